"""A hashed maximum-entropy language model with a class-factored softmax, and a table of word pairs that grows with the corpus.

Words fall into 256 bins by their hash: 16 classes of 16. The softmax part gives
Q(word | history) = P(class | history) * P(bin | class, history) * P(word | bin). The first two are softmaxes over hashed
features of the history: the last word, the one before it (skip) and both together. The last is the word's smoothed share
of its bin's tokens. It learns from all training documents: each task improves the weights over its own texts in small
batches, Spark averages what the tasks learned, and the next round starts from there. These weights have a fixed size.

What follows each word is learned from exact counts of all pairs: P(word | history) =
(count(last word, word) + weight * Q(word | history)) / (count(last word) + weight), where `weight` is the mean number of
different words after a word. It adds up to 1, since every word of a training text is followed by a word or its end.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.llm.packed import Outbox, block_of, bucket_count, receive_blocks, rows, runs, send_blocks, text_size, unpack  # noqa: F401
from tandem.llm.words import WordHashes, hashed_texts, mix, small, split_words, text_bytes
from tandem.workspace import settle

CLASSES = INNER = 16
BINS = CLASSES * INNER
END, START = np.uint64(0x1D8AF066E1C3B5A7), np.uint64(0x6C62272E07BB0142)
BYTES_PER_WORD = 6
CHUNK = 8192
# Tokens a task holds before it merges them; bytes of text in a group; largest score whose exponential is taken as it is.
FEATURES = 2_000_000
GROUP_BYTES = 16 * 1024 * 1024
NEAR = 30


@dataclass(frozen=True)
class Options:
    """`frequent` words have their counts sent to every task; the other words are counted where they meet. `smooth` is
    added to each count. Sizes of the feature tables are powers of two."""

    held_out: int = 10
    smooth: float = 0.1
    frequent: int = 1 << 18
    word_bits: int = 13
    pair_bits: int = 14
    inner_bits: int = 11
    rounds: int = 2
    batch: int = 32768
    rate: float = 0.1

    @property
    def class_rows(self) -> int:
        return 1 + 2 * (1 << self.word_bits) + (1 << self.pair_bits)

    @property
    def inner_rows(self) -> int:
        return CLASSES * ((1 << self.inner_bits) + 1)


def is_held_out(id: Column, options: Options) -> Column:
    """crc32 of the id as text (null: of the empty text), modulo `held_out`, is 0."""
    return F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")) % options.held_out == 0


def token_hashes(text: bytes, hashes: WordHashes) -> np.ndarray:
    """Lower-cased words, then the end of the text."""
    return np.append(hashes.of(split_words(text, lower=True)), END)


def hashed_tokens(batches, column: str = "_text"):
    """Slices of the batches, each with the tokens of its texts, as `token_hashes` gives them, and the edges of the texts."""
    for batch, words, edges in hashed_texts(batches, column):
        yield batch, np.insert(words, edges[1:], END), edges + np.arange(len(edges))


def each_text(batches, column: str = "_text"):
    """The tokens of each text."""
    for _, tokens, edges in hashed_tokens(batches, column):
        for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            yield tokens[i:j]


def bin_of(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(56)).astype(np.int64)


# ---------------------------------------------------------------- counts


@dataclass
class Counts:
    """Of the training tokens: all, distinct, both per bin, and the frequent words' hashes (ascending) with their counts."""

    tokens: int
    words: int
    bin_tokens: np.ndarray
    bin_words: np.ndarray
    frequent: np.ndarray
    counts: np.ndarray

    def __iter__(self):
        """The fields as plain values, in order."""
        return iter(vars(self).values())

    def places(self, tokens: np.ndarray) -> np.ndarray:
        """Place of each token among the frequent words, or -1."""
        at = np.searchsorted(self.frequent, tokens)
        at[at == len(self.frequent)] = 0
        return np.where(self.frequent[at] == tokens, at, -1) if len(self.frequent) else np.full(len(tokens), -1)


def count_words(texts: DataFrame, options: Options, buckets: int) -> Counts:
    """Exact counts. Only sums per bin and the bounded list of frequent words come to the driver."""

    def send(batches, box: Outbox):
        held, size = [], 0
        for tokens in each_text(batches):
            held.append(tokens)
            size += len(tokens)
            if size >= box.flush:
                yield from box.add(*np.unique(np.concatenate(held), return_counts=True))
                held, size = [], 0
        if held:
            yield from box.add(*np.unique(np.concatenate(held), return_counts=True))

    def receive(columns):
        words, count = columns
        edges = runs(words)[:-1]
        total, words = np.add.reduceat(count, edges), words[edges]
        top = np.lexsort((words, -total))[: max(1, options.frequent // buckets)]
        bins = bin_of(words)
        schema = [("kind", pa.int32()), ("key", pa.int64()), ("n", pa.int64()), ("v", pa.int64())]
        yield from rows([np.zeros(BINS, np.int32), np.arange(BINS), np.bincount(bins, total, BINS).astype(np.int64), np.bincount(bins, minlength=BINS)], schema)
        yield from rows([np.ones(len(top), np.int32), words[top].view(np.int64), total[top], np.ones(len(top), np.int64)], schema)

    found = send_blocks(texts, send, ("u8", "i8"), buckets)
    found = settle(receive_blocks(found, receive, ("u8", "i8"), buckets, "kind int, key bigint, n bigint, v bigint"), "vocabulary")
    n, v = np.zeros(BINS, np.int64), np.zeros(BINS, np.int64)
    for row in found.where("kind = 0").groupBy("key").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        n[row["key"]], v[row["key"]] = row["n"], row["v"]
    top = found.where("kind = 1").select("key", "n").collect()
    words = np.array([r["key"] for r in top], np.int64).view(np.uint64)
    order = np.argsort(words)
    return Counts(int(n.sum()), int(v.sum()), n, v, words[order], np.array([r["n"] for r in top], np.int64)[order])


def before(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The token before each; START where texts begin."""
    one = np.empty_like(tokens)
    one[1:] = tokens[:-1]
    one[first] = START
    return one


def pair_keys(one: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return mix(mix(one) * np.uint64(3) + tokens)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and how often each occurs."""
    keys = np.sort(keys)
    edges = runs(keys)
    return keys[edges[:-1]], np.diff(edges)


def _totals(keys: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with the sums of their numbers."""
    order = np.argsort(keys, kind="stable")
    keys, number = keys[order], number[order]
    edges = runs(keys)[:-1]
    return (keys[edges], np.add.reduceat(number, edges)) if len(keys) else (keys, number)


def pack_numbers(first: np.uint64, numbers: np.ndarray) -> bytes:
    """The first key, then of all numbers the first bytes, the second ones and so on, which compress well."""
    return first.tobytes() + numbers.astype(np.int64).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack_numbers(blocks: list[bytes]) -> np.ndarray:
    """The numbers of all blocks, by their first keys."""
    blocks = sorted(blocks, key=lambda x: int.from_bytes(x[:8], "little"))
    planes = [np.frombuffer(x, np.uint8, offset=8).reshape(8, -1).T for x in blocks]
    return np.concatenate([np.empty(0, np.int64), *(np.ascontiguousarray(x).view(np.int64).ravel() for x in planes)])


def count_features(texts: DataFrame, shared, options: Options, groups: int, buckets: int, keys: bool = True) -> DataFrame:
    """`place`, `kind` 0, `block`: for each group of texts its words that are not frequent and its pairs of successive
    words, by hash, with their counts in all training texts. Rows of place -1 hold in `n` the keys counted in a bucket.
    Without `keys`, blocks hold for every key of the group, ascending, its count alone (0: in no training text): a group
    that has its texts knows its keys, and they are most of what would be moved.

    Groups and counts meet by the hash, so the table of counts, which grows with the corpus, is never in one place. A
    group asks for a key once, however often it holds it.
    """
    with_keys = keys
    kinds = ("u8", "i4", "i4")

    def send(batches, box):
        counts = Counts(*shared.value)
        keys, number, held, size, place = np.empty(0, np.uint64), np.empty(0, np.int32), {True: [], False: []}, 0, -1

        def merged():
            """What was merged before with the words and pairs held: how often in training texts, once with 0 in others."""
            found = [(keys, number)]
            for train, tokens in held.items():
                words, often = distinct(np.concatenate([np.empty(0, np.uint64), *(x for x, _ in tokens)]))
                rare = counts.places(words) < 0
                for some, n in ((words[rare], often[rare]), distinct(np.concatenate([np.empty(0, np.uint64), *(x for _, x in tokens)]))):
                    found.append((some, n.astype(np.int32) * train))
            return _totals(*(np.concatenate(x) for x in zip(*found, strict=True)))

        for batch, tokens, edges in hashed_tokens(batches):
            if not batch.num_rows:
                continue
            pairs = pair_keys(before(tokens, edges[:-1]), tokens)
            train = np.repeat(batch.column("train").to_numpy(zero_copy_only=False).astype(bool), np.diff(edges))
            for flag in held:
                held[flag].append((tokens[train == flag], pairs[train == flag]))
            size, place = size + len(tokens), batch.column("place")[0].as_py()
            if size >= FEATURES:
                keys, number = merged()
                held, size = {True: [], False: []}, 0
        if place >= 0:
            keys, number = merged()
            for i in range(0, len(keys), box.flush):
                yield from box.add(keys[i : i + box.flush], np.full(len(keys[i : i + box.flush]), place, np.int32), number[i : i + box.flush])

    def receive(columns):
        keys, place, number = columns
        edges = runs(keys)
        sums = np.add.reduceat(number.astype(np.int64), edges[:-1])
        total = np.repeat(sums, np.diff(edges))
        if with_keys:
            known = np.flatnonzero(total)
            keys, place, total = keys[known], place[known], total[known]
        # Small numbers are sorted by radix.
        order = np.argsort(place.astype(np.uint16) if groups <= 1 << 16 else place, kind="stable")
        keys, place, total = keys[order], place[order], total[order]
        edges = runs(place)
        blocks = [block_of([keys[i:j], total[i:j]]) if with_keys else pack_numbers(keys[i], total[i:j]) for i, j in zip(edges[:-1], edges[1:], strict=True)]
        at = [int(place[i]) for i in edges[:-1]]
        schema = [("place", pa.int32()), ("kind", pa.int32()), ("n", pa.int64()), ("block", pa.binary())]
        yield from rows([[*at, -1], [0] * (len(at) + 1), [0] * len(at) + [int((sums > 0).sum())], [*blocks, None]], schema, 64)

    asked = send_blocks(texts.select("place", "_text", "train").repartitionById(groups, "place"), send, kinds, buckets)
    return receive_blocks(asked, receive, kinds, buckets, "place int, kind int, n bigint, block binary")


# ---------------------------------------------------------------- weights


class Weights:
    """Two tables: class scores by feature, and scores within a class by feature and class."""

    def __init__(self, options: Options, values: np.ndarray | None = None):
        self.options = options
        size = options.class_rows * CLASSES
        values = np.zeros(size + options.inner_rows * INNER, np.float32) if values is None else values
        self.values = values
        self.outer, self.inner = values[:size].reshape(-1, CLASSES), values[size:].reshape(-1, INNER)

    def features(self, tokens: np.ndarray, first: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Rows of the outer table and, given each token's class, of the inner one. `first` marks where texts begin."""
        o = self.options
        one = before(tokens, first)
        two = before(one, first)
        cut = lambda x, bits: (x >> np.uint64(64 - bits)).astype(np.int64)
        a, b, both = mix(one), mix(two ^ np.uint64(0x5555)), mix(one * np.uint64(3) + mix(two))
        words = 1 << o.word_bits
        outer = [np.zeros(len(tokens), np.int64), 1 + cut(a, o.word_bits), 1 + words + cut(b, o.word_bits), 1 + 2 * words + cut(both, o.pair_bits)]
        known = bin_of(tokens) // INNER
        return outer, [known, CLASSES + (known << o.inner_bits) + cut(a, o.inner_bits)]

    def log_chances(self, tokens: np.ndarray, first: np.ndarray, learn=None) -> np.ndarray:
        """Natural log of P(bin | history) per token; `learn` gets each table's rows and what remains of the truth."""
        outer, inner = self.features(tokens, first)
        bins, at = bin_of(tokens), np.arange(len(tokens))
        total = np.zeros(len(tokens), np.float32)
        ones = np.ones(CLASSES, np.float32)
        for table, parts, gold in ((self.outer, outer, bins // INNER), (self.inner, inner, bins % INNER)):
            score = np.take(table, parts[0], axis=0)
            for f in parts[1:]:
                score += np.take(table, f, axis=0)
            # Exponentials of scores near 0 need no shift.
            if len(score) and max(score.max(), -score.min()) > NEAR:
                score -= np.maximum.reduce(score.T.copy())[:, None]
            total += score[at, gold]
            chance = np.exp(score, out=score)
            norm = chance @ ones
            total -= np.log(norm)
            if learn is not None:
                chance *= (-1 / norm)[:, None]
                chance[at, gold] += 1
                learn(table, parts, chance)
        return total


def _improve(weights: Weights, squares: dict[int, np.ndarray], tokens: np.ndarray, first: np.ndarray) -> None:
    """One AdaGrad step on a batch. Only rows of its features change."""

    def learn(table, parts, rest):
        used = np.zeros(len(table), bool)
        for f in parts:
            used[f] = True
        rows = np.flatnonzero(used)
        place = np.cumsum(used) - 1
        columns = np.ascontiguousarray(rest.T, np.float64)
        grad = np.zeros((table.shape[1], len(rows)))
        for f in parts:
            if (f == f[0]).all():
                grad[:, place[f[0]]] += columns.sum(axis=1)
                continue
            at = place[f]
            for sums, column in zip(grad, columns, strict=True):
                sums += np.bincount(at, column, len(rows))
        grad = np.ascontiguousarray(grad.T, np.float32)
        square = squares.setdefault(id(table), np.full(table.shape, 1.0, np.float32))
        now = square[rows] + grad * grad
        square[rows] = now
        grad *= weights.options.rate
        grad /= np.sqrt(now, out=now)
        table[rows] += grad

    if len(tokens):
        weights.log_chances(tokens, first, learn)


def _batches(batches, column: str, size: int):
    """Token arrays of about `size`, with the places where texts begin."""
    held, n = [], 0
    for tokens in each_text(batches, column):
        held.append(tokens)
        n += len(tokens)
        if n >= size:
            yield np.concatenate(held), np.cumsum([0, *map(len, held[:-1])])
            held, n = [], 0
    if held:
        yield np.concatenate(held), np.cumsum([0, *map(len, held[:-1])])


def train(texts: DataFrame, options: Options) -> Weights:
    """Rounds of local gradient steps, averaged by the number of tokens each task has learned from.

    Weights have a fixed size, whatever the corpus. They are averaged in chunks by Spark, and come to the driver once a round.
    """
    spark = texts.sparkSession
    weights = Weights(options)
    for _ in range(options.rounds):
        start = spark.sparkContext.broadcast(weights.values)

        def learn(batches, start=start):
            own, squares, n = Weights(options, start.value.copy()), {}, 0
            for tokens, first in _batches(batches, "_text", options.batch):
                # Long texts are learned from in pieces.
                for i in range(0, len(tokens), options.batch):
                    _improve(own, squares, tokens[i : i + options.batch], np.append(0, first[(first > i) & (first < i + options.batch)] - i))
                n += len(tokens)
            if n:
                parts = [own.values[i : i + CHUNK].tobytes() for i in range(0, len(own.values), CHUNK)]
                yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([n] * len(parts), pa.int64()), pa.array(parts, pa.binary())], ["chunk", "n", "part"])

        def average(batches):
            sums: dict[int, list] = {}
            for batch in small(batches):
                for chunk, n, part in zip(*(batch.column(c).to_pylist() for c in ("chunk", "n", "part")), strict=True):
                    held = sums.setdefault(chunk, [0.0, 0])
                    held[0] = held[0] + n * np.frombuffer(part, np.float32).astype(np.float64)
                    held[1] += n
            if sums:
                parts = [(s / n).astype(np.float32).tobytes() for s, n in sums.values()]
                yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(parts, pa.binary())], ["chunk", "part"])

        chunks = -(-len(weights.values) // CHUNK)
        learned = texts.select("_text").mapInArrow(learn, "chunk int, n bigint, part binary").repartitionById(chunks, "chunk")
        values = weights.values.copy()
        for row in learned.mapInArrow(average, "chunk int, part binary").collect():
            part = np.frombuffer(row["part"], np.float32)
            values[row["chunk"] * CHUNK : row["chunk"] * CHUNK + len(part)] = part
        weights = Weights(options, values)
    return weights


# ---------------------------------------------------------------- scores


def score_documents(docs: DataFrame, options: Options = Options(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """`id`, held_out, n_tokens, n_known, train_tokens, base_score (unigrams) and score (the model), both log10.

    Null texts count as empty: the end token alone. Rows that repeat an id and text get equal scores, and count as often
    as they occur in training. Without training texts all words are unknown.
    """
    spark = docs.sparkSession
    held = is_held_out(F.col(id), options)
    texts = docs.select(F.col(id).alias("_id"), text_bytes(text).alias("_text"), (~held).alias("train"), F.xxhash64(F.col(id), F.col(text)).alias("key"))
    size = text_size(docs, text)
    words = size / BYTES_PER_WORD
    training = texts.where("train")
    total = count_words(training, options, bucket_count(docs, words / 4))
    # Plain values: a class of this package would travel by name, and executors need no copy of it.
    shared = spark.sparkContext.broadcast(tuple(total))
    # A group's texts are scored where the counts of their words and pairs arrive.
    groups = max(2 * spark.sparkContext.defaultParallelism, size // GROUP_BYTES + 1)
    texts = texts.withColumn("place", F.pmod("key", F.lit(groups)).cast("int"))
    features = settle(count_features(texts, shared, options, groups, bucket_count(docs, words / 2), keys=False), "features")
    pairs = features.where("place < 0").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] - (total.words - len(total.frequent))
    # The model counts as many tokens beside those that followed a word as words follow one on average.
    weight = max(1.0, pairs / max(1, total.words))
    model = spark.sparkContext.broadcast(train(training, options).values)

    def score(batches):
        counts, weights = Counts(*shared.value), Weights(options, model.value)
        share = np.log10(counts.bin_tokens + options.smooth * (counts.bin_words + 1))
        blocks, places, held, who = [], {}, [np.array([END])], []
        for batch in small(batches):
            blocks += batch.column("block").drop_null().to_pylist()
            batch = batch.filter(pc.equal(batch.column("kind"), 1))
            # Rows that repeat a text share its tokens.
            at, new = [], []
            for i, text in enumerate(batch.column("_text").to_pylist()):
                digest = xxhash.xxh3_128_digest(text)
                if digest not in places:
                    places[digest] = len(places)
                    new.append(i)
                at.append(places[digest])
            who.append((batch.column("_id"), batch.column("train"), np.array(at, np.int64)))
            held += each_text([batch.select(["_text"]).take(new)])
        if not places:
            return
        # The end alone stands first, for the number of texts.
        lengths = np.array(list(map(len, held)), np.int64)
        tokens, edges = np.concatenate(held), np.append(0, np.cumsum(lengths))
        held.clear()
        first = edges[:-1]
        pairs = pair_keys(before(tokens, first), tokens)[1:]
        # The group's counts come in the order of its keys.
        order = np.argsort(tokens)
        bounds = runs(tokens[order])
        words = tokens[order[bounds[:-1]]]
        at = counts.places(words)
        rare = words[at < 0]
        wanted = np.concatenate([pairs, rare])
        by_key = np.argsort(wanted)
        edges_of_keys = runs(wanted[by_key])
        found = unpack_numbers(blocks)
        blocks.clear()
        if len(found) != len(edges_of_keys) - 1:
            raise RuntimeError(f"{len(found)} counts for {len(edges_of_keys) - 1} words and pairs")
        numbers = np.empty(len(wanted), np.int64)
        numbers[by_key] = np.repeat(found, np.diff(edges_of_keys))
        of_word = np.empty(len(words), np.int64)
        of_word[at >= 0], of_word[at < 0] = counts.counts[at[at >= 0]], numbers[len(pairs) :]
        number = np.empty(len(tokens), np.int64)
        number[order] = np.repeat(of_word, np.diff(bounds))
        del order, by_key, wanted, found
        out = np.zeros((3, len(lengths)))
        k = 1
        while k < len(lengths):
            # As many texts as make a batch; one at least.
            end = max(k + 1, int(np.searchsorted(edges, edges[k] + options.batch, "right")) - 1)
            i, j = edges[k], edges[end]
            starts, every, own = edges[k:end] - i, tokens[i:j], number[i:j]
            context = np.concatenate([
                weights.log_chances(every[x : x + options.batch], np.append(0, starts[(starts > x) & (starts < x + options.batch)] - x))
                for x in range(0, len(every), options.batch)
            ]).astype(np.float64)
            alone = np.log10(own + options.smooth)
            # Texts begin as often as they end.
            history = np.empty_like(own)
            history[1:] = own[:-1]
            history[starts] = number[0]
            chance = np.exp(context + np.log(10) * (alone - share[bin_of(every)]))
            chance = np.log10((numbers[i - 1 : j - 1] + weight * chance) / (history + weight))
            for row, value in enumerate((alone, own > 0, chance)):
                out[row, k:end] = np.add.reduceat(value.astype(np.float64), starts)
            k = end
        for ids, train, at in who:
            if len(at):
                at = at + 1
                columns = [ids, train, pa.array(lengths[at]), pa.array(out[0, at]), pa.array(out[1, at].astype(np.int64)), pa.array(out[2, at])]
                yield pa.RecordBatch.from_arrays(columns, ["_id", "train", "n", "s", "k", "c"])

    kind = texts.schema["_id"].dataType.simpleString()
    sent = features.where("place >= 0").select("place", "kind", "block", F.lit(None).cast(kind).alias("_id"), F.lit(None).cast("binary").alias("_text"), F.lit(None).cast("boolean").alias("train"))
    sent = sent.unionByName(texts.select("place", F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("block"), "_id", "_text", "train"))
    sent = sent.repartitionById(groups, "place")
    scored = sent.mapInArrow(score, f"_id {kind}, train boolean, n bigint, s double, k bigint, c double")
    base = float(np.log10(total.tokens + options.smooth * (total.words + 1)))
    return scored.select(
        F.col("_id").alias(id),
        (~F.col("train")).alias("held_out"),
        F.col("n").alias("n_tokens"),
        F.col("k").alias("n_known"),
        F.lit(total.tokens).cast("bigint").alias("train_tokens"),
        (F.col("s") - F.col("n") * base).alias("base_score"),
        F.col("c").alias("score"),
    )
