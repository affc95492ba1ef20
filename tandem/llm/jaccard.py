"""N-gram Jaccard self-join by a token-group matrix.

1. Screening. Every set sends the part of its tokens with the lowest hashes. Tokens found in one set only cannot be
   shared, so a set with too few shared tokens has no partner and leaves. What is left are near copies and the like.
2. The rest send all their tokens; the shared ones give each set's largest possible partner.
3. Similar sets are grouped: sets with an equal min-hash are checked against the one among them with the fewest
   tokens of its own, and those that link form one group.
4. Matrix. Groups, and sets that are alone but share a min-hash, are cut into parts of bounded size. Each part's tokens
   are stored, one row per token and part, and parts meet where a rare token of one is among those of the other. There a
   set's overlap with the other part's token union bounds that with every member; only parts that reach the bound are
   opened, and their sets counted at once. A pair of parts gives as many links as connect its groups, no more.

All bounds are exact, so no link between groups is lost. Tokens and sets stand as 64-bit hashes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.llm.components import components
from tandem.llm.packed import bucket_count, forward_blocks, receive_blocks, rows, runs, send_blocks, text_size
from tandem.llm.words import WordHashes, bounded_batches, mix, small, split_words, text_bytes, window_hashes
from tandem.workspace import settle

#: Min-hash keys per set in step 3; more keys find more links early, none is needed for the result.
KEYS = 4
#: Sets per part of a group, and their tokens.
GROUP, GROUP_TOKENS = 256, 1 << 17
#: Tasks over which the rows of one group are dealt in joins.
SALTS = 32
BYTES_PER_WORD = 6
ALL = 2**64 - 1


@dataclass(frozen=True)
class Join:
    """Shingles of `size` words; sets link when 100 * intersection >= percent * union."""

    size: int = 4
    percent: int = 85

    def least_overlap(self, n):
        """With a partner of any size."""
        return -(-self.percent * n // 100)

    def overlap(self, n, m):
        return -(-self.percent * (n + m) // (100 + self.percent))

    def largest_partner(self, matched, n):
        return (100 + self.percent) * matched // self.percent - n

    def alone(self, n):
        """Sets so small that only an equal one links."""
        return 100 * n < self.percent * (n + 1)

    def share(self, n) -> np.ndarray:
        """Part of its tokens that a set counts in the screening: beyond 1 - percent, and more for small sets."""
        return np.minimum(1.0, 1.2 * (1 - self.percent / 100) + 2 / np.sqrt(np.maximum(n, 1)))


def token_set(text: bytes, hashes: WordHashes, size: int) -> np.ndarray:
    """Sorted distinct hashes of the lower-cased text's shingles; fewer words than `size` make one shingle."""
    words = hashes.of(split_words(text, lower=True))
    return np.unique(window_hashes(words, min(size, len(words)), seed=1)) if len(words) else words


def set_hash(tokens: np.ndarray) -> int:
    """63 bits over the sorted tokens and their number."""
    place = mix(np.arange(1, len(tokens) + 1, dtype=np.uint64) + np.uint64(len(tokens) << 32))
    return int(mix(np.array([np.bitwise_xor.reduce(mix(tokens ^ place)) + np.uint64(len(tokens))]))[0] >> np.uint64(1)) if len(tokens) else 0


def _sets(docs: DataFrame, join: Join) -> DataFrame:
    """`id`, `sid` (hash of the set), `n`, and `n_low`, the tokens counted in the screening."""

    def measure(batches):
        hashes = WordHashes()
        for batch in small(batches):
            out = []
            for text in batch.column("_text").to_pylist():
                tokens = token_set(text, hashes, join.size)
                out.append((set_hash(tokens), len(tokens), len(tokens) and int(np.searchsorted(tokens, _low(join, len(tokens)), "right"))))
            columns = [pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [[]] * 3)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], ["id", "sid", "n", "n_low"])

    return docs.mapInArrow(measure, "id bigint, sid bigint, n bigint, n_low bigint")


def _low(join: Join, n) -> np.uint64:
    """The largest token hash that a set of n tokens counts."""
    share = float(join.share(n))
    return np.uint64(ALL if share >= 1 else int(share * 2.0**64))


def _screen(docs: DataFrame, join: Join, buckets: int) -> DataFrame:
    """`sid`, `m`: how many counted tokens of the set some other set has too."""

    def send(batches, box):
        hashes, seen = WordHashes(), set()
        for batch in small(batches):
            for text in batch.column("_text").to_pylist():
                tokens = token_set(text, hashes, join.size)
                if join.alone(len(tokens)) or (sid := set_hash(tokens)) in seen:
                    continue
                seen.add(sid)
                # As far as any partner may count; partners can be smaller.
                sent = tokens[: np.searchsorted(tokens, _low(join, join.least_overlap(len(tokens))), "right")]
                counted = np.searchsorted(sent, _low(join, len(tokens)), "right")
                yield from box.add(sent, np.full(len(sent), sid, np.uint64), np.arange(len(sent)) < counted)

    def turn(columns):
        _, sid, counted, _ = _shared(*columns)
        found, count = np.unique(sid[counted > 0], return_counts=True)
        yield _key(found), count

    def receive(columns):
        key, count = columns
        edges = runs(key)[:-1]
        yield from rows([_sid(key[edges]), np.add.reduceat(count.astype(np.int64), edges)], [("sid", pa.int64()), ("m", pa.int64())])

    blocks = send_blocks(docs.select("_text"), send, ("u8", "u8", "u1"), buckets)
    return receive_blocks(forward_blocks(blocks, turn, ("u8", "u8", "u1"), ("u8", "u4"), buckets), receive, ("u8", "u4"), buckets, "sid bigint, m bigint")


def _key(sid: np.ndarray) -> np.ndarray:
    """Set hashes have 63 bits; keys fill 64."""
    return sid << np.uint64(1)


def _sid(key: np.ndarray) -> np.ndarray:
    return (key >> np.uint64(1)).astype(np.int64)


def _shared(tokens: np.ndarray, sid: np.ndarray, *more: np.ndarray):
    """Rows of tokens that two or more sets have, one per token and set, and the number of sets of each row's token."""
    edges = runs(tokens)
    several = np.repeat(np.diff(edges) > 1, np.diff(edges))
    tokens, sid, more = tokens[several], sid[several], [x[several] for x in more]
    order = np.lexsort((sid, tokens))
    tokens, sid, more = tokens[order], sid[order], [x[order] for x in more]
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (sid[1:] != sid[:-1])
    tokens, sid, more = tokens[new], sid[new], [x[new] for x in more]
    size = np.diff(runs(tokens))
    df = np.repeat(size, size)
    keep = df > 1
    return [tokens[keep], sid[keep], *(x[keep] for x in more), df[keep]]


def _shared_tokens(docs: DataFrame, left: DataFrame, join: Join, buckets: int) -> DataFrame:
    """`sid`, `n`, `matched`, `largest`, `tokens` (packed, ascending) and `df` (packed) of sets that may have a partner.

    Only tokens that two or more of the sets have are kept: no others can be in an intersection.
    """

    def send(batches, box):
        hashes = WordHashes()
        for batch in small(batches):
            for text, sid in zip(batch.column("_text").to_pylist(), batch.column("sid").to_pylist(), strict=True):
                tokens = token_set(text, hashes, join.size)
                if set_hash(tokens) == sid:
                    yield from box.add(tokens, np.full(len(tokens), sid, np.uint64))

    def turn(columns):
        tokens, sid, df = _shared(*columns)
        yield _key(sid), tokens, df

    def receive(columns):
        key, tokens, df = columns
        edges = runs(key)
        out = []
        for i, j in zip(edges, edges[1:], strict=False):
            order = np.argsort(tokens[i:j])
            out.append((j - i, tokens[i:j][order].tobytes(), df[i:j][order].tobytes()))
        if out:
            kinds = [("sid", pa.int64()), ("matched", pa.int64()), ("tokens", pa.binary()), ("df", pa.binary())]
            yield from rows([_sid(key[edges[:-1]]), *map(list, zip(*out, strict=True))], kinds)

    first = left.withColumnsRenamed({"id": "_first", "sid": "_sid"}).select("_first", "_sid")
    # The texts pass the narrow side, which is built, unsorted, and alike at every size.
    texts = docs.join(first.hint("shuffle_hash"), docs["id"].eqNullSafe(first["_first"])).select("_text", F.col("_sid").alias("sid"))
    blocks = forward_blocks(send_blocks(texts, send, ("u8", "u8"), buckets), turn, ("u8", "u8"), ("u8", "u8", "u4"), buckets)
    table = receive_blocks(blocks, receive, ("u8", "u8", "u4"), buckets, "sid bigint, matched bigint, tokens binary, df binary")
    table = table.join(left.select("sid", "n"), "sid").withColumn("largest", F.expr(f"matched * {100 + join.percent} div {join.percent}") - F.col("n"))
    return settle(table.where(F.col("largest") * 100 >= F.col("n") * join.percent), "shared")


def _check(pairs: DataFrame, join: Join) -> DataFrame:
    """Rows of (a, b, n_a, n_b, tokens_a, tokens_b) whose common tokens reach the bound for these sizes."""

    def verify(batches):
        for batch in small(batches):
            n, m = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("n_a", "n_b"))
            need = join.overlap(n, m)
            keep = [
                k
                for k, (x, y) in enumerate(zip(batch.column("tokens_a").to_pylist(), batch.column("tokens_b").to_pylist(), strict=True))
                if len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True)) >= need[k]
            ]
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(keep, pa.int64())) for c in ("a", "b")], ["a", "b"])

    return pairs.select("a", "b", "n_a", "n_b", "tokens_a", "tokens_b").mapInArrow(verify, "a bigint, b bigint")


def _with_tokens(pairs: DataFrame, table: DataFrame) -> DataFrame:
    one = table.select(F.col("sid").alias("a"), F.col("n").alias("n_a"), F.col("tokens").alias("tokens_a"))
    two = table.select(F.col("sid").alias("b"), F.col("n").alias("n_b"), F.col("tokens").alias("tokens_b"))
    return pairs.join(one, "a").join(two, "b")


def _group(table: DataFrame, join: Join) -> DataFrame:
    """Links (a, b) between sets with an equal min-hash and the leader of that hash."""

    def sign(batches):
        for batch in small(batches):
            out = []
            for t in batch.column("tokens").to_pylist():
                tokens = np.frombuffer(t, np.uint64)
                out += [int(mix(tokens ^ np.uint64(0xA5A5 * (j + 1))).min().astype(np.int64)) for j in range(KEYS)]
            many = lambda c: np.repeat(batch.column(c).to_numpy(), KEYS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(many("sid")), pa.array(many("n")), pa.array(many("rest")), pa.array(np.tile(np.arange(KEYS), batch.num_rows)), pa.array(out, pa.int64())],
                ["sid", "n", "rest", "j", "key"],
            )

    keyed = table.select("sid", "n", "tokens", (F.col("n") - F.col("matched")).alias("rest")).mapInArrow(sign, "sid bigint, n bigint, rest bigint, j bigint, key bigint")
    leader = keyed.groupBy("j", "key").agg(F.min(F.struct("rest", "sid", "n")).alias("lead"), F.count("*").alias("size")).where("size > 1")
    # A table of its own, so that Spark may split the rows of a frequent key in the join.
    leader = settle(leader, "leaders")
    near = (F.col("n") * join.percent <= F.col("lead.n") * 100) & (F.col("lead.n") * join.percent <= F.col("n") * 100)
    pairs = keyed.join(leader, ["j", "key"]).where(near & (F.col("sid") != F.col("lead.sid"))).select(F.col("sid").alias("a"), F.col("lead.sid").alias("b")).distinct()
    return settle(_check(_with_tokens(pairs, table), join), "links")


def _salt(sid: str = "sid") -> Column:
    return F.pmod(F.xxhash64(sid), F.lit(SALTS)).cast("int").alias("salt")


def _salted(df: DataFrame) -> DataFrame:
    """A small table for each salt, so that the many rows of one of its keys are dealt over SALTS tasks."""
    return df.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))


def _parted(table: DataFrame, groups: DataFrame) -> DataFrame:
    """`table` with `root` (a set alone is its own) and `part`: similar sets, about GROUP or GROUP_TOKENS tokens of them.

    Sets already linked are similar; of the others those with an equal min-hash are, linked or not. So a crowd of copies
    of one text that are too far apart for links still makes few parts.
    """

    def sign(batches):
        for batch in small(batches):
            keys = [int(mix(np.frombuffer(t, np.uint64) ^ np.uint64(0xA5A5)).min().astype(np.int64)) for t in batch.column("tokens").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.int64())], [*batch.schema.names, "key"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema)
    keyed = table.mapInArrow(sign, f"{fields}, key bigint").join(groups.withColumnRenamed("node", "sid"), "sid", "left")
    alike = F.when(F.col("root").isNull(), F.xxhash64(F.lit("key"), "key")).otherwise(F.xxhash64(F.lit("root"), "root"))
    keyed = settle(keyed.select("sid", "n", "largest", F.coalesce("root", "sid").alias("root"), alike.alias("alike"), "tokens", "df"), "alike")
    weight = F.sum(F.octet_length("tokens") / 8) / GROUP_TOKENS
    cuts = keyed.groupBy("alike").agg(F.ceil(F.greatest(F.count("*") / GROUP, weight)).cast("int").alias("cuts")).where("cuts > 1")
    cut = keyed.withColumn("salt", _salt()).join(_salted(settle(cuts, "group-cuts")), ["alike", "salt"], "left")
    part = F.xxhash64("alike", F.pmod(F.xxhash64("sid", F.lit(1)), F.coalesce("cuts", F.lit(1))))
    return settle(cut.select("sid", "n", "largest", "root", part.alias("part"), "tokens", "df"), "grouped")


PACKED = "part bigint, sid binary, n binary, largest binary, root binary, edges binary, tokens binary"


def _packed_parts(sets: DataFrame) -> DataFrame:
    """One row per part: its sets' columns as arrays, and their tokens one after the other."""

    def pack(batches):
        for batch in small(batches):
            out = []
            for members in batch.column("members").to_pylist():
                numbers = [np.array([m[c] for m in members], np.int64).tobytes() for c in ("sid", "n", "largest", "root")]
                edges = np.cumsum([0, *(len(m["tokens"]) // 8 for m in members)], dtype=np.int64)
                out.append((*numbers, edges.tobytes(), b"".join(m["tokens"] for m in members)))
            columns = [pa.array(c, pa.binary()) for c in (zip(*out, strict=True) if out else [[]] * 6)]
            yield pa.RecordBatch.from_arrays([batch.column("part"), *columns], ["part", "sid", "n", "largest", "root", "edges", "tokens"])

    members = F.collect_list(F.struct("sid", "n", "largest", "root", "tokens")).alias("members")
    return sets.groupBy("part").agg(members).mapInArrow(pack, PACKED)


def _links_between(one: dict[str, np.ndarray], two: dict[str, np.ndarray], join: Join) -> list[tuple[int, int]]:
    """Links between sets of two parts, as many as join their roots: what else links them says nothing new."""
    # The union of the second part, and which of its sets each token stands for.
    member = np.repeat(np.arange(len(two["n"])), np.diff(two["edges"]))
    order = np.argsort(two["tokens"], kind="stable")
    tokens, member = two["tokens"][order], member[order]
    root = {int(r): int(r) for r in (*one["root"], *two["root"])}

    def top(r: int) -> int:
        while root[r] != r:
            root[r] = root[root[r]]
            r = root[r]
        return r

    links = []
    for a in range(len(one["n"])):
        own, n = one["tokens"][one["edges"][a] : one["edges"][a + 1]], one["n"][a]
        low, high = np.searchsorted(tokens, own, "left"), np.searchsorted(tokens, own, "right")
        # Fewer tokens in the union than any of its sets would have to share: the part stays closed to this set.
        if np.count_nonzero(high > low) < join.overlap(n, two["n"].min()):
            continue
        met = np.concatenate([member[i:j] for i, j in zip(low, high, strict=True)] or [member[:0]])
        common = np.bincount(met, minlength=len(two["n"]))
        for b in np.flatnonzero(common >= join.overlap(n, two["n"])):
            x, y = top(int(one["root"][a])), top(int(two["root"][b]))
            if x != y:
                root[max(x, y)] = min(x, y)
                links.append((int(one["sid"][a]), int(two["sid"][b])))
    return links


def _across(table: DataFrame, groups: DataFrame, join: Join) -> DataFrame:
    """Links between sets of different groups. `groups` has `node`, `root` for those sets that are not alone.

    Parts meet parts, not sets: what Spark joins grows with the parts of a crowd, and what it passes on with the roots.
    """
    sets = _parted(table.drop("matched"), groups)

    def rarest(batches):
        """One row for each token among the rarest of a set that any partner must share one of."""
        for batch in small(batches):
            tokens, source = [], []
            n = batch.column("n").to_pylist()
            for k, (t, d) in enumerate(zip(batch.column("tokens").to_pylist(), batch.column("df").to_pylist(), strict=True)):
                t, d = np.frombuffer(t, np.uint64), np.frombuffer(d, np.uint32)
                first = np.lexsort((t, d))[: len(t) - join.least_overlap(n[k]) + 1]
                tokens.append(t[first])
                source.append(np.full(len(first), k))
            if tokens:
                source = pa.array(np.concatenate(source))
                names = ["n", "largest", "root", "part"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens).astype(np.int64)), *(batch.column(c).take(source) for c in names)], ["token", *names]
                )

    # The matrix: one row per token and part, with the range of sizes and roots.
    prefix = sets.mapInArrow(rarest, "token bigint, n bigint, largest bigint, root bigint, part bigint")
    matrix = prefix.groupBy("token", "part").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.max("largest").alias("largest"), F.min("root").alias("x"), F.max("root").alias("y")
    )
    matrix = settle(matrix, "matrix")
    between = matrix.groupBy("token").agg(F.min("x").alias("x"), F.max("y").alias("y")).where("x <> y").select("token")
    matrix = settle(matrix.join(between, "token", "left_semi"), "shared-matrix")
    other = matrix.withColumnsRenamed({c: f"{c}_b" for c in ("part", "low", "high", "largest", "x", "y")})
    p = join.percent
    sizes = F.expr(f"low_b <= largest and low <= largest_b and low * {p} <= high_b * 100 and low_b * {p} <= high * 100")
    roots = (F.col("x") != F.col("y")) | (F.col("x_b") != F.col("y_b")) | (F.col("x") != F.col("x_b"))
    meets = matrix.join(other, "token").where((F.col("part") >= F.col("part_b")) & sizes & roots).select("part", "part_b").distinct()
    meets = settle(meets, "meets")

    touched = meets.select("part").unionByName(meets.select(F.col("part_b").alias("part"))).distinct()
    parts = settle(_packed_parts(sets.join(touched, "part", "left_semi")), "parts")
    names = ["sid", "n", "largest", "root", "edges", "tokens"]

    def check(batches):
        for batch in batches:
            links = []
            for k in range(batch.num_rows):
                one, two = (
                    {c: np.frombuffer(batch.column(c + end)[k].as_py(), np.uint64 if c == "tokens" else np.int64) for c in names} for end in ("", "_b")
                )
                links += _links_between(one, two, join)
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], ["a", "b"])

    both = meets.join(parts, "part").join(parts.withColumnsRenamed({c: f"{c}_b" for c in ("part", *names)}), "part_b")
    return both.select(*names, *(f"{c}_b" for c in names)).mapInArrow(check, "a bigint, b bigint")


def similar_documents(docs: DataFrame, join: Join = Join(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """`id`, `n_shingles` and `component_id`, the smallest id that a chain of links reaches, for every row.

    Null texts and texts without words have the empty set: 0 shingles, no link, their own id. Equal sets are linked and
    handled once. Repeated ids keep their rows; a null id is never the smallest, so a component of null ids has null.
    """
    bounded_batches(docs.sparkSession)
    narrow = docs.select(F.col(id).cast("bigint").alias("id"), text_bytes(text).alias("_text"))
    members = settle(_sets(narrow, join), "sets")
    buckets = bucket_count(docs, text_size(docs, text) / BYTES_PER_WORD * 0.25)
    distinct = members.where("n > 0").groupBy("sid").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("n_low").alias("n_low"))

    screened = _screen(narrow, join, buckets)
    need = F.ceil(F.col("n") * join.percent / 100) - (F.col("n") - F.col("n_low"))
    able = (F.col("n") + 1) * join.percent <= F.col("n") * 100
    left = distinct.join(screened, "sid", "left").where(able & (F.coalesce("m", F.lit(0)) >= need)).select("sid", "id", "n")
    table = _shared_tokens(narrow, settle(left, "left"), join, buckets)

    links = _group(table, join)
    groups = components(links)
    found = components(links.unionByName(_across(table, groups, join)))

    own = members.where("n > 0").groupBy("sid").agg(F.min("id").alias("low"))
    linked = settle(own.join(found.withColumnRenamed("node", "sid"), "sid").withColumn("salt", _salt()), "linked")
    lowest = settle(linked.groupBy("root").agg(F.min("low").alias("component_id")), "lowest")
    named = linked.join(_salted(lowest), ["root", "salt"]).select("sid", "component_id")
    label = own.join(named, "sid", "left").select(F.col("sid").alias("_sid"), F.coalesce("component_id", "low").alias("component_id"))
    out = members.join(settle(label, "labels"), (F.col("sid") == F.col("_sid")) & (F.col("n") > 0), "left")
    return out.select(F.col("id").alias(id), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
