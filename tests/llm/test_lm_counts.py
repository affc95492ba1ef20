"""The language model's words, learning and counts against plain forms."""

import collections
import math
import random
import zlib

import numpy as np
import pyarrow as pa

from tandem.llm import lm
from tandem.llm.words import WordHashes, hashed_texts

OPTIONS = lm.Options(frequent=8, rounds=0, batch=64)


def held(doc):
    return zlib.crc32(str(doc).encode()) % 10 == 0


def rows_of(n):
    """Texts of few words, long ones among them, one without words, and rows that come twice."""
    rnd = random.Random(5)
    words = [f"Word{i}" for i in range(40)]
    rows = [(i, " ".join(rnd.choices(words, k=rnd.choice([0, 1, 5, 30, 200])))) for i in range(n)]
    return rows + rows[:7] + [(n, None)]


def tokens_of(rows):
    return [(d, [lm.START, *lm.token_hashes((t or "").encode(), lm.WordHashes())]) for d, t in rows]


def test_words_of_all_lengths_are_hashed_alike():
    rnd = random.Random(3)
    texts = [bytes(rnd.choice(b"abAZ \t\n\r\x0b\x0c\x1c\x85\xa0\xc3\xff0") for _ in range(rnd.randrange(80))) for _ in range(500)]
    texts += [b"", None, b" ", bytes(range(256))] + [bytes(rnd.randrange(33, 256) for _ in range(k)) for k in range(1, 300)]
    batch = pa.RecordBatch.from_arrays([pa.array([b"cut off", *texts], pa.binary())], ["t"]).slice(1)
    found = [words[i:j].tolist() for _, words, edges in hashed_texts([batch], "t") for i, j in zip(edges, edges[1:], strict=False)]
    assert found == [WordHashes().of((t or b"").lower().split()).tolist() for t in texts]


def test_a_step_changes_what_a_plain_step_changes():
    options = lm.Options(word_bits=4, pair_bits=5, inner_bits=2)
    rng = np.random.default_rng(2)
    for spread in (0.5, 200):
        values = rng.normal(size=lm.Weights(options).values.shape).astype(np.float32) * np.float32(spread)
        tokens, first = rng.integers(0, 2**64, 300, dtype=np.uint64), np.array([0, 7, 100])
        bins, parts = lm.bin_of(tokens), lm.Weights(options).features(tokens, first)
        got, want = lm.Weights(options, values.copy()), lm.Weights(options, values.copy())
        lm._improve(got, {}, tokens, first)
        for table, rows, gold in ((want.outer, parts[0], bins // lm.INNER), (want.inner, parts[1], bins % lm.INNER)):
            score = sum(table[f].astype(float) for f in rows)
            chance = np.exp(score - score.max(axis=1)[:, None])
            rest = np.eye(16)[gold] - chance / chance.sum(axis=1)[:, None]
            grad = np.zeros(table.shape)
            for f in rows:
                np.add.at(grad, f, rest)
            table += options.rate * grad / np.sqrt(1 + grad * grad)
        assert np.allclose(got.values, want.values, rtol=1e-4, atol=1e-4)


def test_groups_are_answered_with_numbers_alone(spark):
    """One number per key of the group, by key, in which keys are not sent back: bytes that are not 0 are few."""
    rows = rows_of(60)
    texts = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr(
        "cast(coalesce(text, '') as binary) _text", "crc32(cast(cast(doc_id as string) as binary)) % 10 <> 0 train", "cast(doc_id % 4 as int) place"
    )
    counts = lm.count_words(texts.where("train"), OPTIONS, 2)
    out = lm.count_features(texts, spark.sparkContext.broadcast(tuple(counts)), OPTIONS, 4, 3, keys=False).collect()
    frequent, number, seen = set(counts.frequent.tolist()), collections.Counter(), collections.defaultdict(set)
    for d, ts in tokens_of(rows):
        ts = np.array(ts, np.uint64)
        keys = [*lm.pair_keys(ts[:-1], ts[1:]).tolist(), *(t for t in ts[1:].tolist() if t not in frequent)]
        seen[d % 4] |= set(keys)
        if not held(d):
            number.update(keys)
    assert sum(r["n"] for r in out) == len(number)
    for place in range(4):
        blocks = [bytes(r["block"]) for r in out if r["place"] == place]
        assert lm.unpack_numbers(blocks).tolist() == [number[k] for k in sorted(seen[place])]
        assert sum(len(x) - x[8:].count(0) for x in blocks) <= len(seen[place]) + 8 * len(blocks)


def test_scores_are_smoothed_pair_counts(spark):
    """Without learning all bins are as likely, so scores follow from counts; texts longer than a batch and equal rows too."""
    rows = rows_of(150)
    found = lm.score_documents(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), OPTIONS).collect()
    texts = [(d, [int(t) for t in ts]) for d, ts in tokens_of(rows)]
    word = collections.Counter(t for d, ts in texts if not held(d) for t in ts[1:])
    pair = collections.Counter(p for d, ts in texts if not held(d) for p in zip(ts, ts[1:]))
    word[int(lm.START)] = word[int(lm.END)]
    distinct = {t for t in word if t != int(lm.START)}
    tokens, kinds = collections.Counter(), collections.Counter()
    for t in distinct:
        tokens[t >> 56] += word[t]
        kinds[t >> 56] += 1
    weight = max(1.0, len(pair) / len(distinct))

    def chance(a, b):
        prior = (word[b] + 0.1) / (tokens[b >> 56] + 0.1 * (kinds[b >> 56] + 1)) / lm.BINS
        return math.log10((pair[a, b] + weight * prior) / (word[a] + weight))

    want = sorted((d, len(ts) - 1, sum(word[t] > 0 for t in ts[1:]), sum(chance(a, b) for a, b in zip(ts, ts[1:]))) for d, ts in texts)
    found = sorted((r["doc_id"], r["n_tokens"], r["n_known"], r["score"]) for r in found)
    assert [f[:3] for f in found] == [w[:3] for w in want]
    assert np.allclose([f[3] for f in found], [w[3] for w in want], rtol=1e-5)
