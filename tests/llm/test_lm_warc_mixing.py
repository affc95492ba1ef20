"""Language model, archives and mixing."""

import collections
import gzip
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tandem.llm import lm, mixing, warc
from tandem.llm.queries import QUERIES
from tandem.workspace import fresh_path

SF = "/root/testdata/sf0.001"


def held(doc):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % 10 == 0


def unigrams(rows):
    """(id, held out, tokens, known, N, base score) per row."""
    texts = [(d, [*(t or "").encode().lower().split(), None]) for d, t in rows]
    count = collections.Counter(w for d, ws in texts if not held(d) for w in ws)
    n = sum(count.values())
    return [(d, held(d), len(ws), sum(count[w] > 0 for w in ws), n, sum(math.log10((count[w] + 0.1) / (n + 0.1 * (len(count) + 1))) for w in ws)) for d, ws in texts]


def check_scores(found, rows):
    key = lambda r: (r[0] is None, r[0], r[2], r[5])
    found = sorted((tuple(r) for r in found), key=key)
    want = sorted(unigrams(rows), key=key)
    assert [f[:5] for f in found] == [w[:5] for w in want]
    assert np.allclose([f[5] for f in found], [w[5] for w in want], rtol=1e-9)
    assert all(math.isfinite(f[6]) and f[6] < 0 for f in found)


@pytest.mark.parametrize("frequent", [1 << 18, 64])
def test_scores(edges, frequent):
    rows = [(r["doc_id"], r["text"]) for r in edges.collect()]
    check_scores(lm.score_documents(edges, lm.Options(frequent=frequent)).collect(), rows)


def test_scores_of_clashing_and_empty_tables(clashing, nothing, edges):
    check_scores(lm.score_documents(clashing).collect(), [(r["doc_id"], r["text"]) for r in edges.collect()])
    assert not lm.score_documents(nothing).collect()


def test_registered_scores(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check_scores(QUERIES["op7_lm_scoring"](spark, SF).collect(), rows)
    # Learning needs more text than that.
    out = QUERIES["op7_lm_scoring"](spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_model_is_a_distribution():
    """Over all bins, the chances given one history add up to 1; so do those of a bin's words and one unknown word."""
    options = lm.Options()
    rng = np.random.default_rng(1)
    weights = lm.Weights(options, rng.normal(size=lm.Weights(options).values.shape).astype(np.float32) * 0.3)
    last, bins = rng.integers(1, 2**63, 2, dtype=np.uint64), np.arange(lm.BINS, dtype=np.uint64) << np.uint64(56)
    tokens = np.concatenate([[last[0], last[1], b] for b in bins]).astype(np.uint64)
    found = weights.log_chances(tokens, np.arange(0, len(tokens), 3))[2::3]
    assert abs(np.exp(found.astype(np.float64)).sum() - 1) < 1e-4


def test_learning_uses_history(spark):
    """A language in which each word fixes the next one: the model gets far below the unigram scores."""
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(400):
        at, text = rnd.randrange(120), []
        for _ in range(200):
            text.append(words[at])
            at = (at * 7 + 3) % 120 if rnd.random() < 0.95 else rnd.randrange(120)
        rows.append((i, " ".join(text)))
    found = lm.score_documents(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2), lm.Options(batch=2048, rounds=3)).where("held_out").collect()
    assert len(found) > 20
    assert sum(r["score"] for r in found) > 0.8 * sum(r["base_score"] for r in found)


HOSTILE = "x" * 900 + "\r\n\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


def pages(spark):
    big, long = "<p>" + "a" * 1000, "é" * 3_000_000
    rows = [(1, "http://a/", big), (7, "http://b/", big), (3, None, big), (4, "http://c\r\nX: y", "small"), (5, "u", "small"), (6, "u", None), (8, "", "")]
    rows += [(9, "h", HOSTILE), (10, "h", HOSTILE), (11, "l", long), (12, "l", long), (None, "n", big), (None, "n", "only" * 400), (7, "http://b/", big)]
    rows += [(100 + i, "g", "group" * 300) for i in range(50)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string"), rows


def test_archives_round_trip(spark):
    table, rows = pages(spark)
    plain, fresh = fresh_path(spark, "warc"), fresh_path(spark, "warc")
    warc.write_archives(warc.as_responses(table), plain)
    order = lambda x: sorted(x, key=lambda r: tuple((v is None, v) for v in r))
    back = [(r["page_id"], bytes(r["payload"]).decode(), r["record_type"]) for r in warc.read_archives(spark, plain).collect()]
    assert order(back) == order((i, h or "", "response") for i, _, h in rows)

    warc.deduplicate(spark, plain, fresh)
    best = {}
    for i, _, h in rows:
        if i is not None:
            best[h or ""] = max(best.get(h or "", i), i)
    want = []
    for i, _, h in rows:
        raw = (h or "").encode()
        again = len(raw) >= 1000 and best.get(h) is not None and i != best[h]
        want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", best[h] if again else None))
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert order(tuple(r[n] for n in names) for r in warc.read_archives(spark, fresh).collect()) == order(want)
    # A second pass changes nothing, and revisits hold no payload.
    again = fresh_path(spark, "warc")
    warc.deduplicate(spark, fresh, again)
    rows_again = warc.read_archives(spark, again)
    assert order(tuple(r[n] for n in names) for r in rows_again.collect()) == order(want)
    assert not rows_again.where("record_type = 'revisit' and octet_length(payload) > 0").count()


def test_parse_joined_members_and_damage():
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    for content in (record * 3, gzip.compress(record) * 3, gzip.compress(record * 3)):
        assert [(h["warc-type"], b) for h, b in warc.parse(content)] == [("response", b"hi")] * 3
    assert not list(warc.parse(b""))
    for damaged in (record[:-6], record[:30], b"HTTP" + record):
        with pytest.raises(ValueError):
            list(warc.parse(damaged))


def test_no_pages(spark):
    plain, fresh = fresh_path(spark, "warc"), fresh_path(spark, "warc")
    warc.write_archives(warc.as_responses(pages(spark)[0].limit(0)), plain)
    warc.deduplicate(spark, plain, fresh)
    assert not warc.read_archives(spark, fresh).collect()


def test_rake_meets_all_margins():
    rng = np.random.default_rng(4)
    tokens = rng.integers(1, 1000, (5, 4, 3)).astype(float)
    tokens[1, 2] = 0
    targets = [rng.dirichlet(np.ones(n)) for n in tokens.shape]
    shares = mixing.rake(tokens, targets, 2000, 1e-12)
    for axis, target in enumerate(targets):
        assert np.allclose(shares.sum(axis=tuple(a for a in range(3) if a != axis)), target, atol=1e-8)
    assert (shares[tokens == 0] == 0).all()
    # The fit keeps the table's odds ratios.
    ratio = lambda t: t[0, 0, 0] * t[4, 1, 2] / (t[0, 1, 2] * t[4, 0, 0]) * 1.0
    flat = mixing.rake(tokens[:, :, :1] + 1, [targets[0], targets[1], np.ones(1)], 2000, 1e-12)
    odds = lambda t: t[0, 0, 0] * t[4, 1, 0] / (t[0, 1, 0] * t[4, 0, 0])
    assert ratio is not None and math.isclose(odds(flat), odds(tokens[:, :, :1] + 1), rel_tol=1e-6)


def test_calibrate():
    tokens, shares = np.array([100.0, 900.0, 0.0, 50.0]), np.array([0.5, 0.5, 0.0, 0.0])
    chance, weight = mixing.calibrate(tokens, shares, 0.4)
    assert math.isclose((chance * tokens).sum(), 0.4 * 1050, rel_tol=1e-6) and chance.max() <= 1 and chance[2] == chance[3] == 0
    weighted = chance * weight * tokens
    assert np.allclose(weighted / weighted.sum(), shares)
    assert not mixing.calibrate(np.zeros(2), np.zeros(2), 0.5)[0].any()


def test_mix(spark, edges, clashing, nothing):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(5)).collect()
    assert {r["doc_id"] for r in found} == {r["doc_id"] for r in again}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(r["n_tokens"] == len(texts[r["doc_id"]].encode().split()) and 0 < r["probability"] <= 1 <= r["weight"] + 1e-9 for r in found)
    # Expected weighted tokens of each margin are its target.
    cells = docs.select(*(mixing.folded(mixing.topic_of(F.col("text")) if d == "topic" else F.col(d), getattr(mixing.STANDARD, d)).alias(d) for d in mixing.DIMENSIONS), mixing.token_weight(F.col("text")).alias("n")).groupBy(*mixing.DIMENSIONS).agg(F.sum("n").alias("n")).collect()
    assert sum(r["n"] for r in cells) == sum(len(t.encode().split()) for t in texts.values())
    sampled = sum(r["n_tokens"] for r in found) / sum(r["n"] for r in cells)
    assert 0.4 < sampled < 0.6
    for rows in (mixing.mix(edges).collect(), mixing.mix(clashing).collect()):
        assert {r["doc_id"] for r in rows} <= {r["doc_id"] for r in edges.collect()}
    assert mixing.mix(clashing).columns.count("topic") == 1
    assert not mixing.mix(nothing).collect()
    assert len(QUERIES["op2_source_mixing"](spark, SF).collect()) > 20


def test_learning_grows_with_the_vocabulary(spark):
    """By the registered options, on held-out text: 4,000 words, each of which mostly fixes the next one. 256 bins cannot
    tell apart the 16 words in each."""
    rnd = random.Random(5)
    rows = []
    for i in range(500):
        at, text = rnd.randrange(4000), []
        for _ in range(200):
            text.append(f"w{at}")
            at = (at * 7 + 3) % 4000 if rnd.random() < 0.95 else rnd.randrange(4000)
        rows.append((i, " ".join(text)))
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = lm.score_documents(table.repartition(3)).collect()
    check_scores(found, rows)
    held_out = [r for r in found if r["held_out"]]
    assert len(held_out) > 30
    assert sum(r["score"] for r in held_out) > 0.4 * sum(r["base_score"] for r in held_out)


def test_pairs_are_counted_exactly_and_once(spark):
    """Counts that reach the groups: of all training texts, whatever the number of groups."""
    rows = [(i, t) for i, t in enumerate(["a b a b", "b a", "a a c", "", "a b"] * 8)]
    tokens = {d: [lm.START, *lm.token_hashes(t.encode(), lm.WordHashes())] for d, t in rows}
    want = collections.Counter(p for d, ts in tokens.items() if not held(d) for p in zip(ts, ts[1:]))
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    options = lm.Options()
    texts = table.selectExpr("cast(text as binary) _text", "crc32(cast(cast(doc_id as string) as binary)) % 10 <> 0 train", "cast(doc_id % 4 as int) place")
    shared = spark.sparkContext.broadcast(lm.count_words(texts.where("train"), options, 2))
    out = lm.count_features(texts, shared, options, 4, 3).collect()
    assert sum(r["n"] for r in out) == len(want)
    for place in range(4):
        got = {}
        for r in out:
            if r["place"] == place:
                keys, number = lm.unpack(bytes(r["block"]), ("u8", "i8"))
                got |= dict(zip(keys.tolist(), number.tolist()))
        inside = {p for d, ts in tokens.items() if d % 4 == place for p in zip(ts, ts[1:])} & set(want)
        key = lambda p: int(lm.pair_keys(np.array([p[0]], np.uint64), np.array([p[1]], np.uint64))[0])
        assert got == {key(p): want[p] for p in inside}
