"""The Jaccard join, connected components and removal of repeated passages against brute force."""

import random

import brute
import numpy as np
import pytest
from conftest import words  # noqa: F401
from pyspark.sql import functions as F

from tandem.llm import jaccard, substrings
from tandem.llm.components import components
from tandem.llm.packed import Outbox, block_of, unpack
from tandem.llm.queries import QUERIES
from tandem.llm.words import WordHashes, covered, split_words, window_hashes

SF = "/root/testdata/sf0.001"


def plain(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80), (1, 50)])
def test_similar_documents(edges, size, percent):
    found = jaccard.similar_documents(edges, jaccard.Join(size, percent))
    assert ordered(map(tuple, found.collect())) == ordered(brute.similar(plain(edges), size, percent))


def test_similar_clashing_and_empty(clashing, edges, nothing):
    assert ordered(map(tuple, jaccard.similar_documents(clashing).collect())) == ordered(brute.similar(plain(edges), 4, 85))
    found = jaccard.similar_documents(nothing)
    assert found.columns == ["doc_id", "n_shingles", "component_id"] and not found.collect()


def test_large_groups_with_partial_links(spark):
    """A crowd of near copies of which only some pairs link, copies of one of them, and a passage that most rows share."""
    rnd = random.Random(9)
    base, shared = [f"b{i}" for i in range(150)], [f"s{i}" for i in range(25)]
    rows = []
    for i in range(320):
        near = list(base)
        for _ in range(rnd.choice([0, 1, 1, 2, 3, 4, 5, 6])):
            near[rnd.randrange(150)] = f"x{rnd.randrange(40)}"
        rows.append((i, " ".join(near)))
    rows += [(1000 + i, rows[7][1]) for i in range(80)]
    rows += [(2000 + i, " ".join([f"u{rnd.randrange(9999)}" for _ in range(rnd.randrange(8, 60))] + shared)) for i in range(200)]
    rows += [(3000 + i, " ".join(shared[: 10 + i % 15])) for i in range(60)]
    rnd.shuffle(rows)
    found = jaccard.similar_documents(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7))
    assert ordered(map(tuple, found.collect())) == ordered(brute.similar(rows, 4, 85))


def test_bounds_hold_for_all_small_sizes():
    join = jaccard.Join()
    for n in range(1, 60):
        for m in range(1, 60):
            for common in range(min(n, m) + 1):
                if 100 * common >= 85 * (n + m - common):
                    assert common >= join.overlap(n, m) and common >= join.least_overlap(n) and m <= join.largest_partner(common, n)
                    assert not join.alone(n) or n == m == common
    # A set counts no token that its partners may leave unsent.
    assert all(join.share(n) <= join.share(join.least_overlap(m)) for m in range(6, 400) for n in range(join.least_overlap(m), m + 1))


def test_components(spark):
    rnd = random.Random(2)
    pairs = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    nodes = {x for a, b in pairs if a != b for x in (a, b)}
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert found == {x: find(x) for x in nodes}
    assert not components(spark.createDataFrame([], "a bigint, b bigint")).collect()


def digests(df):
    return df.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256))


def test_remove_repeats(edges, clashing, nothing):
    want = ordered(brute.without_repeats(plain(edges)))
    assert ordered(map(tuple, digests(substrings.remove_repeats(edges)).collect())) == want
    assert ordered(map(tuple, digests(substrings.remove_repeats(clashing)).collect())) == want
    assert not substrings.remove_repeats(nothing).collect()


def test_repeats_at_all_offsets(spark):
    """One passage at every offset, of just a window's length and one word less, and repeats within a text."""
    rnd = random.Random(4)
    passage = [f"p{i}" for i in range(20)]
    rows = [(i, " ".join([f"f{rnd.randrange(10**6)}" for _ in range(i)] + passage[: 19 + i % 2] + [f"g{rnd.randrange(10**6)}" for _ in range(5)])) for i in range(60)]
    rows += [(100, " ".join(passage * 3)), (101, "again " * 70), (102, "again " * 19)]
    found = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5))
    assert ordered(map(tuple, digests(found).collect())) == ordered(brute.without_repeats(rows))


def test_registered_queries(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert ordered(map(tuple, QUERIES["op1_ngram_jaccard"](spark, SF).collect())) == ordered(brute.similar(plain(docs), 4, 85))
    assert ordered(map(tuple, QUERIES["op8_substring_dedup"](spark, SF).collect())) == ordered(brute.without_repeats(plain(docs)))


def test_cover_takes_any_two_positions_to_anchors():
    for i in range(substrings.PERIOD):
        for j in range(substrings.PERIOD):
            assert any((i + s) % substrings.PERIOD in substrings.COVER and (j + s) % substrings.PERIOD in substrings.COVER for s in range(substrings.PERIOD))


def test_word_helpers():
    assert split_words(b" A\tb\x0bC\x0c\r\nd\x1fe ", lower=True) == [b"a", b"b", b"c", b"d\x1fe"]
    hashes = WordHashes().of([b"a", b"b", b"a", b"b", b"a"])
    found = window_hashes(hashes, 2)
    assert len(found) == 4 and found[0] == found[2] != found[1] == found[3]
    assert not len(window_hashes(hashes, 6))
    assert covered(np.array([0, 3]), 2, 6).tolist() == [True, True, False, True, True, False]


def test_blocks_round_trip():
    rng = np.random.default_rng(0)
    kinds = ("u8", "i8", "u4", "u1", "f8")
    for n in (1, 2, 1000):
        columns = [np.sort(rng.integers(0, 2**64, n, dtype=np.uint64)), rng.integers(-9, 9, n), rng.integers(0, 2**32, n, dtype=np.uint32), rng.integers(0, 2, n).astype(np.uint8), rng.normal(size=n)]
        assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(unpack(block_of(columns), kinds), columns, strict=True))
    box = Outbox(7, ("u8", "i8"), flush=100)
    keys = rng.integers(0, 2**64, 950, dtype=np.uint64)
    batches = [b for i in range(0, 950, 50) for b in box.add(keys[i : i + 50], np.arange(i, i + 50))] + list(box.drain())
    back = [(int(k), int(v)) for b in batches for x in b.column("block").to_pylist() for k, v in zip(*unpack(x, ("u8", "i8")), strict=True)]
    assert sorted(back) == sorted(zip(keys.tolist(), range(950), strict=True))
    for b in batches:
        for bucket, x in zip(b.column("bucket").to_pylist(), b.column("block").to_pylist(), strict=True):
            assert {int(k) * 7 >> 64 for k in unpack(x, ("u8", "i8"))[0]} == {bucket}
