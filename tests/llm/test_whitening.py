"""Whitening against exact sums in Python and numpy's eigenvectors."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tandem.llm import whitening
from tandem.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def table(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in enumerate(vectors)], SCHEMA)


def brute(rows):
    """{id: (deviation, whitened)}, explained; whitened up to the components' signs."""
    kept = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in kept]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    centred = np.array([[(n * a - s) / n for a, s in zip(v, sums, strict=True)] for v in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    z = centred @ vectors[:, :8] / np.sqrt(values[:8])
    deviation = [sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True)) for v in x]
    return {i: (dev, w) for (i, _), dev, w in zip(kept, deviation, z, strict=True)}, values / values.sum()


def check(df):
    want, explained = brute([(r["vec_id"], r["embedding"]) for r in df.collect()])
    got = whitening.whiten(df).collect()
    assert {(r["vec_id"], r["component"]) for r in got} == {(i, k) for i in want for k in range(1, 9)}
    assert len(got) == 8 * len(want)
    signs = {}
    for r in got:
        deviation, z = want[r["vec_id"]]
        k = r["component"] - 1
        assert r["n"] == len(want) and r["deviation"] == deviation and r["identity_error"] < 1e-9
        assert r["explained"] == pytest.approx(explained[k], rel=1e-9)
        assert abs(r["whitened"]) == pytest.approx(abs(z[k]), abs=1e-6)
        if abs(z[k]) > 1e-3:
            signs.setdefault(k, set()).add(np.sign(z[k]) == np.sign(r["whitened"]))
    assert all(len(s) == 1 for s in signs.values())


def test_query_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    check(spark.read.parquet(f"{sf}/embeddings.parquet"))
    got = QUERIES["op12_embedding_whitening"](spark, sf)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "int", "bigint", "bigint", "double", "double", "double"]


def test_unusable_and_repeated_vectors(spark):
    rnd = np.random.default_rng(3)
    good = [*rnd.normal(size=(40, 10)).tolist()]
    bad = [None, [], [1.0] * 9 + [None], [1.0] * 9 + [float("nan")], [float("inf")] + [0.0] * 9, [1.0] * 4]
    df = table(spark, good + good[:3] + bad)
    wider = df.withColumn("id", F.lit("x")).withColumn("z", F.lit(1)).withColumn("component", F.lit(7)).withColumn("n", F.lit(0))
    got, plain = (sorted(map(str, whitening.whiten(d).collect())) for d in (wider, df))
    assert got == plain and len(plain) == 43 * 8
    check(df.where(F.size("embedding") == 10))
    twice = df.withColumn("vec_id", F.lit(None).cast("bigint"))
    assert whitening.whiten(twice).where("vec_id is null").count() == 43 * 8


def test_components_without_variance(spark):
    """Three dimensions vary, two of them alike: two components, the rest have no variance and no whitened value."""
    rnd = np.random.default_rng(4)
    rows = [[a, a, b, *[0.25] * 7] for a, b in rnd.normal(size=(30, 2)).tolist()]
    got = whitening.whiten(table(spark, rows)).collect()
    assert {r["component"] for r in got if r["whitened"] is None} == {3, 4, 5, 6, 7, 8}
    assert {r["explained"] for r in got if r["component"] > 2} == {0.0} and got[0]["identity_error"] < 1e-9
    same = whitening.whiten(table(spark, [[1.0, 2.0]] * 5)).collect()
    assert [(r["component"], r["deviation"], r["whitened"], r["explained"]) for r in same[:2]] == [(1, 0, None, None), (2, 0, None, None)]


def test_equal_eigenvalues(spark):
    """Points on all half axes: every direction has the same variance, exactly. Whitened rows have the identity as covariance."""
    axes = np.eye(9)
    got = whitening.whiten(table(spark, [*axes.tolist(), *(-axes).tolist()]))
    rows = got.collect()
    assert len(rows) == 18 * 8 and max(r["identity_error"] for r in rows) < 1e-12
    assert all(r["explained"] == pytest.approx(1 / 9) for r in rows)


def test_huge_entries(spark):
    got = whitening.whiten(table(spark, [[3e38, 1.0], [-3e38, 2.0], [1e9, 3.0]])).collect()
    assert len(got) == 6 and all(r["deviation"] is None or r["deviation"] >= 0 for r in got) and got[0]["identity_error"] < 1e-4


def test_no_rows(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whiten(table(spark, [None, []])).collect() == []


def test_sums_are_exact_beyond_doubles():
    a = np.array([[2**51, 3], [2**51 - 1, 5], [7, 2**50]], np.int64)
    exact = [[sum(int(r[i]) * int(r[j]) for r in a) for j in range(2)] for i in range(2)]
    assert whitening.products(a, a).tolist() == exact


def test_polynomial_and_roots(spark):
    """Integer eigenvalues, double ones among them, are found exactly."""
    rnd = np.random.default_rng(5)
    poly = [1]
    for root in (0, 0, 3, 3, 3, 10**12, 10**12 + 1, 7):
        poly = [(poly[k - 1] if k else 0) - root * (poly[k] if k < len(poly) else 0) for k in range(len(poly) + 1)]
    assert [r >> whitening.ROOT_BITS for r in whitening.largest_roots(poly, 8)] == [10**12 + 1, 10**12, 7, 3, 3, 3, 0, 0]
    m = rnd.integers(-50, 50, (12, 7))
    a = (m.T @ m).tolist()
    got = whitening.polynomial_of(spark, a)
    assert np.allclose(np.array(got[::-1], float), np.poly(np.array(a, float)), rtol=1e-8)
    assert sum(a[i][i] for i in range(7)) == -got[6]


def test_close_eigenvalues_keep_their_vectors():
    """A relative gap of 10^-16, which doubles can't see."""
    d, gap = 4, 10**16
    a = [[0] * d for _ in range(d)]
    for i, v in enumerate((gap + 1, gap, 5, 3)):
        a[i][i] = v
    vectors = whitening.null_vectors(a, [v << whitening.ROOT_BITS for v in (gap + 1, gap, 5, 3)])
    assert np.allclose([[v / 2**whitening.VECTOR_BITS for v in row] for row in vectors], np.eye(d), atol=1e-12)
