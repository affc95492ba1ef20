"""The pipeline against plain versions of its stages."""

import brute
import pytest
from conftest import SCHEMA, edge_rows
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from tandem.llm import decontaminate, mixing, pii, quality

SF = "/root/testdata/sf0.001"


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is None, str(x)) for x in r))


def plain_copies(rows):
    """The groups of near copies, each as the set of (id, text) that may stay: those with the smallest id, null ids last."""
    rows = sorted({(r[0], r[1]) for r in rows}, key=str)
    found = brute.similar([(k, r[1]) for k, r in enumerate(rows)], 5, 80)
    groups = {}
    for (k, _, low), r in zip(found, rows, strict=True):
        groups.setdefault(low, []).append(r)
    least = lambda g: min((r[0] is None, r[0]) for r in g)
    return [{r for r in g if (r[0] is None, r[0]) == least(g)} for g in groups.values()]


def check_copies(found, rows):
    groups, found = plain_copies(rows), [tuple(r) for r in found.select("doc_id", "text").collect()]
    assert len(found) == len(groups) and all(sum(r in g for r in found) == 1 for g in groups)


@pytest.mark.parametrize("extra", [False, True])
def test_near_copies(spark, edges, clashing, extra):
    docs = clashing if extra else edges
    found = pipeline.near_copies(spark, docs, SF)
    assert found.columns == docs.columns
    check_copies(found, edge_rows())


def test_near_copies_with_one_id(spark):
    """An id with several texts, near copies among them and of other ids; null ids with equal and with other texts."""
    text = [f"word{i}" for i in range(80)]
    near = [" ".join([*text[:i], "other", *text[i + 1 :]]) for i in (3, 40, 70)]
    rows = [(5, " ".join(text)), (5, "quite another text"), (3, "quite another text"), (5, near[0]), (5, near[0]), (9, near[1]), (None, near[2])]
    rows += [(None, "without an id"), (None, "without an id"), (None, None), (None, ""), (7, None), (7, ""), (5, "a third text")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
    found = pipeline.near_copies(spark, docs, SF)
    check_copies(found, rows)
    assert [r for r in map(tuple, found.select("doc_id", "text").collect()) if r[1] == "quite another text"] == [(3, "quite another text")]


def test_stages_one_by_one(spark, clashing):
    docs = clashing
    kept = pipeline.quality_rules(spark, docs, SF)
    assert kept.columns == docs.columns
    want = quality.judge(docs, keep=("doc_id", "text")).where("kept").select("doc_id", "text")
    assert order(kept.select("doc_id", "text").collect()) == order(want.collect())

    clean = pipeline.benchmark_passages(spark, docs, SF)
    assert clean.columns == docs.columns and clean.count() == docs.count()

    private = pipeline.personal_data(spark, docs, SF)
    assert private.columns == docs.columns and private.count() == docs.count()
    for r in private.collect():
        assert not brute.personal(r["text"])
        assert r["n_chars"] is None or r["text"] is None or r["n_chars"] == len(r["text"])


def test_empty_table(spark, nothing):
    for _, stage in pipeline.STAGES:
        found = stage(spark, nothing, SF)
        assert not found.collect() and set(found.columns) >= set(nothing.columns)


def test_run(spark):
    """All rows of run() from a plain chain of the stages."""
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    table = lambda rows: spark.createDataFrame(rows, SCHEMA)
    verdict = {r["doc_id"]: r["kept"] for r in quality.judge(table(docs)).collect()}
    rows = [r for r in docs if verdict[r[0]]]
    low = brute.similar([r[:2] for r in rows], 5, 80)
    rows = [r for r, (i, _, first) in zip(rows, low, strict=True) if i == first]
    items = [decontaminate.normal(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [r for r in rows if not any(t in decontaminate.normal(r[1]) for t in items)]
    model = pii.train(pii.label_sample(table(rows)))
    spans = {r["doc_id"]: r["spans"] for r in pii.find(table(rows), model, ("doc_id",)).collect()}
    rows = [(r[0], new := pii.redact(r[1], spans[r[0]]), *r[2:4], len(new)) for r in rows]
    want = mixing.mix(table(rows), prefix="mix_")
    found = pipeline.run(spark, SF)
    names = ("doc_id", "text", "lang", "source", "n_chars", "mix_topic", "mix_n_tokens")
    assert order(found.select(*names).collect()) == order(want.select(*names).collect())
    assert found.count() > 20
    weights = found.groupBy().agg(F.sum(F.col("mix_n_tokens") * F.col("mix_weight"))).first()[0]
    assert weights > 0
    assert not found.where("text rlike '@[a-z0-9-]+[.]'").count()
    assert pipeline.ORACLE_SQL is None and len(pipeline.STAGES) == 5
