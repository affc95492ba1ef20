"""Quality rules and URL filters."""

import random

import brute
import numpy as np
from pyspark.sql import functions as F

from tandem.llm import quality, urls
from tandem.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_counts(edges, clashing, nothing):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    rows = [(r["doc_id"], *brute.text_counts(r["text"])) for r in edges.collect()]
    order = lambda x: sorted(x, key=lambda r: tuple((v is None, v) for v in r))
    for docs in (edges, clashing):
        judged = quality.judge(docs)
        assert order(tuple(r[n] for n in ("doc_id", *names)) for r in judged.collect()) == order(rows)
        for r in judged.collect():
            assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
            assert not (r["base_failed"] and r["kept"])
    assert not quality.judge(nothing).collect() and not quality.reject(nothing).collect()


def test_limits_follow_the_group(spark):
    """In a group where symbols are common they are no fault; elsewhere they are. Small groups use the language's sketch."""
    rnd = random.Random(1)
    rows, n = [], 0
    for source, marks, size in (("code", 12, 300), ("prose", 0, 300), ("tiny", 0, 4)):
        for _ in range(size):
            text = " ".join(f"word{rnd.randrange(9999)}{rnd.choice('abc')}" for _ in range(60)) + " " + "| " * rnd.randrange(marks + 1)
            rows.append((n, text, "en", source, 1))
            n += 1
    bad = " ".join(f"word{i} | # $ %" for i in range(40))
    rows += [(n, bad, "en", "prose", 1), (n + 1, bad, "en", "tiny", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    dropped = {r["doc_id"] for r in quality.judge(docs).where("not kept").collect()}
    assert dropped == {n, n + 1}
    assert {r["doc_id"] for r in quality.reject(docs).collect()} == set(range(n))


def test_fences_are_near_exact_quantiles(spark):
    rnd = random.Random(3)
    values = [rnd.random() ** 3 for _ in range(5000)]
    rows = [("en", "s", 1000, 1000, round(v * 1000), 10, 0, 0) for v in values]
    counts = spark.createDataFrame(rows, "lang string, source string, n_words bigint, word_chars bigint, n_symbols bigint, n_lines bigint, n_dup_lines bigint, n_repeat_words bigint")
    limits = quality.Limits(slack=tuple((n, -9.0) for n in ("symbols", "dup_lines", "repeats", "long_words", "short_words")))
    found = quality.fences(quality.sketches(counts, limits), limits).first()["max_symbols"]
    middle, high = np.quantile(np.round(np.array(values) * 1000) / 1000, [0.5, 0.9], method="inverted_cdf")
    assert abs(found - (high + 4 * (high - middle))) < 0.06 * found
    # Sketches of parts, merged, are the sketch of the whole.
    halves = [quality.sketches(counts.where(f"n_symbols % 2 = {i}"), limits) for i in (0, 1)]
    merged = halves[0].unionByName(halves[1]).groupBy("lang", "source", "measure", "cell").agg(F.sum("n").alias("n"))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, quality.sketches(counts, limits).collect()))


def test_registered_quality_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op9_quality_rules"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute.text_counts(docs[r["doc_id"]])


URLS = [
    None, "", "no scheme", "://", "http://", "http://com", "http://COM/", "https://Example.com/en/x?y=/en/", "http://www.EXAMPLE.com/en/", "http://a.www.example.com/en/1#f",
    "http://notexample.com/en/", "http://example.com/en", "http://x.net/es/a", "http://net/fr/", "ftp://a.net/de/", "http://a.b/c://d.com/", "http://com.net/es/?q", "http://.com/",
    "http://a..com/x", "http://example.com:80/en/", "HTTP://example.com#/en/", "http://exa\nmple.com/en/\n", "http://ÄÖ.com/É", "http://" + "a." * 5000 + "com/" + "x" * 50_000,
]


def test_judge_urls(spark):
    pages = spark.createDataFrame([(i, u, "x", 1) for i, u in enumerate(URLS * 2)], "page_id bigint, url string, host string, key int")
    found = urls.judge_urls(pages, urls.standard_rules(spark)).collect()
    assert len(found) == 2 * len(URLS)
    for r in found:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute.judged(r["url"])
    empty = urls.judge_urls(pages.limit(0), urls.standard_rules(spark))
    assert not empty.collect() and {"page_id", "host", "path", "rule", "verdict"} <= set(empty.columns)
    none = urls.judge_urls(pages, urls.standard_rules(spark).limit(0)).collect()
    assert {(r["rule"], r["verdict"]) for r in none} == {(None, "allow")}


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(6000).select(F.concat(F.lit("k"), F.col("id")).alias("key"))
    listed = universe.where(F.xxhash64("key") % 3 == 0)
    cascade = urls.Cascade.build(listed, universe)
    assert len(cascade.levels) > 1
    found = universe.where(cascade.member(F.col("key")))
    assert {r["key"] for r in found.collect()} == {r["key"] for r in listed.collect()}
    assert not urls.Cascade.build(listed.limit(0), universe).levels


def test_url_plan_is_native(spark):
    plan = QUERIES["op10_url_filters"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Join"))
    assert "op10_url_filters" in ORACLE
