import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tandem.functions import records as rec
from tandem.operators import pairs, ranking, sampling, split
from tandem.settings import Rules
from tandem.workspace import settle

SCHEMA = "source_rank int, doc_id bigint, domain string, en string, es string"
ORDER = ["source_rank", "doc_id"]


def words(n, tag="w"):
    return " ".join(f"{tag}{i}" for i in range(n))


@pytest.mark.parametrize(
    "n_en, n_es, valid",
    [(10, 8, True), (1, 5, False), (5, 1, False), (250, 200, False), (200, 250, False), (100, 10, False), (20, 10, True),
     (3, 3, True), (200, 200, True), (5, 2, False), (10, 4, True), (4, 10, True), (11, 4, False), (4, 11, False)],
)
def test_validity(spark, n_en, n_es, valid):
    df = spark.createDataFrame([(0, 1, "medical", words(n_en), words(n_es))], SCHEMA)
    assert (pairs.valid_pairs(df).count() == 1) is valid
    reason = pairs.reject_reasons(df).first()["reason"]
    assert (reason == "valid") is valid


def test_first_source_wins_and_invalid_pairs_do_not_block(spark):
    rows = [
        (1, 0, "legal", "one two three", "uno dos tres"),
        (0, 7, "medical", "one two three", "uno dos tres"),
        (0, 3, "medical", " one  two three", "uno dos tres"),
        (0, 9, "medical", "one two threeuno", "dos tres cuatro"),
        (1, 1, "legal", "one two three uno", "dos tres cuatro"),
        (0, 1, "medical", "a b", "c d e"),
        (1, 2, "legal", "a b c", "d e"),
        (1, 3, "legal", "", "x y z"),
        (1, 4, "legal", None, "x y z"),
    ]
    kept = pairs.dedup_pairs(pairs.valid_pairs(pairs.clean_pairs(spark.createDataFrame(rows, SCHEMA))), ORDER)
    got = {(row["source_rank"], row["doc_id"], row["en"], row["es"], row["n_en"], row["domain"]) for row in kept.collect()}
    assert got == {
        (0, 3, "one two three", "uno dos tres", 3, "medical"),
        (0, 9, "one two threeuno", "dos tres cuatro", 3, "medical"),
        (1, 1, "one two three uno", "dos tres cuatro", 4, "legal"),
    }


def test_same_concatenation_is_one_key(spark):
    rows = [(0, 1, "medical", "a b cd", "e f g"), (0, 2, "medical", "a b c", "de f g")]
    kept = pairs.dedup_pairs(pairs.valid_pairs(spark.createDataFrame(rows, SCHEMA)), ORDER).collect()
    assert [(row["en"], row["es"]) for row in kept] == [("a b cd", "e f g")]


def test_dedup_with_many_copies_is_idempotent(spark):
    copies = spark.range(20_000).select(
        F.lit(0).alias("source_rank"), F.col("id").alias("doc_id"), F.lit("medical").alias("domain"),
        F.when(F.col("id") % 3 > 0, "x y z").otherwise(F.concat(F.lit("x y z"), F.col("id").cast("string"))).alias("en"),
        F.lit("u v w").alias("es"),
    )
    once = pairs.dedup_pairs(copies, ORDER)
    assert once.count() == 1 + 6667
    assert once.where("en = 'x y z'").first()["doc_id"] == 1
    again = pairs.dedup_pairs(once.select(*copies.columns), ORDER)
    assert again.exceptAll(once.select(*again.columns)).count() == 0


def test_both_directions(spark):
    df = spark.createDataFrame([(0, 1, "legal", "Court case opens today", "El caso abre hoy en Court")], SCHEMA)
    rows = pairs.preprocess(df, ORDER).orderBy("direction").collect()
    assert [(r["direction"], r["input"], r["output"], r["n_in"], r["n_out"]) for r in rows] == [
        ("en_to_es", "Court case opens today", "El caso abre hoy en Court", 4, 6),
        ("es_to_en", "El caso abre hoy en Court", "Court case opens today", 6, 4),
    ]
    assert rows[0]["instruction"] == "Translate the following legal sentence from English to Spanish."
    assert rows[1]["instruction"] == "Translate the following legal sentence from Spanish to English."


def test_prompts(column):
    prompt = rec.render_prompt(F.lit("do"), F.col("x"), F.lit("out"))
    assert column(prompt, ["in"]) == ["### Instruction:\ndo\n\n### Input:\nin\n\n### Response:\nout"]
    assert column(rec.render_prompt(F.lit("do"), F.col("x")), ["in"])[0].endswith("### Response:\n")


SIZES = {1: (0, 0, 1), 2: (1, 0, 1), 3: (2, 1, 0), 4: (3, 1, 0), 5: (4, 1, 0), 9: (7, 1, 1), 10: (8, 1, 1), 11: (8, 1, 2),
         15: (12, 1, 2), 20: (16, 2, 2), 1000: (800, 100, 100)}


def expected_sizes(g):
    train = g * 4 // 5
    val = train + g // 10
    if g >= 3:
        train = max(train, 1)
        val = max(val, train + 1)
    return train, val - train, g - val


def test_split_sizes(column):
    sizes = [*SIZES, *range(1, 3000, 7), 2_999_999]
    train, val = split.split_sizes(F.col("x"), Rules().ratios)
    got = column(F.array(train, val), sizes, "x bigint")
    assert [(t, v - t, g - v) for g, (t, v) in zip(sizes, got)] == [expected_sizes(g) for g in sizes]
    assert all(expected_sizes(g) == want for g, want in SIZES.items())


def make_records(spark, groups, copies=False, partitions=3):
    """`groups` maps (domain, direction, bucket) to a size."""
    rows, n = [], 0
    for (domain, direction, bucket), size in groups.items():
        for i in range(size):
            text = "same text here" if copies and i % 3 else f"text {domain} {i}"
            rows.append((n, domain, direction, bucket, text, "out"))
            n += 1
    schema = "row_no bigint, domain string, direction string, bucket string, input string, output string"
    return spark.createDataFrame(rows, schema).repartition(partitions)


def counts(df):
    rows = df.groupBy("domain", "direction", "bucket", "split").count().collect()
    return {(r["domain"], r["direction"], r["bucket"], r["split"]): r["count"] for r in rows}


def check_sizes(df, groups):
    got = counts(df)
    for group, size in groups.items():
        sizes = tuple(got.get((*group, name), 0) for name in ("train", "val", "test"))
        assert sizes == expected_sizes(size), group


GROUPS = {("medical", "en_to_es", "short_sents"): 1000, ("legal", "es_to_en", "long_sents"): 11,
          ("legal", "en_to_es", "mid_sents"): 2, ("medical", "es_to_en", "mid_sents"): 1}


@pytest.mark.parametrize("copies", [False, True])
def test_split_is_exact_and_reproducible(spark, copies):
    first = split.stratified_split(make_records(spark, GROUPS, copies), ["row_no"]).cache()
    check_sizes(first, GROUPS)
    again = split.stratified_split(make_records(spark, GROUPS, copies, partitions=7), ["row_no"])
    assert first.select("row_no", "split").exceptAll(again.select("row_no", "split")).count() == 0
    other = split.stratified_split(make_records(spark, GROUPS, copies), ["row_no"], Rules(seed=7))
    assert first.select("row_no", "split").exceptAll(other.select("row_no", "split")).count() > 0


def test_split_is_the_rank_in_the_stratum(spark):
    got = split.stratified_split(make_records(spark, GROUPS, copies=True), ["row_no"])
    ranked = got.selectExpr(
        "split", "row_number() over (partition by domain, direction, bucket order by shuffle_key) rn", "domain", "direction", "bucket"
    )
    for row in ranked.collect():
        train, val, _ = expected_sizes(GROUPS[(row["domain"], row["direction"], row["bucket"])])
        want = "train" if row["rn"] <= train else "val" if row["rn"] <= train + val else "test"
        assert row["split"] == want


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.sampled_from(list(GROUPS)), st.integers(1, 60), min_size=1), st.booleans())
def test_split_sizes_for_any_group(spark, groups, copies):
    check_sizes(split.stratified_split(make_records(spark, groups, copies), ["row_no"]), groups)


def test_cuts_are_right_without_broadcasts(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        check_sizes(split.stratified_split(make_records(spark, GROUPS, copies=True), ["row_no"]), GROUPS)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def hashed(spark, n):
    """n rows in two groups; a third of each are copies that share the first half of the key, five rows share a whole key."""
    content = "if(id % 3 = 0, 'copy', cast(id as string))"
    return spark.range(n, numPartitions=4).selectExpr(
        "id", "if(id % 10 < 9, 'hot', null) g", f"if(id < 5, repeat('0', 64), concat(md5({content}), md5(cast(id as string)))) shuffle_key"
    )


@pytest.mark.parametrize("last_rows", [8, 65_536])
def test_cut_points_among_copies(spark, monkeypatch, last_rows):
    """The located keys are those at the targets, however many rounds it takes."""
    monkeypatch.setattr(ranking, "LAST_ROWS", last_rows)
    rows = hashed(spark, 3000).select(F.struct("g").alias("group"), F.col("shuffle_key").alias("key"))
    targets = (0, 1, 3, 150, 1000, 2699)
    ends = lambda size: F.array(*(F.struct(F.lit(t).cast("string").alias("cut"), F.least(F.lit(t).cast("bigint"), size).alias("target")) for t in targets))
    got = {(r["group"]["g"], int(r["cut"])): (r["key"], r["before"]) for r in ranking.locate(rows, ends).collect()}
    keys = {g: sorted(r["key"] for r in rows.where(F.col("group.g").eqNullSafe(F.lit(g))).collect()) for g in ("hot", None)}
    want = {(g, t): (k := keys[g][min(t, len(keys[g])) - 1], keys[g].index(k)) for g in keys for t in targets if t}
    assert got == want


def test_heads_of_a_million_rows(spark):
    """The rows that pass to the last step are the heads themselves; groups, null ones too, and equal keys are cut exactly."""
    df = settle(hashed(spark, 1_000_000), "million")
    assert ranking.up_to_cut(df, ["g"], "shuffle_key", 500).count() == 1000
    got = [r["id"] for r in sampling.head_sample(df, ["shuffle_key", "id"], 700).collect()]
    assert got == [r["id"] for r in df.orderBy("shuffle_key", "id").limit(700).collect()]
    heads = sampling.head_per_group(df, ["g"], ["shuffle_key", "id"], 3)
    plain = df.selectExpr("*", "row_number() over (partition by g order by shuffle_key, id) n").where("n <= 3").drop("n")
    assert sorted(map(str, heads.collect())) == sorted(map(str, plain.collect()))
    assert sampling.head_sample(df.limit(0), ["shuffle_key"], 5).count() == 0 and sampling.head_sample(df, ["shuffle_key"], 0).count() == 0


def test_missing_domain_is_its_own_stratum(spark):
    df = make_records(spark, {("medical", "en_to_es", "mid_sents"): 40}).withColumn("domain", F.lit(None).cast("string"))
    got = {r["split"]: r["count"] for r in split.stratified_split(df, ["row_no"]).groupBy("split").count().collect()}
    assert got == {"train": 32, "val": 4, "test": 4}


def test_ratios_must_sum_to_one(spark):
    with pytest.raises(ValueError):
        split.stratified_split(make_records(spark, GROUPS), ["row_no"], Rules(ratios=(0.8, 0.1, 0.2)))


def test_leakage(spark):
    rows = [("train", "a", "b"), ("test", "b", "a"), ("test", "a", "b"), ("val", "c", "d"), ("test", "c", "d"), ("train", "e", "f")]
    got = split.split_leakage(spark.createDataFrame(rows, "split string, input string, output string")).collect()
    assert {(r["split"], r["records"], r["in_train"]) for r in got} == {("val", 1, 0), ("test", 3, 2)}
