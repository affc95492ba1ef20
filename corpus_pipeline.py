"""Documents to a training corpus: quality rules, near copies, benchmark passages, personal data, source mix.

Each stage takes (spark, docs, sf_dir) and returns the documents it lets through; all but the last return the columns of
documents. Columns beyond those are carried along whatever their names. An empty table passes through every stage.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tandem
from tandem.llm import decontaminate, jaccard, mixing, pii, quality
from tandem.llm.words import bounded_batches
from tandem.workspace import fresh_path, settle

# Python functions travel with their tasks, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(tandem)

#: Near copies: five words to a shingle, and a similarity of 0.8.
NEAR = jaccard.Join(size=5, percent=80)


def packed(docs: DataFrame) -> F.Column:
    """A whole row as one column, so that no column's name can clash."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")


def unpacked(df: DataFrame, docs: DataFrame, **changed) -> DataFrame:
    return df.select(*(changed.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fixed rules or their group's limits reject go; so do those with null or empty text."""
    bounded_batches(spark)
    return quality.reject(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents one stays: that with the smallest id, of equal ids that with the smallest hash of
    its text; a null id counts as larger than all others. Documents without words are linked with nothing and stay. Of
    rows that repeat an id and text one stays, and rows that share an id alone are documents of their own."""
    key = F.xxhash64("doc_id", F.coalesce("text", F.lit("")), F.col("text").isNull())
    keyed = docs.select(packed(docs), key.alias("_key"), F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    found = jaccard.similar_documents(keyed.select("_key", "_text"), NEAR, id="_key", text="_text")
    group = settle(found.groupBy(F.col("_key").alias("_of")).agg(F.first("component_id").alias("_group"), F.count("*").alias("_times")), "groups")
    order = F.struct(F.col("_id").isNull().alias("last"), "_id", "_key")
    ids = keyed.select("_key", "_id").join(group, F.col("_key") == F.col("_of"))
    first = ids.groupBy("_group").agg(F.min(order).alias("_first"), F.min_by("_times", order).alias("_times")).select("_first._key", "_times")
    first = settle(first.withColumnRenamed("_key", "_first"), "first")
    kept = keyed.join(first.hint("shuffle_hash"), F.col("_key") == F.col("_first"))
    repeated = kept.where("_times > 1").dropDuplicates(["_key"])
    return unpacked(kept.where("_times = 1").unionByName(repeated), docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark, up to the edit budget, go."""
    bounded_batches(spark)
    rows = docs.select(packed(docs), F.col("text").alias("_text"))
    found = decontaminate.find_passages(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), ("_row",), text="_text")
    return unpacked(found.where(F.size("regions") == 0), docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each span of personal data is replaced by its kind; n_chars follows the new text."""
    bounded_batches(spark)
    model = pii.train(pii.label_sample(docs))
    found = pii.find(docs.select(packed(docs), F.col("text").alias("_text")), model, ("_row",), text="_text")
    clean = pii.redacted(found.select("_row", F.col("_row").getField("text").alias("_text"), "spans"), "_text")
    length = F.when(F.col("_row").getField("n_chars").isNotNull(), F.length("_text").cast("bigint"))
    return unpacked(clean, docs, text=F.col("_text"), **({"n_chars": length} if "n_chars" in docs.columns else {}))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens follow the target shares, with its probabilities and weights as mix_* columns."""
    return mixing.mix(docs, prefix="mix_")


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark_passages),
    ("personal data", personal_data),
    ("source mixing", source_mix),
]

#: The field's labels, the sample's hash and the alignments are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written to the shared folder and read again, so a lost executor costs one stage at most."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
