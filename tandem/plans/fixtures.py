"""Bitext views over the plain tables: where the registered queries take their pairs and logs from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.operators.pairs import clean_pairs, dedup_pairs, preprocess, valid_pairs
from tandem.operators.split import stratified_split
from tandem.settings import Rules
from tandem.workspace import fresh_path, settle

ORDER = ["source_rank", "doc_id", "pair_no"]
ROW_ID = ["doc_id", "pair_no", "direction"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for an input of few, small files; an input with enough splits stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def raw_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Lines 2k and 2k+1 of a document are pair k; a last odd line is paired with the empty text."""
    source_no = F.substring("source", 4, 10).cast("int")
    documents = spread(table(spark, sf, "documents").select("doc_id", "text", "lang", "source"))
    lines = documents.select("doc_id", "source", "lang", source_no.alias("n"), F.split("text", "\n").alias("lines"))
    pair = F.explode(
        F.transform(
            F.when(F.size("lines") >= 1, F.sequence(F.lit(0), F.ceil(F.size("lines") / 2).cast("int") - 1)),
            lambda k: F.struct(
                k.cast("bigint").alias("pair_no"),
                F.get("lines", 2 * k).alias("en"),
                F.coalesce(F.get("lines", 2 * k + 1), F.lit("")).alias("es"),
            ),
        )
    )
    first = F.col("n") < 10
    return lines.select(
        "doc_id",
        "source",
        "lang",
        F.when(first, 0).otherwise(1).alias("source_rank"),
        F.when(first, "medical").otherwise("legal").alias("domain"),
        pair.alias("pair"),
    ).select("doc_id", "pair.pair_no", "source", "lang", "source_rank", "domain", "pair.en", "pair.es")


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    return clean_pairs(raw_pairs(spark, sf))


def kept(spark: SparkSession, sf: str) -> DataFrame:
    narrow = pairs(spark, sf).drop("source", "lang")
    return dedup_pairs(valid_pairs(narrow), ORDER)


def records(spark: SparkSession, sf: str) -> DataFrame:
    return preprocess(raw_pairs(spark, sf).drop("source", "lang"), ORDER)


def splits(spark: SparkSession, sf: str, rules: Rules = Rules()) -> DataFrame:
    """The split records, from a written record table: as between the steps of a corpus run."""
    return stratified_split(settle(records(spark, sf), "records"), ROW_ID, rules)


def split_of(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return splits(spark, sf).where(F.col("split") == name)


def test_split(spark: SparkSession, sf: str) -> DataFrame:
    return settle(split_of(spark, sf, "test"), "test")


def dirty_records(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs as records with every kind of anomaly in them."""
    source_no = F.substring("source", 4, 10).cast("int")
    return pairs(spark, sf).select(
        "doc_id",
        "pair_no",
        "source",
        F.lit("translate").alias("instruction"),
        F.when(F.col("doc_id") % 97 != 0, F.col("en")).alias("input"),
        F.when(F.col("doc_id") % 89 == 0, "").otherwise(F.col("es")).alias("output"),
        F.when(source_no >= 18, "finance").otherwise(F.col("domain")).alias("domain"),
        F.when(F.col("lang") == "fr", "fr_to_en").otherwise("en_to_es").alias("direction"),
    )


def request_log(spark: SparkSession, sf: str) -> DataFrame:
    return as_request_log(table(spark, sf, "events"))


def as_request_log(events: DataFrame) -> DataFrame:
    """Events, batch or stream, as translation requests; word counts are derived from the ids."""
    return events.select(
        F.col("ts").alias("timestamp"),
        "event_id",
        "user_id",
        F.when(F.col("user_id") % 2 == 0, "en_to_es").otherwise("es_to_en").alias("direction"),
        F.when(F.col("event_type").isin("error", "signup"), "legal").otherwise("medical").alias("domain"),
        F.bround("value", 2).alias("latency_ms"),
        (F.col("user_id") % 40 + 1).cast("int").alias("input_len"),
        (F.col("event_id") % 40 + 1).cast("int").alias("output_len"),
    )


def transcripts(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns as transcript events: system turns are interim."""
    return table(spark, sf, "conversations").select(
        F.col("conv_id").alias("session"), "turn", (F.col("role") != "system").alias("is_final"), "text"
    )


def line_updates(spark: SparkSession, sf: str) -> DataFrame:
    """User turns open a line, the assistant turn after it fills in the translation."""
    is_user = F.col("role") == "user"
    return table(spark, sf, "conversations").where(F.col("role").isin("user", "assistant")).select(
        F.col("conv_id").alias("session"),
        F.when(is_user, F.col("turn")).otherwise(F.col("turn") - 1).alias("idx"),
        F.col("turn").alias("seq"),
        F.when(is_user, F.col("text")).alias("source"),
        F.when(is_user, "").otherwise(F.col("text")).alias("translated"),
        is_user.alias("pending"),
    )


# Lines that a tolerant reader must drop.
BAD_LINES = (
    "{bad",
    "",
    "{}",
    '{"translation":null}',
    '{"translation":{"en":["a b c d"],"es":"a b c d"}}',
)


def raw_sources(spark: SparkSession, sf: str, ordered: bool = False) -> list[tuple[str, str, str]]:
    """The pairs written as two raw JSON-line sources, bad lines included: (name, path, domain). In the order of the
    documents, if asked for, by a sort over all tasks."""
    base = fresh_path(spark, "raw")
    translation = F.to_json(F.struct(F.struct("en", "es").alias("translation")))
    # Every source gets the bad lines once per document that opens it.
    bad = F.when(F.col("pair_no") == 0, F.array(*(F.lit(line) for line in BAD_LINES))).otherwise(F.array())
    lines = pairs(spark, sf).select("domain", "doc_id", "pair_no", F.posexplode(F.concat(F.array(translation), bad)).alias("at", "value"))
    lines = lines.orderBy("domain", "doc_id", "pair_no", "at") if ordered else lines
    lines.select("domain", "value").write.partitionBy("domain").text(base)
    return [(f"{domain}_pairs", f"{base}/domain={domain}", domain) for domain in ("medical", "legal")]


def source_files(documents: DataFrame) -> str:
    """The texts of documents as lines, in a folder per source and in the order of their ids; gives the folder above."""
    base = fresh_path(documents.sparkSession, "by-source")
    documents.orderBy("source", "doc_id").select("source", "text").write.partitionBy("source").text(base)
    return base
