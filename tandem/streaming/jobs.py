"""Streaming forms of the log, monitor, transcript and session operators.

Every sink writes one directory per micro-batch and overwrites it on a replay, so a batch that runs
twice after a failure leaves the same data as one that runs once.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from tandem.operators.monitor import inference_log, value_counts, window_keys, window_report
from tandem.operators.ranking import running_total
from tandem.operators.sessions import collapse_updates, final_transcripts, line_values, merge_lines


def read_files(spark: SparkSession, path: str, schema: StructType, pattern: str | None = None, files: int | None = None) -> DataFrame:
    """Parquet files as a stream, oldest first."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.parquet(path)


def _each_batch(stream: DataFrame, out: str, write, mode: str, trigger: dict) -> StreamingQuery:
    return (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", f"{out}/_checkpoint")
        .trigger(**trigger)
        .foreachBatch(write)
        .start()
    )


NOW = {"availableNow": True}


def stream_inference_log(requests: DataFrame, out: str, trigger: dict = NOW) -> StreamingQuery:
    """Answered requests to log rows, appended to a file table."""
    return (
        inference_log(requests)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", f"{out}/log")
        .option("checkpointLocation", f"{out}/_checkpoint")
        .trigger(**trigger)
        .start()
    )


def windowed_log(log: DataFrame, width: str = "1 hour", slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Counts per window, keys and latency value of a log stream; rows later than the watermark are dropped.

    The state holds one row per distinct value of a window, and the percentile is looked up on reading, as in batch.
    """
    timed = log.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", late)
    return timed.groupBy(*window_keys(F.col("timestamp"), width, slide), "latency_ms").agg(*value_counts())


def stream_monitor(log: DataFrame, out: str, trigger: dict = NOW, **window) -> StreamingQuery:
    """Changed counts of each micro-batch; read the report with `read_monitor`."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/windows/batch={batch_id}")

    return _each_batch(windowed_log(log, **window), out, write, "update", trigger)


def read_monitor(spark: SparkSession, out: str) -> DataFrame:
    """The report from the latest counts of each window and value."""
    keys = ["window", "direction", "domain", "latency_ms"]
    state = F.max_by(F.struct("n", "n_in", "n_out"), "batch").alias("state")
    latest = spark.read.parquet(f"{out}/windows").groupBy(*keys).agg(state)
    return window_report(latest.select(*keys, "state.*"))


def stream_final_lines(events: DataFrame, out: str, trigger: dict = NOW) -> StreamingQuery:
    """Appends the final lines of each micro-batch under the batch's number; `read_lines_table` numbers them."""

    def write(batch: DataFrame, batch_id: int) -> None:
        final_transcripts(batch).write.mode("overwrite").parquet(f"{out}/lines/batch={batch_id}")

    return _each_batch(events, out, write, "append", trigger)


def read_lines_table(spark: SparkSession, out: str, session: str, position: str) -> DataFrame:
    """The final lines with `idx`: 0, 1, 2, ... per session, by micro-batch and then position.

    A line keeps its number as batches are added, and neither a session nor a batch has to fit into one task.
    """
    lines = spark.read.parquet(f"{out}/lines").withColumn("batch", F.col("batch").cast("bigint"))
    numbered = running_total(lines, [session], ["batch", position], "_n")
    return numbered.withColumn("idx", F.col("_n") - 1).drop("_n", "batch")


def stream_line_updates(updates: DataFrame, out: str, trigger: dict = NOW) -> StreamingQuery:
    """Collapses the line updates of each micro-batch and logs them; `read_line_state` merges on read."""

    def write(batch: DataFrame, batch_id: int) -> None:
        collapse_updates(batch).write.mode("overwrite").parquet(f"{out}/updates/batch={batch_id}")

    return _each_batch(updates, out, write, "append", trigger)


def _compactions(spark: SparkSession, out: str) -> DataFrame:
    """Committed compactions: (upto, path)."""
    schema = "upto bigint, path string"
    try:
        return spark.read.schema(schema).json(f"{out}/compactions")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _line_tables(spark: SparkSession, out: str) -> tuple[DataFrame, int]:
    """The last compaction and the micro-batches after it, and its last batch. Batches that it holds are not opened."""
    last = _compactions(spark, out).orderBy(F.desc("upto"), "path").first()
    updates = spark.read.parquet(f"{out}/updates")
    if last is None:
        return updates.drop("batch"), -1
    later = updates.where(F.col("batch") > last["upto"]).drop("batch")
    return spark.read.schema(later.schema).parquet(last["path"]).unionByName(later), last["upto"]


def compact_lines(spark: SparkSession, out: str) -> None:
    """Merges all micro-batches so far into one table, which replaces them for readers once its marker is committed.

    A failure before that leaves readers with what they had. A batch that is replayed later has the content it had, so
    its place in the compaction stands; late updates are merged by their `seq`, which the table keeps for each field.
    Replaced batches can be deleted by whoever keeps the storage.
    """
    batches = spark.read.parquet(f"{out}/updates").select("batch").distinct()
    upto = batches.agg(F.max(F.col("batch").cast("bigint"))).first()[0]
    tables, done = _line_tables(spark, out)
    if upto is None or upto <= done:
        return
    path = f"{out}/compacted/upto={upto}-{uuid.uuid4().hex}"
    merge_lines(tables).write.parquet(path)
    spark.createDataFrame([(upto, path)], "upto bigint, path string").coalesce(1).write.mode("append").json(f"{out}/compactions")


def read_line_state(spark: SparkSession, out: str) -> DataFrame:
    """The current lines, from the last compaction and the micro-batches after it."""
    return line_values(merge_lines(_line_tables(spark, out)[0]))


def stream_sessions(events: DataFrame, user: str, ts: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Sessions per user as a streaming aggregate; a session is emitted once the watermark passed it."""
    timed = events.withColumn("at", F.col(ts).cast("timestamp")).withWatermark("at", late)
    return (
        timed.groupBy(F.col(user).alias("user"), F.session_window("at", gap).alias("session"))
        .agg(F.min("at").alias("start"), F.max("at").alias("end"), F.count("*").alias("events"))
        .drop("session")
    )
