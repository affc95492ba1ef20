"""Stage tables in the folder that every executor shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a scratch folder only for local sessions without one."""
    global _local_folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="tandem-")
    return _local_folder


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a stage table and read it back.

    Cuts the lineage on durable storage, and gives the reader the true size of the table, so that
    Spark broadcasts it in a join only while it is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
