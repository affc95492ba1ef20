"""Translation log rows and their statistics per time window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tandem.functions.text import token_count

LOG_KEYS = ["window_start", "direction", "domain"]


def inference_log(requests: DataFrame) -> DataFrame:
    """Log rows of answered requests: texts, routing, latency and word counts."""
    return requests.select(
        "timestamp",
        "input_text",
        "translated_text",
        "direction",
        "domain",
        F.bround("latency_ms", 2).alias("latency_ms"),
        token_count(F.col("input_text")).alias("input_len"),
        token_count(F.col("translated_text")).alias("output_len"),
    )


def window_measures(count: Column, latency: Column, n_in: Column, n_out: Column) -> list[Column]:
    """Report columns from summed latency and word counts."""
    return [
        count.alias("n"),
        (latency / count).alias("latency_mean"),
        (n_in / count).alias("input_len_mean"),
        (n_out / count).alias("output_len_mean"),
        (n_out / F.greatest(n_in, F.lit(1))).alias("out_in_ratio"),
    ]


def monitor_window(log: DataFrame, width: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Per (window, direction, domain): requests, mean and exact 95th percentile latency, word counts."""
    return window_report(log.groupBy(*window_keys(F.col("timestamp").cast("timestamp"), width, slide), "latency_ms").agg(*value_counts()))


def window_keys(timestamp: Column, width: str, slide: str | None) -> list[Column]:
    """A stream must give its watermarked column as it is: a cast would lose the watermark."""
    return [F.window(timestamp, width, slide).alias("window"), F.col("direction"), F.col("domain")]


def value_counts() -> list[Column]:
    """Latencies have two digits, so a busy window shrinks to its distinct values before its percentile is looked up."""
    return [F.count("*").alias("n"), F.sum("input_len").alias("n_in"), F.sum("output_len").alias("n_out")]


def window_report(values: DataFrame) -> DataFrame:
    """The report from counts per (window, direction, domain, latency value)."""
    values = values.withColumn("window_start", F.col("window.start")).drop("window")
    upto = Window.partitionBy(*LOG_KEYS).orderBy("latency_ms")
    total = F.sum("n").over(Window.partitionBy(*LOG_KEYS))
    ranked = values.withColumns({"upto": F.sum("n").over(upto), "total": total})
    reached = F.col("upto") >= F.ceil(F.col("total") * F.lit(0.95))
    return (
        ranked.groupBy(*LOG_KEYS)
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.col("n") * F.col("latency_ms")).alias("latency"),
            F.sum("n_in").alias("n_in"),
            F.sum("n_out").alias("n_out"),
            F.min(F.when(reached, F.col("latency_ms"))).alias("latency_p95"),
        )
        .select(
            *LOG_KEYS,
            *window_measures(F.col("n"), F.col("latency"), F.col("n_in"), F.col("n_out")),
            "latency_p95",
        )
    )
