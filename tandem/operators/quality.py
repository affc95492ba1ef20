"""Anomaly flags and counts, the repair gate and the approval gate."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.functions.records import anomaly_messages, is_empty, known_direction, known_domain
from tandem.functions.text import token_count
from tandem.settings import Rules

ANOMALIES = ("null_inputs", "too_long", "too_short", "null_outputs", "invalid_domains", "invalid_directions")


class DatasetRejected(ValueError):
    """A gate did not let the data pass."""


def anomaly_flags(records: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One flag per anomaly category and their union; lengths are tested only on non-empty input."""
    n_in, has_input = token_count(F.col("input")), ~is_empty(F.col("input"))
    return records.withColumns(
        {
            "null_inputs": ~has_input,
            "too_long": has_input & (n_in > rules.max_tokens),
            "too_short": has_input & (n_in < rules.min_tokens),
            "null_outputs": is_empty(F.col("output")),
            "invalid_domains": ~known_domain(F.col("domain")),
            "invalid_directions": ~known_direction(F.col("direction")),
        }
    ).withColumn("anomalous", F.greatest(*ANOMALIES))


def membership(records: DataFrame) -> DataFrame:
    """Records whose domain and direction are in the allowed sets."""
    return records.where(known_domain(F.col("domain")) & known_direction(F.col("direction")))


def anomaly_counts(records: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row: records per category, anomalous records, total."""
    flags = anomaly_flags(records, rules)
    return flags.agg(
        *(F.count_if(name).alias(name) for name in ANOMALIES),
        F.count_if("anomalous").alias("anomalous_row_count"),
        F.count("*").alias("total_checked"),
    )


def anomaly_report(records: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Verdict row of the repair gate: validated, drop_and_continue or fail_fast."""
    bad, total = F.col("anomalous_row_count"), F.col("total_checked")
    drop = bad > rules.anomaly_drop_threshold
    return anomaly_counts(records, rules).select(
        anomaly_messages().alias("anomalies"),
        "total_checked",
        "anomalous_row_count",
        F.lit(rules.anomaly_drop_threshold).alias("drop_threshold"),
        F.when(bad == 0, "validated").when(drop, "drop_and_continue").otherwise("fail_fast").alias("action_taken"),
        F.when(bad > 0, F.when(drop, bad).otherwise(0)).alias("records_dropped"),
        F.when(bad > 0, total - bad).alias("records_after_drop"),
    )


def clean_records(records: DataFrame, rules: Rules = Rules()) -> DataFrame:
    return anomaly_flags(records, rules).where(~F.col("anomalous")).select(*records.columns)


def anomaly_gate(records: DataFrame, write_report, rules: Rules = Rules()) -> DataFrame:
    """Records to go on with. Writes the report first, then raises if few records are anomalous."""
    report = anomaly_report(records, rules)
    verdict = report.first()
    write_report(records.sparkSession.createDataFrame([verdict], report.schema))
    if verdict["action_taken"] == "fail_fast":
        raise DatasetRejected(f"Dataset anomalies detected: {verdict['anomalies']}")
    return clean_records(records, rules) if verdict["action_taken"] == "drop_and_continue" else records


def split_counts(splits: DataFrame) -> DataFrame:
    return splits.groupBy("split").agg(F.count("*").alias("records"))


def approval_report(splits: DataFrame, rules: Rules = Rules(), now: datetime | None = None) -> DataFrame:
    """Approval row; `approved` is false when the train split is too small."""
    stamp = (now or datetime.now(timezone.utc)).strftime("%Y-%m-%d %H:%M:%S.%f")
    counts = split_counts(splits).agg(
        *(
            F.coalesce(F.sum(F.when(F.col("split") == name, F.col("records"))), F.lit(0)).alias(f"{name}_records")
            for name in ("train", "val", "test")
        )
    )
    return counts.select(
        (F.col("train_records") >= rules.min_train_records).alias("approved"),
        F.lit(stamp).alias("timestamp"),
        "train_records",
        "val_records",
        "test_records",
        F.lit(rules.version).alias("version"),
    )


def approval_gate(splits: DataFrame, rules: Rules = Rules(), now: datetime | None = None) -> DataFrame:
    """The approval row, or an error when the train split is too small."""
    report = approval_report(splits, rules, now)
    row = report.first()
    if not row["approved"]:
        raise DatasetRejected(f"Train set too small: {row['train_records']} < {rules.min_train_records}")
    return splits.sparkSession.createDataFrame([row], report.schema)
