"""The whole corpus run: raw sources to a published, snapshotted version."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.operators.pairs import preprocess
from tandem.operators.profile import profile_report, schema_report
from tandem.operators.quality import DatasetRejected, anomaly_gate, approval_gate
from tandem.operators.slices import assign_slices, bias_report, report_stats, slice_stats
from tandem.operators.split import shuffle_rows, stratified_split
from tandem.settings import Rules
from tandem.sinks.writers import handoff_payload, publish, publish_plan, sink_report, sink_slices, sink_splits, version_status
from tandem.sources.bitext import LINE_ORDER, read_manifest, scan_manifest_sources
from tandem.sources.files import file_checksums, list_present, manifest_missing, relative_to, snapshot_manifest, source_branch


def run_corpus(
    spark: SparkSession,
    manifest_path: str,
    out: str,
    target: str,
    rules: Rules = Rules(),
    now: datetime | None = None,
    fetch: Callable[[list[str]], None] | None = None,
) -> DataFrame:
    """Runs every step and returns the hand-off payload. A gate that fails raises, after its report.

    Stage tables are written once under `out` and read back, so each step starts from storage. Sources that are not there
    go to `fetch`, by name; without it, or if it does not bring them, the run is rejected.
    """

    def stage(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{out}/stage/{name}")
        return spark.read.parquet(f"{out}/stage/{name}")

    def report(df: DataFrame, name: str) -> None:
        sink_report(df, f"{out}/reports/{name}")

    manifest = read_manifest(spark, manifest_path)
    paths = [row["path"] for row in manifest.select("path").collect()]

    def absent() -> DataFrame:
        return manifest_missing(manifest, list_present(spark, paths))

    missing = absent()
    if fetch and source_branch(missing).first()["branch"] == "download":
        fetch([row["name"] for row in missing.orderBy("rank").collect()])
        missing = absent()
    if names := [row["name"] for row in missing.orderBy("rank").collect()]:
        raise DatasetRejected(f"Missing sources: {names}")

    order = ["source_rank", *LINE_ORDER]
    records = stage(preprocess(scan_manifest_sources(spark, manifest), order, rules), "records")
    # Pairs are unique by text here, so the text is the row's id wherever its files lie and however they are read.
    splits = stratified_split(records, ["domain", "direction", "input", "output"], rules)
    splits.write.mode("overwrite").partitionBy("split").parquet(f"{out}/stage/splits")
    splits = spark.read.parquet(f"{out}/stage/splits")
    train, val, test = (splits.where(F.col("split") == name) for name in ("train", "val", "test"))

    profile = stage(profile_report(train), "profile")
    report(profile, "tfdv_stats_summary")
    report(schema_report(profile), "schema")
    val = anomaly_gate(val, lambda row: report(row, "anomalies"), rules)
    approved = train.unionByName(val).unionByName(test)
    sink_splits(shuffle_rows(approved), f"{out}/splits")
    sink_slices(assign_slices(test), f"{out}/slices")
    stats = stage(report_stats(slice_stats(test)), "slice_stats")
    report(bias_report(stats, rules), "bias_report")

    approval = approval_gate(approved, rules, now)
    report(approval, "dataset_approval")
    published = publish(spark, publish_plan(spark, out, rules.version), out, target, rules.version)
    files = relative_to(file_checksums(spark, published.path), published.path)
    directory = F.struct("directory", "hash", "size", "nfiles")
    report(snapshot_manifest(files).agg(F.array_sort(F.collect_list(directory)).alias("directories")), "snapshot")
    changes = version_status(spark, target, rules.version)
    changes = changes.agg(*(F.array_sort(F.collect_list(F.when(F.col("status") == s, F.col("path")))).alias(s) for s in ("added", "removed", "modified")))
    report(changes.select(F.lit(published.number).alias("publication"), F.lit(published.snapshot).alias("hash"), "*"), "snapshot_status")
    payload = handoff_payload(approval, target, published)
    report(payload, "trigger_payload")
    return payload
