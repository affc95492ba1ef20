"""Writers: records, splits, slices, reports, published versions."""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tandem.settings import RECORD_FIELDS, SLICES
from tandem.sources.files import digest_sums, digest_text, list_files, plain_path, relative_to, snapshot_status
from tandem.workspace import settle


def sink_records(records: DataFrame, path: str) -> None:
    """Instruction records as JSON lines, non-ASCII text kept."""
    records.select(*RECORD_FIELDS).write.mode("overwrite").json(path)


def sink_splits(splits: DataFrame, path: str) -> None:
    """One directory of JSON lines per split."""
    splits.select("split", *RECORD_FIELDS).write.mode("overwrite").partitionBy("split").json(path)


def sink_slices(sliced: DataFrame, path: str) -> None:
    """One directory of JSON lines per slice."""
    sliced.select("slice", *RECORD_FIELDS).write.mode("overwrite").partitionBy("slice").json(path)


def sink_report(report: DataFrame, path: str) -> None:
    """A one-row report as one pretty JSON document."""
    document = F.to_json(F.struct(*report.columns), {"pretty": "true", "ignoreNullFields": "false"})
    report.select(document.alias("value")).coalesce(1).write.mode("overwrite").text(path)


def append_log(rows: DataFrame, path: str) -> bool:
    """Appends log rows in one committed write. A failure is logged and told, not raised: the caller's answers go on."""
    try:
        rows.write.mode("append").parquet(path)
    except Exception:
        logging.getLogger(__name__).exception("no log rows were added to %s", path)
        return False
    return True


# Reports that belong to an approved version.
APPROVED_REPORTS = ("schema", "tfdv_stats_summary", "anomalies", "dataset_approval")


def publish_plan(spark: SparkSession, base: str, version: str) -> DataFrame:
    """Wanted datasets of a version against what lies under `base`: target, files, size, found.

    Wanted are the three splits, the four reports and whichever slices exist. Split and slice
    directories are kept in the target, since flat names can clash.
    """
    wanted = [
        *(("split", f"splits/split={name}") for name in ("train", "val", "test")),
        *(("report", f"reports/{name}") for name in APPROVED_REPORTS),
    ]
    wanted = spark.createDataFrame(wanted, "kind string, dataset string")
    # Listed paths come without the `file:` scheme, the base may have it.
    root = F.concat(F.regexp_replace(plain_path(F.lit(base)), "/+$", ""), F.lit("/"))
    files = list_files(spark, base).select(F.substring(F.col("path"), F.length(root) + 1, F.length("path")).alias("relative"), "length")
    name = F.element_at(F.split("relative", "/"), -1)
    files = files.where(~name.startswith("_") & ~name.startswith(".")).select(
        F.regexp_replace("relative", "/[^/]*$", "").alias("dataset"), "length"
    )
    found = files.groupBy("dataset").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    slices = found.where(F.col("dataset").isin(*(f"slices/slice={name}" for name in SLICES))).select(
        F.lit("slice").alias("kind"), "dataset"
    )
    return (
        wanted.unionByName(slices)
        .join(found, "dataset", "left")
        .select(
            "kind",
            "dataset",
            F.concat(F.lit(f"version={version}/"), F.col("dataset")).alias("target"),
            F.coalesce("files", F.lit(0)).alias("files"),
            (F.coalesce("bytes", F.lit(0)) / (1024 * 1024)).alias("size_mb"),
            F.col("bytes").isNotNull().alias("found"),
        )
    )


@dataclass(frozen=True)
class Version:
    """A committed publication: its number, its folder and the hash over its datasets."""

    number: int
    path: str
    snapshot: str


DATASETS = "array<struct<dataset: string, rows: bigint, fingerprint: string>>"
COMMIT = f"number bigint, build string, snapshot string, datasets {DATASETS}"


def dataset_fingerprints(spark: SparkSession, root: str) -> DataFrame:
    """(dataset, rows, fingerprint) of every folder of lines below `root`, by one scan; the order of lines has no part."""
    path = plain_path(F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))))
    lines = spark.read.option("recursiveFileLookup", "true").text(root).select(path.alias("path"), F.sha2(F.col("value").cast("binary"), 256).alias("hash"))
    lines = relative_to(lines, root).select(F.regexp_replace("path", "/?[^/]*$", "").alias("dataset"), "hash")
    return lines.groupBy("dataset").agg(*digest_sums(F.col("hash"))).select("dataset", "rows", digest_text().alias("fingerprint"))


def _version_folder(target: str, version: str) -> str:
    return f"{target}/version={version}"


def commits(spark: SparkSession, target: str, version: str) -> DataFrame:
    """All publications of a version, one row each."""
    try:
        return spark.read.schema(COMMIT).json(f"{_version_folder(target, version)}/_commits")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMIT)


def published(spark: SparkSession, target: str, version: str, check: bool = False) -> Version | None:
    """The last committed publication; with `check`, its datasets are read and compared with what was committed."""
    last = commits(spark, target, version).orderBy(F.desc("number"), "build").first()
    if last is None:
        return None
    path = f"{_version_folder(target, version)}/build={last['build']}"
    if check and (found := _snapshot(dataset_fingerprints(spark, path)).first()["snapshot"]) != last["snapshot"]:
        raise ValueError(f"{path} is not what was published: {found} in place of {last['snapshot']}")
    return Version(last["number"], path, last["snapshot"])


def _snapshot(fingerprints: DataFrame) -> DataFrame:
    """One row: the datasets, a few per version, and the hash over them."""
    one = fingerprints.agg(F.array_sort(F.collect_list(F.struct("dataset", "rows", "fingerprint"))).alias("datasets"))
    text = F.transform("datasets", lambda d: F.concat_ws("|", d["dataset"], d["rows"].cast("string"), d["fingerprint"]))
    return one.select("datasets", F.md5(F.array_join(text, "\n").cast("binary")).alias("snapshot"))


def publish(spark: SparkSession, plan: DataFrame, base: str, target: str, version: str) -> Version:
    """Copies the found datasets of a plan, at most 13 per version, to a folder of their own and commits it.

    The commit is one row, appended in one committed write after the copy was read back and compared line by line with
    what lies under `base`. Readers find a version by its last commit, so a failure at any point leaves the one before
    whole. A missing split is an error, other gaps are skipped.
    """
    if lost := [row["dataset"] for row in plan.where("kind = 'split' and not found").orderBy("dataset").collect()]:
        raise FileNotFoundError(f"nothing published: {', '.join(lost)} not found under {base}")
    wanted = [row["dataset"] for row in plan.where("found").orderBy("dataset").collect()]
    before = published(spark, target, version)
    build = uuid.uuid4().hex
    folder = f"{_version_folder(target, version)}/build={build}"
    for dataset in wanted:
        spark.read.text(f"{base}/{dataset}").write.text(f"{folder}/{dataset}")
    copied = settle(dataset_fingerprints(spark, folder), "published")
    given = dataset_fingerprints(spark, base).where(F.col("dataset").isin(wanted))
    if odd := [row["dataset"] for row in given.exceptAll(copied).unionByName(copied.exceptAll(given)).select("dataset").distinct().collect()]:
        raise ValueError(f"nothing published: the copies of {', '.join(sorted(odd))} differ from {base}")
    commit = _snapshot(copied).select(F.lit(before.number + 1 if before else 1).cast("bigint").alias("number"), F.lit(build).alias("build"), "snapshot", "datasets")
    commit.coalesce(1).write.mode("append").json(f"{_version_folder(target, version)}/_commits")
    return published(spark, target, version)


def version_status(spark: SparkSession, target: str, version: str) -> DataFrame:
    """Datasets added, removed or modified by the last publication of a version against the one before: (path, status)."""
    last = commits(spark, target, version).orderBy(F.desc("number"), "build").limit(2).select("number", F.inline("datasets"))
    last = settle(last, "commits")
    newest = last.agg(F.max("number").alias("newest"))
    listing = last.join(newest).select("number", "newest", F.col("dataset").alias("path"), F.col("fingerprint").alias("checksum"))
    return snapshot_status(listing.where("number < newest"), listing.where("number = newest"))


def handoff_payload(approval: DataFrame, target: str, at: Version | None = None) -> DataFrame:
    """What the training side needs to start: published paths, version and train size; with `at`, those of one publication.

    An approval table without an approved row gives no payload row.
    """
    root = F.lit(at.path) if at else F.concat(F.lit(f"{target}/version="), F.col("version"))
    return approval.where("approved").select(
        F.concat(root, F.lit("/splits/split=train")).alias("train"),
        F.concat(root, F.lit("/splits/split=val")).alias("val"),
        F.concat(root, F.lit("/reports/schema")).alias("schema"),
        F.col("version").alias("dataset_version"),
        "train_records",
    )
