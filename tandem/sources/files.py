"""File listings, checksums and snapshots as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tandem.sources import digest


def plain_path(path: Column) -> Column:
    """A path without the `file:` scheme that listings put before local paths."""
    return F.regexp_replace(path, "^file:(//)?", "")


def list_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All files below a path: (path, length). The contents are not read."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return listing.select(plain_path(F.col("path")).alias("path"), "length")


def list_present(spark: SparkSession, paths: list[str]) -> DataFrame:
    """As `list_files`; paths that do not exist have no files. The paths are those of a manifest, a few."""
    listing = spark.createDataFrame([], "path string, length bigint")
    for path in paths:
        try:
            listing = listing.unionByName(list_files(spark, path))
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
    return listing


def file_checksums(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, length, checksum, value, shift) of all files below a path: one mergeable checksum for files of any size.

    Blocks of files are read by all tasks, as lines that end at a line feed, which leaves every byte as it is; the length
    tells whether the last line has one. Only a number per block is shuffled. Files whose ending names a compression are
    read decompressed, as Spark reads them everywhere. Spark's scans pass over empty files, so they are not listed.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    listed = reader.format("binaryFile").load(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), plain_path(F.col("path")).alias("path"), "length"
    )
    lines = reader.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("value"),
    )
    blocks = digest.line_pieces(lines).groupBy("file").agg(F.array_sort(F.collect_list(F.struct("block", "value", "shift"))).alias("blocks"), F.sum("bytes").alias("bytes"))
    whole = digest.together(F.coalesce("blocks", F.array().cast("array<struct<block: bigint, value: array<bigint>, shift: array<bigint>>>")))
    files = listed.join(blocks, "file", "left").select("path", "length", "bytes", whole.alias("piece"))
    # Every line was given a line feed.
    piece = F.when(F.col("bytes") == F.col("length") + 1, digest.without_last_line_feed(F.col("piece"))).otherwise(F.col("piece"))
    return files.select("path", "length", piece.alias("piece")).select("path", "length", digest.checksum(F.col("piece")).alias("checksum"), "piece.*")


def dataset_checksum() -> Column:
    """Aggregate of a group of `file_checksums`: the checksum of their bytes one after the other, in the order of their paths.

    A row per file meets in a group, of which the driver's own listing has as many.
    """
    files = F.array_sort(F.collect_list(F.struct("path", "value", "shift")))
    return digest.checksum(digest.together(files))


def row_hash(*columns: str) -> Column:
    """SHA-256 of a row's values as text, each after its length in bytes; null differs from every text."""
    text = [F.col(f"`{c}`").cast("string") for c in columns]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in text)).cast("binary"), 256)


def digest_sums(hashed: Column) -> list[Column]:
    """Order-free digest of rows hashed to hexadecimal digits: the sums of two parts of 60 bits, and the count. It is
    mergeable, so hot groups combine before the shuffle, and rows that repeat count each time."""
    part = lambda at: F.conv(F.substring(hashed, at, 15), 16, 10).cast("decimal(20,0)")
    return [F.sum(part(1)).alias("sum1"), F.sum(part(16)).alias("sum2"), F.count("*").alias("rows")]


def digest_text() -> Column:
    sums = (F.coalesce(c, F.lit(0)).cast("string") for c in ("sum1", "sum2", "rows"))
    return F.md5(F.concat_ws("|", *sums).cast("binary"))


def source_roots(spark: SparkSession, sources: DataFrame) -> DataFrame:
    """The sources (rank, name, path, ...) with `root`, their path as listings have it; a pattern gives a row per match.

    Sources are the few rows of a manifest. A path that does not exist is an error.
    """
    conf, hadoop = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs
    rows = []
    for row in sources.toLocalIterator():
        path = hadoop.Path(row["path"])
        found = path.getFileSystem(conf).globStatus(path)
        if not found:
            raise FileNotFoundError(f"source {row['name']}: {row['path']} does not exist")
        rows += [(*row, status.getPath().toString()) for status in found]
    return spark.createDataFrame(rows, f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in sources.schema)}, root string")


def outermost(roots: DataFrame) -> list[str]:
    """The roots that no other one lies above: what has to be read."""
    every = {row["root"] for row in roots.select("root").collect()}
    return sorted(r for r in every if not any(r[:i] in every for i, c in enumerate(r) if c == "/" and i))


def owners(paths: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of `paths` (path as listings have it) with those of `roots` that hold it: the path itself or the nearest
    folder above it. Files meet roots by equal folder names, so neither their number nor that of the sources squares."""
    parts = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    met = paths.withColumn("root", F.explode(above)).join(roots.withColumnsRenamed({"path": "source_path"}), "root")
    depth = F.length("root")
    return met.withColumn("_deepest", F.max(depth).over(Window.partitionBy("path"))).where(depth == F.col("_deepest")).drop("_deepest", "root")


def source_manifest(spark: SparkSession, sources: list[tuple[str, str, str]]) -> DataFrame:
    """Manifest of (name, path, domain) sources: adds rank and checksum.

    A source's checksum is that of its files' bytes one after the other, in the order of their paths. All sources are
    read in one scan; a file that lies in two of them belongs to the nearest.
    """
    named = spark.createDataFrame([(rank, *source) for rank, source in enumerate(sources)], "rank int, name string, path string, domain string")
    roots = source_roots(spark, named)
    files = file_checksums(spark, outermost(roots))
    plain = roots.withColumn("root", plain_path(F.col("root")))
    sums = owners(files, plain).groupBy("rank").agg(dataset_checksum().alias("checksum"))
    return named.join(sums, "rank").select("rank", "name", "path", "checksum", "domain")


def manifest_json(manifest: DataFrame) -> DataFrame:
    """The manifest as one JSON document, sources in rank order."""
    entry = F.struct("rank", "name", F.struct("path", "checksum", "domain").alias("meta"))
    entries = F.array_sort(F.collect_list(entry))
    as_map = F.map_from_entries(F.transform(entries, lambda e: F.struct(e["name"], e["meta"])))
    return manifest.agg(F.to_json(as_map).alias("value"))


def with_directories(files: DataFrame) -> DataFrame:
    return files.withColumn("directory", F.regexp_replace("path", "/[^/]*$", ""))


def manifest_missing(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Sources whose path is neither a listed file nor a folder above listed files; empty = complete."""
    parts = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    present = files.select(F.explode(above).alias("path")).distinct()
    wanted = manifest.withColumn("_path", F.regexp_replace(plain_path(F.col("path")), "/+$", ""))
    return wanted.join(present.withColumnRenamed("path", "_path"), "_path", "left_anti").drop("_path")


def source_branch(missing: DataFrame) -> DataFrame:
    """One row: go on with the sources at hand, or fetch them again."""
    return missing.agg(F.count("*").alias("missing_sources")).withColumn(
        "branch", F.when(F.col("missing_sources") == 0, "skip_download").otherwise("download")
    )


def relative_to(files: DataFrame, base: str) -> DataFrame:
    """The listing with paths below `base`, so that the same files elsewhere have the same paths."""
    root = F.concat(F.regexp_replace(plain_path(F.lit(base)), "/+$", ""), F.lit("/"))
    return files.withColumn("path", F.when(F.col("path").startswith(root), F.substring("path", F.length(root) + 1, F.length("path"))).otherwise(F.col("path")))


def snapshot_manifest(files: DataFrame) -> DataFrame:
    """Per directory of a checksum listing: hash of its files' bytes in the order of their names, total bytes, number of files.

    Names count by their order alone, as Spark gives files other names on each writing. The directory itself has no part.
    """
    in_directory = with_directories(files).groupBy("directory")
    return in_directory.agg(dataset_checksum().alias("hash"), F.sum("length").alias("size"), F.count("*").alias("nfiles"))


def snapshot_status(before: DataFrame, after: DataFrame) -> DataFrame:
    """Paths added, removed or modified between two listings (path, checksum); empty = clean."""
    old = before.select("path", F.col("checksum").alias("old"))
    new = after.select("path", F.col("checksum").alias("new"))
    status = (
        F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").otherwise("modified")
    )
    return old.join(new, "path", "full_outer").where(~F.col("old").eqNullSafe(F.col("new"))).select(
        "path", status.alias("status")
    )


def table_fingerprint(df: DataFrame) -> DataFrame:
    """Content hash of a table that does not depend on the order of its rows."""
    return df.agg(*digest_sums(row_hash(*df.columns))).withColumn("fingerprint", digest_text())
