"""Readers of raw pair lines, instruction records and their manifest."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.functions.text import let
from tandem.settings import RECORD_FIELDS
from tandem.sources.files import outermost, owners, source_roots
from tandem.workspace import settle

RECORD_SCHEMA = ", ".join(f"{name} string" for name in RECORD_FIELDS)
MANIFEST_SCHEMA = "map<string, struct<path: string, checksum: string, domain: string>>"
# Where a line stands in its source: file, block of the file, position in the block.
LINE_ORDER = ["file_path", "block_start", "line_no"]


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text lines with their place of origin, in columns that order them as in the files."""
    return spark.read.option("recursiveFileLookup", "true").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_no"),
    )


def _side(document: Column, name: str) -> tuple[Column, Column]:
    """Text of one side ('' if missing) and whether the line is usable there."""
    field = F.try_variant_get(document, f"$.translation.{name}", "variant")
    kind = F.schema_of_variant(field)
    text = F.coalesce(F.try_variant_get(document, f"$.translation.{name}", "string"), F.lit(""))
    return text, F.coalesce(kind == "STRING", F.lit(True))


# A string, which stays as it is, or one of the numbers that are none, which JSON proper doesn't have but is written as.
_STRING_OR_NO_NUMBER = r'("[^"\\]*+(?:\\.[^"\\]*+)*+")|-?Infinity|NaN'


@contextmanager
def _last_key_wins(spark: SparkSession) -> Iterator[None]:
    """Where an object repeats a key, expressions built meanwhile take the last value."""
    name = "spark.sql.variant.allowDuplicateKeys"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _document(value: Column) -> Column:
    """The one JSON document on a line, as a variant: null for anything else, also for two documents or an unfinished one."""
    # The mark can't be in a valid line. It is set behind strings, too, and taken from there.
    marked = F.regexp_replace(value, _STRING_OR_NO_NUMBER, "$1\x01")
    numbers = F.replace(F.replace(marked, F.lit('"\x01'), F.lit('"')), F.lit("\x01"), F.lit("null"))
    odd = value.rlike("NaN|Infinity") & ~value.contains("\x01")
    # In brackets, what follows a document is seen as well.
    line = F.concat(F.lit("["), F.when(odd, numbers).otherwise(value), F.lit("]"))
    first = lambda array: F.when(F.try_variant_get(array, "$[1]", "variant").isNull(), F.try_variant_get(array, "$[0]", "variant"))
    return let(F.try_parse_json(line), first)


def parse_pairs(lines: DataFrame, value: str = "value") -> DataFrame:
    """Adds en and es; lines that are no JSON object, or hold other than text there, vanish.

    Of a repeated key the last value counts, and NaN and Infinity are numbers like others.
    """
    with _last_key_wins(lines.sparkSession):
        # The one-element `inline` keeps the optimizer from parsing anew in each filter and projection.
        document = F.struct(_document(F.col(value)).alias("_json"))
        parsed = lines.select("*", F.inline(F.array(document))).where(F.col("_json").isNotNull())
    inner = F.schema_of_variant(F.try_variant_get("_json", "$.translation", "variant"))
    usable = F.schema_of_variant("_json").startswith("OBJECT") & F.coalesce(inner.startswith("OBJECT"), F.lit(True))
    (en, en_ok), (es, es_ok) = _side(F.col("_json"), "en"), _side(F.col("_json"), "es")
    return parsed.where(usable & en_ok & es_ok).withColumns({"en": en, "es": es}).drop("_json", value)


def scan_bitext(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Tolerant read of nested pair lines: (en, es) and where each line stands."""
    return parse_pairs(read_lines(spark, path))


def scan_records(spark: SparkSession, path: str) -> DataFrame:
    """Flat record lines; blank lines are skipped, a malformed line fails the job."""
    return spark.read.schema(RECORD_SCHEMA).option("mode", "FAILFAST").json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A JSON manifest as rows (rank, name, path, checksum, domain), in file order.

    The file names the sources of a corpus: a few lines, read as one document.
    """
    document = spark.read.text(path, wholetext=True).select(F.from_json("value", MANIFEST_SCHEMA).alias("m"))
    return document.select(F.posexplode(F.map_entries("m")).alias("rank", "entry")).select(
        "rank", F.col("entry.key").alias("name"), "entry.value.*"
    )


def scan_manifest_sources(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """All sources of a manifest with their domain and rank, in one scan however many there are.

    Each file is given to the source whose path is the nearest at or above it, once per file, and its lines follow it.
    """
    roots = source_roots(spark, manifest.select("rank", "name", "path", "domain"))
    paths = outermost(roots)
    reader = spark.read.option("recursiveFileLookup", "true")
    listed = reader.format("binaryFile").load(paths).select("path", F.col("_metadata.file_path").alias("file_path"))
    # A row per file, of which the driver's own listing has as many.
    owned = settle(owners(listed, roots).select("file_path", F.col("name").alias("source"), F.col("rank").alias("source_rank"), "domain"), "source-files")
    return scan_bitext(spark, paths).join(owned, "file_path").select("source", "source_rank", "domain", *LINE_ORDER, "en", "es")


def uri_split(uri: Column) -> tuple[Column, Column]:
    """Bucket and prefix of a storage URI."""
    pattern = "^[A-Za-z][A-Za-z0-9+.-]*://([^/]*)/?(.*)$"
    return F.regexp_extract(uri, pattern, 1), F.regexp_extract(uri, pattern, 2)
