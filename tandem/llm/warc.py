"""WARC archives whose repeated payloads are revisit records."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "urn:page:"
LENGTH = "X-Payload-Length"
LEAST_BYTES = 1000
RECORDS_PER_FILE = 20_000
CHUNK, BATCH_BYTES = 1 << 20, 8 << 20

RECORD = "record_type string, page_id bigint, target_uri string, payload_digest string, payload_bytes bigint, refers_to bigint"


def _header(name: str, value: Column) -> Column:
    """One header line; nothing for null. Line ends in a value would end the header, so they are percent-encoded."""
    clean = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def write_archives(records: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Writes one record per row of (record_type, page_id, target_uri, payload_digest, payload_bytes, refers_to, payload).

    Files are gzip archives of up to RECORDS_PER_FILE records, in Spark's committed way, so a lost executor leaves none
    half written. Payloads are bytes and go in as they are; a revisit has none. A null page_id or uri leaves its value out.
    """
    name = lambda c: F.concat(F.lit(f"<{ID}"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    revisit = F.col("record_type") == "revisit"
    body = F.when(revisit, F.lit("").cast("binary")).otherwise(F.coalesce("payload", F.lit("").cast("binary")))
    lines = [
        F.lit(f"{VERSION}\r\n"),
        _header("WARC-Type", F.col("record_type")),
        _header("WARC-Record-ID", name("page_id")),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", F.col("target_uri")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _header(LENGTH, F.col("payload_bytes")),
        _header("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _header("WARC-Refers-To", F.when(revisit, name("refers_to"))),
        _header("Content-Type", F.lit("text/html")),
        _header("Content-Length", F.octet_length(body)),
        F.lit("\r\n"),
    ]
    # The writer ends each row with one line end, which makes the two that end a record.
    value = F.concat(F.concat(*lines).cast("binary"), body, F.lit("\r\n").cast("binary")).cast("string")
    out = records.select(value.alias("value")).write.option("lineSep", "\r\n").option("compression", "gzip")
    out.option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of each record of a gzip or plain archive, by Content-Length, in order."""
    buffer, at, ended = bytearray(), 0, False
    source = _inflated(content)

    def fill(size: int) -> bool:
        nonlocal ended
        while not ended and len(buffer) - at < size:
            if (part := next(source, None)) is None:
                ended = True
            else:
                buffer.extend(part)
        return len(buffer) - at >= size

    while True:
        end, seen = -1, at
        while (end := buffer.find(b"\r\n\r\n", max(at, seen - 3))) < 0:
            seen = len(buffer)
            if not fill(len(buffer) - at + 1):
                break
        if end < 0:
            if buffer[at:].strip():
                raise ValueError("an archive ends within a record's headers")
            return
        lines = buffer[at:end].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record where one should begin: {lines[0][:40]!r}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(headers["content-length"])
        at = end + 4
        if not fill(size + 4):
            raise ValueError("an archive ends within a record's block")
        yield headers, bytes(buffer[at : at + size])
        at += size + 4
        if at > CHUNK:
            del buffer[:at]
            at = 0


def _inflated(content: bytes) -> Iterator[bytes]:
    """Pieces of the plain bytes; gzip members may follow one another."""
    if content[:2] != b"\x1f\x8b":
        yield from (content[i : i + CHUNK] for i in range(0, len(content), CHUNK))
        return
    engine, rest = zlib.decompressobj(31), content
    while rest:
        if part := engine.decompress(rest, CHUNK):
            yield part
        rest = engine.unconsumed_tail
        if engine.eof:
            rest, engine = engine.unused_data, zlib.decompressobj(31)


def _number(value: str | None) -> int | None:
    found = re.fullmatch(rf"<{ID}(-?\d+)>", value or "")
    return int(found[1]) if found else None


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records under `path`, with `payload` if asked for.

    Digest and length of a response are taken from its block, those of a revisit from its headers. A response whose block
    does not match the digest in its headers is an error.
    """

    def run(batches):
        for batch in batches:
            for content in batch.column("content").to_pylist():
                out, size = [], 0
                for headers, block in parse(content):
                    told = headers.get("warc-payload-digest", "").removeprefix("sha1:")
                    if headers.get("warc-type") == "revisit":
                        digest, length = told, int(headers[LENGTH.lower()])
                    else:
                        digest, length = hashlib.sha1(block).hexdigest(), len(block)
                        if told and told != digest:
                            raise ValueError(f"payload of {headers.get('warc-record-id')} does not match its digest")
                    row = [headers.get("warc-type"), _number(headers.get("warc-record-id")), headers.get("warc-target-uri"), digest, length]
                    out.append([*row, _number(headers.get("warc-refers-to")), *([block] if payload else [])])
                    size += len(block) * payload + 200
                    if size > BATCH_BYTES:
                        yield batch_of(out)
                        out, size = [], 0
                if out:
                    yield batch_of(out)

    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
    schema = RECORD + ", payload binary" * payload
    names = [x.split()[0] for x in schema.split(", ")]

    def batch_of(out):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=False)], names)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInArrow(run, schema)


def resolve(headers: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """`digest` and `original`, the largest page_id of the responses with that payload digest, where there are several
    records with the payload and it has `least` bytes or more. Only headers are shuffled, combined on the map side."""
    equal = headers.where(F.col("payload_bytes") >= least).groupBy(F.col("payload_digest").alias("digest"))
    return equal.agg(F.max("page_id").alias("original"), F.count("*").alias("size")).where("size > 1 and original is not null").drop("size")


def deduplicate(spark: SparkSession, source: str, target: str, least: int = LEAST_BYTES) -> None:
    """Reads the archives under `source` and writes them to `target` with fresh headers: of records with equal payloads of
    `least` bytes or more, the one with the largest page_id is a response and the others revisit it.

    Records already revisits in `source` are resolved by their digest like the rest, and keep pointing at their original
    where the archive does not hold one. Rows that repeat the largest id are responses all.
    """
    originals = resolve(read_archives(spark, source, payload=False), least)
    records = read_archives(spark, source)
    joined = records.join(originals, F.col("payload_digest") == F.col("digest"), "left")
    again = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    fresh = joined.withColumn("refers_to", F.when(again, F.col("original")).when(F.col("record_type") == "revisit", F.col("refers_to")))
    fresh = fresh.withColumn("record_type", F.when(again, F.lit("revisit")).otherwise(F.col("record_type")))
    write_archives(fresh.drop("digest", "original"), target)


def as_responses(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One response per page; the payload is the html in UTF-8, empty for null."""
    body = F.coalesce(F.col(html), F.lit("")).cast("binary")
    return pages.select(
        F.lit("response").alias("record_type"), F.col(id).cast("bigint").alias("page_id"), F.col(url).alias("target_uri"), F.sha1(body).alias("payload_digest"),
        F.octet_length(body).cast("bigint").alias("payload_bytes"), F.lit(None).cast("bigint").alias("refers_to"), body.alias("payload"),
    )
