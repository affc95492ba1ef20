"""Shuffles of many small integers as packed blocks.

Map tasks cut their (key, value, ...) arrays into buckets by the key's high bits and send one binary block per bucket;
Spark moves each bucket to its own partition, where numpy sorts it. The number of buckets follows the data, so that a
partition stays bounded; keys are hashes, so buckets are even, and a key repeats at most once per document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PER_BUCKET = 3_000_000
FLUSH = 750_000
BLOCKS = "bucket int, block binary"


def bucket_count(df: DataFrame, items: float) -> int:
    """Buckets for so many items; never fewer than the session's shuffle partitions."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(items // PER_BUCKET) + 1)


def text_size(df: DataFrame, name: str = "text") -> int:
    """Bytes of all texts, by one scan."""
    return df.agg(F.coalesce(F.sum(F.octet_length(name)), F.lit(0)).alias("n")).first()["n"]


class Outbox:
    """Collects arrays of equal length, the key first, and gives them back as blocks by bucket."""

    def __init__(self, buckets: int, dtypes: tuple[str, ...], flush: int = FLUSH):
        self.buckets, self.dtypes, self.flush = buckets, [np.dtype(d) for d in dtypes], flush
        self.parts, self.held = [], 0

    def add(self, *columns) -> Iterator[pa.RecordBatch]:
        if len(columns[0]):
            self.parts.append(columns)
            self.held += len(columns[0])
        if self.held >= self.flush:
            yield from self.drain()

    def drain(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        columns = [np.concatenate(c).astype(d, copy=False) for c, d in zip(zip(*self.parts, strict=True), self.dtypes, strict=True)]
        self.parts, self.held = [], 0
        # Order by the whole key: equal keys stand together, and sorted values compress better.
        order = np.argsort(columns[0], kind="stable")
        columns = [c[order] for c in columns]
        bucket = ((columns[0] >> np.uint64(32)) * np.uint64(self.buckets)) >> np.uint64(32)
        edges = np.searchsorted(bucket, np.arange(self.buckets + 1))
        numbers, blocks = [], []
        for b in range(self.buckets):
            i, j = edges[b], edges[b + 1]
            if i < j:
                numbers.append(b)
                blocks.append(block_of([c[i:j] for c in columns]))
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(blocks, pa.binary())], ["bucket", "block"])


def block_of(columns: list[np.ndarray]) -> bytes:
    """Columns of equal length, the first ascending, as bytes that compress well: differences of the first, and of each
    column all first bytes, then all second ones, and so on."""
    first = np.diff(columns[0], prepend=columns[0].dtype.type(0))
    return b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T.tobytes() for c in (first, *columns[1:]))


def unpack(block: bytes, dtypes: tuple[str, ...]) -> list[np.ndarray]:
    types = [np.dtype(d) for d in dtypes]
    n = len(block) // sum(d.itemsize for d in types)
    out, at = [], 0
    for d in types:
        planes = np.frombuffer(block, np.uint8, n * d.itemsize, at).reshape(d.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(d).ravel())
        at += n * d.itemsize
    out[0] = np.cumsum(out[0], dtype=types[0])
    return out


def send_blocks(df: DataFrame, send: Callable[[Iterator[pa.RecordBatch], Outbox], Iterator[pa.RecordBatch]], dtypes: tuple[str, ...], buckets: int) -> DataFrame:
    """Blocks by bucket; `send` fills the outbox."""

    def pack(batches):
        box = Outbox(buckets, dtypes)
        yield from send(batches, box)
        yield from box.drain()

    return df.mapInArrow(pack, BLOCKS)


def receive_blocks(blocks: DataFrame, receive: Callable[[list[np.ndarray]], Iterator[pa.RecordBatch]], dtypes: tuple[str, ...], buckets: int, schema: str) -> DataFrame:
    """Rows that `receive` makes of all arrays of a bucket, sorted by key."""

    def gather(batches):
        parts = [unpack(x, dtypes) for batch in batches for x in batch.column("block").to_pylist()]
        if parts:
            columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
            parts.clear()
            order = np.argsort(columns[0], kind="stable")
            yield from receive([c[order] for c in columns])

    return blocks.repartitionById(buckets, "bucket").mapInArrow(gather, schema)


def forward_blocks(
    blocks: DataFrame, turn: Callable[[list[np.ndarray]], Iterator[tuple]], dtypes: tuple[str, ...], onward: tuple[str, ...], buckets: int
) -> DataFrame:
    """Blocks by another key: `turn` gives arrays, the new key first, for all arrays of a bucket. Results for a document
    come from many buckets; this way they go back to it packed, and not as a row from each."""

    def receive(columns):
        box = Outbox(buckets, onward)
        for arrays in turn(columns):
            yield from box.add(*arrays)
        yield from box.drain()

    return receive_blocks(blocks, receive, dtypes, buckets, BLOCKS)


def runs(keys: np.ndarray) -> np.ndarray:
    """Edges of the runs of equal values in a sorted array: starts, then its length."""
    return np.append(np.flatnonzero(np.append(True, keys[1:] != keys[:-1])), len(keys)) if len(keys) else np.zeros(1, np.int64)


def rows(columns: list, schema: list[tuple[str, pa.DataType]], size: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Record batches of bounded length from whole columns."""
    for i in range(0, len(columns[0]), size):
        yield pa.RecordBatch.from_arrays([pa.array(c[i : i + size], t) for c, (_, t) in zip(columns, schema, strict=True)], [n for n, _ in schema])
