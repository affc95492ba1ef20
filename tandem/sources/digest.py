"""Checksums of bytes that are taken in pieces, in any cut, and put together in order.

A piece is a number in base 256, modulo two primes, beside the power of 256 that its length shifts by. Of two pieces in
order, the whole is the first one shifted by the second one's length, plus the second. So files are read in blocks by all
tasks, and neither the blocks nor the cut of a dataset into files has a part in the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Halves of these primes less one are primes too, so powers of 256 don't repeat within any real length.
PRIMES = (2**62 - 10565, 2**62 - 11585)
MODULUS = PRIMES[0] * PRIMES[1]
PIECE = "bytes bigint, value array<bigint>, shift array<bigint>"


def line_pieces(lines: DataFrame) -> DataFrame:
    """A piece per (file, block) of lines (file, block, value binary), each line with its line feed. Rows of a block stand
    together and in order in one task, as the text reader gives them."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, size, value = None, 0, 0

        def piece():
            parts = [[x % p for p in PRIMES] for x in (value, pow(256, size, MODULUS))]
            columns = [pa.array([x], pa.int64()) for x in (*key, size)] + [pa.array([x], pa.list_(pa.int64())) for x in parts]
            return pa.RecordBatch.from_arrays(columns, ["file", "block", "bytes", "value", "shift"])

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("file", "block")], axis=1)
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for i, j in zip(edges, edges[1:], strict=False):
                if i == j:
                    continue
                if key is not None and key != tuple(keys[i].tolist()):
                    yield piece()
                    size, value = 0, 0
                key = tuple(keys[i].tolist())
                data = b"\n".join(batch.column("value").slice(i, j - i).to_pylist()) + b"\n"
                value = (value * pow(256, len(data), MODULUS) + int.from_bytes(data)) % MODULUS
                size += len(data)
        if key is not None:
            yield piece()

    return lines.mapInArrow(digest, f"file bigint, block bigint, {PIECE}")


def _product(a: Column, b: Column, prime: int) -> Column:
    """a * b modulo the prime: 124 bits, which a decimal holds."""
    wide = lambda c: c.cast("decimal(19,0)")
    return (wide(a) * wide(b) % F.lit(prime).cast("decimal(19,0)")).cast("bigint")


def _sum(a: Column, b: Column, prime: int) -> Column:
    return F.when(a >= F.lit(prime) - b, a - (F.lit(prime) - b)).otherwise(a + b)


def _each(make) -> Column:
    return F.array(*(make(k, p) for k, p in enumerate(PRIMES)))


def together(pieces: Column) -> Column:
    """(value, shift) of an array of pieces in order."""
    one = lambda n: F.array(*(F.lit(n).cast("bigint") for _ in PRIMES))
    return F.aggregate(
        pieces,
        F.struct(one(0).alias("value"), one(1).alias("shift")),
        lambda a, x: F.struct(
            _each(lambda k, p: _sum(_product(a["value"][k], x["shift"][k], p), x["value"][k], p)).alias("value"),
            _each(lambda k, p: _product(a["shift"][k], x["shift"][k], p)).alias("shift"),
        ),
    )


def without_last_line_feed(piece: Column) -> Column:
    back = [pow(256, -1, p) for p in PRIMES]
    return F.struct(
        _each(lambda k, p: _product(_sum(piece["value"][k], F.lit(p - 10), p), F.lit(back[k]), p)).alias("value"),
        _each(lambda k, p: _product(piece["shift"][k], F.lit(back[k]), p)).alias("shift"),
    )


def checksum(piece: Column) -> Column:
    """32 hexadecimal digits. The bytes count as if a 1 stood before them, so that leading zero bytes have their part."""
    return F.lower(F.concat(*(F.lpad(F.hex(_sum(piece["value"][k], piece["shift"][k], p)), 16, "0") for k, p in enumerate(PRIMES))))


def checksum_of(data: bytes) -> str:
    """The same for bytes at hand."""
    return "".join(f"{int.from_bytes(b'\x01' + data) % p:016x}" for p in PRIMES)
