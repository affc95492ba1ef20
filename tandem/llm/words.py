"""Words of a text and their hashes, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

MEMO_WORDS = 200_000
ROWS = 512
# Words hashed at once: their arrays stay in the processor's cache.
WORDS = 1 << 16
BATCH_BYTES = 4 << 20
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
ODD = np.array(
    [(0x9E3779B97F4A7C15 * (2 * i + 1) + 0xD1B54A32D192ED03 * i * i * 2) % 2**64 | 1 for i in range(128)], dtype=np.uint64
)


def text_bytes(name: str = "text") -> Column:
    """The whole text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(name), F.lit("")).cast("binary")


def bounded_batches(spark: SparkSession) -> None:
    """Lowers the session's bytes per Arrow batch to BATCH_BYTES, if they are more: a worker then holds few texts at a time
    however long they are. The setting stays, since results are computed after the call that builds them."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(name).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of ROWS rows, so that few texts at a time become Python values."""
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS):
            yield batch.slice(i, ROWS)


class WordHashes(dict):
    """64-bit hash per word, remembered for up to MEMO_WORDS words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _fold(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lower half of the 128-bit products, exclusive or their upper half."""
    half, low = np.uint64(32), np.uint64(0xFFFFFFFF)
    x, y, z, w = a >> half, a & low, b >> half, b & low
    cross, other = y * z, x * w
    carry = ((y * w) >> half) + (cross & low) + (other & low)
    return (a * b) ^ (x * z + (cross >> half) + (other >> half) + (carry >> half))


def hashes_at(data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """What `WordHashes` gives for the words `data[edges[i]:edges[i + 1]]`, none empty: XXH3 of all short ones at once."""
    u = np.uint64
    padded = np.concatenate([np.zeros(8, np.uint8), data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
    size = np.diff(edges)
    first, last = eight[edges[:-1] + 8], eight[edges[1:]]
    out = np.empty(len(size), np.uint64)

    at = np.flatnonzero(size < 4)
    n, x = size[at].astype(np.uint64), first[at]
    h = ((x & u(255)) << u(16)) | (((x >> ((n >> u(1)) << u(3))) & u(255)) << u(24)) | (last[at] >> u(56)) | (n << u(8))
    h ^= u(0x87275A9B)
    h = (h ^ (h >> u(33))) * u(0xC2B2AE3D27D4EB4F)
    h = (h ^ (h >> u(29))) * u(0x165667B19E3779F9)
    out[at] = h ^ (h >> u(32))

    at = np.flatnonzero((size >= 4) & (size <= 8))
    h = ((last[at] >> u(32)) + (first[at] << u(32))) ^ u(0xC73AB174C5ECD5A2)
    h ^= ((h << u(49)) | (h >> u(15))) ^ ((h << u(24)) | (h >> u(40)))
    h *= u(0x9FB21C651E98DF25)
    h = (h ^ ((h >> u(35)) + size[at].astype(np.uint64))) * u(0x9FB21C651E98DF25)
    out[at] = h ^ (h >> u(28))

    at = np.flatnonzero((size > 8) & (size <= 16))
    x, y = first[at] ^ u(0x6782737BEA4239B9), last[at] ^ u(0xAF56BC3B0996523A)
    h = size[at].astype(np.uint64) + x.byteswap() + y + _fold(x, y)
    h = (h ^ (h >> u(37))) * u(0x165667919E3779F9)
    out[at] = h ^ (h >> u(32))

    for i in np.flatnonzero(size > 16).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[edges[i] : edges[i + 1]])
    return out


def hashed_texts(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """The batches in slices of at most ROWS rows and about BATCH_BYTES of text, each with the hashes of the lower-cased words
    of its texts, one text after the other, and the edges of the texts among them."""
    for batch in small(batches):
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        cuts = [0, *np.flatnonzero(np.diff(ends // BATCH_BYTES)) + 1, batch.num_rows]
        for i, j in zip(cuts, cuts[1:], strict=False):
            part = batch.slice(i, j - i)
            # A view: bytes that are not UTF-8 pass, and letters beyond ASCII stay.
            found = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(part.column(column), b"").view(pa.string())))
            words = found.flatten()
            edges = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64) if len(words) else np.zeros(1, np.int64)
            data = np.frombuffer(words.buffers()[2], np.uint8) if edges[-1] else np.empty(0, np.uint8)
            # Blanks at either end of a text make empty words.
            real = np.diff(edges) > 0
            texts = np.append(0, np.cumsum(real))[found.offsets.to_numpy()]
            edges = edges[np.append(real, True)]
            hashes = [hashes_at(data[e[0] : e[-1]], e - e[0]) for e in (edges[k : k + WORDS + 1] for k in range(0, len(edges) - 1, WORDS))]
            yield part, np.concatenate([np.empty(0, np.uint64), *hashes]), texts


def split_words(text: bytes, lower: bool = False) -> list[bytes]:
    """Maximal runs without space, tab, line feed, vertical tab, form feed and return: bytes.split() to the letter."""
    return (text.translate(LOWER) if lower else text).split()


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche of 64-bit values (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(words: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of `size` words, in order; empty if there are fewer words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.full(n, ODD[(seed * 7 + size) % len(ODD)], np.uint64)
    for i in range(size):
        total += words[i : i + n] * ODD[(i + 31 * seed) % len(ODD)]
    return mix(total)


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of n positions lie in a run of `size` beginning at one of `starts`."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + size, -1)
    return np.cumsum(edges[:-1]) > 0
