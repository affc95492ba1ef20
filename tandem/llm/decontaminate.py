"""Benchmark passages in documents, by the q-gram lemma over diagonal bands.

A passage with at most k edits of an item of m characters keeps m - q + 1 - k * q of its q-grams, and these lie on
k + 1 neighbouring diagonals (document position minus item position). Diagonals are cut into bands of 2 (k + 1) that
overlap by half, so one band holds them all. Bands with too few shared q-grams are passed over; the rest are regions of
about the item's length, which a banded alignment decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tandem.llm.words import small


Q = 10
TABLE_BITS = 22
REGION = T.StructType(
    [T.StructField("item_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("edits", T.LongType())]
)
REGION_ARROW = pa.list_(pa.struct([(n, pa.int64()) for n in ("item_id", "start", "end", "edits")]))


@dataclass(frozen=True)
class Search:
    """Items of fewer than `min_chars` normalised characters are too short to be evidence and are not searched.
    `rate` is the share of an item's characters that may be edited. Items are searched in blocks of `block_chars`."""

    rate: float = 0.06
    min_chars: int = 25
    block_chars: int = 4_000_000

    def budget(self, m: int) -> int:
        return min(int(self.rate * m), (m - Q) // Q)

    def least(self, m: int) -> int:
        return m - Q + 1 - self.budget(m) * Q


def normal(text: str) -> str:
    """Lower case, with single spaces."""
    return " ".join(text.lower().split())


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(chars: np.ndarray) -> np.ndarray:
    """Hash of the Q characters from each position, by doubling: 2, 4, 8, then the last two."""
    if len(chars) < Q:
        return np.empty(0, np.uint64)
    one = chars.astype(np.uint64)
    two = one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:]
    four = two[:-2] * np.uint64(0xC2B2AE3D27D4EB4F) + two[2:]
    eight = four[:-4] * np.uint64(0xD6E8FEB86659FD93) + four[4:]
    return (eight[:-2] * np.uint64(0xA0761D6478BD642F) + two[8:]) * np.uint64(0xE7037ED1A0B428DB)


class Index:
    """The q-grams of a block of items: a table of bits to pass most of the text by, and sorted postings."""

    def __init__(self, items: list[tuple[int, str]], search: Search):
        self.items = [(i, t, code_points(t)) for i, t in items]
        self.budget = np.array([search.budget(len(c)) for _, _, c in self.items], np.int64)
        self.least = np.array([search.least(len(c)) for _, _, c in self.items], np.int64)
        grams = [gram_hashes(c) for _, _, c in self.items]
        hashes = np.concatenate(grams)
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.item = np.concatenate([np.full(len(g), k) for k, g in enumerate(grams)])[order]
        self.position = np.concatenate([np.arange(len(g)) for g in grams])[order]
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[self._cell(self.hashes)] = True
        self.fewest = int(self.least.min())

    @staticmethod
    def _cell(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def regions(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, start, end, edits) in the normalised text; overlapping bands that find one end report it once."""
        chars = code_points(text)
        grams = gram_hashes(chars)
        at = np.flatnonzero(self.table[self._cell(grams)])
        if len(at) < self.fewest:
            return []
        low, high = np.searchsorted(self.hashes, grams[at], "left"), np.searchsorted(self.hashes, grams[at], "right")
        count = high - low
        if count.sum() < self.fewest:
            return []
        which = np.repeat(low - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        item, diagonal = self.item[which], np.repeat(at, count) - self.position[which]
        # Band b covers the diagonals from b (k + 1) to (b + 2) (k + 1).
        step = self.budget[item] + 1
        band = diagonal // step
        item, band = np.concatenate([item, item]), np.concatenate([band, band - 1])
        key, number = np.unique(item * (1 << 40) + (band + (1 << 20)), return_counts=True)
        item, band = key >> 40, (key & ((1 << 40) - 1)) - (1 << 20)
        found = {}
        for k, b in zip(*(x[number >= self.least[item]].tolist() for x in (item, band)), strict=True):
            item_id, pattern, codes = self.items[k]
            k_edits = int(self.budget[k])
            if hit := align(pattern, codes, text, chars, b * (k_edits + 1), k_edits):
                start, end, edits = hit
                if (old := found.get((item_id, end))) is None or edits < old[3]:
                    found[item_id, end] = (item_id, start, end, edits)
        return sorted(found.values())


def align(pattern: str, codes: np.ndarray, text: str, chars: np.ndarray, low: int, budget: int) -> tuple[int, int, int] | None:
    """(start, end, edits) of the best alignment of the whole pattern that begins on one of 2 (budget + 1) diagonals from `low`
    and strays by `budget` at most; None beyond the budget. Ties go to the earliest end. Null starts are lower bounds:
    the start is end minus the pattern's length for inexact hits, moved into the text."""
    m, width = len(codes), 2 * (budget + 1)
    at = text.find(pattern, max(0, low), max(0, low + width + m))
    if at >= 0:
        return at, at + m, 0
    first, size = low - budget, width + 2 * budget
    # cost[d]: edits of the pattern's first i characters against the text up to position first + d + i.
    offset = np.arange(size)
    padded = np.full(m + size, 0xFFFFFFFF, np.uint32)
    begin, end = max(0, first), min(len(chars), first + m + size)
    if end > begin:
        padded[begin - first : end - first] = chars[begin:end]
    # A start before the text is worthless; one before or beyond the band's own diagonals is no start.
    cost = np.where((offset >= budget) & (offset < budget + width) & (first + offset >= 0) & (first + offset <= len(chars)), 0, m + 1)
    for i in range(m):
        step = cost + (padded[i : i + size] != codes[i])
        step[:-1] = np.minimum(step[:-1], cost[1:] + 1)
        cost = np.minimum.accumulate(step - offset) + offset
    ends = first + offset + m
    cost = np.where((ends >= 0) & (ends <= len(chars)), cost, m + 1)
    best = int(np.argmin(cost))
    if cost[best] > budget:
        return None
    return max(0, int(ends[best]) - m), int(ends[best]), int(cost[best])


def blocks(benchmark: DataFrame, search: Search, id: str, text: str) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size; null ids or texts and items that are too short are left out."""
    held, size = [], 0
    items = benchmark.select(F.col(id).cast("bigint").alias("i"), F.col(text).alias("t")).where("i is not null and t is not null").distinct()
    for row in items.toLocalIterator():
        if len(t := normal(row["t"])) >= search.min_chars:
            held.append((row["i"], t))
            size += len(t)
        if size >= search.block_chars:
            yield held
            held, size = [], 0
    if held:
        yield held


def find_passages(
    docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...], search: Search = Search(), text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """The columns `keep` and `regions`, an array of (item_id, start, end, edits) in the normalised text, by item and end.

    Each block of items is one pass of the texts through the executors, without a shuffle; what goes to an executor is
    a block's index and no more. Null and empty texts have no regions; repeated rows are searched each. A region's start
    is exact where it has no edits, else its end minus the item's length.
    """
    found = docs.select(F.struct(*keep).alias("_kept"), F.coalesce(F.col(text), F.lit("")).alias("_text"), F.array().cast(T.ArrayType(REGION)).alias("_regions"))
    schema = found.schema

    def search_in(items):
        def run(batches):
            index = Index(items, search)
            for batch in small(batches):
                texts, old = batch.column("_text").to_pylist(), batch.column("_regions").to_pylist()
                new = [[dict(zip(("item_id", "start", "end", "edits"), r, strict=True)) for r in index.regions(normal(t))] for t in texts]
                both = pa.array([(a or []) + b for a, b in zip(old, new, strict=True)], REGION_ARROW)
                yield pa.RecordBatch.from_arrays([batch.column("_kept"), batch.column("_text"), both], ["_kept", "_text", "_regions"])

        return run

    for items in blocks(benchmark, search, item_id, item_text):
        found = found.mapInArrow(search_in(items), schema)
    return found.select("_kept.*", F.array_sort("_regions").alias("regions"))


