"""Exact running positions and cut points for groups of any size."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tandem.workspace import settle

#: Rows of a cell: what a window holds at most.
CELL_BITS = 12
#: Rows among which a cut point is looked for by sorting.
LAST_ROWS = 65_536
#: Digits of a key: of its first half, which copies share, and in all.
HALF, WHOLE = 32, 64
#: Copies of a small table of cuts, by the first two digits of the key that is compared with them.
CUT_CELLS = 256


def _same(keys: list[str], other: str = "_of_") -> Column:
    """Equal keys, nulls included."""
    test = F.lit(True)
    for key in keys:
        test = test & F.col(key).eqNullSafe(F.col(f"{other}{key}"))
    return test


def _renamed(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumnsRenamed({key: f"_of_{key}" for key in keys})


def running_total(df: DataFrame, by: list[str], order: list[Column | str], name: str, weight: Column | None = None) -> DataFrame:
    """Running sum of `weight` (of 1: the row number) over `by` in `order`, ending at each row.

    Rows are sorted by ranges over all groups, so that a hot group is spread, and written; a row's place in its range is then
    fixed. Totals of the ranges before come from one row per group and range. Weights are summed up in cells of 4,096
    successive rows, from the totals of the cells before in the range: no window holds more than a cell's rows, a range's
    cells or a group's ranges. Null groups are groups of their own. Rows with equal order stand in the order of their hash.
    """
    ties = [f.name for f in df.schema if f.dataType.typeName() not in ("map", "variant")]
    keys = [*by, *order, F.xxhash64(*(F.col(f"`{c}`") for c in ties))]
    rows = df if weight is None else df.withColumn("_weight", weight.cast("bigint"))
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    placed = settle(placed, "ranges").withColumn("_range", F.shiftright("_at", 33))
    if weight is None:
        ranges = placed.groupBy(*by, "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_total"))
        ranges = ranges.select(*by, "_range", (_before(by, "_range") - F.col("_first") + 1).alias("_offset"))
        at = [*by, "_range"]
        numbered = placed.join(_renamed(ranges, at), _same(at)).withColumn(name, F.col("_at") + F.col("_offset"))
        return numbered.drop("_at", "_range", "_offset", *(f"_of_{key}" for key in at))
    placed = placed.withColumn("_cell", F.shiftright("_at", CELL_BITS))
    cells = settle(placed.groupBy(*by, "_range", "_cell").agg(F.sum("_weight").alias("_total")), "cells")
    ranges = cells.groupBy(*by, "_range").agg(F.sum("_total").alias("_total")).select(*by, "_range", _before(by, "_range").alias("_in_ranges"))
    cells = cells.select(*by, "_range", "_cell", _before([*by, "_range"], "_cell").alias("_in_cells"))
    at = [*by, "_range"]
    offsets = cells.join(_renamed(ranges, at), _same(at)).select(*by, "_cell", (F.col("_in_ranges") + F.col("_in_cells")).alias("_offset"))
    at = [*by, "_cell"]
    inside = Window.partitionBy(*at).orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = placed.join(_renamed(offsets, at), _same(at)).withColumn(name, F.col("_offset") + F.sum("_weight").over(inside))
    return summed.drop("_at", "_range", "_cell", "_weight", "_offset", *(f"_of_{key}" for key in at))


def _before(by: list[str], order: str) -> Column:
    """Sum of `_total` over the earlier rows."""
    return F.coalesce(F.sum("_total").over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


# ---------------------------------------------------------------- cut points


def _cut_rows(counts: DataFrame) -> DataFrame:
    """Of the counted prefixes, the one that holds each cut point; `before` rows come before it."""
    upto = F.col("before") + F.sum("n").over(Window.partitionBy("group", "cut").orderBy("prefix"))
    located = counts.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("n"))
    inside = (F.col("before") < F.col("target")) & (F.col("target") <= F.col("upto"))
    return located.where(inside).select("group", "cut", "target", "prefix", "before", "n")


def _settled_cuts(counts: DataFrame) -> tuple[DataFrame, int]:
    """The located prefixes, and the rows of the largest, counted while they are written."""
    largest = Observation()
    cuts = settle(_cut_rows(counts).observe(largest, F.max("n").alias("n")), "cuts")
    return cuts, largest.get["n"] or 0


def locate(rows: DataFrame, ends: Callable[[Column], Column]) -> DataFrame:
    """(group, cut, target, key, before) of rows (group, key): the key of the target-th row of its group in the order of
    keys, and how many rows have smaller ones. `ends` makes an array of (cut, target) of a group's size; targets below 1
    have no row.

    Nothing is sorted but the few rows around a cut. Counts per key prefix tell which prefix holds a cut point, and only
    rows with it are looked at again. Keys are 64 hexadecimal digits that are spread evenly; copies may share the first 32.
    How many digits are counted next follows from the rows left, so two scans do for groups up to 10^8 rows, and each two
    more digits for a group 256 times as large. Only the size of the largest cell reaches the driver.
    """
    prefix = lambda digits: F.substring("key", 1, digits)
    digits = 3
    counts = rows.groupBy("group", prefix(digits).alias("prefix")).agg(F.count("*").alias("n"))
    counts = counts.withColumn("size", F.sum("n").over(Window.partitionBy("group")))
    cuts, largest = _settled_cuts(counts.select("group", "prefix", "n", F.lit(0).cast("bigint").alias("before"), F.inline(ends(F.col("size")))))
    before = math.inf
    while largest > LAST_ROWS and digits < WHOLE:
        more = min(5, max(2, math.ceil(math.log(largest / LAST_ROWS, 16)) + 1))
        # Digits that leave most rows together are those of copies, which only the second half tells apart.
        copies = digits < HALF and largest > before / 2
        near, digits = digits, min(WHOLE, HALF + more if copies else digits + more)
        known = cuts.select("group", "cut", "target", "before", F.col("prefix").alias("near"))
        counts = rows.withColumn("near", prefix(near)).join(known, ["group", "near"])
        counts = counts.groupBy("group", "cut", "target", "before", prefix(digits).alias("prefix")).agg(F.count("*").alias("n"))
        before = largest
        cuts, largest = _settled_cuts(counts)
    known = cuts.select("group", "cut", "target", "before", F.col("prefix").alias("near"))
    within = Window.partitionBy("group", "cut").orderBy("key")
    around = rows.withColumn("near", prefix(digits)).join(known, ["group", "near"])
    around = around.groupBy("group", "cut", "target", "before", "key").agg(F.count("*").alias("n")).withColumn("upto", F.col("before") + F.sum("n").over(within))
    found = around.where((F.col("upto") - F.col("n") < F.col("target")) & (F.col("target") <= F.col("upto")))
    return found.select("group", "cut", "target", "key", (F.col("upto") - F.col("n")).alias("before"))


def beside_cuts(rows: DataFrame, group: Column, key: str, cuts: DataFrame) -> DataFrame:
    """Each row with the columns of its group's row in `cuts` (group, ...); null if it has none.

    The cuts are repeated for the first two digits of the key, so that a hot group is spread where Spark shuffles.
    """
    cells = F.explode(F.transform(F.sequence(F.lit(0), F.lit(CUT_CELLS - 1)), lambda i: F.lower(F.lpad(F.hex(i), 2, "0")))).alias("_digits")
    dealt = settle(cuts.select("*", cells), "cut-cells").withColumnsRenamed({"group": "_group", "_digits": "_cut_digits"})
    keyed = rows.withColumns({"_of_group": group, "_digits": F.substring(key, 1, 2)})
    return keyed.join(dealt, (F.col("_of_group") == F.col("_group")) & (F.col("_digits") == F.col("_cut_digits")), "left").drop("_of_group", "_group", "_digits", "_cut_digits")


def up_to_cut(rows: DataFrame, by: list[str], key: str, n: int) -> DataFrame:
    """The rows of each group up to its n-th key, with `_last` (that key) and `_left` (how many rows with it belong to the n)."""
    group = F.struct(*by) if by else F.lit(1)
    head = lambda size: F.array(F.struct(F.lit("head").alias("cut"), F.least(F.lit(n).cast("bigint"), size).alias("target")))
    cuts = locate(rows.select(group.alias("group"), F.col(key).alias("key")), head)
    cuts = cuts.select("group", F.col("key").alias("_last"), (F.col("target") - F.col("before")).alias("_left"))
    return beside_cuts(rows, group, key, cuts).where(F.col(key) <= F.col("_last"))


def first_rows(rows: DataFrame, by: list[str], order: list[str], n: int) -> DataFrame:
    """The first n rows of each group (of all rows, if `by` is empty) by `order`, which begins with a shuffle key.

    The n-th key is located first, and a filter leaves the rows up to it, wherever they are; only rows that share a key
    meet, so that those beyond n go.
    """
    key = order[0]
    number = F.row_number().over(Window.partitionBy(*by, key).orderBy(*order))
    near = up_to_cut(rows, by, key, n).withColumn("_number", number)
    return near.where((F.col(key) < F.col("_last")) | (F.col("_number") <= F.col("_left"))).drop("_last", "_left", "_number")
