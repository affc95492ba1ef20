"""Heads, samples, packed windows, length batches and oversampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tandem.functions.records import render_prompt
from tandem.operators.ranking import first_rows, running_total
from tandem.settings import Rules


def row_hash() -> Column:
    """The half of the shuffle key that differs between copies: spreads any group evenly."""
    return F.substring("shuffle_key", 33, 32)


def head_sample(records: DataFrame, order: list[str], n: int) -> DataFrame:
    """First n records in a stable order, which begins with the shuffle key. No task holds more of them than others."""
    return first_rows(records, [], order, n).orderBy(*order)


def head_per_group(records: DataFrame, by: list[str], order: list[str], n: int) -> DataFrame:
    """First n records per group, by an order that begins with the shuffle key; a group may be of any size."""
    return first_rows(records, by, order, n)


def length_stratified_sample(records: DataFrame, n: int) -> DataFrame:
    """n records per length bucket, in seeded random order."""
    return head_per_group(records, ["bucket"], ["shuffle_key"], n)


def training_prompts(splits: DataFrame, rules: Rules = Rules(), keep: list[str] = ()) -> DataFrame:
    """The training loader's view: train and val, or their heads, rendered to one text column."""
    parts = [
        part if n is None else head_sample(part, ["shuffle_key"], n)
        for part, n in ((splits.where(F.col("split") == name), n) for name, n in (("train", rules.train_head), ("val", rules.val_head)))
    ]
    text = render_prompt(F.col("instruction"), F.col("input"), F.col("output"))
    return parts[0].unionByName(parts[1]).select("split", "shuffle_key", *keep, text.alias("text"))


def pack_sequences(examples: DataFrame, window: int, shard_digits: int = 2) -> DataFrame:
    """Concatenate examples in shuffled order and cut them into windows of `window` tokens.

    Needs `shuffle_key` and `n_tokens`. Shards are prefixes of the row hash (raise `shard_digits` with
    the data) and are packed independently; an example gives one row per window it reaches into.
    """
    sharded = examples.withColumn("shard", F.substring(row_hash(), 1, shard_digits))
    placed = running_total(sharded, ["shard"], [row_hash()], "end", F.col("n_tokens"))
    start = F.col("end") - F.col("n_tokens")
    window_no = F.explode(F.sequence(F.floor(start / window), F.floor((F.col("end") - 1) / window)))
    return (
        placed.where(F.col("n_tokens") > 0)
        .select("*", start.alias("start"), window_no.alias("window_no"))
        .withColumn("first_token", F.greatest("start", F.col("window_no") * window))
        .withColumn("last_token", F.least("end", (F.col("window_no") + 1) * window) - 1)
    )


def packed_windows(packed: DataFrame) -> DataFrame:
    """Fill of each packed window: (shard, window_no, examples, tokens)."""
    return packed.groupBy("shard", "window_no").agg(
        F.count("*").alias("examples"),
        F.sum(F.col("last_token") - F.col("first_token") + 1).alias("tokens"),
    )


def group_by_length(records: DataFrame, batch_size: int) -> DataFrame:
    """Adds `batch_no`: batches of `batch_size` records of similar input length, shuffled within a length.

    Positions come from counts per length plus the position within the length, so no global sort.
    """
    ranked = running_total(records, ["n_in"], [row_hash()], "_in_length")
    shorter = Window.orderBy("n_in").rowsBetween(Window.unboundedPreceding, -1)
    # One row per distinct length: small enough for the ungrouped window.
    lengths = records.groupBy("n_in").count()
    offsets = lengths.select("n_in", F.coalesce(F.sum("count").over(shorter), F.lit(0)).alias("_shorter"))
    position = F.col("_shorter") + F.col("_in_length") - 1
    return (
        ranked.join(offsets, "n_in")
        .withColumn("batch_no", F.floor(position / batch_size))
        .drop("_shorter", "_in_length")
    )


def oversample_domain(records: DataFrame, domain: str, share: float) -> DataFrame:
    """Repeat a domain's records until it holds `share` of all; adds `copy_no`.

    Each record gets the whole number of copies, and those whose hash falls below the remaining
    fraction get one more: deterministic, and exact up to the hash's spread. Without records of the domain nothing changes.
    """
    if not 0 <= share < 1:
        raise ValueError(f"a share of {share} cannot be reached: it must be at least 0 and below 1")
    counts = records.groupBy("domain").count()
    own = F.sum(F.when(F.col("domain") == domain, F.col("count")).otherwise(0))
    rest = F.sum(F.when(F.col("domain") == domain, 0).otherwise(F.col("count")))
    factor = F.when(own > 0, F.greatest(F.try_divide(F.lit(share) * rest, F.lit(1.0 - share) * own), F.lit(1.0)))
    factors = counts.agg(F.coalesce(factor, F.lit(1.0)).alias("_factor"))
    whole = F.floor("_factor")
    draw = F.conv(F.substring(row_hash(), 1, 8), 16, 10).cast("bigint") / F.lit(float(2**32))
    extra = (draw < F.col("_factor") - whole).cast("bigint")
    copies = F.when(F.col("domain") == domain, whole + extra).otherwise(1)
    # One global aggregate row.
    return (
        records.join(F.broadcast(factors))
        .select(*records.columns, F.explode(F.sequence(F.lit(1).cast("bigint"), copies)).alias("copy_no"))
    )
