"""Reproducible stratified splits, shuffling and leakage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.functions.records import content_hash, default_fields, mirror_key
from tandem.operators.ranking import beside_cuts, locate
from tandem.settings import Rules


def with_shuffle_key(records: DataFrame, row_id: list[str], seed: int) -> DataFrame:
    """Seeded pseudo-random order key: content hash, then `row_id` hash to tell copies apart."""
    copy = F.md5(F.concat_ws("|", F.lit(str(seed)), *row_id))
    return records.withColumn("shuffle_key", F.concat(content_hash(seed), copy))


def stratum() -> Column:
    fields = default_fields()
    return F.struct(fields["domain"].alias("domain"), fields["direction"].alias("direction"), "bucket")


def split_sizes(size: Column, ratios: tuple[float, float, float]) -> tuple[Column, Column]:
    """Last row number of train and of val in a stratum of `size` rows."""
    train = F.floor(F.lit(float(ratios[0])) * size)
    train = F.when(size >= 3, F.greatest(train, F.lit(1))).otherwise(train)
    val = train + F.floor(F.lit(float(ratios[1])) * size)
    return train, F.when(size >= 3, F.greatest(val, train + 1)).otherwise(val)


def split_cuts(keyed: DataFrame, ratios: tuple[float, float, float]) -> DataFrame:
    """Per stratum (`group`), the shuffle keys of the last train row and of the last val row."""
    train_end, val_end = (lambda size: split_sizes(size, ratios)[0]), (lambda size: split_sizes(size, ratios)[1])
    ends = lambda size: F.array(
        F.struct(F.lit("train").alias("cut"), train_end(size).alias("target")), F.struct(F.lit("val").alias("cut"), val_end(size).alias("target"))
    )
    cuts = locate(keyed.select(F.col("stratum").alias("group"), F.col("shuffle_key").alias("key")), ends)
    return cuts.groupBy("group").agg(*(F.max(F.when(F.col("cut") == cut, F.col("key"))).alias(f"last_{cut}") for cut in ("train", "val")))


def stratified_split(records: DataFrame, row_id: list[str], rules: Rules = Rules()) -> DataFrame:
    """Adds `split` and `shuffle_key`: exact sizes per (domain, direction, bucket), same for a seed.

    Scans `records` three times and doesn't shuffle them while the cuts are few, so pass a written table, not a long plan.
    """
    if abs(sum(rules.ratios) - 1.0) > 1e-6:
        raise ValueError(f"the shares of train, val and test are {rules.ratios}: together they are not 1")
    keyed = with_shuffle_key(records, row_id, rules.seed).withColumn("stratum", stratum())
    cuts = beside_cuts(keyed, F.col("stratum"), "shuffle_key", split_cuts(keyed, rules.ratios))
    split = (
        F.when(F.col("shuffle_key") <= F.col("last_train"), "train")
        .when(F.col("shuffle_key") <= F.col("last_val"), "val")
        .otherwise("test")
    )
    return cuts.withColumn("split", split).drop("stratum", "last_train", "last_val")


def shuffle_rows(splits: DataFrame) -> DataFrame:
    """Each split in seeded random order: strata are no longer clustered."""
    return splits.orderBy("split", "shuffle_key")


def split_leakage(splits: DataFrame) -> DataFrame:
    """How many val and test records have their pair, in either direction, among the train records.

    One aggregate per pair instead of a join, so copies of a pair collapse before the shuffle.
    """
    held_out = ("val", "test")
    per_pair = splits.groupBy(mirror_key(F.col("input"), F.col("output")).alias("pair")).agg(
        F.max(F.col("split") == "train").alias("in_train"),
        *(F.count_if(F.col("split") == name).alias(name) for name in held_out),
    )
    sums = [F.sum(name).alias(name) for name in held_out]
    leaked = [F.sum(F.when(F.col("in_train"), F.col(name)).otherwise(0)).alias(f"{name}_leaked") for name in held_out]
    rows = [
        F.struct(F.lit(name).alias("split"), F.col(name).alias("records"), F.col(f"{name}_leaked").alias("in_train"))
        for name in held_out
    ]
    return per_pair.agg(*sums, *leaked).select(F.inline(F.array(*rows)))
