"""Corpus BLEU from per-record clipped n-gram matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.functions.text import ngrams, tokenize_13a
from tandem.operators.sampling import head_per_group
from tandem.operators.slices import OVERALL, assign_slices, slice_sums

ORDERS = (1, 2, 3, 4)


def explode_ngrams(records: DataFrame, side: str = "output") -> DataFrame:
    """Every 1- to 4-gram of a text: (n, ngram), repeats included."""
    tokens = records.select(tokenize_13a(F.col(side)).alias("tokens"))
    grams = F.array(*(F.struct(F.lit(n).alias("n"), ngrams(F.col("tokens"), n).alias("grams")) for n in ORDERS))
    return tokens.select(F.inline(grams)).select("n", F.explode("grams").alias("ngram"))


def _repeats(grams: Column) -> Column:
    """Every occurrence of a value after its first."""
    ordered, rest = F.sort_array(grams), F.greatest(F.size(grams) - 1, F.lit(0))
    shifted = F.zip_with(
        F.slice(ordered, F.lit(2), rest), F.slice(ordered, F.lit(1), rest), lambda a, b: F.when(a == b, a)
    )
    return F.array_compact(shifted)


def _common(left: Column, right: Column) -> Column:
    """Size of the multiset intersection of two small arrays."""

    def occurrences(values: Column, gram: Column) -> Column:
        return F.size(F.filter(values, lambda x: x == gram))

    return F.aggregate(
        F.array_intersect(left, right),
        F.lit(0),
        lambda total, gram: total + F.least(occurrences(left, gram), occurrences(right, gram)),
    )


def ngram_matches(records: DataFrame) -> DataFrame:
    """Adds hyp_len, ref_len, match_n and total_n (output scored against input), within the row.

    Clipped matches are the distinct n-grams in common plus the repeats in common, so no n-gram leaves
    its row: nothing is shuffled but the sums.
    """
    names = records.columns
    tokens = records.select("*", tokenize_13a(F.col("output")).alias("_h"), tokenize_13a(F.col("input")).alias("_r"))
    grams = tokens.select(
        *names,
        F.size("_h").alias("hyp_len"),
        F.size("_r").alias("ref_len"),
        *(ngrams(F.col(f"_{side}"), n).alias(f"_{side}{n}") for side in "hr" for n in ORDERS),
    )
    counted = grams.select(
        *names,
        "hyp_len",
        "ref_len",
        *(F.size(F.array_intersect(f"_h{n}", f"_r{n}")).alias(f"_d{n}") for n in ORDERS),
        *(_repeats(F.col(f"_{side}{n}")).alias(f"_{side}{n}") for side in "hr" for n in ORDERS),
    )
    return counted.select(
        *names,
        "hyp_len",
        "ref_len",
        *((F.col(f"_d{n}") + _common(F.col(f"_h{n}"), F.col(f"_r{n}"))).alias(f"match_{n}") for n in ORDERS),
        *(F.greatest(F.col("hyp_len") - (n - 1), F.lit(0)).alias(f"total_{n}") for n in ORDERS),
    )


BLEU_SUMS = ["hyp_len", "ref_len", *(f"match_{n}" for n in ORDERS), *(f"total_{n}" for n in ORDERS)]


def bleu_score() -> Column:
    """BLEU from the summed columns: brevity penalty, and exponential smoothing of orders without a match."""
    matches = [F.col(f"match_{n}") for n in ORDERS]
    misses = F.lit(0)
    logs, unscored = F.lit(0.0), F.lit(False)
    for n, match in zip(ORDERS, matches):
        total = F.col(f"total_{n}")
        misses = misses + (match == 0).cast("int")
        precision = F.when(match == 0, F.lit(100.0) / (F.pow(F.lit(2.0), misses) * total)).otherwise(
            F.lit(100.0) * match / total
        )
        logs = logs + F.log(precision)
        unscored = unscored | (total == 0)
    hyp, ref = F.col("hyp_len"), F.col("ref_len")
    brevity = F.when(hyp >= ref, F.lit(1.0)).otherwise(F.exp(F.lit(1.0) - ref / hyp))
    any_match = F.greatest(*matches) > 0
    return F.when(any_match & ~unscored, brevity * F.exp(logs / len(ORDERS))).otherwise(F.lit(0.0))


def corpus_bleu(records: DataFrame) -> DataFrame:
    """One row: sums and BLEU of all records."""
    sums = ngram_matches(records).agg(*(F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in BLEU_SUMS))
    return sums.withColumn("bleu", bleu_score())


def bleu_by_slice(records: DataFrame) -> DataFrame:
    """Sums and BLEU per slice and overall, over all records."""
    scored = ngram_matches(records.select("domain", "direction", "bucket", "input", "output"))
    sums = slice_sums(scored, {name: F.col(name) for name in BLEU_SUMS})
    return sums.withColumn("bleu", bleu_score())


def slice_bleu(records: DataFrame, head: int | None = None, min_records: int = 2) -> DataFrame:
    """BLEU of each slice that has at least `min_records`, over all its records or its first `head`."""
    if head is None:
        sums = slice_sums(ngram_matches(records.select("domain", "direction", "bucket", "input", "output")), {name: F.col(name) for name in BLEU_SUMS})
        sums = sums.where(F.col("slice") != OVERALL)
    else:
        sliced = assign_slices(records.select("domain", "direction", "bucket", "input", "output", "shuffle_key"))
        heads = head_per_group(sliced, ["slice"], ["shuffle_key"], head).select("slice", "input", "output")
        sums = ngram_matches(heads).groupBy("slice").agg(F.count("*").alias("count"), *(F.sum(name).alias(name) for name in BLEU_SUMS))
    return sums.where(F.col("count") >= min_records).withColumn("bleu", bleu_score())
