"""From raw pairs to unique, valid, directed instruction records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.functions.records import pair_key, to_instruction
from tandem.functions.text import clean_text, clean_token_count, length_bucket, length_ratio
from tandem.settings import DIRECTIONS, Rules


def clean_pairs(pairs: DataFrame, repair: bool = True) -> DataFrame:
    """Both sides cleaned.

    The one-element `inline` keeps the optimizer from copying the cleaning into every later filter
    and projection that uses a side: it runs once per text.
    """
    others = [name for name in pairs.columns if name not in ("en", "es")]
    cleaned = F.struct(*(clean_text(F.col(side), repair).alias(side) for side in ("en", "es")))
    return pairs.select(*others, cleaned.alias("_sides")).select(*others, F.inline(F.array("_sides")))


def nonempty_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.where((F.col("en") != "") & (F.col("es") != ""))


def with_pair_lengths(pairs: DataFrame) -> DataFrame:
    """Token counts of cleaned pairs, counted once (see `clean_pairs`) for all rules that use them."""
    counts = F.struct(clean_token_count(F.col("en")).alias("n_en"), clean_token_count(F.col("es")).alias("n_es"))
    return pairs.select("*", F.inline(F.array(counts)))


def _bounds(rules: Rules) -> tuple[Column, Column, Column]:
    ratio = length_ratio(F.col("n_en"), F.col("n_es"))
    return (
        F.col("n_en").between(rules.min_tokens, rules.max_tokens),
        F.col("n_es").between(rules.min_tokens, rules.max_tokens),
        ratio.between(1 / rules.max_ratio, rules.max_ratio),
    )


def valid_pairs(pairs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Cleaned pairs within the token and ratio bounds, bounds included."""
    en_ok, es_ok, ratio_ok = _bounds(rules)
    return with_pair_lengths(nonempty_pairs(pairs)).where(en_ok & es_ok & ratio_ok)


def reject_reasons(pairs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Every cleaned pair with the first rule it breaks, `valid` if none."""
    en_ok, es_ok, ratio_ok = _bounds(rules)
    empty = (F.coalesce("en", F.lit("")) == "") | (F.coalesce("es", F.lit("")) == "")
    reason = (
        F.when(empty, "empty_side")
        .when(F.col("n_en") < rules.min_tokens, "en_too_short")
        .when(~en_ok, "en_too_long")
        .when(F.col("n_es") < rules.min_tokens, "es_too_short")
        .when(~es_ok, "es_too_long")
        .when(~ratio_ok, "length_ratio")
        .otherwise("valid")
    )
    return with_pair_lengths(pairs).withColumn("reason", reason)


def dedup_pairs(pairs: DataFrame, order: list[str]) -> DataFrame:
    """Keep the first pair per key; `order` names the columns that say which one is first.

    Copies collapse in the map-side aggregate, so a key with many copies costs no more than any
    other. The text travels once, inside the key, and is cut apart again after the shuffle. The
    leading hash makes the sort compare numbers, the full key decides what is equal.
    """
    carried = [name for name in pairs.columns if name not in ("en", "es", *order)]
    first = F.struct(*order, *carried, F.length("en").alias("_en_chars"))
    key = pair_key(F.col("en"), F.col("es"))
    return (
        pairs.select(F.xxhash64(key).alias("_hash"), key.alias("_key"), first.alias("_row"))
        .groupBy("_hash", "_key")
        .agg(F.min("_row").alias("_row"))
        .select(
            *(f"_row.{name}" for name in (*order, *carried)),
            F.expr("substring(_key, 1, _row._en_chars)").alias("en"),
            F.expr("substring(_key, _row._en_chars + 1)").alias("es"),
        )
    )


def bidirectional(pairs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Two directed records per pair, with token counts and length bucket."""
    carried = [name for name in pairs.columns if name not in ("en", "es", "domain", "n_en", "n_es")]

    def directed(direction: str, n_in: str, n_out: str) -> Column:
        record = to_instruction(F.col("en"), F.col("es"), F.col("domain"), F.lit(direction))
        return F.struct(record.alias("record"), F.col(n_in).alias("n_in"), F.col(n_out).alias("n_out"))

    both = F.array(directed(DIRECTIONS[0], "n_en", "n_es"), directed(DIRECTIONS[1], "n_es", "n_en"))
    return (
        pairs.select(*carried, F.inline(both))
        .select(*carried, "record.*", "n_in", "n_out")
        .withColumn("bucket", length_bucket(F.col("n_in"), (rules.short_max, rules.mid_max)))
    )


def preprocess(pairs: DataFrame, order: list[str], rules: Rules = Rules(), repair: bool = True) -> DataFrame:
    """Clean, validate, deduplicate over all sources, fan out."""
    kept = dedup_pairs(valid_pairs(clean_pairs(pairs, repair), rules), order)
    return bidirectional(kept, rules)
