"""Profile of a record set, the schema report drawn from it, and the check against that schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.functions.records import default_fields, is_empty
from tandem.functions.text import length_bucket, token_count
from tandem.settings import DIRECTIONS, DOMAINS, RECORD_FIELDS, Rules


def with_lengths(records: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Token counts and length bucket for records read from files; null texts count 0."""
    return records.withColumns(
        {"n_in": token_count(F.col("input")), "n_out": token_count(F.col("output"))}
    ).withColumn("bucket", length_bucket(F.col("n_in"), (rules.short_max, rules.mid_max)))


def value_distribution(records: DataFrame) -> DataFrame:
    """Record counts by domain and by direction: (field, value, records).

    Counts the few combinations first, so that both fields come from one pass and one small shuffle.
    """
    fields = default_fields()
    combos = records.groupBy(fields["domain"].alias("domain"), fields["direction"].alias("direction")).count()
    return (
        combos.unpivot("count", ["domain", "direction"], "field", "value")
        .groupBy("field", "value")
        .agg(F.sum("count").alias("records"))
    )


def length_stats(records: DataFrame) -> DataFrame:
    """Mean, max and min of input tokens, mean and max of output tokens, over non-empty texts."""
    n_in = F.when(~is_empty(F.col("input")), F.col("n_in"))
    n_out = F.when(~is_empty(F.col("output")), F.col("n_out"))
    return records.agg(
        F.coalesce(F.avg(n_in), F.lit(0.0)).alias("input_len_mean"),
        F.coalesce(F.max(n_in), F.lit(0)).alias("input_len_max"),
        F.coalesce(F.min(n_in), F.lit(0)).alias("input_len_min"),
        F.coalesce(F.avg(n_out), F.lit(0.0)).alias("output_len_mean"),
        F.coalesce(F.max(n_out), F.lit(0)).alias("output_len_max"),
    )


def null_counts(records: DataFrame) -> DataFrame:
    return records.agg(
        F.count("*").alias("total_records"),
        F.count_if(is_empty(F.col("input"))).alias("null_input_count"),
        F.count_if(is_empty(F.col("output"))).alias("null_output_count"),
    )


def profile_report(records: DataFrame) -> DataFrame:
    """The whole profile as one row, from one aggregate over the records.

    Sums per (domain, direction) first; domains, directions and totals are grouping sets of that small table, in one pass.
    """
    fields = default_fields()
    n_in = F.when(~is_empty(F.col("input")), F.col("n_in"))
    n_out = F.when(~is_empty(F.col("output")), F.col("n_out"))
    sums = ("n", "with_input", "with_output", "sum_in", "sum_out")
    combos = records.groupBy(fields["domain"].alias("domain"), fields["direction"].alias("direction")).agg(
        F.count("*").alias("n"),
        F.count(n_in).alias("with_input"),
        F.count(n_out).alias("with_output"),
        F.sum(n_in).alias("sum_in"),
        F.sum(n_out).alias("sum_out"),
        F.max(n_in).alias("max_in"),
        F.min(n_in).alias("min_in"),
        F.max(n_out).alias("max_out"),
    )
    limits = (F.max("max_in").alias("max_in"), F.min("min_in").alias("min_in"), F.max("max_out").alias("max_out"))
    sets = _by_field(combos, *(F.sum(c).alias(c) for c in sums), *limits)

    def mean(name: str, count: str) -> Column:
        return F.bround(F.coalesce(_total(name) / _total(count), F.lit(0.0)), 2)

    return sets.agg(
        F.coalesce(_total("n"), F.lit(0)).alias("total_records"),
        F.map_from_entries(_listed("domain")).alias("domain_distribution"),
        F.map_from_entries(_listed("direction")).alias("direction_distribution"),
        mean("sum_in", "with_input").alias("input_len_mean"),
        F.coalesce(_total("max_in"), F.lit(0)).alias("input_len_max"),
        F.coalesce(_total("min_in"), F.lit(0)).alias("input_len_min"),
        mean("sum_out", "with_output").alias("output_len_mean"),
        F.coalesce(_total("max_out"), F.lit(0)).alias("output_len_max"),
        F.coalesce(_total("n") - _total("with_input"), F.lit(0)).alias("null_input_count"),
        F.coalesce(_total("n") - _total("with_output"), F.lit(0)).alias("null_output_count"),
    )


# Which of domain and direction a row of the grouping sets sums over, as Spark numbers them.
_SETS = {"domain": 1, "direction": 2, "total": 3}


def _by_field(combos: DataFrame, *sums: Column) -> DataFrame:
    """Sums per domain, per direction and in all, with the number of the `set`."""
    return combos.groupingSets([("domain",), ("direction",), ()], "domain", "direction").agg(F.grouping_id().alias("set"), *sums)


def _total(name: str) -> Column:
    return F.max(F.when(F.col("set") == _SETS["total"], F.col(name)))


def _listed(field: str) -> Column:
    """Values of a field with their counts, in order."""
    return F.array_sort(F.collect_list(F.when(F.col("set") == _SETS[field], F.struct(field, "n"))))


def schema_report(profile: DataFrame) -> DataFrame:
    """Required fields, allowed values, totals and input length limits of a profiled record set."""

    def names(values: tuple[str, ...]):
        return F.array(*(F.lit(value) for value in values))

    return profile.select(
        names(RECORD_FIELDS).alias("required_fields"),
        names(DOMAINS).alias("valid_domains"),
        names(DIRECTIONS).alias("valid_directions"),
        "total_records",
        F.struct(F.col("null_input_count").alias("input"), F.col("null_output_count").alias("output")).alias(
            "null_counts"
        ),
        F.struct(
            F.col("input_len_mean").alias("mean"),
            F.col("input_len_max").alias("max"),
            F.col("input_len_min").alias("min"),
        ).alias("input_len_stats"),
    )


def learned_schema(records: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """A schema report drawn from the records themselves, for `schema_check`: the domains and directions that hold at least
    `schema_share` of them, and input lengths between two quantiles.

    Values are counted and lengths sketched in aggregates with map-side combine; the sketch's error is a ten-thousandth of
    the ranks.
    """
    counted = records.groupBy(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("domain", "direction"))).agg(
        F.count("*").alias("n"), *(F.count_if(is_empty(F.col(c))).alias(f"no_{c}") for c in ("input", "output")), F.sum("n_in").alias("sum_in")
    )
    sums = ("n", "no_input", "no_output", "sum_in")
    sets = _by_field(counted, *(F.sum(c).alias(c) for c in sums))
    values = sets.agg(*(F.coalesce(_total(c), F.lit(0)).alias(c) for c in sums), *(_listed(c).alias(f"_{c}") for c in ("domain", "direction")))
    lengths = records.agg(F.percentile_approx("n_in", list(rules.schema_quantiles), 10_000).alias("_limits"))
    usual = lambda c: F.transform(
        F.filter(f"_{c}", lambda v: (v[c] != "") & (v["n"] >= rules.schema_share * F.col("n"))), lambda v: v[c]
    )
    # Two tables of one row.
    return values.join(lengths).select(
        F.array(*(F.lit(value) for value in RECORD_FIELDS)).alias("required_fields"),
        usual("domain").alias("valid_domains"),
        usual("direction").alias("valid_directions"),
        F.col("n").alias("total_records"),
        F.struct(F.col("no_input").alias("input"), F.col("no_output").alias("output")).alias("null_counts"),
        F.struct(
            F.bround(F.col("sum_in") / F.greatest("n", F.lit(1)), 2).alias("mean"), F.get("_limits", F.lit(1)).alias("max"), F.get("_limits", F.lit(0)).alias("min")
        ).alias("input_len_stats"),
    )


def schema_check(records: DataFrame, schema: DataFrame) -> DataFrame:
    """Each record against a schema report: missing field, unseen value, length out of range."""
    names = records.columns
    limits = schema.select("required_fields", "valid_domains", "valid_directions", "input_len_stats").limit(1)
    missing = [F.when(is_empty(F.col(name)), F.lit(name)) for name in RECORD_FIELDS]
    domain, direction = (F.coalesce(F.col(name), F.lit("")) for name in ("domain", "direction"))
    # One row of limits.
    return records.join(F.broadcast(limits)).select(
        *names,
        F.arrays_overlap("required_fields", F.array_compact(F.array(*missing))).alias("missing_field"),
        (~F.array_contains("valid_domains", domain)).alias("unseen_domain"),
        (~F.array_contains("valid_directions", direction)).alias("unseen_direction"),
        (~F.col("n_in").between(F.col("input_len_stats.min"), F.col("input_len_stats.max"))).alias("length_out_of_range"),
    )
