"""Overlapping slices, their statistics, and the bias report over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.functions.records import bias_status, over_under, rel_deviation
from tandem.functions.text import length_ratio, word_overlap, words
from tandem.settings import GAP_RULES, SLICES, STAT_METRICS, Rules

OVERALL = "overall"


def slice_predicates() -> dict[str, Column]:
    """Membership test per slice, on the cell columns (domain, direction, bucket)."""
    column = {"medical": "domain", "legal": "domain", "en_to_es": "direction", "es_to_en": "direction"}
    return {name: F.coalesce(F.col(column.get(name, "bucket")) == name, F.lit(False)) for name in SLICES}


def slice_names(with_overall: bool = False) -> Column:
    names = [F.when(test, F.lit(name)) for name, test in slice_predicates().items()]
    return F.array_compact(F.array(*names, *([F.lit(OVERALL)] if with_overall else [])))


def assign_slices(records: DataFrame, with_overall: bool = False) -> DataFrame:
    """One row per record and slice it belongs to (0 to 3 of the 6)."""
    return records.select(F.explode(slice_names(with_overall)).alias("slice"), "*")


def explode_words(records: DataFrame) -> DataFrame:
    """Every word of both sides: (domain, direction, bucket, side, word)."""
    sides = F.array(
        F.struct(F.lit("input").alias("side"), words(F.col("input")).alias("words")),
        F.struct(F.lit("output").alias("side"), words(F.col("output")).alias("words")),
    )
    return records.select("domain", "direction", "bucket", F.inline(sides)).select(
        "domain", "direction", "bucket", "side", F.explode("words").alias("word")
    )


def lexical_diversity(records: DataFrame) -> DataFrame:
    """Distinct words and words per (slice, side).

    One shuffle keyed by word with a counter per slice: no row is repeated for the slices it is in,
    and frequent words collapse before the shuffle.
    """
    tests = {**slice_predicates(), OVERALL: F.lit(True)}
    per_word = (
        explode_words(records)
        .groupBy("side", "word")
        .agg(*(F.count_if(test).alias(name) for name, test in tests.items()))
    )
    per_side = per_word.groupBy("side").agg(
        *(F.sum(name).alias(f"{name}_words") for name in tests),
        *(F.count_if(F.col(name) > 0).alias(f"{name}_distinct") for name in tests),
    )
    rows = [
        F.struct(
            F.lit(name).alias("slice"),
            F.col(f"{name}_distinct").alias("distinct_words"),
            F.col(f"{name}_words").alias("words"),
        )
        for name in tests
    ]
    return (
        per_side.select("side", F.inline(F.array(*rows)))
        .where(F.col("words") > 0)
        .withColumn("diversity", F.col("distinct_words") / F.greatest(F.col("words"), F.lit(1)))
    )


def slice_sums(records: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """Count and sums of `measures` per slice and overall.

    Sums per (domain, direction, bucket) first: slices and overall are unions of those cells, so the
    records themselves are never repeated.
    """
    sums = [F.sum(name).alias(name) for name in measures]
    cells = (
        records.select("domain", "direction", "bucket", *(column.alias(name) for name, column in measures.items()))
        .groupBy("domain", "direction", "bucket")
        .agg(F.count("*").alias("count"), *sums)
    )
    return assign_slices(cells, with_overall=True).groupBy("slice").agg(F.sum("count").alias("count"), *sums)


def slice_stats(records: DataFrame) -> DataFrame:
    """Per slice and overall: count, mean lengths, mean ratio, diversity, mean word overlap (raw doubles).

    One scan, one shuffle. A record gives a row for each of its words and one for itself, whose key is its cell (domain,
    direction, bucket); words and cells are counted per slice, and cells carry the records' sums. A cell lies in a slice
    with all of its records, so slices are unions of them.
    """
    tests = {**slice_predicates(), OVERALL: F.lit(True)}
    measures = {
        "n_in": F.col("n_in"),
        "n_out": F.col("n_out"),
        "ratio": length_ratio(F.col("n_out"), F.col("n_in")),
        "overlap": word_overlap(F.col("input"), F.col("output")),
    }
    cell = ("domain", "direction", "bucket")
    grains = F.array(
        F.struct(F.lit("input").alias("grain"), words(F.col("input")).alias("keys")),
        F.struct(F.lit("output").alias("grain"), words(F.col("output")).alias("keys")),
        F.struct(F.lit("cell").alias("grain"), F.array(F.to_json(F.struct(*cell))).alias("keys")),
    )
    rows = records.select(*cell, *(column.alias(f"_{name}") for name, column in measures.items()), F.inline(grains))
    rows = rows.select(*cell, *(f"_{name}" for name in measures), "grain", F.explode("keys").alias("key"))
    counted = rows.groupBy("grain", "key").agg(
        *(F.count_if(test).alias(name) for name, test in tests.items()),
        *(F.sum(F.when(F.col("grain") == "cell", F.col(f"_{name}"))).alias(f"_{name}") for name in measures),
    )

    # Written as SQL: there are many of these, and each is one call that way.
    sums, slices = [], []
    for name in tests:
        sums.append(f"coalesce(sum(if(grain = 'cell', {name}, null)), 0) as {name}_count")
        sums += [f"sum(if(grain = 'cell' and {name} > 0, _{m}, null)) as {name}_{m}" for m in measures]
        sums += [
            f"coalesce(count_if({name} > 0 and grain = '{side}') / greatest(sum(if(grain = '{side}', {name}, null)), 1), 0D) as {name}_{side}"
            for side in ("input", "output")
        ]
        means = [f"{name}_{m} / greatest({name}_count, 1)" for m in measures]
        values = dict(zip(STAT_METRICS, (*means[:3], f"{name}_input", f"{name}_output", means[3]), strict=True))
        fields = ", ".join(f"'{metric}', {value}" for metric, value in values.items())
        slices.append(f"named_struct('slice', '{name}', 'count', {name}_count, {fields})")
    return counted.agg(*map(F.expr, sums)).select(F.expr(f"inline(array({', '.join(slices)}))")).where("count > 0")


def report_stats(stats: DataFrame) -> DataFrame:
    """Slice statistics at report digits: lengths 2, the rest 3; ties round to even."""
    digits = {"avg_input_len": 2, "avg_output_len": 2}
    return stats.select(
        "slice", "count", *(F.bround(F.col(name), digits.get(name, 3)).alias(name) for name in STAT_METRICS)
    )


def _as_one_row(rounded: DataFrame) -> DataFrame:
    """The few slice rows as `rows`, and each of the known ones by itself, in one row: what compares slices needs no join."""
    one = rounded.agg(F.array_sort(F.collect_list(F.struct("slice", "count", *STAT_METRICS))).alias("rows"))
    by_name = F.map_from_entries(F.transform("rows", lambda r: F.struct(r["slice"], r)))
    one = one.withColumn("by_name", by_name)
    return one.select("rows", *(F.try_element_at("by_name", F.lit(name)).alias(f"_{name}") for name in (OVERALL, *SLICES)))


def _row_of(name: str) -> Column:
    """The row of a slice; null if there is none."""
    return F.col(f"_{name}")


def _others() -> Column:
    """The slices to compare: none without an overall row."""
    return F.filter("rows", lambda r: (r["slice"] != OVERALL) & _row_of(OVERALL).isNotNull())


def _scores_of(row: Column, rules: Rules) -> Column:
    """One score per metric of a slice's row, in the order of the metrics."""

    def score(metric: str) -> Column:
        deviation = rel_deviation(row[metric], _row_of(OVERALL)[metric])
        return F.struct(
            row["slice"].alias("slice"),
            row["count"].alias("count"),
            F.lit(metric).alias("metric"),
            row[metric].alias("slice_val"),
            _row_of(OVERALL)[metric].alias("overall_val"),
            deviation.alias("deviation"),
            (F.abs(deviation) > rules.bias_threshold).alias("flagged"),
            over_under(deviation).alias("direction"),
            bias_status(deviation, rules.bias_threshold).alias("status"),
        )

    return F.array(*map(score, STAT_METRICS))


def bias_scores(rounded: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Deviation of each slice from overall per metric, from already rounded statistics."""
    return _as_one_row(rounded).select(F.inline(F.flatten(F.transform(_others(), lambda r: _scores_of(r, rules)))))


def bias_flags(scores: DataFrame) -> DataFrame:
    """Slices with at least one flagged metric, their issues in metric order, and the summary text."""
    rank = F.array_position(F.array(*(F.lit(name) for name in STAT_METRICS)), F.col("metric"))
    issue = F.struct(
        rank.alias("rank"), "metric", "deviation", "direction", "slice_val", "overall_val"
    )
    issues = (
        scores.where("flagged").groupBy("slice", "count").agg(F.array_sort(F.collect_list(issue)).alias("issues"))
    )
    listed = F.array_join(F.transform("issues", lambda x: x["metric"]), ", ")
    return issues.select(
        "slice",
        "count",
        F.transform("issues", lambda x: x.dropFields("rank")).alias("issues"),
        F.concat(F.lit("Slice '"), F.col("slice"), F.lit("' shows bias in: "), listed).alias("summary"),
    )


def _gaps() -> Column:
    """The fixed comparisons whose slices both exist."""

    def gap(rank: int, left: str, right: str, metric: str, most: float, label: str, left_text: str, right_text: str) -> Column:
        one, two = _row_of(left)[metric], _row_of(right)[metric]
        size = F.abs(one - two)
        message = F.format_string(
            "%s bias detected: %s=%.3f vs %s=%.3f (gap=%.3f)", F.lit(label), F.lit(left_text), one, F.lit(right_text), two, size
        )
        return F.when(
            _row_of(left).isNotNull() & _row_of(right).isNotNull(),
            F.struct(
                F.lit(rank).alias("rank"), F.lit(left).alias("left_slice"), F.lit(right).alias("right_slice"), F.lit(metric).alias("metric"),
                one.alias("left_val"), two.alias("right_val"), size.alias("gap"), (size > most).alias("detected"),
                F.when(size > most, message).alias("message"),
            ),
        )

    return F.array_compact(F.array(*(gap(rank, *rule) for rank, rule in enumerate(GAP_RULES))))


def cross_slice_gaps(rounded: DataFrame) -> DataFrame:
    """Gaps between the fixed slice pairs, only where both slices exist."""
    return _as_one_row(rounded).select(F.inline(_gaps()))


def bias_report(rounded: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The whole bias report as one nested row, from the few slice rows in one pass and without a join."""
    stats = lambda r: F.struct(r["count"].alias("count"), *(r[m].alias(m) for m in STAT_METRICS))
    order = F.array(*(F.lit(name) for name in SLICES))
    judged = F.transform(
        _others(),
        lambda r: F.struct(
            F.array_position(order, r["slice"]).alias("rank"), r["slice"].alias("slice"), r["count"].alias("count"), _scores_of(r, rules).alias("scores")
        ),
    )
    issue = lambda x: F.struct(*(x[c].alias(c) for c in ("metric", "deviation", "direction", "slice_val", "overall_val")))
    flag = lambda j: F.struct(
        j["slice"].alias("slice"), j["count"].alias("count"), F.transform(F.filter(j["scores"], lambda x: x["flagged"]), issue).alias("issues")
    )
    summary = lambda f: F.concat(
        F.lit("Slice '"), f["slice"], F.lit("' shows bias in: "), F.array_join(F.transform(f["issues"], lambda x: x["metric"]), ", ")
    )
    one = _as_one_row(rounded).select("*", F.array_sort(judged).alias("judged"), _gaps().alias("gaps"))
    one = one.withColumn("flags", F.filter(F.transform("judged", flag), lambda f: F.size(f["issues"]) > 0))
    # Slices and metrics by name.
    named = F.array_sort(
        F.transform("judged", lambda j: F.struct(j["slice"], F.array_sort(F.transform(j["scores"], lambda x: F.struct(x["metric"], x["deviation"]))).alias("scores")))
    )
    per_slice = F.transform(named, lambda j: F.struct(j["slice"], F.map_from_entries(j["scores"])))
    both = lambda left, right: _row_of(left).isNotNull() & _row_of(right).isNotNull()
    names = ("domain_bias", "direction_bias", "length_bias")
    slices = F.filter("rows", lambda r: r["slice"] != OVERALL)
    return one.select(
        F.when(_row_of(OVERALL).isNotNull(), stats(_row_of(OVERALL))).alias("overall_stats"),
        F.map_from_entries(F.transform(slices, lambda r: F.struct(r["slice"], stats(r)))).alias("slice_stats"),
        F.map_from_entries(per_slice).alias("bias_scores"),
        F.lit(rules.bias_threshold).alias("bias_threshold"),
        F.col("flags").alias("bias_flags"),
        F.concat(F.transform("flags", summary), F.transform(F.filter("gaps", lambda g: g["detected"]), lambda g: g["message"])).alias("bias_summary"),
        F.size(slices).cast("bigint").alias("total_slices"),
        F.size("flags").alias("biased_slices"),
        (F.size("flags") > 0).alias("bias_detected"),
        F.struct(*(both(left, right).alias(name) for (left, right, *_), name in zip(GAP_RULES, names, strict=True))).alias("cross_slice_analysis"),
    )
