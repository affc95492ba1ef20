"""Slice-aware evaluation gate, sensitivity reports and flat run metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.functions.records import abs_len_deviation
from tandem.functions.text import length_bucket, length_ratio, words
from tandem.operators.bleu import BLEU_SUMS, bleu_score, ngram_matches
from tandem.operators.quality import DatasetRejected
from tandem.operators.sampling import head_per_group, head_sample
from tandem.operators.slices import OVERALL, assign_slices, slice_sums
from tandem.settings import LENGTH_SLICES, Rules


def slice_heads(test: DataFrame, n: int | None) -> DataFrame:
    """First n records of each slice in shuffled order; all records for None."""
    sliced = assign_slices(test)
    return sliced if n is None else head_per_group(sliced, ["slice"], ["shuffle_key"], n)


def _eval_sums(test: DataFrame, rules: Rules) -> DataFrame:
    """Count, input length and BLEU sums per slice and overall."""
    sums = ["n_in", *BLEU_SUMS]
    columns = ["domain", "direction", "bucket", "input", "output", "n_in"]
    if rules.eval_head is None and rules.eval_slice_head is None:
        return slice_sums(ngram_matches(test.select(*columns)), {name: F.col(name) for name in sums})
    test = test.select(*columns, "shuffle_key")
    overall = test if rules.eval_head is None else head_sample(test, ["shuffle_key"], rules.eval_head)
    heads = slice_heads(test, rules.eval_slice_head).unionByName(overall.withColumn("slice", F.lit(OVERALL)))
    return ngram_matches(heads.select("slice", "n_in", "input", "output")).groupBy("slice").agg(F.count("*").alias("count"), *(F.sum(name).alias(name) for name in sums))


def eval_report(test: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per slice and one for overall: count, mean input length, deviation, BLEU, cap, passed."""
    stats = (
        _eval_sums(test, rules)
        .withColumn("avg_input_len", F.col("n_in") / F.col("count"))
        .withColumn("bleu", F.when((F.col("count") >= 2) | (F.col("slice") == OVERALL), F.bround(bleu_score(), 2)))
    )
    base = stats.where(F.col("slice") == OVERALL).select(F.col("avg_input_len").alias("overall_len"))
    is_overall = F.col("slice") == OVERALL
    deviation = F.when(~is_overall, abs_len_deviation(F.col("avg_input_len"), F.col("overall_len")))
    cap = F.when(F.col("slice").isin(*LENGTH_SLICES), rules.length_slice_cap).when(~is_overall, rules.slice_cap)
    passed = F.when(is_overall, F.col("bleu") >= rules.bleu_threshold).otherwise(F.col("bias_dev") < F.col("cap"))
    return (
        stats.join(F.broadcast(base))
        .select("slice", "count", "avg_input_len", "bleu", deviation.alias("bias_dev"), cap.alias("cap"))
        .withColumn("passed", passed)
    )


def eval_verdict(report: DataFrame) -> DataFrame:
    is_overall = F.col("slice") == OVERALL
    return report.agg(
        F.max(F.when(is_overall, F.col("bleu"))).alias("bleu"),
        F.coalesce(F.bool_and(F.when(is_overall, F.col("passed"))), F.lit(False)).alias("bleu_passed"),
        F.coalesce(F.bool_and(F.when(~is_overall, F.col("passed"))), F.lit(True)).alias("bias_passed"),
    ).withColumn("passed", F.col("bleu_passed") & F.col("bias_passed"))


def eval_gate(test: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The evaluation report, or an error: BLEU is judged before the slices."""
    report = eval_report(test, rules)
    verdict = eval_verdict(report).first()
    if not verdict["bleu_passed"]:
        raise DatasetRejected(f"corpus BLEU of {verdict['bleu']} misses the required {rules.bleu_threshold}")
    if not verdict["bias_passed"]:
        raise DatasetRejected("a slice's input length strays from overall by its cap or more")
    return report


def sensitivity_length(test: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Mean length ratio and count by input length, over the medical and the legal slice."""
    names = ("short", "medium", "long")
    heads = union_slices(slice_heads(test, rules.sensitivity_head), ["medical", "legal"])
    group = length_bucket(F.col("n_in"), rules.sensitivity_bounds, names)
    ratio = length_ratio(F.col("n_out"), F.col("n_in"))
    measured = heads.select(group.alias("length_group"), ratio.alias("ratio"))
    return measured.agg(
        *(
            F.coalesce(F.avg(F.when(F.col("length_group") == name, F.col("ratio"))), F.lit(0.0)).alias(
                f"{name}_length_ratio"
            )
            for name in names
        ),
        *(F.count_if(F.col("length_group") == name).alias(f"{name}_count") for name in names),
    )


def union_slices(sliced: DataFrame, names: list[str]) -> DataFrame:
    """Concatenation of slices; a record in two of them appears twice."""
    return sliced.where(F.col("slice").isin(*names))


def sensitivity_domain(test: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Output diversity and count of the medical slice against the legal one."""
    heads = slice_heads(test, rules.sensitivity_head)
    names = ("medical", "legal")
    heads = union_slices(heads, list(names)).select("slice", "output")
    vocabulary = (
        heads.select("slice", F.explode(words(F.col("output"))).alias("word")).groupBy("slice", "word").count()
    )
    diversity = vocabulary.groupBy("slice").agg((F.count("*") / F.sum("count")).alias("diversity"))
    per_slice = heads.groupBy("slice").agg(F.count("*").alias("count")).join(diversity, "slice", "left")
    return per_slice.agg(
        *(
            F.coalesce(F.max(F.when(F.col("slice") == name, F.col("diversity"))), F.lit(0.0)).alias(
                f"{name}_output_diversity"
            )
            for name in names
        ),
        *(
            F.coalesce(F.max(F.when(F.col("slice") == name, F.col("count"))), F.lit(0)).alias(f"{name}_count")
            for name in names
        ),
    )


def sensitivity_direction(test: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Mean output length and count per direction."""
    names = ("en_to_es", "es_to_en")
    heads = union_slices(slice_heads(test, rules.sensitivity_head), list(names)).select("slice", "n_out")
    return heads.agg(
        *(
            F.coalesce(F.avg(F.when(F.col("slice") == name, F.col("n_out"))), F.lit(0.0)).alias(
                f"{name}_avg_output_len"
            )
            for name in names
        ),
        *(F.count_if(F.col("slice") == name).alias(f"{name}_count") for name in names),
    )


def sensitivity_report(test: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """All three analyses as one nested row, at report digits."""

    def rounded(df: DataFrame, digits: int, name: str) -> DataFrame:
        fields = [
            F.bround(F.col(f.name), digits).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
            for f in df.schema
        ]
        return df.select(F.struct(*fields).alias(name))

    return (
        rounded(sensitivity_length(test, rules), 3, "length_sensitivity")
        .join(rounded(sensitivity_domain(test, rules), 4, "domain_sensitivity"))
        .join(rounded(sensitivity_direction(test, rules), 3, "direction_sensitivity"))
    )


def run_metrics(results: DataFrame, run: str, key: str | None = None) -> DataFrame:
    """Numeric columns of a result table as (run, key, value); `key` names a row-label column."""
    numeric = [f.name for f in results.schema if f.dataType.typeName() in ("double", "integer", "long", "float")]
    wide = results.select(
        (F.col(key) if key else F.lit("")).alias("label"), *(F.col(name).cast("double") for name in numeric)
    )
    name = F.when(F.col("label") == "", F.col("metric")).otherwise(F.concat_ws("_", "metric", "label"))
    return (
        wide.unpivot("label", numeric, "metric", "value")
        .where(F.col("value").isNotNull())
        .select(F.lit(run).alias("run"), name.alias("key"), "value")
    )


def eval_metrics(report: DataFrame, run: str) -> DataFrame:
    """The evaluation report as (run, key, value), under the names that runs are compared by."""
    metrics = F.array(
        F.struct(F.concat(F.lit("bleu_proxy_"), F.col("slice")).alias("key"), F.col("bleu").cast("double").alias("value")),
        F.struct(F.concat(F.lit("bias_length_deviation_"), F.col("slice")).alias("key"), F.col("bias_dev").cast("double").alias("value")),
    )
    return report.select(F.lit(run).alias("run"), F.inline(metrics)).where(F.col("value").isNotNull())


# Training metrics that are left out of a run when given as a negative number.
OPTIONAL_METRICS = ("train_loss_start", "train_loss_best", "train_steps", "train_hours")


def loss_delta(metrics: DataFrame) -> DataFrame:
    """Drops optional metrics that are negative (not given), adds train_loss_delta = start - final."""
    given = metrics.where(~F.col("key").isin(*OPTIONAL_METRICS) | (F.col("value") >= 0))

    def value_of(name: str):
        return F.max(F.when(F.col("key") == name, F.col("value")))

    delta = (value_of("train_loss_start") - value_of("train_loss_final")).alias("value")
    derived = given.groupBy("run").agg(delta).where(F.col("value").isNotNull())
    return given.unionByName(derived.select("run", F.lit("train_loss_delta").alias("key"), "value"))
