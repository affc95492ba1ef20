import json
import math
import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tandem.functions import records as rec
from tandem.operators import bleu, evaluate, profile, quality, slices
from tandem.settings import STAT_METRICS, Rules
from tandem.sinks.writers import sink_report
from tandem.workspace import settle

HAND = [
    {"input": "Our clinic closes at seven", "output": "El consultorio cierra temprano"},
    {"input": "No no no", "output": "no es no"},
    {"input": "Court case 12 opens today", "output": "El caso 12 abre hoy en Court", "domain": "legal"},
]


def test_profile_counts_and_lengths(records):
    rows = [{}] * 5 + [{"input": ""}] * 3 + [{"output": None, "domain": "legal", "input": "one two three four five six seven"}]
    row = profile.profile_report(records(rows)).first()
    assert row["total_records"] == 9
    assert row["domain_distribution"] == {"medical": 8, "legal": 1}
    assert (row["null_input_count"], row["null_output_count"]) == (3, 1)
    assert (row["input_len_mean"], row["input_len_max"], row["input_len_min"]) == (5.33, 7, 5)
    assert (row["output_len_mean"], row["output_len_max"]) == (4.0, 4)


def test_profile_of_three_lengths(records):
    texts = [" ".join(["w"] * n) for n in (3, 5, 7)]
    row = profile.profile_report(records([{"input": text} for text in texts])).first()
    assert (row["input_len_min"], row["input_len_max"], row["input_len_mean"]) == (3, 7, 5.0)


def test_profile_of_nothing(records):
    row = profile.profile_report(records([{}]).limit(0)).first()
    assert row["total_records"] == 0 and row["input_len_mean"] == 0 and row["domain_distribution"] == {}


def test_missing_fields_are_unknown(records):
    got = profile.value_distribution(records([{"domain": None}, {"direction": None}])).collect()
    assert {(r["field"], r["value"], r["records"]) for r in got} == {
        ("domain", "medical", 1), ("domain", "unknown", 1), ("direction", "en_to_es", 1), ("direction", "unknown", 1),
    }


def test_schema_report_and_check(records):
    train = records([{}, {"input": "one two three", "domain": "legal"}])
    schema = profile.schema_report(profile.profile_report(train))
    row = schema.first()
    assert row["required_fields"] == ["instruction", "input", "output", "domain", "direction"]
    assert row["input_len_stats"].asDict() == {"mean": 4.0, "max": 5, "min": 3}
    val = records([{}, {"domain": "finance"}, {"output": ""}, {"input": "one"}, {"direction": None}])
    got = [tuple(r)[-4:] for r in profile.schema_check(val, schema).orderBy("row_no").collect()]
    assert got == [
        (False, False, False, False),
        (False, True, False, False),
        (True, False, False, False),
        (False, False, False, True),
        (True, False, True, False),
    ]


ANOMALOUS = {
    "too_long": {"input": " ".join(["w"] * 250)},
    "too_short": {"input": "Hi"},
    "invalid_domains": {"domain": "finance"},
    "invalid_directions": {"direction": "fr_to_en"},
    "null_inputs": {"input": ""},
    "null_outputs": {"output": None},
}


@pytest.mark.parametrize("category", ANOMALOUS)
def test_each_anomaly_fails_after_the_report(records, category):
    written = []
    df = records([{}] * 20 + [ANOMALOUS[category]])
    with pytest.raises(quality.DatasetRejected):
        quality.anomaly_gate(df, lambda report: written.append(report.first()))
    assert written[0]["action_taken"] == "fail_fast"
    assert (written[0]["records_dropped"], written[0]["records_after_drop"]) == (0, 20)
    assert quality.anomaly_counts(df).first()[category] == 1


def test_clean_records_pass(records):
    written = []
    df = records([{}] * 20)
    assert quality.anomaly_gate(df, lambda report: written.append(report.first())).count() == 20
    assert written[0]["action_taken"] == "validated" and written[0]["anomalies"] == []
    assert written[0]["records_dropped"] is None


def test_many_anomalies_are_dropped(records):
    written = []
    df = records([{}] * 4 + [{"input": "Hi", "domain": "x"}] * 3)
    out = quality.anomaly_gate(df, lambda r: written.append(r.first()), Rules(anomaly_drop_threshold=2))
    assert out.count() == 4
    assert written[0]["anomalies"] == ["Sentences too short: 3 records", "Invalid domains: 3 records"]
    assert (written[0]["action_taken"], written[0]["records_dropped"]) == ("drop_and_continue", 3)
    with pytest.raises(quality.DatasetRejected):
        quality.anomaly_gate(df, lambda r: None, Rules(anomaly_drop_threshold=3))


def test_whitespace_input_is_short_not_null(records):
    row = quality.anomaly_counts(records([{"input": "  "}])).first()
    assert (row["null_inputs"], row["too_short"]) == (0, 1)


@pytest.mark.parametrize("train, approved", [(10_000, True), (9_999, False)])
def test_approval(spark, train, approved):
    parts = {"train": train, "val": 500, "test": 400}
    splits = spark.range(sum(parts.values())).select(
        F.when(F.col("id") < train, "train").when(F.col("id") < train + 500, "val").otherwise("test").alias("split")
    )
    now = datetime(2026, 1, 2, 3, 4, 5)
    if not approved:
        with pytest.raises(quality.DatasetRejected):
            quality.approval_gate(splits, now=now)
        return
    row = quality.approval_gate(splits, now=now).first()
    assert row.asDict() == {
        "approved": True, "timestamp": "2026-01-02 03:04:05.000000", "train_records": train, "val_records": 500,
        "test_records": 400, "version": "v2_approved",
    }


# Published slice statistics and the deviations that follow from them.
STATS = {
    "overall": (265474, 18.39, 18.4, 1.03, 0.055, 0.055, 0.055),
    "medical": (158075, 12.97, 12.96, 1.037, 0.103, 0.103, 0.071),
    "legal": (107399, 26.37, 26.39, 1.02, 0.041, 0.041, 0.03),
    "en_to_es": (132921, 18.08, 18.75, 1.029, 0.052, 0.063, 0.055),
    "es_to_en": (132553, 18.71, 18.04, 1.032, 0.063, 0.052, 0.055),
    "short_sents": (147389, 7.72, 7.96, 1.055, 0.121, 0.118, 0.067),
    "long_sents": (48927, 45.09, 44.06, 0.982, 0.06, 0.061, 0.041),
}
DEVIATIONS = {
    "medical": (-0.295, -0.296, 0.007, 0.873, 0.873, 0.291),
    "legal": (0.434, 0.434, -0.01, -0.255, -0.255, -0.455),
    "en_to_es": (-0.017, 0.019, -0.001, -0.055, 0.145, 0.0),
    "es_to_en": (0.017, -0.02, 0.002, 0.145, -0.055, 0.0),
    "short_sents": (-0.58, -0.567, 0.024, 1.2, 1.145, 0.218),
    "long_sents": (1.452, 1.395, -0.047, 0.091, 0.109, -0.255),
}


@pytest.fixture
def published(spark):
    schema = "slice string, count bigint, " + ", ".join(f"{name} double" for name in STAT_METRICS)
    return spark.createDataFrame([(name, *values) for name, values in STATS.items()], schema)


def test_published_deviations(published):
    scores = slices.bias_scores(published)
    got = {(r["slice"], r["metric"]): r["deviation"] for r in scores.collect()}
    assert got == {(name, m): d for name, row in DEVIATIONS.items() for m, d in zip(STAT_METRICS, row)}
    flags = {r["slice"]: r for r in slices.bias_flags(scores).collect()}
    assert sorted(flags) == ["legal", "long_sents", "medical", "short_sents"]
    assert flags["long_sents"]["summary"] == (
        "Slice 'long_sents' shows bias in: avg_input_len, avg_output_len, avg_word_overlap"
    )
    assert flags["medical"]["issues"][0].asDict() == {
        "metric": "avg_input_len", "deviation": -0.295, "direction": "UNDER", "slice_val": 12.97, "overall_val": 18.39,
    }


def test_slice_statistics_take_one_scan_and_reports_no_join(spark, records, published):
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    stored = settle(records(HAND), "hand")
    assert plan(slices.slice_stats(stored)).count("Relation [") == 1 and "Join" not in plan(slices.slice_stats(stored))
    assert "Join" not in plan(slices.bias_report(published)) and plan(slices.bias_report(published)).count("Aggregate") == 1
    assert "Join" not in plan(profile.profile_report(stored)) and plan(profile.profile_report(stored)).count("Relation [") == 1


def test_reports_without_an_overall_row_or_any(spark, published):
    some = slices.bias_report(published.where("slice <> 'overall'")).first()
    assert some["overall_stats"] is None and some["bias_scores"] == {} and some["total_slices"] == 6 and not some["bias_detected"]
    none = slices.bias_report(published.limit(0)).first()
    assert none["slice_stats"] == {} and none["bias_summary"] == [] and not any(none["cross_slice_analysis"])
    assert slices.bias_scores(published.limit(0)).count() == slices.cross_slice_gaps(published.limit(0)).count() == 0


def test_a_learned_schema_knows_values_that_no_setting_names(records):
    rows = [{"domain": "news", "input": "w " * n, "output": f"o{n}"} for n in range(1, 101)]
    rows += [{"domain": "sports", "direction": "fr_to_en", "input": "a b", "output": "x"}] * 2 + [{"domain": None, "input": "", "output": "y"}]
    schema = profile.learned_schema(records(rows)).first()
    assert schema["valid_domains"] == ["news"] and schema["valid_directions"] == ["en_to_es"] and schema["total_records"] == 103
    assert schema["null_counts"]["input"] == 1 and (schema["input_len_stats"]["min"], schema["input_len_stats"]["max"]) == (1, 99)
    probe = [{"domain": "news"}, {"domain": "medical"}, {"direction": "fr_to_en", "domain": "news"}, {"domain": "news", "input": "w " * 150}]
    learned = profile.learned_schema(records(rows))
    got = [tuple(r)[-3:] for r in profile.schema_check(records(probe), learned).orderBy("row_no").collect()]
    assert got == [(False, False, False), (True, False, False), (False, True, False), (False, False, True)]
    assert profile.learned_schema(records([{}]).limit(0)).first()["valid_domains"] == []


def test_bias_report_document(spark, published, tmp_path):
    sink_report(slices.bias_report(published), f"{tmp_path}/bias")
    report = json.loads(spark.read.text(f"{tmp_path}/bias", wholetext=True).first()[0])
    assert (report["total_slices"], report["biased_slices"], report["bias_detected"]) == (6, 4, True)
    assert [flag["slice"] for flag in report["bias_flags"]] == ["medical", "legal", "short_sents", "long_sents"]
    assert report["overall_stats"]["count"] == 265474
    assert report["bias_scores"]["long_sents"]["avg_input_len"] == 1.452
    assert report["cross_slice_analysis"] == {"domain_bias": True, "direction_bias": True, "length_bias": True}
    assert len(report["bias_summary"]) == 4


def test_gaps_need_both_slices(published):
    gaps = slices.cross_slice_gaps(published).orderBy("rank").collect()
    assert [round(g["gap"], 3) for g in gaps] == [0.017, 0.011, 0.026]
    assert not any(g["detected"] for g in gaps)
    wide = published.withColumn("avg_length_ratio", F.when(F.col("slice") == "legal", 2.0).otherwise(F.col("avg_length_ratio")))
    first = slices.cross_slice_gaps(wide.where("slice <> 'long_sents'")).orderBy("rank").collect()
    assert len(first) == 2
    assert first[0]["message"] == "Domain bias detected: medical length_ratio=1.037 vs legal=2.000 (gap=0.963)"


def test_status_text(column):
    texts = column(rec.bias_status(F.col("x"), 0.2), [0.218, -0.455, 0.2], "x double")
    assert texts == ["BIASED (OVER by 21.8%)", "BIASED (UNDER by 45.5%)", "OK"]


def test_hand_case_statistics(records):
    row = slices.slice_stats(records(HAND)).where("slice = 'overall'").first()
    want = (3, 13 / 3, 14 / 3, 16 / 15, 12 / 13, 12 / 14, 7 / 15)
    got = (row["count"], *(row[name] for name in STAT_METRICS))
    assert got == pytest.approx(want)


def test_empty_slices_are_absent(records):
    names = {r["slice"] for r in slices.slice_stats(records(HAND)).collect()}
    assert names == {"overall", "medical", "legal", "en_to_es", "short_sents"}


def test_slices_overlap(records):
    got = slices.assign_slices(records([{}, {"domain": "x", "direction": "y", "input": " ".join(["w"] * 20)}])).collect()
    assert sorted(r["slice"] for r in got) == ["en_to_es", "medical", "short_sents"]


def test_hand_case_bleu(records):
    row = bleu.corpus_bleu(records(HAND)).first()
    assert [row[f"match_{n}"] for n in (1, 2, 3, 4)] == [4, 0, 0, 0]
    assert [row[f"total_{n}"] for n in (1, 2, 3, 4)] == [14, 11, 8, 5]
    assert row["ref_len"] == 13
    assert row["bleu"] == pytest.approx(5.643842, abs=1e-6)


def brute_bleu(pairs):
    match, total, hyp_len, ref_len = [0] * 4, [0] * 4, 0, 0
    for ref, hyp in pairs:
        h, r = hyp.split(), ref.split()
        hyp_len, ref_len = hyp_len + len(h), ref_len + len(r)
        for n in range(1, 5):
            grams = [Counter(tuple(t[i : i + n]) for i in range(len(t) - n + 1)) for t in (h, r)]
            match[n - 1] += sum((grams[0] & grams[1]).values())
            total[n - 1] += sum(grams[0].values())
    if not any(match) or not all(total):
        return match, 0.0
    logs, smooth = 0.0, 1
    for m, t in zip(match, total):
        smooth *= 2 if m == 0 else 1
        logs += math.log(100 * m / t if m else 100 / (smooth * t))
    return match, (1.0 if hyp_len >= ref_len else math.exp(1 - ref_len / hyp_len)) * math.exp(logs / 4)


@pytest.mark.parametrize("seed", range(3))
def test_bleu_against_counting_by_hand(records, seed):
    rng = random.Random(seed)
    pairs = [
        (" ".join(rng.choices("abcd", k=rng.randint(1, 30))), " ".join(rng.choices("abcx", k=rng.randint(1, 30))))
        for _ in range(40)
    ]
    row = bleu.corpus_bleu(records([{"input": a, "output": b} for a, b in pairs])).first()
    match, score = brute_bleu(pairs)
    assert [row[f"match_{n}"] for n in (1, 2, 3, 4)] == match
    assert row["bleu"] == pytest.approx(score)


def test_bleu_of_copies_and_of_nothing(records):
    same = bleu.corpus_bleu(records([{"input": "a b c d e a b", "output": "a b c d e a b"}])).first()
    assert same["bleu"] == pytest.approx(100.0)
    assert bleu.corpus_bleu(records([{"input": "a b", "output": "c d"}])).first()["bleu"] == 0.0
    assert bleu.corpus_bleu(records([{}]).limit(0)).first()["bleu"] == 0.0


def test_slice_bleu_needs_two_records(records):
    got = {r["slice"]: r["count"] for r in bleu.slice_bleu(records(HAND), 2).collect()}
    assert got == {"medical": 2, "en_to_es": 2, "short_sents": 2}


def test_eval_gate(records):
    df = records(HAND * 3)
    report = {r["slice"]: r for r in evaluate.eval_gate(df).collect()}
    assert report["overall"]["bias_dev"] is None and report["overall"]["passed"]
    assert report["legal"]["bias_dev"] == 0.154 and report["legal"]["cap"] == 0.5
    assert report["short_sents"]["cap"] == 2.0
    with pytest.raises(quality.DatasetRejected, match="BLEU"):
        evaluate.eval_gate(df, Rules(bleu_threshold=90.0))
    with pytest.raises(quality.DatasetRejected, match="slice"):
        evaluate.eval_gate(df, Rules(slice_cap=0.154))


def test_sensitivity_report(records):
    row = evaluate.sensitivity_report(records(HAND)).first()
    assert row["length_sensitivity"]["short_count"] == 3 and row["length_sensitivity"]["long_length_ratio"] == 0.0
    assert row["length_sensitivity"]["short_length_ratio"] == 1.067
    assert row["domain_sensitivity"].asDict() == {
        "medical_output_diversity": 0.8571, "legal_output_diversity": 1.0, "medical_count": 2, "legal_count": 1,
    }
    assert row["direction_sensitivity"]["en_to_es_avg_output_len"] == 4.667
    assert row["direction_sensitivity"]["es_to_en_count"] == 0


def test_run_metrics(spark):
    results = spark.createDataFrame([(9.35, 6.25, -1.0)], "train_loss_start double, train_loss_final double, train_steps double")
    got = {r["key"]: r["value"] for r in evaluate.loss_delta(evaluate.run_metrics(results, "r1")).collect()}
    assert got == {"train_loss_start": 9.35, "train_loss_final": 6.25, "train_loss_delta": pytest.approx(3.1)}
    unknown = results.withColumn("train_loss_start", F.lit(-1.0))
    got = {r["key"] for r in evaluate.loss_delta(evaluate.run_metrics(unknown, "r1")).collect()}
    assert got == {"train_loss_final"}


def test_evaluation_covers_all_rows_unless_heads_are_asked_for(records):
    df = records(HAND * 200)
    report = {r["slice"]: r["count"] for r in evaluate.eval_report(df).collect()}
    assert report["overall"] == 200 * len(HAND) > 500
    heads = {r["slice"]: r["count"] for r in evaluate.eval_report(df, Rules(eval_head=500, eval_slice_head=200)).collect()}
    assert heads["overall"] == 500 and heads["medical"] == 200
