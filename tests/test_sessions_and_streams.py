import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tandem.functions import records as rec
from tandem.operators import monitor, sampling, sessions, translate
from tandem.operators.ranking import running_total
from tandem.plans import queries
from tandem.streaming import jobs

T0 = dt.datetime(2024, 1, 1)


def test_running_total_matches_a_plain_window(spark):
    rng = random.Random(1)
    rows = [(("hot" if i % 3 else f"k{i % 7}"), i, rng.randint(1, 9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, at bigint, w int").repartition(6)
    got = running_total(df, ["k"], ["at"], "total", F.col("w"))
    want = df.selectExpr("k", "at", "w", "sum(w) over (partition by k order by at) total")
    assert got.select("k", "at", "w", "total").exceptAll(want).count() == 0 and got.count() == 3000


def test_positions_of_a_hot_group_by_time(spark):
    """Two thirds of 60,000 rows are one group, positions are times with gaps from microseconds to days, and a group is null."""
    df = spark.range(60_000, numPartitions=5).selectExpr(
        "if(id % 3 = 0, if(id % 6 = 0, null, 'cold'), 'hot') k", "timestamp_micros(id * id * 7919) at", "id", "id % 11 w"
    )
    plain = df.selectExpr("id", "sum(w) over (partition by k order by at) total", "row_number() over (partition by k order by at) n")
    got = running_total(running_total(df, ["k"], ["at"], "total", F.col("w")), ["k"], ["at"], "n")
    assert got.select("id", "total", F.col("n").cast("int")).exceptAll(plain).count() == 0 and got.count() == 60_000


def test_group_by_length_is_exact(spark, records):
    df = records([{"input": " ".join(["w"] * (1 + i % 5)), "output": f"o{i}"} for i in range(103)])
    got = sampling.group_by_length(df, 10).groupBy("batch_no").agg(F.count("*").alias("n"), F.min("n_in"), F.max("n_in"))
    rows = sorted(tuple(r) for r in got.collect())
    assert [r[1] for r in rows] == [10] * 10 + [3]
    assert all(a[3] <= b[2] for a, b in zip(rows, rows[1:]))


def test_packing_fills_windows(spark, records):
    df = records([{"output": f"o{i}"} for i in range(300)]).withColumn("n_tokens", (F.col("row_no") % 50).cast("int"))
    windows = sampling.packed_windows(sampling.pack_sequences(df, 16, shard_digits=1)).collect()
    assert sum(r["tokens"] for r in windows) == sum(i % 50 for i in range(300))
    last = {}
    for r in windows:
        last[r["shard"]] = max(last.get(r["shard"], 0), r["window_no"])
    assert all(r["tokens"] == 16 for r in windows if r["window_no"] < last[r["shard"]])


def test_oversampling_reaches_the_share(spark, records):
    df = records([{"domain": "legal" if i % 5 == 0 else "medical", "output": f"o{i}"} for i in range(2000)])
    out = sampling.oversample_domain(df, "legal", 0.5)
    counts = {r["domain"]: r["count"] for r in out.groupBy("domain").count().collect()}
    assert counts["medical"] == 1600 and abs(counts["legal"] - 1600) < 80
    same = sampling.oversample_domain(df, "legal", 0.1)
    assert same.count() == 2000


def test_final_lines_and_index(spark):
    rows = [("a", 0, False, "par"), ("a", 1, True, " partial "), ("a", 2, True, "  "), ("a", 5, True, "x"), ("b", 1, True, "y")]
    events = spark.createDataFrame(rows, "session string, turn bigint, is_final boolean, text string")
    got = sessions.line_index(sessions.final_transcripts(events), "session", "turn")
    assert sorted((r["session"], r["idx"], r["text"]) for r in got.collect()) == [
        ("a", 0, "partial"), ("a", 1, "x"), ("b", 0, "y"),
    ]


def test_line_updates_and_export(spark):
    rows = [
        ("s", 0, 1, "hola", "", True), ("s", 0, 2, None, "hello", False), ("s", 1, 3, "adios", "", True),
        ("s", 2, 4, "uno", "", True), ("s", 2, 5, None, "Error: timeout", False),
    ]
    schema = "session string, idx bigint, seq bigint, source string, translated string, pending boolean"
    state = sessions.latest_lines(spark.createDataFrame(rows, schema))
    got = {r["idx"]: (r["source"], r["translated"], r["pending"]) for r in state.collect()}
    assert got == {0: ("hola", "hello", False), 1: ("adios", "", True), 2: ("uno", "Error: timeout", False)}
    text = sessions.transcript_export(state).first()["text"]
    assert text == "[1] hola\n  \u2192 hello\n\n[2] adios\n  \u2192 ...\n\n[3] uno\n  \u2192 Error: timeout"
    pages = sessions.transcript_export(state, page_lines=2).orderBy("page").collect()
    assert "\n\n".join(p["text"] for p in pages) == text


def brute_sessions(events, gap):
    out, last = [], {}
    for user, at in sorted(events):
        if user in last and (at - last[user]["end"]).total_seconds() < gap:
            last[user]["end"], last[user]["n"] = at, last[user]["n"] + 1
        else:
            last[user] = {"user": user, "start": at, "end": at, "n": 1}
            out.append(last[user])
    return sorted((s["user"], s["start"], s["end"], s["n"]) for s in out)


@pytest.mark.parametrize("block", ["minute", "hour", "day"])
def test_sessions_across_blocks(spark, block):
    rng = random.Random(3)
    events = [(1, T0 + dt.timedelta(seconds=rng.randint(0, 4 * 86400))) for _ in range(700)]
    events += [(u, T0 + dt.timedelta(minutes=20 * i)) for u, n in ((2, 200), (3, 1)) for i in range(n)]
    events += [(4, T0), (4, T0 + dt.timedelta(minutes=30)), (4, T0 + dt.timedelta(minutes=59, seconds=59))]
    df = spark.createDataFrame(events, "u int, at timestamp")
    got = sessions.session_summary(df, "u", "at", 1800, block).collect()
    assert sorted((r["user"], r["start"], r["end"], r["events"]) for r in got) == brute_sessions(events, 1800)


def test_latency_direction_and_errors(spark, column):
    df = spark.createDataFrame([(T0, T0 + dt.timedelta(microseconds=1234567))], "a timestamp, b timestamp")
    assert df.select(rec.latency_ms(F.col("a"), F.col("b"))).first()[0] == 1234.57
    direction = rec.direction_from_langs(F.col("a"), F.col("b"))
    pairs = [("english", "spanish"), ("spanish", "english"), ("german", "english"), (None, "english")]
    assert column(direction, pairs, "a string, b string") == ["en_to_es", "es_to_en", "en_to_es", "en_to_es"]
    shown = sessions.answered(F.col("a"), F.col("b"))
    assert column(shown, [("hi", None), ("", "503")], "a string, b string") == ["hi", "Error: 503"]


def test_batch_translate_keeps_failed_rows(spark):
    def load():
        words = {"a": " A ", "b": "B"}
        return lambda prompts: [words[prompt] for prompt in prompts]

    df = spark.createDataFrame([("a",), ("b",), ("zzz",)], "prompt string").coalesce(1)
    got = translate.batch_translate(df, load, batch=2).collect()
    assert [(r["prompt"], r["translated"]) for r in got] == [("a", "A"), ("b", "B"), ("zzz", "")]
    assert got[0]["error"] is None and "zzz" in got[2]["error"]
    assert all(r["latency_ms"] >= 0 for r in got)
    # A batch of the wrong length is tried row by row, and a null prompt fails alone.
    short = translate.batch_translate(df, lambda: lambda prompts: ["x"], batch=2).collect()
    assert [r["translated"] for r in short] == ["x", "x", "x"]
    mixed = spark.createDataFrame([("a",), ("zzz",), (None,), ("b",)], "prompt string").coalesce(1)
    rows = translate.batch_translate(mixed, load, batch=64).collect()
    assert [r["translated"] for r in rows] == ["A", "", "", "B"]
    assert [r["error"] is None for r in rows] == [True, False, False, True]


def test_missing_domain_is_not_oversampled(spark, records):
    df = records([{}] * 3)
    assert sampling.oversample_domain(df, "legal", 0.9).count() == 3
    with pytest.raises(ValueError, match="share"):
        sampling.oversample_domain(df, "medical", 1.0)


def test_line_index_keeps_null_sessions_and_positions(spark):
    rows = [("a", 5), ("a", None), (None, 1), (None, 2), ("a", 7)]
    got = sessions.line_index(spark.createDataFrame(rows, "s string, p bigint"), "s", "p").collect()
    assert {(r["s"], r["p"], r["idx"]) for r in got} == {("a", None, 0), ("a", 5, 1), ("a", 7, 2), (None, 1, 0), (None, 2, 1)}


def log_rows(spark, minutes, name, path):
    rows = [(T0 + dt.timedelta(minutes=m), "en_to_es", "medical", float(v), 2, 4) for m, v in minutes]
    schema = "timestamp timestamp, direction string, domain string, latency_ms double, input_len int, output_len int"
    df = spark.createDataFrame(rows, schema).coalesce(1)
    df.write.mode("append").parquet(path)
    return df.schema


def test_monitor_exact_percentile_and_slide(spark, tmp_path):
    rng = random.Random(5)
    values = [(i % 120, rng.randint(1, 40)) for i in range(500)]
    log_rows(spark, values, "log", f"{tmp_path}/log")
    log = spark.read.parquet(f"{tmp_path}/log")
    first = monitor.monitor_window(log).orderBy("window_start").first()
    inside = sorted(v for m, v in values if m < 60)
    assert first["n"] == len(inside) and first["latency_p95"] == inside[-(-len(inside) * 95 // 100) - 1]
    assert first["out_in_ratio"] == 2.0
    slid = monitor.monitor_window(log, "1 hour", "30 minutes")
    assert slid.agg(F.sum("n")).first()[0] == 1000


def test_stream_drops_rows_behind_the_watermark(spark, tmp_path):
    path, out = f"{tmp_path}/log", f"{tmp_path}/out"
    schema = log_rows(spark, [(0, 10), (200, 30)], "a", path)
    stream = jobs.read_files(spark, path, schema, files=1)
    jobs.stream_monitor(stream, out).awaitTermination()
    log_rows(spark, [(10, 99), (190, 50)], "b", path)
    jobs.stream_monitor(jobs.read_files(spark, path, schema, files=1), out).awaitTermination()
    got = {r["window_start"]: (r["n"], r["latency_mean"]) for r in jobs.read_monitor(spark, out).collect()}
    assert got == {T0: (1, 10.0), T0 + dt.timedelta(hours=3): (2, 40.0)}


def test_stream_percentile_is_exact_in_large_windows(spark, tmp_path):
    rng = random.Random(7)
    values = [(i % 60, rng.randint(1, 10**6) / 100) for i in range(24_000)]
    schema = log_rows(spark, values, "a", f"{tmp_path}/log")
    jobs.stream_monitor(jobs.read_files(spark, f"{tmp_path}/log", schema), f"{tmp_path}/out").awaitTermination()
    row = jobs.read_monitor(spark, f"{tmp_path}/out").first()
    assert (row["n"], row["latency_p95"]) == (24_000, sorted(v for _, v in values)[24_000 * 95 // 100 - 1])


def test_stream_numbers_lines_across_batches_and_replays(spark, tmp_path):
    path, out = f"{tmp_path}/in", f"{tmp_path}/out"
    schema = "session string, turn bigint, is_final boolean, text string"
    batches = [[("a", 1, True, "x"), ("b", 1, True, "y"), ("a", 2, False, "i")], [("a", 3, True, "z")], [("c", 1, True, "q"), ("b", 9, True, "r")]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        stream = jobs.read_files(spark, path, spark.read.parquet(path).schema, files=1)
        jobs.stream_final_lines(stream, out).awaitTermination()
    got = sorted((r["session"], r["turn"], r["idx"]) for r in jobs.read_lines_table(spark, out, "session", "turn").collect())
    assert got == [("a", 1, 0), ("a", 3, 1), ("b", 1, 0), ("b", 9, 1), ("c", 1, 0)]


def test_streaming_sessions_match_batch_once_closed(spark, tmp_path):
    path = f"{tmp_path}/in"
    schema = "u int, at timestamp"
    early = [(1, T0), (1, T0 + dt.timedelta(minutes=10)), (1, T0 + dt.timedelta(minutes=50))]
    for rows in (early, [(2, T0 + dt.timedelta(days=1))], [(2, T0 + dt.timedelta(days=1, minutes=1))]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    stream = jobs.read_files(spark, path, spark.read.parquet(path).schema, files=1)
    query = (
        jobs.stream_sessions(stream, "u", "at").writeStream.outputMode("append").format("parquet")
        .option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = sorted((r["user"], r["start"], r["end"], r["events"]) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == brute_sessions(early, 1800)


def test_inference_log_counts_words(spark):
    rows = [(T0, "a b  c", "x", "en_to_es", "legal", 12.345)]
    schema = "timestamp timestamp, input_text string, translated_text string, direction string, domain string, latency_ms double"
    row = monitor.inference_log(spark.createDataFrame(rows, schema)).first()
    assert (row["input_len"], row["output_len"]) == (3, 1)


UPDATES = "session string, idx bigint, seq bigint, source string, translated string, pending boolean"


def random_updates(n, seed=4):
    rnd = random.Random(seed)
    pick = lambda make: make() if rnd.random() < 0.6 else None
    return [
        (f"s{rnd.randrange(4)}", rnd.randrange(6), i, pick(lambda: f"t{rnd.randrange(99)}"), pick(lambda: f"u{rnd.randrange(99)}"), pick(lambda: rnd.random() < 0.5))
        for i in range(n)
    ]


def plain_lines(rows):
    state = {}
    for session, idx, seq, *values in sorted(rows, key=lambda r: r[2]):
        line = state.setdefault((session, idx), [seq, None, None, None])
        line[0] = seq
        for i, value in enumerate(values, 1):
            line[i] = line[i] if value is None else value
    return sorted((*k, *v) for k, v in state.items())


def test_a_read_after_a_thousand_batches_opens_few_files(spark, tmp_path):
    """Updates come in any order: late ones are merged by their number, before and after the compaction."""
    out, rows = str(tmp_path), random_updates(1200)
    random.Random(1).shuffle(rows)
    batches = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], f"{UPDATES}, batch bigint")
    write = lambda df: sessions.collapse_updates(df.drop("batch"))
    one_each = batches.select("session", "idx", "seq", *(F.when(F.col(c).isNotNull(), F.struct("seq", F.col(c).alias("value"))).alias(c) for c in sessions.LINE_FIELDS), "batch")
    one_each.where("batch < 1000").coalesce(1).write.partitionBy("batch").parquet(f"{out}/updates")
    jobs.compact_lines(spark, out)
    for number in (1000, 1001):
        write(batches.where(F.col("batch") % 2 == number % 2).where("batch >= 1000")).write.mode("overwrite").parquet(f"{out}/updates/batch={number}")
    # A replayed batch that the compaction holds, and one that it does not.
    write(batches.where("batch = 999")).write.mode("overwrite").parquet(f"{out}/updates/batch=999")
    write(batches.where("batch >= 1000 and batch % 2 = 1")).write.mode("overwrite").parquet(f"{out}/updates/batch=1001")
    state = jobs.read_line_state(spark, out)
    assert sorted(map(tuple, state.collect())) == plain_lines(rows)
    opened = jobs._line_tables(spark, out)[0].select(F.input_file_name().alias("f")).distinct().count()
    assert opened <= 20
    jobs.compact_lines(spark, out)
    jobs.compact_lines(spark, out)
    assert sorted(map(tuple, jobs.read_line_state(spark, out).collect())) == plain_lines(rows)
    assert jobs._compactions(spark, out).count() == 2


def test_a_failed_compaction_changes_nothing(spark, tmp_path, monkeypatch):
    out, rows = str(tmp_path), random_updates(60)
    for number in range(3):
        part = spark.createDataFrame(rows[number * 20 : number * 20 + 20], UPDATES)
        sessions.collapse_updates(part).write.parquet(f"{out}/updates/batch={number}")
    monkeypatch.setattr(jobs.uuid, "uuid4", lambda: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        jobs.compact_lines(spark, out)
    monkeypatch.undo()
    assert jobs._compactions(spark, out).count() == 0
    assert sorted(map(tuple, jobs.read_line_state(spark, out).collect())) == plain_lines(rows)


def test_streamed_sessions_drop_only_what_is_later_than_the_watermark(spark, tmp_path):
    at = lambda minutes: T0 + dt.timedelta(minutes=minutes)
    batches = [[("a", at(0)), ("a", at(20)), ("b", at(5))], [("a", at(90)), ("a", at(40))], [("b", at(400))], [("a", at(395))], [("b", at(10))], [("z", at(5000))]]
    path, out = f"{tmp_path}/in", f"{tmp_path}/out"
    for rows in batches:
        spark.createDataFrame(rows, "user string, ts timestamp").coalesce(1).write.mode("append").parquet(path)
    stream = jobs.stream_sessions(jobs.read_files(spark, path, spark.read.parquet(path).schema, files=1), "user", "ts")
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}/_c").trigger(availableNow=True).start().awaitTermination()
    got = sorted((r["user"], r["start"], r["end"], r["events"]) for r in spark.read.parquet(out).collect())
    # The event of minute 40 is late but within the hour; that of minute 10 comes when its session is closed.
    want = [("a", at(0), at(40), 3), ("a", at(90), at(90), 1), ("a", at(395), at(395), 1), ("b", at(5), at(5), 1), ("b", at(400), at(400), 1)]
    assert got == want


def test_registered_session_stream_reads_files_of_bounded_length(spark, tmp_path, monkeypatch):
    """One input file of 1,000 events reaches the stream as many files, all in one micro-batch."""
    monkeypatch.setattr(queries, "EVENTS_PER_FILE", 100)
    read, paths = jobs.read_files, []
    monkeypatch.setattr(jobs, "read_files", lambda s, path, *more, **named: paths.append(path) or read(s, path, *more, **named))
    rng = random.Random(3)
    rows = [(rng.randrange(9) or None, T0 + dt.timedelta(seconds=rng.randrange(500_000)) if i % 50 else None) for i in range(1000)]
    spark.createDataFrame(rows, "user_id bigint, ts timestamp_ntz").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    got = queries.QUERIES["stream_sessions"](spark, str(tmp_path))
    events = spark.read.parquet(f"{tmp_path}/events.parquet").where("user_id is not null and ts is not null")
    want = queries.rounded(sessions.session_summary(events, "user_id", "ts")).select("user", "start", "end", "events")
    assert sorted(got.collect()) == sorted(want.collect())
    files = spark.read.parquet(paths[-1]).groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in files) <= 100 and sum(r["count"] for r in files) == 1001
