import json

import pytest
from pyspark.sql import functions as F

from tandem.operators.quality import DatasetRejected
from tandem.plans.flow import run_corpus
from tandem.settings import Rules
from tandem.sinks import writers
from tandem.sources import bitext, digest, files
from tandem.workspace import settle


def pair_line(en, es):
    return json.dumps({"translation": {"en": en, "es": es}}, ensure_ascii=False)


BAD = [
    "{bad", "", "   ", "[1, 2]", '"text"', "null", '{"translation": null}', '{"translation": "x"}', '{"translation": ["x"]}',
    '{"translation": {"en": 5, "es": "cinco"}}', '{"translation": {"en": ["a b c d"], "es": "a b c d"}}',
    '{"translation": {"en": null, "es": "a b c d"}}', '{"translation": {"en": {"a": 1}, "es": "a b c d"}}',
]


def test_bad_lines_vanish_and_missing_sides_are_empty(spark, tmp_path):
    lines = [pair_line("Hi café", "Hola"), *BAD, "{}", '{"translation": {"en": "only"}}']
    (tmp_path / "a.jsonl").write_text("\n".join(lines), encoding="utf-8")
    got = bitext.scan_bitext(spark, f"{tmp_path}/a.jsonl").orderBy(*bitext.LINE_ORDER).collect()
    assert [(r["en"], r["es"]) for r in got] == [("Hi café", "Hola"), ("", ""), ("only", "")]


def test_lines_are_valid_as_python_has_it(spark, tmp_path):
    """Repeated keys, numbers that are none, text behind the document: what json.loads takes is kept, the rest goes."""
    pair = '"translation": {"en": "a", "es": "b"}'
    lines = [
        f'{{"score": NaN, {pair}}}', f'{{"score": [-Infinity, Infinity], {pair}}}', f'{{{pair}, "note": "NaN \\" Infinity", "x": NaN}}',
        '{"translation": {"en": "a", "es": "b", "en": "c"}}', f'{{"x": 1, "x": 2, {pair}}}', f'{{"translation": 5, {pair}}}',
        f"{{{pair}}} x", f"{{{pair}}}{{{pair}}}", f"{{{pair}}}, {{{pair}}}", f'{{"score": -NaN, {pair}}}', f'{{"score": nan, {pair}}}',
        f'{{"score": "NaN, {pair}}}', f"  {{{pair}}}  ", f'{{"x": "Infinity", {pair}}}', '{"translation": {"en": "NaN", "es": "Infinity"}}',
    ]

    def plain(line):
        try:
            found = json.loads(line)["translation"]
            return found["en"], found["es"]
        except (json.JSONDecodeError, TypeError):
            return None

    (tmp_path / "a.jsonl").write_text("\n".join(lines))
    before = spark.conf.get("spark.sql.variant.allowDuplicateKeys")
    got = [(r["en"], r["es"]) for r in bitext.scan_bitext(spark, f"{tmp_path}/a.jsonl").orderBy(*bitext.LINE_ORDER).collect()]
    assert got == [x for x in map(plain, lines) if x] and len(got) == 9
    assert spark.conf.get("spark.sql.variant.allowDuplicateKeys") == before


def test_line_order_over_blocks(spark, tmp_path):
    lines = [pair_line(f"line {i}", "x") for i in range(2000)]
    (tmp_path / "a.jsonl").write_text("\n".join(lines), encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        scan = bitext.scan_bitext(spark, f"{tmp_path}/a.jsonl")
        assert scan.rdd.getNumPartitions() > 3
        got = [r["en"] for r in scan.orderBy(*bitext.LINE_ORDER).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [f"line {i}" for i in range(2000)]


def test_records_round_trip_and_fail_fast(spark, records, tmp_path):
    writers.sink_records(records([{"output": "ñandú"}, {"input": "x"}]), f"{tmp_path}/r")
    back = bitext.scan_records(spark, f"{tmp_path}/r")
    assert back.columns == list(bitext.RECORD_FIELDS) and back.where("output = 'ñandú'").count() == 1
    assert any("ñandú" in p.read_text(encoding="utf-8") for p in (tmp_path / "r").glob("part-*"))
    (tmp_path / "bad.json").write_text('{"input": "a"}\n\n{bad\n')
    with pytest.raises(Exception, match="MALFORMED"):
        bitext.scan_records(spark, f"{tmp_path}/bad.json").collect()
    (tmp_path / "ok.json").write_text('{"input": "a"}\n\n   \n{"input": "b"}\n')
    assert bitext.scan_records(spark, f"{tmp_path}/ok.json").count() == 2


def sources(tmp_path):
    first = [pair_line(f"Ward number {i} receives visitors every morning", f"La sala {i} recibe visitas temprano") for i in range(400)]
    second = first[:50] + [pair_line(f"Court case {i} opens today", f"El caso {i} abre hoy") for i in range(300)]
    (tmp_path / "med.jsonl").write_text("\n".join([*first, *BAD]), encoding="utf-8")
    (tmp_path / "law.jsonl").write_text("\n".join(second), encoding="utf-8")
    return [("med", f"{tmp_path}/med.jsonl", "medical"), ("law", f"{tmp_path}/law.jsonl", "legal")]


def write_manifest(spark, tmp_path):
    manifest = files.source_manifest(spark, sources(tmp_path))
    files.manifest_json(manifest).coalesce(1).write.text(f"{tmp_path}/manifest")
    return manifest


def test_manifest(spark, tmp_path):
    write_manifest(spark, tmp_path)
    rows = bitext.read_manifest(spark, f"{tmp_path}/manifest").orderBy("rank").collect()
    assert [(r["name"], r["domain"]) for r in rows] == [("med", "medical"), ("law", "legal")]
    assert rows[0]["checksum"] == digest.checksum_of((tmp_path / "med.jsonl").read_bytes())


def test_one_scan_for_all_sources(spark, tmp_path):
    """A hundred sources, one of them inside another's folder, one with a folder of its own inside, one given by a pattern."""
    names = []
    for i in range(100):
        folder = tmp_path / ("s0/inner" if i == 1 else f"s{i}")
        (folder / "deep" if i == 2 else folder).mkdir(parents=True)
        file = folder / ("deep/a b%20.jsonl" if i == 2 else "a.jsonl")
        file.write_text(pair_line(f"text of source {i}", "x") + "\n")
        names.append((i, f"n{i}", f"{tmp_path}/s3*/a.js*l" if i == 3 else str(folder) + "/" * (i % 2), f"d{i % 2}"))
    names = [n for n in names if n[0] == 3 or not n[1].startswith("n3")]
    manifest = spark.createDataFrame(names, "rank int, name string, path string, domain string")
    scan = bitext.scan_manifest_sources(spark, manifest)
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and "Union" not in plan
    got = {(r["source"], r["source_rank"], r["domain"], r["en"]) for r in scan.collect()}
    assert got == {("n3" if str(i).startswith("3") else f"n{i}", 3 if str(i).startswith("3") else i, "d1" if str(i).startswith("3") else f"d{i % 2}", f"text of source {i}") for i in range(100)}
    with pytest.raises(FileNotFoundError, match="gone"):
        bitext.scan_manifest_sources(spark, spark.createDataFrame([(0, "gone", f"{tmp_path}/none", "d")], manifest.schema))


def test_missing_sources_and_branch(spark, tmp_path):
    manifest = write_manifest(spark, tmp_path)
    listing = files.list_files(spark, str(tmp_path))
    complete = files.manifest_missing(manifest, listing)
    assert files.source_branch(complete).first().asDict() == {"missing_sources": 0, "branch": "skip_download"}
    partial = files.manifest_missing(manifest, listing.where(~F.col("path").endswith("law.jsonl")))
    assert [r["name"] for r in partial.collect()] == ["law"]
    assert files.source_branch(partial).first()["branch"] == "download"


def test_checksums_are_those_of_the_bytes(spark, tmp_path):
    """Whatever the bytes: no line end, bytes that are no text, zero bytes in front. Empty files are not listed."""
    contents = [b"", b"\n", b"x", b"x\n", b"\n\nx\r\n\r", bytes(range(256)) * 40, b"\0x", b"\0\0x", "caf\u00e9 \U0001F600".encode() * 999, b"a" * 100_000]
    for i, content in enumerate(contents):
        (tmp_path / f"f{i}.bin").write_bytes(content)
    got = {r["path"].rsplit("/", 1)[-1]: r for r in files.file_checksums(spark, str(tmp_path)).collect()}
    assert {k: r["checksum"] for k, r in got.items()} == {f"f{i}.bin": digest.checksum_of(c) for i, c in enumerate(contents) if c}
    assert len({r["checksum"] for r in got.values()}) == len(contents) - 1
    manifest = files.source_manifest(spark, [("all", str(tmp_path), "x"), ("one", f"{tmp_path}/f3.bin", "x")]).orderBy("rank").collect()
    assert manifest[0]["checksum"] == digest.checksum_of(b"".join(c for i, c in enumerate(contents) if i != 3))
    assert manifest[1]["checksum"] == digest.checksum_of(contents[3])


def test_the_cut_into_files_has_no_part(spark, tmp_path):
    lines = [f"line {i}" for i in range(3000)]
    for parts in (1, 7):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).orderBy(F.lit(1)).write.text(f"{tmp_path}/{parts}")
        spark.range(3000, numPartitions=parts).selectExpr("concat('line ', id) value").write.mode("overwrite").text(f"{tmp_path}/{parts}")
    one, seven = (files.source_manifest(spark, [("s", f"{tmp_path}/{p}", "x")]).first()["checksum"] for p in (1, 7))
    assert one == seven == digest.checksum_of(("\n".join(lines) + "\n").encode())


def test_large_files_keep_order_and_line_ends(spark, tmp_path):
    """Every edit changes the checksum, also of the manifest and the snapshot; how files are cut into blocks does not."""
    lines = [f"line {i % 700} \u00e9" for i in range(5000)]
    swapped = [lines[1], lines[0], *lines[2:]]
    variants = {
        "plain": "\n".join(lines) + "\n",
        "swapped": "\n".join(swapped) + "\n",
        "rotated": "\n".join(lines[2500:] + lines[:2500]) + "\n",
        "crlf": "\r\n".join(lines) + "\r\n",
        "one_return": "\n".join(lines).replace("0 \u00e9\n", "0 \u00e9\r", 1) + "\n",
        "no_end": "\n".join(lines),
        "blank_end": "\n".join(lines) + "\n\n",
    }
    path = tmp_path / "d" / "a.txt"
    path.parent.mkdir()

    def checksums():
        listing = files.file_checksums(spark, str(path.parent))
        manifest = files.source_manifest(spark, [("a", str(path.parent), "x")])
        return listing.first()["checksum"], files.snapshot_manifest(listing).first()["hash"], manifest.first()["checksum"]

    found = {}
    for name, text in variants.items():
        path.write_bytes(text.encode())
        found[name] = checksums()
    assert [len(set(x)) for x in zip(*found.values(), strict=True)] == [len(variants)] * 3
    path.write_bytes(variants["plain"].encode())
    before = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for size in (3000, 20_000):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 100)
        assert checksums() == found["plain"]
    for c, v in before.items():
        spark.conf.set(c, v)


def test_snapshot_and_status(spark, tmp_path):
    for name, text in (("d/a", "1"), ("d/b", "2"), ("e/c", "3")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    before = settle(files.file_checksums(spark, str(tmp_path)), "before")
    manifest = {r["directory"].rsplit("/", 1)[-1]: r for r in files.snapshot_manifest(before).collect()}
    assert (manifest["d"]["nfiles"], manifest["d"]["size"], manifest["e"]["nfiles"]) == (2, 2, 1)
    assert files.snapshot_status(before, before).count() == 0
    (tmp_path / "d/b").write_text("5")
    (tmp_path / "e/f").write_text("6")
    after = files.file_checksums(spark, str(tmp_path)).where(~F.col("path").endswith("/a"))
    got = {r["path"].rsplit("/", 1)[-1]: r["status"] for r in files.snapshot_status(before, after).collect()}
    assert got == {"a": "removed", "b": "modified", "f": "added"}


def test_fingerprint_ignores_row_order(spark, records):
    df = records([{"input": f"text {i}"} for i in range(50)]).select("input", "output")
    one = files.table_fingerprint(df).first()["fingerprint"]
    assert files.table_fingerprint(df.repartition(5).orderBy(F.desc("input"))).first()["fingerprint"] == one
    assert files.table_fingerprint(df.union(df.limit(1))).first()["fingerprint"] != one
    assert files.table_fingerprint(df.union(df.limit(1)).union(df.limit(1))).first()["fingerprint"] != one


@pytest.mark.parametrize(
    "uri, bucket, prefix", [("gs://b/a/b", "b", "a/b"), ("s3a://b", "b", ""), ("gs://b/", "b", ""), ("plain/path", "", "")]
)
def test_uri_split(column, uri, bucket, prefix):
    first, second = bitext.uri_split(F.col("x"))
    assert column(F.array(first, second), [uri]) == [[bucket, prefix]]


def test_log_append_does_not_raise(spark, tmp_path):
    (tmp_path / "file").write_text("x")
    assert writers.append_log(spark.range(2), f"{tmp_path}/log") and writers.append_log(spark.range(1), f"{tmp_path}/log")
    assert spark.read.parquet(f"{tmp_path}/log").count() == 3
    assert not writers.append_log(spark.range(1), f"{tmp_path}/file/log")


def test_lines_are_parsed_once(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"translation": {"en": "a", "es": "b"}}\n')
    plan = bitext.scan_bitext(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parse_json") + plan.lower().count("parsejson") == 1


def test_nested_folders_and_a_closing_slash_are_present(spark, tmp_path):
    (tmp_path / "s/deep").mkdir(parents=True)
    (tmp_path / "s/deep/a.txt").write_text("x")
    manifest = spark.createDataFrame([("s", f"{tmp_path}/s/"), ("t", f"{tmp_path}/t")], "name string, path string")
    listing = files.list_present(spark, [f"{tmp_path}/s/", f"{tmp_path}/t"])
    assert [r["name"] for r in files.manifest_missing(manifest, listing).collect()] == ["t"]


def test_publish_plan_counts_what_is_there(spark, records, tmp_path):
    splits = records([{}] * 3).withColumn("split", F.element_at(F.array(*map(F.lit, ("train", "val", "test"))), F.col("row_no").cast("int") + 1))
    writers.sink_splits(splits, f"{tmp_path}/splits")
    slices = records([{}] * 2).withColumn("slice", F.when(F.col("row_no") == 0, "medical").otherwise("legal"))
    writers.sink_slices(slices, f"{tmp_path}/slices")
    for name in writers.APPROVED_REPORTS[:3]:
        writers.sink_report(spark.range(1), f"{tmp_path}/reports/{name}")
    plan = writers.publish_plan(spark, f"file://{tmp_path}", "v9").collect()
    assert plan == writers.publish_plan(spark, f"{tmp_path}/", "v9").collect()
    assert len(plan) == 9 and sum(r["found"] for r in plan) == 8
    missing = next(r for r in plan if not r["found"])
    assert (missing["target"], missing["size_mb"]) == ("version=v9/reports/dataset_approval", 0.0)


def lines_below(spark, path, texts):
    for name, lines in texts.items():
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(2).write.mode("overwrite").text(f"{path}/splits/split={name}")


def test_a_failed_publication_leaves_the_one_before(spark, tmp_path, monkeypatch):
    base, target = f"{tmp_path}/out", f"{tmp_path}/pub"
    texts = {"train": ["a", "b", "b"], "val": ["c"], "test": ["d", "e"]}
    lines_below(spark, base, texts)
    assert writers.published(spark, target, "v1") is None
    plan = lambda: writers.publish_plan(spark, base, "v1")
    first = writers.publish(spark, plan(), base, target, "v1")
    assert first.number == 1 and writers.published(spark, target, "v1", check=True) == first
    assert {tuple(r) for r in writers.version_status(spark, target, "v1").collect()} == {(f"splits/split={n}", "added") for n in texts}
    # A dataset is lost while it is copied: some of the others are there already.
    lines_below(spark, base, {"train": ["new"]})
    broken = plan().withColumn("found", F.lit(True))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        writers.publish(spark, broken, base, target, "v1")
    assert writers.published(spark, target, "v1", check=True) == first
    # A copy that lacks a line is found out before it is committed.
    honest = writers.dataset_fingerprints
    monkeypatch.setattr(writers, "dataset_fingerprints", lambda s, root: honest(s, root) if root == base else honest(s, root).withColumn("rows", F.col("rows") - 1))
    with pytest.raises(ValueError, match="copies of splits/split=test"):
        writers.publish(spark, plan(), base, target, "v1")
    monkeypatch.undo()
    assert writers.published(spark, target, "v1", check=True) == first and bitext.read_lines(spark, f"{first.path}/splits/split=train").count() == 3
    second = writers.publish(spark, plan(), base, target, "v1")
    assert second.number == 2 and second.path != first.path and writers.published(spark, target, "v1") == second
    assert {tuple(r) for r in writers.version_status(spark, target, "v1").collect()} == {("splits/split=train", "modified")}
    # Lines dealt to other files in another order are the same publication.
    lines_below(spark, base, {"train": ["new"], "test": ["e", "d"]})
    assert writers.publish(spark, plan(), base, target, "v1").snapshot == second.snapshot
    assert writers.version_status(spark, target, "v1").count() == 0
    # A published file that changed is told.
    next((tmp_path / "pub/version=v1").glob("build=*/splits/split=val/part-*")).write_text("x\n")
    spark.createDataFrame([(9, second.path.split("=")[-1], second.snapshot)], "number bigint, build string, snapshot string").write.mode("append").json(f"{target}/version=v1/_commits")
    assert writers.published(spark, target, "v1").number == 9


def test_payload_needs_an_approval(spark):
    schema = "approved boolean, version string, train_records bigint"
    row = writers.handoff_payload(spark.createDataFrame([(True, "v7", 15000)], schema), "s3a://b/data").first()
    assert row["train"] == "s3a://b/data/version=v7/splits/split=train"
    assert (row["dataset_version"], row["train_records"]) == ("v7", 15000)
    assert writers.handoff_payload(spark.createDataFrame([(False, "v7", 1)], schema), "x").count() == 0


def test_whole_run(spark, tmp_path):
    write_manifest(spark, tmp_path)
    rules = Rules(min_train_records=1000)
    payload = run_corpus(spark, f"{tmp_path}/manifest", f"{tmp_path}/out", f"{tmp_path}/pub", rules).first()
    assert payload["train_records"] == 1120
    published = bitext.scan_records(spark, payload["train"])
    assert published.count() == 1120 and published.where("domain = 'medical'").count() == 640
    names = {p.name for p in (tmp_path / "out/reports").iterdir()}
    assert names >= {"schema", "tfdv_stats_summary", "anomalies", "bias_report", "dataset_approval", "trigger_payload", "snapshot"}
    assert names >= {"snapshot_status"}
    version = writers.published(spark, f"{tmp_path}/pub", "v2_approved", check=True)
    assert payload["train"] == f"{version.path}/splits/split=train"
    approval = json.loads(spark.read.text(f"{version.path}/reports/dataset_approval", wholetext=True).first()[0])
    assert approval["approved"] is True and approval["test_records"] == 140
    with pytest.raises(DatasetRejected, match="Train set too small"):
        run_corpus(spark, f"{tmp_path}/manifest", f"{tmp_path}/out2", f"{tmp_path}/pub2", Rules())
    (tmp_path / "law.jsonl").rename(tmp_path / "gone.jsonl")
    with pytest.raises(DatasetRejected, match="Missing sources.*law"):
        run_corpus(spark, f"{tmp_path}/manifest", f"{tmp_path}/out3", f"{tmp_path}/pub3", rules)
    asked = []
    bring = lambda names: (asked.extend(names), (tmp_path / "gone.jsonl").rename(tmp_path / "law.jsonl"))
    again = run_corpus(spark, f"{tmp_path}/manifest", f"{tmp_path}/out4", f"{tmp_path}/pub4", rules, fetch=bring).first()
    assert len(asked) == 1 and again["train_records"] == 1120
    # The order key is the same for another folder and other blocks.
    keys = {r["shuffle_key"] for r in spark.read.parquet(f"{tmp_path}/out/stage/splits").collect()}
    assert keys == {r["shuffle_key"] for r in spark.read.parquet(f"{tmp_path}/out4/stage/splits").collect()}
