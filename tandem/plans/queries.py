"""The registered queries: one per operator, each with the SQL it is compared to where SQL can say it.

Doubles are rounded to 6 digits, which hides the order of summation.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.functions import records as rec
from tandem.functions import text as txt
from tandem.operators import bleu, evaluate, monitor, pairs, profile, quality, sampling, sessions, slices, split, translate
from tandem.plans import fixtures as fx
from tandem.plans.oracle import bleu_sql, checksum_sql, fingerprint_sql, over_all_records, sql
from tandem.settings import GAP_RULES, RECORD_FIELDS, SLICES, STAT_METRICS, Rules
from tandem.sinks import writers
from tandem.sources import bitext, files
from tandem.streaming import jobs
from tandem.workspace import fresh_path, settle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(function):
        QUERIES[name] = function
        if oracle is not None:
            ORACLE[name] = oracle
        return function

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles at 6 digits, whole numbers as long, timestamps without zone: as the SQL side gives them."""

    def plain(field):
        kind = field.dataType.typeName()
        if kind == "double":
            return F.round(F.col(field.name), digits).alias(field.name)
        if kind in ("integer", "short", "decimal"):
            return F.col(field.name).cast("bigint").alias(field.name)
        if kind == "timestamp":
            return F.col(field.name).cast("timestamp_ntz").alias(field.name)
        return F.col(field.name)

    return df.select(*(plain(field) for field in df.schema))


# ---------------------------------------------------------------- sources


@query("scan_bitext", sql("""select "domain", en, es from pairs where en <> '' and es <> ''"""))
def scan_bitext(spark, sf):
    scans = [
        bitext.scan_bitext(spark, path).select(F.lit(domain).alias("domain"), "en", "es")
        for _, path, domain in fx.raw_sources(spark, sf)
    ]
    return pairs.nonempty_pairs(scans[0].unionByName(scans[1]))


@query("scan_records", sql("""select instruction, "input", "output", "domain", direction from records"""))
def scan_records(spark, sf):
    path = fresh_path(spark, "records")
    writers.sink_records(fx.records(spark, sf), path)
    return bitext.scan_records(spark, path)


def _manifest(spark, sf):
    manifest = files.source_manifest(spark, fx.raw_sources(spark, sf))
    path = fresh_path(spark, "manifest")
    files.manifest_json(manifest).coalesce(1).write.text(path)
    return bitext.read_manifest(spark, path)


@query(
    "scan_manifest_sources",
    sql("""select "domain" || '_pairs' source, cast(source_rank as bigint) source_rank, "domain", en, es
           from pairs where en <> '' and es <> ''"""),
)
def scan_manifest_sources(spark, sf):
    scan = bitext.scan_manifest_sources(spark, _manifest(spark, sf))
    return rounded(pairs.nonempty_pairs(scan).select("source", "source_rank", "domain", "en", "es"))


_BAD = ", ".join("'" + line + "'" for line in fx.BAD_LINES)
_RAW_LINES = f"""select "domain" as key, string_agg(v || chr(10), '' order by doc_id, pair_no, "at") "text" from (
    select "domain", doc_id, pair_no, 0 "at", cast(to_json({{'translation': {{'en': en, 'es': es}}}}) as varchar) v from pairs
    union all select "domain", doc_id, pair_no, unnest(range(1, {len(fx.BAD_LINES) + 1})), unnest([{_BAD}]) from pairs where pair_no = 0
  ) group by 1"""


@query(
    "source_manifest",
    sql(f"""select case when key = 'medical' then 0 else 1 end "rank", key || '_pairs' as name, key as "domain", checksum
            from {checksum_sql(_RAW_LINES)}"""),
)
def source_manifest(spark, sf):
    manifest = files.source_manifest(spark, fx.raw_sources(spark, sf, ordered=True))
    return rounded(manifest.select("rank", "name", "domain", "checksum"))


def _partial_sources(spark, sf):
    """Manifest of all document sources, of which only the first ten are on storage."""
    base = fresh_path(spark, "sources")
    documents = fx.table(spark, sf, "documents").select("source", "text")
    number = F.substring("source", 4, 10).cast("int")
    documents.where(number < 10).select(
        "source", F.to_json(F.struct("text")).alias("value")
    ).write.partitionBy("source").text(base)
    manifest = documents.select("source").distinct().select(
        F.col("source").alias("name"), F.concat(F.lit(f"{base}/source="), "source").alias("path")
    )
    return files.manifest_missing(manifest, files.list_files(spark, base))


@query(
    "manifest_missing",
    """select distinct source as name from documents where cast(substr(source, 4) as int) >= 10""",
)
def manifest_missing(spark, sf):
    return _partial_sources(spark, sf).select("name")


@query(
    "source_branch",
    """select count(distinct source) missing_sources, case when count(*) = 0 then 'skip_download' else 'download' end branch
       from documents where cast(substr(source, 4) as int) >= 10""",
)
def source_branch(spark, sf):
    return files.source_branch(_partial_sources(spark, sf))


@query(
    "manifest_listing",
    """select source as name, cast(substr(source, 4) as int) < 10 present, count(*) documents from documents group by all""",
)
def manifest_listing(spark, sf):
    missing = _partial_sources(spark, sf).select("name", F.lit(False).alias("present"))
    counts = fx.table(spark, sf, "documents").groupBy(F.col("source").alias("name")).agg(
        F.count("*").alias("documents")
    )
    return counts.join(missing, "name", "left").select(
        "name", F.coalesce("present", F.lit(True)).alias("present"), "documents"
    )


@query(
    "head_sample",
    sql("select doc_id, pair_no, direction from records order by content_key, row_key limit 500"),
)
def head_sample(spark, sf):
    keyed = split.with_shuffle_key(fx.records(spark, sf), fx.ROW_ID, 42)
    return sampling.head_sample(keyed, ["shuffle_key"], 500).select("doc_id", "pair_no", "direction")


@query(
    "uri_split",
    r"""select page_id, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/]*)/?(.*)$', 1) bucket,
        regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/]*)/?(.*)$', 2) prefix from pages""",
)
def uri_split(spark, sf):
    bucket, prefix = bitext.uri_split(F.col("url"))
    return fx.table(spark, sf, "pages").select("page_id", bucket.alias("bucket"), prefix.alias("prefix"))


# ---------------------------------------------------------------- sinks


@query("sink_records", sql("""select direction, "domain", count(*) n, cast(sum(length("input")) as bigint) chars
    from records group by all"""))
def sink_records(spark, sf):
    path = fresh_path(spark, "records")
    writers.sink_records(fx.records(spark, sf), path)
    back = bitext.scan_records(spark, path)
    return back.groupBy("direction", "domain").agg(F.count("*").alias("n"), F.sum(F.length("input")).alias("chars"))


@query("sink_splits", sql("""select split, instruction, "input", "output", "domain", direction from splits"""))
def sink_splits(spark, sf):
    path = fresh_path(spark, "splits")
    writers.sink_splits(fx.splits(spark, sf), path)
    return spark.read.schema(f"{bitext.RECORD_SCHEMA}, split string").json(path)


@query(
    "sink_slices",
    sql("""select slice, instruction, "input", "output", "domain", direction from sliced where slice <> 'overall'"""),
)
def sink_slices(spark, sf):
    path = fresh_path(spark, "slices")
    writers.sink_slices(slices.assign_slices(fx.test_split(spark, sf)), path)
    return spark.read.schema(f"{bitext.RECORD_SCHEMA}, slice string").json(path)


@query(
    "sink_report",
    sql("""select count(*) total_records, round_even(avg(n_in), 2) input_len_mean, max(n_in) input_len_max,
        count(*) filter ("domain" = 'medical') medical from splits where split = 'train'"""),
)
def sink_report(spark, sf):
    path = fresh_path(spark, "report")
    writers.sink_report(profile.profile_report(fx.split_of(spark, sf, "train")), path)
    schema = "total_records bigint, input_len_mean double, input_len_max bigint, domain_distribution map<string, bigint>"
    document = spark.read.text(path, wholetext=True).select(F.from_json("value", schema).alias("r"))
    return document.select(
        "r.total_records", "r.input_len_mean", "r.input_len_max", F.col("r.domain_distribution")["medical"].alias("medical")
    )


@query(
    "publish_plan",
    sql("""select * from (
        select distinct 'split' kind, 'splits/split=' || split dataset, 'version=v2_approved/splits/split=' || split target,
          true found from splits
        union all select distinct 'slice', 'slices/slice=' || slice, 'version=v2_approved/slices/slice=' || slice, true
          from sliced where slice <> 'overall'
        union all select 'report', 'reports/' || r, 'version=v2_approved/reports/' || r, r = 'schema'
          from (select unnest(['schema', 'tfdv_stats_summary', 'anomalies', 'dataset_approval']) r))"""),
)
def publish_plan(spark, sf):
    base = fresh_path(spark, "publish")
    parts = settle(fx.splits(spark, sf), "splits")
    writers.sink_splits(parts, f"{base}/splits")
    writers.sink_slices(slices.assign_slices(parts.where("split = 'test'")), f"{base}/slices")
    schema = profile.schema_report(profile.profile_report(parts.where("split = 'train'")))
    writers.sink_report(schema, f"{base}/reports/schema")
    return writers.publish_plan(spark, base, Rules().version).select("kind", "dataset", "target", "found")


_PUBLISHED = """with d as (select case when cast(substr(source, 4) as int) < 15 then 'train' when cast(substr(source, 4) as int) < 17 then 'val' else 'test' end split,
    lang from documents)
select 'splits/split=' || split dataset, count(*) filter (split <> 'val' or lang <> 'fr') "rows",
    case when split = 'val' and count(*) filter (lang = 'fr') > 0 then 'modified' else 'same' end status from d group by split"""


@query("publish", _PUBLISHED)
def publish(spark, sf):
    """Two publications of the documents as splits; the second lacks some rows of one. The last one, checked, and what changed."""
    target, number = fresh_path(spark, "target"), F.substring("source", 4, 10).cast("int")
    split_name = F.when(number < 15, "train").when(number < 17, "val").otherwise("test")
    documents = fx.table(spark, sf, "documents").select(split_name.alias("split"), "lang", F.to_json(F.struct("doc_id", "text")).alias("value"))
    for rows in (documents, documents.where("split <> 'val' or lang <> 'fr'")):
        base = fresh_path(spark, "base")
        rows.select("split", "value").write.partitionBy("split").text(f"{base}/splits")
        writers.publish(spark, writers.publish_plan(spark, base, "v1"), base, target, "v1")
    last = writers.published(spark, target, "v1", check=True)
    status = writers.version_status(spark, target, "v1").withColumnRenamed("path", "dataset")
    found = writers.dataset_fingerprints(spark, last.path).join(status, "dataset", "left")
    return found.select("dataset", "rows", F.coalesce("status", F.lit("same")).alias("status"))


@query(
    "handoff_payload",
    sql("""select 'published/version=v2_approved/splits/split=train' train, 'published/version=v2_approved/splits/split=val' val,
        'published/version=v2_approved/reports/schema' "schema", 'v2_approved' dataset_version, count(*) train_records
        from splits where split = 'train'"""),
)
def handoff_payload(spark, sf):
    approval = quality.approval_report(fx.splits(spark, sf), Rules(min_train_records=100))
    return writers.handoff_payload(approval, "published")


_LOG_SQL = """
with log as (select ts as "timestamp", event_id, user_id, case when user_id % 2 = 0 then 'en_to_es' else 'es_to_en' end direction,
    case when event_type in ('error', 'signup') then 'legal' else 'medical' end "domain", round_even("value", 2) latency_ms,
    user_id % 40 + 1 input_len, event_id % 40 + 1 output_len from events)
"""


@query("append_inference_log", _LOG_SQL + "select * from log")
def append_inference_log(spark, sf):
    path = fresh_path(spark, "log")
    log = fx.request_log(spark, sf)
    for parity in (0, 1):
        writers.append_log(log.where(F.col("event_id") % 2 == parity), path)
    return rounded(spark.read.parquet(path))


# ---------------------------------------------------------------- snapshots


_SOURCE_TEXT = """select source as key, string_agg(coalesce("text", '') || chr(10), '' order by doc_id) "text" from documents group by source"""


@query(
    "snapshot_manifest",
    f"""select 'source=' || key as directory, checksum as hash, strlen("text")::bigint as size
        from {checksum_sql(_SOURCE_TEXT)} join ({_SOURCE_TEXT}) using (key)""",
)
def snapshot_manifest(spark, sf):
    base = fx.source_files(fx.table(spark, sf, "documents"))
    listing = files.relative_to(files.file_checksums(spark, base), base)
    return files.snapshot_manifest(listing).select("directory", "hash", "size")


@query(
    "snapshot_status",
    """with s as (select source, cast(substr(source, 4) as int) n, bool_or(lang = 'fr') fr, bool_and(lang = 'fr') only_fr
        from documents group by source)
    select source "path", case when n >= 15 and not only_fr then 'added' when n < 5 or only_fr then 'removed'
        else 'modified' end status from s
    where (n >= 15 and not only_fr) or n < 5 or (n between 5 and 14 and fr)""",
)
def snapshot_status(spark, sf):
    """Two versions of the documents, written to two folders and compared source by source."""
    documents = fx.table(spark, sf, "documents").withColumn("n", F.substring("source", 4, 10).cast("int"))

    def listing(rows):
        base = fx.source_files(rows)
        snapshot = files.snapshot_manifest(files.relative_to(files.file_checksums(spark, base), base))
        return snapshot.select(F.regexp_replace("directory", "^source=", "").alias("path"), F.col("hash").alias("checksum"))

    return files.snapshot_status(listing(documents.where("n < 15")), listing(documents.where("n >= 5 and lang <> 'fr'")))


_FINGERPRINT = "doc_id pair_no domain direction instruction input output"


@query("table_fingerprint", sql(fingerprint_sql(_FINGERPRINT, "select * from records")))
def table_fingerprint(spark, sf):
    return files.table_fingerprint(fx.records(spark, sf).select(*_FINGERPRINT.split())).select("rows", "fingerprint")


# ---------------------------------------------------------------- scalar functions


@query(
    "repair_text",
    r"""select page_id, replace(replace(replace(replace(regexp_replace(html, '<[^>]*>', ' ', 'g'),
        '&copy;', chr(169)), '&middot;', chr(183)), '&quot;', '"'), '&amp;', '&') "text" from pages""",
)
def repair_text(spark, sf):
    bare = F.regexp_replace("html", "<[^>]*>", " ")
    return fx.table(spark, sf, "pages").select("page_id", txt.repair_text(bare).alias("text"))


# Letters that the documents hold, as damage leaves them and as they are.
_BROKEN = ("áéíóúñüäöçàèêß", "Ã¡ Ã© Ã\u00ad Ã³ Ãº Ã± Ã¼ Ã¤ Ã¶ Ã§ Ã\u00a0 Ã¨ Ãª ÃŸ".split(" "))


@query("repair_damage", r"""select doc_id, regexp_replace("text", '\r\n?', chr(10), 'g') "text" from documents""")
def repair_damage(spark, sf):
    """Every document damaged in one of four ways, by turns, and repaired: half of the letters with accents broken, letters
    apart from their marks, ligatures and wide digits, line ends and control codes."""
    text, odd = F.col("text"), lambda i: i % 2 == 0
    broken = text
    for i, (letter, shown) in enumerate(zip(*_BROKEN, strict=True)):
        broken = F.replace(broken, F.lit(letter), F.lit(shown)) if odd(i) else broken
    apart = text
    for letter in _BROKEN[0]:
        apart = F.replace(apart, F.lit(letter), F.lit(unicodedata.normalize("NFD", letter)))
    shaped = F.translate(F.replace(text, F.lit("fi"), F.lit("\uFB01")), "0123456789", "０１２３４５６７８９")
    ends = F.concat(F.lit("\x07"), F.replace(text, F.lit("\n"), F.lit("\r\n")), F.lit("\x1b[0m\u2060".replace("\u2060", "\uFEFF")))
    way = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    ways = F.when(way == 0, broken).when(way == 1, apart).when(way == 2, shaped).when(way == 3, ends)
    # The generator keeps the optimizer from copying the damage into each use of the text: it is done once.
    damaged = fx.table(spark, sf, "documents").select("doc_id", F.explode(F.array(ways)).alias("text"))
    return damaged.select("doc_id", txt.repair_text(F.col("text")).alias("text"))


@query("clean_text", r"""select doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) "text" from documents""")
def clean_text(spark, sf):
    return fx.table(spark, sf, "documents").select("doc_id", txt.clean_text(F.col("text")).alias("text"))


@query("token_count", r"""select doc_id, len(regexp_extract_all(text, '\S+')) n_tokens from documents""")
def token_count(spark, sf):
    documents = fx.table(spark, sf, "documents")
    return rounded(documents.select("doc_id", txt.token_count(F.col("text")).alias("n_tokens")))


@query(
    "length_ratio",
    sql(r"""select doc_id, pair_no, round(len(regexp_extract_all(en, '\S+'))
        / greatest(len(regexp_extract_all(es, '\S+')), 1), 6) ratio from pairs"""),
)
def length_ratio(spark, sf):
    counted = pairs.with_pair_lengths(fx.pairs(spark, sf))
    return rounded(counted.select("doc_id", "pair_no", txt.length_ratio(F.col("n_en"), F.col("n_es")).alias("ratio")))


@query(
    "to_instruction",
    sql("""select 'Translate the following ' || "domain" || ' sentence from ' || case when lang = 'es'
        then 'Spanish to English.' else 'English to Spanish.' end instruction,
        case when lang = 'es' then es else en end "input", case when lang = 'es' then en else es end "output", "domain",
        case when lang = 'es' then 'es_to_en' else 'en_to_es' end direction from pairs"""),
)
def to_instruction(spark, sf):
    direction = F.when(F.col("lang") == "es", "es_to_en").otherwise("en_to_es")
    record = rec.to_instruction(F.col("en"), F.col("es"), F.col("domain"), direction)
    return fx.pairs(spark, sf).select(record.alias("r")).select("r.*")


@query(
    "render_prompt",
    sql("""select doc_id, pair_no, direction, '### Instruction:' || chr(10) || instruction || chr(10) || chr(10) || '### Input:'
        || chr(10) || "input" || chr(10) || chr(10) || '### Response:' || chr(10) || "output" "text" from records"""),
)
def render_prompt(spark, sf):
    text = rec.render_prompt(F.col("instruction"), F.col("input"), F.col("output"))
    return fx.records(spark, sf).select(*fx.ROW_ID, text.alias("text"))


@query(
    "length_bucket",
    sql("""select bucket, case when n_in <= 10 then 'short' when n_in > 25 then 'long' else 'medium' end length_group,
        count(*) n from d group by all"""),
)
def length_bucket(spark, sf):
    group = txt.length_bucket(F.col("n_in"), Rules().sensitivity_bounds, ("short", "medium", "long"))
    return fx.records(spark, sf).groupBy("bucket", group.alias("length_group")).agg(F.count("*").alias("n"))


@query("pair_key", sql("select doc_id, pair_no, md5(en || es) key_md5 from pairs"))
def pair_key(spark, sf):
    key = rec.pair_key(F.col("en"), F.col("es"))
    return fx.pairs(spark, sf).select("doc_id", "pair_no", F.md5(key).alias("key_md5"))


@query(
    "default_fields",
    sql("""select doc_id, pair_no, coalesce("input", '') "input", coalesce("output", '') "output",
        coalesce(nullif("domain", 'finance'), 'unknown') "domain", direction from dirty"""),
)
def default_fields(spark, sf):
    blank = fx.dirty_records(spark, sf).withColumn("domain", F.nullif(F.col("domain"), F.lit("finance")))
    return blank.withColumns(rec.default_fields()).select("doc_id", "pair_no", "input", "output", "domain", "direction")


_OVERLAP = r"""len(list_intersect(list_distinct(regexp_extract_all(lower("input"), '\S+')),
    list_distinct(regexp_extract_all(lower("output"), '\S+'))))"""
_WORD_SET = r"""len(list_distinct(regexp_extract_all(lower("input"), '\S+')))"""


@query("word_overlap", sql(f"select doc_id, pair_no, direction, round({_OVERLAP} / greatest({_WORD_SET}, 1), 6) overlap from records"))
def word_overlap(spark, sf):
    overlap = txt.word_overlap(F.col("input"), F.col("output"))
    return rounded(fx.records(spark, sf).select(*fx.ROW_ID, overlap.alias("overlap")))


@query(
    "word_set_ops",
    sql(f"""select "domain", direction, cast(sum({_WORD_SET}) as bigint) set_words, cast(sum({_OVERLAP}) as bigint) shared_words
        from records group by all"""),
)
def word_set_ops(spark, sf):
    own = txt.word_set(F.col("input"))
    shared = F.array_intersect(own, txt.word_set(F.col("output")))
    return (
        fx.records(spark, sf)
        .groupBy("domain", "direction")
        .agg(F.sum(F.size(own)).alias("set_words"), F.sum(F.size(shared)).alias("shared_words"))
    )


_SOURCE_SQL = """
with s as (select source, avg(n_chars) mean from documents group by source),
o as (select avg(n_chars) mean from documents),
dev as (select source, s.mean, round_even((s.mean - o.mean) / o.mean, 3) deviation,
    round_even(abs(s.mean - o.mean) / greatest(o.mean, 1.0), 3) abs_deviation from s, o)
"""


def _source_lengths(spark, sf):
    documents = fx.table(spark, sf, "documents")
    overall = documents.agg(F.avg("n_chars").alias("overall"))
    return documents.groupBy("source").agg(F.avg("n_chars").alias("mean")).join(F.broadcast(overall))


@query("rel_deviation", _SOURCE_SQL + "select source, deviation from dev")
def rel_deviation(spark, sf):
    return rounded(
        _source_lengths(spark, sf).select("source", rec.rel_deviation(F.col("mean"), F.col("overall")).alias("deviation"))
    )


@query("abs_len_deviation", _SOURCE_SQL + "select source, abs_deviation from dev")
def abs_len_deviation(spark, sf):
    deviation = rec.abs_len_deviation(F.col("mean"), F.col("overall"))
    return rounded(_source_lengths(spark, sf).select("source", deviation.alias("abs_deviation")))


@query(
    "over_under",
    _SOURCE_SQL + """select source, case when deviation > 0 then 'OVER' else 'UNDER' end side,
        case when abs(deviation) > 0.05 then 'BIASED (' || case when deviation > 0 then 'OVER' else 'UNDER' end || ' by '
        || printf('%.1f', abs(deviation) * 100) || '%)' else 'OK' end status from dev""",
)
def over_under(spark, sf):
    deviation = rec.rel_deviation(F.col("mean"), F.col("overall"))
    return _source_lengths(spark, sf).select(
        "source", rec.over_under(deviation).alias("side"), rec.bias_status(deviation, 0.05).alias("status")
    )


_MESSAGES = ", ".join(
    f"case when {name} > 0 then '{label}: ' || {name} || ' records' end" for name, label in rec.ANOMALY_MESSAGES
)
_COUNTS = ", ".join(f"count(*) filter ({name}) {name}" for name in quality.ANOMALIES)


@query(
    "messages",
    sql(f"""select source, concat_ws('; ', {_MESSAGES}) messages from
        (select source, {_COUNTS} from flagged group by source)"""),
)
def messages(spark, sf):
    flags = quality.anomaly_flags(fx.dirty_records(spark, sf))
    counts = flags.groupBy("source").agg(*(F.count_if(name).alias(name) for name in quality.ANOMALIES))
    return counts.select("source", F.array_join(rec.anomaly_messages(), "; ").alias("messages"))


@query(
    "tokenize_13a",
    over_all_records(bleu_sql("""select doc_id, pair_no, direction, array_to_string(toks, ' ') tokens from bleu_in
        where slice = 'overall' and side = 'h'""", "slice = 'overall'")),
)
def tokenize_13a(spark, sf):
    tokens = F.array_join(txt.tokenize_13a(F.col("output")), " ")
    return fx.records(spark, sf).select(*fx.ROW_ID, tokens.alias("tokens"))


@query("latency_ms", """select event_id, round_even(round("value" * 1000) / 1000.0, 2) latency_ms from events""")
def latency_ms(spark, sf):
    start = F.col("ts").cast("timestamp")
    end = F.timestamp_micros(F.unix_micros(start) + F.round(F.col("value") * 1000).cast("bigint"))
    return rounded(fx.table(spark, sf, "events").select("event_id", rec.latency_ms(start, end).alias("latency_ms")))


@query(
    "direction_from_langs",
    """select case when lang = 'es' then 'es_to_en' else 'en_to_es' end direction,
        case when lang = 'es' then 'es-ES' else 'en-US' end locale, lang, count(*) n from documents group by all""",
)
def direction_from_langs(spark, sf):
    source = F.when(F.col("lang") == "es", "spanish").when(F.col("lang") == "en", "english").otherwise(F.col("lang"))
    target = F.when(F.col("lang") == "es", "english").otherwise("spanish")
    keys = (rec.direction_from_langs(source, target).alias("direction"), rec.locale_of(source).alias("locale"), "lang")
    return fx.table(spark, sf, "documents").groupBy(*keys).agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- filters


@query("nonempty_pairs", sql("select doc_id, pair_no from m"))
def nonempty_pairs(spark, sf):
    return pairs.nonempty_pairs(fx.pairs(spark, sf)).select("doc_id", "pair_no")


@query(
    "valid_pairs",
    sql("""select doc_id, pair_no, ne n_en, ns n_es from m
        where ne between 3 and 200 and ns between 3 and 200 and ne/greatest(ns,1) between 0.4 and 2.5"""),
)
def valid_pairs(spark, sf):
    return rounded(pairs.valid_pairs(fx.pairs(spark, sf)).select("doc_id", "pair_no", "n_en", "n_es"))


@query(
    "reject_reasons",
    sql(r"""select source, case when en = '' or es = '' then 'empty_side' when ne < 3 then 'en_too_short'
        when ne > 200 then 'en_too_long' when ns < 3 then 'es_too_short' when ns > 200 then 'es_too_long'
        when not ne/greatest(ns,1) between 0.4 and 2.5 then 'length_ratio' else 'valid' end reason, count(*) n
        from (select *, len(regexp_extract_all(en,'\S+')) ne, len(regexp_extract_all(es,'\S+')) ns from pairs)
        group by all"""),
)
def reject_reasons(spark, sf):
    return pairs.reject_reasons(fx.pairs(spark, sf)).groupBy("source", "reason").agg(F.count("*").alias("n"))


@query(
    "final_transcripts",
    r"""select conv_id "session", turn, regexp_replace(text, '^\s+|\s+$', '', 'g') "text" from conversations
        where role <> 'system' and regexp_replace(text, '^\s+|\s+$', '', 'g') <> ''""",
)
def final_transcripts(spark, sf):
    return sessions.final_transcripts(fx.transcripts(spark, sf)).select("session", "turn", "text")


@query(
    "membership",
    sql("""select doc_id, pair_no from dirty where "domain" in ('medical', 'legal') and direction in ('en_to_es', 'es_to_en')"""),
)
def membership(spark, sf):
    return quality.membership(fx.dirty_records(spark, sf)).select("doc_id", "pair_no")


# ---------------------------------------------------------------- fan-out


@query("bidirectional", sql("""select doc_id, pair_no, direction, "input", "output", n_in, n_out, bucket from d"""))
def bidirectional(spark, sf):
    records = pairs.bidirectional(fx.kept(spark, sf))
    return rounded(records.select(*fx.ROW_ID, "input", "output", "n_in", "n_out", "bucket"))


@query("assign_slices", sql("select slice, doc_id, pair_no, direction from sliced where slice <> 'overall'"))
def assign_slices(spark, sf):
    return slices.assign_slices(fx.test_split(spark, sf)).select("slice", *fx.ROW_ID)


@query("explode_words", over_all_records(sql("select side, word, count(*) n from word_rows where slice = 'overall' group by all")))
def explode_words(spark, sf):
    return slices.explode_words(fx.records(spark, sf)).groupBy("side", "word").agg(F.count("*").alias("n"))


@query(
    "explode_ngrams",
    over_all_records(bleu_sql("""select n, count(*) ngrams, count(distinct gram) distinct_ngrams
        from bleu_grams where slice = 'overall' and side = 'h' group by n""")),
)
def explode_ngrams(spark, sf):
    counts = bleu.explode_ngrams(fx.records(spark, sf)).groupBy("n", "ngram").count()
    return rounded(counts.groupBy("n").agg(F.sum("count").alias("ngrams"), F.count("*").alias("distinct_ngrams")))


# ---------------------------------------------------------------- dedup and aggregation


@query("dedup_pairs", sql("""select doc_id, pair_no, "domain", en, es from kept"""))
def dedup_pairs(spark, sf):
    return fx.kept(spark, sf).select("doc_id", "pair_no", "domain", "en", "es")


@query("preprocess", sql("""select "domain", direction, count(*) records, cast(sum(n_in) as bigint) n_in, cast(sum(n_out) as bigint) n_out
    from records group by all"""))
def preprocess(spark, sf):
    return (
        fx.records(spark, sf)
        .groupBy("domain", "direction")
        .agg(F.count("*").alias("records"), F.sum("n_in").alias("n_in"), F.sum("n_out").alias("n_out"))
    )


@query(
    "value_distribution",
    sql("""select 'domain' field, "domain" "value", count(*) records from splits where split = 'train' group by all
        union all select 'direction', direction, count(*) from splits where split = 'train' group by all"""),
)
def value_distribution(spark, sf):
    return profile.value_distribution(fx.split_of(spark, sf, "train"))


_LENGTHS = """round(avg(n_in) filter ("input" <> ''), 6) input_len_mean, max(n_in) filter ("input" <> '') input_len_max,
    min(n_in) filter ("input" <> '') input_len_min"""


@query(
    "length_stats",
    sql(rf"""select {_LENGTHS}, round(avg(n_out) filter ("output" <> ''), 6) output_len_mean,
        max(n_out) filter ("output" <> '') output_len_max
        from (select *, len(regexp_extract_all("output",'\S+')) n_out from dirty_n)"""),
)
def length_stats(spark, sf):
    return rounded(profile.length_stats(profile.with_lengths(fx.dirty_records(spark, sf))))


@query(
    "null_counts",
    sql("""select count(*) total_records, count(*) filter (null_inputs) null_input_count,
        count(*) filter (null_outputs) null_output_count from flagged"""),
)
def null_counts(spark, sf):
    return profile.null_counts(fx.dirty_records(spark, sf))


_TRAIN = "from splits where split = 'train'"


@query(
    "profile_report",
    sql(f"""select count(*) total_records, count(*) filter ("domain" = 'medical') medical,
        count(*) filter ("domain" = 'legal') legal, count(*) filter (direction = 'en_to_es') en_to_es,
        count(*) filter (direction = 'es_to_en') es_to_en, round_even(avg(n_in), 2) input_len_mean, max(n_in) input_len_max,
        min(n_in) input_len_min, round_even(avg(n_out), 2) output_len_mean, max(n_out) output_len_max,
        cast(0 as bigint) null_input_count, cast(0 as bigint) null_output_count {_TRAIN}"""),
)
def profile_report(spark, sf):
    report = profile.profile_report(fx.split_of(spark, sf, "train"))
    counts = [
        F.col(f"{field}_distribution")[value].alias(value)
        for field, value in (("domain", "medical"), ("domain", "legal"), ("direction", "en_to_es"), ("direction", "es_to_en"))
    ]
    plain = [name for name in report.columns if not name.endswith("_distribution")]
    return rounded(report.select(*plain, *counts))


@query(
    "schema_report",
    sql(f"""select 'instruction,input,output,domain,direction' required_fields, 'medical,legal' valid_domains,
        'en_to_es,es_to_en' valid_directions, count(*) total_records, round_even(avg(n_in), 2) mean, max(n_in) "max",
        min(n_in) "min" {_TRAIN}"""),
)
def schema_report(spark, sf):
    report = profile.schema_report(profile.profile_report(fx.split_of(spark, sf, "train")))
    lists = [F.array_join(name, ",").alias(name) for name in ("required_fields", "valid_domains", "valid_directions")]
    return rounded(report.select(*lists, "total_records", "input_len_stats.*"))


def _rounded_sql(columns):
    return ", ".join(f"round({name}, 6) {name}" for name in columns)


@query("slice_stats", sql(f"""select slice, "count", {_rounded_sql(STAT_METRICS)} from stats"""))
def slice_stats(spark, sf):
    return rounded(slices.slice_stats(fx.test_split(spark, sf)))


@query("lexical_diversity", sql("select slice, side, distinct_words, words, round(diversity, 6) diversity from diversity"))
def lexical_diversity(spark, sf):
    return rounded(slices.lexical_diversity(fx.test_split(spark, sf)))


@query(
    "anomaly_counts",
    sql(f"select {_COUNTS}, count(*) filter (anomalous) anomalous_row_count, count(*) total_checked from flagged"),
)
def anomaly_counts(spark, sf):
    return quality.anomaly_counts(fx.dirty_records(spark, sf))


@query("split_counts", sql("select split, count(*) records from splits group by split"))
def split_counts(spark, sf):
    return quality.split_counts(fx.splits(spark, sf))


_BLEU_COLUMNS = """cast(hyp_len as bigint) hyp_len, cast(ref_len as bigint) ref_len, cast(m1 as bigint) match_1,
    cast(m2 as bigint) match_2, cast(m3 as bigint) match_3, cast(m4 as bigint) match_4, cast(t1 as bigint) total_1,
    cast(t2 as bigint) total_2, cast(t3 as bigint) total_3, cast(t4 as bigint) total_4, round(bleu, 6) bleu"""


@query("corpus_bleu", bleu_sql(f"select {_BLEU_COLUMNS} from bleu", "slice = 'overall'"))
def corpus_bleu(spark, sf):
    return rounded(bleu.corpus_bleu(fx.test_split(spark, sf)))


@query("bleu_by_slice", bleu_sql(f"""select slice, "count", {_BLEU_COLUMNS} from bleu"""))
def bleu_by_slice(spark, sf):
    return rounded(bleu.bleu_by_slice(fx.test_split(spark, sf)))


@query(
    "slice_bleu",
    bleu_sql(f"""select slice, "count", {_BLEU_COLUMNS} from bleu where "count" >= 2""", "slice <> 'overall'"),
)
def slice_bleu(spark, sf):
    return rounded(bleu.slice_bleu(fx.test_split(spark, sf)))


_SENSITIVE_LENGTH = """select coalesce(round(avg(n_out / greatest(n_in, 1)) filter (n_in <= 10), 6), 0.0) short_length_ratio,
        coalesce(round(avg(n_out / greatest(n_in, 1)) filter (n_in between 11 and 25), 6), 0.0) medium_length_ratio,
        coalesce(round(avg(n_out / greatest(n_in, 1)) filter (n_in > 25), 6), 0.0) long_length_ratio,
        count(*) filter (n_in <= 10) short_count, count(*) filter (n_in between 11 and 25) medium_count,
        count(*) filter (n_in > 25) long_count from head where slice in ('medical', 'legal')"""


@query("sensitivity_length", sql(_SENSITIVE_LENGTH))
def sensitivity_length(spark, sf):
    return rounded(evaluate.sensitivity_length(fx.test_split(spark, sf)))


_SENSITIVE_DOMAIN = r"""select round(count(distinct w) filter (slice = 'medical') / count(*) filter (slice = 'medical'), 6) medical_output_diversity,
        round(count(distinct w) filter (slice = 'legal') / count(*) filter (slice = 'legal'), 6) legal_output_diversity,
        count(distinct hn) filter (slice = 'medical') medical_count, count(distinct hn) filter (slice = 'legal') legal_count
        from (select slice, hn, unnest(regexp_extract_all("output", '\S+')) w from head)"""


@query("sensitivity_domain", sql(_SENSITIVE_DOMAIN))
def sensitivity_domain(spark, sf):
    return rounded(evaluate.sensitivity_domain(fx.test_split(spark, sf)))


_SENSITIVE_DIRECTION = """select round(avg(n_out) filter (slice = 'en_to_es'), 6) en_to_es_avg_output_len,
        round(avg(n_out) filter (slice = 'es_to_en'), 6) es_to_en_avg_output_len,
        count(*) filter (slice = 'en_to_es') en_to_es_count, count(*) filter (slice = 'es_to_en') es_to_en_count
        from head"""


@query("sensitivity_direction", sql(_SENSITIVE_DIRECTION))
def sensitivity_direction(spark, sf):
    return rounded(evaluate.sensitivity_direction(fx.test_split(spark, sf)))


@query(
    "run_metrics",
    sql("""select 'slices' run, metric || '_' || slice "key", round("value", 6) "value" from metrics
        union all select 'slices', 'count_' || slice, cast("count" as double) from rounded
        union all select 'slices', 'train_loss_start', avg_input_len from rounded where slice = 'overall'
        union all select 'slices', 'train_loss_final', avg_output_len from rounded where slice = 'overall'
        union all select 'slices', 'train_loss_delta', round(avg_input_len - avg_output_len, 6) from rounded where slice = 'overall'"""),
)
def run_metrics(spark, sf):
    """Slice statistics as metrics; the overall lengths stand in for a start and a final loss."""
    stats = settle(slices.report_stats(slices.slice_stats(fx.test_split(spark, sf))), "stats")
    overall = stats.where("slice = 'overall'").select(
        F.col("avg_input_len").alias("train_loss_start"),
        F.col("avg_output_len").alias("train_loss_final"),
        F.lit(-1.0).alias("train_steps"),
    )
    metrics = evaluate.run_metrics(stats, "slices", "slice").unionByName(evaluate.run_metrics(overall, "slices"))
    return rounded(evaluate.loss_delta(metrics))


# ---------------------------------------------------------------- windows, sorts, samples


@query("stratified_split", sql("select doc_id, pair_no, direction, bucket, split from splits"))
def stratified_split(spark, sf):
    return fx.splits(spark, sf).select(*fx.ROW_ID, "bucket", "split")


@query("shuffle_rows", sql("select split, content_key || row_key shuffle_key, instruction from splits"))
def shuffle_rows(spark, sf):
    return split.shuffle_rows(fx.splits(spark, sf)).select("split", "shuffle_key", "instruction")


@query("head_per_group", sql("select slice, doc_id, pair_no, direction from head where hn <= 200 and slice <> 'overall'"))
def head_per_group(spark, sf):
    return evaluate.slice_heads(fx.test_split(spark, sf), 200).select("slice", *fx.ROW_ID)


@query(
    "line_index",
    """select conv_id "session", turn, row_number() over (partition by conv_id order by turn) - 1 idx from conversations
        where role <> 'system' and trim(text) <> ''""",
)
def line_index(spark, sf):
    finals = sessions.final_transcripts(fx.transcripts(spark, sf))
    return sessions.line_index(finals, "session", "turn").select("session", "turn", "idx")


@query(
    "pack_sequences",
    sql(r"""select shard, window_no, count(*) examples, cast(sum(last_token - first_token + 1) as bigint) tokens from (
        select shard, window_no, greatest(s, window_no * 128) first_token, least(en, (window_no + 1) * 128) - 1 last_token from (
          select *, unnest(range(s // 128, (en - 1) // 128 + 1)) window_no from (
            select substr(row_key, 1, 2) shard, cast(sum(n) over w as bigint) en, cast(sum(n) over w as bigint) - n s from (
              select *, len(regexp_extract_all(instruction, '\S+')) + n_in + n_out + 6 n from splits where split = 'train')
            window w as (partition by substr(row_key, 1, 2) order by row_key)))) group by all"""),
)
def pack_sequences(spark, sf):
    """Rendered training prompts; tokens are whitespace tokens."""
    train = fx.split_of(spark, sf, "train")
    prompt = rec.render_prompt(F.col("instruction"), F.col("input"), F.col("output"))
    examples = train.select("shuffle_key", txt.token_count(prompt).alias("n_tokens"))
    packed = sampling.pack_sequences(examples, Rules().window_tokens)
    return rounded(sampling.packed_windows(packed))


@query(
    "group_by_length",
    sql("select doc_id, pair_no, direction, n_in, (row_number() over (order by n_in, row_key) - 1) // 32 batch_no from records"),
)
def group_by_length(spark, sf):
    keyed = split.with_shuffle_key(settle(fx.records(spark, sf), "records"), fx.ROW_ID, 42)
    batches = sampling.group_by_length(keyed.select(*fx.ROW_ID, "n_in", "shuffle_key"), 32)
    return rounded(batches.select(*fx.ROW_ID, "n_in", "batch_no"))


@query(
    "oversample_domain",
    sql("""select doc_id, pair_no, direction, cast(unnest(range(1, 1 + case when "domain" <> 'legal' then 1 else cast(floor(factor) as int) +
        case when ('0x' || substr(row_key, 1, 8))::bigint / 4294967296.0 < factor - floor(factor) then 1 else 0 end end)) as bigint) copy_no
        from splits, (select 0.6 * count(*) filter ("domain" <> 'legal') / ((1 - 0.6) * count(*) filter ("domain" = 'legal')) factor
          from splits where split = 'train') where split = 'train'"""),
)
def oversample_domain(spark, sf):
    train = settle(fx.split_of(spark, sf, "train").select(*fx.ROW_ID, "domain", "shuffle_key"), "train")
    return sampling.oversample_domain(train, "legal", 0.6).select(*fx.ROW_ID, "copy_no")


@query(
    "length_stratified_sample",
    sql("""select bucket, doc_id, pair_no, direction from (select *,
        row_number() over (partition by bucket order by content_key, row_key) k from splits where split = 'train') where k <= 50"""),
)
def length_stratified_sample(spark, sf):
    return sampling.length_stratified_sample(fx.split_of(spark, sf, "train"), 50).select("bucket", *fx.ROW_ID)


# ---------------------------------------------------------------- joins and set operations


@query(
    "bias_scores",
    sql("""select slice, "count", metric, round(slice_val, 6) slice_val, round(overall_val, 6) overall_val,
        round(deviation, 6) deviation, abs(deviation) > 0.2 flagged,
        case when deviation > 0 then 'OVER' else 'UNDER' end direction from scores"""),
)
def bias_scores(spark, sf):
    stats = settle(slices.report_stats(slices.slice_stats(fx.test_split(spark, sf))), "stats")
    return rounded(slices.bias_scores(stats).drop("status"))


@query(
    "cross_slice_gaps",
    sql("""select l.slice left_slice, r.slice right_slice, l.metric, round(l."value", 6) left_val, round(r."value", 6) right_val,
        round(abs(l."value" - r."value"), 6) gap, abs(l."value" - r."value") > max_gap detected
        from (values ('medical', 'legal', 'avg_length_ratio', 0.1), ('en_to_es', 'es_to_en', 'output_diversity', 0.05),
          ('short_sents', 'long_sents', 'avg_word_overlap', 0.05)) g(a, b, c, max_gap)
        join metrics l on l.slice = a and l.metric = c join metrics r on r.slice = b and r.metric = c"""),
)
def cross_slice_gaps(spark, sf):
    stats = settle(slices.report_stats(slices.slice_stats(fx.test_split(spark, sf))), "stats")
    return rounded(slices.cross_slice_gaps(stats).drop("rank", "message"))


@query(
    "bias_flags",
    sql("""select slice, "count", count(*) n_issues, 'Slice ''' || slice || ''' shows bias in: ' || string_agg(metric, ', '
        order by list_position(['avg_input_len', 'avg_output_len', 'avg_length_ratio', 'input_diversity', 'output_diversity',
        'avg_word_overlap'], metric)) summary from scores where abs(deviation) > 0.2 group by slice, "count" """),
)
def bias_flags(spark, sf):
    stats = settle(slices.report_stats(slices.slice_stats(fx.test_split(spark, sf))), "stats")
    flags = slices.bias_flags(slices.bias_scores(stats))
    return rounded(flags.select("slice", "count", F.size("issues").alias("n_issues"), "summary"))


_METRICS_TEXT = " || ' ' || ".join(f"printf('%.3f', {name})" for name in STAT_METRICS)
_BY_METRIC = "list_position([" + ", ".join(f"'{name}'" for name in STAT_METRICS) + "], metric)"
_BY_SLICE = "list_position([" + ", ".join(f"'{name}'" for name in SLICES) + "], slice)"
_GAP_VALUES = ", ".join(f"({rank}, '{a}', '{b}', '{c}', {most}, '{label}', '{lt}', '{rt}')" for rank, (a, b, c, most, label, lt, rt) in enumerate(GAP_RULES))
_BOTH = " || ' ' || ".join(f"(select bool_or(slice = '{a}') and bool_or(slice = '{b}') from rounded)" for a, b, *_ in GAP_RULES)


@query(
    "bias_report",
    sql(f"""select (select {_METRICS_TEXT} from rounded where slice = 'overall') overall_stats,
        (select string_agg(slice || ' ' || {_METRICS_TEXT}, '; ' order by slice) from rounded where slice <> 'overall') slice_stats,
        (select string_agg(slice || ' ' || metric || ' ' || printf('%.3f', deviation), '; ' order by slice, metric) from scores) bias_scores,
        0.2::double bias_threshold,
        (select string_agg(slice || ' ' || "count" || ' ' || metric || ' ' || printf('%.3f', deviation) || ' '
           || case when deviation > 0 then 'OVER' else 'UNDER' end || ' ' || printf('%.3f', slice_val) || ' ' || printf('%.3f', overall_val), '; '
           order by {_BY_SLICE}, {_BY_METRIC}) from scores where abs(deviation) > 0.2) bias_flags,
        (select string_agg(m, '; ' order by k, r) from (
           select 0 k, {_BY_SLICE} r, 'Slice ' || chr(39) || slice || chr(39) || ' shows bias in: ' || string_agg(metric, ', ' order by {_BY_METRIC}) m
             from scores where abs(deviation) > 0.2 group by slice
           union all select 1, rank, label || ' bias detected: ' || lt || '=' || printf('%.3f', l."value") || ' vs ' || rt || '='
               || printf('%.3f', r."value") || ' (gap=' || printf('%.3f', abs(l."value" - r."value")) || ')'
             from (values {_GAP_VALUES}) g(rank, a, b, c, most, label, lt, rt)
             join metrics l on l.slice = a and l.metric = c join metrics r on r.slice = b and r.metric = c where abs(l."value" - r."value") > most)) bias_summary,
        count(distinct slice) total_slices, count(distinct slice) filter (abs(deviation) > 0.2) biased_slices,
        count(*) filter (abs(deviation) > 0.2) > 0 bias_detected, {_BOTH} cross_slice_analysis
        from scores"""),
)
def bias_report(spark, sf):
    """All ten fields; nested ones as text."""
    stats = settle(slices.report_stats(slices.slice_stats(fx.test_split(spark, sf))), "stats")
    number = lambda c: F.format_string("%.3f", c)
    metrics = lambda r: F.concat_ws(" ", *(number(r[m]) for m in STAT_METRICS))
    listed = lambda c, text: F.array_join(F.transform(c, text), "; ")
    scores = lambda e: listed(F.map_entries(e["value"]), lambda x: F.concat_ws(" ", e["key"], x["key"], number(x["value"])))
    flags = lambda f: listed(f["issues"], lambda x: F.concat_ws(
        " ", f["slice"], f["count"].cast("string"), x["metric"], number(x["deviation"]), x["direction"], number(x["slice_val"]), number(x["overall_val"])
    ))
    report = slices.bias_report(stats).select(
        metrics(F.col("overall_stats")).alias("overall_stats"),
        listed(F.map_entries("slice_stats"), lambda e: F.concat_ws(" ", e["key"], metrics(e["value"]))).alias("slice_stats"),
        listed(F.map_entries("bias_scores"), scores).alias("bias_scores"),
        "bias_threshold",
        listed("bias_flags", flags).alias("bias_flags"),
        F.array_join("bias_summary", "; ").alias("bias_summary"),
        "total_slices",
        "biased_slices",
        "bias_detected",
        F.concat_ws(" ", *(F.col(f"cross_slice_analysis.{c}_bias").cast("string") for c in ("domain", "direction", "length"))).alias("cross_slice_analysis"),
    )
    return rounded(report)


@query(
    "turn_pairs",
    """select u.conv_id, u.turn, u.text source, a.text translated from conversations u
        join conversations a on a.conv_id = u.conv_id and a.turn = u.turn + 1 and a.role = 'assistant' where u.role = 'user'""",
)
def turn_pairs(spark, sf):
    return sessions.turn_pairs(fx.table(spark, sf, "conversations"))


@query(
    "union_slices",
    sql("select slice, doc_id, pair_no, direction from sliced where slice in ('medical', 'legal')"),
)
def union_slices(spark, sf):
    return evaluate.union_slices(slices.assign_slices(fx.test_split(spark, sf)), ["medical", "legal"]).select("slice", *fx.ROW_ID)


@query(
    "split_leakage",
    sql("""select split, count(*) records, count(*) filter (exists (select 1 from splits t where t.split = 'train'
        and least(t."input", t."output") = least(s."input", s."output")
        and greatest(t."input", t."output") = greatest(s."input", s."output"))) in_train
        from splits s where split in ('val', 'test') group by split"""),
)
def split_leakage(spark, sf):
    return split.split_leakage(fx.splits(spark, sf).select("split", "input", "output"))


# ---------------------------------------------------------------- gates


@query("anomaly_flags", sql(f"select doc_id, pair_no, {', '.join(quality.ANOMALIES)}, anomalous from flagged"))
def anomaly_flags(spark, sf):
    flags = quality.anomaly_flags(fx.dirty_records(spark, sf))
    return flags.select("doc_id", "pair_no", *quality.ANOMALIES, "anomalous")


@query(
    "anomaly_gate",
    sql(f"""select concat_ws('; ', {_MESSAGES}) anomalies, total_checked, anomalous_row_count, cast(1000 as bigint) drop_threshold,
        case when bad = 0 then 'validated' when bad > 1000 then 'drop_and_continue' else 'fail_fast' end action_taken,
        case when bad > 0 then case when bad > 1000 then bad else 0 end end records_dropped,
        case when bad > 0 then total_checked - bad end records_after_drop
        from (select {_COUNTS}, count(*) filter (anomalous) bad, count(*) filter (anomalous) anomalous_row_count,
          count(*) total_checked from flagged)"""),
)
def anomaly_gate(spark, sf):
    report = quality.anomaly_report(fx.dirty_records(spark, sf))
    return rounded(report.withColumn("anomalies", F.array_join("anomalies", "; ")))


@query(
    "approval_gate",
    sql("""select count(*) filter (split = 'train') >= 10000 approved, count(*) filter (split = 'train') train_records,
        count(*) filter (split = 'val') val_records, count(*) filter (split = 'test') test_records, 'v2_approved' "version" from splits"""),
)
def approval_gate(spark, sf):
    return quality.approval_report(fx.splits(spark, sf)).drop("timestamp")


_EVAL_SQL = """select b.slice, b."count", round(l.mean, 6) avg_input_len, case when b."count" >= 2 or b.slice = 'overall'
          then round_even(bleu, 2) end bleu,
        case when b.slice <> 'overall' then round_even(abs(l.mean - o.mean) / greatest(o.mean, 1.0), 3) end bias_dev,
        case when b.slice in ('short_sents', 'long_sents') then 2.0::double when b.slice <> 'overall' then 0.5::double end cap,
        case when b.slice = 'overall' then round_even(bleu, 2) >= 0.0
          else round_even(abs(l.mean - o.mean) / greatest(o.mean, 1.0), 3)
            < case when b.slice in ('short_sents', 'long_sents') then 2.0 else 0.5 end end passed
        from bleu b join (select slice, avg(n_in) mean from head group by slice) l on l.slice = b.slice,
          (select avg(n_in) mean from head where slice = 'overall') o"""


@query("eval_gate", bleu_sql(_EVAL_SQL))
def eval_gate(spark, sf):
    return rounded(evaluate.eval_report(fx.test_split(spark, sf)))


_SUMMARY_SQL = f"""select 'eval' run, 'bleu_proxy_' || slice "key", bleu "value" from report where bleu is not null
    union all select 'eval', 'bias_length_deviation_' || slice, bias_dev from report where bias_dev is not null"""


@query("eval_summary", bleu_sql(f"select * from (with report as ({_EVAL_SQL}) {_SUMMARY_SQL})"))
def eval_summary(spark, sf):
    return rounded(evaluate.eval_metrics(evaluate.eval_report(fx.test_split(spark, sf)), "eval"))


@query(
    "sensitivity_report",
    sql(f"""select round_even(short_length_ratio, 3) short_length_ratio, round_even(medium_length_ratio, 3) medium_length_ratio,
        round_even(long_length_ratio, 3) long_length_ratio, short_count, medium_count, long_count,
        round_even(medical_output_diversity, 4) medical_output_diversity, round_even(legal_output_diversity, 4) legal_output_diversity, medical_count,
        legal_count, round_even(en_to_es_avg_output_len, 3) en_to_es_avg_output_len, round_even(es_to_en_avg_output_len, 3) es_to_en_avg_output_len,
        en_to_es_count, es_to_en_count from ({_SENSITIVE_LENGTH}), ({_SENSITIVE_DOMAIN}), ({_SENSITIVE_DIRECTION})"""),
)
def sensitivity_report(spark, sf):
    report = evaluate.sensitivity_report(fx.test_split(spark, sf))
    return rounded(report.select(*(f"{part}_sensitivity.*" for part in ("length", "domain", "direction"))))


@query(
    "schema_check",
    sql(f"""select doc_id, pair_no, "input" is null or "input" = '' or "output" is null or "output" = '' missing_field,
        "domain" not in ('medical', 'legal') unseen_domain, direction not in ('en_to_es', 'es_to_en') unseen_direction,
        not n_in between lo and hi length_out_of_range
        from dirty_n, (select min(n_in) lo, max(n_in) hi {_TRAIN})"""),
)
def schema_check(spark, sf):
    schema = settle(profile.schema_report(profile.profile_report(fx.split_of(spark, sf, "train"))), "schema")
    checked = profile.schema_check(profile.with_lengths(fx.dirty_records(spark, sf)), schema)
    return checked.select(
        "doc_id", "pair_no", "missing_field", "unseen_domain", "unseen_direction", "length_out_of_range"
    )


@query(
    "learned_schema_check",
    sql("""select doc_id, pair_no, "input" is null or "input" = '' or "output" is null or "output" = '' missing_field,
        "domain" not in (select "domain" from dirty group by 1 having count(*) >= 0.05 * (select count(*) from dirty)) unseen_domain,
        direction not in (select direction from dirty group by 1 having count(*) >= 0.05 * (select count(*) from dirty)) unseen_direction,
        not n_in between lo and hi length_out_of_range
        from dirty_n, (select quantile_disc(n_in, 0.01) lo, quantile_disc(n_in, 0.99) hi from dirty_n)"""),
)
def learned_schema_check(spark, sf):
    """Pairs with anomalies against what is usual among them; values that no setting names are allowed if frequent."""
    rows = settle(profile.with_lengths(fx.dirty_records(spark, sf)), "dirty")
    checked = profile.schema_check(rows, settle(profile.learned_schema(rows), "schema"))
    return checked.select("doc_id", "pair_no", "missing_field", "unseen_domain", "unseen_direction", "length_out_of_range")


# ---------------------------------------------------------------- streams and sessions


_WINDOWS = """select date_trunc('hour', "timestamp") window_start, direction, "domain", count(*) n,
    round(avg(latency_ms), 9) latency_mean, round(avg(input_len), 9) input_len_mean, round(avg(output_len), 9) output_len_mean,
    round(sum(output_len) / greatest(sum(input_len), 1), 9) out_in_ratio, round(quantile_disc(latency_ms, 0.95), 9) latency_p95
    from log group by all"""


@query("monitor_window", _LOG_SQL + _WINDOWS)
def monitor_window(spark, sf):
    return rounded(monitor.monitor_window(fx.request_log(spark, sf)), 9)


@query("stream_monitor_window", _LOG_SQL + _WINDOWS)
def stream_monitor_window(spark, sf):
    stream = jobs.read_files(spark, sf, fx.table(spark, sf, "events").schema, "events.parquet")
    out = fresh_path(spark, "monitor")
    jobs.stream_monitor(fx.as_request_log(stream), out).awaitTermination()
    return rounded(jobs.read_monitor(spark, out), 9)


@query(
    "stream_inference_log",
    r"""select make_timestamp((1704067200 + u.conv_id * 60 + u.turn) * 1000000) "timestamp", u.text input_text,
        a.text translated_text, case when u.conv_id % 2 = 0 then 'en_to_es' else 'es_to_en' end direction, 'medical' "domain",
        round(length(a.text) / 4, 6) latency_ms,
        len(regexp_extract_all(u.text, '\S+')) input_len, len(regexp_extract_all(a.text, '\S+')) output_len
        from conversations u join conversations a on a.conv_id = u.conv_id and a.turn = u.turn + 1 and a.role = 'assistant'
        where u.role = 'user'""",
)
def stream_inference_log(spark, sf):
    """Answered turns as requests; the latency is derived from the answer's length."""
    requests = settle(
        sessions.turn_pairs(fx.table(spark, sf, "conversations")).select(
            F.timestamp_seconds(F.lit(1704067200) + F.col("conv_id") * 60 + F.col("turn")).alias("timestamp"),
            F.col("source").alias("input_text"),
            F.col("translated").alias("translated_text"),
            F.when(F.col("conv_id") % 2 == 0, "en_to_es").otherwise("es_to_en").alias("direction"),
            F.lit("medical").alias("domain"),
            (F.length("translated") / 4).alias("latency_ms"),
        ),
        "requests",
    )
    out = fresh_path(spark, "log")
    stream = jobs.read_files(spark, requests.inputFiles()[0].rsplit("/", 1)[0], requests.schema)
    jobs.stream_inference_log(stream, out).awaitTermination()
    return rounded(spark.read.parquet(f"{out}/log"))


def _in_steps(df, spark, name, position, steps=(2, 4)):
    """A table written in three appends by position, so that a stream reads it in three micro-batches."""
    path = fresh_path(spark, name)
    low, high = steps
    for part in (F.col(position) < low, F.col(position).between(low, high - 1), F.col(position) >= high):
        df.where(part).coalesce(1).write.mode("append").parquet(path)
    return jobs.read_files(spark, path, df.schema, files=1)


@query(
    "stream_final_lines",
    """select conv_id "session", turn, row_number() over (partition by conv_id order by turn) - 1 idx from conversations
        where role <> 'system' and trim(text) <> ''""",
)
def stream_final_lines(spark, sf):
    out = fresh_path(spark, "lines")
    stream = _in_steps(fx.transcripts(spark, sf), spark, "transcripts", "turn")
    jobs.stream_final_lines(stream, out).awaitTermination()
    return jobs.read_lines_table(spark, out, "session", "turn").select("session", "turn", "idx")


_LINES_SQL = """
with updates as (select conv_id "session", case when role = 'user' then turn else turn - 1 end idx, turn seq,
    case when role = 'user' then text end source, case when role = 'user' then '' else text end translated,
    role = 'user' pending from conversations where role in ('user', 'assistant')),
state as (select "session", idx, max(seq) seq, arg_max(source, seq) source, arg_max(translated, seq) translated,
    arg_max(pending, seq) pending from updates group by all)
"""


@query("upsert_lines", _LINES_SQL + "select * from state")
def upsert_lines(spark, sf):
    out = fresh_path(spark, "updates")
    stream = _in_steps(fx.line_updates(spark, sf), spark, "line-updates", "seq")
    jobs.stream_line_updates(stream, out).awaitTermination()
    return jobs.read_line_state(spark, out)


@query("compact_lines", _LINES_SQL + "select * from state")
def compact_lines(spark, sf):
    """The updates in five micro-batches, compacted after the first two and after the fourth."""
    out, path = fresh_path(spark, "updates"), fresh_path(spark, "line-updates")
    updates = fx.line_updates(spark, sf)
    steps = (F.col("seq") >= 4, F.col("seq") < 1, F.col("seq") == 2, F.col("seq") == 1, F.col("seq") == 3)
    for number, step in enumerate(steps):
        updates.where(step).coalesce(1).write.mode("append").parquet(path)
        jobs.stream_line_updates(jobs.read_files(spark, path, updates.schema, files=1), out).awaitTermination()
        if number in (1, 3):
            jobs.compact_lines(spark, out)
    return jobs.read_line_state(spark, out)


@query(
    "transcript_export",
    """with n as (select u.conv_id "session", u.text source, a.text translated,
        row_number() over (partition by u.conv_id order by u.turn) - 1 idx from conversations u
        left join conversations a on a.conv_id = u.conv_id and a.role = 'assistant' and a.turn = u.turn + 1 where u.role = 'user')
    select "session", idx // 3 page, count(*) "lines", string_agg('[' || (idx + 1) || '] ' || source || chr(10) || '  ' || chr(8594)
        || ' ' || case when coalesce(translated, '') = '' then '...' else translated end, chr(10) || chr(10) order by idx) "text"
        from n group by all""",
)
def transcript_export(spark, sf):
    lines = sessions.turn_pairs(fx.table(spark, sf, "conversations"), unanswered=True).withColumnRenamed("conv_id", "session")
    numbered = sessions.line_index(lines, "session", "turn")
    return rounded(sessions.transcript_export(numbered, page_lines=3))


#: A reader takes few such files at a time, since opening one counts like some megabytes.
EVENTS_PER_FILE = 250_000

_SESSIONS_SQL = """
with g as (select user_id, ts, case when ts - lag(ts) over w < interval 30 minute then 0 else 1 end opens from events
  window w as (partition by user_id order by ts)),
s as (select *, sum(opens) over (partition by user_id order by ts rows unbounded preceding) no from g),
sessions as (select user_id "user", min(ts) "start", max(ts) "end", count(*) "events",
  round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0, 6) "seconds" from s group by user_id, no)
"""


@query("session_summary", _SESSIONS_SQL + "select * from sessions")
def session_summary(spark, sf):
    return rounded(sessions.session_summary(fx.table(spark, sf, "events"), "user_id", "ts"))


@query("stream_sessions", _SESSIONS_SQL + 'select "user", "start", "end", events from sessions')
def stream_sessions(spark, sf):
    """All events in one micro-batch, then one event long after them, which the watermark follows and closes their sessions.

    Files of bounded length are read by many tasks, so that none of them holds the sessions of all events.
    """
    path, out = fresh_path(spark, "events"), fresh_path(spark, "sessions")
    events = fx.table(spark, sf, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    last = events.agg(F.lit(None).cast("bigint").alias("user_id"), (F.max("ts") + F.expr("interval 1 year")).alias("ts"))
    for part in (events, last.withColumn("user_id", F.lit(None).cast(events.schema["user_id"].dataType))):
        part.write.mode("append").option("maxRecordsPerFile", EVENTS_PER_FILE).parquet(path)
        stream = jobs.stream_sessions(jobs.read_files(spark, path, events.schema), "user_id", "ts")
        query = stream.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", f"{out}/_checkpoint")
        query.trigger(availableNow=True).start().awaitTermination()
    return rounded(spark.read.schema(stream.schema).parquet(out).where("user is not null"))


# ---------------------------------------------------------------- user functions


def _stub_model():
    return lambda prompts: [f" [{prompt}] " for prompt in prompts]


@query(
    "batch_translate",
    sql("""select doc_id, pair_no, direction, '[### Instruction:' || chr(10) || instruction || chr(10) || chr(10)
        || '### Input:' || chr(10) || "input" || chr(10) || chr(10) || '### Response:' || chr(10) || ']' translated
        from records"""),
)
def batch_translate(spark, sf):
    """A stand-in model that answers with the prompt in brackets."""
    prompts = fx.records(spark, sf).select(*fx.ROW_ID, rec.render_prompt(F.col("instruction"), F.col("input")).alias("prompt"))
    return translate.batch_translate(prompts, _stub_model).select(*fx.ROW_ID, "translated")


@query(
    "training_prompts",
    sql("""select split, doc_id, pair_no, direction, '### Instruction:' || chr(10) || instruction || chr(10) || chr(10)
        || '### Input:' || chr(10) || "input" || chr(10) || chr(10) || '### Response:' || chr(10) || "output" "text"
        from splits where split in ('train', 'val')"""),
)
def training_prompts(spark, sf):
    return sampling.training_prompts(fx.splits(spark, sf), keep=fx.ROW_ID).drop("shuffle_key")
