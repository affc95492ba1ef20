"""The registered queries of this subpackage, each with comparison SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.llm import decontaminate, jaccard, lm, merkle, mixing, pii, quality, secrets, substrings, tokens, urls, warc, whitening
from tandem.workspace import fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
TOKENIZER = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096


def query(name: str, oracle: str | None = None):
    def register(function):
        QUERIES[name] = function
        if oracle is not None:
            ORACLE[name] = oracle
        return function

    return register


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


@query("op6_token_counts")
def op6_token_counts(spark, sf):
    import public_tokenizers

    path = public_tokenizers.path(TOKENIZER)
    counts = tokens.count_tokens(documents(spark, sf), path, fresh_path(spark, "token-cache"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query("op9_quality_rules")
def op9_quality_rules(spark, sf):
    return quality.judge(documents(spark, sf)).drop("n_lines")


OP10 = """
with parts as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages
), hosts as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from parts
), rules(h, p, v) as (
  values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), best as (
  select page_id, max_by(h || p, length(h || p)) as rule, max_by(v, length(h || p)) as v
  from hosts join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by page_id
)
select page_id, host, path, rule, coalesce(v, 'allow') as verdict from hosts left join best using (page_id)
"""


@query("op10_url_filters", OP10)
def op10_url_filters(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    return urls.judge_urls(pages, urls.standard_rules(spark)).select("page_id", "host", "path", "rule", "verdict")


@query("op1_ngram_jaccard")
def op1_ngram_jaccard(spark, sf):
    return jaccard.similar_documents(documents(spark, sf))


@query("op8_substring_dedup")
def op8_substring_dedup(spark, sf):
    stripped = substrings.remove_repeats(documents(spark, sf))
    return stripped.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op4_decontamination")
def op4_decontamination(spark, sf):
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
    found = decontaminate.find_passages(documents(spark, sf), benchmark, ("doc_id",))
    region = F.transform("regions", lambda r: F.concat_ws(":", r["item_id"], r["start"], r["end"], r["edits"]))
    items = F.array_distinct(F.transform("regions", lambda r: r["item_id"]))
    return found.select(
        "doc_id", (F.size("regions") > 0).alias("contaminated"), F.size(items).cast("bigint").alias("n_items"), F.array_join(region, ",").alias("regions")
    )


@query("op5_personal_data")
def op5_personal_data(spark, sf):
    docs = documents(spark, sf)
    found = pii.find(docs, pii.train(pii.label_sample(docs)), ("doc_id",))
    base = F.filter("spans", lambda s: s["base"])
    digest = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(digest(base), 256).alias("base_sha256"), digest("spans").alias("spans"))


OP3 = """
with pages_ as (
  select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages
), best as (
  select payload_digest, max(page_id) as original from pages_ where payload_bytes >= 1000 group by 1
)
select page_id, payload_bytes, payload_digest, case when original > page_id then 'revisit' else 'response' end as record_type,
       case when original > page_id then original end as refers_to
from pages_ left join best using (payload_digest)
"""


@query("op3_warc_revisits", OP3)
def op3_warc_revisits(spark, sf):
    plain, fresh = fresh_path(spark, "warc"), fresh_path(spark, "warc-fresh")
    warc.write_archives(warc.as_responses(spark.read.parquet(f"{sf}/pages.parquet")), plain)
    warc.deduplicate(spark, plain, fresh)
    return warc.read_archives(spark, fresh, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op7_lm_scoring")
def op7_lm_scoring(spark, sf):
    return lm.score_documents(documents(spark, sf))


@query("op2_source_mixing")
def op2_source_mixing(spark, sf):
    mixed = mixing.mix(documents(spark, sf))
    return mixed.select("doc_id", "source", "lang", "topic", "n_tokens", F.round("probability", 9).alias("probability"), F.round("weight", 9).alias("weight"))


_LEAF = " || ".join(f"coalesce(strlen(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')" for c in ("doc_id", "source", "lang", "{n}", "text"))
# crc32 by bits: a letter is met by exclusive or, a -1 shifts by one bit.
_CRC = """xor(4294967295, list_reduce(flatten(list_prepend([4294967295], list_transform(string_split(cast(doc_id as varchar), ''),
    lambda x: [ascii(x)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda x, y: case when y >= 0 then xor(x, y) when x % 2 = 1 then xor(x >> 1, 3988292384) else x >> 1 end))"""
OP11 = f"""
with recursive leaves as (
  select doc_id, lang, sha256({_LEAF.format(n="n_chars")}) leaf,
         case when {_CRC} % 7 = 0 then sha256({_LEAF.format(n="(n_chars + 1)")}) end tampered from documents
), placed as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 pos, count(*) over (partition by lang) c from leaves
), up as (
  select lang, 0 lvl, pos, leaf h, c from placed
  union all
  select lang, lvl + 1, pos // 2, sha256(string_agg(h, '' order by pos)), (c + 1) // 2 from up where c > 1 group by lang, lvl, pos // 2, c
), roots as (
  select lang, h, row_number() over (order by lang nulls first) - 1 pos, count(*) over () c from up where c = 1
), top as (
  select 0 lvl, pos, h, c from roots
  union all
  select lvl + 1, pos // 2, sha256(string_agg(h, '' order by pos)), (c + 1) // 2 from top where c > 1 group by lvl, pos // 2, c
), nodes as (
  select lang, lvl, pos, case when pos % 2 = 1 then lag(h) over w else '' end b, case when pos % 2 = 0 then coalesce(lead(h) over w, '') else '' end a
  from up where c > 1 window w as (partition by lang, lvl order by pos)
), high as (
  select lvl, pos, case when pos % 2 = 1 then lag(h) over w else '' end b, case when pos % 2 = 0 then coalesce(lead(h) over w, '') else '' end a
  from top where c > 1 window w as (partition by lvl order by pos)
), steps as (
  select p.lang, p.pos, n.lvl, n.b, n.a from placed p join nodes n on n.lang is not distinct from p.lang and n.pos = p.pos >> n.lvl
  union all
  select p.lang, p.pos, 1000 + t.lvl, t.b, t.a from placed p join roots r on r.lang is not distinct from p.lang join high t on t.pos = r.pos >> t.lvl
), paths as (
  select lang, pos, list({{'b': b, 'a': a}} order by lvl) path from steps group by lang, pos
), folded as (
  select p.doc_id, p.leaf, r.h subroot, (select h from top where c = 1) root, sha256(list_aggregate(list_transform(path, lambda s: s.b || s.a), 'string_agg', '')) proof,
         list_reduce(list_prepend({{'b': '', 'a': coalesce(tampered, leaf)}}, path), lambda x, y: {{'b': '', 'a': sha256(y.b || x.a || y.a)}}).a as folded
  from placed p join roots r on r.lang is not distinct from p.lang
  join (select lang, pos, path from paths
        union all select lang, pos, [] from placed p where not exists (select 1 from paths q where q.lang is not distinct from p.lang and q.pos = p.pos)) s
    on s.lang is not distinct from p.lang and s.pos = p.pos
)
select doc_id, leaf, subroot, root, coalesce(proof, sha256('')) proof_sha256, folded folded_root, folded = root verified from folded
"""


@query("op11_merkle_manifest", OP11)
def op11_merkle_manifest(spark, sf):
    return merkle.manifest(documents(spark, sf))


@query("op12_embedding_whitening")
def op12_embedding_whitening(spark, sf):
    return whitening.whiten(spark.read.parquet(f"{sf}/embeddings.parquet"))


def _oracle13() -> str:
    """Each kind's matches are placed by the pieces between them."""
    kinds = []
    for at, rule in enumerate(secrets.RULES):
        pattern = rule.pattern.replace("'", "''")
        kinds.append(f"""
  select doc_id, row, {at} "at", '{rule.name}' kind, s, s + length(m) e from (
    select doc_id, row, unnest(found) m, unnest(part) p,
           unnest(list_transform(range(1, len(found) + 1), lambda i: list_sum(list_transform(gaps[1:i], lambda g: length(g)))
             + coalesce(list_sum(list_transform(found[1:i - 1], lambda f: length(f))), 0)))::bigint s
    from (select doc_id, row, regexp_extract_all("text", '{pattern}') found, regexp_extract_all("text", '{pattern}', {rule.group}) part,
                 string_split_regex("text", '{pattern}') gaps from d where regexp_matches("text", '{pattern}'))
  ) where length(p) >= {rule.least}""")
    return f"""
with d as (select doc_id, coalesce("text", '') "text", row_number() over () as row from documents), spans as ({" union all ".join(kinds)})
select d.doc_id, {", ".join(f"count(*) filter (kind = '{r.name}') n_{r.name}" for r in secrets.BASE)},
       sha256(coalesce(string_agg(kind || ':' || s || ':' || e, ',' order by s, "at") filter ("at" < {len(secrets.BASE)}), '')) base_sha256,
       coalesce(string_agg(kind || ':' || s || ':' || e, ',' order by s, "at"), '') spans
from d left join spans using (row) group by d.doc_id, row
"""


@query("op13_secret_scans", _oracle13())
def op13_secret_scans(spark, sf):
    """Two scans of one history, the second with all rules: it finds the first one's ledger and only does what that lacks."""
    docs, ledger = documents(spark, sf), fresh_path(spark, "secret-ledger")
    late = F.col("source").isNull() | (F.xxhash64("source") < 0)
    secrets.scan(docs.where(~late), ledger, secrets.BASE)
    found = secrets.findings(secrets.scan(docs, ledger), ledger)
    base = F.filter("spans", lambda s: s["kind"].isin(*(r.name for r in secrets.BASE)))
    digest = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        F.col("path").alias("doc_id"), *(count(r.name) for r in secrets.BASE), F.sha2(digest(base).cast("binary"), 256).alias("base_sha256"), digest("spans").alias("spans")
    )
