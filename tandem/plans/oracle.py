"""The bitext views in plain SQL, as common table expressions for the comparison queries."""

from tandem.sources.digest import PRIMES

VIEWS = r"""
with l as (select doc_id, source, lang, unnest(string_split(text, chr(10))) ln,
                  generate_subscripts(string_split(text, chr(10)), 1) - 1 i from documents),
pairs as (select a.doc_id, cast(a.i//2 as bigint) pair_no, a.source, a.lang,
    cast(substr(a.source,4) as int) source_no,
    case when cast(substr(a.source,4) as int) < 10 then 0 else 1 end source_rank,
    case when cast(substr(a.source,4) as int) < 10 then 'medical' else 'legal' end "domain",
    trim(regexp_replace(a.ln,'\s+',' ','g')) en, trim(regexp_replace(coalesce(b.ln, ''),'\s+',' ','g')) es
  from l a left join l b on a.doc_id = b.doc_id and b.i = a.i + 1 where a.i % 2 = 0),
m as (select *, len(regexp_extract_all(en,'\S+')) ne, len(regexp_extract_all(es,'\S+')) ns
  from pairs where en <> '' and es <> ''),
kept as (select * from m
  where ne between 3 and 200 and ns between 3 and 200 and ne/greatest(ns,1) between 0.4 and 2.5
  qualify row_number() over (partition by en||es order by source_rank, doc_id, pair_no) = 1),
directed as (select doc_id, pair_no, "domain", 'en_to_es' direction, en "input", es "output" from kept
  union all select doc_id, pair_no, "domain", 'es_to_en', es, en from kept),
records as (select *,
    'Translate the following '||"domain"||' sentence from '||
      case when direction = 'en_to_es' then 'English to Spanish.' else 'Spanish to English.' end instruction,
    len(regexp_extract_all("input",'\S+')) n_in, len(regexp_extract_all("output",'\S+')) n_out,
    md5('42|'||direction||'|'||"input"||'|'||"output") content_key,
    md5('42|'||doc_id||'|'||pair_no||'|'||direction) row_key from directed),
d as (select *, case when n_in <= 15 then 'short_sents' when n_in > 30 then 'long_sents'
    else 'mid_sents' end bucket from records),
e as (select *, count(*) over (partition by "domain", direction, bucket) g,
  row_number() over (partition by "domain", direction, bucket order by content_key, row_key) rn from d),
f as (select *, case when g >= 3 then greatest(g*4//5, 1) else g*4//5 end te from e),
h as (select *, case when g >= 3 then greatest(te + g//10, te + 1) else te + g//10 end ve from f),
splits as (select *, case when rn <= te then 'train' when rn <= ve then 'val' else 'test' end split from h),
test as (select * from splits where split = 'test'),
sliced as (
  select 'overall' slice, * from test
  union all select "domain", * from test where "domain" in ('medical', 'legal')
  union all select direction, * from test where direction in ('en_to_es', 'es_to_en')
  union all select bucket, * from test where bucket in ('short_sents', 'long_sents')),
head as (select * from (select *, row_number() over (partition by slice order by content_key, row_key) hn
  from sliced)),
dirty as (select doc_id, pair_no, source, case when doc_id % 97 <> 0 then en end "input",
    case when doc_id % 89 = 0 then '' else es end "output",
    case when source_no >= 18 then 'finance' else "domain" end "domain",
    case when lang = 'fr' then 'fr_to_en' else 'en_to_es' end direction from pairs),
dirty_n as (select *, len(regexp_extract_all(coalesce("input", ''),'\S+')) n_in from dirty),
flags as (select *, coalesce("input", '') = '' null_inputs,
    coalesce("input", '') <> '' and n_in > 200 too_long, coalesce("input", '') <> '' and n_in < 3 too_short,
    coalesce("output", '') = '' null_outputs, "domain" not in ('medical', 'legal') invalid_domains,
    direction not in ('en_to_es', 'es_to_en') invalid_directions from dirty_n),
flagged as (select *, null_inputs or too_long or too_short or null_outputs or invalid_domains
    or invalid_directions anomalous from flags),
word_rows as (select slice, 'input' side, unnest(regexp_extract_all("input", '\S+')) word from sliced
  union all select slice, 'output', unnest(regexp_extract_all("output", '\S+')) from sliced),
diversity as (select slice, side, count(distinct word) distinct_words, count(*) words,
    count(distinct word) / count(*) diversity from word_rows group by all),
lapped as (select *, len(list_intersect(list_distinct(regexp_extract_all(lower("input"), '\S+')),
    list_distinct(regexp_extract_all(lower("output"), '\S+'))))
    / greatest(len(list_distinct(regexp_extract_all(lower("input"), '\S+'))), 1) overlap from sliced),
stats as (select o.slice, count(*) "count", sum(n_in) / count(*) avg_input_len, sum(n_out) / count(*) avg_output_len,
    avg(n_out / greatest(n_in, 1)) avg_length_ratio, max(i.diversity) input_diversity,
    max(u.diversity) output_diversity, avg(overlap) avg_word_overlap
  from lapped o join diversity i on o.slice = i.slice and i.side = 'input'
    join diversity u on o.slice = u.slice and u.side = 'output' group by o.slice),
rounded as (select slice, "count", round_even(avg_input_len, 2) avg_input_len,
    round_even(avg_output_len, 2) avg_output_len, round_even(avg_length_ratio, 3) avg_length_ratio,
    round_even(input_diversity, 3) input_diversity, round_even(output_diversity, 3) output_diversity,
    round_even(avg_word_overlap, 3) avg_word_overlap from stats),
metrics as (unpivot rounded on avg_input_len, avg_output_len, avg_length_ratio, input_diversity,
    output_diversity, avg_word_overlap into name metric value "value"),
scores as (select s.slice, s."count", s.metric, s."value" slice_val, o."value" overall_val,
    case when o."value" = 0 then 0.0 else round_even((s."value" - o."value") / o."value", 3) end deviation
  from metrics s join metrics o on s.metric = o.metric and o.slice = 'overall' where s.slice <> 'overall'),
bleu_in as (select slice, doc_id, pair_no, direction, hn, side,
    regexp_extract_all(regexp_replace(regexp_replace(regexp_replace(regexp_replace(' ' ||
      replace(replace(replace(replace(replace(replace(replace(txt, '<skipped>', ''), '-' || chr(10), ''), chr(10), ' '),
      '&quot;', '"'), '&amp;', '&'), '&lt;', '<'), '&gt;', '>') || ' ',
      '([\{-\~\[-\` -\&\(-\+\:-\@\/])', ' \1 ', 'g'), '([^0-9])([\.,])', '\1 \2 ', 'g'),
      '([\.,])([^0-9])', ' \1 \2', 'g'), '([0-9])(-)', '\1 \2 ', 'g'), '\S+') toks
  from (select *, 'h' side, "output" txt from head union all select *, 'r' side, "input" txt from head)),
bleu_pos as (select *, unnest(range(1, len(toks) + 1)) p from bleu_in),
bleu_grams as (select slice, doc_id, pair_no, direction, hn, side, n, array_to_string(toks[p:p + n - 1], ' ') gram
  from bleu_pos, (select unnest([1, 2, 3, 4]) n) where p + n - 1 <= len(toks)),
bleu_counts as (select slice, doc_id, pair_no, direction, hn, n, gram,
    count(*) filter (side = 'h') ch, count(*) filter (side = 'r') cr from bleu_grams group by all),
"""

# Sums and score per slice over the heads of `{limit}` records.
BLEU = r"""
bleu_n as (select slice, n, sum(least(ch, cr)) m, sum(ch) t from bleu_counts where {limit} group by all),
bleu_len as (select slice, count(*) filter (side = 'h') "count", sum(len(toks)) filter (side = 'h') hyp_len,
    sum(len(toks)) filter (side = 'r') ref_len from bleu_in where {limit} group by all),
bleu_wide as (select l.slice, any_value("count") "count", any_value(hyp_len) hyp_len, any_value(ref_len) ref_len,
    coalesce(max(m) filter (n = 1), 0) m1, coalesce(max(m) filter (n = 2), 0) m2,
    coalesce(max(m) filter (n = 3), 0) m3, coalesce(max(m) filter (n = 4), 0) m4,
    coalesce(max(t) filter (n = 1), 0) t1, coalesce(max(t) filter (n = 2), 0) t2,
    coalesce(max(t) filter (n = 3), 0) t3, coalesce(max(t) filter (n = 4), 0) t4
  from bleu_len l left join bleu_n b on l.slice = b.slice group by l.slice),
bleu_zero as (select *, cast(m1 = 0 as int) z1, cast(m1 = 0 as int) + cast(m2 = 0 as int) z2,
    cast(m1 = 0 as int) + cast(m2 = 0 as int) + cast(m3 = 0 as int) z3,
    cast(m1 = 0 as int) + cast(m2 = 0 as int) + cast(m3 = 0 as int) + cast(m4 = 0 as int) z4 from bleu_wide),
bleu as (select *, case when m1 + m2 + m3 + m4 = 0 or least(t1, t2, t3, t4) = 0 then 0.0 else
    (case when hyp_len >= ref_len then 1.0 else exp(1 - ref_len / hyp_len) end) * exp((
      ln(case when m1 = 0 then 100.0 / (pow(2, z1) * t1) else 100.0 * m1 / t1 end)
      + ln(case when m2 = 0 then 100.0 / (pow(2, z2) * t2) else 100.0 * m2 / t2 end)
      + ln(case when m3 = 0 then 100.0 / (pow(2, z3) * t3) else 100.0 * m3 / t3 end)
      + ln(case when m4 = 0 then 100.0 / (pow(2, z4) * t4) else 100.0 * m4 / t4 end)) / 4) end bleu from bleu_zero)
"""


def sql(select: str) -> str:
    return VIEWS + "done as (select 1)\n" + select


def bleu_sql(select: str, limit: str = "true") -> str:
    return VIEWS + BLEU.format(limit=limit) + select


def over_all_records(text: str) -> str:
    """The same SQL with every record in the place of the test split."""
    return text.replace("test as (select * from splits where split = 'test')", "test as (select * from splits)")


def checksum_sql(rows: str) -> str:
    """(key, checksum) of a select of (key, "text"): the text's bytes as one number modulo two primes, seven bytes a step."""
    residue = lambda p: f"format('{{:016x}}', list_reduce(list_prepend(0::hugeint, digits), lambda a, x: (a * 72057594037927936 + x) % {p})::bigint)"
    return f"""(select key, {" || ".join(map(residue, PRIMES))} checksum from (
      select key, list_transform(regexp_extract_all(lpad(h, cast(ceil(length(h) / 14.0) * 14 as int), '0'), '.{{14}}'),
        lambda x: ('0x' || x)::hugeint) digits from (select key, '01' || hex(encode("text")) h from ({rows}))))"""


def fingerprint_sql(columns: str, rows: str) -> str:
    """("rows", fingerprint) of a select with these columns, whatever its order."""
    value = lambda c: f"""coalesce(strlen(cast("{c}" as varchar)) || ':' || cast("{c}" as varchar), '-')"""
    part = lambda at: f"sum(('0x' || substr(h, {at}, 15))::hugeint)"
    return f"""select count(*) "rows", md5({part(1)} || '|' || {part(16)} || '|' || count(*)) fingerprint
      from (select sha256({" || ".join(map(value, columns.split()))}) h from ({rows}))"""
