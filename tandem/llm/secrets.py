"""Secret scans through a ledger of contents already scanned, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tandem.workspace import settle

LEDGER = "blob binary, rule string, version int, spans array<struct<start: bigint, end: bigint>>"
SPAN = "struct<start: bigint, end: bigint>"
#: Copies of a content are dealt over this many keys when findings go back to them; findings are repeated as often.
SALTS = 32


@dataclass(frozen=True)
class Rule:
    """A match counts if its group `group` has at least `least` characters. A new pattern needs a new version.

    Matches are taken from the left without overlap. Patterns hold no groups that can be empty at a match of no length.
    """

    name: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1


#: The three kinds every scan must find.
BASE = (
    Rule(
        "assign",
        1,
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=8,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", least=16),
    # A run of 32 or more is found whole wherever shorter runs are skipped, and these are most of any prose.
    Rule("hex", 1, r"[0-9a-f]{32,}", least=32),
)
#: Added kinds: forms that only credentials have.
ADDED = (
    Rule("pem", 1, r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("prefixed", 1, r"(?:gh[oprsu]_[A-Za-z0-9]{30,}|xox[abprs]-[A-Za-z0-9-]{20,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35})"),
)
RULES = BASE + ADDED


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """What `use` makes of a value, which is computed once however often it is named there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running_sum(values: Column) -> Column:
    """Sums of an array of bigints up to each place. It is done in cells of about the root of its length, since an array
    that grows by one place is copied: an array of any length costs little more than one pass."""
    zero = F.lit(0).cast("bigint")

    def chain(numbers: Column, start: Column) -> Column:
        return F.aggregate(numbers, F.array(start), lambda a, x: F.array_append(a, F.element_at(a, -1) + x))

    def in_cells(numbers: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(numbers))).cast("int")
        count = F.ceil(F.size(numbers) / width).cast("int")
        cells = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.slice(numbers, i * width + 1, width))
        starts = chain(F.transform(cells, lambda c: F.aggregate(c, zero, lambda a, x: a + x)), zero)
        return bound(starts, lambda s: F.flatten(F.transform(cells, lambda c, i: F.slice(chain(c, F.get(s, i)), F.lit(2), F.size(c)))))

    return bound(values, lambda v: F.when(F.size(v) == 0, v).otherwise(in_cells(v)))


def matches(text: Column, rule: Rule) -> Column:
    """(start, end) of the rule's matches, in code points, end exclusive."""
    pattern = F.lit(rule.pattern)
    none = F.array().cast(f"array<{SPAN}>")
    # What counts for `least` beside the match itself.
    found = F.arrays_zip(F.regexp_extract_all(text, pattern, F.lit(0)).alias("all"), F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("part"))

    def placed(hits: Column) -> Column:
        # The pieces between matches: their lengths place the matches.
        gaps = F.slice(F.split(text, rule.pattern, -1), F.lit(1), F.size(hits))
        ends = running_sum(F.zip_with(gaps, hits, lambda g, h: (F.length(g) + F.length(h["all"])).cast("bigint")))
        enough = lambda h: F.length(h["part"]) >= rule.least
        spans = F.zip_with(ends, hits, lambda e, h: F.when(enough(h), F.struct((e - F.length(h["all"])).alias("start"), e.alias("end"))))
        return F.filter(spans, lambda s: s.isNotNull())

    # Most texts have no match at all, which one search tells.
    return F.when(text.rlike(rule.pattern), bound(found, placed)).otherwise(none)


def address(text: Column) -> Column:
    """Content address of a text; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def _current(ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """The ledger's rows of these rules in these versions."""
    current = ((F.col("rule") == r.name) & (F.col("version") == r.version) for r in rules)
    return ledger.where(reduce(Column.__or__, current, F.lit(False)))


def unseen(addressed: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`blob`, `first` (one of its paths) and `missing` (rules) per content with a rule version that it wasn't scanned with."""
    blobs = addressed.groupBy("blob").agg(F.min("path").alias("first"))
    done = _current(ledger, rules).groupBy("blob").agg(F.collect_set("rule").alias("done"))
    names = F.array(*(F.lit(r.name) for r in rules))
    missing = F.array_except(names, F.coalesce("done", F.array().cast("array<string>")))
    return blobs.join(done, "blob", "left").select("blob", "first", missing.alias("missing")).where(F.size("missing") > 0)


def scan(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, path: str = "doc_id", text: str = "text") -> DataFrame:
    """Scans what the ledger lacks and appends it; gives `path` (the table's paths), `blob` of every row of `docs`, which
    holds all historical versions of all paths. `findings` joins the ledger back to it.

    Contents are told apart by the SHA-256 of their bytes. One row of each unseen content is read again and searched with the
    rule versions it misses; copies, earlier contents and earlier rule versions are not. Texts only travel where there are
    too many unseen contents to broadcast. The ledger has a row per content, rule and version, also without findings. It is
    appended to in one committed write; where two scans add the same content, equal rows result and count once.
    """
    spark = docs.sparkSession
    versions = docs.select(F.col(f"`{path}`").alias("path"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    addressed = settle(versions.select("path", address(F.col("text")).alias("blob")), "addressed")
    todo = settle(unseen(addressed, read_ledger(spark, ledger), rules), "unseen").withColumnRenamed("blob", "_blob")
    here = (F.col("blob") == F.col("_blob")) & F.col("path").eqNullSafe(F.col("first"))
    # The join's narrow side is built, so the texts stream through unsorted.
    wanted = versions.withColumn("blob", address(F.col("text"))).join(todo.hint("shuffle_hash"), here)
    entries = [
        F.when(
            F.array_contains("missing", r.name),
            F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version"), matches(F.col("text"), r).alias("spans")),
        )
        for r in rules
    ]
    scanned = wanted.select("blob", F.inline(F.filter(F.array(*entries), lambda e: e.isNotNull())))
    scanned.select("blob", "rule", "version", "spans").write.mode("append").parquet(ledger)
    return addressed


def findings(addressed: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`path`, `blob`, `spans` per row of `addressed`: (start, kind, end) of all rules, by start, then in the rules' order.

    Rows of a content that many paths hold are dealt over SALTS keys; only contents with findings are repeated for it.
    """
    order = F.create_map(*(x for i, r in enumerate(rules) for x in (F.lit(r.name), F.lit(i))))
    known = _current(read_ledger(addressed.sparkSession, ledger), rules)
    found = known.where(F.size("spans") > 0).dropDuplicates(["blob", "rule"])
    spans = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), order[F.col("rule")].alias("at"), F.col("rule").alias("kind"), s["end"].alias("end")))
    per_blob = found.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list(spans))).alias("spans"))
    salted = per_blob.select("blob", "spans", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    dealt = addressed.withColumn("salt", F.pmod(F.xxhash64("path"), F.lit(SALTS)).cast("int"))
    joined = dealt.join(salted, ["blob", "salt"], "left").drop("salt")
    plain = F.transform("spans", lambda s: F.struct(s["start"], s["kind"], s["end"]))
    return joined.withColumn("spans", F.coalesce(plain, F.array().cast("array<struct<start: bigint, kind: string, end: bigint>>")))
