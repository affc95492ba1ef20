"""URL rules by a cascade of Bloom filters, in DataFrame functions only."""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.workspace import settle

#: (host, path, verdict); a path begins with "/".
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
HASHES = 4
BITS_PER_KEY = 10


def host_of(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end, A-Z lower-cased; empty without "://"."""
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def candidate_keys(host: Column, path: Column, labels: list[int], lengths: list[int]) -> list[Column]:
    """The keys under which a rule may list a url: the last n labels of its host with the first k characters of its path."""
    dots = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit("")))
    return [
        F.when((dots >= n - 1) & (F.length(path) >= k), F.concat(F.substring_index(host, ".", -n), F.substring(path, 1, k)))
        for n in labels
        for k in lengths
    ]


@dataclass(frozen=True)
class Level:
    """One Bloom filter: a one-row table of 64-bit words, and its number of bits (a power of two)."""

    words: DataFrame
    bits: int
    seed: int

    def hit(self, key: Column) -> Column:
        words = self.words.scalar()
        found = F.lit(True)
        for position in _positions(key, self.bits, self.seed):
            word = F.get(words, F.shiftright(position, 6).cast("int"))
            found = found & (F.getbit(word, (position % 64).cast("int")) == 1)
        return found


def _positions(key: Column, bits: int, seed: int) -> list[Column]:
    return [F.xxhash64(key, F.lit(seed * HASHES + i)).bitwiseAND(F.lit(bits - 1)) for i in range(HASHES)]


def _level(keys: DataFrame, n: int, seed: int) -> Level:
    """Bits are set by an aggregate with map-side combine; the filter has BITS_PER_KEY bits per key of its own set."""
    bits = max(64, 1 << (BITS_PER_KEY * n - 1).bit_length())
    spark = keys.sparkSession
    at = keys.select(F.explode(F.array(*_positions(F.col("key"), bits, seed))).alias("at"))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("at") % 64).cast("int"))
    words = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(one).alias("bits"))
    empty = spark.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    dense = words.unionByName(empty).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    row = dense.agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("cells")).select(F.col("cells.bits").alias("words"))
    return Level(settle(row, f"bloom-{seed}"), bits, seed)


class Cascade:
    """Exact membership over a known universe of keys, without a join.

    Level 0 holds the listed keys, level 1 the universe's keys that pass level 0 without being listed, level 2 the
    listed keys that pass level 1, and so on until no key is left. A key is listed if the first level it misses is odd.
    Keys from outside the universe may be taken wrongly, so the universe must be the whole corpus' own keys.
    """

    def __init__(self, levels: list[Level]):
        self.levels = levels

    @classmethod
    def build(cls, listed: DataFrame, universe: DataFrame) -> Cascade:
        """From tables with a column `key`. Only keys that pass level 0 are ever shuffled."""
        listed = settle(listed.where("key is not null").distinct(), "listed")
        levels: list[Level] = []
        inside, outside, n = listed, None, listed.count()
        while n:
            levels.append(_level(inside, n, len(levels)))
            passing = universe.where("key is not null") if outside is None else outside
            passing = passing.where(levels[-1].hit(F.col("key")))
            if outside is None:
                passing = passing.select("key").distinct().join(listed, "key", "left_anti")
            passing = settle(passing, "passing")
            inside, outside, n = passing, inside, passing.count()
        return cls(levels)

    def member(self, key: Column) -> Column:
        """False for null."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for i, level in reversed(list(enumerate(self.levels))):
            answer = F.when(~level.hit(key), F.lit(i % 2 == 1)).otherwise(answer)
        return key.isNotNull() & answer


def judge_urls(pages: DataFrame, rules: DataFrame, otherwise: str = "allow", url: str = "url") -> DataFrame:
    """`host`, `path`, `rule` (longest that fits, else null) and `verdict` beside the columns of `pages`, in place of any
    that have these names.

    `rules` has host, path and verdict ("allow" or "block"). A rule fits its host and all subdomains if the path begins
    with the rule's. A url without a rule gets `otherwise`: it is in neither list. Null urls and urls without "://" have
    empty host and path and fit no rule. Repeated rows are judged alike; equal rules with both verdicts: block.
    """
    spark = pages.sparkSession
    key = F.concat("host", "path").alias("key")
    shape = rules.agg(
        F.sort_array(F.collect_set(F.size(F.split("host", r"\.")))).alias("labels"), F.sort_array(F.collect_set(F.length("path"))).alias("lengths")
    ).first()
    parts = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    if not shape["labels"]:
        return parts.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(otherwise)})
    keys = candidate_keys(F.col("host"), F.col("path"), shape["labels"], shape["lengths"])
    every = parts.select(F.explode(F.array(*keys)).alias("key"))
    listed = Cascade.build(rules.select(key), every)
    blocked = Cascade.build(rules.where("verdict = 'block'").select(key), rules.select(key))
    # Columns first, so that each key is built once.
    free = "_" * (1 + max(len(c) for c in pages.columns))
    named = {f"{free}{i}": k for i, k in enumerate(keys)}
    fits = [F.when(listed.member(F.col(n)), F.struct(F.length(n).alias("size"), F.col(n).alias("rule"))) for n in named]
    longest = F.greatest(*fits)["rule"] if len(fits) > 1 else fits[0]["rule"]
    verdict = F.when(F.col("rule").isNull(), F.lit(otherwise)).when(blocked.member(F.col("rule")), F.lit("block")).otherwise(F.lit("allow"))
    return parts.withColumns(named).withColumn("rule", longest).withColumn("verdict", verdict).drop(*named)


def standard_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(RULES), "host string, path string, verdict string")
