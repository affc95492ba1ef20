"""Quality rules whose limits follow each language and source."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.llm.words import WordHashes, covered, small, split_words, text_bytes, window_hashes
from tandem.workspace import settle

SYMBOLS = b"#*$%&|<>"
NO_LETTER = bytes([32, *range(9, 14), *range(0x80, 0xC0)])  # white space and UTF-8 continuation bytes
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Limits:
    """Fixed rules, then the shape of the adaptive ones: a document is an outlier of a measure when it lies more than
    `reach` times the distance from median to 90th percentile beyond the latter, and at least `slack` beyond it."""

    min_words: int = 10
    max_repeat_percent: int = 20
    accuracy: float = 0.01
    smallest: float = 1e-4
    min_group: int = 200
    reach: float = 4.0
    slack: tuple[tuple[str, float], ...] = (("symbols", 0.05), ("dup_lines", 0.35), ("repeats", 0.15), ("long_words", 4.0), ("short_words", 0.35))


def measures(limits: Limits) -> dict[str, Column]:
    """Name to value, null where the document has nothing to measure. Large is suspect in each."""
    words, chars = F.col("n_words"), F.col("word_chars")
    of = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b))
    return {
        "symbols": of("n_symbols", "word_chars"),
        "dup_lines": of("n_dup_lines", "n_lines"),
        "repeats": of("n_repeat_words", "n_words"),
        "long_words": F.when(words > 0, chars / words),
        "short_words": F.when(chars > 0, words / chars),
    }


def text_counts(docs: DataFrame, keep: tuple[str, ...], text: str = "text", row: str | None = None) -> DataFrame:
    """Counts of every whole text beside the columns `keep`; the text is a field of the kept column `row`, if given."""
    kinds = list(docs.select(*keep).schema)

    def count(batches):
        hashes = WordHashes()
        for batch in small(batches):
            texts = batch.column("_text").to_pylist() if row is None else [(x or "").encode() for x in batch.column(row).field(text).to_pylist()]
            found = [counts_of(x, hashes) for x in texts]
            columns = [batch.column(n) for n in keep] + [pa.array(c, pa.int64()) for c in (zip(*found, strict=True) if found else [[]] * len(COUNTS))]
            yield pa.RecordBatch.from_arrays(columns, [*keep, *COUNTS])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds), *(f"{n} bigint" for n in COUNTS)])
    return docs.select(*keep, *([text_bytes(text).alias("_text")] if row is None else [])).mapInArrow(count, schema)


def counts_of(text: bytes, hashes: WordHashes) -> tuple[int, ...]:
    words = split_words(text)
    lines = [x for x in text.split(b"\n") if x.strip()]
    windows = window_hashes(hashes.of(words), 5)
    repeated = 0
    if len(windows):
        _, where, count = np.unique(windows, return_inverse=True, return_counts=True)
        if len(count) < len(windows):
            repeated = int(covered(np.flatnonzero(count[where] > 1), 5, len(words)).sum())
    return (
        len(words),
        len(text.translate(None, NO_LETTER)),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated,
    )


def sketches(counts: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Quantile sketch of each measure per language and source: how many values fall into each logarithmic cell.

    Cells are ``ceil(log(value) / log(gamma))``; a value is known to the relative `accuracy`. Sketches merge by adding
    their counts, so the map side combines them, and those of a language or of all documents are sums over these.
    """
    width = F.lit(float(np.log((1 + limits.accuracy) / (1 - limits.accuracy))))
    named = [F.struct(F.lit(n).alias("measure"), v.alias("value")) for n, v in measures(limits).items()]
    cells = counts.select("lang", "source", F.inline(F.array(*named))).where("value is not null")
    cell = F.ceil(F.log(F.greatest("value", F.lit(limits.smallest))) / width).cast("int")
    return cells.groupBy("lang", "source", "measure", cell.alias("cell")).agg(F.count("*").alias("n"))


def fences(sketch: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Upper limit per language, source and measure, one row per language and source; from the language's or the
    whole corpus' merged sketch where a group has fewer than `min_group` documents."""
    gamma = (1 + limits.accuracy) / (1 - limits.accuracy)
    value = lambda q: F.pow(F.lit(gamma), q) * (2 / (1 + gamma))

    def limit(keys: list[str], name: str) -> DataFrame:
        """Median and 90th percentile of merged cells; the order of cells is bounded by the sketch's size."""
        merged = sketch.groupBy(*keys, "measure", "cell").agg(F.sum("n").alias("n"))
        ordered = merged.groupBy(*keys, "measure").agg(F.array_sort(F.collect_list(F.struct("cell", "n"))).alias("cells"), F.sum("n").alias("size"))

        def quantile(share: float) -> Column:
            step = F.aggregate(
                "cells",
                F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("int").alias("cell")),
                lambda a, x: F.struct(
                    (a["seen"] + x["n"]).alias("seen"),
                    F.when(a["cell"].isNull() & (a["seen"] + x["n"] >= F.ceil(F.col("size") * share)), x["cell"]).otherwise(a["cell"]).alias("cell"),
                ),
            )
            return value(step["cell"])

        middle, high = quantile(0.5), quantile(0.9)
        return ordered.select(*keys, "measure", "size", (high + limits.reach * (high - middle)).alias(name), high.alias(f"{name}_high"))

    own, tongue, every = limit(["lang", "source"], "own"), limit(["lang"], "tongue"), limit([], "every")
    same = lambda a, b, names: [a[n].eqNullSafe(b[n]) for n in names]
    joined = own.alias("o").join(F.broadcast(every.select(F.col("measure").alias("m"), "every", "every_high")), F.col("m") == own["measure"])
    joined = joined.join(tongue.withColumnRenamed("size", "tongue_size"), same(own, tongue, ["lang", "measure"]), "left").select(
        "o.lang", "o.source", "o.measure", "own", "own_high", "tongue", "tongue_high", "every", "every_high", "o.size", "tongue_size"
    )
    slack = F.create_map(*(F.lit(x) for pair in limits.slack for x in pair))
    pick = lambda s: F.when(F.col("size") >= limits.min_group, F.col(f"own{s}")).when(F.col("tongue_size") >= limits.min_group, F.col(f"tongue{s}")).otherwise(F.col(f"every{s}"))
    fence = F.greatest(pick(""), pick("_high") + slack[F.col("measure")])
    wide = joined.select("lang", "source", "measure", fence.alias("fence"))
    return wide.groupBy("lang", "source").agg(*(F.max(F.when(F.col("measure") == n, F.col("fence"))).alias(f"max_{n}") for n in measures(limits)))


def judge(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), limits: Limits = Limits()) -> DataFrame:
    """Counts, `base_failed` and `kept` of each document, beside the columns `keep`.

    `docs` has `lang`, `source`, `text` and the columns to keep. Null text counts as empty and fails for want of words.
    Null languages and sources form groups of their own. Repeated rows are judged one by one; an empty table gives an
    empty one.
    """
    counted = settle(text_counts(docs, tuple(dict.fromkeys([*keep, "lang", "source"]))), "quality")
    return _verdicts(counted, settle(fences(sketches(counted, limits), limits), "fences"), limits).select(*keep, *COUNTS, "base_failed", "kept")


def reject(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The documents that `judge` keeps, with all their columns. Texts are counted twice, so none has to be stored or
    shuffled for the limits, which are a small table."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    limit = settle(fences(sketches(text_counts(docs, ("lang", "source")), limits), limits), "fences")
    counted = text_counts(docs.select(row, "lang", "source"), ("_row", "lang", "source"), row="_row")
    kept = _verdicts(counted, limit, limits).where("kept")
    return kept.select(*(F.col("_row").getField(c).alias(c) for c in docs.columns))


def _verdicts(counted: DataFrame, limit: DataFrame, limits: Limits) -> DataFrame:
    limit = limit.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    outlier = F.lit(False)
    for name, value in measures(limits).items():
        outlier = outlier | F.coalesce(value > F.col(f"max_{name}"), F.lit(False))
    joined = counted.join(limit, counted["lang"].eqNullSafe(limit["_lang"]) & counted["source"].eqNullSafe(limit["_source"]), "left")
    failed = (F.col("n_words") < limits.min_words) | (100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words"))
    return joined.withColumns({"base_failed": failed, "kept": ~failed & ~outlier})
