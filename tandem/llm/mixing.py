"""Mixing sources to target weights: raking of token weights, then a calibrated sample."""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REST = "*"
DIMENSIONS = ("source", "lang", "topic")


@dataclass(frozen=True)
class Targets:
    """Share of tokens wanted per category; REST is every category that is not named, null among them.

    `budget` is the part of all tokens that the sample should have. The named categories bound the number of cells.
    """

    source: tuple[tuple[str, float], ...]
    lang: tuple[tuple[str, float], ...]
    topic: tuple[tuple[str, float], ...]
    budget: float = 0.5
    seed: int = 17
    rounds: int = 500
    tolerance: float = 1e-9


#: The production mix: named sources alike, the many others together.
STANDARD = Targets(
    source=(*((f"src{i}", 0.06) for i in range(10)), (REST, 0.4)),
    lang=(("en", 0.45), ("de", 0.2), ("fr", 0.2), ("es", 0.13), (REST, 0.02)),
    topic=(("contact", 0.05), ("tabular", 0.05), ("figures", 0.1), ("note", 0.2), ("prose", 0.6)),
)


def topic_of(text: Column) -> Column:
    """A coarse topic from the text's surface: addresses, tables, figures, short or long prose."""
    return (
        F.when(text.isNull(), F.lit("note"))
        .when(F.contains(text, F.lit("@")) | F.contains(text, F.lit("<EMAIL>")), F.lit("contact"))
        .when(F.contains(text, F.lit(" | ")), F.lit("tabular"))
        .when(text.rlike("[0-9]"), F.lit("figures"))
        .when(F.length(text) < 1000, F.lit("note"))
        .otherwise(F.lit("prose"))
    )


def token_weight(text: Column) -> Column:
    """Words of the whole text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def folded(column: Column, named: tuple[tuple[str, float], ...]) -> Column:
    names = [n for n, _ in named if n != REST]
    return F.when(column.isin(names), column).otherwise(F.lit(REST))


def rake(tokens: np.ndarray, targets: list[np.ndarray], rounds: int, tolerance: float) -> np.ndarray:
    """Iterative proportional fitting: the table of shares nearest to `tokens` whose margins are the targets.

    Targets of categories without tokens are spread over the others. Cells without tokens stay 0; if these make the targets
    contradict each other, the rounds end at the last fit.
    """
    total = tokens.sum()
    if not total:
        return tokens.astype(float)
    shares = tokens / total
    margins = []
    for axis, target in enumerate(targets):
        present = tokens.sum(axis=tuple(a for a in range(tokens.ndim) if a != axis)) > 0
        wanted = np.where(present, target, 0.0)
        margins.append(wanted / wanted.sum() if wanted.sum() else present / present.sum())
    for _ in range(rounds):
        worst = 0.0
        for axis, wanted in enumerate(margins):
            own = shares.sum(axis=tuple(a for a in range(tokens.ndim) if a != axis))
            worst = max(worst, float(np.abs(own - wanted).max()))
            factor = np.divide(wanted, own, out=np.zeros_like(own), where=own > 0)
            shares = shares * factor.reshape([-1 if a == axis else 1 for a in range(tokens.ndim)])
        if worst < tolerance:
            break
    return shares


def calibrate(tokens: np.ndarray, shares: np.ndarray, budget: float) -> tuple[np.ndarray, np.ndarray]:
    """Probability and weight per cell. Probabilities follow share over tokens, none above 1, and keep `budget` of the
    tokens as far as cells with a target allow; a cell that would need more than 1 carries the rest as its weight, so
    weighted tokens keep the raked shares. Shares below 1e-12 are what is left of contradicting targets, and none."""
    shares = np.where(shares < 1e-12, 0.0, shares)
    ratio = np.divide(shares, tokens, out=np.zeros_like(shares), where=tokens > 0)
    low, high = 0.0, 1.0 / ratio[ratio > 0].min() if (ratio > 0).any() else 0.0
    wanted = min(budget * tokens.sum(), tokens[ratio > 0].sum())
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if (tokens * np.minimum(1.0, middle * ratio)).sum() < wanted else (low, middle)
    chance = np.minimum(1.0, high * ratio)
    return chance, np.divide(high * ratio, chance, out=np.zeros_like(chance), where=chance > 0)


def mix(docs: DataFrame, targets: Targets = STANDARD, id: str = "doc_id", text: str = "text", prefix: str = "") -> DataFrame:
    """The sampled rows of `docs` with `topic`, `n_tokens`, `probability` and `weight` (named with `prefix`), which take
    the place of columns of these names.

    A row is in the sample if a hash of its id and the seed lies below its cell's probability; rows with equal ids, also
    null ones, are kept or left together. Rows without words have no tokens to weigh: they follow their cell like others.
    Only the sums of the cells, whose number the targets bound, reach the driver.
    """
    spark = docs.sparkSession
    names = dict(zip(("topic", "n_tokens", "probability", "weight"), (f"{prefix}{x}" for x in ("topic", "n_tokens", "probability", "weight")), strict=True))
    cell = {f"_{d}": folded(topic_of(F.col(text)) if d == "topic" else F.col(d), getattr(targets, d)) for d in DIMENSIONS}
    sums = docs.select(*(c.alias(n) for n, c in cell.items()), token_weight(F.col(text)).alias("_n")).groupBy(*cell).agg(F.sum("_n").alias("_n")).collect()
    labels = [[n for n, _ in getattr(targets, d)] + [REST] * (REST not in dict(getattr(targets, d))) for d in DIMENSIONS]
    tokens = np.zeros([len(x) for x in labels])
    for row in sums:
        tokens[tuple(x.index(row[f"_{d}"]) for d, x in zip(DIMENSIONS, labels, strict=True))] = row["_n"]
    wanted = [np.array([dict(getattr(targets, d)).get(n, 0.0) for n in x]) for d, x in zip(DIMENSIONS, labels, strict=True)]
    chance, weight = calibrate(tokens, rake(tokens, wanted, targets.rounds, targets.tolerance), targets.budget)
    rows = [(*key, float(chance[at]), float(weight[at])) for at, key in zip(itertools.product(*(range(len(x)) for x in labels)), itertools.product(*labels), strict=True)]
    table = spark.createDataFrame(rows, ", ".join([*(f"{n} string" for n in cell), "_chance double", "_weight double"]))
    mixed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.col(id).alias("_id"), F.col(text).alias("_text"), *(c.alias(n) for n, c in cell.items()))
    even = F.pmod(F.xxhash64(F.col("_id"), F.lit(targets.seed)), F.lit(1 << 52)) / float(1 << 52)
    kept = mixed.join(F.broadcast(table), list(cell)).where(even < F.col("_chance"))
    added = {"topic": topic_of(F.col("_text")), "n_tokens": token_weight(F.col("_text")), "probability": F.col("_chance"), "weight": F.col("_weight")}
    carried = [c for c in docs.columns if c not in names.values()]
    return kept.select(*(F.col("_row").getField(c).alias(c) for c in carried), *(v.alias(names[n]) for n, v in added.items()))
