"""Batch translation with a user-supplied model."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.functions.text import SPACE, WORD, token_count
from tandem.settings import Rules

Translate = Callable[[list[str]], list[str]]


def truncate_tokens(text: Column, limit: int) -> Column:
    """The text up to its `limit`-th token; shorter texts are unchanged."""
    # Possessive quantifiers: a token is never given back, so the scan stays linear.
    head = F.regexp_extract(text, f"^{SPACE}*+(?:{WORD}+{SPACE}*+){{0,{limit}}}", 0)
    return F.when(token_count(text) <= limit, text).otherwise(F.regexp_replace(head, f"{SPACE}+$", ""))


def batch_translate(prompts: DataFrame, load_model: Callable[[], Translate], rules: Rules = Rules(), batch: int = 64) -> DataFrame:
    """Adds translated, error and latency_ms to rows with a `prompt`.

    `load_model` runs once per task and returns `translate(list[str]) -> list[str]`. When a batch fails, its
    prompts are tried one by one, so only the failing rows carry the error text; a null prompt is an error of its own row.
    Latency is the mean over what was translated together. Prompts are cut only where `rules.prompt_tokens` says so.
    """

    def attempt(translate: Translate, texts: list[str]) -> list[tuple[str, str | None, float]]:
        began = time.perf_counter()
        try:
            outputs = [text.strip() for text in translate(texts)]
            if len(outputs) != len(texts):
                raise ValueError(f"{len(outputs)} translations for {len(texts)} prompts")
        except Exception as failure:
            if len(texts) > 1:
                return [row for text in texts for row in attempt(translate, [text])]
            return [("", f"Error: {failure}", round((time.perf_counter() - began) * 1000, 2))]
        each = round((time.perf_counter() - began) * 1000 / len(texts), 2)
        return [(output, None, each) for output in outputs]

    def run(prompts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        translate = load_model()
        for series in prompts:
            rows = [("", "Error: no prompt", 0.0)] * len(series)
            given = [i for i, text in enumerate(series) if text is not None]
            for first in range(0, len(given), batch):
                part = given[first : first + batch]
                for i, row in zip(part, attempt(translate, [series.iloc[i] for i in part]), strict=True):
                    rows[i] = row
            yield pd.DataFrame(rows, columns=["translated", "error", "latency_ms"])

    udf = F.pandas_udf(run, "translated string, error string, latency_ms double")
    limit = rules.prompt_tokens
    cut = prompts if limit is None else prompts.withColumn("prompt", truncate_tokens(F.col("prompt"), limit))
    return cut.withColumn("_result", udf("prompt")).select(*prompts.columns, "_result.*")
