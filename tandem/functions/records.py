"""Instruction records, prompts, report scores and messages as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tandem.settings import DIRECTIONS, DOMAINS

# Languages and wording of the task sentence, which models are trained on.
_LANGUAGES = {"en_to_es": ("English", "Spanish"), "es_to_en": ("Spanish", "English")}


def instruction(domain: Column, direction: Column) -> Column:
    """Task sentence of a record; every direction but en_to_es reads Spanish to English."""
    source, target = _LANGUAGES["en_to_es"]
    forward = F.concat(F.lit("Translate the following "), domain, F.lit(f" sentence from {source} to {target}."))
    backward = F.concat(F.lit("Translate the following "), domain, F.lit(f" sentence from {target} to {source}."))
    return F.when(direction == "en_to_es", forward).otherwise(backward)


def to_instruction(en: Column, es: Column, domain: Column, direction: Column) -> Column:
    """One directed record as a struct of the five string fields."""
    forward = direction == "en_to_es"
    return F.struct(
        instruction(domain, direction).alias("instruction"),
        F.when(forward, en).otherwise(es).alias("input"),
        F.when(forward, es).otherwise(en).alias("output"),
        domain.alias("domain"),
        direction.alias("direction"),
    )


def render_prompt(instruction: Column, text: Column, output: Column | None = None) -> Column:
    """Training text; without an output, the inference prompt that ends at the response header."""
    parts = [F.lit("### Instruction:\n"), instruction, F.lit("\n\n### Input:\n"), text, F.lit("\n\n### Response:\n")]
    return F.concat(*parts, *([output] if output is not None else []))


def default_fields(unknown: str = "unknown") -> dict[str, Column]:
    """Missing group fields become `unknown`, missing texts the empty string."""
    return {
        **{name: F.coalesce(F.col(name), F.lit(unknown)) for name in ("domain", "direction")},
        **{name: F.coalesce(F.col(name), F.lit("")) for name in ("input", "output")},
    }


def pair_key(en: Column, es: Column) -> Column:
    return F.concat(en, es)


def mirror_key(left: Column, right: Column) -> Column:
    """The same for a record and for its opposite direction."""
    return F.struct(F.least(left, right).alias("a"), F.greatest(left, right).alias("b"))


def is_empty(text: Column) -> Column:
    """True for missing, null and '', not for whitespace."""
    return F.coalesce(text, F.lit("")) == ""


def known_domain(domain: Column) -> Column:
    return F.coalesce(domain, F.lit("")).isin(*DOMAINS)


def known_direction(direction: Column) -> Column:
    return F.coalesce(direction, F.lit("")).isin(*DIRECTIONS)


def rel_deviation(value: Column, overall: Column) -> Column:
    """(value - overall) / overall at 3 digits, 0 where overall is 0; ties round to even."""
    return F.when(overall == 0, F.lit(0.0)).otherwise(F.bround((value - overall) / overall, 3))


def abs_len_deviation(value: Column, overall: Column) -> Column:
    return F.bround(F.abs(value - overall) / F.greatest(overall, F.lit(1.0)), 3)


def over_under(deviation: Column) -> Column:
    return F.when(deviation > 0, "OVER").otherwise("UNDER")


def bias_status(deviation: Column, threshold: float) -> Column:
    percent = F.format_string("%.1f", F.abs(deviation) * 100)
    biased = F.concat(F.lit("BIASED ("), over_under(deviation), F.lit(" by "), percent, F.lit("%)"))
    return F.when(F.abs(deviation) > threshold, biased).otherwise("OK")


# Report wording per anomaly count, in report order.
ANOMALY_MESSAGES = (
    ("too_long", "Sentences too long"),
    ("too_short", "Sentences too short"),
    ("invalid_domains", "Invalid domains"),
    ("invalid_directions", "Invalid directions"),
    ("null_inputs", "Null inputs"),
    ("null_outputs", "Null outputs"),
)


def anomaly_messages() -> Column:
    """Texts for the categories that occur, in report order, from the anomaly count columns."""
    texts = [
        F.when(F.col(name) > 0, F.format_string(f"{label}: %d records", F.col(name)))
        for name, label in ANOMALY_MESSAGES
    ]
    return F.array_compact(F.array(*texts))


def latency_ms(start: Column, end: Column) -> Column:
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return F.bround(micros / 1000, 2)


def _lookup(key: Column, table: dict[str, str], default: str) -> Column:
    pairs = reduce(lambda acc, item: [*acc, F.lit(item[0]), F.lit(item[1])], table.items(), [])
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))


def direction_from_langs(source: Column, target: Column) -> Column:
    """Direction code of a language pair; any other pair counts as en_to_es."""
    return _lookup(
        F.concat_ws("-", source, target),
        {"english-spanish": "en_to_es", "spanish-english": "es_to_en"},
        "en_to_es",
    )


def locale_of(language: Column) -> Column:
    return _lookup(language, {"english": "en-US", "spanish": "es-ES"}, "en-US")


def content_hash(seed: int) -> Column:
    """Seeded order key of a record's content."""
    fields = default_fields()
    return F.md5(F.concat_ws("|", F.lit(str(seed)), fields["direction"], fields["input"], fields["output"]))
