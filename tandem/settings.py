"""Thresholds of the corpus rules, in one place."""

from __future__ import annotations

from dataclasses import dataclass

# Enumerations and field names of the record format.
DOMAINS = ("medical", "legal")
DIRECTIONS = ("en_to_es", "es_to_en")
RECORD_FIELDS = ("instruction", "input", "output", "domain", "direction")
SLICES = ("medical", "legal", "en_to_es", "es_to_en", "short_sents", "long_sents")
LENGTH_SLICES = ("short_sents", "long_sents")
STAT_METRICS = (
    "avg_input_len",
    "avg_output_len",
    "avg_length_ratio",
    "input_diversity",
    "output_diversity",
    "avg_word_overlap",
)
# Fixed values: (left slice, right slice, metric, largest accepted gap, label, metric wording, right wording).
GAP_RULES = (
    ("medical", "legal", "avg_length_ratio", 0.1, "Domain", "medical length_ratio", "legal"),
    ("en_to_es", "es_to_en", "output_diversity", 0.05, "Directional", "en_to_es diversity", "es_to_en"),
    ("short_sents", "long_sents", "avg_word_overlap", 0.05, "Length", "short_sents overlap", "long_sents"),
)


@dataclass(frozen=True)
class Rules:
    """Limits; the defaults are fixed values, with which every report is published."""

    min_tokens: int = 3
    max_tokens: int = 200
    max_ratio: float = 2.5
    short_max: int = 15
    mid_max: int = 30
    seed: int = 42
    ratios: tuple[float, float, float] = (0.8, 0.1, 0.1)
    anomaly_drop_threshold: int = 1000
    min_train_records: int = 10_000
    bias_threshold: float = 0.20
    # A learned schema allows values with this share, and lengths between these quantiles.
    schema_share: float = 0.05
    schema_quantiles: tuple[float, float] = (0.01, 0.99)
    # Heads judge only the first so many records of a slice; None judges all.
    eval_head: int | None = None
    eval_slice_head: int | None = None
    bleu_threshold: float = 0.0
    slice_cap: float = 0.50
    length_slice_cap: float = 2.0
    sensitivity_head: int | None = None
    sensitivity_bounds: tuple[int, int] = (10, 25)
    train_head: int | None = None
    val_head: int | None = None
    window_tokens: int = 128
    prompt_tokens: int | None = None
    version: str = "v2_approved"
