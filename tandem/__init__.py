"""Tandem: parallel-text corpora prepared, checked and measured on Spark."""

from tandem.settings import Rules

__all__ = ["Rules"]
