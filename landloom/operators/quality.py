"""Text reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def filter_noise(lines: DataFrame, text: str, patterns: list[str]) -> DataFrame:
    """Drops log lines that match one of the patterns from their start on."""
    alternation = "|".join(f"(?:{p})" for p in patterns)
    return lines.filter(~F.col(text).rlike(f"^(?:{alternation})"))
