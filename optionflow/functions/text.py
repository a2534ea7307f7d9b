"""Numbers in text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

NUMBER = r"(?i)^[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?$|^[+-]?(inf|infinity|nan)$"


def number(text: Column) -> Column:
    """A decimal number, or null. Suffixes of a type (`2f`, `1.0d`) make no number."""
    return F.when(text.rlike(NUMBER), text.try_cast("double"))
