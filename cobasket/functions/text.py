"""Small text expressions for listings and reports."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def cut(col: str | Column, length: int) -> Column:
    return F.substring(col, 1, length)


def text_or(col: str | Column, default: str) -> Column:
    """The text, or ``default`` when it is missing or empty."""
    col = F.col(col) if isinstance(col, str) else col
    return F.when(col.isNull() | (col == ""), F.lit(default)).otherwise(col)


def number_or(col: str | Column, default: str) -> Column:
    """The number as text, or ``default`` when it is missing or zero."""
    col = F.col(col) if isinstance(col, str) else col
    return F.when(col.isNull() | (col == 0), F.lit(default)).otherwise(col.cast("string"))
