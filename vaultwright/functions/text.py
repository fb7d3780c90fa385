"""Text cleansing expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_text(column: Column) -> Column:
    """Upper case without surrounding ASCII spaces."""
    return F.trim(F.upper(column))


def blank_marker(column: Column, marker: str = "\\N") -> Column:
    """The empty text where the whole value is the null marker."""
    return F.when(column == marker, "").otherwise(column)
