"""Audit values. They are arguments of the batch, never read from the clock, so
that every table of a batch and every retry of it carries the same ones."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def record_source(source: str) -> Column:
    return F.lit(source.upper())


def load_date(ts: datetime) -> Column:
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")
