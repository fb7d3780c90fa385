"""Audit columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from vaultwright.functions.audit import load_date, record_source
from vaultwright.spec import LOAD_DATE, RECORD_SOURCE


def with_audit(df: DataFrame, source: str, ts: datetime) -> DataFrame:
    """Add the record source and the load timestamp of the batch."""
    return df.withColumns({RECORD_SOURCE: record_source(source), LOAD_DATE: load_date(ts)})
