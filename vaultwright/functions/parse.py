"""Date and time parsing that yields NULL for bad text, also in ANSI mode, and does
not depend on the session's time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats of the source files: yyyy-MM-dd and HH:mm:ss.
DATE = r"\d{4}-\d{2}-\d{2}"
TIME = r"\d{2}:\d{2}:\d{2}"


def parse_date(text: Column) -> Column:
    return F.when(text.rlike(f"^{DATE}$"), text.try_cast("date"))


def parse_datetime(date: Column, time: Column) -> Column:
    """Date text and time text as one zone-free timestamp; NULL if either is bad."""
    text = F.concat(date, F.lit(" "), time)
    return F.when(text.rlike(f"^{DATE} {TIME}$"), text.try_cast("timestamp_ntz"))
