"""What the joins share: renamed key columns, their equality, and the size check
that stands before every broadcast."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Upper bound of one key column of a row in a broadcast relation: 32 characters,
# row header and hash map entry.
KEY_BYTES = 128
# The same without the text of the key.
ROW_BYTES = 96


def broadcast_limit(df: DataFrame) -> int:
    """Spark's own broadcast threshold in bytes; 0 when broadcasting is off."""
    setting = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    digits = setting.lower().rstrip("b")
    scale = {"k": 2**10, "m": 2**20, "g": 2**30}.get(digits[-1:], 1)
    return max(0, int(digits.rstrip("kmg")) * scale)


def fits_broadcast(df: DataFrame, row_bound: int, on: Sequence[str]) -> bool:
    """Whether the ``on`` columns of at most ``row_bound`` rows stay below it."""
    return row_bound * KEY_BYTES * len(on) <= broadcast_limit(df)


def renamed(df: DataFrame, on: Sequence[str], side: str) -> DataFrame:
    return df.select(*[F.col(c).alias(side + c) for c in on])


def equal(left: str, right: str, on: Sequence[str], null_safe: Sequence[str] = ()) -> Column:
    """Equality of the prefixed columns."""

    def one(name: str) -> Column:
        mine, other = F.col(left + name), F.col(right + name)
        return mine.eqNullSafe(other) if name in null_safe else mine == other

    return reduce(lambda a, b: a & b, map(one, on))


def pack(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """The hexadecimal hash columns as bytes, half as long to shuffle and sort."""
    return df.withColumns({c: F.unhex(c) for c in on})


def unpack(df: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.hex(c) for c in on})
