"""Registry of queries, and what their definitions share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from vaultwright.spec import Batch

QueryFunction = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: QueryFunction
    sql: str


QUERIES: dict[str, Query] = {}


def query(sql: str) -> Callable[[QueryFunction], QueryFunction]:
    """Register a query under its function name, with the SQL of the same result."""

    def register(run: QueryFunction) -> QueryFunction:
        QUERIES[run.__name__] = Query(run, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


FIRST = Batch("2024-01-01", datetime(2024, 1, 1))
SECOND = Batch("2024-01-02", datetime(2024, 1, 2))
THIRD = Batch("2024-01-03", datetime(2024, 1, 3))


# SQL counterparts of the column functions.


def sql_hk(expression: str) -> str:
    return f"upper(md5(cast({expression} as varchar)))"


def sql_joined(*expressions: str, sep: str = "||") -> str:
    """NULL-passing concatenation."""
    return f" || '{sep}' || ".join(f"cast({e} as varchar)" for e in expressions)


def sql_escaped(expression: str) -> str:
    return f"replace(replace(cast({expression} as varchar), '\\', '\\\\'), '|', '\\|')"


def sql_marked(*expressions: str) -> str:
    """Concatenation of escaped texts with a mark for NULL."""
    return " || '||' || ".join(f"coalesce({sql_escaped(e)}, '\\N')" for e in expressions)


def sql_fixed(expression: str) -> str:
    return f"cast({expression} as decimal(18,4))"


def sql_audit(source: str, batch: Batch = FIRST) -> str:
    return f"'{source}' AS RECORD_SOURCE, TIMESTAMP '{batch.ts}' AS LOAD_DATE"
