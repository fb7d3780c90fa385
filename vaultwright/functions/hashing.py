"""Hash keys and hash diffs, as built-in expressions inside code generation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultwright.spec import LINK_STANDARD, STANDARD, HashRule


# An escaped text never holds a single backslash before an N.
NULL_MARK = "\\N"


def _md5(text: Column) -> Column:
    # Upper-case hexadecimal; a third faster than upper(md5(...)).
    return F.hex(F.unhex(F.md5(text)))


def text_of(df: DataFrame, name: str, rule: HashRule) -> Column:
    """The text of a column that enters a hash."""
    column, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return F.replace(F.replace(column, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|")) if rule.escape else column
    if rule.numerics == "fixed":
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            # Values with more decimals, NaN, infinities and values beyond the decimal keep their plain text.
            fixed = column.try_cast("decimal(18,4)")
            return F.when(fixed.cast(kind) == column, fixed.cast("string")).otherwise(column.cast("string"))
        if isinstance(kind, T.TimestampType):
            return F.unix_micros(column).cast("string")
    return column.cast("string")


def _joined(df: DataFrame, columns: Sequence[str], rule: HashRule) -> Column:
    texts = [text_of(df, name, rule) for name in columns]
    if rule.nulls == "mark":
        return F.concat_ws(rule.separator, *[F.coalesce(t, F.lit(NULL_MARK)) for t in texts])
    if rule.nulls == "blank":
        return F.concat_ws(rule.separator, *[F.coalesce(t, F.lit("")) for t in texts])
    if rule.nulls == "skip":
        return F.concat_ws(rule.separator, *texts)
    pieces = [texts[0]]
    for text in texts[1:]:
        pieces += [F.lit(rule.separator), text] if rule.separator else [text]
    return F.concat(*pieces)


def hash_key(name: str) -> Column:
    """Upper-case hexadecimal MD5 of one business key; NULL for a NULL key."""
    return _md5(F.col(name).cast("string"))


def hash_diff(df: DataFrame, columns: Sequence[str], rule: HashRule = STANDARD) -> Column:
    """MD5 over the attributes of a satellite row, in the given order."""
    return _md5(_joined(df, columns, rule))


def link_key(df: DataFrame, columns: Sequence[str], rule: HashRule = LINK_STANDARD) -> Column:
    """MD5 over the business keys of a link, in the given order."""
    return _md5(_joined(df, columns, rule))
