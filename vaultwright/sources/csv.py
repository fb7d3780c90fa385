"""Raw CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The raw text of a line that does not fit the schema; NULL for all others.
RAW_LINE = "__RAW_LINE"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    sep: str = ",",
    encoding: str = "UTF-8",
    null_marker: str = "\\N",
    multi_line: bool = False,
    report: bool = False,
) -> DataFrame:
    """A CSV file with a header line, bound to an explicit schema by name and order.

    A header that does not match the schema fails the read. Quoted texts may hold the
    separator, quotes (doubled) and, with ``multi_line``, line breaks; such files are not
    split over tasks.

    Cells are read as text and then cast. An empty cell and the ``null_marker`` are NULL
    in a column that is no text. Any other cell that does not fit its type becomes NULL.
    With ``report`` the column ``RAW_LINE`` holds the line of such a cell, or of a
    number of cells unlike the header's; without it such lines look like any other.
    """
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    read = (
        spark.read.schema(T.StructType([*texts.fields, T.StructField(RAW_LINE, T.StringType())]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RAW_LINE)
        .option("columnPruning", False)
        .csv(path)
    )
    typed, unfit = [], F.lit(False)
    for field in schema.fields:
        text = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            typed.append(text)
            # Never true; Spark does not read the raw line without any other column.
            unfit = unfit | (F.length(text) < 0)
            continue
        given = F.when(~text.isin("", null_marker), F.trim(text))
        value = given.try_cast(field.dataType)
        unfit = unfit | (given.isNotNull() & value.isNull())
        typed.append(value.alias(field.name))
    if not report:
        return read.select(*typed)
    line = F.to_csv(F.struct(*[F.coalesce(F.col(f.name), F.lit("")).alias(f.name) for f in schema.fields]), {
        "sep": sep, "quote": '"', "escape": '"', "emptyValue": "",
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    return read.select(*typed, F.coalesce(RAW_LINE, F.when(unfit, line)).alias(RAW_LINE))


# Compressed files are not split over tasks: none has more rows than this.
FILE_ROWS = 1_000_000


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of gzip CSV files, each with the header line."""
    write = df.write.mode("overwrite").option("header", True).option("escape", '"')
    write.option("compression", "gzip").option("maxRecordsPerFile", FILE_ROWS).csv(path)
