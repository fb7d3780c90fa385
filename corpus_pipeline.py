"""The corpus pipeline: five stages from raw documents to token records.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. All but
the last return the columns of documents. Part of the ``llm`` folder's operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vaultwright.llm.common import Query, table, written
from vaultwright.llm.perplexity import quality_filter
from vaultwright.llm.positional_index import without_contaminated
from vaultwright.llm.simhash import one_of_each
from vaultwright.llm.soft_mixing import ONLY_GOOD, mixed
from vaultwright.llm.token_records import token_records


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity passes for their language."""
    return quality_filter(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: three-word shingles, at most three bits."""
    return one_of_each(docs, words=3, most_bits=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more than a trace of the benchmark."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the fit asks for good tokens only: poor and toxic ones go, none multiplies."""
    return mixed(docs, table(spark, sf_dir, "labels"), targets=ONLY_GOOD)


def binary_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token records, read back: place, length and checksum of each document."""
    import public_tokenizers

    return token_records(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("binary_output", binary_output),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Null and empty texts go in the first; repeated rows are
    copies of each other in the second; no documents give no records; extra columns travel along."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# Perplexity, SimHash, the fitted rates and the tokenizer are beyond SQL.
ORACLE_SQL = None
PIPELINE = Query(run, ORACLE_SQL)
