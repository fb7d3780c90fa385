"""Spans found in texts: running a finder over a table, and the digest of its spans."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultwright.llm.common import tidy

SPAN = "struct<kind:string,start:long,end:long>"
SPANS = f"array<{SPAN}>"
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

Span = tuple[str, int, int]
Finder = Callable[[str], list[Span]]


def arrow_spans(rows: list[list[Span]]) -> pa.Array:
    return pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in spans] for spans in rows], type=_ARROW_SPANS)


def find_spans(docs: DataFrame, finder: Finder) -> DataFrame:
    """``doc_id`` and the ``spans`` of every row's whole text; a null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [finder(text.as_py() or "") for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), arrow_spans(found)], names=["doc_id", "spans"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(tidy(run), f"doc_id long, spans {SPANS}")


def of_kind(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s.kind.isin(*kinds))


def digest(spans: Column) -> Column:
    """The spans as ``kind:start:end``, comma-joined in their order."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)))


def counts(spans: Column, kinds: Sequence[str]) -> dict[str, Column]:
    return {f"n_{kind}": F.size(of_kind(spans, kind)).cast("long") for kind in kinds}
