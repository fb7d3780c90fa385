"""Ranked lexical search by norm buckets.

A document is a vector of impacts over the terms of the items, an item a vector of term
weights; the score is their product. Document vectors are ordered by length and cut into
buckets. A bucket whose longest vector cannot reach an item's threshold is skipped
(Cauchy-Schwarz); inside a bucket a document's strongest coordinates have to lie where the
threshold is within reach, and bound what the others can add; what survives is
scored exactly in integers. The thresholds come from the longest vectors first, and rise
within each task from bucket to bucket.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vaultwright.llm.common import ascii_lower, table, tidy, written

# Fixed values of the contract: what separates terms.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# Items are looked up in blocks of about this many terms: what a worker holds of them.
BLOCK_TERMS = 1_000_000
BUCKET_ROWS = 4096
FOCUS = 4
# Float bounds are widened by this share, so rounding never prunes what integers keep.
SLACK = 1e-9


@dataclass(frozen=True)
class Queries:
    """Item vectors: numbers of the items, and of each its terms with their weights, strongest first."""

    items: list[int]
    terms: list[np.ndarray]
    weights: list[np.ndarray]
    norms: np.ndarray

    @staticmethod
    def of(vectors: dict[int, dict[int, int]]) -> Queries:
        items, terms, weights = [], [], []
        for item, vector in sorted(vectors.items()):
            pairs = sorted(((w, t) for t, w in vector.items() if w > 0), reverse=True)
            if pairs:
                items.append(item)
                terms.append(np.array([t for _, t in pairs], dtype=np.int64))
                weights.append(np.array([w for w, _ in pairs], dtype=np.int64))
        return Queries(items, terms, weights, np.array([math.sqrt(float((w * w).sum())) for w in weights]))


class Best:
    """The best ``k`` (score, id) of each item met so far, and the score the next has to reach."""

    def __init__(self, reach: np.ndarray, k: int) -> None:
        self.k, self.reach = k, reach.copy()
        self.rows: list[list[tuple[int, bool, int]]] = [[] for _ in reach]

    def add(self, q: int, scores: np.ndarray, ids: list) -> None:
        rows = self.rows[q] + [(-int(s), i is None, i or 0) for s, i in zip(scores, ids, strict=True)]
        rows.sort()
        self.rows[q] = rows[: self.k]
        if len(rows) >= self.k:
            self.reach[q] = max(self.reach[q], -rows[self.k - 1][0])


def search_bucket(
    ids: list, norms: np.ndarray, rows: np.ndarray, terms: np.ndarray, impacts: np.ndarray, queries: Queries, best: Best, focus: int = FOCUS
) -> int:
    """Add the bucket's documents that reach ``best``; returns how many were scored exactly.

    ``rows``, ``terms``, ``impacts`` are the coordinates of the bucket's vectors.
    """
    order = np.argsort(terms, kind="stable")
    rows, impacts = rows[order], impacts[order]
    present, starts = np.unique(terms[order], return_index=True)
    at = {int(t): slice(a, b) for t, a, b in zip(present, starts, [*starts[1:], len(order)], strict=True)}
    longest, scored = float(norms.max()), 0
    safe = np.maximum(norms, 1e-300)
    for q, norm in enumerate(queries.norms):
        reach = max(float(best.reach[q]), 1.0)
        if norm * longest * (1 + SLACK) < reach:
            continue
        q_terms, q_weights = queries.terms[q], queries.weights[q]
        cosine = min(1.0, reach / (norm * longest) * (1 - SLACK))
        alive = np.ones(len(norms), dtype=bool)
        partial, seen, met = np.zeros(len(norms)), 0.0, np.zeros(len(norms))
        for term, weight in zip(q_terms[:focus].tolist(), q_weights[:focus].tolist(), strict=True):
            share, value = weight / norm, np.zeros(len(norms))
            if term in at:
                value[rows[at[term]]] = impacts[at[term]] / safe[rows[at[term]]]
            # Where a coordinate has to lie for the cosine to be within reach.
            spread = math.sqrt(max(0.0, (1 - cosine * cosine) * (1 - share * share)))
            highest = 1.0 if share >= cosine else share * cosine + spread
            alive &= (value >= share * cosine - spread - 1e-6) & (value <= highest + 1e-6)
            partial += share * value
            seen += share * share
            met += value * value
        rest = np.sqrt(max(0.0, 1 - seen) * np.maximum(0.0, 1 - met))
        alive &= (partial + rest + 1e-6) * norms * norm >= reach
        if not alive.any():
            continue
        scored += int(alive.sum())
        score = np.zeros(len(norms), dtype=np.int64)
        for term, weight in zip(q_terms.tolist(), q_weights.tolist(), strict=True):
            if term in at:
                held = rows[at[term]]
                kept = alive[held]
                score[held[kept]] += weight * impacts[at[term]][kept]
        found = np.flatnonzero(score >= reach)
        if len(found):
            best.add(q, score[found], [ids[i] for i in found.tolist()])
    return scored


def _search(vectors: DataFrame, queries: Queries, reach: np.ndarray, k: int, bucket_rows: int) -> DataFrame:
    """``item``, ``doc_id``, ``score``: the best of each task over its buckets."""
    ordered = vectors.repartitionByRange(F.col("norm").desc(), "row").sortWithinPartitions(F.col("norm").desc())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(reach, k)
        for batch in batches:
            for start in range(0, batch.num_rows, bucket_rows):
                part = batch.slice(start, bucket_rows)
                sizes = np.array([len(x) for x in part.column(2)], dtype=np.int64)
                if not sizes.sum():
                    continue
                search_bucket(
                    part.column(0).to_pylist(), part.column(1).to_numpy(zero_copy_only=False),
                    np.repeat(np.arange(part.num_rows), sizes),
                    part.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int64),
                    part.column(3).flatten().to_numpy(zero_copy_only=False), queries, best)
        found = [(queries.items[q], None if no_id else i, -s) for q, rows in enumerate(best.rows) for s, no_id, i in rows]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[c] for r in found], pa.int64()) for c in range(3)], names=["item", "doc_id", "score"])

    return ordered.select("doc_id", "norm", "terms", "impacts").mapInArrow(tidy(run), "item long, doc_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    place = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)


def _count_terms(docs: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """``row``, ``doc_id``, ``n`` (its terms), and number and occurrences of its terms that are in the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, terms, tfs = [], [], []
            for text in batch.column(2):
                found = _TERM.findall((text.as_py() or "").translate(_LOWER))
                held = Counter(filter(None, map(vocabulary.get, found)))
                n.append(len(found))
                terms.append(list(held))
                tfs.append(list(held.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                 pa.array(tfs, pa.list_(pa.int64()))], names=["row", "doc_id", "n", "terms", "tfs"])

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(tidy(run), "row long, doc_id long, n long, terms array<int>, tfs array<long>")


def _block(docs: DataFrame, items: dict[int, list[str]], k: int, bucket_rows: int) -> DataFrame:
    # Terms are numbered from 1: 0 would look like a term that is not there.
    vocabulary = {term: number for number, term in enumerate(sorted({t for terms in items.values() for t in terms}), 1)}
    counted = written(_count_terms(docs, vocabulary), "term-counts")
    n_docs, total = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    # At most one row a term of the block.
    df = {r.term: r.df for r in counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()}
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    queries = Queries.of({
        item: {vocabulary[t]: weight[vocabulary[t]] for t in terms if vocabulary[t] in weight} for item, terms in items.items()})
    m = F.expr(f"50L + (50L * n * {n_docs}L) div {max(total, 1)}L")
    impacts = F.transform("tfs", lambda tf: F.call_function("div", F.lit(1_000_000_000).cast("long") * tf, F.lit(1000).cast("long") * tf + F.lit(20).cast("long") * F.col("m")))
    vectors = counted.filter(F.size("terms") > 0).withColumn("m", m).select("row", "doc_id", "terms", impacts.alias("impacts"))
    norm = F.sqrt(F.aggregate("impacts", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    vectors = vectors.withColumn("norm", norm)
    n_vectors = counted.filter(F.size("terms") > 0).count()
    if not n_vectors or not queries.items:
        return counted.sparkSession.createDataFrame([], "item long, doc_id long, score long")
    # The longest vectors set the thresholds: one in a hundred, a bucket at least.
    share = min(1.0, max(0.01, bucket_rows / n_vectors))
    cut = vectors.approxQuantile("norm", [1 - share], 0.001)[0] if share < 1 else -1.0
    nothing = np.zeros(len(queries.items))
    first = written(_ranked(_search(vectors.filter(F.col("norm") >= cut), queries, nothing, k, bucket_rows), k), "longest")
    if share == 1:
        return first.select("item", "doc_id", "score")
    reached = {r.item: r.score for r in first.filter(F.col("rank") == k).select("item", "score").collect()}
    reach = np.array([float(reached.get(item, 0)) for item in queries.items])
    others = _search(vectors.filter(F.col("norm") < cut), queries, reach, k, bucket_rows)
    return first.select("item", "doc_id", "score").union(others)


def ranked_search(
    docs: DataFrame, items: DataFrame, *, k: int = 50, block_terms: int = BLOCK_TERMS, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: the ``k`` best documents of each item with a score above 0.

    All documents are searched and count for the weights. Null and empty texts have no
    terms: such items find nothing, such documents are not found. Equal scores go by
    ascending ``doc_id``, nulls last; repeated rows rank each; each row of ``items`` is an
    item of its own, also without id. Extra columns are not read. Items are
    searched in blocks of about ``block_terms`` terms, each a pass over the documents; an item
    is never split, so one item's terms have to fit a worker.
    """
    spark = docs.sparkSession
    terms = F.array_distinct(F.array_remove(F.split(ascii_lower(F.coalesce(F.col("text").cast("string"), F.lit(""))), SEPARATORS, -1), ""))
    listed = written(items.select(
        F.monotonically_increasing_id().alias("item"), F.col("item_id").alias("item_id"), terms.alias("terms")), "items")
    n_terms = listed.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-n_terms // block_terms))
    found = spark.createDataFrame([], "item long, doc_id long, score long")
    for block in range(n_blocks):
        own = listed.filter(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == block)
        vectors = {r.item: r.terms for r in own.select("item", "terms").collect()}
        if any(vectors.values()):
            found = found.union(written(_block(docs, vectors, k, bucket_rows), "found"))
    return _ranked(found, k).join(listed.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def search_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _terms_sql(name: str, key: str) -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    pattern = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"
    return f"SELECT row_number() OVER () AS r, {key}, regexp_extract_all({lower}, {pattern}) AS t FROM {name}"


SEARCH_SQL = f"""
WITH d AS ({_terms_sql('documents', 'doc_id')}),
     i AS ({_terms_sql('benchmark', 'item_id')}),
     it AS (SELECT DISTINCT r AS item, item_id, unnest(t) AS term FROM i),
     size AS (SELECT count(*) AS big_n, sum(len(t)) AS big_l FROM d WHERE len(t) > 0),
     tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM it) GROUP BY r, term),
     w AS (SELECT term, CAST(floor(1000 * ln((2 * big_n + 2) / CAST(2 * df + 1 AS double))) AS bigint) AS w
           FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), size),
     m AS (SELECT r, doc_id, 50 + CAST((50 * len(t) * big_n) // big_l AS bigint) AS m FROM d, size WHERE len(t) > 0),
     s AS (SELECT item, item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS bigint) AS score
           FROM it JOIN tf USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY item, item_id, r, doc_id)
SELECT item_id, CAST(rank AS integer) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
WHERE rank <= 50
"""
