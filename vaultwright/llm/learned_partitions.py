"""Approximate nearest neighbours by learned partitions.

On a bounded sample a graph of nearest neighbours is cut into parts of equal size with
few cut edges. A small network learns to tell the part of a vector from the vector
itself. It then places every row in its most probable part and sends every query to
several, where all rows are compared with it exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vaultwright.llm.common import table, tidy, written


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the rows that are fitted on, the blocks bound what one task holds.

    13 probes of 16 parts find over 0.95 of the true neighbours among vectors that lie
    all around a 64-dimensional sphere, the hardest case; clustered ones need fewer.
    Parts come from repeated halving, so their number is a power of two.
    """

    sample: int = 8192
    parts: int = 16
    probes: int = 13
    neighbours: int = 30
    hidden: int = 64
    epochs: int = 15
    block_rows: int = 16_384
    block_queries: int = 2_048

    def __post_init__(self) -> None:
        if self.parts < 1 or self.parts & (self.parts - 1):
            raise ValueError(f"parts must be a power of two, not {self.parts}")


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Row numbers of the ``k`` nearest other rows of each row."""
    norms, found = (x * x).sum(1), np.empty((len(x), k), dtype=np.int64)
    for at in range(0, len(x), 512):
        d = norms[at : at + 512, None] + norms - 2 * (x[at : at + 512] @ x.T)
        d[np.arange(len(d)), np.arange(at, at + len(d))] = np.inf
        found[at : at + 512] = np.argpartition(d, k - 1, axis=1)[:, :k]
    return found


def balanced_parts(graph: np.ndarray, parts: int, seed: int = 0) -> np.ndarray:
    """A part for each node: equal sizes within 10 %, few neighbours in other parts.

    Halves are split at the median of a vector smoothed along the edges, again and
    again; then nodes move to the part of most of their neighbours while it has room.
    """
    n, k = graph.shape
    rng = np.random.default_rng(seed)
    src, dst = np.repeat(np.arange(n), k), graph.ravel()
    src, dst = np.concatenate([src, dst]), np.concatenate([dst, src])
    label, groups = np.zeros(n, dtype=np.int64), 1
    while groups < parts:
        inside = label[src] == label[dst]
        s, d = src[inside], dst[inside]
        degree = np.bincount(s, minlength=n) + 1
        value, size = rng.standard_normal(n), np.bincount(label, minlength=groups)
        for _ in range(60):
            value = (value + np.bincount(s, weights=value[d], minlength=n)) / degree
            value -= (np.bincount(label, weights=value, minlength=groups) / size)[label]
            value /= np.sqrt(np.bincount(label, weights=value * value, minlength=groups) / size + 1e-30)[label]
        order = np.lexsort((value, label))
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.arange(n)
        rank -= np.concatenate([[0], np.cumsum(size)[:-1]])[label]
        label = 2 * label + (rank >= size[label] / 2)
        groups *= 2
    room, size = int(1.1 * n / groups) + 1, np.bincount(label, minlength=groups)
    for _ in range(8):
        votes = np.zeros((n, groups))
        np.add.at(votes, (src, label[dst]), 1)
        best, moved = votes.argmax(1), 0
        for node in np.flatnonzero(votes[np.arange(n), best] > votes[np.arange(n), label]):
            if size[best[node]] < room:
                size[label[node]] -= 1
                size[best[node]] += 1
                label[node] = best[node]
                moved += 1
        if not moved:
            break
    return label


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


@dataclass
class Router:
    """One hidden layer, softmax over the parts; ``coarse`` if fitted on a graph with fewer neighbours."""

    mean: np.ndarray
    scale: float
    weights: list[np.ndarray]
    coarse: bool = False

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return softmax(np.maximum((x - self.mean) / self.scale @ w1 + b1, 0) @ w2 + b2)

    @classmethod
    def fit(cls, x: np.ndarray, target: np.ndarray, settings: Settings, seed: int = 0) -> Router:
        """``target`` has a row of part probabilities for each row of ``x``."""
        rng = np.random.default_rng(seed)
        mean, scale = x.mean(0), float(x.std()) or 1.0
        parts = target.shape[1]
        shapes = [(x.shape[1], settings.hidden), (settings.hidden,), (settings.hidden, parts), (parts,)]
        w = [rng.standard_normal(s) * (2 / s[0]) ** 0.5 if len(s) == 2 else np.zeros(s) for s in shapes]
        first, second, step = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes], 0
        z = (x - mean) / scale
        for _ in range(settings.epochs):
            for batch in np.array_split(rng.permutation(len(x)), max(1, len(x) // 128)):
                h = np.maximum(z[batch] @ w[0] + w[1], 0)
                error = (softmax(h @ w[2] + w[3]) - target[batch]) / len(batch)
                back = (error @ w[2].T) * (h > 0)
                gradient = [z[batch].T @ back, back.sum(0), h.T @ error, error.sum(0)]
                step += 1
                for i, g in enumerate(gradient):
                    first[i] = 0.9 * first[i] + 0.1 * g
                    second[i] = 0.999 * second[i] + 0.001 * g * g
                    rate = 2e-3 * (1 - 0.999**step) ** 0.5 / (1 - 0.9**step)
                    w[i] = w[i] - rate * first[i] / (np.sqrt(second[i]) + 1e-8)
        return cls(mean, scale, w)


def fit_router(vectors: DataFrame, n: int, settings: Settings) -> Router | None:
    """A router from a sample of at most ``settings.sample`` rows, chosen by hash of the id.

    A small sample is cut into the same parts, from a graph with fewer neighbours: a
    quarter of a part at most; its queries are sent to one part more. None, that is one part for all, only where that is not one,
    below four different vectors a part.
    """
    share = min(1 << 20, max(1, settings.sample * (1 << 20) // (n + n // 10 + 1)))
    sample = vectors.filter(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < share).limit(settings.sample)
    x = np.array([row.vector for row in sample.select("vector").collect()], dtype=np.float64)
    x = np.unique(x, axis=0) if len(x) else x
    parts = settings.parts
    neighbours = min(settings.neighbours, len(x) // (4 * parts))
    if not neighbours:
        return None
    graph = neighbour_graph(x, neighbours)
    label = np.eye(parts)[balanced_parts(graph, parts)]
    # A query needs the parts of its neighbours, so those count besides its own.
    router = Router.fit(x, 0.3 * label + 0.7 * label[graph].mean(1), settings)
    router.coarse = neighbours < settings.neighbours
    return router


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``vector`` (doubles) of the rows that take part.

    Vectors that are null, empty or zero, or hold null, NaN or infinity, do not; nor do
    those of another length than most.
    """
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    v = v.filter(F.col("vector").isNotNull() & (F.size("vector") > 0)).filter(~bad & F.exists("vector", lambda c: c != 0))
    usual = v.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    return v.filter(F.size("vector") == (usual.d if usual else 0))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    array = column.combine_chunks()
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks) if array.num_chunks else pa.array([], array.type)
    return array.flatten().to_numpy(zero_copy_only=False).reshape(len(array), -1) if len(array) else np.empty((0, 0))


def _placed(vectors: DataFrame, router: Router | None, probes: int) -> DataFrame:
    """Every row with its ``part`` and, as a query, the ``probed`` parts, most probable first."""

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            if router is None:
                best = np.zeros((len(batch), 1), dtype=np.int32)
            else:
                p = router.probabilities(_matrix(pa.chunked_array([batch.column(1)])))
                best = np.argsort(-p, axis=1, kind="stable")[:, :probes].astype(np.int32)
            offsets = pa.array(np.arange(len(batch) + 1, dtype=np.int32) * best.shape[1])
            probed = pa.ListArray.from_arrays(offsets, pa.array(best.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(best[:, 0]), probed], names=["vec_id", "vector", "part", "probed"])

    return vectors.mapInArrow(tidy(run), "vec_id long, vector array<double>, part int, probed array<int>")


def nearest_in_block(queries: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    """Exact ``k`` nearest rows of each query within one block, ties to the smaller id."""
    out: list[tuple] = []
    if len(queries) and len(rows):
        q, x = _matrix(queries["vector"]), _matrix(rows["vector"])
        q_row, x_row = queries["row"].to_numpy(), rows["row"].to_numpy()
        ids = pc.fill_null(rows["vec_id"], np.iinfo(np.int64).max).to_numpy()
        q_norm, x_norm = (q * q).sum(1), (x * x).sum(1)
        for at in range(0, len(q), 64):
            # A quick distance chooses with a margin for its rounding, the exact one decides.
            near = q_norm[at : at + 64, None] + x_norm - 2 * (q[at : at + 64] @ x.T)
            for i, d in enumerate(near, start=at):
                d = np.where(x_row == q_row[i], np.inf, d)
                limit = np.partition(d, min(k, len(d)) - 1)[min(k, len(d)) - 1]
                margin = 1e-9 * (q_norm[i] + x_norm.max())
                some = np.flatnonzero((d <= limit + margin) & (x_row != q_row[i]))
                exact = np.sqrt(((x[some] - q[i]) ** 2).sum(1))
                for j in np.lexsort((x_row[some], ids[some], exact))[:k]:
                    out.append((int(q_row[i]), int(x_row[some[j]]), int(ids[some[j]]), float(exact[j])))
    columns = list(zip(*out, strict=True)) or [[]] * 4
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["query_row", "row", "id", "score"])


def _search(queries: DataFrame, rows: DataFrame, k: int, settings: Settings) -> DataFrame:
    """The ``k`` best of the probed parts for each query: ``queries`` has one row per probe."""
    n_rows = {r.part: r.n for r in rows.groupBy("part").agg(F.count("*").alias("n")).collect()}
    n_queries = {r.part: r.n for r in queries.groupBy("part").agg(F.count("*").alias("n")).collect()}
    parts = sorted(n_rows)
    if not parts:
        return rows.sparkSession.createDataFrame([], "query_row long, row long, id long, score double, rank int")
    blocks = rows.sparkSession.createDataFrame(
        [(p, -(-n_rows[p] // settings.block_rows), -(-n_queries.get(p, 0) // settings.block_queries)) for p in parts],
        "part int, row_blocks int, query_blocks int")
    blocks = F.broadcast(blocks)  # one row per part
    own = lambda n: F.pmod(F.xxhash64("row"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt_rows = rows.join(blocks, "part").filter("query_blocks > 0").select(
        F.lit(False).alias("asks"), "part", own("row_blocks").alias("r"), every("query_blocks").alias("q"), "row", "vec_id", "vector")
    dealt_queries = queries.join(blocks, "part").select(
        F.lit(True).alias("asks"), "part", every("row_blocks").alias("r"), own("query_blocks").alias("q"), "row",
        F.lit(None).cast("long").alias("vec_id"), "vector")

    def run(block: pa.Table) -> pa.Table:
        asks = block["asks"]
        return nearest_in_block(block.filter(asks), block.filter(pc.invert(asks)), k)

    found = dealt_queries.union(dealt_rows).groupBy("part", "r", "q").applyInArrow(
        run, "query_row long, row long, id long, score double")
    best = Window.partitionBy("query_row").orderBy("score", "id", "row")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def nearest_neighbours(vectors: DataFrame, is_query, *, k: int = 10, settings: Settings = Settings()) -> DataFrame:  # noqa: B008
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` (Euclidean) of the rows where ``is_query``.

    ``vectors`` has ``vec_id`` and ``embedding``. Every usable row is indexed and may be
    found; a query never finds its own row, but may find another row of its id. Queries
    whose parts hold fewer than ``k`` others are searched in all parts. Ids may repeat;
    null ids come last among ties and are reported as null. An empty table gives no rows.
    """
    clean = usable(vectors)
    n = clean.count()
    router = fit_router(clean, n, settings)
    placed = _placed(clean, router, settings.probes + bool(router and router.coarse)).withColumn("row", F.monotonically_increasing_id())
    rows = written(placed, "learned-partitions")
    queries = rows.filter(is_query)
    found = written(
        _search(queries.select(F.explode("probed").alias("part"), "row", "vector"),
                rows.select("part", "row", "vec_id", "vector"), k, settings), "nearest")
    short = written(
        queries.join(found.groupBy("query_row").agg(F.count("*").alias("n")), queries.row == F.col("query_row"), "left")
        .filter(F.coalesce("n", F.lit(0)) < min(k, n - 1)).select("row", "vector"), "short-queries")
    if short.count():
        everywhere = F.explode(F.array(*[F.lit(p) for p in range(settings.parts)]))
        again = _search(short.select(everywhere.alias("part"), "row", "vector"),
                        rows.select("part", "row", "vec_id", "vector"), k, settings)
        found = found.join(short.select(F.col("row").alias("query_row")), "query_row", "left_anti").unionByName(again)
    ids = queries.select(F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"))
    missing = F.col("id") == np.iinfo(np.int64).max
    return found.join(ids, "query_row").select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.when(~missing, F.col("id")).alias("vec_id"), "score")


def nearest_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
