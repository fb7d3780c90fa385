"""Quality by perplexity: an interpolated modified Kneser-Ney model of characters.

The model is trained on trusted documents and counts runs of ``ORDER`` characters. With
c the count of a run (the number of different characters before it, for shorter runs),
D the discount by count (1, 2, 3 and more) and h a run without its last character,

    p(w | h) = max(c(hw) - D(c(hw)), 0) / c(h.) + g(h) p(w | h without its first)
    g(h)     = (D1 N1(h.) + D2 N2(h.) + D3 N3+(h.)) / c(h.)

down to the even chance of every character and one unseen. Runs are counted once over
all documents, each task adding up its own first. Counts, contexts and shorter runs are
tables sharded by run and meet in joins, which give every run of the corpus its log
probability. Documents look their runs up: the most frequent ones, which would be hot
keys of a join, in a table of at most ``head`` runs, all others in a join. A document
is kept if its perplexity is at most the quantile of the trusted ones of its language:
of the quarter of them held out of training, which new texts resemble.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultwright.llm.common import bounded_broadcast, table, text_key, tidy, written

ORDER = 4
BEGIN, ASTRAL = 0x02, 0xFFFF
BLOCK_CHARS = 1 << 20
HELD_OUT = 4
MOST_BROADCAST_ROWS = 2_000_000


def runs_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The run ending at each character, as 16 bits per character, and the text lengths.

    Each text begins after ``ORDER - 1`` marks of its own. Characters beyond 16 bits
    count as one.
    """
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    pad = chr(BEGIN) * (ORDER - 1)
    chars = np.frombuffer((pad + pad.join(texts)).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    chars[chars > ASTRAL] = ASTRAL
    runs = np.zeros(len(chars) - ORDER + 1, dtype=np.uint64)
    for k in range(ORDER):
        runs = (runs << np.uint64(16)) | chars[k : k + len(runs)]
    ends = np.cumsum(lengths + ORDER - 1) - (ORDER - 1)
    own = np.ones(len(runs), dtype=bool)
    for k in range(ORDER - 1):
        at = ends[:-1] + k
        own[at] = False
    return runs[own].view(np.int64), lengths


def _blocks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[str]]]:
    """Texts of a batch in blocks of about ``BLOCK_CHARS`` characters, with the first row's number."""
    first, block, size = 0, [], 0
    for n, text in enumerate(batch.column(column)):
        text = text.as_py() or ""
        if block and size + len(text) > BLOCK_CHARS:
            yield first, block
            first, block, size = n, [], 0
        block.append(text)
        size += len(text)
    if block:
        yield first, block


def _add_up(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    runs, places = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return runs, *(np.bincount(places, weights=np.concatenate([p[i] for p in parts]), minlength=len(runs)).astype(np.int64)
                   for i in (1, 2))


def _count_runs(batches: Iterator[pa.RecordBatch], most: int = 1_500_000) -> Iterator[pa.RecordBatch]:
    """``run``, its count in all and in trusted texts, added up within the task."""
    def out(part):
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in part], names=["run", "n", "n_trusted"])

    parts, held = [], 0
    for batch in batches:
        trusted = np.array(batch.column(1).to_pylist(), dtype=bool)
        for first, texts in _blocks(batch, 0):
            runs, lengths = runs_of(texts)
            weight = np.repeat(trusted[first : first + len(texts)], lengths)
            found, places = np.unique(runs, return_inverse=True)
            parts.append((found, np.bincount(places, minlength=len(found)),
                          np.bincount(places, weights=weight, minlength=len(found))))
            held += len(found)
            if held > most:
                parts = [_add_up(parts)]
                held = len(parts[0][0])
                if held > most // 2:
                    yield out(parts[0])
                    parts, held = [], 0
    if parts:
        yield out(_add_up(parts))


def _shorter(run: Column, characters: int) -> Column:
    """The last ``characters`` of a run."""
    return run.bitwiseAND(F.lit((1 << 16 * characters) - 1))


def _context(run: Column) -> Column:
    return F.shiftrightunsigned(run, 16)


def discounts(counts: DataFrame) -> tuple[float, float, float]:
    """Discounts for counts of 1, 2 and more, from how many runs have counts 1 to 4.

    Where a count is missing, as in a tiny text, the discount of that step is 0.5 below
    the plain one; no discount exceeds its count.
    """
    n = dict.fromkeys(range(1, 5), 0) | {
        r.c: r.n for r in counts.filter("c <= 4").groupBy("c").agg(F.count("*").alias("n")).collect()}
    y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.0
    found = [k - (k + 1) * y * n[k + 1] / n[k] if n[k] and n[k + 1] else k - 0.5 for k in (1, 2, 3)]
    return tuple(min(max(d, 0.0), float(k)) for k, d in zip((1, 2, 3), found, strict=True))


def train(counts: DataFrame) -> tuple[list[DataFrame], list[DataFrame], float]:
    """Per length: probabilities (``run``, ``p``) and contexts (``context``, ``g``); and the chance of an unseen character.

    ``counts`` has ``run`` and ``c`` of the trusted texts, one row per run.
    """
    tables = [counts.select("run", "c")]
    for characters in range(ORDER - 1, 0, -1):
        longer = tables[0]
        tables.insert(0, longer.groupBy(_shorter(F.col("run"), characters).alias("run")).agg(F.count("*").alias("c")))
    probabilities, contexts, unseen = [], [], 1.0
    for n, seen in enumerate(tables, start=1):
        seen = written(seen, "runs")
        d1, d2, d3 = discounts(seen)
        cut = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        context = _context(F.col("run")) if n > 1 else F.lit(0).cast("long")
        g = written(seen.groupBy(context.alias("context")).agg(
            F.sum("c").alias("total"), (F.sum(cut) / F.sum("c")).alias("g")), "contexts")
        joined = seen.withColumn("context", context).join(g, "context")
        own = F.greatest(F.col("c") - cut, F.lit(0.0)) / F.col("total")
        if n == 1:
            first = g.first()
            unseen = (first.g if first else 1.0) / (seen.count() + 1)
            p = joined.select("run", (own + F.lit(unseen)).alias("p"))
        else:
            below = probabilities[-1].select(F.col("run").alias("below"), F.col("p").alias("p_below"))
            p = joined.join(below, _shorter(joined["run"], n - 1) == F.col("below")).select(
                "run", (own + F.col("g") * F.col("p_below")).alias("p"))
        probabilities.append(written(p, "probabilities"))
        contexts.append(g.select("context", "g"))
    return probabilities, contexts, unseen


def log_probabilities(runs: DataFrame, model: tuple[list[DataFrame], list[DataFrame], float]) -> DataFrame:
    """``runs`` (distinct ``run``, other columns stay) with ``logp``, backing off where a run is unseen."""
    probabilities, contexts, unseen = model
    # From the shortest up: what is known of the ending, then of the longer run.
    found = runs.withColumn("p", F.lit(unseen))
    for n in range(1, ORDER + 1):
        seen = probabilities[n - 1].select(F.col("run").alias("seen"), F.col("p").alias("p_seen"))
        part = _shorter(F.col("run"), n) if n < ORDER else F.col("run")
        found = found.withColumn("part", part).join(seen, F.col("part") == F.col("seen"), "left")
        if n > 1:
            g = contexts[n - 1].withColumnRenamed("context", "known")
            found = found.withColumn("context", _context(F.col("part"))).join(g, F.col("context") == F.col("known"), "left")
            backed = F.coalesce("g", F.lit(1.0)) * F.col("p")
        else:
            backed = F.col("p")
        found = found.withColumn("p", F.coalesce("p_seen", backed)).select(*runs.columns, "p")
    return found.withColumn("logp", F.log("p")).drop("p")


def most_frequent(known: DataFrame, head: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs and log probabilities of the most frequent rows of ``known`` (``run``, ``n``, ``logp``), in order of run.

    Counts are cut into 64 levels per doubling, and whole levels are taken from the top as
    long as they hold at most ``head`` runs together. So one row per level and the runs
    taken reach the driver, however many partitions ``known`` has.
    """
    level = F.floor(F.log2("n") * 64)
    sizes = sorted(((r.level, r.runs) for r in known.groupBy(level.alias("level")).agg(F.count("*").alias("runs")).collect()), reverse=True)
    lowest, taken = None, 0
    for at, runs in sizes:
        taken += runs
        if taken > head:
            break
        lowest = at
    if lowest is None:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.float64)
    top = known.filter(level >= lowest).select("run", "logp").toArrow().sort_by("run")
    return top["run"].to_numpy(), top["logp"].to_numpy()


def _score(runs: np.ndarray, logp: np.ndarray, at: int, columns: int):
    """Head log probabilities summed per document, and its other runs with their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums, lengths, others, times = [], [], [], []
            for _, texts in _blocks(batch, at):
                found, sizes = runs_of(texts)
                place = np.minimum(np.searchsorted(runs, found), max(len(runs) - 1, 0))
                hit = runs[place] == found if len(runs) else np.zeros(len(found), dtype=bool)
                ends = np.cumsum(sizes)
                total = np.concatenate([[0.0], np.cumsum(np.where(hit, logp[place] if len(runs) else 0.0, 0.0))])
                sums.extend(total[ends] - total[ends - sizes])
                lengths.extend(sizes)
                missed = np.flatnonzero(~hit)
                cuts = np.searchsorted(missed, np.concatenate([[0], ends]))
                for a, b in zip(cuts, cuts[1:], strict=False):
                    tail, n = np.unique(found[missed[a:b]], return_counts=True)
                    others.append(tail)
                    times.append(n)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:columns], pa.array(lengths, pa.int64()), pa.array(sums, pa.float64()),
                 pa.array(others, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int64()))],
                names=[*batch.schema.names[:columns], "n_tokens", "head", "runs", "times"])

    return run


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents that every label calls good and none toxic."""
    return labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min(F.coalesce("quality", F.lit(0))).alias("q"), F.max(F.coalesce("toxic", F.lit(1))).alias("t")
    ).filter("q = 1 AND t = 0").select("doc_id")


def perplexities(docs: DataFrame, labels: DataFrame, *, quantile: float = 0.995, head: int = 1 << 17) -> DataFrame:
    """Per row: ``doc_id``, ``lang``, ``text_key``, ``n_tokens``, ``perplexity``, ``threshold``, ``keep``.

    ``labels`` has ``doc_id``, ``quality``, ``toxic``; documents it calls good and not
    toxic are trusted. One in ``HELD_OUT``, by hash of the id, is not trained on. The
    threshold of a language is the ``quantile`` of those, of a language without any
    (also of a null one) that of all of them; if there are none at all, there is no
    threshold and every text is kept. Null and
    empty texts have no perplexity and are not kept. Rows stay as they are, repeated or
    not; a null id is never trusted. Other columns are not read.
    """
    trusted = written(trusted_ids(labels), "trusted")
    trusted = bounded_broadcast(trusted, trusted.count(), MOST_BROADCAST_ROWS).withColumnRenamed("doc_id", "good")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    good, held = F.col("good").isNotNull(), F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) == 0
    rows = rows.join(trusted, F.col("doc_id") == F.col("good"), "left").select(
        "doc_id", "lang", (good & held).alias("held_out"), text_key(F.col("text")).alias("text_key"),
        (good & ~held).alias("trusted"), "text")
    counts = written(
        rows.select("text", "trusted").mapInArrow(tidy(_count_runs), "run long, n long, n_trusted long")
        .groupBy("run").agg(F.sum("n").alias("n"), F.sum("n_trusted").alias("c")), "run-counts")
    model = train(counts.filter("c > 0"))
    known = written(log_probabilities(counts.select("run", "n"), model), "log-probabilities")
    scored = written(
        rows.mapInArrow(
            tidy(_score(*most_frequent(known, head), 5, 4)),
            "doc_id long, lang string, held_out boolean, text_key binary, n_tokens long, head double, "
            "runs array<long>, times array<long>",
        ).withColumn("row", F.monotonically_increasing_id()), "scored")
    tail = scored.select("row", F.explode(F.arrays_zip("runs", "times")).alias("t")).select(
        "row", F.col("t.runs").alias("run"), F.col("t.times").alias("times"))
    tails = tail.join(known.select("run", "logp"), "run").groupBy("row").agg(F.sum(F.col("logp") * F.col("times")).alias("tail"))
    n = F.col("n_tokens")
    perplexity = F.when(n > 0, F.exp(-(F.col("head") + F.coalesce("tail", F.lit(0.0))) / n))
    result = written(scored.join(tails, "row", "left").select(
        "doc_id", "lang", "held_out", "text_key", "n_tokens", F.round(perplexity, 6).alias("perplexity")), "perplexities")
    good = result.filter("held_out AND perplexity IS NOT NULL")
    limit = F.percentile_approx("perplexity", quantile, 100_000)
    # Written and counted: else the rows of a language meet in one task before the join.
    by_language = written(good.groupBy(F.col("lang").alias("of")).agg(limit.alias("own")), "limits")
    by_language = bounded_broadcast(by_language, by_language.count(), MOST_BROADCAST_ROWS)
    overall = good.agg(limit.alias("overall"))
    return (
        result.join(F.broadcast(overall)).join(by_language, F.col("lang") == F.col("of"), "left")
        .withColumn("threshold", F.coalesce("own", "overall"))
        .select("doc_id", "lang", "text_key", "n_tokens", "perplexity", "threshold", (
            F.col("perplexity").isNotNull() & (F.col("threshold").isNull() | (F.col("perplexity") <= F.col("threshold")))
        ).alias("keep"))
    )


def quality_filter(docs: DataFrame, labels: DataFrame, *, quantile: float = 0.995, head: int = 1 << 17) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns, whatever their names.

    Equal texts of one language share their fate. Null and empty texts have no perplexity and go;
    a null language is a language of its own; repeated rows stay or go together; without
    labels every text with a word stays. Without rows the result is empty.
    """
    found = perplexities(docs, labels, quantile=quantile, head=head)
    gone = written(
        found.filter(~F.col("keep")).select("text_key", F.col("lang").alias("of")).distinct(), "rejected")
    # The caller's columns travel as one, so none of their names can clash.
    rows = docs.select(F.struct("*").alias("doc"))
    same = (text_key(F.col("doc.text")) == F.col("text_key")) & F.col("doc.lang").cast("string").eqNullSafe(F.col("of"))
    return rows.join(bounded_broadcast(gone, gone.count(), MOST_BROADCAST_ROWS), same, "left_anti").select("doc.*")


def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexities(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("text_key")
