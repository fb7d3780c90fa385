"""Mixing to target weights with soft membership.

A decision list, trained on labelled documents, gives every document a probability of
each domain: the most telling feature that a document has decides, with the shares of
the domains among labelled documents that the same feature decides. Every document gets
a rate: how often it is to be used. The rates r >= 0 minimise by projected gradient steps

    sum over domains of (sum over documents of r n p - target)^2

with n the document's tokens and p its probability of the domain. All rates start at 1,
so documents change no more than the targets ask. All domains weigh alike: the traces of an unwanted
domain in all other documents do not thin those out, only documents that are mostly of
it fall to rate 0. Per step only one sum per domain reaches the driver. Everything is DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vaultwright.llm.common import bounded_broadcast, table, text_key, written

DOMAINS = ("good", "poor", "toxic")
# Shares of the tokens asked for: nothing toxic, a little poor text.
TARGETS = {"good": 0.95, "poor": 0.05, "toxic": 0.0}
ONLY_GOOD = {"good": 1.0, "poor": 0.0, "toxic": 0.0}
# A rate this near to a whole number is taken for it when copies are counted out.
NEARLY = 0.1
MOST_BROADCAST_ROWS = 1_000_000


def label_domains(labels: DataFrame) -> DataFrame:
    """``labelled`` (a document id) and ``domain``: toxic, else good or poor by quality.

    Documents with several labels get the worst of them; null labels and ids are left out.
    """
    return (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & F.col("toxic").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
        .select("labelled", F.when(F.col("t") > 0, "toxic").when(F.col("q") > 0, "good").otherwise("poor").alias("domain"))
    )


def _tokens(docs: DataFrame) -> DataFrame:
    """``row``, ``doc_id``, ``text_key``, ``n_tokens`` and the ``features`` of every document.

    Features are the tokens between white space and the last two letters of each, as
    hashes; some may come twice.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    split = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        text_key(text).alias("text_key"), F.array_remove(F.split(text, r"\s+", -1), "").alias("tokens"))
    distinct = split.select(
        "row", "doc_id", "text_key", F.size("tokens").cast("long").alias("n_tokens"), F.array_distinct("tokens").alias("tokens"))
    features = F.concat(
        F.transform("tokens", lambda t: F.xxhash64(t)), F.transform("tokens", lambda t: F.xxhash64(F.right(t, F.lit(2)), F.lit(2))))
    return distinct.select("row", "doc_id", "text_key", "n_tokens", features.alias("features"))


def _telling(tokens: DataFrame, sample: DataFrame, least_g: float, n: Mapping[str, int]) -> DataFrame:
    """The telling features, numbered as ``rule`` by rising gain, and the shares of the domains among their documents.

    A feature tells if the documents that have it are spread over the domains unlike all
    documents, by a G statistic of ``least_g``; its gain is that statistic per document.
    """
    total = max(sum(n.values()), 1)
    seen = tokens.join(F.broadcast(sample), F.col("doc_id") == F.col("labelled")).select(
        "domain", F.explode(F.array_distinct("features")).alias("feature"))
    counts = seen.groupBy("feature").agg(*[F.sum((F.col("domain") == d).cast("long")).alias(d) for d in DOMAINS])
    having = sum((F.col(d) for d in DOMAINS[1:]), F.col(DOMAINS[0]))
    g = 2 * sum((F.when(F.col(d) > 0, F.col(d) * F.log(F.col(d) * total / (max(n[d], 1) * having))).otherwise(0.0) for d in DOMAINS), F.lit(0.0))
    # The features of the sample only, however many documents there are. One number stands for
    # gain and feature: the largest of a document's numbers is found without sorting its features.
    rule = F.row_number().over(Window.orderBy(F.col("g") / having, "feature"))
    return written(counts.withColumn("g", g).filter(F.col("g") >= least_g).select(
        "feature", rule.alias("rule"), *[(F.col(d) / having).alias("share_" + d) for d in DOMAINS]), "telling")


def classify(docs: DataFrame, labels: DataFrame, *, sample: int = 50_000, least_g: float = 30.0, pull: float = 1.0) -> DataFrame:
    """``row``, ``doc_id``, ``text_key``, ``n_tokens`` and the probability of each domain, of every row.

    Trained on at most ``sample`` labelled documents, chosen by hash of the id. The
    shares of a feature are those of the sample's documents that it decides, drawn
    towards those of all its documents as if by ``pull`` more. Without any label all
    domains are equally likely.
    """
    domains = written(label_domains(labels), "label-domains")
    n_labels = domains.count()
    share = min(1 << 20, max(1, sample * (1 << 20) // (n_labels + n_labels // 10 + 1)))
    chosen = written(domains.filter(F.pmod(F.xxhash64("labelled"), F.lit(1 << 20)) < share).limit(sample), "label-sample")
    counted = {r.domain: r.n for r in chosen.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    n = {d: counted.get(d, 0) for d in DOMAINS}
    prior = {d: (n[d] + 1) / (sum(n.values()) + len(DOMAINS)) for d in DOMAINS}
    # Only documents of the sample are cut for the choice of features.
    sampled = docs.join(F.broadcast(chosen.select("labelled")), F.col("doc_id").cast("long") == F.col("labelled"), "left_semi")
    telling = _telling(_tokens(sampled), chosen, least_g, n)
    keys = ["row", "doc_id", "text_key", "n_tokens"]
    each = _tokens(docs).select(*keys, F.explode_outer("features").alias("feature"))
    rules = bounded_broadcast(telling.select("feature", "rule"), telling.count(), MOST_BROADCAST_ROWS)
    # Each row's features are reduced to one before the shuffle.
    ruled = written(
        each.join(rules, "feature", "left").groupBy(*keys).agg(F.coalesce(F.max("rule"), F.lit(0)).alias("rule")), "rules")
    decided = ruled.join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled")).groupBy("rule").agg(
        F.count("*").alias("n"), *[F.sum((F.col("domain") == d).cast("long")).alias("decided_" + d) for d in DOMAINS])
    known = telling.select("rule", *["share_" + d for d in DOMAINS]).union(
        docs.sparkSession.range(1).select(F.lit(0).alias("rule"), *[F.lit(prior[d]).alias("share_" + d) for d in DOMAINS]))
    shares = written(known.join(decided, "rule", "left").select("rule", *[
        ((F.coalesce("decided_" + d, F.lit(0)) + pull * F.col("share_" + d)) / (F.coalesce("n", F.lit(0)) + pull)).alias(d) for d in DOMAINS]), "shares")
    return written(ruled.join(bounded_broadcast(shares, shares.count(), MOST_BROADCAST_ROWS), "rule").drop("rule"), "members")


def fit_rates(members: DataFrame, targets: Mapping[str, float], *, most_steps: int = 200, tolerance: float = 1e-5) -> DataFrame:
    """``members`` (``n_tokens`` and a probability per domain) with its ``rate``.

    ``targets`` are tokens per domain. Each step starts a little ahead of the rates, in
    the direction they moved (Nesterov's rule). Steps end when every domain is within
    ``tolerance`` of its target (of its size, if larger), or, where no rates reach the targets, moves by less
    than three hundredths of that for three steps; after ``most_steps`` without either it is an error. Every eighth step
    the rates are written, so a plan never grows longer than that.
    """
    domains = list(targets)
    n, k = F.col("n_tokens"), len(domains)
    goal = np.array([targets[d] for d in domains], dtype=float)
    present = members.agg(*[F.coalesce(F.sum(n * F.col(d)), F.lit(0.0)) for d in domains]).first()
    size = np.maximum(np.maximum(np.array(present, dtype=float), goal), 1.0)
    # A document moves in inverse proportion to the size of its domains: a rare domain
    # settles in as few steps as a large one. The objective stays as it is.
    pace = sum((F.col(d) * float(v) for d, v in zip(domains[1:], size[1:], strict=True)), F.col(domains[0]) * float(size[0]))
    members = members.withColumns({"pace": F.greatest(pace, F.lit(1.0)), "rate": F.lit(1.0), "ahead": F.lit(1.0)})
    products = members.agg(*[F.coalesce(F.sum(n * F.col(a) * F.col(b) / F.col("pace")), F.lit(0.0)) for a in domains for b in domains]).first()
    # The steepest curvature over all rates: one step of its inverse never overshoots.
    step = 1.0 / max(float(np.linalg.eigvalsh(np.array(products, dtype=float).reshape(k, k))[-1]), 1e-9)
    speed, before, still = 1.0, np.full(k, np.inf), 0
    for done in range(1, most_steps + 1):
        totals = members.agg(*[F.coalesce(F.sum(F.col(c) * n * F.col(d)), F.lit(0.0)) for c in ("rate", "ahead") for d in domains]).first()
        reached, looked_at = np.array(totals[:k], dtype=float), np.array(totals[k:], dtype=float)
        still = still + 1 if (np.abs(reached - before) / size).max() <= 0.03 * tolerance else 0
        if (np.abs(reached - goal) / size).max() <= tolerance or still == 3:
            return written(members.drop("ahead", "pace"), "rates")
        before = reached
        pull = step * (looked_at - goal)
        change = sum((F.col(d) * float(v) for d, v in zip(domains[1:], pull[1:], strict=True)), F.col(domains[0]) * float(pull[0]))
        faster = (1 + (1 + 4 * speed * speed) ** 0.5) / 2
        members = members.withColumn("next", F.greatest(F.col("ahead") - change / F.col("pace"), F.lit(0.0)))
        members = members.withColumn("ahead", F.col("next") + (F.col("next") - F.col("rate")) * ((speed - 1) / faster))
        members = members.withColumn("rate", F.col("next")).drop("next")
        speed = faster
        if done % 8 == 0:
            members = written(members, "rates")
    raise RuntimeError(f"rates still move after {most_steps} steps: {dict(zip(domains, reached, strict=True))} for {dict(targets)}")


def mixing_rates(
    docs: DataFrame, labels: DataFrame, *, targets: Mapping[str, float] = TARGETS, whole: str = "good", sample: int = 50_000,
    tolerance: float = 0.03,
) -> DataFrame:
    """Every row of ``docs`` with its domain probabilities, ``rate`` and ``copies``.

    ``targets`` are shares of the tokens, of all ``DOMAINS``; as many tokens are asked for as
    keep the domain ``whole`` at its present size. Each total comes within ``tolerance`` of its
    target or, if larger, of the present size of its domain: traces in other domains are not chased, which
    would cost documents that are merely in doubt. ``copies`` is the rate where that is within
    ``NEARLY`` of a whole number, else rounded up or down by a hash of the id, so that it equals
    the rate on average.

    Null and empty texts have no tokens and do not weigh on the fit. Null ids are no
    labels' documents; rows of one id round alike; repeated rows each count. Without rows
    the result is empty. Only ``doc_id`` and ``text`` are read.
    """
    if set(targets) != set(DOMAINS) or targets[whole] <= 0:
        raise ValueError(f"targets must name {DOMAINS}, with some of {whole}")
    members = classify(docs, labels, sample=sample)
    present = members.agg(F.coalesce(F.sum(F.col("n_tokens") * F.col(whole)), F.lit(0.0))).first()[0]
    rated = fit_rates(members, {d: present * targets[d] / targets[whole] for d in DOMAINS}, tolerance=tolerance)
    chance = F.pmod(F.xxhash64("doc_id", F.lit("mix")), F.lit(1 << 30)) / float(1 << 30)
    near = F.abs(F.col("rate") - F.round("rate")) <= NEARLY
    drawn = F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("long")
    return rated.withColumn("copies", F.when(near, F.round("rate").cast("long")).otherwise(drawn))


def mixed(docs: DataFrame, labels: DataFrame, *, targets: Mapping[str, float] = TARGETS, whole: str = "good") -> DataFrame:
    """The rows of ``docs`` as often as ``copies`` says, all columns, whatever their names.

    Rows of one id and text have the same copies; null ids and texts are kept apart from others.
    """
    rates = mixing_rates(docs, labels, targets=targets, whole=whole)
    changed = written(rates.filter("copies != 1").select("doc_id", "text_key", "copies").distinct(), "copies")
    rows = docs.select(F.struct("*").alias("row"))
    same = F.col("row.doc_id").cast("long").eqNullSafe(F.col("doc_id")) & (text_key(F.col("row.text")) == F.col("text_key"))
    joined = rows.join(bounded_broadcast(changed, changed.count(), MOST_BROADCAST_ROWS), same, "left")
    times = F.coalesce("copies", F.lit(1)).cast("int")
    return joined.filter(times > 0).select("row", F.explode(F.array_repeat(F.lit(True), times))).select("row.*")


def mixing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = mixing_rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rates.select(
        "doc_id", "n_tokens", *[F.round(d, 6).alias("p_" + d) for d in DOMAINS], F.round("rate", 6).alias("rate"), "copies")
