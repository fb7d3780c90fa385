"""The operators over whole corpora against brute force on small tables."""

from __future__ import annotations

import hashlib
import math
import os
import random
import re
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from fixtures import documents, odd_rows, words  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from vaultwright.llm import components, fixity, learned_partitions, perplexity, positional_index, simhash, soft_mixing, suffix_levels  # noqa: E402
from vaultwright.llm.queries import QUERIES  # noqa: E402

LABELS = "doc_id long, quality int, toxic int, row long"


def labels(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], LABELS)


# Components


def test_components_of_a_path_a_star_and_loops(spark):
    edges = [(n, n + 1) for n in range(0, 40)] + [(100, n) for n in range(101, 160)] + [(200, 200), (300, 301), (301, 300)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.root for r in components.component_roots(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: 0 for n in range(41)} | {n: 100 for n in range(100, 160)} | {300: 300, 301: 300}
    assert components.component_roots(spark.createDataFrame([], "a long, b long")).count() == 0


# Fixity


def test_audit_finds_every_damaged_record_and_no_other(spark):
    rng = random.Random(2)
    offsets = sorted(rng.sample(range(3_000_000), 700))
    a = {o: (10, f"h{o}") for o in offsets}
    b = dict(a)
    changes = {}
    for n, o in enumerate(rng.sample(offsets, 40)):
        kind = ("missing", "altered", "resized")[n % 3]
        changes[o] = kind
        if kind == "missing":
            del b[o]
        else:
            b[o] = (10 if kind == "altered" else 9, "other")
    extra = max(offsets) + 900_000
    b[extra], changes[extra] = (5, "new"), "extra"
    frame = lambda d: spark.createDataFrame([(o, *v, 1) for o, v in d.items()], "offset long, n_bytes long, hash string, node int")
    got = {r.offset: r.status for r in fixity.audit(frame(a), frame(b), range_bytes=4096).collect()}
    assert got == changes
    assert fixity.audit(frame(a), frame(a)).count() == 0
    empty = spark.createDataFrame([], "offset long, n_bytes long, hash string, node int")
    assert fixity.audit(empty, empty).count() == 0
    assert {r.status for r in fixity.audit(frame(a), empty).collect()} == {"missing"}


def test_offsets_follow_the_order_of_pages(spark):
    rows = [(3, "u", "abc"), (1, None, "é"), (None, "x", None), (3, "u", "abc"), (2, "", "")]
    pages = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, hash int").repartition(3)
    got = sorted(fixity.replicas(pages).select("page_id", "offset", "n_bytes", "hash").collect(), key=lambda r: r.offset)
    assert [r.page_id for r in got] == [None, 1, 2, 3, 3]
    at = 0
    for r in got:
        url, html = next(((u or "", h or "") for p, u, h in rows if p == r.page_id))
        name = "" if r.page_id is None else r.page_id
        record = (f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: {name}\r\nWARC-Target-URI: {url}\r\n"
                  f"Content-Length: {len(html.encode())}\r\n\r\n{html}\r\n\r\n").encode()
        assert (r.offset, r.n_bytes, r.hash) == (at, len(record), hashlib.sha256(b"leaf:" + record).hexdigest())
        at += len(record)


# Decontamination


def tokens(text):
    return [t for t in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if t]


def contaminated(rows, items, window):
    out = []
    for doc_id, text, *_ in rows:
        doc, hit, ids = tokens(text), set(), set()
        for item_id, item in items:
            item = tokens(item)
            n = min(len(item), window)
            for b in range(len(item) - n + 1 if n else 0):
                for p in range(len(doc) - n + 1):
                    if doc[p : p + n] == item[b : b + n]:
                        hit.update(range(p, p + n))
                        ids.add(item_id)
        ids = sorted(str(i) for i in ids if i is not None)
        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
        out.append((doc_id, len(doc), len(hit), len(ids), digest, bool(hit) and 20 * len(hit) >= len(doc)))
    return sorted(out, key=repr)


def test_contamination(spark):
    rng = random.Random(7)
    items = [(n, words(rng, rng.choice([1, 3, 5, 9, 14]), 6)) for n in range(9)] + [(9, None), (10, ""), (None, "w1 w2 w3"), (3, "w4 w4 w4 w4 w4")]
    rows = [(n, words(rng, 40, 6)) for n in range(25)] + odd_rows()[12:-1]
    rows += [(90, f"{words(rng, 30)}! {items[2][1].upper()}?"), (91, items[4][1])]
    frame = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, row int").repartition(2)
    docs = documents(spark, rows)
    got = positional_index.contamination(docs, frame, window=5).drop("text_key").collect()
    want = contaminated(rows, items, 5)
    assert sorted((tuple(r) for r in got), key=repr) == want
    kept = positional_index.without_contaminated(docs, frame, window=5)
    assert kept.columns == docs.columns and kept.count() == sum(not w[5] for w in want)
    none = spark.createDataFrame([], "item_id long, text string")
    assert positional_index.contamination(docs, none).filter("n_hit > 0").count() == 0
    assert positional_index.contamination(documents(spark, []), frame).count() == 0


def test_proximity(spark):
    rows = [(1, "a b c d e f g"), (2, "c x x a x b"), (3, "c x x x x x x x a b"), (4, "a"), (5, None)]
    items = spark.createDataFrame([(1, "a b c"), (2, "a")], "item_id long, text string")
    index, parts = positional_index.build_index(documents(spark, rows)), positional_index.item_words(items)
    found = positional_index.proximity_matches(index, parts, 5).join(positional_index.documents_of(index), "row")
    found = found.join(parts.select("item", "item_id").distinct(), "item")
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(1, "1"), (2, "1"), (1, "2"), (2, "2"), (3, "2"), (4, "2")}


# Perplexity


def plain_model(texts):
    c = {4: Counter()}
    for text in texts:
        padded = "\x02" * 3 + text
        c[4].update(padded[k : k + 4] for k in range(len(text)))
    for n in (3, 2, 1):
        c[n] = Counter(g[1:] for g in c[n + 1])
    total, cut, rest = {}, {}, {}
    for n in c:
        times = Counter(c[n].values())
        y = times[1] / (times[1] + 2 * times[2]) if times[1] else 0
        cut[n] = [0.0] + [min(max(k - (k + 1) * y * times[k + 1] / times[k] if times[k] and times[k + 1] else k - 0.5, 0.0), k) for k in (1, 2, 3)]
        total[n], rest[n] = defaultdict(int), defaultdict(float)
        for g, v in c[n].items():
            total[n][g[:-1]] += v
            rest[n][g[:-1]] += cut[n][min(v, 3)]

    def p(g):
        n, h = len(g), g[:-1]
        if not n:
            return 1 / (len(c[1]) + 1)
        if h not in total[n]:
            return p(g[1:])
        v = c[n][g]
        return (max(v - cut[n][min(v, 3)], 0) + rest[n][h] * p(g[1:])) / total[n][h]

    return lambda text: math.exp(-sum(math.log(p(("\x02" * 3 + text)[k : k + 4])) for k in range(len(text))) / len(text))


@pytest.mark.parametrize("head", [0, 50, 1 << 17])
def test_perplexity(spark, head):
    rng = random.Random(8)
    rows = [(n, words(rng, rng.randrange(1, 40)), ("en", "de", None)[n % 3]) for n in range(60)] + [r[:2] for r in odd_rows()[12:-1]]
    marks = [(n, n % 5 != 0, 0) for n in range(50)] + [(7, 0, 0), (8, 1, 1), (None, 1, 0), (9, None, 0)]
    marks = [(i, None if q is None else int(q), t) for i, q, t in marks]
    good = {i for i, q, t in marks if q == 1 and t == 0 and i is not None} - {i for i, q, t in marks if not q or t}
    held = {r[0] for r in spark.range(100).filter(f"pmod(xxhash64(id), {perplexity.HELD_OUT}) = 0").collect()}
    docs = documents(spark, rows)
    got = perplexity.perplexities(docs, labels(spark, marks), quantile=0.9, head=head).collect()
    score = plain_model([r[1] for r in rows if r[0] in good - held and r[1]])
    seen = {(r.doc_id, r.n_tokens): r.perplexity for r in got}
    assert len(got) == len(rows)
    for doc_id, text, *_ in rows:
        want = score(text) if text else None
        assert seen[doc_id, len(text or "")] == (want if want is None else pytest.approx(want, rel=1e-6))
    limits = {r.lang: r.threshold for r in got}
    for lang in ("en", "de"):
        own = sorted(score(r[1]) for r in rows if r[0] in good & held and r[1] and (r[2] if len(r) > 2 else "en") == lang)
        assert limits[lang] == pytest.approx(own[math.ceil(0.9 * len(own)) - 1], rel=1e-6)
    assert all(r.keep == (r.perplexity is not None and r.perplexity <= r.threshold) for r in got)
    kept = perplexity.quality_filter(docs, labels(spark, marks), quantile=0.9, head=head)
    assert kept.columns == docs.columns and kept.count() == sum(r.keep for r in got)


def sent_to_driver(spark, group):
    """Bytes that the tasks of a job group returned."""
    sc, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    stages = {s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds}
    return sum(sc._jsc.sc().statusStore().lastStageAttempt(s).resultSize() for s in stages)


@pytest.mark.parametrize("head", [0, 1, 3_000, 1 << 17])
def test_the_driver_gets_the_most_frequent_runs_only(spark, head):
    rows = {n * 7919 % 60_000 - 30_000: (60_000 // (1 + n % 6_000), -n / 3.0) for n in range(60_000)}
    known = spark.range(0, 60_000, 1, 64).selectExpr(
        "id * 7919 % 60000 - 30000 AS run", "60000 div (1 + id % 6000) AS n", "-CAST(id AS double) / 3 AS logp")
    spark.sparkContext.setJobGroup(f"head-{head}", "")
    runs, logp = perplexity.most_frequent(known, head)
    spark.sparkContext.setJobGroup("", "")
    assert runs.tolist() == sorted(set(runs.tolist())) and logp.tolist() == [rows[r][1] for r in runs.tolist()]
    assert 0.9 * min(head, 60_000) <= len(runs) <= head or head == 1 and not len(runs)
    rest = max((rows[r][0] for r in rows.keys() - set(runs.tolist())), default=0)
    assert all(rows[r][0] > rest for r in runs.tolist())
    # Not the first ``head`` of each partition: these are 3.1 MB where 3,000 are asked for.
    assert head > 3_000 or sent_to_driver(spark, f"head-{head}") < 1_000_000


def test_perplexity_without_labels_or_documents(spark):
    docs, none = documents(spark, odd_rows()[:-1]), labels(spark, [])
    assert perplexity.quality_filter(docs, none).count() == sum(bool(r[1]) for r in odd_rows()[:-1])
    assert perplexity.quality_filter(documents(spark, []), none).count() == 0


# Mixing


def test_rates_reach_the_targets(spark):
    rng = np.random.default_rng(9)
    p = rng.dirichlet([0.3, 0.3, 0.3], 400)
    n = rng.integers(1, 500, 400)
    rows = [(int(k), *map(float, q)) for k, q in zip(n, p, strict=True)]
    members = spark.createDataFrame(rows, "n_tokens long, good double, poor double, toxic double")
    present = (p * n[:, None]).sum(0)
    goal = present.sum() * np.array([0.7, 0.25, 0.05])
    got = soft_mixing.fit_rates(members, dict(zip(soft_mixing.DOMAINS, map(float, goal), strict=True))).collect()
    reached = sum(np.array([r.good, r.poor, r.toxic]) * r.n_tokens * r.rate for r in got)
    assert np.abs(reached - goal).max() <= 1e-4 * goal.sum() and min(r.rate for r in got) >= 0
    # The same steps in plain numpy.
    rate = np.ones(len(n))
    size = np.maximum(present, goal)
    pace = p @ size
    step = 1 / np.linalg.eigvalsh((p.T * (n / pace)) @ p)[-1]
    ahead, speed = rate.copy(), 1.0
    while (np.abs((p * (n * rate)[:, None]).sum(0) - goal) / size).max() > 1e-5:
        new = np.maximum(ahead - p @ (step * ((p * (n * ahead)[:, None]).sum(0) - goal)) / pace, 0)
        faster = (1 + (1 + 4 * speed * speed) ** 0.5) / 2
        rate, ahead, speed = new, new + (new - rate) * (speed - 1) / faster, faster
    assert np.allclose(sorted(r.rate for r in got), sorted(rate), atol=1e-6)


def test_mixing_learns_the_domains(spark):
    rng = random.Random(10)
    rows, marks, truth = [], [], {}
    for n in range(600):
        kind = ("good", "good", "poor", "toxic")[n % 4]
        text = words(rng, 30, 300)
        text = text.replace(" ", "!! ") if kind == "poor" else f"{text} vile" if kind == "toxic" else text
        rows.append((n, text))
        truth[n] = kind
        if n < 400:
            marks.append((n, int(kind != "poor"), int(kind == "toxic")))
    docs = documents(spark, rows + [(700, None), (701, ""), (None, "vile"), (5, rows[5][1])])
    marks += [(None, 1, 0), (3, None, 1)]
    got = soft_mixing.mixing_rates(docs, labels(spark, marks)).collect()
    assert len(got) == 604
    best = {r.doc_id: max(soft_mixing.DOMAINS, key=lambda d: r[d]) for r in got if r.doc_id is not None}
    assert sum(best[n] == truth[n] for n in range(400, 600)) >= 195
    mixed = soft_mixing.mixed(docs, labels(spark, marks))
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in got)
    clean = {n for n in range(600) if truth[n] == "good"}
    assert len(clean & {r.doc_id for r in mixed.collect()}) >= 0.97 * len(clean)
    assert soft_mixing.mixed(documents(spark, []), labels(spark, marks)).count() == 0
    assert soft_mixing.mixed(docs, labels(spark, [])).columns == docs.columns


@pytest.mark.parametrize("every", [100, 8])
def test_nothing_toxic_is_mixed_in(spark, every):
    rng = random.Random(16)
    toxic = {n for n in range(2000) if n % every == 3}
    poor = {n for n in range(2000) if n % 10 == 4} - toxic
    rows = [(n, words(rng, 30, 300) + (" vile" if n in toxic else " junk" if n in poor else "")) for n in range(2000)]
    marks = [(n, int(n not in poor), int(n in toxic)) for n in range(1600)]
    got = soft_mixing.mixing_rates(documents(spark, rows), labels(spark, marks)).collect()
    assert all(r.rate < 0.1 and r.copies == 0 for r in got if r.doc_id in toxic)
    assert max(r.copies for r in got) <= 2
    clean = [r for r in got if r.doc_id not in toxic | poor]
    assert sum(r.copies > 0 for r in clean) >= 0.97 * len(clean)


def test_poor_documents_do_not_multiply_where_good_ones_are_asked_for(spark):
    """Few poor documents, as after a quality stage; columns named as the operators' own stay."""
    rng = random.Random(17)
    poor, toxic = {n for n in range(1200) if n % 60 == 4}, {n for n in range(1200) if n % 50 == 3}
    rows = [(n, words(rng, 30, 300) + (" vile" if n in toxic else " junk" if n in poor else "")) for n in range(1200)]
    marks = labels(spark, [(n, int(n not in poor), int(n in toxic)) for n in range(1200)])
    own = ["__key", "__text_key", "__row", "__fp", "__gone", "__id", "__lang", "doc", "copies", "text_key", "of"]
    docs = documents(spark, rows).withColumns({name: F.concat(F.lit(name), F.col("doc_id")) for name in own})
    mixed = soft_mixing.mixed(docs, marks, targets=soft_mixing.ONLY_GOOD)
    kept = mixed.collect()
    assert not {r.doc_id for r in kept} & (poor | toxic)
    assert len(kept) >= 0.97 * (1200 - len(poor | toxic)) and len(kept) == len({r.doc_id for r in kept})
    for got in (mixed, perplexity.quality_filter(docs, marks), positional_index.without_contaminated(docs, spark.createDataFrame([("a", "w1 w2")], "item_id string, text string")),
                simhash.one_of_each(docs)):
        assert got.columns == docs.columns
        assert all(r[name] == f"{name}{r.doc_id}" for r in got.collect() for name in own)
    with pytest.raises(ValueError, match="targets"):
        soft_mixing.mixed(docs, marks, targets={"good": 1.0})


def test_rates_that_do_not_settle_are_an_error(spark):
    members = spark.createDataFrame([(10, 0.5, 0.5, 0.0), (20, 0.4, 0.6, 0.0)], "n_tokens long, good double, poor double, toxic double")
    with pytest.raises(RuntimeError, match="still move"):
        soft_mixing.fit_rates(members, {"good": 100.0, "poor": 3.0, "toxic": 0.0}, most_steps=3, tolerance=1e-9)


# Neighbours


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(11)
    centre = rng.standard_normal((12, 8)) * 3
    x = centre[rng.integers(0, 12, 3000)] + rng.standard_normal((3000, 8))
    x[50:80] = x[50]
    rows = [(n, [float(c) for c in v], 0) for n, v in enumerate(x)]
    odd = [(5000, None, 0), (5001, [0.0] * 8, 0), (5002, [1.0] * 7 + [float("nan")], 0), (5003, [None] + [1.0] * 7, 0),
           (5100, [1.0, 2.0], 0), (5200, [float("inf")] * 8, 0), (None, [float(c) for c in x[0]], 0), (100, [float(c) for c in x[100]], 0)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, row int").repartition(4)
    settings = learned_partitions.Settings(sample=2500, parts=8, probes=4, neighbours=10, block_rows=400, block_queries=7)
    got = learned_partitions.nearest_neighbours(table, F.col("vec_id") % 50 == 0, settings=settings).collect()
    usable = [r for r in rows + odd if r[1] and len(r[1]) == 8 and all(c is not None and math.isfinite(c) for c in r[1]) and any(r[1])]
    every = np.array([r[1] for r in usable])
    ids = [r[0] if r[0] is not None else 1 << 62 for r in usable]
    answers = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        answers[r.query_id].append(r)
    hits = wanted = 0
    for at, r in enumerate(usable):
        if r[0] is None or r[0] % 50:
            continue
        d = np.sqrt(((every - every[at]) ** 2).sum(1))
        best = [i for i in np.lexsort((ids, d)) if i != at][:10]
        mine = answers[r[0]]
        assert len(mine) == (20 if r[0] == 100 else 10)
        hits += len({i.vec_id for i in mine} & {usable[i][0] for i in best})
        wanted += len({usable[i][0] for i in best})
        exact = {(usable[i][0], float(v)) for i, v in enumerate(d)}
        assert all((i.vec_id, i.score) in exact for i in mine)
    assert hits >= 0.9 * wanted
    assert [r.vec_id for r in answers[50]][:5] == [51, 52, 53, 54, 55]


def test_few_vectors(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0]), (100, [0.0, 2.0]), (3, [1.0, 1.0])], "vec_id long, embedding array<float>")
    got = learned_partitions.nearest_neighbours(table, F.col("vec_id") % 100 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == [(0, 1, 3), (0, 2, 100), (100, 1, 3), (100, 2, 0)]
    assert learned_partitions.nearest_neighbours(table.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_small_tables_are_cut_into_parts_too(spark):
    rng = np.random.default_rng(4)
    table = spark.createDataFrame([(n, rng.standard_normal(8).tolist()) for n in range(200)], "vec_id long, embedding array<double>")
    few = table.limit(10)
    settings = learned_partitions.Settings(parts=8, probes=4)
    router = learned_partitions.fit_router(learned_partitions.usable(table), 200, settings)
    assert router.coarse and router.probabilities(rng.standard_normal((5, 8))).shape == (5, 8)
    assert learned_partitions.fit_router(learned_partitions.usable(few), 10, settings) is None
    with pytest.raises(ValueError, match="power of two"):
        learned_partitions.Settings(parts=12)


# Repeats


def plain_removal(texts, length):
    count = Counter()
    for b in texts:
        count.update(b[i : i + length] for i in range(len(b) - length + 1))
    out = []
    for b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = len(re.findall(b"\1+", bytes(gone)))
        out.append((len(b), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [20_000, 3])
def test_removal_of_repeats(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_levels, "HOT_CLASSES", hot)
    rng = random.Random(12)
    passages = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(20, 120))) for _ in range(6)]
    rows = []
    for n in range(60):
        parts = ["".join(rng.choice("abcdefgh é") for _ in range(rng.randrange(0, 60)))]
        for _ in range(rng.randrange(0, 4)):
            passage = rng.choice(passages)
            a = rng.randrange(0, 15)
            parts += [passage[a : len(passage) - rng.randrange(0, 15)], "".join(rng.choice("xyz") for _ in range(rng.randrange(0, 30)))]
        rows.append((n, "".join(parts)))
    rows += [(70, "ab" * 200), (71, "a" * 99), (72, rows[3][1]), (72, rows[3][1])] + [r[:2] for r in odd_rows()[12:-1]]
    docs = documents(spark, rows)
    texts = [(r[1] or "").encode() for r in rows]
    want = sorted(((r[0], *w) for r, w in zip(rows, plain_removal(texts, 30), strict=True)), key=repr)
    for batches in (1, 5):
        found = suffix_levels.without_repeats(docs, length=30, anchor=6, batches=batches).select(
            "doc_id", "n_bytes", "n_removed", F.size("spans"), "kept_sha256")
        assert sorted((tuple(r) for r in found.collect()), key=repr) == want
    assert suffix_levels.without_repeats(documents(spark, [])).count() == 0


def test_levels_grow_geometrically(spark):
    family, rng = suffix_levels.LevelFamily(30, 6), random.Random(13)
    sizes = []
    for _ in range(6):
        family.add(spark.createDataFrame([(words(rng, 40),)], "text string"))
        sizes.append([size for size, _ in family.levels])
    assert sizes == [[0], [0, 0], [1, 0], [1, 0, 0], [2, 0], [2, 0, 0]]


def test_long_text_in_chunks(monkeypatch):
    rolling, data = suffix_levels.Rolling(), np.frombuffer(words(random.Random(14), 3000).encode(), np.uint8)
    whole = suffix_levels.entries(data, rolling, 200, 40)
    monkeypatch.setattr(suffix_levels, "CHUNK", 1000)
    cut = suffix_levels.entries(data, rolling, 200, 40)
    covered = lambda e: [w for f, c in zip(e[2], e[3], strict=True) for w in range(f, f + c)]
    assert covered(whole) == covered(cut) == list(range(len(data) - 199))
    assert set(whole[0].tolist()) <= set(cut[0].tolist())


def test_every_operator_has_one_query():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 11))
