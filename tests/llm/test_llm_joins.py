"""Spelling forms, the n-gram join and lexical search against brute force, odd rows included."""

from __future__ import annotations

import math
import os
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from fixtures import documents, odd_rows, words  # noqa: E402

from vaultwright.llm import lexical_search, ngram_join, spelling  # noqa: E402
from vaultwright.llm.queries import QUERIES  # noqa: E402

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def folder_of(tmp_path, docs, items=None):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    if items is not None:
        items.write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


# Spelling


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def plain_forms(counts, times=5):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, around in near.items():
        best = min(around, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= times * counts[w] else None
    found = set()
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        found.add((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return found


def odd_texts(rng):
    stems = ["garten", "gärten", "strasse", "ÀÉÎÕÜß", "receive", "aaaaaa", "aaaaaaa", "abcabc", "wortlang"]
    rows = []
    for n in range(60):
        text = []
        for _ in range(rng.randrange(30, 90)):
            word = rng.choice(stems)
            if rng.random() < 0.4:
                at, letter = rng.randrange(len(word)), rng.choice("aé")
                word = rng.choice([word[:at] + word[at + 1 :], word[:at] + letter + word[at + 1 :], word[:at] + letter + word[at:]])
            text.append(rng.choice([word, word.upper(), word.title()]))
        rows.append((n, rng.choice([" ", "-", "1", "×", "."]).join(text)))
    return rows + [(60, None), (61, ""), (None, "garten garten strasse"), (62, "garten " * 3000), (62, "garten " * 3000)]


def test_registered_spelling_query_equals_brute_force(spark, tmp_path):
    rows = odd_texts(random.Random(4))
    got = QUERIES["op11_spelling"].run(spark, folder_of(tmp_path, documents(spark, rows)))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    expected = plain_forms(plain_words(rows))
    assert {tuple(r) for r in got.collect()} == expected and len(expected) > 50


@pytest.mark.parametrize("seed", [1, 2])
def test_near_words_of_all_lengths(spark, seed):
    rng = random.Random(seed)
    counts = {"".join(rng.choice("ab") for _ in range(rng.randrange(2, 9))): rng.choice([5, 5, 25, 30, 125, 700]) for _ in range(150)}
    got = spelling.spelling_forms(spark.createDataFrame([(w, n, 1) for w, n in counts.items()], "word string, n long, near int"))
    expected = plain_forms(counts)
    assert {tuple(r) for r in got.collect()} == expected
    assert any(form and root != form for _, form, root, *_ in expected)


def test_spelling_of_nothing(spark):
    assert spelling.spelling_forms(spelling.occurring_words(documents(spark, []))).count() == 0
    with pytest.raises(ValueError, match="times"):
        spelling.spelling_forms(spark.createDataFrame([], "word string, n long"), times=1)


# The n-gram join


def plain_components(rows, size=4, percent=85):
    sets = []
    for _, text in rows:
        tokens = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        k = min(size, len(tokens))
        sets.append({" ".join(tokens[i : i + k]) for i in range(len(tokens) - k + 1)} if tokens else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    n_links = 0
    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                root[find(a)] = find(b)
                n_links += 1
    least = defaultdict(list)
    for n, (doc_id, _) in enumerate(rows):
        least[find(n)].append(doc_id)
    ids = {r: min((i for i in found if i is not None), default=None) for r, found in least.items()}
    return sorted(((rows[n][0], len(sets[n]), ids[find(n)]) for n in range(len(rows))), key=repr), n_links


def near_copies(rng, first, *, groups=6, copies=12, length=120):
    rows = []
    for _ in range(groups):
        base = words(rng, length, 5000).split()
        for _ in range(copies):
            copy = list(base)
            for _ in range(rng.randrange(0, 6)):
                at = rng.randrange(len(copy))
                copy[at : at + 1] = [[], [f"z{rng.randrange(9999)}"], [copy[at], "and"]][rng.randrange(3)]
            rows.append((first + len(rows), " ".join(copy)))
    return rows


def test_registered_join_equals_brute_force(spark, tmp_path):
    rng = random.Random(6)
    shared = words(rng, 60, 5000)
    rows = [r[:2] for r in odd_rows()] + near_copies(rng, 100)
    rows += [(500 + n, shared + " " + words(rng, rng.randrange(5, 80), 5000)) for n in range(40)]
    rows += [(600, "one"), (601, "One"), (602, "one two three"), (603, "one  TWO\tthree"), (604, "one two three four")]
    got = QUERIES["op12_ngram_join"].run(spark, folder_of(tmp_path, documents(spark, rows)))
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    expected, n_links = plain_components(rows)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected and n_links > 50


def test_join_of_chains_and_other_sizes(spark):
    """Near copies in a chain: each links with the next few only, the component holds all."""
    rng = random.Random(8)
    base = [f"c{n}" for n in range(260)]
    rows = [(n, " ".join(base[2 * n : 2 * n + 60])) for n in range(100)] + near_copies(rng, 200, groups=2, copies=30, length=60)
    rng.shuffle(rows)
    for size, percent in ((1, 90), (4, 85)):
        got = ngram_join.jaccard_components(documents(spark, rows), words=size, percent=percent)
        assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_components(rows, size, percent)[0]


def test_join_of_nothing(spark):
    assert ngram_join.jaccard_components(documents(spark, [])).count() == 0
    got = ngram_join.jaccard_components(documents(spark, [(3, None), (None, " "), (4, "")]))
    assert sorted(got.collect(), key=repr) == [(3, 0, 3), (4, 0, 4), (None, 0, None)]
    with pytest.raises(ValueError, match="percent"):
        ngram_join.jaccard_components(documents(spark, []), percent=50)


# Lexical search


def plain_search(rows, items, k=50):
    terms = lambda text: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    docs = [(doc_id, terms(text)) for doc_id, text in rows]
    big_n, big_l = sum(1 for _, t in docs if t), sum(len(t) for _, t in docs)
    df = Counter(term for _, t in docs for term in set(t))
    found = []
    for item_id, text in items:
        scores = []
        for doc_id, t in docs:
            tf, score = Counter(t), 0
            for term in set(terms(text)):
                if tf[term]:
                    m = 50 + (50 * len(t) * big_n) // big_l
                    w = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[term] + 1)))
                    score += w * ((1_000_000_000 * tf[term]) // (1000 * tf[term] + 20 * m))
            if score:
                scores.append((-score, doc_id is None, doc_id or 0))
        found += [(item_id, n, None if no else i, -s) for n, (s, no, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(found, key=repr)


def searched(rng):
    rows = [r[:2] for r in odd_rows()] + [(100 + n, words(rng, rng.randrange(1, 200), 400)) for n in range(300)]
    items = [(n, words(rng, rng.randrange(1, 30), 400)) for n in range(12)] + [(12, None), (13, "nowhere"), (13, "w1 W2 w2 é 日本"), (None, "w3")]
    items += [(14, rows[50][1])]
    return rows, items


def items_table(spark, items):
    return spark.createDataFrame([(*i, 5) for i in items], "item_id long, text string, score int")


def test_registered_search_equals_brute_force(spark, tmp_path):
    rows, items = searched(random.Random(3))
    got = QUERIES["op13_lexical_search"].run(spark, folder_of(tmp_path, documents(spark, rows), items_table(spark, items)))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_search(rows, items)


def test_search_in_buckets_and_blocks(spark):
    rows, items = searched(random.Random(5))
    got = lexical_search.ranked_search(documents(spark, rows), items_table(spark, items), k=3, block_terms=60, bucket_rows=16)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_search(rows, items, 3)


def test_buckets_prune_and_lose_nothing():
    rng = np.random.default_rng(7)
    n, dim = 3000, 40
    vectors = np.where(rng.random((n, dim)) < 0.15, rng.integers(1, 1_000_000, (n, dim)), 0)
    vectors[7] = vectors[11]
    norms = np.sqrt((vectors.astype(float) ** 2).sum(1))
    order = np.argsort(-norms)
    weights = {q: {int(t): int(rng.integers(1, 9000)) for t in rng.choice(dim, 1 + q % 8, replace=False)} for q in range(20)}
    queries = lexical_search.Queries.of(weights)
    best, scored = lexical_search.Best(np.zeros(20), 5), 0
    for start in range(0, n, 200):
        own = order[start : start + 200]
        at, terms = np.nonzero(vectors[own])
        scored += lexical_search.search_bucket(own.tolist(), norms[own], at, terms, vectors[own][at, terms], queries, best)
    for q, vector in weights.items():
        exact = sum(vectors[:, t] * w for t, w in vector.items())
        assert best.rows[q] == sorted((-int(s), False, i) for i, s in enumerate(exact) if s)[:5]
    assert scored < 0.4 * n * 20


def test_search_of_nothing(spark):
    rows, items = searched(random.Random(1))
    assert lexical_search.ranked_search(documents(spark, []), items_table(spark, items)).count() == 0
    assert lexical_search.ranked_search(documents(spark, rows), items_table(spark, [])).count() == 0
