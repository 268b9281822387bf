"""Decontamination, near duplicates and nearest neighbours against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from wardlens.llm import ann, decontaminate, neardup
from wardlens.llm.common import Workspace
from wardlens.llm.components import connected_components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _words(text, pattern):
    return re.findall(pattern, (text or "").translate(LOWER))


def _leak_words(text):
    return _words(text, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _windows(words, size):
    return {tuple(words[i:i + size]) for i in range(max(len(words) - size + 1, 1))} if words else set()


def _brute_leaks(docs, items, size):
    out = {}
    for doc_id in {d for d, _ in docs if d is not None}:
        n_words, hit, named = 0, set(), set()
        for d, text in docs:
            if d != doc_id:
                continue
            words = _leak_words(text)
            n_words += len(words)
            for item, item_text in items:
                for w in _windows(_leak_words(item_text), size):
                    for s in range(len(words) - len(w) + 1):
                        if tuple(words[s:s + len(w)]) == w:
                            hit.update(range(s, s + len(w)))
                            named |= {str(item)} - {"None"}
        out[doc_id] = (n_words, len(hit), len(named),
                       hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), bool(hit))
    return out


def _leaks(spark, docs, items, **options):
    rows = decontaminate.decontaminate(
        spark.createDataFrame(docs, "doc_id long, text string, items int, pos string"),
        spark.createDataFrame(items, "item_id long, text string, doc_id string"),
        Workspace(spark, "test"), **options).collect()
    return {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows}


def test_leaks_match_brute_force(spark):
    rng = random.Random(3)
    vocabulary = ["a", "b", "the", "Été", "x9"]
    line = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, line(rng.randrange(1, 9))) for i in range(12)] + [
        (20, None), (21, " .,"), (None, "x9 x9"), (11, "the"), (30, "absent words here")]
    docs = [(i, line(rng.randrange(0, 30))) for i in range(40)] + [
        (50, None), (51, ""), (52, "!"), (None, "a b the"), (3, "the the the"), (3, "the the the"),
        (60, "a " * 5000 + items[0][1])]
    got = _leaks(spark, [(d, t, 1, "p") for d, t in docs], [(i, t, "d") for i, t in items], size=4)
    assert got == _brute_leaks(docs, items, 4)


def test_leaks_of_empty_tables(spark):
    assert _leaks(spark, [], [(1, "a b", "d")]) == {}
    empty = hashlib.sha256(b"").hexdigest()
    assert _leaks(spark, [(1, "a b", 1, "p")], []) == {1: (2, 0, 0, empty, False)}


def test_proximity_matches_brute_force(spark):
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choice("abcdefgh") for _ in range(40))) for i in range(20)]
    phrases = [(1, ["a", "b"]), (2, ["c", "d", "e"]), (3, ["h"]), (4, ["a", "zz"])]
    work = Workspace(spark, "test")
    index = decontaminate.build_index(spark.createDataFrame(docs, "doc_id long, text string"), work)
    table = spark.createDataFrame(phrases, "phrase long, words array<string>")
    got = {(r.phrase, r.doc_id) for r in decontaminate.proximity_matches(index, table, 3, work).collect()}
    counts = {w: sum(t.split().count(w) for _, t in docs) for w in "abcdefgh"}
    want = set()
    for phrase, words in phrases:
        if any(w not in counts for w in words):
            continue
        rarest = min(words, key=lambda w: counts[w])
        assert sum(counts[w] == counts[rarest] for w in words) == 1
        for doc_id, text in docs:
            t = text.split()
            if any(w == rarest and all(o in t[max(p - 3, 0):p + 4] for o in words)
                   for p, w in enumerate(t)):
                want.add((phrase, doc_id))
    assert got == want


def _brute_components(docs):
    sets = {}
    for doc_id, text in docs:
        words = _words(text, r"[^\x20\x09-\x0D]+")
        sets[doc_id] = ({tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))} if words else set())
    comp = {d: d for d in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if sets[a] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both) and comp[b] < comp[a]:
                    comp[a] = comp[b]
                    changed = True
    return {d: (len(sets[d]), comp[d], comp[d] == d) for d in sets}


def test_near_duplicates_match_brute_force(spark):
    rng = random.Random(11)
    base = [[f"w{rng.randrange(400)}" for _ in range(rng.randrange(30, 120))] for _ in range(12)]
    docs, i = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "One"), (5, "a b c d"), (6, "a b c d e")], 10
    for words in base:
        for _ in range(12):
            edited = list(words)
            for _ in range(rng.randrange(0, 5)):
                edited[rng.randrange(len(edited))] = f"v{rng.randrange(10 ** 6)}"
            docs.append((i, " ".join(edited)))
            i += 1
    chain = [f"c{k}" for k in range(104)]
    for k in range(0, 30, 2):
        docs.append((i, " ".join(chain[k:k + 60])))
        i += 1
    docs.append((i, "very long " * 20000))
    frame = spark.createDataFrame([(d, t, 1, "x") for d, t in docs],
                                  "doc_id long, text string, doc int, key string").repartition(5)
    rows = neardup.near_duplicates(frame, Workspace(spark, "test")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == _brute_components(docs)


def test_near_duplicates_repeated_null_and_empty(spark):
    schema = "doc_id long, text string"
    rows = neardup.near_duplicates(spark.createDataFrame(
        [(7, "a b c d e f"), (7, "a b c d e f"), (9, "A b c d e f"), (None, "a b c d e f")], schema),
        Workspace(spark, "test")).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in rows) == [(7, 7, True), (9, 7, False)]
    assert neardup.near_duplicates(spark.createDataFrame([], schema), Workspace(spark, "test")).count() == 0


def test_estimate_is_close_to_similarity(spark):
    rng = np.random.default_rng(2)
    both, own = rng.integers(0, 1 << 62, 600), rng.integers(0, 1 << 62, (2, 100))
    data = [" ".join(map(str, np.concatenate((both, o)))) for o in own]
    signed = neardup.signatures(spark.createDataFrame(list(enumerate(data)), "doc_id long, text string"))
    a, b = [signed.where(F.col("doc_id") == i).select(F.col("sig").alias(f"s{i}")) for i in (0, 1)]
    value = a.crossJoin(b).select(neardup.estimated_similarity("s0", "s1")).first()[0]
    assert abs(value - 596 / 796) < 0.15


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(k, k + 1) for k in range(100, 160)]
    root = {n: n for e in edges for n in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = connected_components(spark.createDataFrame(edges, "a long, b long"), Workspace(spark, "test"))
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert {r.node: r.root for r in got.collect()} == {n: root[n] for n in linked}
    assert connected_components(spark.createDataFrame([], "a long, b long"),
                                Workspace(spark, "test")).count() == 0


def _neighbours(spark, rows, queries):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, class string")
    found = ann.nearest_neighbours(frame, Workspace(spark, "test"), F.col("vec_id").isin(queries)).collect()
    out = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_neighbours_of_small_and_odd_tables(spark):
    rows = [(1, [1.0, 0.0], "a"), (2, [0.0, 1.0], "a"), (3, [0.0, 0.0], "a"), (4, None, "a"),
            (5, [float("nan"), 1.0], "a"), (6, [1.0, None], "a"), (7, [1.0, 0.0], "a"),
            (8, [1.0, 2.0, 3.0], "a"), (None, [1.0, 1.0], "a"), (9, [], "a")]
    got = _neighbours(spark, rows, [1, 3, 8])
    assert got == {1: [(7, 0.0), (2, math.sqrt(2))]}
    assert _neighbours(spark, [], [1]) == {}


def test_neighbours_recall_and_ties(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(1500, 32)).astype(np.float32)
    vectors[900:1000] = vectors[0]  # many equal vectors: ties go to the smaller id
    rows = [(i, [float(x) for x in v], "c") for i, v in enumerate(vectors)]
    queries = list(range(0, 1500, 100))
    got = _neighbours(spark, rows, queries)
    exact = 0
    for q in queries:
        distance = np.sqrt(((vectors.astype(float) - vectors[q].astype(float)) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((np.arange(1500), distance)) if i != q][:10]
        assert len(got[q]) == 10
        assert all(abs(s - distance[i]) < 1e-12 for i, s in got[q])
        exact += len(set(order) & {i for i, _ in got[q]})
    assert exact / (10 * len(queries)) >= 0.9
    assert [i for i, _ in got[0]] == list(range(900, 910))


def test_class_in_all_tables_takes_one_place():
    n = 3 * ann.K
    index = pd.DataFrame([(c, t, [float(c), 1.0]) for t in range(ann.TABLES) for c in range(n)],
                         columns=["class", "bucket", "vec"])
    probes = pd.DataFrame([(0, np.arange(ann.TABLES), [0.0, 1.0])], columns=["query_id", "buckets", "qvec"])
    best = ann._rank(index, probes, exact=False)
    assert list(best["class"]) == list(range(ann.K + 1))
    assert list(best["distance"]) == [float(c) for c in range(ann.K + 1)]


def _own_recall(spark, vectors, step):
    """Mean recall of the queries that the buckets answered, and the numbers of
    these and of those answered by the exact scan."""
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found, scanned = ann.search(frame, Workspace(spark, "test"), F.col("vec_id") % step == 0)
    scanned = {r.query_id for r in scanned.collect()}
    got = {}
    for r in found.collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    wide, shares = vectors.astype(float), []
    assert sorted(got) == list(range(0, len(rows), step)) and all(len(x) == ann.K for x in got.values())
    for q in sorted(got.keys() - scanned):
        distance = ((wide - wide[q]) ** 2).sum(axis=1)
        distance[q] = np.inf
        shares.append(len(set(np.argsort(distance)[:ann.K]) & got[q]) / ann.K)
    return float(np.mean(shares or [0])), len(shares), len(scanned)


def test_neighbours_come_from_the_buckets(spark, monkeypatch):
    monkeypatch.setattr(ann, "GROUP_ROWS", 3000)  # four groups of rows
    rng = np.random.default_rng(6)
    loose = rng.normal(size=(3000, 32)).astype(np.float32)
    tight = (rng.normal(size=(60, 32))[np.arange(3000) % 60] + 0.1 * rng.normal(size=(3000, 32))).astype(np.float32)
    for vectors in (loose, tight):
        recall, answered, scanned = _own_recall(spark, vectors, 100)
        assert (answered, scanned) == (30, 0) and recall >= 0.9


def test_an_id_with_several_vectors_asks_with_each(spark):
    """Whatever the order of the rows, the nearest to any of its vectors counts."""
    rows = [(0, [1.0, 1.0]), (0, [100.0, 1.0])] + [(i, [float(i), 1.0]) for i in range(1, 40)] + [
        (i, [100.0, float(i - 90)]) for i in range(92, 98)]
    want = sorted((min(np.hypot(x - a, y - 1.0) for a in (1.0, 100.0)), i)
                  for i, (x, y) in rows[2:])[:ann.K]
    for order in (rows, rows[::-1]):
        frame = spark.createDataFrame(order, "vec_id long, embedding array<double>")
        found = ann.nearest_neighbours(frame, Workspace(spark, "test"), F.col("vec_id") == 0).collect()
        assert sorted((r.score, r.vec_id) for r in found) == want
        assert sorted(r["rank"] for r in found) == list(range(1, ann.K + 1))
