"""Exact copies, near copies and components against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fluxweave.llm import common, exact_dedup, fuse_filter, graph, jaccard

from .helpers import EDGE, docs


@settings(max_examples=40, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=400))
def test_filter_has_no_false_negatives(keys):
    array = np.array(sorted(keys), np.uint64)
    built = fuse_filter.build(array)
    if len(array):
        assert fuse_filter.probe(array, *built).all()


def test_filter_is_small_and_selective():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, 50_000).astype(np.uint64)
    seed, segment, count, table = fuse_filter.build(keys)
    assert fuse_filter.probe(keys, seed, segment, count, table).all() and len(table) < 1.3 * len(keys)
    others = rng.integers(2**63, 2**64 - 1, 50_000, dtype=np.uint64)
    assert fuse_filter.probe(others, seed, segment, count, table).mean() < 0.01


@pytest.mark.parametrize("rows", [EDGE, [(i, "hot" if i % 3 else f"t{i % 40}") for i in range(300)], [(None, "a"), (None, "a"), (3, "a"), (None, "b")], []])
def test_exact_dedup(spark, rows):
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.exact_dedup(docs(spark, rows)).collect()), key=str)
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    expected = []
    for i, t in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        expected.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(expected, key=str)


def test_filters_serve_batches_of_other_sizes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BUCKET_KEYS", 20)
    store, in_old = str(tmp_path / "filters"), F.col("doc_id") < 100
    old = [(i, f"old {i}") for i in range(100)]
    stamps = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "filters").rglob("*.parquet") if "snapshot=" in str(p)}

    def check(batch):
        got = exact_dedup.exact_dedup(docs(spark, old + batch), in_old, store).collect()
        groups = defaultdict(list)
        for i, t in old + batch:
            groups[t].append(i)
        assert sorted((r.doc_id, r.keep_id, r.group_size) for r in got) == sorted((i, max(groups[t]), len(groups[t])) for i, t in old + batch)

    check([(100 + i, f"old {3 * i}") for i in range(10)])
    first = stamps()
    assert len(first) == exact_dedup.buckets_for(100) == 8
    # A batch with more buckets than the snapshot, and an empty one, load the same files.
    check([(100 + i, f"old {i}") for i in range(700)])
    check([])
    assert stamps() == first
    # Another snapshot has files of its own.
    old.append((99, "one more"))
    check([(100, "one more"), (101, "old 5")])
    assert len(stamps()) == 16 and first.items() <= stamps().items()


def test_exact_dedup_of_very_long_texts(spark):
    long = "0123456789" * 300_000
    got = exact_dedup.exact_dedup(docs(spark, [(1, long), (2, long), (3, long + "x"), (4, long[:-1])]))
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got.collect()) == [(1, 2, 2, False), (2, 2, 2, True), (3, 3, 1, True), (4, 4, 1, True)]


def brute(rows, n, num, den):
    def shingles(t):
        w = (t or "").encode().lower().split()
        return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])

    sets = [(i, shingles(t)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and den * len(x & y) >= num * len(x | y):
                root[find(a)] = find(b)
    low = defaultdict(list)
    for a in range(len(sets)):
        low[find(a)].append(sets[a][0])
    return sorted(((i, len(s), min((x for x in low[find(a)] if x is not None), default=None)) for a, (i, s) in enumerate(sets)), key=str)


def families(seed):
    rng = random.Random(seed)
    words, rows = [f"w{i}" for i in range(400)], []
    for _ in range(10):
        base = [rng.choice(words) for _ in range(rng.choice([4, 11, 40, 130, 300]))]
        for _ in range(rng.choice([1, 2, 9, 30])):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 5, 8])):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((len(rows), " ".join(text)))
    return rows


@pytest.mark.parametrize(("n", "num", "den"), [(3, 90, 100), (5, 80, 100)])
@pytest.mark.parametrize("limits", [{}, {"MEMBERS": 6, "PIVOTS": 3, "ROUNDS": 2}])
def test_jaccard_join(spark, monkeypatch, n, num, den, limits):
    """The limits send families to cells formed by Spark jobs and to tiles."""
    for name, value in limits.items():
        monkeypatch.setattr(jaccard, name, value)
    rows = families(n) + [(1000 + (i or 0) if i is not None else None, t) for i, t in EDGE]
    got = jaccard.ngram_jaccard_join(docs(spark, rows), n, num, den).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, n, num, den)


def brute_links(rows, n, num, den):
    """Per row, the number of other rows whose sets are within the threshold."""

    def shingles(t):
        w = (t or "").encode().lower().split()
        return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])

    sets = [shingles(t) for _, t in rows]
    return sorted(((i, sum(b != a and bool(x) and den * len(x & y) >= num * len(x | y) for b, y in enumerate(sets))) for a, ((i, _), x) in enumerate(zip(rows, sets, strict=True))), key=str)


@pytest.mark.parametrize("limits", [{}, {"PIVOTS": 2, "MATRIX": 0}, {"MEMBERS": 20, "PIVOTS": 3}, {"MEMBERS": 8, "PIVOTS": 2, "ROUNDS": 2}])
def test_jaccard_join_keeps_every_link(spark, monkeypatch, limits):
    """The limits send families to pivots in a task and by Spark jobs, and to tiles."""
    for name, value in limits.items():
        monkeypatch.setattr(jaccard, name, value)
    rows = families(5) + [(1000 + (i or 0) if i is not None else None, t) for i, t in EDGE]
    got = jaccard.ngram_jaccard_join(docs(spark, rows), 3, 90, 100, every=True).collect()
    assert sorted(((r.doc_id, r.n_links) for r in got), key=str) == brute_links(rows, 3, 90, 100)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, 3, 90, 100)


def test_jaccard_join_empty(spark):
    assert jaccard.ngram_jaccard_join(docs(spark, [])).collect() == []


@settings(max_examples=120, deadline=None)
@given(st.integers(1, 400), st.integers(0, 60), st.integers(0, 2**32), st.sampled_from([(90, 100), (80, 100)]))
def test_linked_sets_share_a_signature(size, edits, seed, limit):
    rng = np.random.default_rng(seed)
    x = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
    y = x.copy()
    k = min(edits, len(y))
    y[rng.choice(len(y), k, replace=False)] = rng.integers(0, 2**63, k).astype(np.uint64)
    y = np.unique(y[: max(1, len(y) - rng.integers(0, 3))])
    inter = len(np.intersect1d(x, y))
    if limit[1] * inter >= limit[0] * (len(x) + len(y) - inter):
        signer = jaccard.classes(*limit)
        assert np.intersect1d(signer.signatures(x), signer.signatures(y)).size


@pytest.mark.parametrize("every", [True, False])
@pytest.mark.parametrize("cells", [0, jaccard.MATRIX])
def test_region_within_a_task(monkeypatch, every, cells):
    """Homes, guests and tiles: each pair that may meet is counted once, at the pivots' first level and below."""
    monkeypatch.setattr(jaccard, "MATRIX", cells)
    rng = np.random.default_rng(4)
    base = [np.unique(rng.integers(0, 2**63, 120).astype(np.uint64)) for _ in range(6)]
    sets = []
    for i in range(240):
        s = base[i % 6].copy()
        s[rng.choice(len(s), rng.integers(0, 12), replace=False)] = rng.integers(0, 2**63, 1).astype(np.uint64)
        sets.append(np.unique(s))
    for roles in ([jaccard.HOME] * 240, [i % 5 > 0 for i in range(240)], [jaccard.TILE * (i % 5 > 0) for i in range(240)]):
        roles, weights = [int(r) for r in roles], [1 + i % 4 for i in range(240)]
        region = jaccard.Region(list(range(240)), [s.tobytes() for s in sets], roles, weights, 90, 100, every)
        root, counts = list(range(240)), [0] * 240

        def find(x, root=root):
            while root[x] != x:
                x = root[x]
            return x

        for a in range(240):
            for b in range(a):
                inter = len(np.intersect1d(sets[a], sets[b]))
                meet = jaccard.HOME in (roles[a], roles[b]) or {roles[a], roles[b]} == {jaccard.TILE, jaccard.GUEST}
                if meet and 100 * inter >= 90 * (len(sets[a]) + len(sets[b]) - inter):
                    root[find(a)] = find(b)
                    counts[a] += weights[b]
                    counts[b] += weights[a]
        assert {(find(a) == find(b)) == (region.root[a] == region.root[b]) for a in range(240) for b in range(a)} == {True}
        if every:
            assert region.counts.tolist() == counts and region.found[0] > 0 and len(region.found) > 1


def test_components(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(100, 160)]
    edges = chain + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(500, 400), (400, 500), (7, 7)]
    got = {r.vertex: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    expected = {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert got == expected


def test_jaccard_join_broadcasts_nothing_that_grows(spark, monkeypatch):
    """Beyond the limit of rows no table is broadcast: texts are chosen by bits, and the result is the same."""
    monkeypatch.setattr(common, "FEW", 0)
    seen = []
    monkeypatch.setattr(F, "broadcast", lambda df, f=F.broadcast: seen.append(df.columns) or f(df))
    rows = families(3) + [(1000 + (i or 0) if i is not None else None, t) for i, t in EDGE]
    got = jaccard.ngram_jaccard_join(docs(spark, rows), 3, 90, 100).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, 3, 90, 100)
    assert all("is_hot_" in c for c in seen)


def test_bit_filter_has_every_key(spark):
    keys = spark.createDataFrame([(None,), *((i * i,) for i in range(3_000))], "k long")
    bits = common.bit_filter(keys, 3_001)
    at = [r[0] for r in keys.select(common.at_bit(F.col("k"), 8 * len(bits))).collect()]
    on = np.unpackbits(bits)
    assert on[at].all() and 0 < on.sum() <= 3_001 and common.bit_filter(keys.where("false"), 0).sum() == 0
