"""The ordered solve against dense solutions: cycles that amplify, self-loops, long chains, large components."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from fluxweave.operators import blocks, solve


def dense(n, edges, seeds):
    m = np.eye(n)
    for s, d, w in edges:
        m[d, s] -= w
    keys = sorted({k for k, *_ in seeds})
    b = np.zeros((n, len(keys)))
    for k, i, v in seeds:
        b[i, keys.index(k)] += v
    x = np.linalg.solve(m, b)
    return {(k, i): x[i, j] for j, k in enumerate(keys) for i in range(n) if abs(x[i, j]) > 1e-12}


def ordered(spark, edges, seeds):
    out = blocks.ordered_totals(spark.createDataFrame(seeds, "key string, node long, value double"), spark.createDataFrame(edges, "src long, dst long, w double"))
    return {(r["key"], r["node"]): r["total"] for r in out.collect() if abs(r["total"]) > 1e-12}


def close(got, want):
    assert set(got) == set(want)
    assert all(got[k] == pytest.approx(want[k], rel=1e-8, abs=1e-9) for k in want)


# Two cycles with gains of 1.5 and -2, a chain between them, a self-loop, a tail, and a part that nothing reaches.
CYCLES = [(0, 1, 1.5), (1, 0, 1.0), (1, 2, 0.5), (2, 3, 1.0), (3, 4, -2.0), (4, 5, 1.0), (5, 3, 1.0), (5, 6, 0.2), (6, 6, 3.0), (6, 7, 1.0), (7, 8, 1.0), (0, 8, 0.1), (9, 10, 1.0), (10, 9, 0.5)]
SEEDS = [("a", 0, 1.0), ("b", 2, 2.0), ("b", 4, -1.0), ("c", 7, 5.0)]


def test_divergent_series_has_a_solution(spark, monkeypatch):
    edges = spark.createDataFrame(CYCLES, "src long, dst long, w double")
    with pytest.raises(solve.Diverged):
        solve.propagate(spark.createDataFrame(SEEDS, "key string, node long, value double"), edges, max_rounds=16)
    close(ordered(spark, CYCLES, SEEDS), dense(11, CYCLES, SEEDS))
    monkeypatch.setattr(blocks, "DENSE", 2)  # the larger cycle by the distributed iteration
    close(ordered(spark, CYCLES, SEEDS), dense(11, CYCLES, SEEDS))


def test_components_and_ranks(spark, tmp_path):
    edges = spark.createDataFrame(CYCLES, "src long, dst long, w double").select("src", "dst")
    nodes = spark.createDataFrame([(i,) for i in range(12)], "node long")
    got = {r["node"]: (r["comp"], r["rank"]) for r in blocks.ranks(nodes, edges, f"file://{tmp_path}/r").collect()}
    assert [got[i][0] for i in range(12)] == [1, 1, None, 5, 5, 5, 6, None, None, 10, 10, None]
    assert [got[i][1] for i in range(12)] == [0, 0, 1, 2, 2, 2, 3, 4, 5, 0, 0, 0]


def test_large_random_component(spark, monkeypatch):
    monkeypatch.setattr(blocks, "DENSE", 10)
    rng = np.random.default_rng(2)
    edges = [(i, (i + 1) % 25, float(rng.uniform(0.5, 1.5))) for i in range(25)] + [(int(a), int(b), float(rng.normal() * 0.3)) for a, b in rng.integers(0, 25, (20, 2))]
    seeds = [("a", 0, 1.0), ("b", 13, 2.0)]
    close(ordered(spark, edges, seeds), dense(25, edges, seeds))


def test_no_edges_and_no_solution(spark):
    assert ordered(spark, [], [("a", 3, 2.0)]) == {("a", 3): 2.0}
    assert ordered(spark, CYCLES, []) == {}
    with pytest.raises(Exception, match="no single solution"):
        ordered(spark, [(0, 1, 1.0), (1, 0, 1.0)], [("a", 0, 1.0)])


def test_many_small_components_share_a_call(spark, monkeypatch):
    """Circles of 2 to 4 nodes and self-loops, with one to three keys each: few calls, and each solved by itself."""
    monkeypatch.setattr(blocks, "CELLS", 40)
    rng = np.random.default_rng(5)
    edges, seeds = [], []
    for c in range(60):
        n = c % 4 + 1
        edges += [(10 * c + i, 10 * c + (i + 1) % n, float(rng.uniform(1.1, 2.0))) for i in range(n)]
        seeds += [("abc"[k], 10 * c + int(rng.integers(n)), float(rng.normal())) for k in range(c % 3 + 1)]
    close(ordered(spark, edges, seeds), dense(600, edges, seeds))
    b = pd.DataFrame([(i // 10 * 10, k, i, v) for k, i, v in seeds], columns=["comp", "key", "node", "v"])
    w = pd.DataFrame([(s // 10 * 10, s, d, x) for s, d, x in edges], columns=["comp", "src", "dst", "w"])
    got = blocks._dense(b, w)  # all of them in one call
    close({(r.key, r.node): r.v for r in got.itertuples()}, dense(600, edges, seeds))


def test_small_networks_are_solved_whole(spark, monkeypatch):
    """Circles and chains that nothing else leads to need no ranks; the rest, and what one system cannot solve, goes on."""
    looked = []
    monkeypatch.setattr(blocks, "ranks", lambda *a, f=blocks.ranks: looked.append(a) or f(*a))
    rng = np.random.default_rng(7)
    edges = [(3 * c + i, 3 * c + (i + 1) % 3, float(rng.uniform(1.1, 2.0))) for c in range(20) for i in range(2 + c % 2)]
    seeds = [(k, i, float(rng.normal())) for i in range(0, 60, 2) for k in ("a", "b")] + [("a", 70, 3.0)]
    close(ordered(spark, edges, seeds), dense(71, edges, seeds) | {("a", 70): 3.0})
    steep = [(100 + i, 101 + i, 1e9) for i in range(3)]  # solved by its order, not by one system
    long = [(200 + i, 201 + i, 0.5) for i in range(40)]
    more = [("a", 100, 1.0), ("b", 240, 1.0), ("b", 200, 2.0)]
    got = ordered(spark, edges + steep + long, seeds + more)
    close(got, dense(300, edges + long, seeds + more[1:]) | {("a", 70): 3.0} | {("a", 100 + i): 1e9**i for i in range(4)})
    assert len(looked) == 2
    looked.clear()
    close(ordered(spark, edges, seeds[:-1]), dense(60, edges, seeds[:-1]))
    assert not looked
