"""How the solve lays out its rows: keys as columns, nodes in order, and the same totals in every layout."""

from __future__ import annotations

import numpy as np
import pytest

from fluxweave.operators import solve

# Backwards through a chain of halves and thirds; behind it a circle, and a node that lies behind the circle.
ORDERED = [(k // d, k, w) for k in range(1, 24) for d, w in ((2, 0.3), (3, 0.2))]
CIRCLE = [(23, 24, 0.5), (24, 25, 0.4), (25, 24, 0.3), (25, 26, 1.0)]
SEEDS = [(key, k, float(k + 1)) for k in range(24) for key in ("a", None)] + [("b", 0, 2.0)]


def dense(edges, seeds, n=27):
    m = np.eye(n)
    for s, d, w in edges:
        m[d, s] -= w
    out = {}
    for key in {k for k, *_ in seeds}:
        b = np.zeros(n)
        for k, i, v in seeds:
            b[i] += v if k == key else 0
        x = np.linalg.solve(m, b)
        out |= {(key, i): x[i] for i in range(n) if abs(x[i]) > 1e-12}
    return out


def totals(spark, edges, seeds):
    out = solve.propagate(spark.createDataFrame(seeds, "key string, node long, value double"), spark.createDataFrame(edges, "src long, dst long, w double"))
    return {(r["key"], r["node"]): r["total"] for r in out.collect()}


def test_a_node_is_passed_on_once(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(solve, "new_path", lambda _, name: f"file://{tmp_path}/{name}")
    assert totals(spark, ORDERED, SEEDS) == pytest.approx(dense(ORDERED, SEEDS), rel=1e-9)
    rows = spark.read.parquet(*(f"file://{p}" for p in tmp_path.glob("propagate/ordered=*"))).where("ready")
    assert rows.count() == rows.select("node").distinct().count() == 24


@pytest.mark.parametrize("keys, spread", [(16, 8), (16, 0), (1, 8)])
def test_layouts_agree(spark, monkeypatch, keys, spread):
    monkeypatch.setattr(solve, "KEYS", keys)
    monkeypatch.setattr(solve, "SPREAD", spread)
    assert totals(spark, ORDERED + CIRCLE, SEEDS) == pytest.approx(dense(ORDERED + CIRCLE, SEEDS), rel=1e-9)


@pytest.mark.parametrize("few", [16, 1])
def test_study_keeps_scores_that_are_null(spark, monkeypatch, few):
    monkeypatch.setattr(solve, "KEYS", few)
    demand = spark.createDataFrame([(1, "x", 2.0), (1, "y", 3.0), (2, "x", None), (3, "z", 1.0)], "demand_id long, code string, quantity double")
    units = spark.createDataFrame([("x", "m", 1.0), ("x", "n", 5.0), ("y", "m", 10.0)], "code string, method string, unit_score double")
    got = {(r["demand_id"], r["method"]): r["score"] for r in solve.study(demand, units).collect()}
    assert got == {(1, "m"): 32.0, (1, "n"): 10.0, (2, "m"): None, (2, "n"): None}


def test_study_meets_a_code_once(spark, monkeypatch):
    """One row for each input, not one for each of its methods, reaches the sum by demand."""
    demand = spark.createDataFrame([(1, "x", 2.0)], "demand_id long, code string, quantity double")
    units = spark.createDataFrame([("x", m, 1.0) for m in "mnopq"], "code string, method string, unit_score double")
    plan = solve.study(demand, units)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("Aggregate")


def test_contributions_are_not_summed_again(spark):
    """Methods meet a level as columns, and their products need no sum by demand, method and code."""
    levels = spark.createDataFrame([("d", "x", 2.0), ("d", "y", -1.0), ("e", "x", None)], "demand_id string, code string, level double")
    direct = spark.createDataFrame([("x", "m", 3.0), ("x", "n", 1e-40), ("y", "m", 5.0), ("z", "m", 7.0)], "code string, method string, direct double")
    out = solve.contributions(levels, direct)
    assert {(r["demand_id"], r["method"], r["code"]): r["score"] for r in out.collect()} == {("d", "m", "x"): 6.0, ("d", "m", "y"): -5.0}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("Aggregate")


def test_cycles_are_contracted(spark, monkeypatch, tmp_path):
    """Nodes with one edge into them are taken out before the series, self-loops divided out; totals stay as they are."""
    monkeypatch.setattr(solve, "new_path", lambda _, name: f"file://{tmp_path}/{name}")
    tree = [(k // 2, k, 0.25) for k in range(2, 24)] + [(k, k // 3, -0.2) for k in range(3, 24, 4)] + [(22, 22, 0.3), (5, 22, 0.1), (23, 1, 0.5), (24, 0, 1.0), (0, 24, 0.4)]
    seeds = [("a", k, float(k + 1)) for k in range(0, 25, 2)] + [("b", 7, -2.0)]
    assert totals(spark, tree, seeds) == pytest.approx(dense(tree, seeds), rel=1e-9)
    core = spark.read.parquet(f"file://{tmp_path}/propagate/contracted/core")
    assert 0 < core.count() < len(tree) / 2


def test_a_look_reads_a_round_once(spark, monkeypatch, tmp_path):
    """What reached the nodes is kept from look to look, so a round is summed once."""
    monkeypatch.setattr(solve, "new_path", lambda _, name: f"file://{tmp_path}/{name}")
    circle = [(0, 1, 0.7), (1, 0, 0.7), (0, 2, 0.5), (2, 1, 0.3), (1, 2, 0.1)]
    seeds = [("a", 0, 1.0), ("b", 2, 3.0)]
    assert totals(spark, circle, seeds) == pytest.approx(dense(circle, seeds, 3), rel=1e-9)
    assert len(list(tmp_path.glob("**/looked=*"))) > 1


def test_study_sums_behind_the_exchange(spark, sf):
    """No sum before the exchange holds every demand, and names of inventories do not move."""
    from fluxweave.plans.queries import QUERIES

    plan = QUERIES["foreground_scores"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    moved = plan[: plan.index("REPARTITION_BY_COL")]
    assert moved.count("HashAggregate") == 2 and "Exchange" not in moved.replace("Exchange hashpartitioning(demand_id", "", 1)
    assert "order " not in plan[plan.index("REPARTITION_BY_COL") :]
