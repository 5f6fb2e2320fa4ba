"""Fixtures with known answers: solve, allocation, linking, votes, inventories, comparison, guards, sources and sinks."""

from __future__ import annotations

import hashlib
import json
import random
import warnings

import pytest
from pyspark.sql import functions as F

from fluxweave.operators import allocation, audit, background, catalog, compare, conversion, factors, foreground, guards, jobs, linking, search, solve
from fluxweave.sources import readers, sinks

CYCLE = [("W", "S", 0.5), ("W", "F", 0.2), ("S", "N", 0.4), ("N", "S", 0.1), ("F", "N", -0.05), ("N", "N", 0.02)]
MADE = [("W", 1.0), ("S", 2.0), ("N", 1.0), ("F", 4.0)]


@pytest.fixture(scope="module")
def network(spark):
    return spark.createDataFrame(CYCLE, "consumer string, provider string, amount double"), spark.createDataFrame(MADE, "code string, amount double")


def test_cyclic_supply(spark, network):
    demand = spark.createDataFrame([("d", "W", 1.0), ("e", "W", 3.0)], "demand_id string, code string, quantity double")
    got = {(r["demand_id"], r["code"]): r for r in solve.supply(demand, *network).collect()}
    for code, value in {"W": 1.0, "S": 0.51015625, "N": 0.1015625, "F": 0.2}.items():
        assert got["d", code]["quantity"] == pytest.approx(value, rel=1e-10)
        assert got["e", code]["quantity"] == pytest.approx(3 * value, rel=1e-10)
    assert got["d", "F"]["level"] == pytest.approx(0.05)


def test_forward_equals_adjoint_and_contributions_add_up(spark, network):
    bio = spark.createDataFrame([("N", "x", 2.0), ("S", "x", 1.0), ("F", "y", 5e-9)], "code string, flow_id string, amount double")
    cf = spark.createDataFrame([("m", "x", 1.5), ("tiny", "y", 1e-9)], "method string, flow_id string, cf double")
    demand = spark.createDataFrame([("d", "W", 2.0)], "demand_id string, code string, quantity double")
    direct = solve.characterized(bio, cf)
    parts = solve.contributions(solve.supply(demand, *network), direct)
    forward = {r["method"]: r["score"] for r in solve.scores(parts).collect()}
    adjoint = {r["method"]: r["score"] for r in solve.study(demand, solve.unit_scores(*network, direct)).collect()}
    assert forward == pytest.approx(adjoint, rel=1e-9) and set(forward) == {"m", "tiny"}


def test_divergence_is_an_error(spark):
    edges = spark.createDataFrame([("a", "b", 2.0), ("b", "a", 1.0)], "consumer string, provider string, amount double")
    made = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "code string, amount double")
    seed = spark.createDataFrame([("k", "a", 1.0)], "key string, node string, value double")
    with pytest.raises(solve.Diverged, match="k/"):
        solve.propagate(seed, solve.coefficients(edges, made), max_rounds=8)


def test_slow_cycle_is_solved(spark):
    """Spectral radius 0.6: the share that lives dies out after some 55 rounds."""
    edges = spark.createDataFrame([("a", "b", 0.6), ("b", "a", 0.6)], "consumer string, provider string, amount double")
    made = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "code string, amount double")
    seed = spark.createDataFrame([("k", "a", 1.0)], "key string, node string, value double")
    got = {r["node"]: r["total"] for r in solve.propagate(seed, solve.coefficients(edges, made)).collect()}
    assert got == pytest.approx({"a": 1 / (1 - 0.36), "b": 0.6 / (1 - 0.36)}, rel=1e-9)


def test_latest_version_and_first_source_of_equals(spark):
    rows = spark.createDataFrame([("p", "00.01.002", "2020", "b"), ("p", "00.01.014", "2019", "c"), ("p", "00.01.014", "2019", "a")], "id string, v string, t string, src string")
    got = catalog.latest_version(rows, ["id"], "v", "t", ["src"]).first()
    assert (got["v"], got["src"]) == ("00.01.014", "a")
    assert catalog.version_conflicts(rows, ["id"], "v", "t").first()["n_versions"] == 2


def test_linking_priorities(spark):
    ex = spark.createDataFrame([(1, "f", "p9", "zzz"), (2, "f", "x1", None), (3, "g", None, None), (4, "f", "gone", "two"), (5, "f", None, "same"), (6, "none", None, None)], "n int, flow_id string, provider_id string, provider_name string")
    cols = "process_id string, flow_id string, supplier string, supplier_name string, supplier_db string"
    inside = spark.createDataFrame([("p9", "other", "p9", "nine", "process"), ("p1", "f", "p1", "one", "process"), ("p2", "f", "p2", "two", "process"), ("p3", "g", "p3", "three", "process"), ("p4", "f", "p4", "same", "process"), ("p5", "f", "p5", "same", "process")], cols)
    outside = spark.createDataFrame([("x1", "f", "x1", "ex", "external")], cols)
    got = {r["n"]: (r["how"], r["supplier"], r["ambiguous"]) for r in linking.resolve(ex, inside, outside, linking.candidates(inside, outside)).collect()}
    assert got == {1: ("hint", "p9", False), 2: ("external_hint", "x1", False), 3: ("single", "p3", False), 4: ("name", "p2", False), 5: ("none", None, True), 6: ("none", None, False)}


def test_allocation_methods(spark):
    out = spark.createDataFrame([("e", "fuel", True, 100.0, 100.0), ("e", "wax", False, 50.0, 50.0), ("m", "a", True, 100.0, 100.0), ("m", "b", False, 0.05, 45.0), ("s", "x", True, 1.0, 0.0), ("z", "x", True, 1.0, 0.0), ("z", "y", False, 1.0, 2.0)], "process_id string, flow_id string, is_ref boolean, amount double, mass double")
    fac = spark.createDataFrame([("e", "ECON", "fuel", 3, 0.999, 0), ("e", "ECON", "fuel", None, 0.8, 1), ("e", "ECON", "wax", None, 0.2, 2), ("e", "PHYS", "fuel", None, 0.6667, 3)], "process_id string, allocation_type string, product_flow_id string, internal_id int, value double, pos int")
    declared = spark.createDataFrame([("e", "ECON")], "process_id string, allocation_type string")
    shares = allocation.mass_fractions(out)
    got = {r["process_id"]: (r["method"], r["factor"]) for r in allocation.decide(shares, allocation.native_factors(fac), declared).collect()}
    assert got == {"e": ("native", 0.8), "m": ("mass", pytest.approx(100 / 145)), "s": ("single", 1.0), "z": ("failed", None)}
    with pytest.raises(guards.GuardError):
        guards.allocation_possible(allocation.decide(shares, allocation.native_factors(fac), declared))


def test_declared_method_is_asked_first(spark):
    """Factors of several kinds side by side; causal without masses; a reference on the input side."""
    out = spark.createDataFrame([("n", "a", True, 0.6), ("n", "b", False, 0.4), ("c", "a", True, 0.6), ("c", "b", False, 0.4), ("k", "a", True, None), ("k", "b", False, None), ("w2", "a", False, 0.5), ("w2", "b", False, 0.5)], "process_id string, flow_id string, is_ref boolean, mass_fraction double")
    fac = spark.createDataFrame([("n", "PHYSICAL", "a", None, 0.7, 0), ("n", "CAUSAL", "a", 3, 0.9, 1), ("c", "ECONOMIC", "a", None, 0.2, 2), ("c", "CAUSAL", "a", None, 0.1, 3)], "process_id string, allocation_type string, product_flow_id string, internal_id int, value double, pos int")
    declared = spark.createDataFrame([("n", "PHYSICAL"), ("c", "CAUSAL"), ("k", "CAUSAL"), ("w", "ECONOMIC"), ("w2", "ECONOMIC"), ("u", None)], "process_id string, allocation_type string")
    got = {r["process_id"]: (r["method"], r["factor"], r["ref_flow"]) for r in allocation.decide(out, allocation.native_factors(fac), declared).collect()}
    assert got == {"n": ("native", 0.7, "a"), "c": ("causal", 0.6, "a"), "k": ("causal", 1.0, "a"), "w": ("single", 1.0, None), "w2": ("failed", None, None), "u": ("single", 1.0, None)}


IMPORT = "process_id string, internal_id int, flow_id string, amount double, unit string, fp_id string, flow_type string, is_input boolean, is_ref boolean, is_avoided boolean, provider_id string, provider_name string"


def _import(spark, exchanges, factors, declared, strict=True):
    rows = spark.createDataFrame([(p, i, f, a, "kg", "mass", t, inp, ref, False, prov, None) for p, i, f, a, t, inp, ref, prov in exchanges], IMPORT)
    conv = spark.createDataFrame([(f, "mass", "kg") for f in sorted({x[2] for x in exchanges})], "flow_id string, ref_fp_id string, ref_unit string")
    inside = rows.where("is_ref").selectExpr("process_id", "flow_id", "process_id as supplier", "process_id as supplier_name", "'process' as supplier_db")
    built = jobs.import_build(rows, conv, spark.createDataFrame([], "flow_id string, fp_id string, factor double"), spark.createDataFrame(factors, "process_id string, allocation_type string, product_flow_id string, internal_id int, value double, pos int"), spark.createDataFrame(declared, "process_id string, allocation_type string"), spark.createDataFrame([("co2",)], "flow_id string"), inside, inside.where("false"), strict=strict)
    return {(r["code"], r["type"], r["input"]): round(r["amount_built"], 9) for r in built.collect()}


P, W, E = "PRODUCT_FLOW", "WASTE_FLOW", "ELEMENTARY_FLOW"


def test_import_with_coproducts_and_treatments(spark):
    """A causal process with its grid, an economic one, a landfill, and a process that draws from all of them."""
    exchanges = [
        ("ref", 1, "fuel", 60.0, P, False, True, None), ("ref", 2, "wax", 40.0, P, False, False, None), ("ref", 3, "crude", 120.0, P, True, False, "well"), ("ref", 4, "co2", 10.0, E, False, False, None), ("ref", 5, "sludge", 7.0, W, False, False, "fill"),
        ("eco", 1, "meal", 80.0, P, False, True, None), ("eco", 2, "oil", 20.0, P, False, False, None), ("eco", 3, "co2", 5.0, E, False, False, None),
        ("well", 1, "crude", 1.0, P, False, True, None), ("fill", 1, "sludge", 1.0, W, True, True, None), ("fill", 2, "co2", 2.0, E, False, False, None),
        ("user", 1, "thing", 1.0, P, False, True, None), ("user", 2, "wax", 3.0, P, True, False, "ref"), ("user", 3, "oil", 2.0, P, True, False, "eco"), ("user", 4, "fuel", 4.0, P, True, False, "ref"),
    ]
    factors = [("ref", "CAUSAL", "fuel", 3, 0.9, 0), ("ref", "CAUSAL", "wax", 3, 0.1, 1), ("ref", "CAUSAL", "fuel", 4, 0.5, 2), ("ref", "CAUSAL", "wax", 4, 0.5, 3), ("eco", "ECONOMIC", "meal", None, 0.6, 4), ("eco", "ECONOMIC", "oil", None, 0.4, 5), ("eco", "CAUSAL", "meal", 3, 0.99, 6)]
    got = _import(spark, exchanges, factors, [("ref", "CAUSAL"), ("eco", "ECONOMIC")])
    assert got == {
        ("ref", "production", "ref"): 60.0, ("ref", "technosphere", "well"): 108.0, ("ref", "biosphere", "co2"): 5.0, ("ref", "technosphere", "fill"): 4.2,
        ("ref__co__wax", "production", "ref__co__wax"): 40.0, ("ref__co__wax", "technosphere", "well"): 12.0, ("ref__co__wax", "biosphere", "co2"): 5.0, ("ref__co__wax", "technosphere", "fill"): 2.8,
        ("eco", "production", "eco"): 80.0, ("eco", "biosphere", "co2"): 3.0, ("well", "production", "well"): 1.0, ("fill", "production", "fill"): 1.0, ("fill", "biosphere", "co2"): 2.0,
        ("user", "production", "user"): 1.0, ("user", "technosphere", "ref__co__wax"): 3.0, ("user", "technosphere", "eco"): round(2.0 * 80 * 0.4 / (20 * 0.6), 9), ("user", "technosphere", "ref"): 4.0,
    }


def test_import_stops_where_a_guard_finds_something(spark):
    two = [("p", 1, "a", 1.0, P, False, False, None), ("p", 2, "b", 1.0, P, False, False, None)]
    with pytest.raises(guards.GuardError):
        _import(spark, two, [], [("p", "ECONOMIC")])
    assert _import(spark, two, [], [("p", "ECONOMIC")], strict=False) == {}
    causal = [("p", 1, "a", 1.0, P, False, True, None), ("p", 2, "b", 1.0, P, False, False, None), ("q", 1, "c", 1.0, P, False, True, None), ("q", 2, "b", 1.0, P, True, False, "p")]
    with pytest.raises(guards.GuardError, match="consumed"):
        _import(spark, causal, [], [("p", "CAUSAL")])


def test_multiplier_conserves_burden(spark):
    rows = spark.createDataFrame([("p", "r", True, 137.0, 0.55), ("p", "a", False, 12.5, 0.30), ("p", "b", False, 940.0, 0.15), ("q", "r", True, 1.0, 0.0), ("q", "a", False, 1.0, 1.0)], "process_id string, flow_id string, is_ref boolean, amount double, share double")
    got = {(r["process_id"], r["flow_id"]): r for r in allocation.multipliers(rows).collect()}
    total = 0.55 + sum(got["p", f]["multiplier"] * y / 137.0 * 0.55 for f, y in (("a", 12.5), ("b", 940.0)))
    assert total == pytest.approx(1.0) and got["q", "a"]["skipped"]


def test_conversion_reference(spark):
    rows = spark.createDataFrame([("d", 0, "v", "m3", 1.0, True), ("d", 1, "m", "kg", 849.0, False), ("i", 0, "m", "kg", 1.0, None), ("a", 0, "m", "kg", 1.0, None), ("a", 1, "v", "m3", 1.0, None), ("b", 0, "m", "kg", 2.0, True), ("n", 0, "m", "kg", 3.0, None)], "flow_id string, pos int, fp_id string, ref_unit string, factor double, flagged boolean")
    ref = conversion.reference_property(rows)
    assert {r["flow_id"]: r["status"] for r in ref.collect()} == {"d": "flagged", "i": "inferred", "a": "ambiguous", "b": "bad_factor", "n": "missing"}
    assert [tuple(r) for r in conversion.conversion_rows(rows, ref).collect()] == [("d", "m", 849.0)]


def test_votes(spark):
    votes = spark.createDataFrame([("a", "2025", 79), ("a", "2026", 1), ("t", "2025", 5), ("t", "2026", 5)], "source string, vintage string, votes long")
    assert {r["source"]: r["verdict"] for r in background.classify_sources(votes).collect()} == {"a": "2025", "t": None}
    verdicts = background.classify_sources(votes)
    assert background.decide_vintage(verdicts).first()["reason"] == "unanimous"
    assert background.decide_vintage(verdicts, explicit="2026").first()["vintage"] == "2026"
    assert background.decide_vintage(verdicts.where("false"), default="2025").first()["reason"] == "default"


def test_factor_table(spark):
    rows = spark.createDataFrame([("m", "f", "", 1.0, 1), ("m", "f", "", 2.0, 2), ("m", "f", "US", 9.0, 3), ("m", None, "", 1.0, 4), ("m", "g", "", float("nan"), 5), ("e", "f", "US", 7.0, 6)], "method string, flow_id string, location string, cf double, row_index int")
    flows = spark.createDataFrame([("f",), ("g",)], "flow_id string")
    got = {(r["method"], r["flow_id"]): (r["cf"], r["n_rows"]) for r in factors.build_table(rows, flows, F.col("method") == "e", "US").collect()}
    assert got == {("m", "f"): (2.0, 2), ("e", "f"): (7.0, 1)}


FG = "lineno int, process_name string, exchange_type string, flow_uuid string, provider_uuid string, amount string, unit string, is_ref string"


def test_foreground_collects_all_errors(spark):
    rows = spark.createDataFrame(
        [
            (2, "Cup", "production", None, None, "1", "kg", "True"),
            (3, "Cup", "technosphere", None, "bg", "500", "g", ""),
            (4, "Cup", "biosphere", "co2", None, "0", "kg", ""),
            (5, "Cup", "technosphere", None, "nowhere", "abc", "kg", ""),
            (6, " ", "strange", None, None, "1", "kg", ""),
            (7, "Lid", "production", None, "bg", "-1", "kg", "no"),
        ],
        FG,
    )
    bio = spark.createDataFrame([("co2", "kg")], "flow_id string, unit string")
    back = spark.createDataFrame([("bg", "kg")], "code string, unit string")
    checked = foreground.validate(rows, bio, back)
    got = {r["lineno"]: (len(r["errors"]), r["warnings"]) for r in checked.collect()}
    assert got == {2: (0, []), 3: (0, ["unit converted"]), 4: (0, ["amount is zero"]), 5: (2, []), 6: (2, []), 7: (3, [])}
    with pytest.raises(foreground.InvalidInventory, match="row 5"):
        foreground.load(checked)
    good = foreground.load(foreground.validate(rows.where("lineno < 5"), bio, back)).collect()
    assert {(r["type"], r["amount"]) for r in good} == {("production", 1.0), ("technosphere", 0.5), ("biosphere", 0.0)}


def test_foreground_rows_that_ask_for_nothing_are_spread(spark):
    """Rows without name, provider or flow do not meet in one task under a null key."""
    rows = spark.range(4000).selectExpr("CAST(id AS INT) AS lineno", "' ' AS process_name", "'production' AS exchange_type", "CAST(NULL AS STRING) AS flow_uuid", "CAST(NULL AS STRING) AS provider_uuid", "'1' AS amount", "'kg' AS unit", "'' AS is_ref")
    table = spark.createDataFrame([("x", "kg")], "id string, unit string")
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        checked = foreground.validate(rows, table.toDF("flow_id", "unit"), table.toDF("code", "unit"))
        got = checked.select("lineno", F.size("errors").alias("n"), F.spark_partition_id().alias("p")).toPandas()
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert len(got) == got.lineno.nunique() == 4000 and set(got.n) == {1}
    assert got.groupby("p").size().max() < 2000


def test_foreground_checks_are_written_once(spark, tmp_path):
    rows = spark.createDataFrame([(1, "Cup", "production", None, None, "2", "kg", "yes"), (2, "Cup", "technosphere", None, "bg", "500", "g", "")], FG)
    bio, back = spark.createDataFrame([("co2", "kg")], "flow_id string, unit string"), spark.createDataFrame([("bg", "kg")], "code string, unit string")
    path = f"file://{tmp_path}/loaded"
    loaded = foreground.load(foreground.validate(rows, bio, back), path=path)
    assert loaded.inputFiles() and loaded.columns == ["code", "input_code", "amount", "type", "link_db"] and loaded.count() == spark.read.parquet(path).count() == 2
    with pytest.raises(foreground.InvalidInventory, match="row 2: unknown provider"):
        foreground.load(foreground.validate(rows.replace("bg", "gone", "provider_uuid"), bio, back), path=f"file://{tmp_path}/bad")


def test_target_choice():
    assert foreground.pick_target(["a"]) == "a" and foreground.pick_target(["a", "b"], "b") == "b"
    with pytest.raises(ValueError, match="name one"):
        foreground.pick_target(["a", "b"])


def test_search(spark, tmp_path):
    names = spark.createDataFrame([("1", "Steel; billets; at plant"), ("2", "Steel"), ("3", "Cold rolled steel; at plant"), ("4", None), ("5", "")], "code string, name string")
    queries = spark.createDataFrame([("steel",), ("",), ("steel zz",), ("t p",)], "query string")
    index = search.build_index(names, str(tmp_path / "index"))
    got = search.search(index, queries).orderBy("query", "rank").collect()
    assert [r["code"] for r in got if r["query"] == "steel"] == ["2", "1", "3"]
    assert [r["code"] for r in got if r["query"] == ""] == ["5", "2", "1", "3"]
    assert [r["code"] for r in got if r["query"] == "t p"] == ["1", "3"] and not [r for r in got if r["query"] == "steel zz"]
    assert search.suggest(names.where("name is not null"), spark.createDataFrame([("steal",)], "query string")).first()["head"] == "steel"


def test_search_by_index_equals_scan(spark, tmp_path):
    rng = random.Random(3)
    words = ["".join(rng.choice("abÄé😀-") for _ in range(rng.randint(1, 5))) for _ in range(60)]
    names = [(str(i), " ".join(rng.choices(words, k=rng.randint(0, 4)))) for i in range(300)]
    asked = sorted({" ".join(rng.choices([w[: rng.randint(1, 5)] for w in words], k=rng.randint(0, 3))) for _ in range(120)})
    path = str(tmp_path / "index")
    search.build_index(spark.createDataFrame(names, "code string, name string"), path)
    plan_of = search.search(search.open_index(spark, path), spark.createDataFrame([(q,) for q in asked], "query string"), 0)
    want = {(q, c) for q in asked for c, n in names if all(t in n.lower() for t in q.lower().split())}
    assert {(r["query"], r["code"]) for r in plan_of.collect()} == want and len(want) > 500
    assert "NestedLoop" not in plan_of._jdf.queryExecution().toString() and "Cartesian" not in plan_of._jdf.queryExecution().toString()


def test_content_hash_is_a_stream(spark, tmp_path, monkeypatch):
    (tmp_path / "empty.bin").write_bytes(b"")
    (tmp_path / "two words.bin").write_bytes(b"x" * 1000)
    monkeypatch.setattr(readers, "BLOCK_BYTES", 7)
    want = {"two words.bin": hashlib.sha256(b"x" * 1000).hexdigest()}
    assert {r["name"]: r["sha256"] for r in readers.content_hashes(spark, str(tmp_path)).collect()} == want
    assert readers._digest(str(tmp_path / "two words.bin")) == want["two words.bin"]


def test_flow_rows_do_not_mix(spark, tmp_path):
    for source, flows in (("a", [("f", "A", None), ("g", "G", "PRODUCT_FLOW")]), ("b", [("f", None, "WASTE_FLOW"), ("f", "B", None)])):
        (tmp_path / source / "flows").mkdir(parents=True)
        (tmp_path / source / "flows" / "f.json").write_text("\n".join(json.dumps({"@id": i, "name": n, "flowType": t}) for i, n, t in flows))
    got = {r["flow_id"]: (r["name"], r["flow_type"]) for r in readers.read_flows(spark, str(tmp_path), lines=True).collect()}
    assert got["g"] == ("G", "PRODUCT_FLOW") and got["f"] in ((None, "WASTE_FLOW"), ("B", None))


def test_comparison(spark):
    scores = spark.createDataFrame([("base", "m", 2.0), ("alt", "m", -1.0), ("base", "n", 0.0), ("alt", "n", 1.0)], "scenario string, method string, score double")
    got = {(r["scenario"], r["method"]): r["percent"] for r in compare.against_baseline(scores, "base").collect()}
    assert got["alt", "m"] == -50.0 and got["alt", "n"] is None
    assert not compare.baseline_guard(scores, "base").first()["refused"]
    cells = spark.createDataFrame([("p", "c", 1.0, 1.0005), ("p", "d", 0.0, 1.0), ("p", "e", 0.0, 0.0), ("p", "f", 1.0, 0.0)], "process string, category string, computed double, reference double")
    gate = compare.gate(cells).first()
    assert (gate["n_cells"], gate["n_failed"], gate["verdict"]) == (4, 2, "FAIL")
    with pytest.raises(KeyError, match="there are m, n"):
        compare.score_of(scores, "x")


def test_completeness(spark):
    chain = spark.createDataFrame([("d", c) for c in "ABCX"], "demand_id string, code string")
    log = spark.createDataFrame([("A", 0, 0, 0), ("B", 2, 1, 3)], "code string, bio_unmatched long, tech_unlinked long, tech_ambiguous long")
    got = audit.completeness(chain, log, spark.createDataFrame([("X",)], "code string")).first()
    assert (got["n_activities"], got["n_external"], got["n_audited"], got["n_unaudited"], got["bio_unmatched"], got["tech_unlinked"], got["fully_linked"]) == (4, 1, 2, 1, 2, 1, False)


def test_json_sources_and_sinks(spark, tmp_path):
    for source, version, name in (("a", "00.01.002", "old"), ("b", "00.01.014", "new")):
        (tmp_path / source / "processes").mkdir(parents=True)
        doc = {"@id": "p", "name": name, "version": version, "exchanges": [{"internalId": 1, "amount": 2.5, "isInput": True, "flow": {"@id": "f", "flowType": "PRODUCT_FLOW"}, "unit": {"name": "kg"}}, {"flow": {"@id": "g"}}]}
        (tmp_path / source / "processes" / "p.json").write_text(json.dumps(doc, indent=1))
        (tmp_path / source / "processes" / "q.json").write_text(json.dumps({"name": "no id"}))
    rows = readers.read_processes(spark, str(tmp_path))
    assert rows.count() == 2
    newest = catalog.latest_version(rows, ["process_id"], "version", "last_change", ["source"])
    got = readers.explode_exchanges(newest).orderBy("pos").collect()
    assert newest.first()["name"] == "new" and [(r["amount"], r["unit"], r["is_input"], r["is_ref"]) for r in got] == [(2.5, "kg", True, False), (0.0, "", False, False)]
    out = str(tmp_path / "results")
    result = lambda s, x: spark.createDataFrame([(s, "m", x)], "scenario string, method string, score double")
    assert sinks.write_results(result("A", 1.0), out) == 1 and sinks.write_results(result("B", 2.0), out) == 2
    assert sinks.write_results(result("A", 3.0), out) == 2
    assert {(r["scenario"], r["score"]) for r in spark.read.parquet(out).collect()} == {("A", 3.0), ("B", 2.0)}
    assert sinks.write_contributions(result("A", 1.0).where("false"), str(tmp_path / "none")) == 0 and not (tmp_path / "none").exists()
    ident = readers.source_identity(spark, str(tmp_path / "a" / "processes"))
    assert ident.count() == 2 and all(len(r["sha256"]) == 64 for r in ident.collect())
    with pytest.raises(ValueError, match="pinned"):
        readers.check_pin(ident, "p.json", "0" * 64)


def test_foreground_csv(spark, tmp_path):
    path = tmp_path / "fg.csv"
    path.write_text("process_name,exchange_type,flow_uuid,provider_uuid,flow_name,amount,unit,is_ref\nCup,production,,,cup,1,kg,True\nCup,biosphere,co2,,CO2,2,kg,\n")
    assert [r["lineno"] for r in readers.read_foreground(spark, str(path)).orderBy("lineno").collect()] == [2, 3]
    path.write_text("process_name,amount\nCup,1\n")
    with pytest.raises(ValueError, match="missing columns"):
        readers.read_foreground(spark, str(path))


def test_guards(spark):
    meta = spark.createDataFrame([("x", "1")], "db string, flow_version string")
    guards.require_build(meta, "x")
    with pytest.raises(guards.GuardError, match="there are x"):
        guards.require_build(meta, "y")
    assert guards.stale(meta, "2").first()["stale"]
    with pytest.raises(guards.GuardError, match="expected"):
        guards.method_count(spark.createDataFrame([("m",)], "method string"), 10)
    with pytest.raises(guards.GuardError, match="twice"):
        guards.index_complete(spark.createDataFrame([("a",), ("a",)], "id string"), "id", 2)
    with pytest.raises(guards.GuardError, match="production"):
        guards.production_present(spark.createDataFrame([("a",)], "code string"), spark.createDataFrame([("b",)], "code string"))


def test_methods_need_one_unit_and_a_factor(spark):
    raw = spark.createDataFrame([("a", "x", "", 1.0, 1, "kg"), ("a", "x", "", 2.0, 2, "g"), ("b", "y", "", 3.0, 1, "MJ")], "method string, flow_id string, location string, cf double, row_index int, unit string")
    flows = spark.createDataFrame([("x",), ("y",)], "flow_id string")
    override = spark.createDataFrame([("a", "kg eq")], "method string, unit string")
    got = {r["method"]: (r["cf"], r["unit"]) for r in factors.build_methods(raw, flows, F.lit(False), override).collect()}
    assert got == {"a": (2.0, "kg eq"), "b": (3.0, "MJ")}
    with pytest.raises(guards.GuardError, match="several units"):
        factors.build_methods(raw, flows, F.lit(False), override.limit(0))
    with pytest.raises(guards.GuardError, match="without factors"):
        factors.build_methods(raw, flows.where("flow_id = 'x'"), F.lit(False), override)


def test_sources_are_chosen_and_pins_checked(spark):
    found = spark.createDataFrame([("full.zip", False), ("look-alike.zip", False), ("bundle.zip", True)], "name string, accepted boolean")
    assert [r["name"] for r in readers.choose_sources(found).collect()] == ["bundle.zip"]
    assert [r["name"] for r in readers.choose_sources(found, full="full.zip").collect()] == ["full.zip"]
    for rows, full in ((found.where("not accepted"), None), (found, "other.zip")):
        with pytest.raises(guards.GuardError):
            readers.choose_sources(rows, full)
    identity = spark.createDataFrame([("full.zip", "aa")], "name string, sha256 string")
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        readers.check_pin(identity, "full.zip", "aa")
        readers.check_pin(identity, "absent.zip", "bb")
    with pytest.raises(ValueError, match="pinned"):
        readers.check_pin(identity, "full.zip", "bb")
    with pytest.warns(UserWarning, match="cannot be checked"):
        readers.check_pin(identity, None, None)


def test_store_asks_before_it_is_replaced(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", "x", "n"), (2, "b", "x", "n")], "pos int, db string, code string, name string")
    path, asked = str(tmp_path / "store"), []
    sinks.write_store(rows, path)
    with pytest.raises(Exception, match="already exists"):
        sinks.write_store(rows.limit(1), path, confirm=lambda p: bool(asked.append(p)))
    assert asked == [path] and spark.read.parquet(path).count() == 2
    assert [tuple(r) for r in readers.read_catalogue(spark, path).collect()] == [("x", "n", "a,b", 1)]
    sinks.write_store(rows.where("db = 'b'"), path, confirm=lambda _: True)
    assert readers.read_catalogue(spark, path, "b").count() == 1
    with pytest.raises(guards.GuardError):
        readers.read_catalogue(spark, path, "a")


def test_mass_of_a_run_and_empty_intersections(spark):
    production = spark.createDataFrame([("a", 2.0, "kg"), ("b", 3.0, "M3"), ("c", 4.0, None)], "code string, amount double, unit string")
    density = spark.createDataFrame([("b", 850.0)], "code string, density double")
    assert {r["code"]: r["kg_per_run"] for r in compare.kg_per_run(production, density).collect()} == {"a": 2.0, "b": 2550.0, "c": 4.0}
    for wrong in (density.limit(0), density.withColumn("density", F.lit(None).cast("double"))):
        with pytest.raises(Exception, match="no mass basis for m3"):
            compare.kg_per_run(production, wrong).collect()
    one, other = (spark.createDataFrame([(s,)], "scenario string") for s in "ab")
    with pytest.raises(guards.GuardError, match="share no scenario"):
        compare.shared_scenarios(one, other)


def test_flow_list_names_missing_columns(spark):
    flows = spark.createDataFrame([("x", "kg")], "flow_id string, unit string")
    guards.flow_list(flows, flows.limit(0), 1, ("flow_id", "unit"))
    with pytest.raises(guards.GuardError, match="missing columns context"):
        guards.flow_list(flows, flows.limit(0), 1, ("flow_id", "context"))


def test_probe_finds_a_planted_error_without_the_product(spark):
    direct = spark.createDataFrame([(r, m, float(r + m)) for r in range(20) for m in range(6)], "row int, mid int, value double")
    supply = spark.createDataFrame([(m, f"c{c}", float(m * c - 3)) for m in range(6) for c in range(8)], "mid int, col string, value double")
    right = [(r, f"c{c}", float(sum((r + m) * (m * c - 3) for m in range(6)))) for r in range(20) for c in range(8)]
    wrong = [(r, c, x + (1e-3 if (r, c) == (7, "c2") else 0.0)) for r, c, x in right]
    schema = "row int, col string, value double"
    assert {r["n_failed"] for r in background.probe(spark.createDataFrame(right, schema), direct, supply).collect()} == {0}
    rows = background.probe(spark.createDataFrame(wrong, schema), direct, supply)
    assert {r["row"] for r in rows.collect() if r["n_failed"]} == {7}
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") <= 4 and "Cartesian" not in plan and "NestedLoop" not in plan
