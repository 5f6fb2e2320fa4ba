"""Units, names, versions and their traps."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from fluxweave.functions import text, units

CONV = "flow_id string, ref_fp_id string, ref_unit string"
FACT = "flow_id string, fp_id string, factor double"
EX = "amount double, unit string, fp_id string, flow_id string"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.createDataFrame([("diesel", "volume", "m3")], CONV), spark.createDataFrame([("diesel", "mass", 849.0), ("diesel", "energy", 38462.0)], FACT)


@pytest.mark.parametrize(
    ("row", "amount", "unit", "known", "stuck"),
    [
        ((1500.0, "g", "mass", "other"), 1.5, "g", True, False),
        ((849.0, "kg", "mass", "diesel"), 1.0, "m3", True, False),
        ((1000.0, "l", "volume", "diesel"), 1.0, "m3", True, False),
        ((1.0, "Mg", "mass", "other"), 1000.0, "Mg", True, False),
        ((1.0, "mg", "mass", "other"), 1e-6, "mg", True, False),
        ((3.0, "furlong", "length", "diesel"), 3.0, "furlong", False, False),
        ((5.0, "m", "length", "diesel"), 5.0, "m3", True, True),
    ],
)
def test_normalize(spark, tables, row, amount, unit, known, stuck):
    got = units.normalize(spark.createDataFrame([row], EX), *tables).first()
    assert got["amount_ref"] == pytest.approx(amount, rel=1e-12)
    assert (got["unit_ref"], got["known_unit"], got["unconverted"]) == (unit, known, stuck)


def test_elementary_flows_never_cross_properties(spark, tables):
    got = units.normalize(spark.createDataFrame([(849.0, "kg", "mass", "diesel")], EX), *tables, cross_property=False).first()
    assert (got["amount_ref"], got["unit_ref"]) == (849.0, "kg")


def test_unknown_units_gather_only_examples(spark):
    """Of many flows only the smallest three are gathered; a null flow or unit counts."""
    rows = [("bushel", f"f{i:05d}") for i in range(5000)] * 2 + [("bushel", None), (None, "x"), (None, None)]
    found = units.unknown_units(spark.createDataFrame([(u, f, False) for u, f in rows], "unit string, flow_id string, known_unit boolean"))
    assert {tuple(r) for r in found.collect()} == {("bushel", 10001, 5001, "f00000,f00001,f00002", 4998), (None, 2, 2, "x", 0)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set(flow_id" not in plan and "row_number" in plan


def test_unknown_units_say_where(spark, tables):
    rows = spark.createDataFrame([(1.0, "furlong", "x", f) for f in "abcd"] + [(1.0, None, "x", "a")], EX)
    got = {r["unit"]: r for r in units.unknown_units(units.normalize(rows, *tables)).collect()}
    assert got["furlong"]["examples"] == "a,b,c" and got["furlong"]["rest"] == 1 and got[None]["n_flows"] == 1


@pytest.mark.parametrize(
    ("unit", "ref", "status", "value"),
    [("g", "kg", "converted", 2e-3), ("KG", "kg", "same", 2.0), ("Mg", "kg", "converted", 2000.0), ("mg", "Mg", "converted", 2e-9), ("h", "kg", "incompatible", None), ("kcal", "kg", "incompatible", None), ("ft2", "kg", "incompatible", None), ("ha*a", "kg", "incompatible", None), ("bushel", "kg", "unknown", None), ("x", "", "same", 2.0)],
)
def test_convert_or_refuse(spark, unit, ref, status, value):
    got = units.convert_or_refuse(spark.createDataFrame([(2.0, unit, ref)], "amount double, unit string, ref_unit string")).first()
    assert got["status"] == status
    assert got["converted"] == (None if value is None else pytest.approx(value))


def test_text_rules(spark):
    rows = spark.createDataFrame([("00.01.014", " My Process ", "Congo (the)", "air/ urban air/", "Steel; billets")], "v string, n string, l string, c string, h string")
    got = rows.select(text.parse_version(F.col("v")).alias("v"), text.name_uuid(F.col("n")).alias("u"), text.location_code(F.col("l")).alias("l"), text.categories(F.col("c")).alias("c"), text.head_segment(F.col("h")).alias("h"), text.functional_unit(F.lit("")).alias("f")).first()
    assert got["v"] == [0, 1, 14] and got["l"] == "Congo" and got["c"] == ["air", "urban air"] and got["h"] == "steel" and got["f"] == "unit"
    assert got["u"] == str(uuid.uuid5(uuid.UUID(text.NAMESPACE), "my process"))


def test_blank_location_and_context(spark):
    rows = spark.createDataFrame([("", None), (None, " / "), ("Northern America", "a")], "l string, c string")
    got = rows.select(text.location_code(F.col("l")), text.categories(F.col("c"))).collect()
    assert [tuple(r) for r in got] == [("GLO", ["unspecified"]), ("GLO", ["unspecified"]), ("RNA", ["a"])]
