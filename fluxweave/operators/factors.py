"""Characterization factors: spatial filter, mapping, matching, last-wins, units, probes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluxweave.operators import guards


def filter_locations(raw: DataFrame, is_spatial: Column, chosen: str = "") -> DataFrame:
    """Methods with regional factors keep the chosen location, all others the generic rows."""
    place = F.coalesce("location", F.lit(""))
    return raw.where(F.when(is_spatial, place == chosen).otherwise(place == ""))


def drop_empty(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("cf").isNotNull() & ~F.isnan("cf") & F.col("flow_id").isNotNull())


def last_wins(rows: DataFrame) -> DataFrame:
    """The last factor, by row_index, of each method and flow; n_rows tells how many there were."""
    return rows.groupBy("method", "flow_id").agg(F.max_by("cf", "row_index").alias("cf"), F.count(F.lit(1)).alias("n_rows"))


def map_flows(raw: DataFrame, mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(factors with the mapped flow ids, rows without any). mapping: source_flow, flow_id, factor."""
    rows = raw.join(mapping.select("source_flow", F.col("flow_id").alias("m_flow"), F.col("factor").alias("m_factor")), "source_flow", "left")
    there = F.coalesce(F.trim(F.col("m_flow").cast("string")), F.lit("")) != ""
    mapped = rows.where(there).withColumn("flow_id", F.col("m_flow")).withColumn("cf", F.col("cf") * F.coalesce("m_factor", F.lit(1.0)))
    return mapped.drop("m_flow", "m_factor"), rows.where(~there).drop("m_flow", "m_factor")


def dropped_census(unmapped: DataFrame) -> DataFrame:
    return unmapped.groupBy("method", "source_flow").agg(F.count(F.lit(1)).alias("n_dropped"))


def method_units(raw: DataFrame, overrides: DataFrame) -> DataFrame:
    """Unit of each method: its only one, or the override; else status is conflict."""
    g = raw.groupBy("method").agg(F.count_distinct("unit").alias("n_units"), F.min("unit").alias("first"))
    rows = g.join(overrides.select("method", F.col("unit").alias("o_unit")), "method", "left")
    status = F.when(F.col("o_unit").isNotNull(), "override").when(F.col("n_units") == 1, "unique").otherwise("conflict")
    return rows.select("method", "n_units", status.alias("status"), F.coalesce("o_unit", F.when(F.col("n_units") == 1, F.col("first"))).alias("unit"))


def build_table(raw: DataFrame, flows: DataFrame, is_spatial: Column, chosen: str = "") -> DataFrame:
    """The factor table: spatial filter, empties out, known flows only, last row wins."""
    rows = drop_empty(filter_locations(raw, is_spatial, chosen))
    return last_wins(rows.join(flows.select("flow_id").distinct(), "flow_id", "left_semi"))


def build_methods(raw: DataFrame, flows: DataFrame, is_spatial: Column, overrides: DataFrame, chosen: str = "") -> DataFrame:
    """The factor table with the unit of each method. A method with several units and no override, or without any factor, is an error."""
    units = method_units(raw, overrides)
    guards.require_empty(units.where("status = 'conflict'"), "methods with several units")
    table = build_table(raw, flows, is_spatial, chosen)
    empty = raw.select("method").distinct().join(table.select("method").distinct(), "method", "left_anti")
    guards.require_empty(empty, "methods without factors")
    return table.join(units.select("method", "unit"), "method")


def match_counts(rows: DataFrame, flows: DataFrame) -> DataFrame:
    """Matched and unmatched factors of each method."""
    listed = flows.select("flow_id", F.lit(True).alias("listed")).distinct()
    return rows.join(listed, "flow_id", "left").groupBy("method").agg(F.count_if("listed").alias("n_matched"), F.count_if(F.col("listed").isNull()).alias("n_unmatched"))


def unmatched(rows: DataFrame, flows: DataFrame) -> DataFrame:
    return rows.join(flows.select("flow_id").distinct(), "flow_id", "left_anti")


def preflight(cf: DataFrame, probes: DataFrame) -> DataFrame:
    """probes: method, flow_id, low, high. Adds the factor and whether it lies in range (false if there is none)."""
    rows = probes.join(cf.select("method", "flow_id", "cf"), ["method", "flow_id"], "left")
    return rows.withColumn("passed", F.coalesce(F.col("cf").between(F.col("low"), F.col("high")), F.lit(False)))
