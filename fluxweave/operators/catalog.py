"""Catalogue: newest versions, reference flows, classification of exchanges, flow lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fluxweave.functions.text import categories, flow_kind, parse_version


def latest_version(rows: DataFrame, key: list[str], version: str, changed: str, order: list[str]) -> DataFrame:
    """The newest row of each key: by version parts, then last change; equal ones go to the first in `order`."""
    w = Window.partitionBy(*key).orderBy(parse_version(F.col(version)).desc(), F.col(changed).desc_nulls_last(), *order)
    return rows.withColumn("rank_", F.row_number().over(w)).where("rank_ = 1").drop("rank_")


def version_conflicts(rows: DataFrame, key: list[str], version: str, changed: str) -> DataFrame:
    """Keys whose rows differ in version or last change, with how many such pairs they have."""
    pair = F.struct(parse_version(F.col(version)), F.col(changed))
    return rows.groupBy(*key).agg(F.count_distinct(pair).alias("n_versions")).where("n_versions > 1")


def reference_flow_index(exchanges: DataFrame) -> DataFrame:
    """flow_id and process_id of the reference exchanges, either direction."""
    return exchanges.where(F.coalesce("is_ref", F.lit(False))).select("flow_id", "process_id").distinct()


def several_references(exchanges: DataFrame) -> DataFrame:
    """Processes with more than one reference exchange."""
    return exchanges.where("is_ref").groupBy("process_id").agg(F.count(F.lit(1)).alias("n_ref")).where("n_ref > 1")


def exchange_kind(flow_type: Column, is_input: Column, is_ref: Column) -> Column:
    """production, biosphere, technosphere, or null for product outputs that are dropped."""
    used = is_input & flow_type.isin("PRODUCT_FLOW", "WASTE_FLOW")
    return F.when(is_ref, "production").when(flow_type == "ELEMENTARY_FLOW", "biosphere").when(used | (flow_type == "WASTE_FLOW"), "technosphere")


def classify(exchanges: DataFrame) -> DataFrame:
    """Adds kind, and the signed amount: avoided products count negative on technosphere links only."""
    kind = exchange_kind(F.col("flow_type"), F.col("is_input"), F.col("is_ref"))
    rows = exchanges.withColumn("kind", kind)
    return rows.withColumn("signed_amount", F.when((F.col("kind") == "technosphere") & F.col("is_avoided"), -F.col("amount")).otherwise(F.col("amount")))


def match_biosphere(exchanges: DataFrame, flows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(exchanges whose flow is listed, those whose flow is not)."""
    listed = flows.select("flow_id").distinct()
    return exchanges.join(listed, "flow_id", "left_semi"), exchanges.join(listed, "flow_id", "left_anti")


def flow_census(flows: DataFrame) -> DataFrame:
    """Flows and distinct units by kind."""
    return flows.groupBy("kind").agg(F.count(F.lit(1)).alias("n_flows"), F.count_distinct("unit").alias("n_units"))


def flow_conflicts(flows: DataFrame, key: str, identity: list[str]) -> DataFrame:
    """Ids whose rows do not all say the same."""
    same = F.struct(*(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in identity))
    return flows.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(same).alias("n_identities")).where("n_identities > 1")


def jobs(processes: DataFrame, coproducts: DataFrame) -> DataFrame:
    """Activities to build: processes and causal co-products."""
    return processes.unionByName(coproducts, allowMissingColumns=True)


def elementary_flows(flows: DataFrame) -> DataFrame:
    """The flow list as flow_id, name, unit, categories, kind and cas (empty without one); repeated ids are one row."""
    context = F.coalesce("Context", F.lit(""))
    rows = flows.select(F.col("`Flow UUID`").alias("flow_id"), F.col("Flowable").alias("name"), F.col("Unit").alias("unit"), categories(context).alias("categories"), flow_kind(context, F.col("Class")).alias("kind"), F.coalesce(F.col("`CAS No`").cast("string"), F.lit("")).alias("cas"))
    return rows.dropDuplicates(["flow_id"])
