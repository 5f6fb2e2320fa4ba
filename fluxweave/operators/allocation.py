"""Allocation of multi-output processes: native, mass, causal; co-product multipliers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def product_outputs(exchanges: DataFrame) -> DataFrame:
    return exchanges.where(~F.col("is_input") & (F.col("flow_type") == "PRODUCT_FLOW"))


def output_mass(ref_property, mass_property, amount, factor):
    """Mass of an output: its amount if it is measured in mass, times the mass factor if it has one, else 0."""
    return F.when(ref_property == mass_property, amount).when(factor.isNotNull(), amount * factor).otherwise(0.0)


def mass_fractions(outputs: DataFrame) -> DataFrame:
    """Adds mass_fraction: each output's share of its process's positive masses (null without any)."""
    total = outputs.groupBy("process_id").agg(F.sum(F.when(F.col("mass") > 0, F.col("mass"))).alias("mass_total"))
    return outputs.join(total, "process_id").withColumn("mass_fraction", F.try_divide(F.when(F.col("mass") > 0, F.col("mass")).otherwise(0.0), "mass_total")).drop("mass_total")


def native_factors(factors: DataFrame) -> DataFrame:
    """The first factor of each process, declared method and product that is tied to no exchange."""
    return factors.where("internal_id is null").groupBy("process_id", "allocation_type", "product_flow_id").agg(F.min_by("value", "pos").alias("native_factor"))


#: Declared methods whose factors belong to exchanges.
CAUSAL = ("CAUSAL", "CAUSAL_ALLOCATION")


def decide(outputs: DataFrame, natives: DataFrame, declared: DataFrame) -> DataFrame:
    """process_id, ref_flow, n_outputs, method (single, causal, native, mass, failed) and the reference's factor.

    outputs: process_id, flow_id, is_ref, mass_fraction; natives: process_id, allocation_type,
    product_flow_id, native_factor; declared: process_id, allocation_type of every process. The declared
    method is asked first: a process is causal if and only if it says so, whatever other factors it has; its
    factor, for exchanges without their own, is the reference's mass fraction, or 1 without any mass. At most one
    output is single with 1, also where the reference is an input (then ref_flow is null). Several
    outputs without a reference, or without a factor and a mass of the reference, have failed.
    """
    g = outputs.groupBy("process_id").agg(F.count(F.lit(1)).alias("n_outputs"), F.max(F.when(F.col("is_ref"), F.col("flow_id"))).alias("ref_flow"), F.max(F.when(F.col("is_ref"), F.col("mass_fraction"))).alias("ref_mass"))
    rows = declared.select("process_id", "allocation_type").join(g, "process_id", "full").withColumn("n_outputs", F.coalesce("n_outputs", F.lit(0)))
    rows = rows.join(natives.withColumnRenamed("product_flow_id", "ref_flow"), ["process_id", "allocation_type", "ref_flow"], "left")
    method = F.when(F.col("n_outputs") <= 1, "single").when(F.col("ref_flow").isNull(), "failed").when(F.col("allocation_type").isin(*CAUSAL), "causal").when(F.col("native_factor").isNotNull(), "native").when(F.col("ref_mass") > 0, "mass").otherwise("failed")
    rows = rows.withColumn("method", method)
    factor = F.when(F.col("method") == "single", 1.0).when(F.col("method") == "native", F.col("native_factor")).when(F.col("method") == "mass", F.col("ref_mass")).when(F.col("method") == "causal", F.coalesce("ref_mass", F.lit(1.0)))
    return rows.select("process_id", "ref_flow", "n_outputs", "method", factor.alias("factor"))


def normalized_outputs(normalized: DataFrame, conversions: DataFrame, factors: DataFrame, mass: str = "mass") -> DataFrame:
    """process_id, flow_id, is_ref, amount (in the flow's reference unit), mass and mass_fraction of product outputs.

    normalized: of `units.normalize`; conversions and factors as there. A flow that a process gives in
    several exchanges is one output with their sum.
    """
    outputs = product_outputs(normalized).groupBy("process_id", "flow_id").agg(F.max(F.coalesce("is_ref", F.lit(False))).alias("is_ref"), F.sum("amount_ref").alias("amount"))
    to_mass = factors.where(F.col("fp_id") == mass).select("flow_id", F.col("factor").alias("mass_factor"))
    rows = outputs.join(conversions.select("flow_id", "ref_fp_id"), "flow_id", "left").join(to_mass, "flow_id", "left")
    return mass_fractions(rows.withColumn("mass", output_mass(F.col("ref_fp_id"), F.lit(mass), F.col("amount"), F.col("mass_factor"))).drop("ref_fp_id", "mass_factor"))


def shares(outputs: DataFrame, natives: DataFrame, declared: DataFrame, decisions: DataFrame) -> DataFrame:
    """outputs with share: by the method that its process's reference was allocated with, native or mass."""
    rows = outputs.join(decisions.where("method in ('native', 'mass')").select("process_id", "method"), "process_id").join(declared.select("process_id", "allocation_type"), "process_id", "left")
    rows = rows.join(natives.withColumnRenamed("product_flow_id", "flow_id"), ["process_id", "allocation_type", "flow_id"], "left")
    return rows.withColumn("share", F.when(F.col("method") == "native", F.col("native_factor")).otherwise(F.col("mass_fraction"))).drop("allocation_type", "native_factor", "method")


def causal_coproducts(outputs: DataFrame, decisions: DataFrame) -> DataFrame:
    """process_id, co_flow and fallback (for exchanges without a factor) of what causal processes make beside their reference."""
    causal = decisions.where("method = 'causal'").select("process_id", "ref_flow")
    rows = outputs.join(causal, "process_id").where(F.col("flow_id") != F.col("ref_flow"))
    return rows.select("process_id", F.col("flow_id").alias("co_flow"), F.coalesce("mass_fraction", F.lit(1.0)).alias("fallback"))


def causal_factors(exchanges: DataFrame, columns: DataFrame, fallback: DataFrame) -> DataFrame:
    """Factor of each exchange for each product of a causal process.

    exchanges: process_id, internal_id; columns: process_id, product_flow_id, internal_id, value;
    fallback: process_id, product_flow_id, mass_fraction for exchanges that no row names; 1 without any mass.
    """
    wide = exchanges.join(fallback, "process_id")
    rows = wide.join(columns, ["process_id", "product_flow_id", "internal_id"], "left")
    return rows.withColumn("factor", F.coalesce("value", "mass_fraction", F.lit(1.0))).withColumn("fell_back", F.col("value").isNull())


def multipliers(outputs: DataFrame) -> DataFrame:
    """m = ref_yield * share / (yield * ref_share) of every product that is not the reference.

    outputs: process_id, flow_id, is_ref, amount, share. Uncomputable ones (a zero or unknown yield or
    reference share) have a null multiplier and skipped = true.
    """
    ref = outputs.where("is_ref").select("process_id", F.col("amount").alias("ref_amount"), F.col("share").alias("ref_share"))
    rows = outputs.where("not is_ref").join(ref, "process_id")
    below = F.nullif(F.col("amount") * F.col("ref_share"), F.lit(0.0))
    m = F.when(F.col("ref_amount") != 0, F.col("ref_amount") * F.col("share") / below)
    return rows.withColumn("multiplier", m).withColumn("skipped", F.col("multiplier").isNull())


def plan_census(decisions: DataFrame, multiplied: DataFrame) -> DataFrame:
    """One row: processes by method, and co-products with a multiplier and without one that can be computed."""
    methods = ("single", "native", "mass", "causal", "failed")
    planned = decisions.agg(*(F.count_if(F.col("method") == m).alias(f"n_{m}") for m in methods))
    scaled = multiplied.agg(F.count_if(~F.col("skipped")).alias("n_multipliers"), F.count_if("skipped").alias("n_skipped"))
    return planned.join(F.broadcast(scaled), F.lit(True))


def census(decisions: DataFrame) -> DataFrame:
    """Processes and outputs by method; degenerate ones have a factor of 0 or 1 though they make several products."""
    degenerate = (F.col("n_outputs") > 1) & F.col("factor").isin(0.0, 1.0)
    return decisions.groupBy("method").agg(F.count(F.lit(1)).alias("n_processes"), F.sum("n_outputs").alias("n_outputs"), F.count_if(degenerate).alias("n_degenerate"))
