"""Linking of technosphere exchanges to suppliers, by priority and without guessing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def candidates(internal: DataFrame, external: DataFrame) -> DataFrame:
    """Who supplies a flow: flow_id, supplier, supplier_name, supplier_db; each supplier once."""
    columns = ("flow_id", "supplier", "supplier_name", "supplier_db")
    return internal.select(*columns).unionByName(external.select(*columns)).distinct()


def resolve(exchanges: DataFrame, processes: DataFrame, external: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Adds supplier, supplier_db, how and ambiguous.

    The hint wins if it names a process, then if it names an external provider; then the only
    supplier of the flow; then the only one with exactly the hinted name. Several suppliers and none
    of these is ambiguous. Candidates are counted per flow first, so no exchange meets them all.
    """
    inside = processes.select(F.col("process_id").alias("p_id"), F.lit("process").alias("p_db")).distinct()
    # An id that two builds have is one provider, of the build whose name comes first.
    outside = external.groupBy(F.col("supplier").alias("x_id")).agg(F.min("supplier_db").alias("x_db"))
    per_flow = suppliers.groupBy(F.col("flow_id").alias("f_id")).agg(F.count(F.lit(1)).alias("f_n"), F.min(F.struct("supplier", "supplier_db")).alias("f_one"))
    per_name = suppliers.groupBy(F.col("flow_id").alias("n_flow"), F.col("supplier_name").alias("n_name")).agg(F.count(F.lit(1)).alias("n_n"), F.min(F.struct("supplier", "supplier_db")).alias("n_one")).where("n_n = 1")
    rows = exchanges.join(inside, F.col("provider_id") == F.col("p_id"), "left").join(outside, F.col("provider_id") == F.col("x_id"), "left")
    rows = rows.join(per_flow, F.col("flow_id") == F.col("f_id"), "left").join(per_name, (F.col("flow_id") == F.col("n_flow")) & (F.col("provider_name") == F.col("n_name")), "left")
    single = F.coalesce("f_n", F.lit(0)) == 1
    how = F.when(F.col("p_id").isNotNull(), "hint").when(F.col("x_id").isNotNull(), "external_hint").when(single, "single").when(F.col("n_one").isNotNull(), "name").otherwise("none")
    rows = rows.withColumn("how", how)
    pick = lambda hint, xhint, field: F.when(F.col("how") == "hint", hint).when(F.col("how") == "external_hint", xhint).when(F.col("how") == "single", F.col("f_one")[field]).when(F.col("how") == "name", F.col("n_one")[field])
    rows = rows.withColumn("supplier", pick(F.col("p_id"), F.col("x_id"), "supplier")).withColumn("supplier_db", pick(F.col("p_db"), F.col("x_db"), "supplier_db"))
    rows = rows.withColumn("ambiguous", (F.col("how") == "none") & (F.coalesce("f_n", F.lit(0)) > 1))
    return rows.drop("p_id", "p_db", "x_id", "x_db", "f_id", "f_n", "f_one", "n_flow", "n_name", "n_n", "n_one")


def rebase(links: DataFrame, coproducts: DataFrame, multipliers: DataFrame) -> DataFrame:
    """Links to a causal co-product go to its own activity; links to another co-product are re-based.

    coproducts: supplier, flow_id, coproduct_code; multipliers: supplier, flow_id, multiplier.
    """
    rows = links.join(coproducts, ["supplier", "flow_id"], "left").join(multipliers, ["supplier", "flow_id"], "left")
    amount = F.when(F.col("coproduct_code").isNotNull(), F.col("signed_amount")).otherwise(F.col("signed_amount") * F.coalesce("multiplier", F.lit(1.0)))
    return rows.withColumn("target", F.coalesce("coproduct_code", "supplier")).withColumn("amount_linked", amount)


#: Counters of a link tally.
COUNTERS = ("bio_matched", "bio_unmatched", "tech_linked", "tech_external", "tech_unlinked", "tech_ambiguous", "waste_links", "avoided_links", "coproduct_links", "causal_fallbacks")


def totals(tallies: DataFrame) -> DataFrame:
    """One row: processes, and the sum of every counter that tallies has."""
    return tallies.agg(F.count(F.lit(1)).alias("n_processes"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS if c in tallies.columns))


def coproduct_tally(rebased: DataFrame, causal: DataFrame) -> DataFrame:
    """Per process: links that go to a causal co-product, and exchanges of a causal process that fell back to the mass share.

    rebased: of `rebase`, with process_id; causal: of `allocation.causal_factors`.
    """
    links = rebased.groupBy("process_id").agg(F.count("coproduct_code").alias("coproduct_links"))
    fell = causal.groupBy("process_id").agg(F.count_if("fell_back").alias("causal_fallbacks"))
    return links.join(fell, "process_id", "full").fillna(0, ["coproduct_links", "causal_fallbacks"])


def tally(classified: DataFrame, flows: DataFrame) -> DataFrame:
    """Six counters of each process, and waste and avoided links.

    Every link counts as linked, external ones as external too; ambiguous ones are unlinked as well. Waste links
    are outputs that found their treatment; avoided links count whether they found a supplier or not.
    """
    listed = flows.select("flow_id", F.lit(True).alias("listed")).distinct()
    rows = classified.join(listed, "flow_id", "left")
    bio, tech = F.col("kind") == "biosphere", F.col("kind") == "technosphere"
    return rows.groupBy("process_id").agg(
        F.count_if(bio & F.col("listed").isNotNull()).alias("bio_matched"), F.count_if(bio & F.col("listed").isNull()).alias("bio_unmatched"),
        F.count_if(tech & F.col("supplier").isNotNull()).alias("tech_linked"), F.count_if(tech & (F.col("supplier_db") != "process")).alias("tech_external"),
        F.count_if(tech & F.col("supplier").isNull()).alias("tech_unlinked"), F.count_if(tech & F.col("ambiguous")).alias("tech_ambiguous"),
        F.count_if(tech & ~F.col("is_input") & F.col("supplier").isNotNull()).alias("waste_links"), F.count_if(tech & F.col("is_avoided")).alias("avoided_links"),
    )
