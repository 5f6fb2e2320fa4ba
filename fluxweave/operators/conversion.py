"""Flow-property conversions: reference inference, factors, gap filling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reference_property(properties: DataFrame) -> DataFrame:
    """Reference property of each flow: the flagged one, else the only one with factor 1.

    properties: flow_id, pos, fp_id, ref_unit, factor, flagged. status is flagged, inferred, ambiguous
    (several factors of 1), bad_factor (a flagged factor that is not 1) or missing.
    """
    one = F.coalesce("factor", F.lit(1.0)) == 1.0
    flagged = F.coalesce("flagged", F.lit(False))
    g = properties.groupBy("flow_id").agg(
        F.count_if(flagged).alias("n_flagged"), F.count_if(one).alias("n_one"),
        F.min_by(F.struct("fp_id", "ref_unit", "factor"), F.when(flagged, F.col("pos"))).alias("first"),
        F.min_by(F.struct("fp_id", "ref_unit", "factor"), F.when(one, F.col("pos"))).alias("only"),
    )
    bad = F.coalesce(F.col("first.factor"), F.lit(1.0)) != 1.0
    status = F.when(F.col("n_flagged") > 0, F.when(bad, "bad_factor").otherwise("flagged")).when(F.col("n_one") > 1, "ambiguous").when(F.col("n_one") == 1, "inferred").otherwise("missing")
    chosen = F.when(F.col("n_flagged") > 0, F.col("first")).when(F.col("n_one") == 1, F.col("only"))
    return g.select("flow_id", status.alias("status"), chosen["fp_id"].alias("ref_fp_id"), chosen["ref_unit"].alias("ref_unit"))


def conversion_rows(properties: DataFrame, references: DataFrame) -> DataFrame:
    """flow_id, fp_id, factor of every property but the reference; a missing factor is 1."""
    good = references.where(F.col("status").isin("flagged", "inferred")).select("flow_id", "ref_fp_id")
    return properties.join(good, "flow_id").where(F.col("fp_id") != F.col("ref_fp_id")).select("flow_id", "fp_id", F.coalesce("factor", F.lit(1.0)).alias("factor"))


def fill_gaps(primary: DataFrame, supplement: DataFrame, order: str) -> DataFrame:
    """primary, and flows it lacks from the first supplement that has them; origin says which."""
    lacking = supplement.join(primary.select("flow_id").distinct(), "flow_id", "left_anti")
    columns = [c for c in primary.columns if c != "flow_id"]
    first = lacking.groupBy("flow_id").agg(F.min_by(F.struct(*columns), order).alias("s")).select("flow_id", "s.*")
    return primary.withColumn("origin", F.lit("primary")).unionByName(first.select(*primary.columns).withColumn("origin", F.lit("supplement")))


def census(filled: DataFrame, factors: DataFrame) -> DataFrame:
    """One row: flows, flows with several properties, flows added by supplements."""
    several = factors.select("flow_id").distinct().withColumn("several", F.lit(True))
    return filled.join(several, "flow_id", "left").agg(F.count(F.lit(1)).alias("n_flows"), F.count_if("several").alias("n_multi_property"), F.count_if(F.col("origin") == "supplement").alias("n_added"))
