"""Aggregated background: external providers, vintage votes, lumped activities from a solved library."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def external_references(exchanges: DataFrame, processes: DataFrame) -> DataFrame:
    """source, provider_id, process_id of inputs whose hint lies outside the source.

    The flow must be no output reference of the source itself.
    """
    own = exchanges.where("is_ref and not is_input").select("source", "flow_id").distinct()
    used = exchanges.where(F.col("is_input") & F.col("flow_type").isin("PRODUCT_FLOW", "WASTE_FLOW") & F.col("provider_id").isNotNull())
    inside = processes.select("source", F.col("process_id").alias("provider_id")).distinct()
    return used.join(own, ["source", "flow_id"], "left_anti").join(inside, ["source", "provider_id"], "left_anti").select("source", "provider_id", "process_id").distinct()


def referrers(references: DataFrame) -> DataFrame:
    """How many distinct processes refer to each provider, over all sources."""
    return references.groupBy("provider_id").agg(F.count_distinct("process_id").alias("n_referrers"), F.count_distinct("source").alias("n_sources"))


def only_in(references: DataFrame, full: str) -> DataFrame:
    """Providers that only the full source refers to."""
    return references.groupBy("provider_id").agg(F.count_if(F.col("source") != full).alias("elsewhere")).where("elsewhere = 0").select("provider_id")


def scan_sources(references: DataFrame, grid: DataFrame, full: str) -> DataFrame:
    """Verdicts that count: those of the bundles, or that of the full source where no bundle has one."""
    verdicts = classify_sources(vintage_votes(references, grid)).where("verdict is not null").withColumn("is_full", F.col("source") == full)
    bundles = verdicts.agg(F.count_if(~F.col("is_full")).alias("n_bundles"))
    return verdicts.join(F.broadcast(bundles), F.lit(True)).where(~F.col("is_full") | (F.col("n_bundles") == 0)).select("source", "verdict")


def external_index(activities: DataFrame, db: str, vintage: str) -> DataFrame:
    """What the linker knows of an aggregated build: supplier, name, the flow it supplies, and the vintage."""
    rows = activities.where(F.col("db") == db)
    return rows.select(F.col("code").alias("supplier"), F.col("name").alias("supplier_name"), F.col("ref_flow_id").alias("flow_id"), F.lit(db).alias("supplier_db"), F.lit(vintage).alias("vintage"))


def vintage_votes(references: DataFrame, grid: DataFrame) -> DataFrame:
    """Per source and vintage, the distinct processes that refer to its grid node."""
    votes = references.join(grid.select("provider_id", "vintage"), "provider_id")
    return votes.groupBy("source", "vintage").agg(F.count_distinct("process_id").alias("votes"))


def classify_sources(votes: DataFrame) -> DataFrame:
    """Verdict of each source: the vintage with strictly most votes; null for a tie or none."""
    best = votes.groupBy("source").agg(F.max("votes").alias("most"))
    top = votes.join(best, "source").where("votes = most and most > 0").groupBy("source").agg(F.count(F.lit(1)).alias("n_top"), F.min("vintage").alias("top"))
    return best.join(top, "source", "left").select("source", F.when(F.col("n_top") == 1, F.col("top")).alias("verdict"))


def decide_vintage(verdicts: DataFrame, explicit: str | None = None, default: str | None = None, full: str | None = None) -> DataFrame:
    """One row: vintage and reason (explicit, unanimous, conflict, full source, default, undecided).

    The verdict of the source `full` counts only where no other source has one; it goes before the default.
    """
    other = F.lit(True) if full is None else F.col("source") != full
    g = verdicts.agg(F.count_distinct(F.when(other, F.col("verdict"))).alias("n"), F.min(F.when(other, F.col("verdict"))).alias("v"), F.max(F.when(~other, F.col("verdict"))).alias("f"))
    reason = F.when(F.lit(explicit is not None), "explicit").when(F.col("n") == 1, "unanimous").when(F.col("n") > 1, "conflict").when(F.col("f").isNotNull(), "full source").when(F.lit(default is not None), "default").otherwise("undecided")
    rows = g.withColumn("reason", reason)
    vintage = F.when(F.col("reason") == "explicit", F.lit(explicit)).when(F.col("reason") == "unanimous", F.col("v").cast("string")).when(F.col("reason") == "full source", F.col("f").cast("string")).when(F.col("reason") == "default", F.lit(default))
    return rows.select("reason", vintage.cast("string").alias("vintage"), F.col("n").alias("n_verdicts"))


def library_inventory(inventory: DataFrame, flows: DataFrame, elementary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(process_id, flow_id, amount summed over locations without zero sums; what was dropped and why)."""
    rows = inventory.join(flows, "row")
    kept = rows.where(F.col("flow_type") == "ELEMENTARY_FLOW")
    listed = elementary.select("flow_id").distinct()
    sums = kept.join(listed, "flow_id", "left_semi").groupBy("process_id", "flow_id").agg(F.sum("value").alias("amount")).where("amount <> 0")
    other = rows.where(F.col("flow_type") != "ELEMENTARY_FLOW").withColumn("reason", F.lit("not elementary"))
    missing = kept.join(listed, "flow_id", "left_anti").withColumn("reason", F.lit("not listed"))
    dropped = other.unionByName(missing).groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("flow_id").alias("n_flows"))
    return sums, dropped


def lumped_activities(processes: DataFrame, inventory: DataFrame, db: str) -> DataFrame:
    """Exchanges of one activity per library process: production of 1 of its reference flow, and its whole inventory.

    processes: process_id, ref_flow_id; ref_flow_id of the result is null on biosphere rows.
    """
    production = processes.select(F.lit(db).alias("db"), F.col("process_id").alias("code"), F.col("process_id").alias("input_code"), F.lit(1.0).alias("amount"), F.lit("production").alias("type"), "ref_flow_id")
    biosphere = inventory.select(F.lit(db).alias("db"), F.col("process_id").alias("code"), F.col("flow_id").alias("input_code"), "amount", F.lit("biosphere").alias("type"))
    return production.unionByName(biosphere, allowMissingColumns=True)


def provider_status(references: DataFrame, library: DataFrame, full: str) -> DataFrame:
    """Each referenced provider: in the library, missing and referenced by a bundle, or missing and only in the full source."""
    g = references.groupBy("provider_id").agg(F.count_if(F.col("source") != full).alias("in_bundles"))
    rows = g.join(library.select(F.col("process_id").alias("provider_id"), F.lit(True).alias("there")).distinct(), "provider_id", "left")
    status = F.when(F.col("there").isNotNull(), "resolved").when(F.col("in_bundles") > 0, "missing_bundle").otherwise("missing_full_only")
    return rows.select("provider_id", status.alias("status"))


def consistency(cumulative: DataFrame, direct: DataFrame, supply: DataFrame) -> DataFrame:
    """Largest relative error of M = B * INV by column.

    cumulative: row, col, value (M); direct: row, mid, value (B); supply: mid, col, value (INV).
    """
    made = direct.withColumnRenamed("value", "b").join(supply.withColumnRenamed("value", "s"), "mid").groupBy("row", "col").agg(F.sum(F.col("b") * F.col("s")).alias("made"))
    rows = cumulative.join(made, ["row", "col"], "full")
    error = F.abs(F.coalesce("value", F.lit(0.0)) - F.coalesce("made", F.lit(0.0))) / F.greatest(F.abs(F.coalesce("value", F.lit(0.0))), F.lit(1e-30))
    return rows.groupBy("col").agg(F.max(error).alias("max_error"), F.count(F.lit(1)).alias("n_rows"))


def probe(cumulative: DataFrame, direct: DataFrame, supply: DataFrame, probes: int = 16, tolerance: float = 1e-9) -> DataFrame:
    """row, n_probes, n_failed: whether cumulative (row, col, value) is direct (row, mid, value) times supply (mid, col, value).

    Freivalds' test: a probe gives every column a sign, by a hash of its name, and compares M r with B (S r),
    so the product is never formed; a wrong row passes a probe with a chance of a half at most. Two matrices cost
    one pass each for all probes together.
    """
    def signed(value, i):
        return F.when(F.substring(F.md5(F.concat_ws("/", F.col("col").cast("string"), F.lit(str(i))).cast("binary")), 1, 1) < "8", value).otherwise(-value)

    sums = lambda df, key: df.groupBy(key).agg(*(F.sum(signed(F.col("value"), i)).alias(f"r{i}") for i in range(probes)), F.sum(F.abs("value")).alias("size"))
    short = sums(supply, "mid")
    made = direct.join(short, "mid").groupBy("row").agg(*(F.sum(F.col("value") * F.col(f"r{i}")).alias(f"m{i}") for i in range(probes)), F.sum(F.abs("value") * F.col("size")).alias("made_size"))
    rows = sums(cumulative, "row").join(made, "row", "full")
    scale = F.coalesce("size", F.lit(0.0)) + F.coalesce("made_size", F.lit(0.0))
    failed = [F.when(F.abs(F.coalesce(f"r{i}", F.lit(0.0)) - F.coalesce(f"m{i}", F.lit(0.0))) > tolerance * scale, 1).otherwise(0) for i in range(probes)]
    return rows.select("row", F.lit(probes).alias("n_probes"), sum(failed[1:], failed[0]).alias("n_failed"))
