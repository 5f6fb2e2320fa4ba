"""Completeness of supply chains, vintage consistency, reasons of zero results, manifests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def completeness(chain: DataFrame, audit: DataFrame, external: DataFrame) -> DataFrame:
    """Per demand: activities by class, cut-offs over the audited ones, and whether all is linked.

    chain: demand_id, code; audit: code, bio_unmatched, tech_unlinked, tech_ambiguous; external: code
    of activities from aggregated builds, which need no audit.
    """
    rows = chain.join(external.select("code", F.lit(True).alias("outside")).distinct(), "code", "left").join(audit.withColumn("audited", F.lit(True)), "code", "left")
    own = F.col("outside").isNull()
    cutoffs = [F.coalesce(F.sum(F.when(own, F.col(c))), F.lit(0)).alias(c) for c in ("bio_unmatched", "tech_unlinked", "tech_ambiguous")]
    g = rows.groupBy("demand_id").agg(F.count(F.lit(1)).alias("n_activities"), F.count_if(~own).alias("n_external"), F.count_if(own & F.col("audited").isNotNull()).alias("n_audited"), F.count_if(own & F.col("audited").isNull()).alias("n_unaudited"), *cutoffs)
    return g.withColumn("fully_linked", (F.col("n_unaudited") == 0) & (F.col("bio_unmatched") + F.col("tech_unlinked") == 0))


def vintage_consistency(meta: DataFrame) -> DataFrame:
    """One row over build_meta (db, vintage): ok, unstamped or inconsistent."""
    g = meta.agg(F.count(F.lit(1)).alias("n_builds"), F.count("vintage").alias("n_stamped"), F.count_distinct("vintage").alias("n_vintages"))
    status = F.when(F.col("n_vintages") > 1, "inconsistent").when(F.col("n_stamped") < F.col("n_builds"), "unstamped").otherwise("ok")
    return g.withColumn("status", status)


def zero_reasons(activities: DataFrame, technosphere: DataFrame, biosphere: DataFrame, cf: DataFrame) -> DataFrame:
    """Per activity: exchange counts, characterised flows, and why a score could be zero."""
    flows = cf.select("flow_id", F.lit(True).alias("known")).distinct()
    tech = technosphere.groupBy(F.col("consumer").alias("code")).agg(F.count(F.lit(1)).alias("n_tech"))
    bio = biosphere.join(flows, "flow_id", "left").groupBy("code").agg(F.count(F.lit(1)).alias("n_bio"), F.count_if("known").alias("n_characterized"))
    rows = activities.select("code").join(tech, "code", "left").join(bio, "code", "left").fillna(0, ["n_tech", "n_bio", "n_characterized"])
    reason = F.when((F.col("n_tech") == 0) & (F.col("n_bio") == 0), "no exchanges").when(F.col("n_characterized") > 0, "characterised").when(F.col("n_bio") > 0, "no flow characterised").otherwise("inputs only")
    return rows.withColumn("reason", reason)


def uncharacterized(biosphere: DataFrame, cf: DataFrame) -> DataFrame:
    """Flows of each activity that no method knows."""
    return biosphere.join(cf.select("flow_id").distinct(), "flow_id", "left_anti").groupBy("code").agg(F.count_distinct("flow_id").alias("n_flows"))


def stale_sidecar(audit: DataFrame, meta: DataFrame) -> DataFrame:
    """Per database: audited activities against the stamped count."""
    g = audit.groupBy("db").agg(F.count(F.lit(1)).alias("n_audited"))
    return meta.select("db", "activity_count").join(g, "db", "left").select("db", "activity_count", F.coalesce("n_audited", F.lit(0)).alias("n_audited")).withColumn("stale", F.col("n_audited") != F.col("activity_count"))


def manifest(results: DataFrame, complete: DataFrame, meta: DataFrame) -> DataFrame:
    """One nested row per demand: scores, completeness and the builds behind them."""
    scored = results.groupBy("demand_id").agg(F.array_sort(F.collect_list(F.struct("method", "score"))).alias("scores"))
    builds = meta.agg(F.array_sort(F.collect_list(F.struct("db", "vintage"))).alias("builds"))
    chain = complete.select("demand_id", F.struct(*(c for c in complete.columns if c != "demand_id")).alias("completeness"))
    return scored.join(chain, "demand_id", "left").join(F.broadcast(builds), F.lit(True)).withColumn("engine", F.version())


def describe_builds(activities: DataFrame, meta: DataFrame) -> DataFrame:
    """Activities, stamped vintage and share of each build, and the other builds (a handful) with their activities."""
    counts = activities.groupBy("db").agg(F.count(F.lit(1)).alias("n_activities"))
    total = counts.agg(F.sum("n_activities").alias("n_all"), F.array_sort(F.collect_list(F.struct("db", "n_activities"))).alias("builds"))
    rest = F.filter("builds", lambda b: b["db"] != F.col("db"))
    others = F.array_join(F.transform(rest, lambda b: F.concat(b["db"], F.lit(": "), b["n_activities"].cast("string"))), ", ")
    return meta.join(counts, "db", "left").join(F.broadcast(total), F.lit(True)).select("db", "vintage", F.coalesce("n_activities", F.lit(0)).alias("n_activities"), F.try_divide("n_activities", "n_all").alias("share"), others.alias("other_builds"))


def source_lines(stamps: DataFrame) -> DataFrame:
    """db and one line on the files it was built from. stamps: db, is_full, name, sha256, release (null if the name has none).

    A build of the full source names it with the head of its hash; one of bundles counts them and lists
    their releases; one without stamped files is unstamped.
    """
    # The files of a build are a download's worth: their releases fit in one row.
    g = stamps.groupBy("db").agg(F.count("name").alias("n"), F.max("is_full").alias("full"), F.min(F.struct("name", "sha256")).alias("first"), F.array_sort(F.collect_set(F.substring("release", 1, 12))).alias("releases"))
    whole = F.concat(F.col("first.name"), F.lit(" (sha256 "), F.substring("first.sha256", 1, 12), F.lit(")"))
    release = F.when(F.size("releases") > 0, F.concat(F.lit(", release "), F.array_join("releases", ", "))).otherwise("")
    line = F.when(F.col("n") == 0, "unstamped").when(F.col("full"), whole).otherwise(F.concat(F.col("n").cast("string"), F.lit(" bundle files"), release))
    return g.select("db", line.alias("line"))


def build_report(parts: dict[str, DataFrame]) -> DataFrame:
    """build, item and n: the columns of one-row tables of counts laid under each other."""
    rows = [one.select(F.lit(build).alias("build"), F.explode(F.array(*(F.struct(F.lit(c).alias("item"), F.col(c).cast("long").alias("n")) for c in one.columns))).alias("x")) for build, one in parts.items()]
    return reduce(DataFrame.unionByName, rows).select("build", "x.item", "x.n")


def build_summaries(exchanges: DataFrame, meta: DataFrame, audit: DataFrame) -> DataFrame:
    """One row per build: activities, exchanges by type, link totals and the stamped vintage.

    exchanges: db, code, type; audit: db, tech_linked, tech_external, tech_unlinked.
    """
    counts = exchanges.groupBy("db").agg(F.count_distinct("code").alias("n_activities"), F.count(F.lit(1)).alias("n_exchanges"), *(F.count_if(F.col("type") == t).alias(f"n_{t}") for t in ("production", "technosphere", "biosphere")))
    links = audit.groupBy("db").agg(*(F.sum(c).alias(c) for c in ("tech_linked", "tech_external", "tech_unlinked")))
    return meta.select("db", "vintage").join(counts, "db", "left").join(links, "db", "left").fillna(0)
