"""Registered queries of builds: totals of links and plans, vintages, units of methods, descriptions, catalogue."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluxweave.functions.text import flow_kind
from fluxweave.operators import allocation, audit, background, compare, factors, linking
from fluxweave.plans.lineage import new_path
from fluxweave.plans.queries import _ALLOC, _SPATIAL, _VERDICT, SQL, _decided, _linked, _votes, query, rounded
from fluxweave.plans.views import Views, with_views
from fluxweave.sources import readers, sinks

# --- links and allocation -----------------------------------------------------------------------------------


@query(f"""SELECT COUNT(*) AS n_processes, {", ".join(f"CAST(SUM({c}) AS BIGINT) AS {c}" for c in linking.COUNTERS[:8])} FROM ({SQL["link_tally"]}) t""")
def link_totals(v: Views) -> DataFrame:
    listed = v.spark.sql("SELECT p_brand AS flow_id FROM part GROUP BY p_brand HAVING MIN(p_retailprice) > 901")
    return linking.totals(linking.tally(_linked(v), listed))


_COPRODUCT = f"""SELECT coalesce(a.process_id, b.process_id) AS process_id, coalesce(coproduct_links, 0) AS coproduct_links, coalesce(causal_fallbacks, 0) AS causal_fallbacks FROM
  (SELECT process_id, COUNT(*) FILTER (WHERE target LIKE '%__co__%') AS coproduct_links FROM ({SQL["causal_coproduct_links"]}) l GROUP BY process_id) a FULL JOIN
  (SELECT process_id, COUNT(*) FILTER (WHERE fell_back) AS causal_fallbacks FROM ({SQL["alloc_causal"]}) c GROUP BY process_id) b ON a.process_id = b.process_id"""


def _coproduct_tally(v: Views) -> DataFrame:
    links = v.spark.sql("SELECT l_orderkey AS process_id, l_partkey AS flow_id, l_orderkey AS supplier, l_quantity AS signed_amount FROM lineitem")
    mult = allocation.multipliers(v.product.withColumn("share", F.col("price_share"))).select(F.col("process_id").alias("supplier"), "flow_id", "multiplier")
    causal = v.declared.where("allocation_type = 'CAUSAL'").select(F.col("process_id").alias("supplier"))
    coproducts = mult.join(causal, "supplier").select("supplier", "flow_id", F.col("flow_id").cast("string").alias("coproduct_code"))
    columns = v.factor.where("internal_id is not null").select("process_id", "product_flow_id", "internal_id", "value")
    exchanges = v.raw_exchange.select("process_id", "internal_id").join(v.declared.where("allocation_type = 'CAUSAL'").select("process_id"), "process_id", "left_semi")
    shares = allocation.mass_fractions(v.product).select("process_id", F.col("flow_id").alias("product_flow_id"), "mass_fraction")
    return linking.coproduct_tally(linking.rebase(links, coproducts, mult), allocation.causal_factors(exchanges, columns, shares))


@query(_COPRODUCT)
def coproduct_tally(v: Views) -> DataFrame:
    return _coproduct_tally(v)


@query(f"SELECT COUNT(*) AS n_processes, CAST(SUM(coproduct_links) AS BIGINT) AS coproduct_links, CAST(SUM(causal_fallbacks) AS BIGINT) AS causal_fallbacks FROM ({_COPRODUCT}) t")
def coproduct_totals(v: Views) -> DataFrame:
    return linking.totals(_coproduct_tally(v))


# Amounts of the first products are zero here, so that some multipliers cannot be computed.
_SKIPPED = "none AS (SELECT process_id, flow_id, is_ref, CASE WHEN flow_id % 10 = 0 THEN 0 ELSE amount END AS amount, price_share AS share FROM product)"


@query(with_views("""SELECT d.*, m.* FROM (SELECT COUNT(*) FILTER (WHERE method = 'single') AS n_single, COUNT(*) FILTER (WHERE method = 'native') AS n_native, COUNT(*) FILTER (WHERE method = 'mass') AS n_mass, COUNT(*) FILTER (WHERE method = 'causal') AS n_causal, COUNT(*) FILTER (WHERE method = 'failed') AS n_failed FROM dec) d,
(SELECT COUNT(*) FILTER (WHERE r.amount <> 0 AND o.amount * r.share <> 0) AS n_multipliers, COUNT(*) FILTER (WHERE NOT (r.amount <> 0 AND o.amount * r.share <> 0)) AS n_skipped FROM none o JOIN none r ON r.process_id = o.process_id AND r.is_ref WHERE NOT o.is_ref) m""", "product", "declared", "factor", recursive=f"{_ALLOC}, {_SKIPPED}"))  # fmt: skip
def allocation_plan(v: Views) -> DataFrame:
    outputs = v.product.select("process_id", "flow_id", "is_ref", F.when(F.col("flow_id") % 10 == 0, 0).otherwise(F.col("amount")).alias("amount"), F.col("price_share").alias("share"))
    return allocation.plan_census(_decided(v), allocation.multipliers(outputs))


# --- vintages -----------------------------------------------------------------------------------------------

_TIED = "CASE WHEN source <> 'click' THEN NULL ELSE verdict END"


@query(with_views(f"""
SELECT 'explicit' AS wanted, 'explicit' AS reason, '2030' AS vintage, COUNT(DISTINCT verdict) AS n_verdicts FROM verdict
UNION ALL SELECT 'full source', CASE WHEN COUNT({_TIED}) > 0 THEN 'full source' ELSE 'default' END, coalesce(MAX({_TIED}), '2025'), 0 FROM verdict
UNION ALL SELECT 'default', 'default', '2025', 0
UNION ALL SELECT 'nothing', 'undecided', NULL, 0
UNION ALL SELECT 'unanimous', CASE WHEN COUNT(verdict) > 0 THEN 'unanimous' ELSE 'undecided' END, CASE WHEN COUNT(verdict) > 0 THEN '2026' END, CASE WHEN COUNT(verdict) > 0 THEN 1 ELSE 0 END FROM verdict
UNION ALL SELECT 'conflict', 'conflict', NULL, 2""", "grid_reference", recursive=_VERDICT))  # fmt: skip
def vintage_choices(v: Views) -> DataFrame:
    """The decision by what is known: the verdicts of the sources, changed so that each reason occurs."""
    verdicts = background.classify_sources(_votes(v))
    none = verdicts.withColumn("verdict", F.lit(None).cast("string"))
    known = F.col("verdict").isNotNull()
    cases = {
        "explicit": background.decide_vintage(verdicts, explicit="2030", default="2025"),
        "full source": background.decide_vintage(verdicts.withColumn("verdict", F.when(F.col("source") == "click", F.col("verdict"))), default="2025", full="click"),
        "default": background.decide_vintage(none, default="2025", full="click"),
        "nothing": background.decide_vintage(none),
        "unanimous": background.decide_vintage(verdicts.withColumn("verdict", F.when(known, "2026"))),
        "conflict": background.decide_vintage(v.spark.sql("SELECT event_type AS source, CAST(2025 + event_id % 2 AS STRING) AS verdict FROM events"), default="2025"),
    }
    parts = [rows.select(F.lit(name).alias("wanted"), "reason", "vintage", "n_verdicts") for name, rows in cases.items()]
    return reduce(DataFrame.unionByName, parts)


@query("SELECT o_orderstatus AS db, COUNT(*) AS activity_count, (SELECT CAST(MAX(o_orderkey) AS VARCHAR) FROM orders WHERE o_orderpriority LIKE '1%') AS vintage FROM orders GROUP BY 1")
def inherited_vintage(v: Views) -> DataFrame:
    """Builds stamped with the vintage of the background they rest on."""
    path = new_path(v.spark, "meta")
    meta = v.spark.sql("SELECT o_orderpriority AS db, CAST(MAX(o_orderkey) AS STRING) AS vintage FROM orders GROUP BY 1")
    first = meta.where("db LIKE '1%'").first()
    counts = v.spark.sql("SELECT o_orderstatus AS db, COUNT(*) AS activity_count FROM orders GROUP BY 1")
    sinks.stamp_build(sinks.inherit_vintage(counts, meta, first["db"] if first else ""), path)
    return readers.read_stored(v.spark, path)


# --- factors and units --------------------------------------------------------------------------------------


@query(with_views(f"SELECT method, flow_id, round(arg_max(cf, row_index), 6) AS cf, COUNT(*) AS n_rows, concat(method, ' eq') AS unit FROM raw_cf WHERE (CASE WHEN {_SPATIAL} THEN location = 'CHINA' ELSE location = '' END) AND cf IS NOT NULL AND flow_id IN (SELECT flow_id FROM elementary) AND NOT ({_SPATIAL}) GROUP BY 1, 2", "raw_cf", "elementary"))
def cf_methods(v: Views) -> DataFrame:
    """The generic methods, each with factors and the unit given for it."""
    overrides = v.spark.sql("SELECT r_name AS method, concat(r_name, ' eq') AS unit FROM region")
    generic = v.raw_cf.where(f"NOT ({_SPATIAL})")
    return rounded(factors.build_methods(generic, v.elementary, F.expr(_SPATIAL), overrides, "CHINA"))


@query("SELECT p_partkey AS code, round((1 + p_partkey % 4) * CASE WHEN p_size % 3 = 0 THEN 700.0 + p_size ELSE 1.0 END, 6) AS kg_per_run FROM part")
def kg_per_run(v: Views) -> DataFrame:
    production = v.spark.sql("SELECT p_partkey AS code, CAST(1 + p_partkey % 4 AS DOUBLE) AS amount, CASE WHEN p_size % 6 = 0 THEN 'm3' WHEN p_size % 3 = 0 THEN ' Cubic meter ' WHEN p_size % 3 = 1 THEN 'KG' END AS unit FROM part")
    densities = v.spark.sql("SELECT p_partkey AS code, 700D + p_size AS density FROM part WHERE p_size % 3 = 0")
    return rounded(compare.kg_per_run(production, densities))


# --- descriptions and catalogue -----------------------------------------------------------------------------


@query("""SELECT db, CASE WHEN n = 0 THEN 'unstamped' WHEN db % 5 = 1 THEN concat(one, ' (sha256 ', substr(sha256(one), 1, 12), ')') ELSE concat(CAST(n AS VARCHAR), ' bundle files', CASE WHEN releases IS NULL THEN '' ELSE concat(', release ', releases) END) END AS line FROM (
  SELECT c_nationkey AS db, COUNT(*) FILTER (WHERE c_nationkey % 5 > 0) AS n, MIN(c_name) AS one, string_agg(DISTINCT CASE WHEN c_nationkey % 5 < 4 THEN substr(sha1(c_mktsegment), 1, 12) END, ', ' ORDER BY CASE WHEN c_nationkey % 5 < 4 THEN substr(sha1(c_mktsegment), 1, 12) END) AS releases FROM customer GROUP BY 1) x""")  # fmt: skip
def source_lines(v: Views) -> DataFrame:
    """Nations as builds, customers as their files; every fifth build is unstamped, of a full source, or without releases."""
    return audit.source_lines(v.spark.sql("SELECT c_nationkey AS db, c_nationkey % 5 = 1 AS is_full, IF(c_nationkey % 5 > 0, c_name, NULL) AS name, sha2(c_name, 256) AS sha256, IF(c_nationkey % 5 < 4, sha1(c_mktsegment), NULL) AS release FROM customer"))


_MISSING = "SELECT provider_id, status FROM (" + SQL["provider_status"] + ") p"


@query(f"""
SELECT 'flows' AS build, 'n_flows' AS item, COUNT(*) AS n FROM ({SQL["context_categories"]}) a UNION ALL SELECT 'flows', 'n_resources', COUNT(*) FILTER (WHERE kind = 'natural resource') FROM ({SQL["context_categories"]}) a
UNION ALL SELECT 'factors', 'n_methods', COUNT(*) FROM ({SQL["cf_counts"]}) b UNION ALL SELECT 'factors', 'n_matched', CAST(SUM(n_matched) AS BIGINT) FROM ({SQL["cf_counts"]}) b UNION ALL SELECT 'factors', 'n_unmatched', CAST(SUM(n_unmatched) AS BIGINT) FROM ({SQL["cf_counts"]}) b
UNION ALL SELECT 'dropped', 'n_dropped', CAST(SUM(n_dropped) AS BIGINT) FROM ({SQL["dropped_factor_census"]}) c
UNION ALL SELECT 'providers', s.status, COUNT(p.status) FROM (SELECT 'resolved' AS status UNION ALL SELECT 'missing_bundle' UNION ALL SELECT 'missing_full_only') s LEFT JOIN ({_MISSING}) p ON p.status = s.status GROUP BY s.status
UNION ALL SELECT 'background', 'n_activities', COUNT(DISTINCT code) FROM ({SQL["lumped_background"]}) d UNION ALL SELECT 'background', 'n_exchanges', COUNT(*) FROM ({SQL["lumped_background"]}) d
UNION ALL SELECT 'library', 'n_dropped', CAST(SUM(n_rows) AS BIGINT) FROM ({SQL["library_dropped"]}) e
UNION ALL SELECT 'links', c.item, CASE c.item WHEN 'tech_linked' THEN tech_linked WHEN 'tech_external' THEN tech_external WHEN 'tech_unlinked' THEN tech_unlinked ELSE tech_ambiguous END
  FROM ({SQL["link_totals"]}) t, (SELECT 'tech_linked' AS item UNION ALL SELECT 'tech_external' UNION ALL SELECT 'tech_unlinked' UNION ALL SELECT 'tech_ambiguous') c""")  # fmt: skip
def build_report(v: Views) -> DataFrame:
    """What each step of a build wrote and dropped, as counts."""
    n = lambda c: F.sum(c).alias(c)
    resource = flow_kind(F.col("context"), F.col("class")) == "natural resource"
    refs = v.spark.table("events").select(F.col("event_type").alias("source"), F.col("user_id").alias("provider_id"), F.col("event_id").alias("process_id"))
    inventory, dropped = background.library_inventory(v.library, v.library_flow, v.elementary)
    lumped = background.lumped_activities(v.library.groupBy("process_id").agg(F.max("row").alias("ref_flow_id")), inventory, "grid")
    status = F.col("status")
    return audit.build_report({
        "flows": v.flow_list.agg(F.count(F.lit(1)).alias("n_flows"), F.count_if(resource).alias("n_resources")),
        "factors": factors.match_counts(v.raw_cf, v.elementary).agg(F.count(F.lit(1)).alias("n_methods"), n("n_matched"), n("n_unmatched")),
        "dropped": factors.dropped_census(factors.map_flows(v.raw_cf, v.mapping)[1]).agg(n("n_dropped")),
        "providers": background.provider_status(refs, v.library, "click").agg(*(F.count_if(status == s).alias(s) for s in ("resolved", "missing_bundle", "missing_full_only"))),
        "background": lumped.agg(F.count_distinct("code").alias("n_activities"), F.count(F.lit(1)).alias("n_exchanges")),
        "library": dropped.agg(F.sum("n_rows").alias("n_dropped")),
        "links": link_totals(v).select("tech_linked", "tech_external", "tech_unlinked", "tech_ambiguous"),
    })


@query(with_views("SELECT code, name, string_agg(db, ',' ORDER BY pos) AS dbs, MIN(pos) AS first_pos FROM catalogue GROUP BY code, name", "catalogue"))
def catalogue_scan(v: Views) -> DataFrame:
    """The catalogue of all builds in a store, written twice: the second time is confirmed."""
    path = new_path(v.spark, "store")
    sinks.write_store(v.catalogue.where("db = 'full'"), path)
    sinks.write_store(v.catalogue, path, confirm=lambda _: True)
    return readers.read_catalogue(v.spark, path)
