"""Registered queries of sources, sinks and guards: what is written to the shared folder is read back and compared."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluxweave.functions import text, units
from fluxweave.operators import allocation, background, catalog, compare, foreground, guards, search
from fluxweave.plans.lineage import new_path
from fluxweave.plans.queries import _NORMALIZED, SQL, _decided, _normalized, query, rounded
from fluxweave.plans.views import Views, with_views
from fluxweave.sources import readers, sinks

# --- sources ---------------------------------------------------------------------------------------------


def _process_files(v: Views) -> str:
    """Orders as process documents of two sources, one JSON line each: some without an id, some fields missing."""
    path = new_path(v.spark, "processes")
    exchange = """named_struct('internalId', CAST(x.l_linenumber AS INT), 'isInput', IF(x.l_linestatus = 'O', TRUE, NULL), 'isQuantitativeReference', IF(x.l_linenumber = 1, TRUE, NULL), 'amount', IF(x.l_tax > 0.07, NULL, x.l_quantity),
        'unit', IF(x.l_discount > 0.09, NULL, named_struct('name', 'kg')), 'flow', named_struct('@id', CAST(x.l_partkey AS STRING), 'name', x.l_returnflag, 'flowType', 'PRODUCT_FLOW'), 'defaultProvider', IF(x.l_suppkey % 2 = 0, named_struct('@id', CAST(x.l_suppkey AS STRING)), NULL))"""
    factor = "IF(x.l_discount > 0.05, named_struct('allocationType', 'CAUSAL_ALLOCATION', 'product', named_struct('@id', CAST(x.l_partkey AS STRING)), 'exchange', named_struct('internalId', CAST(x.l_linenumber AS INT)), 'value', x.l_discount), NULL)"
    # The line items move as they are; documents are made where an order has come together.
    lines = v.spark.sql("SELECT l_orderkey, sort_array(collect_list(struct(l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_tax, l_linestatus, l_returnflag))) AS rows FROM lineitem GROUP BY l_orderkey")
    docs = lines.join(v.spark.table("orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderkey"), F.when(F.col("o_orderkey") % 50 != 0, F.col("o_orderkey").cast("string")).alias("@id"), F.col("o_orderpriority").alias("name"), F.lit("01.2").alias("version"),
        F.col("o_orderstatus").alias("defaultAllocationMethod"), F.expr(f"transform(rows, x -> {exchange})").alias("exchanges"), F.expr(f"array_compact(transform(rows, x -> {factor}))").alias("allocationFactors"),
    )
    for k in (0, 1):
        docs.where(F.col("o_orderkey") % 2 == k).drop("o_orderkey").write.option("compression", "gzip").json(f"{path}/bundle_{k}/processes")
    return path


_KEPT = "l_orderkey % 50 <> 0"


@query("SELECT concat('bundle_', CAST(o_orderkey % 2 AS VARCHAR)) AS source, CAST(o_orderkey AS VARCHAR) AS process_id, o_orderpriority AS name, '01.2' AS version, o_orderstatus AS default_allocation, n AS n_exchanges FROM orders JOIN (SELECT l_orderkey, COUNT(*) AS n FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey WHERE o_orderkey % 50 <> 0")
def process_scan(v: Views) -> DataFrame:
    rows = readers.read_processes(v.spark, _process_files(v), lines=True)
    return rows.select("source", "process_id", "name", "version", "default_allocation", F.size("exchanges").cast("long").alias("n_exchanges"))


@query(f"""SELECT CAST(l_orderkey AS VARCHAR) AS process_id, l_linenumber AS internal_id, CASE WHEN l_tax > 0.07 THEN 0 ELSE l_quantity END AS amount, CASE WHEN l_discount > 0.09 THEN '' ELSE 'kg' END AS unit, '' AS fp_id,
  CAST(l_partkey AS VARCHAR) AS flow_id, l_linestatus = 'O' AS is_input, l_linenumber = 1 AS is_ref, FALSE AS is_avoided, CASE WHEN l_suppkey % 2 = 0 THEN CAST(l_suppkey AS VARCHAR) END AS provider_id FROM lineitem WHERE {_KEPT} AND l_orderkey IN (SELECT o_orderkey FROM orders)""")  # fmt: skip
def exchange_scan(v: Views) -> DataFrame:
    rows = readers.explode_exchanges(readers.read_processes(v.spark, _process_files(v), lines=True))
    return rows.select("process_id", "internal_id", "amount", "unit", "fp_id", "flow_id", "is_input", "is_ref", "is_avoided", "provider_id")


@query(f"SELECT CAST(l_orderkey AS VARCHAR) AS process_id, 'CAUSAL_ALLOCATION' AS allocation_type, CAST(l_partkey AS VARCHAR) AS product_flow_id, l_linenumber AS internal_id, l_discount AS value FROM lineitem WHERE {_KEPT} AND l_discount > 0.05 AND l_orderkey IN (SELECT o_orderkey FROM orders)")
def allocation_factor_scan(v: Views) -> DataFrame:
    return readers.explode_factors(readers.read_processes(v.spark, _process_files(v), lines=True)).drop("pos")


@query("SELECT CAST(p_partkey AS VARCHAR) AS flow_id, CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE p_name END AS name, 'PRODUCT_FLOW' AS flow_type FROM part")
def flow_scan(v: Views) -> DataFrame:
    """Two sources; the second names every third flow anew."""
    path = new_path(v.spark, "flows")
    for k, rows in enumerate(("SELECT p_partkey, p_name AS name FROM part", "SELECT p_partkey, p_brand FROM part WHERE p_partkey % 3 = 0")):
        v.spark.sql(rows).toDF("id", "name").select(F.col("id").cast("string").alias("@id"), "name", F.lit("PRODUCT_FLOW").alias("flowType")).write.json(f"{path}/bundle_{k}/flows")
    return readers.read_flows(v.spark, path, lines=True).select("flow_id", "name", "flow_type")


def _source_folder(v: Views) -> str:
    """The folder of the given tables."""
    return v.spark.table("region").select(F.input_file_name().alias("f")).first()["f"].rpartition("/")[0]


@query()
def source_identity(v: Views) -> DataFrame:
    """Content hash of every given file, and whether its name is that of a source."""
    files = f"{_source_folder(v)}/*.parquet"
    return readers.source_identity(v.spark, files).join(readers.discover_sources(v.spark, files).select("name", "accepted"), "name")


@query("SELECT p_partkey AS flow_id, p_name AS name, 'kg' AS unit, concat(trim(p_brand), '>', trim(p_type)) AS categories, CASE WHEN lower(p_brand) LIKE 'resource%' OR p_size % 4 = 0 THEN 'natural resource' ELSE 'emission' END AS kind, CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS VARCHAR) ELSE '' END AS cas FROM part")
def elementary_flow_scan(v: Views) -> DataFrame:
    path = new_path(v.spark, "flow-list")
    listed = v.spark.sql("SELECT p_partkey AS `Flow UUID`, p_name AS Flowable, 'kg' AS Unit, concat(p_brand, ' / ', p_type) AS Context, IF(p_size % 4 = 0, 'Resource', 'Emission') AS Class, IF(p_size % 2 = 0, p_size, NULL) AS `CAS No` FROM part")
    listed.unionByName(listed.where("`Flow UUID` % 5 = 0")).write.parquet(path)
    rows = catalog.elementary_flows(readers.read_table(v.spark, path, "elementary_flow"))
    return rows.withColumn("categories", F.array_join("categories", ">"))


@query(with_views("SELECT method AS indicator, COUNT(*) AS n_rows, COUNT(DISTINCT flow_id) AS n_flows, round(SUM(cf), 6) AS cf_sum FROM cf GROUP BY method", "cf"))
def factor_scan(v: Views) -> DataFrame:
    path = new_path(v.spark, "factors")
    v.cf.select(F.col("method").alias("Indicator"), F.lit("kg").alias("Indicator unit"), F.col("flow_id").alias("Flow UUID"), F.lit("").alias("Flowable"), F.lit("").alias("Location"), F.col("cf").alias("Characterization Factor")).write.parquet(path)
    rows = readers.read_table(v.spark, path, "cf")
    return rounded(rows.groupBy(F.col("Indicator").alias("indicator")).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("`Flow UUID`").alias("n_flows"), F.sum("`Characterization Factor`").alias("cf_sum")))


@query(SQL["library_inventory"])
def library_scan(v: Views) -> DataFrame:
    path = new_path(v.spark, "library")
    v.library.select("process_id").distinct().write.parquet(f"{path}/process")
    v.library_flow.write.parquet(f"{path}/flow")
    v.library.write.parquet(f"{path}/inventory")
    _, flows, inventory = readers.read_library(v.spark, path)
    return rounded(background.library_inventory(inventory, flows, v.elementary)[0])


@query(with_views("""SELECT process, category, ratio, status FROM (
  SELECT c_mktsegment AS process, n_name AS category, round(SUM(c_acctbal) / SUM(CASE WHEN c_custkey % 200 = 7 THEN c_acctbal * 1.2 ELSE c_acctbal END), 6) AS ratio, 'matched' AS status FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey BETWEEN 5 AND 19 GROUP BY 1, 2
  UNION ALL SELECT DISTINCT c_mktsegment, n_name, CAST(NULL AS DOUBLE), CASE WHEN n_nationkey < 5 THEN 'not computed' ELSE 'no reference' END FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey NOT BETWEEN 5 AND 19) x"""))  # fmt: skip
def reference_match(v: Views) -> DataFrame:
    """Computed scores lack some categories, reference scores lack others and hold rows without a category."""
    scores = v.spark.sql("SELECT c_mktsegment AS process, n_name AS category, SUM(c_acctbal) AS score FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey >= 5 GROUP BY 1, 2")
    given = v.spark.sql("SELECT c_mktsegment AS process, IF(n_nationkey < 20, n_name, NULL) AS category, SUM(IF(c_custkey % 200 = 7, c_acctbal * 1.2, c_acctbal)) AS ol_score FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2")
    cells, alone = compare.match_references(scores, readers.read_reference_scores(given))
    matched = compare.ratios(cells).select("process", "category", "ratio", F.lit("matched").alias("status"))
    return rounded(matched.unionByName(alone.select("process", "category", F.lit(None).cast("double").alias("ratio"), F.col("reason").alias("status"))))


# --- rows in between ---------------------------------------------------------------------------------------


@query(with_views("""SELECT e.process_id, e.internal_id, e.l_suppkey, round(x.mass * CASE WHEN c.ref_fp_id = 'mass' THEN 1.0 ELSE coalesce(m.factor, 0.0) END, 6) AS mass FROM raw_exchange e
JOIN (SELECT process_id, internal_id, l_suppkey, flow_id, unit, fp_id, amount, CASE WHEN f IS NULL THEN amount WHEN listed AND NOT same AND factor IS NOT NULL THEN amount * f / factor ELSE amount * f END AS mass FROM n) x
  ON x.process_id = e.process_id AND x.internal_id = e.internal_id AND x.l_suppkey = e.l_suppkey AND x.flow_id = e.flow_id AND x.amount = e.amount
LEFT JOIN conversion c ON c.flow_id = e.flow_id LEFT JOIN conversion_factor m ON m.flow_id = e.flow_id AND m.fp_id = 'mass' WHERE NOT e.is_input AND e.flow_type = 'PRODUCT_FLOW'""", "raw_exchange", "conversion", "conversion_factor", recursive=_NORMALIZED))  # fmt: skip
def output_mass(v: Views) -> DataFrame:
    """Masses of outputs, from amounts in their flow's reference unit."""
    outputs = allocation.product_outputs(_normalized(v))
    of_mass = v.conversion_factor.where("fp_id = 'mass'").select("flow_id", "factor")
    rows = outputs.join(v.conversion.select("flow_id", "ref_fp_id"), "flow_id", "left").join(of_mass, "flow_id", "left")
    return rounded(rows.select("process_id", "internal_id", "l_suppkey", allocation.output_mass(F.col("ref_fp_id"), F.lit("mass"), F.col("amount_ref"), F.col("factor")).alias("mass")))


@query(with_views("SELECT CAST(o_orderkey AS VARCHAR) AS code, CAST(NULL AS BIGINT) AS flow_id FROM orders UNION ALL SELECT concat(CAST(p.process_id AS VARCHAR), '__co__', CAST(p.flow_id AS VARCHAR)), p.flow_id FROM product p JOIN declared d ON d.process_id = p.process_id WHERE d.allocation_type = 'CAUSAL' AND NOT p.is_ref", "product", "declared"))
def build_jobs(v: Views) -> DataFrame:
    causal = v.declared.where("allocation_type = 'CAUSAL'").select("process_id")
    coproducts = v.product.where("not is_ref").join(causal, "process_id").select(text.coproduct_code(F.col("process_id").cast("string"), F.col("flow_id").cast("string")).alias("code"), "flow_id")
    return catalog.jobs(v.spark.sql("SELECT CAST(o_orderkey AS STRING) AS code FROM orders"), coproducts).select("code", "flow_id")


@query("SELECT p_partkey AS supplier, concat(p_name, '; at ', p_brand) AS supplier_name, p_brand AS flow_id, 'subset' AS supplier_db, '2025' AS vintage FROM part WHERE p_retailprice > 905")
def external_suppliers(v: Views) -> DataFrame:
    flows = v.spark.sql("SELECT p_partkey AS code, p_brand AS ref_flow_id FROM part")
    return background.external_index(v.catalogue.join(flows, "code"), "subset", "2025")


@query("SELECT c_custkey AS case_id, c_mktsegment AS expected, c_mktsegment IS NULL OR c_mktsegment = 'BUILDING' AS runs FROM (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer) c")
def vintage_guard(v: Views) -> DataFrame:
    cases = v.spark.sql("SELECT c_custkey AS case_id, IF(c_custkey % 4 = 0, NULL, c_mktsegment) AS expected FROM customer")
    runs, skipped = compare.same_vintage(cases, "BUILDING")
    return runs.withColumn("runs", F.lit(True)).unionByName(skipped.withColumn("runs", F.lit(False)))


@query("SELECT s_suppkey AS code, CASE WHEN s_suppkey % 3 = 0 THEN 'unit' WHEN s_suppkey % 3 = 1 THEN '1 kg' ELSE '1 m3' END AS label FROM supplier")
def functional_unit_label(v: Views) -> DataFrame:
    rows = v.spark.sql("SELECT s_suppkey AS code, CASE s_suppkey % 6 WHEN 0 THEN NULL WHEN 3 THEN ' ' WHEN 1 THEN 'kg' WHEN 4 THEN ' kg ' ELSE 'm3' END AS unit FROM supplier")
    return rows.select("code", text.functional_unit(F.col("unit")).alias("label"))


_INVENTORY = """SELECT o_orderkey * 100 + k AS lineno, concat('order ', CAST(o_orderkey AS VARCHAR(20))) AS process_name, kind AS exchange_type, CASE WHEN kind = 'biosphere' THEN CAST(o_orderkey % 7 AS VARCHAR(20)) END AS flow_uuid,
  CASE WHEN kind = 'technosphere' THEN CAST(o_custkey AS VARCHAR(20)) END AS provider_uuid, CAST(1 + o_orderkey % 9 AS VARCHAR(20)) AS amount, CASE WHEN kind = 'technosphere' AND o_orderkey % 2 = 0 THEN 'g' ELSE 'kg' END AS unit, CASE WHEN kind = 'production' THEN 'yes' ELSE '' END AS is_ref
  FROM orders CROSS JOIN (SELECT 1 AS k, 'production' AS kind UNION ALL SELECT 2, 'technosphere' UNION ALL SELECT 3, 'biosphere') kinds"""


def _valid(v: Views) -> DataFrame:
    flows = v.spark.range(7).select(F.col("id").cast("string").alias("flow_id"), F.lit("kg").alias("unit"))
    return foreground.validate(v.spark.sql(_INVENTORY), flows, v.spark.sql("SELECT CAST(c_custkey AS STRING) AS code, 'kg' AS unit FROM customer"))


@query(f"SELECT exchange_type, CASE WHEN exchange_type = 'technosphere' AND provider_uuid IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer) THEN 'background' END AS link_db, COUNT(*) AS n_rows FROM ({_INVENTORY}) i GROUP BY 1, 2")
def foreground_links(v: Views) -> DataFrame:
    return _valid(v).groupBy("exchange_type", "link_db").agg(F.count(F.lit(1)).alias("n_rows"))


@query(f"""SELECT type, COUNT(*) AS n_rows, round(SUM(amount), 6) AS amount FROM (
  SELECT exchange_type AS type, CASE WHEN unit = 'g' THEN 0.001 ELSE 1 END * CAST(amount AS DOUBLE) AS amount FROM ({_INVENTORY}) i WHERE exchange_type <> 'technosphere' OR provider_uuid IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer)
  UNION ALL SELECT 'technosphere', CAST(l_quantity AS DOUBLE) FROM lineitem) x GROUP BY type""")  # fmt: skip
def merged_network(v: Views) -> DataFrame:
    """A valid inventory beside the network's own exchanges; rows of customers that do not exist are left out before."""
    rows = _valid(v).where("exchange_type <> 'technosphere' or link_db is not null")
    loaded = foreground.load(rows, path=new_path(v.spark, "inventory"))
    network = v.spark.sql("SELECT CAST(l_orderkey AS STRING) AS code, CAST(l_partkey AS STRING) AS input_code, l_quantity AS amount, 'technosphere' AS type FROM lineitem")
    whole = foreground.merge(network, loaded.select("code", "input_code", "amount", "type"))
    return rounded(whole.groupBy("type").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("amount").alias("amount")))


# --- sinks -------------------------------------------------------------------------------------------------


@query("SELECT 'full' AS db, COUNT(*) AS n_rows, TRUE AS refused FROM part UNION ALL SELECT 'subset', COUNT(*), TRUE FROM part WHERE p_retailprice > 905 HAVING COUNT(*) > 0")
def activity_store(v: Views) -> DataFrame:
    """A store that is there is kept; with overwrite it is written again."""
    path, refused = new_path(v.spark, "store"), False
    sinks.write_store(v.catalogue.where("db = 'full'"), path)
    try:
        sinks.write_store(v.catalogue, path)
    except FileExistsError:
        refused = True
    sinks.write_store(v.catalogue, path, overwrite=True)
    return readers.read_stored(v.spark, path).groupBy("db").agg(F.count(F.lit(1)).alias("n_rows")).select("db", "n_rows", F.lit(refused).alias("refused"))


@query(with_views("SELECT scenario, method, round(score, 6) AS score, (SELECT COUNT(DISTINCT scenario) FROM scenario) AS n_stored FROM (SELECT scenario, method, CASE WHEN scenario = 'BUILDING' THEN score * 2 ELSE score END AS score FROM scenario) s", "scenario"))
def result_store(v: Views) -> DataFrame:
    """A scenario that is written again replaces its rows and leaves the others."""
    path, rows = new_path(v.spark, "results"), v.scenario.select("scenario", "method", "score")
    sinks.write_results(rows, path)
    n = sinks.write_results(rows.where("scenario = 'BUILDING'").withColumn("score", F.col("score") * 2), path)
    return rounded(readers.read_stored(v.spark, path).withColumn("n_stored", F.lit(n).cast("long")))


@query(with_views("SELECT scenario, COUNT(*) AS n_rows, CAST(SUM(COUNT(*)) OVER () AS BIGINT) AS n_written, 0 AS n_empty FROM scenario GROUP BY scenario", "scenario"))
def contribution_store(v: Views) -> DataFrame:
    path, rows = new_path(v.spark, "contributions"), v.scenario.select("scenario", "method", "score")
    empty = sinks.write_contributions(rows.where("false"), path)
    n = sinks.write_contributions(rows, path)
    return readers.read_stored(v.spark, path).groupBy("scenario").agg(F.count(F.lit(1)).alias("n_rows")).withColumns({"n_written": F.lit(n).cast("long"), "n_empty": F.lit(empty)})


@query(with_views("""SELECT s.scenario, s.method, round(s.score / nullif(b.score, 0), 6) AS ratio FROM scenario s JOIN scenario b ON b.method = s.method AND b.scenario = 'BUILDING'""", "scenario"))
def result_scan(v: Views) -> DataFrame:
    """Stored results, read through the gate of their columns, rewritten from themselves, and set against a baseline."""
    path, unit = new_path(v.spark, "results"), {"unit": F.lit(""), "functional_unit": F.lit("unit")}
    sinks.write_results(v.scenario.select("scenario", "method", "score").withColumns(unit), path)
    sinks.write_results(readers.read_stored(v.spark, path, "result").withColumn("score", F.col("score") * 2), path)
    rows = readers.read_stored(v.spark, path, "result")
    base = rows.where("scenario = 'BUILDING'").select("method", F.col("score").alias("base"))
    return rounded(rows.join(base, "method").select("scenario", "method", F.expr("score / nullif(base, 0)").alias("ratio")))


@query(with_views("SELECT method, flow_id, round(CASE WHEN method = 'ASIA' THEN -cf ELSE cf END, 6) AS cf FROM cf", "cf"))
def factor_store(v: Views) -> DataFrame:
    """Factors of a method are always written anew."""
    path = new_path(v.spark, "cf")
    sinks.write_cf(v.cf, path)
    sinks.write_cf(v.cf.where("method = 'ASIA'").withColumn("cf", -F.col("cf")), path)
    return rounded(readers.read_stored(v.spark, path).select("method", "flow_id", "cf"))


@query("SELECT o_orderpriority AS db, COUNT(*) AS n_processes, round(SUM(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def link_audit_store(v: Views) -> DataFrame:
    """Builds written one after the other never share rows."""
    path = new_path(v.spark, "audit")
    for part in ("o_orderpriority < '3'", "o_orderpriority >= '3'"):
        sinks.write_link_audit(v.spark.sql(f"SELECT o_orderpriority AS db, o_orderkey, o_totalprice FROM orders WHERE {part}"), path)
    return rounded(readers.read_stored(v.spark, path).groupBy("db").agg(F.count(F.lit(1)).alias("n_processes"), F.sum("o_totalprice").alias("total")), 2)


@query(with_views("SELECT flow_id, fp_id, round(factor, 6) AS factor FROM conversion_factor", "conversion_factor"))
def conversion_store(v: Views) -> DataFrame:
    path = new_path(v.spark, "conversions")
    for rows in (v.conversion_factor.limit(0), v.conversion_factor):
        sinks.write_conversions(rows, path)
    return rounded(readers.read_stored(v.spark, path))


@query("SELECT 'full' AS db, COUNT(*) AS activity_count, '2026' AS vintage, FALSE AS stale FROM part UNION ALL SELECT 'subset', COUNT(*), '2025', TRUE FROM part WHERE p_retailprice > 905 HAVING COUNT(*) > 0")
def build_stamps(v: Views) -> DataFrame:
    """Stamping a build again replaces its row; the other build's flow list is stale then."""
    path = new_path(v.spark, "meta")
    counts = v.catalogue.groupBy("db").agg(F.count(F.lit(1)).alias("activity_count"))
    sinks.stamp_build(counts.withColumns({"vintage": F.lit("2025"), "flow_version": F.lit("1")}), path)
    sinks.stamp_build(counts.where("db = 'full'").withColumns({"vintage": F.lit("2026"), "flow_version": F.lit("2")}), path)
    return guards.stale(readers.read_stored(v.spark, path), "2").select("db", "activity_count", "vintage", "stale")


@query("SELECT s_nationkey % 2 AS mode, vintage, partial, COUNT(*) AS n_rows FROM supplier, (SELECT '2025' AS vintage, FALSE AS partial UNION ALL SELECT '2026', FALSE UNION ALL SELECT '2025', TRUE) t WHERE NOT partial OR s_suppkey % 3 = 0 GROUP BY 1, 2, 3")
def validation_store(v: Views) -> DataFrame:
    path, rows = new_path(v.spark, "validation"), v.spark.sql("SELECT s_nationkey % 2 AS mode, s_suppkey FROM supplier")
    for vintage, partial in (("2025", False), ("2026", False), ("2025", True)):
        sinks.write_validation(rows.where("s_suppkey % 3 = 0") if partial else rows, path, vintage, partial)
    return readers.read_stored(v.spark, path).groupBy("mode", "vintage", "partial").agg(F.count(F.lit(1)).alias("n_rows"))


@query(with_views("SELECT COUNT(*) AS n_results, round(SUM(score), 6) AS total, COUNT(DISTINCT scenario) AS n_scenarios FROM scenario", "scenario"))
def manifest_store(v: Views) -> DataFrame:
    """A nested row as JSON, read back and flattened."""
    path = new_path(v.spark, "manifest")
    nested = v.scenario.agg(F.struct(F.count(F.lit(1)).alias("n"), F.sum("score").alias("total")).alias("results"), F.struct(F.count_distinct("scenario").alias("n")).alias("scenarios"))
    sinks.write_manifest(nested, path)
    back = v.spark.read.schema(nested.schema).json(path)
    return rounded(back.select(F.col("results.n").alias("n_results"), F.col("results.total").alias("total"), F.col("scenarios.n").alias("n_scenarios")))


# --- guards ------------------------------------------------------------------------------------------------

_GUARDS = f"""
SELECT 'unknown units' AS guard, COUNT(*) AS n_violations FROM ({SQL['unknown_units']}) a
UNION ALL SELECT 'columns without exchanges', COUNT(*) FROM (SELECT DISTINCT l_partkey FROM lineitem WHERE l_tax > 0.07 AND l_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_discount > 0.08)) b
UNION ALL SELECT 'exchanges without a flow', COUNT(*) FROM lineitem WHERE l_suppkey % 7 = 0
UNION ALL SELECT 'activities without production', COUNT(*) FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_linenumber = 1 AND l_discount > 0.05)
UNION ALL SELECT 'impossible allocation', COUNT(*) FROM ({SQL['alloc_decision']}) c WHERE method = 'failed'
UNION ALL SELECT 'conflicting flows', COUNT(*) FROM ({SQL['flow_conflicts']}) d
UNION ALL SELECT 'unpinned sources', COUNT(*) FROM part WHERE p_partkey % 50 = 0
UNION ALL SELECT 'implausible masses', COUNT(*) FROM part WHERE p_retailprice NOT BETWEEN 950 AND 1500
UNION ALL SELECT 'repeated ids', COUNT(*) FROM (SELECT l_partkey FROM lineitem GROUP BY 1 HAVING COUNT(*) > 1) e
UNION ALL SELECT 'several references', COUNT(*) FROM (SELECT l_orderkey FROM lineitem WHERE l_linenumber <= 2 GROUP BY 1 HAVING COUNT(*) > 1) f
UNION ALL SELECT 'stale builds', COUNT(*) FROM orders WHERE o_orderstatus <> 'F' OR o_orderstatus IS NULL
UNION ALL SELECT 'missing builds', COUNT(*) FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)) g"""


@query(_GUARDS)
def guard_report(v: Views) -> DataFrame:
    """Violations of each guard over rows that hold some."""
    sql = v.spark.sql
    pinned = sql("SELECT CAST(p_partkey AS STRING) AS name, sha2(IF(p_partkey % 50 = 0, '', p_name), 256) AS sha256 FROM part")
    return guards.report({
        "unknown units": units.unknown_units(_normalized(v)),
        "columns without exchanges": guards.empty_columns(sql("SELECT l_partkey AS coproduct_code FROM lineitem WHERE l_tax > 0.07"), sql("SELECT l_partkey AS coproduct_code FROM lineitem WHERE l_discount > 0.08")),
        "exchanges without a flow": guards.without_flow(sql("SELECT l_orderkey AS process_id, IF(l_suppkey % 7 = 0, NULL, l_partkey) AS flow_id FROM lineitem")),
        "activities without production": guards.without_production(v.activity, sql("SELECT l_partkey AS code FROM lineitem WHERE l_linenumber = 1 AND l_discount > 0.05")),
        "impossible allocation": guards.impossible(_decided(v)),
        "conflicting flows": catalog.flow_conflicts(v.flow_list, "flow_id", ["name", "unit", "context", "class"]),
        "unpinned sources": guards.unpinned(sql("SELECT CAST(p_partkey AS STRING) AS name, sha2(p_name, 256) AS sha256 FROM part"), pinned),
        "implausible masses": guards.plausible(v.spark.table("part"), "p_retailprice", 950, 1500),
        "repeated ids": guards.repeated(v.spark.table("lineitem"), "l_partkey"),
        "several references": catalog.several_references(sql("SELECT l_orderkey AS process_id, l_linenumber <= 2 AS is_ref FROM lineitem")),
        "stale builds": guards.stale(sql("SELECT o_orderkey AS db, o_orderstatus AS flow_version FROM orders"), "F").where("stale"),
        "missing builds": guards.missing_builds(sql("SELECT o_custkey AS db FROM orders"), sql("SELECT c_custkey AS db FROM customer WHERE c_acctbal > 0")),
    })
