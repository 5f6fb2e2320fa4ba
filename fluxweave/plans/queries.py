"""Registered queries: each operator over the derived life-cycle tables, with its SQL for a second engine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxweave.functions import text, units
from fluxweave.operators import allocation, background, catalog, conversion, factors, linking
from fluxweave.plans.views import Views, with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Callable[[Views], DataFrame]], Callable[[Views], DataFrame]]:
    def keep(f: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Views(spark, sf_dir))
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return keep


def rounded(df: DataFrame, places: int = 6, *names: str) -> DataFrame:
    """Sums differ in their last digits between engines, so what is compared is rounded."""
    chosen = names or [c for c, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.round(c, places) for c in chosen})


# --- units and conversions -----------------------------------------------------------------------------

_UNIT_ROWS = ", ".join(f"('{u}', '{d}', CAST({f!r} AS DOUBLE))" for d, us in units.UNITS.items() for u, f in us.items())
_UNITS = f"units(u, dimension, f) AS (VALUES {_UNIT_ROWS})"
_NORMALIZED = f"""{_UNITS}, n AS (
  SELECT e.process_id, e.internal_id, e.l_suppkey, e.flow_id, e.fp_id, e.unit, e.amount,
         CASE WHEN e.unit = 'Mg' THEN 1000.0 ELSE u.f END AS f, e.flow_type <> 'ELEMENTARY_FLOW' AND c.flow_id IS NOT NULL AS listed, e.fp_id = c.ref_fp_id AS same, c.ref_unit, s.factor
  FROM raw_exchange e LEFT JOIN units u ON u.u = lower(e.unit) LEFT JOIN conversion c ON c.flow_id = e.flow_id LEFT JOIN conversion_factor s ON s.flow_id = e.flow_id AND s.fp_id = e.fp_id)"""


def _normalized(v: Views) -> DataFrame:
    return units.normalize(v.raw_exchange, v.conversion, v.conversion_factor, F.col("flow_type") != "ELEMENTARY_FLOW")


@query(with_views("""
SELECT process_id, internal_id, l_suppkey, flow_id, unit, f IS NOT NULL AS known_unit, f IS NOT NULL AND listed AND NOT same AND factor IS NULL AS unconverted,
       CASE WHEN f IS NOT NULL AND listed THEN ref_unit ELSE unit END AS unit_ref,
       round(CASE WHEN f IS NULL THEN amount WHEN listed AND NOT same AND factor IS NOT NULL THEN amount * f / factor ELSE amount * f END, 6) AS amount_ref FROM n""", "raw_exchange", "conversion", "conversion_factor", recursive=_NORMALIZED))  # fmt: skip
def unit_normalize(v: Views) -> DataFrame:
    return rounded(_normalized(v).select("process_id", "internal_id", "l_suppkey", "flow_id", "unit", "known_unit", "unconverted", "unit_ref", "amount_ref"))


@query(with_views("""
SELECT unit, CAST(SUM(k) AS BIGINT) AS n_rows, COUNT(*) AS n_flows, string_agg(flow_id, ',' ORDER BY flow_id) FILTER (WHERE i <= 3) AS examples, greatest(COUNT(*) - 3, 0) AS rest FROM p GROUP BY unit""", "raw_exchange", "conversion", "conversion_factor", recursive=_NORMALIZED + ", p AS (SELECT unit, flow_id, COUNT(*) AS k, row_number() OVER (PARTITION BY unit ORDER BY flow_id) AS i FROM n WHERE f IS NULL GROUP BY unit, flow_id)"))  # fmt: skip
def unknown_units(v: Views) -> DataFrame:
    return units.unknown_units(_normalized(v))


@query(with_views("""
SELECT process_id, internal_id, l_suppkey, unit, ref_unit, status, round(CASE status WHEN 'same' THEN amount WHEN 'converted' THEN amount * fa / fb END, 6) AS converted FROM (
  SELECT x.*, a.dimension AS da, CASE WHEN x.unit = 'Mg' THEN 1000.0 ELSE a.f END AS fa, b.f AS fb,
         CASE WHEN x.unit = x.ref_unit THEN 'same' WHEN a.f IS NULL OR b.f IS NULL THEN 'unknown' WHEN a.dimension <> b.dimension THEN 'incompatible' ELSE 'converted' END AS status
  FROM (SELECT process_id, internal_id, l_suppkey, amount, unit, CASE WHEN l_partkey % 3 = 0 THEN 'kg' WHEN l_partkey % 3 = 1 THEN 'MJ' ELSE 'bushel' END AS ref_unit FROM raw_exchange) x
  LEFT JOIN units a ON a.u = lower(x.unit) LEFT JOIN units b ON b.u = lower(x.ref_unit)) y""", "raw_exchange", recursive=_UNITS))  # fmt: skip
def unit_convert_or_refuse(v: Views) -> DataFrame:
    k = F.col("l_partkey") % 3
    rows = v.raw_exchange.select("process_id", "internal_id", "l_suppkey", "amount", "unit", F.when(k == 0, "kg").when(k == 1, "MJ").otherwise("bushel").alias("ref_unit"))
    return rounded(units.convert_or_refuse(rows).select("process_id", "internal_id", "l_suppkey", "unit", "ref_unit", "status", "converted"))


_REFERENCE = """ref AS (
  SELECT flow_id, CASE WHEN nf > 0 THEN CASE WHEN first_factor <> 1 THEN 'bad_factor' ELSE 'flagged' END WHEN n1 > 1 THEN 'ambiguous' WHEN n1 = 1 THEN 'inferred' ELSE 'missing' END AS status,
         CASE WHEN nf > 0 THEN first_fp WHEN n1 = 1 THEN only_fp END AS ref_fp_id, CASE WHEN nf > 0 THEN first_unit WHEN n1 = 1 THEN only_unit END AS ref_unit
  FROM (SELECT flow_id, SUM(CASE WHEN flagged THEN 1 ELSE 0 END) AS nf, SUM(CASE WHEN coalesce(factor, 1.0) = 1.0 THEN 1 ELSE 0 END) AS n1,
               arg_min(fp_id, pos) FILTER (WHERE flagged) AS first_fp, arg_min(ref_unit, pos) FILTER (WHERE flagged) AS first_unit, arg_min(coalesce(factor, 1.0), pos) FILTER (WHERE flagged) AS first_factor,
               arg_min(fp_id, pos) FILTER (WHERE coalesce(factor, 1.0) = 1.0) AS only_fp, arg_min(ref_unit, pos) FILTER (WHERE coalesce(factor, 1.0) = 1.0) AS only_unit
        FROM property GROUP BY flow_id) g)"""


@query(with_views("SELECT * FROM ref", "property", recursive=_REFERENCE))
def flow_reference_property(v: Views) -> DataFrame:
    return conversion.reference_property(v.property)


@query(with_views("SELECT p.flow_id, p.fp_id, round(coalesce(p.factor, 1.0), 6) AS factor FROM property p JOIN ref USING (flow_id) WHERE status IN ('flagged', 'inferred') AND p.fp_id <> ref_fp_id", "property", recursive=_REFERENCE))
def conversion_rows(v: Views) -> DataFrame:
    return rounded(conversion.conversion_rows(v.property, conversion.reference_property(v.property)))


_FILLED = """prim AS (SELECT p_partkey AS flow_id, 'mass' AS ref_fp_id, 'kg' AS ref_unit FROM part WHERE p_retailprice < 1000),
supp AS (SELECT l_partkey AS flow_id, CASE WHEN l_tax > 0.04 THEN 'volume' ELSE 'mass' END AS ref_fp_id, CASE WHEN l_tax > 0.04 THEN 'm3' ELSE 'kg' END AS ref_unit, l_orderkey * 100 + l_suppkey AS pos FROM lineitem),
filled AS (SELECT *, 'primary' AS origin FROM prim UNION ALL SELECT flow_id, arg_min(ref_fp_id, (pos, ref_fp_id)), arg_min(ref_unit, (pos, ref_fp_id)), 'supplement' FROM supp WHERE flow_id NOT IN (SELECT flow_id FROM prim) GROUP BY flow_id)"""


def _filled(v: Views) -> DataFrame:
    prim = v.spark.sql("SELECT p_partkey AS flow_id, 'mass' AS ref_fp_id, 'kg' AS ref_unit FROM part WHERE p_retailprice < 1000")
    supp = v.spark.sql("SELECT l_partkey AS flow_id, CASE WHEN l_tax > 0.04 THEN 'volume' ELSE 'mass' END AS ref_fp_id, CASE WHEN l_tax > 0.04 THEN 'm3' ELSE 'kg' END AS ref_unit, struct(l_orderkey * 100 + l_suppkey AS pos, CASE WHEN l_tax > 0.04 THEN 'volume' ELSE 'mass' END AS fp) AS pos FROM lineitem")
    return conversion.fill_gaps(prim, supp, "pos")


@query(f"WITH {_FILLED} SELECT * FROM filled")
def conversion_gap_fill(v: Views) -> DataFrame:
    return _filled(v)


@query(f"WITH {_FILLED}, multi AS (SELECT DISTINCT l_partkey AS flow_id FROM lineitem WHERE l_discount > 0.095) SELECT COUNT(*) AS n_flows, COUNT(multi.flow_id) AS n_multi_property, CAST(SUM(CASE WHEN origin = 'supplement' THEN 1 ELSE 0 END) AS BIGINT) AS n_added FROM filled LEFT JOIN multi USING (flow_id)")
def conversion_census(v: Views) -> DataFrame:
    return conversion.census(_filled(v), v.spark.sql("SELECT l_partkey AS flow_id FROM lineitem WHERE l_discount > 0.095"))


# --- catalogue and flow lists -----------------------------------------------------------------------------

_PARTS = "[CAST(x AS INT) FOR x IN string_split(version, '.')]"


@query(with_views(f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, version, changed FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_PARTS} DESC, changed DESC NULLS LAST, l_partkey, l_suppkey) AS i FROM raw_version) r WHERE i = 1""", "raw_version"))  # fmt: skip
def latest_version(v: Views) -> DataFrame:
    rows = catalog.latest_version(v.raw_version, ["l_orderkey", "l_linenumber"], "version", "changed", ["l_partkey", "l_suppkey"])
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "version", "changed")


@query(with_views("SELECT l_orderkey, l_linenumber, COUNT(DISTINCT concat(version, '/', changed)) AS n_versions FROM raw_version GROUP BY 1, 2 HAVING COUNT(DISTINCT concat(version, '/', changed)) > 1", "raw_version"))
def version_conflicts(v: Views) -> DataFrame:
    return catalog.version_conflicts(v.raw_version, ["l_orderkey", "l_linenumber"], "version", "changed")


@query(with_views("SELECT DISTINCT flow_id, process_id FROM raw_exchange WHERE is_ref", "raw_exchange"))
def reference_flow_index(v: Views) -> DataFrame:
    return catalog.reference_flow_index(v.raw_exchange)


@query(with_views("SELECT process_id, COUNT(*) AS n_ref FROM raw_exchange WHERE is_ref GROUP BY process_id HAVING COUNT(*) > 1", "raw_exchange"))
def several_references(v: Views) -> DataFrame:
    return catalog.several_references(v.raw_exchange)


_KIND = "CASE WHEN is_ref THEN 'production' WHEN flow_type = 'ELEMENTARY_FLOW' THEN 'biosphere' WHEN (is_input AND flow_type IN ('PRODUCT_FLOW', 'WASTE_FLOW')) OR flow_type = 'WASTE_FLOW' THEN 'technosphere' END"


@query(with_views(f"SELECT process_id, internal_id, l_suppkey, kind, CASE WHEN kind = 'technosphere' AND is_avoided THEN -amount ELSE amount END AS signed_amount FROM (SELECT *, {_KIND} AS kind FROM raw_exchange) x", "raw_exchange"))
def exchange_classify(v: Views) -> DataFrame:
    return catalog.classify(v.raw_exchange).select("process_id", "internal_id", "l_suppkey", "kind", "signed_amount")


@query(with_views("SELECT code, flow_id, round(amount, 6) AS amount FROM biosphere WHERE flow_id IN (SELECT flow_id FROM elementary)", "biosphere", "elementary"))
def biosphere_match(v: Views) -> DataFrame:
    return rounded(catalog.match_biosphere(v.biosphere, v.elementary)[0].select("code", "flow_id", "amount"))


@query(with_views("SELECT code, COUNT(*) AS n_unmatched FROM biosphere WHERE flow_id NOT IN (SELECT flow_id FROM elementary) GROUP BY code", "biosphere", "elementary"))
def biosphere_unmatched(v: Views) -> DataFrame:
    return catalog.match_biosphere(v.biosphere, v.elementary)[1].groupBy("code").agg(F.count(F.lit(1)).alias("n_unmatched"))


_FLOW_LIST = "SELECT *, CASE WHEN lower(context) LIKE 'resource%' OR lower(class) LIKE '%resource%' THEN 'natural resource' ELSE 'emission' END AS kind FROM flow_list"


def _flow_list(v: Views) -> DataFrame:
    return v.flow_list.withColumn("kind", text.flow_kind(F.col("context"), F.col("class")))


@query(with_views(f"SELECT kind, COUNT(*) AS n_flows, COUNT(DISTINCT unit) AS n_units FROM ({_FLOW_LIST}) x GROUP BY kind", "flow_list"))
def flow_census(v: Views) -> DataFrame:
    return catalog.flow_census(_flow_list(v))


@query(with_views("SELECT flow_id, COUNT(*) AS n_rows, COUNT(DISTINCT concat(name, '|', unit, '|', context, '|', class)) AS n_identities FROM flow_list GROUP BY flow_id HAVING COUNT(DISTINCT concat(name, '|', unit, '|', context, '|', class)) > 1", "flow_list"))
def flow_conflicts(v: Views) -> DataFrame:
    return catalog.flow_conflicts(v.flow_list, "flow_id", ["name", "unit", "context", "class"])


@query(with_views(f"SELECT flow_id, kind, array_to_string([trim(x) FOR x IN string_split(context, '/') IF trim(x) <> ''], '>') AS categories FROM ({_FLOW_LIST}) x", "flow_list"))
def context_categories(v: Views) -> DataFrame:
    return _flow_list(v).select("flow_id", "kind", F.array_join(text.categories(F.col("context")), ">").alias("categories"))


_PLACE = "CASE n_regionkey WHEN 0 THEN 'Northern America' WHEN 1 THEN concat(n_name, ' (the)') WHEN 2 THEN 'Europe' WHEN 3 THEN '' ELSE 'United States of America (the)' END"


@query(f"SELECT c_custkey, CASE n_regionkey WHEN 0 THEN 'RNA' WHEN 1 THEN n_name WHEN 2 THEN 'RER' WHEN 3 THEN 'GLO' ELSE 'US' END AS location FROM customer JOIN nation ON c_nationkey = n_nationkey")
def location_normalize(v: Views) -> DataFrame:
    return v.spark.sql(f"SELECT c_custkey, {_PLACE} AS place FROM customer JOIN nation ON c_nationkey = n_nationkey").select("c_custkey", text.location_code(F.col("place")).alias("location"))


@query(with_views("SELECT code, concat(substr(h, 1, 8), '-', substr(h, 9, 4), '-5', substr(h, 14, 3), '-', CASE WHEN substr(h, 17, 1) IN ('0', '4', '8', 'c') THEN '8' WHEN substr(h, 17, 1) IN ('1', '5', '9', 'd') THEN '9' WHEN substr(h, 17, 1) IN ('2', '6', 'a', 'e') THEN 'a' ELSE 'b' END, substr(h, 18, 3), '-', substr(h, 21, 12)) AS uuid FROM (SELECT code, sha1(from_hex('6ba7b8109dad11d180b400c04fd430c8') || encode(lower(trim(name)))) AS h FROM activity) x", "activity"))
def name_uuid(v: Views) -> DataFrame:
    return v.activity.select("code", text.name_uuid(F.col("name")).alias("uuid"))


@query(with_views("SELECT process_id, flow_id, concat('Order ', CAST(process_id AS VARCHAR), ' [causal co-product: ', CAST(flow_id AS VARCHAR), ']') AS name, concat(CAST(process_id AS VARCHAR), '__co__', CAST(flow_id AS VARCHAR)) AS code FROM product WHERE NOT is_ref", "product"))
def coproduct_naming(v: Views) -> DataFrame:
    p, f = F.col("process_id").cast("string"), F.col("flow_id").cast("string")
    return v.product.where("not is_ref").select("process_id", "flow_id", text.coproduct_name(F.concat(F.lit("Order "), p), f).alias("name"), text.coproduct_code(p, f).alias("code")).where(text.is_coproduct(F.col("code")))


# --- linking ------------------------------------------------------------------------------------------------

_SUPPLIERS = """sup AS (SELECT p_brand AS flow_id, p_partkey AS supplier, p_name AS supplier_name, 'process' AS supplier_db FROM part WHERE p_retailprice >= 905
  UNION SELECT p_brand, p_partkey, p_name, 'external' FROM part WHERE p_retailprice < 905),
pf AS (SELECT flow_id, COUNT(*) AS n, arg_min(supplier, (supplier, supplier_db)) AS one, arg_min(supplier_db, (supplier, supplier_db)) AS one_db FROM sup GROUP BY flow_id),
pn AS (SELECT flow_id, supplier_name, MIN(supplier) AS one, MIN(supplier_db) AS one_db FROM sup GROUP BY flow_id, supplier_name HAVING COUNT(*) = 1),
linked AS (
  SELECT x.*, CASE how WHEN 'hint' THEN provider_id WHEN 'external_hint' THEN provider_id WHEN 'single' THEN f_one WHEN 'name' THEN n_one END AS supplier,
         CASE how WHEN 'hint' THEN 'process' WHEN 'external_hint' THEN 'external' WHEN 'single' THEN f_db WHEN 'name' THEN n_db END AS supplier_db, how = 'none' AND coalesce(f_n, 0) > 1 AS ambiguous
  FROM (SELECT e.*, """ + _KIND + """ AS kind, pf.n AS f_n, pf.one AS f_one, pf.one_db AS f_db, pn.one AS n_one, pn.one_db AS n_db,
               CASE WHEN h.p_retailprice >= 905 THEN 'hint' WHEN h.p_partkey IS NOT NULL THEN 'external_hint' WHEN pf.n = 1 THEN 'single' WHEN pn.one IS NOT NULL THEN 'name' ELSE 'none' END AS how
        FROM raw_exchange e LEFT JOIN part h ON h.p_partkey = e.provider_id LEFT JOIN pf ON pf.flow_id = e.flow_id LEFT JOIN pn ON pn.flow_id = e.flow_id AND pn.supplier_name = e.provider_name) x)"""  # fmt: skip


def _linked(v: Views) -> DataFrame:
    inside = v.spark.sql("SELECT p_partkey AS process_id, p_brand AS flow_id, p_partkey AS supplier, p_name AS supplier_name, 'process' AS supplier_db FROM part WHERE p_retailprice >= 905")
    outside = v.spark.sql("SELECT p_brand AS flow_id, p_partkey AS supplier, p_name AS supplier_name, 'external' AS supplier_db FROM part WHERE p_retailprice < 905")
    return linking.resolve(catalog.classify(v.raw_exchange), inside, outside, linking.candidates(inside, outside))


@query(with_views("SELECT process_id, internal_id, l_suppkey, how, supplier, supplier_db, ambiguous FROM linked WHERE kind = 'technosphere'", "raw_exchange", recursive=_SUPPLIERS))
def link_resolve(v: Views) -> DataFrame:
    return _linked(v).where("kind = 'technosphere'").select("process_id", "internal_id", "l_suppkey", "how", "supplier", "supplier_db", "ambiguous")


_LISTED = "listed AS (SELECT p_brand AS flow_id FROM part GROUP BY p_brand HAVING MIN(p_retailprice) > 901)"


@query(with_views("""
SELECT process_id, COUNT(*) FILTER (WHERE kind = 'biosphere' AND l.flow_id IS NOT NULL) AS bio_matched, COUNT(*) FILTER (WHERE kind = 'biosphere' AND l.flow_id IS NULL) AS bio_unmatched,
       COUNT(*) FILTER (WHERE kind = 'technosphere' AND supplier IS NOT NULL) AS tech_linked, COUNT(*) FILTER (WHERE kind = 'technosphere' AND supplier_db = 'external') AS tech_external,
       COUNT(*) FILTER (WHERE kind = 'technosphere' AND supplier IS NULL) AS tech_unlinked, COUNT(*) FILTER (WHERE kind = 'technosphere' AND ambiguous) AS tech_ambiguous,
       COUNT(*) FILTER (WHERE kind = 'technosphere' AND NOT is_input AND supplier IS NOT NULL) AS waste_links, COUNT(*) FILTER (WHERE kind = 'technosphere' AND is_avoided) AS avoided_links
FROM linked LEFT JOIN listed l ON l.flow_id = linked.flow_id GROUP BY process_id""", "raw_exchange", recursive=f"{_SUPPLIERS}, {_LISTED}"))  # fmt: skip
def link_tally(v: Views) -> DataFrame:
    return linking.tally(_linked(v), v.spark.sql("SELECT p_brand AS flow_id FROM part GROUP BY p_brand HAVING MIN(p_retailprice) > 901"))


# --- allocation ---------------------------------------------------------------------------------------------

_ALLOC = """mf AS (SELECT p.*, CASE WHEN t.total > 0 THEN CASE WHEN p.mass > 0 THEN p.mass ELSE 0 END / t.total END AS mass_fraction FROM product p JOIN (SELECT process_id, SUM(CASE WHEN mass > 0 THEN mass END) AS total FROM product GROUP BY process_id) t ON t.process_id = p.process_id),
nat AS (SELECT process_id, allocation_type, product_flow_id, arg_min(value, pos) AS native_factor FROM factor WHERE internal_id IS NULL GROUP BY 1, 2, 3),
dec AS (SELECT d.process_id, g.ref_flow, coalesce(g.n_outputs, 0) AS n_outputs,
    CASE WHEN coalesce(n_outputs, 0) <= 1 THEN 'single' WHEN ref_flow IS NULL THEN 'failed' WHEN d.allocation_type = 'CAUSAL' THEN 'causal' WHEN n.native_factor IS NOT NULL THEN 'native' WHEN ref_mass > 0 THEN 'mass' ELSE 'failed' END AS method,
    CASE WHEN coalesce(n_outputs, 0) <= 1 THEN 1.0 WHEN d.allocation_type = 'CAUSAL' THEN coalesce(ref_mass, 1.0) WHEN n.native_factor IS NOT NULL THEN n.native_factor WHEN ref_mass > 0 THEN ref_mass END AS factor
  FROM declared d LEFT JOIN (SELECT process_id, COUNT(*) AS n_outputs, MAX(CASE WHEN is_ref THEN flow_id END) AS ref_flow, MAX(CASE WHEN is_ref THEN mass_fraction END) AS ref_mass FROM mf GROUP BY process_id) g ON d.process_id = g.process_id
  LEFT JOIN nat n ON n.process_id = d.process_id AND n.allocation_type = d.allocation_type AND n.product_flow_id = g.ref_flow)"""


def _decided(v: Views) -> DataFrame:
    outputs = allocation.mass_fractions(v.product)
    return allocation.decide(outputs, allocation.native_factors(v.factor), v.declared)


@query(with_views("SELECT process_id, flow_id, round(mass_fraction, 6) AS mass_fraction FROM mf", "product", "declared", "factor", recursive=_ALLOC))
def alloc_mass_fraction(v: Views) -> DataFrame:
    return rounded(allocation.mass_fractions(v.product).select("process_id", "flow_id", "mass_fraction"))


@query(with_views("SELECT process_id, allocation_type, product_flow_id, round(native_factor, 6) AS native_factor FROM nat", "product", "declared", "factor", recursive=_ALLOC))
def alloc_native(v: Views) -> DataFrame:
    return rounded(allocation.native_factors(v.factor))


@query(with_views("SELECT process_id, ref_flow, n_outputs, method, round(factor, 6) AS factor FROM dec", "product", "declared", "factor", recursive=_ALLOC))
def alloc_decision(v: Views) -> DataFrame:
    return rounded(_decided(v))


@query(with_views("""SELECT e.process_id, e.internal_id, e.l_suppkey, m.flow_id AS product_flow_id, round(coalesce(f.value, m.mass_fraction, 1.0), 6) AS factor, f.value IS NULL AS fell_back
FROM raw_exchange e JOIN mf m ON m.process_id = e.process_id JOIN declared c ON c.process_id = e.process_id AND c.allocation_type = 'CAUSAL'
LEFT JOIN factor f ON f.allocation_type = 'CAUSAL' AND f.process_id = e.process_id AND f.product_flow_id = m.flow_id AND f.internal_id = e.internal_id""", "raw_exchange", "product", "declared", "factor", recursive=_ALLOC))  # fmt: skip
def alloc_causal(v: Views) -> DataFrame:
    columns = v.factor.where("internal_id is not null").select("process_id", "product_flow_id", "internal_id", "value")
    exchanges = v.raw_exchange.select("process_id", "internal_id", "l_suppkey").join(v.declared.where("allocation_type = 'CAUSAL'").select("process_id"), "process_id", "left_semi")
    shares = allocation.mass_fractions(v.product).select("process_id", F.col("flow_id").alias("product_flow_id"), "mass_fraction")
    return rounded(allocation.causal_factors(exchanges, columns, shares).select("process_id", "internal_id", "l_suppkey", "product_flow_id", "factor", "fell_back"))


@query(with_views("SELECT method, COUNT(*) AS n_processes, CAST(SUM(n_outputs) AS BIGINT) AS n_outputs, COUNT(*) FILTER (WHERE n_outputs > 1 AND factor IN (0.0, 1.0)) AS n_degenerate FROM dec GROUP BY method", "product", "declared", "factor", recursive=_ALLOC))
def alloc_census(v: Views) -> DataFrame:
    return allocation.census(_decided(v))


_MULTIPLIER = "mult AS (SELECT o.process_id, o.flow_id, CASE WHEN r.amount <> 0 THEN r.amount * o.price_share / nullif(o.amount * r.price_share, 0) END AS multiplier FROM product o JOIN product r ON r.process_id = o.process_id AND r.is_ref WHERE NOT o.is_ref)"


@query(with_views("SELECT process_id, flow_id, round(multiplier, 6) AS multiplier, multiplier IS NULL AS skipped FROM mult", "product", recursive=_MULTIPLIER))
def coproduct_multiplier(v: Views) -> DataFrame:
    return rounded(allocation.multipliers(v.product.withColumn("share", F.col("price_share"))).select("process_id", "flow_id", "multiplier", "skipped"))


@query(with_views("""SELECT l.process_id, l.internal_id, l.l_suppkey, CASE WHEN d.allocation_type = 'CAUSAL' AND m.flow_id IS NOT NULL THEN concat(CAST(l.supplier AS VARCHAR), '__co__', CAST(l.l_partkey AS VARCHAR)) ELSE CAST(l.supplier AS VARCHAR) END AS target,
  round(CASE WHEN d.allocation_type = 'CAUSAL' THEN l.signed ELSE l.signed * coalesce(m.multiplier, 1.0) END, 6) AS amount_linked
FROM (SELECT l_orderkey AS process_id, l_linenumber AS internal_id, l_suppkey, l_partkey, l_orderkey AS supplier, l_quantity AS signed FROM lineitem) l
LEFT JOIN mult m ON m.process_id = l.supplier AND m.flow_id = l.l_partkey LEFT JOIN declared d ON d.process_id = l.supplier AND m.flow_id IS NOT NULL""", "product", "declared", recursive=_MULTIPLIER))  # fmt: skip
def causal_coproduct_links(v: Views) -> DataFrame:
    links = v.spark.sql("SELECT l_orderkey AS process_id, l_linenumber AS internal_id, l_suppkey, l_partkey AS flow_id, l_orderkey AS supplier, l_quantity AS signed_amount FROM lineitem")
    mult = allocation.multipliers(v.product.withColumn("share", F.col("price_share"))).select(F.col("process_id").alias("supplier"), "flow_id", "multiplier")
    causal = v.declared.where("allocation_type = 'CAUSAL'").select(F.col("process_id").alias("supplier"))
    coproducts = mult.join(causal, "supplier").select("supplier", "flow_id", text.coproduct_code(F.col("supplier").cast("string"), F.col("flow_id").cast("string")).alias("coproduct_code"))
    rows = linking.rebase(links, coproducts, mult).select("process_id", "internal_id", "l_suppkey", F.coalesce("coproduct_code", F.col("supplier").cast("string")).alias("target"), "amount_linked")
    return rounded(rows)


# --- factors ------------------------------------------------------------------------------------------------

_SPATIAL = "method IN ('ASIA', 'EUROPE')"


@query(with_views(f"SELECT method, customer, location, round(cf, 6) AS cf FROM raw_cf WHERE CASE WHEN {_SPATIAL} THEN location = 'CHINA' ELSE location = '' END", "raw_cf"))
def cf_spatial_filter(v: Views) -> DataFrame:
    return rounded(factors.filter_locations(v.raw_cf, F.expr(_SPATIAL), "CHINA").select("method", "customer", "location", "cf"))


@query(with_views("SELECT method, source_flow AS flow_id, round(arg_max(cf, row_index), 6) AS cf, COUNT(*) AS n_rows FROM raw_cf GROUP BY 1, 2", "raw_cf"))
def cf_last_wins(v: Views) -> DataFrame:
    return rounded(factors.last_wins(v.raw_cf.drop("flow_id").withColumnRenamed("source_flow", "flow_id")))


@query(with_views("SELECT method, customer, location FROM raw_cf WHERE flow_id IS NULL OR flow_id NOT IN (SELECT flow_id FROM elementary)", "raw_cf", "elementary"))
def cf_unmatched(v: Views) -> DataFrame:
    return factors.unmatched(v.raw_cf, v.elementary).select("method", "customer", "location")


@query(with_views(f"SELECT method, flow_id, round(arg_max(cf, row_index), 6) AS cf, COUNT(*) AS n_rows FROM raw_cf WHERE (CASE WHEN {_SPATIAL} THEN location = 'CHINA' ELSE location = '' END) AND cf IS NOT NULL AND flow_id IN (SELECT flow_id FROM elementary) GROUP BY 1, 2", "raw_cf", "elementary"))
def cf_table(v: Views) -> DataFrame:
    return rounded(factors.build_table(v.raw_cf, v.elementary, F.expr(_SPATIAL), "CHINA"))


@query(with_views("SELECT method, COUNT(*) FILTER (WHERE flow_id IN (SELECT flow_id FROM elementary)) AS n_matched, COUNT(*) FILTER (WHERE flow_id IS NULL OR flow_id NOT IN (SELECT flow_id FROM elementary)) AS n_unmatched FROM raw_cf GROUP BY method", "raw_cf", "elementary"))
def cf_counts(v: Views) -> DataFrame:
    return factors.match_counts(v.raw_cf, v.elementary)


@query(with_views("SELECT method, COUNT(DISTINCT unit) AS n_units, CASE WHEN method = 'EUROPE' THEN 'override' WHEN COUNT(DISTINCT unit) = 1 THEN 'unique' ELSE 'conflict' END AS status, CASE WHEN method = 'EUROPE' THEN 'kg-eq' WHEN COUNT(DISTINCT unit) = 1 THEN MIN(unit) END AS unit FROM raw_cf GROUP BY method", "raw_cf"))
def cf_units(v: Views) -> DataFrame:
    return factors.method_units(v.raw_cf, v.spark.createDataFrame([("EUROPE", "kg-eq")], "method string, unit string"))


@query(with_views("SELECT r.method, r.source_flow, COUNT(*) AS n_dropped FROM raw_cf r LEFT JOIN mapping m ON m.source_flow = r.source_flow WHERE trim(coalesce(m.flow_id, '')) = '' GROUP BY 1, 2", "raw_cf", "mapping"))
def dropped_factor_census(v: Views) -> DataFrame:
    return factors.dropped_census(factors.map_flows(v.raw_cf, v.mapping)[1])


@query(with_views("SELECT r.method, r.source_flow, COUNT(*) AS n_rows, round(SUM(r.cf * m.factor), 3) AS cf_sum FROM raw_cf r JOIN mapping m ON m.source_flow = r.source_flow WHERE trim(m.flow_id) <> '' GROUP BY 1, 2", "raw_cf", "mapping"))
def cf_mapped(v: Views) -> DataFrame:
    return factors.map_flows(v.raw_cf, v.mapping)[0].groupBy("method", "source_flow").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("cf"), 3).alias("cf_sum"))


@query(with_views("SELECT p.flow_id, r.r_name AS method, round(c.cf, 6) AS cf, coalesce(c.cf BETWEEN 0 AND 5, FALSE) AS passed FROM elementary p CROSS JOIN region r LEFT JOIN cf c ON c.flow_id = p.flow_id AND c.method = r.r_name", "elementary", "cf"))
def cf_preflight(v: Views) -> DataFrame:
    methods = v.spark.table("region").select(F.col("r_name").alias("method"))  # one row for each method, a handful
    probes = v.elementary.join(F.broadcast(methods)).select("method", "flow_id", F.lit(0.0).alias("low"), F.lit(5.0).alias("high"))
    return rounded(factors.preflight(v.cf, probes).select("flow_id", "method", "cf", "passed"))


# --- background ---------------------------------------------------------------------------------------------


@query(with_views("SELECT provider_id, COUNT(DISTINCT process_id) AS n_referrers, COUNT(DISTINCT source) AS n_sources FROM grid_reference GROUP BY provider_id", "grid_reference"))
def external_providers(v: Views) -> DataFrame:
    return background.referrers(v.grid_reference)


_EXTERNAL = """SELECT DISTINCT e.source, e.provider_id, e.process_id FROM sx e
WHERE e.is_input AND e.flow_type IN ('PRODUCT_FLOW', 'WASTE_FLOW') AND e.provider_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM sx o WHERE o.source = e.source AND o.flow_id = e.flow_id AND o.is_ref AND NOT o.is_input AND o.l_suppkey < 3)
  AND NOT EXISTS (SELECT 1 FROM orders p WHERE p.o_orderpriority = e.source AND p.o_orderkey = e.provider_id)"""


@query(with_views("SELECT source, COUNT(*) AS n_references, COUNT(DISTINCT provider_id) AS n_providers FROM (" + _EXTERNAL + ") x GROUP BY source", "raw_exchange", recursive="sx AS (SELECT e.*, o_orderpriority AS source FROM raw_exchange e JOIN orders ON o_orderkey = process_id)"))
def external_discovery(v: Views) -> DataFrame:
    orders = v.spark.table("orders").select(F.col("o_orderkey").alias("process_id"), F.col("o_orderpriority").alias("source"))
    # Of the references, those of the first suppliers count as the source's own.
    rows = v.raw_exchange.join(orders, "process_id").withColumn("is_ref", F.col("is_ref") & (F.col("l_suppkey") < 3))
    found = background.external_references(rows, orders)
    return found.groupBy("source").agg(F.count(F.lit(1)).alias("n_references"), F.count_distinct("provider_id").alias("n_providers"))


_VOTES = "votes AS (SELECT source, CASE provider_id WHEN '0' THEN '2025' ELSE '2026' END AS vintage, COUNT(DISTINCT process_id) AS votes FROM grid_reference GROUP BY 1, 2)"


def _votes(v: Views) -> DataFrame:
    return background.vintage_votes(v.grid_reference, v.spark.createDataFrame([("0", "2025"), ("1", "2026")], "provider_id string, vintage string"))


@query(with_views("SELECT * FROM votes", "grid_reference", recursive=_VOTES))
def vintage_vote(v: Views) -> DataFrame:
    return _votes(v)


_VERDICT = _VOTES + ", verdict AS (SELECT source, CASE WHEN COUNT(*) FILTER (WHERE votes = most) = 1 THEN MIN(vintage) FILTER (WHERE votes = most) END AS verdict FROM (SELECT *, MAX(votes) OVER (PARTITION BY source) AS most FROM votes) x GROUP BY source)"


@query(with_views("SELECT * FROM verdict", "grid_reference", recursive=_VERDICT))
def vintage_verdict(v: Views) -> DataFrame:
    return background.classify_sources(_votes(v))


@query(with_views("SELECT CASE WHEN COUNT(DISTINCT verdict) = 1 THEN 'unanimous' WHEN COUNT(DISTINCT verdict) > 1 THEN 'conflict' ELSE 'default' END AS reason, CASE WHEN COUNT(DISTINCT verdict) = 1 THEN MIN(verdict) WHEN COUNT(DISTINCT verdict) = 0 THEN '2025' END AS vintage, COUNT(DISTINCT verdict) AS n_verdicts FROM verdict", "grid_reference", recursive=_VERDICT))
def vintage_decision(v: Views) -> DataFrame:
    return background.decide_vintage(background.classify_sources(_votes(v)), default="2025")


_LIBRARY = "lib AS (SELECT l.process_id, f.flow_id, f.flow_type, l.value, e.flow_id IS NOT NULL AS listed FROM library l JOIN library_flow f ON f.row = l.row LEFT JOIN elementary e ON e.flow_id = f.flow_id)"


@query(with_views("SELECT process_id, flow_id, round(SUM(value), 6) AS amount FROM lib WHERE flow_type = 'ELEMENTARY_FLOW' AND listed GROUP BY 1, 2 HAVING SUM(value) <> 0", "library", "library_flow", "elementary", recursive=_LIBRARY))
def library_inventory(v: Views) -> DataFrame:
    return rounded(background.library_inventory(v.library, v.library_flow, v.elementary)[0])


@query(with_views("SELECT CASE WHEN flow_type <> 'ELEMENTARY_FLOW' THEN 'not elementary' ELSE 'not listed' END AS reason, COUNT(*) AS n_rows, COUNT(DISTINCT flow_id) AS n_flows FROM lib WHERE flow_type <> 'ELEMENTARY_FLOW' OR NOT listed GROUP BY 1", "library", "library_flow", "elementary", recursive=_LIBRARY))
def library_dropped(v: Views) -> DataFrame:
    return background.library_inventory(v.library, v.library_flow, v.elementary)[1]


@query(with_views("""SELECT 'grid' AS db, process_id AS code, process_id AS input_code, CAST(1.0 AS DOUBLE) AS amount, 'production' AS type, MAX(row) AS ref_flow_id FROM library GROUP BY process_id
UNION ALL SELECT 'grid', process_id, flow_id, round(SUM(value), 6), 'biosphere', NULL FROM lib WHERE flow_type = 'ELEMENTARY_FLOW' AND listed GROUP BY process_id, flow_id HAVING SUM(value) <> 0""", "library", "library_flow", "elementary", recursive=_LIBRARY))  # fmt: skip
def lumped_background(v: Views) -> DataFrame:
    inventory = background.library_inventory(v.library, v.library_flow, v.elementary)[0]
    processes = v.library.groupBy("process_id").agg(F.max("row").alias("ref_flow_id"))
    return rounded(background.lumped_activities(processes, inventory, "grid"))


@query(with_views("SELECT provider_id, CASE WHEN l.process_id IS NOT NULL THEN 'resolved' WHEN bundles > 0 THEN 'missing_bundle' ELSE 'missing_full_only' END AS status FROM (SELECT user_id AS provider_id, COUNT(*) FILTER (WHERE event_type <> 'click') AS bundles FROM events GROUP BY user_id) r LEFT JOIN (SELECT DISTINCT process_id FROM library) l ON l.process_id = r.provider_id", "library"))
def provider_status(v: Views) -> DataFrame:
    refs = v.spark.table("events").select(F.col("event_type").alias("source"), F.col("user_id").alias("provider_id"), F.col("event_id").alias("process_id"))
    return background.provider_status(refs, v.library, "click")


@query("SELECT CAST(floor(event_id / 2) AS BIGINT) AS provider_id FROM events GROUP BY 1 HAVING COUNT(*) FILTER (WHERE event_type <> 'click') = 0")
def full_only_providers(v: Views) -> DataFrame:
    return background.only_in(v.spark.table("events").select(F.col("event_type").alias("source"), F.floor(F.col("event_id") / 2).alias("provider_id")), "click")


_MATRIX = """direct AS (SELECT l_suppkey AS row, l_partkey AS mid, SUM(l_quantity) AS b FROM lineitem GROUP BY 1, 2),
inv AS (SELECT p_partkey AS mid, p_brand AS col, p_size / 10.0 AS s FROM part),
m AS (SELECT l_suppkey AS row, p_brand AS col, SUM(l_quantity * p_size / 10.0) + CASE WHEN l_suppkey % 10 = 0 THEN 1.0 ELSE 0.0 END AS value FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)"""


@query(f"WITH {_MATRIX} SELECT m.col, round(MAX(abs(m.value - coalesce(made, 0)) / greatest(abs(m.value), 1e-30)), 6) AS max_error, COUNT(*) AS n_rows FROM m FULL JOIN (SELECT d.row, i.col, SUM(b * s) AS made FROM direct d JOIN inv i ON i.mid = d.mid GROUP BY 1, 2) x ON x.row = m.row AND x.col = m.col GROUP BY m.col")
def library_consistency(v: Views) -> DataFrame:
    return rounded(background.consistency(*_matrices(v)))


def _matrices(v: Views) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cumulative (with an error in every tenth row), direct and supply."""
    cumulative = v.spark.sql("SELECT l_suppkey AS row, p_brand AS col, SUM(l_quantity * p_size / 10D) + CASE WHEN l_suppkey % 10 = 0 THEN 1D ELSE 0D END AS value FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_suppkey, p_brand")
    direct = v.spark.sql("SELECT l_suppkey AS row, l_partkey AS mid, SUM(l_quantity) AS value FROM lineitem GROUP BY l_suppkey, l_partkey")
    return cumulative, direct, v.spark.sql("SELECT p_partkey AS mid, p_brand AS col, p_size / 10D AS value FROM part")


_SIGN = "CASE WHEN substr(md5(concat(col, '/', CAST(i AS VARCHAR))), 1, 1) < '8' THEN 1 ELSE -1 END"


@query(f"""WITH {_MATRIX}, probes AS (SELECT i FROM range(0, 16) t(i)),
short AS (SELECT i, mid, SUM(s * {_SIGN}) AS r FROM inv, probes GROUP BY 1, 2),
made AS (SELECT i, row, SUM(b * r) AS x, SUM(abs(b)) AS size FROM direct JOIN short ON short.mid = direct.mid GROUP BY 1, 2),
given AS (SELECT i, row, SUM(value * {_SIGN}) AS x, SUM(abs(value)) AS size FROM m, probes GROUP BY 1, 2)
SELECT given.row, 16 AS n_probes, CAST(COUNT(*) FILTER (WHERE abs(given.x - made.x) > 1e-9 * (given.size + made.size)) AS INT) AS n_failed FROM given JOIN made ON made.row = given.row AND made.i = given.i GROUP BY 1""")
def library_probe(v: Views) -> DataFrame:
    """Rows of the library that are not what its matrices give, found without their product."""
    return background.probe(*_matrices(v))
