"""Life-cycle tables derived from the star-schema tables, in SQL that Spark and DuckDB both read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fluxweave.plans.lineage import cut, new_path

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

VIEWS: dict[str, str] = {
    # Activities and their network: an acyclic one, since every provider has a smaller key.
    "activity": """
        SELECT p_partkey AS code, concat(p_name, '; at ', p_brand) AS name, p_name, p_brand, CAST(1 + p_partkey % 4 AS DOUBLE) AS amount FROM part""",
    "technosphere": """
        SELECT consumer, provider, SUM(amount) AS amount FROM (
          SELECT p_partkey AS consumer, CAST(FLOOR(p_partkey / 2) AS BIGINT) AS provider, CAST(0.30 AS DOUBLE) AS amount FROM part WHERE p_partkey > 0
          UNION ALL
          SELECT p_partkey, CAST(FLOOR(p_partkey / 3) AS BIGINT), CAST(CASE WHEN p_partkey % 11 = 0 THEN -0.05 ELSE 0.20 END AS DOUBLE) FROM part WHERE p_partkey > 0) e
        GROUP BY consumer, provider""",
    # The same with a cycle at every fifth activity, whose product goes into half of its own supply.
    "cyclic": """
        SELECT consumer, provider, SUM(amount) AS amount FROM (
          SELECT consumer, provider, amount FROM technosphere
          UNION ALL SELECT CAST(FLOOR(p_partkey / 2) AS BIGINT), p_partkey, CAST(0.25 AS DOUBLE) FROM part WHERE p_partkey > 0 AND p_partkey % 5 = 0) e
        GROUP BY consumer, provider""",
    # Pairs that use more of one another than they make: the series diverges, the solution does not.
    "amplifying": """
        SELECT p_partkey AS consumer, p_partkey + 1 AS provider, CAST(1.5 AS DOUBLE) * (1 + p_partkey % 4) AS amount FROM part WHERE p_partkey % 2 = 0
        UNION ALL SELECT p_partkey, p_partkey - 1, CAST(1.0 AS DOUBLE) * (1 + p_partkey % 4) FROM part WHERE p_partkey % 2 = 1
        UNION ALL SELECT p_partkey, 2 * CAST(FLOOR(p_partkey / 4) AS BIGINT), CAST(0.3 AS DOUBLE) * (1 + p_partkey % 4) FROM part WHERE p_partkey % 2 = 0 AND p_partkey > 0""",
    "biosphere": """
        SELECT l_partkey AS code, l_suppkey AS flow_id, SUM(l_quantity) / 1000 AS amount FROM lineitem GROUP BY l_partkey, l_suppkey""",
    "elementary": """
        SELECT s_suppkey AS flow_id, s_name AS name, CASE WHEN s_nationkey % 2 = 0 THEN 'kg' ELSE 'MJ' END AS unit FROM supplier WHERE s_acctbal > 0""",
    "cf": """
        SELECT r_name AS method, s_suppkey AS flow_id, s_acctbal / 1000 AS cf FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "demand": """
        SELECT o_orderpriority AS demand_id, l_partkey AS code, SUM(l_quantity) AS quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderpriority, l_partkey""",
    # Raw factors: generic and regional rows of every customer, so a method and flow has many.
    "raw_cf": """
        SELECT r_name AS method, c_mktsegment AS source_flow, c_custkey AS customer, s_suppkey AS flow_id, '' AS location, c_acctbal / 1000 AS cf, c_custkey * 2 AS row_index, CASE WHEN c_nationkey % 5 = 0 THEN 'CTU' ELSE 'kg' END AS unit
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey LEFT JOIN supplier ON s_suppkey = c_custkey
        UNION ALL
        SELECT r_name, c_mktsegment, c_custkey, s_suppkey, n_name, c_acctbal / 500, c_custkey * 2 + 1, 'kg'
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey LEFT JOIN supplier ON s_suppkey = c_custkey""",
    "mapping": """
        SELECT DISTINCT c_mktsegment AS source_flow, CASE WHEN length(c_mktsegment) % 2 = 0 THEN c_mktsegment ELSE '' END AS flow_id, CAST(2.0 AS DOUBLE) AS factor FROM customer""",
    # Versions: repeated keys of line items, with versions from the ship date.
    "raw_version": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
               concat('0', CAST(year(l_shipdate) % 10 AS VARCHAR(10)), '.', CAST(month(l_shipdate) AS VARCHAR(10)), '.', CAST(day(l_shipdate) AS VARCHAR(10))) AS version,
               CAST(l_returnflag AS VARCHAR(10)) AS changed
        FROM lineitem""",
    # Exchanges of processes (orders): flows are brands, suppliers of a flow are the parts of that brand.
    "raw_exchange": """
        SELECT l_orderkey AS process_id, l_linenumber AS internal_id, l_partkey, l_suppkey, p_brand AS flow_id, p_type AS fp_name, l_quantity AS amount,
               CASE l_linenumber % 7 WHEN 0 THEN 'kg' WHEN 1 THEN 'g' WHEN 2 THEN 'Mg' WHEN 3 THEN 'mg' WHEN 4 THEN 'lb' WHEN 5 THEN 'btu' ELSE 'furlong' END AS unit,
               CASE l_linenumber % 7 WHEN 5 THEN 'energy' WHEN 6 THEN 'length' ELSE 'mass' END AS fp_id,
               CASE l_returnflag WHEN 'A' THEN 'ELEMENTARY_FLOW' WHEN 'N' THEN 'PRODUCT_FLOW' ELSE 'WASTE_FLOW' END AS flow_type,
               l_linestatus = 'O' AS is_input, l_linenumber = 1 AS is_ref, l_discount > 0.08 AS is_avoided,
               CASE WHEN l_suppkey % 5 = 0 THEN -l_partkey WHEN l_suppkey % 5 = 1 THEN NULL ELSE l_partkey END AS provider_id, p_name AS provider_name, l_extendedprice AS price, l_tax AS tax
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "conversion": """
        SELECT p_brand AS flow_id, CASE WHEN length(p_brand) % 2 = 0 OR p_brand LIKE '%1' THEN 'mass' ELSE 'volume' END AS ref_fp_id,
               CASE WHEN length(p_brand) % 2 = 0 OR p_brand LIKE '%1' THEN 'kg' ELSE 'm3' END AS ref_unit FROM part GROUP BY p_brand""",
    "conversion_factor": """
        SELECT p_brand AS flow_id, 'energy' AS fp_id, AVG(p_retailprice) AS factor FROM part GROUP BY p_brand
        UNION ALL
        SELECT p_brand, 'mass', AVG(p_size) FROM part WHERE NOT (p_brand LIKE '%1' OR length(p_brand) % 2 = 0) GROUP BY p_brand""",
    "property": """
        SELECT p_partkey AS flow_id, 1 AS pos, 'mass' AS fp_id, 'kg' AS ref_unit, CAST(CASE WHEN p_size % 3 = 0 THEN 2.0 ELSE 1.0 END AS DOUBLE) AS factor, p_size % 4 = 0 AS flagged FROM part
        UNION ALL
        SELECT p_partkey, 2, 'volume', 'm3', CAST(CASE WHEN p_size % 5 = 0 THEN 1.0 ELSE p_retailprice END AS DOUBLE), p_size % 7 = 0 FROM part
        UNION ALL
        SELECT p_partkey, 3, 'energy', 'MJ', CAST(NULL AS DOUBLE), CAST(NULL AS BOOLEAN) FROM part WHERE p_size > 40""",
    # Outputs of processes: one row per product of an order.
    "output": """
        SELECT l_orderkey AS process_id, l_partkey AS flow_id, SUM(l_quantity) AS amount, SUM(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END) AS mass, SUM(l_extendedprice) AS price
        FROM lineitem GROUP BY l_orderkey, l_partkey""",
    "product": """
        SELECT o.process_id, o.flow_id, o.amount, o.mass, o.price, o.flow_id = r.ref_flow AS is_ref, o.price / r.total_price AS price_share
        FROM output o JOIN (SELECT process_id, MIN(flow_id) AS ref_flow, SUM(price) AS total_price FROM output GROUP BY process_id) r ON o.process_id = r.process_id""",
    "declared": """
        SELECT o_orderkey AS process_id, CASE WHEN o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%' THEN 'ECONOMIC' WHEN o_orderpriority LIKE '3%' THEN 'CAUSAL' ELSE 'PHYSICAL' END AS allocation_type FROM orders""",
    "factor": """
        SELECT p.process_id, d.allocation_type, p.flow_id AS product_flow_id, CAST(NULL AS INT) AS internal_id, p.price_share AS value, 1 AS pos FROM product p JOIN declared d ON p.process_id = d.process_id WHERE d.allocation_type = 'ECONOMIC'
        UNION ALL
        SELECT p.process_id, d.allocation_type, p.flow_id, CAST(NULL AS INT), CAST(0.999 AS DOUBLE), 2 FROM product p JOIN declared d ON p.process_id = d.process_id WHERE d.allocation_type = 'ECONOMIC'
        UNION ALL
        SELECT p.process_id, 'CAUSAL', p.flow_id, 1, p.price_share, 3 FROM product p JOIN declared d ON p.process_id = d.process_id WHERE d.allocation_type = 'CAUSAL' OR p.process_id % 2 = 0""",
    # An import: orders are processes, their lines exchanges. Line 1 is the reference (of every tenth process an input:
    # a treatment), lines 2 and 3 of most are further products. A link draws one of three products of its supplier.
    "import_line": """
        SELECT l_orderkey AS process_id, l_linenumber AS internal_id, MIN(l_partkey) AS part, MIN(l_suppkey) AS supp, SUM(l_quantity) AS amount, SUM(l_extendedprice) AS price, MIN(l_returnflag) AS flag, MIN(l_discount) AS discount,
               l_linenumber = 1 AS is_ref, l_linenumber <= 3 AND (l_linenumber = 1 OR l_orderkey % 3 <> 0) AS is_output, l_orderkey - l_orderkey % 97 + (l_orderkey * 7 + l_linenumber) % 97 AS drawn
        FROM lineitem GROUP BY l_orderkey, l_linenumber""",
    "import_exchange": """
        SELECT process_id, internal_id,
               CASE WHEN is_output THEN concat('g', CAST(process_id % 97 AS VARCHAR(10)), '/', CAST(internal_id AS VARCHAR(10))) WHEN flag = 'A' THEN concat('e', CAST(supp AS VARCHAR(10))) ELSE concat('g', CAST(drawn % 97 AS VARCHAR(10)), '/', CAST(1 + part % 3 AS VARCHAR(10))) END AS flow_id,
               amount, CASE (internal_id + part) % 5 WHEN 0 THEN 'kg' WHEN 1 THEN 'g' WHEN 2 THEN 'Mg' WHEN 3 THEN 'lb' ELSE 'MJ' END AS unit, CASE (internal_id + part) % 5 WHEN 4 THEN 'energy' ELSE 'mass' END AS fp_id,
               CASE WHEN is_output THEN CASE WHEN is_ref AND process_id % 10 = 9 THEN 'WASTE_FLOW' ELSE 'PRODUCT_FLOW' END WHEN flag = 'A' THEN 'ELEMENTARY_FLOW' WHEN flag = 'R' THEN 'WASTE_FLOW' ELSE 'PRODUCT_FLOW' END AS flow_type,
               (is_ref AND process_id % 10 = 9) OR (NOT is_output AND flag = 'N') AS is_input, is_ref, discount > 0.08 AS is_avoided,
               CASE WHEN supp % 5 = 0 THEN -drawn WHEN supp % 5 = 1 THEN NULL ELSE drawn END AS provider_id, concat('order ', CAST(drawn % 100 AS VARCHAR(10))) AS provider_name, price
        FROM import_line""",
    "import_inside": """
        SELECT process_id, flow_id, process_id AS supplier, concat('order ', CAST(process_id % 100 AS VARCHAR(10))) AS supplier_name, 'process' AS supplier_db FROM import_exchange WHERE is_ref""",
    "import_outside": """
        SELECT concat('g', CAST(p_partkey % 97 AS VARCHAR(10)), '/3') AS flow_id, -p_partkey AS supplier, p_name AS supplier_name, 'external' AS supplier_db FROM part WHERE p_partkey % 4 = 0""",
    "import_conversion": """
        SELECT flow_id, CASE WHEN length(flow_id) % 2 = 0 THEN 'mass' ELSE 'volume' END AS ref_fp_id, CASE WHEN length(flow_id) % 2 = 0 THEN 'kg' ELSE 'm3' END AS ref_unit FROM import_exchange WHERE flow_id LIKE 'g%' GROUP BY flow_id""",
    "import_step": """
        SELECT flow_id, 'mass' AS fp_id, CAST(800.0 AS DOUBLE) AS factor FROM import_exchange WHERE flow_id LIKE 'g%' AND length(flow_id) % 2 = 1 AND flow_id NOT LIKE 'g1%/3' GROUP BY flow_id
        UNION ALL SELECT flow_id, 'energy', CAST(40.0 AS DOUBLE) FROM import_exchange WHERE flow_id LIKE 'g%' GROUP BY flow_id""",
    "import_factor": """
        SELECT x.process_id, k.allocation_type, x.flow_id AS product_flow_id, CAST(NULL AS INT) AS internal_id, x.price / CASE k.allocation_type WHEN 'ECONOMIC' THEN t.price ELSE 2 * t.price END AS value, 1 AS pos
        FROM import_exchange x JOIN (SELECT process_id, SUM(price) AS price FROM import_exchange WHERE NOT is_input AND flow_type = 'PRODUCT_FLOW' GROUP BY process_id) t ON t.process_id = x.process_id CROSS JOIN (SELECT 'ECONOMIC' AS allocation_type UNION ALL SELECT 'PHYSICAL') k
        WHERE NOT x.is_input AND x.flow_type = 'PRODUCT_FLOW' AND (k.allocation_type = 'ECONOMIC' OR x.process_id % 4 <> 0)
        UNION ALL
        SELECT o.process_id, 'CAUSAL', o.flow_id, i.internal_id, 1.0 / (2 + o.internal_id + i.internal_id), 2 FROM import_exchange o JOIN import_exchange i ON i.process_id = o.process_id
        WHERE NOT o.is_input AND o.flow_type = 'PRODUCT_FLOW' AND (o.internal_id + i.internal_id) % 4 <> 0 AND i.internal_id > 1""",
    # References to grids: event types are sources, events refer to one of two grids.
    "grid_reference": """
        SELECT event_type AS source, CAST(user_id % 2 AS VARCHAR(10)) AS provider_id, event_id AS process_id FROM events""",
    "library": """
        SELECT l_suppkey AS row, l_partkey AS process_id, (SUM(CAST(round(l_discount * 100) AS BIGINT)) - 4 * COUNT(*)) / 100 AS value FROM lineitem GROUP BY l_suppkey, l_partkey""",
    "library_flow": """
        SELECT s_suppkey AS row, s_suppkey AS flow_id, CASE WHEN s_nationkey < 20 THEN 'ELEMENTARY_FLOW' ELSE 'PRODUCT_FLOW' END AS flow_type FROM supplier""",
    # Builds: all parts, and those at a price.
    "catalogue": """
        SELECT 1 AS pos, 'full' AS db, p_partkey AS code, concat(p_name, '; at ', p_brand) AS name FROM part
        UNION ALL SELECT 2, 'subset', p_partkey, concat(p_name, '; at ', p_brand) FROM part WHERE p_retailprice > 905""",
    # Inventories of orders: rows with errors of many kinds.
    "inventory": """
        SELECT l_orderkey * 10 + l_linenumber AS lineno, CASE WHEN l_tax = 0 AND l_discount = 0 THEN ' ' ELSE concat('Order ', CAST(l_orderkey AS VARCHAR(20))) END AS process_name,
               CASE WHEN l_linenumber = 1 THEN 'production' WHEN l_returnflag = 'A' THEN 'biosphere' WHEN l_tax > 0.075 THEN 'other' ELSE 'technosphere' END AS exchange_type,
               CASE WHEN l_returnflag = 'A' THEN CAST(l_suppkey AS VARCHAR(20)) END AS flow_uuid,
               CASE WHEN l_linenumber = 1 OR l_returnflag = 'A' THEN NULL WHEN l_discount > 0.09 THEN '' WHEN l_discount < 0.01 THEN 'none' ELSE CAST(l_partkey AS VARCHAR(20)) END AS provider_uuid,
               CASE WHEN l_discount = 0.05 THEN 'n/a' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR(20)) END AS amount,
               CASE WHEN l_linenumber % 3 = 0 THEN 'g' WHEN l_linenumber % 3 = 1 THEN 'kg' ELSE 'h' END AS unit, CASE WHEN l_linenumber = 1 THEN 'TRUE' ELSE 'no' END AS is_ref
        FROM lineitem""",
    # Scenarios: segments, with scores by region and a unit that not all share.
    "scenario": """
        SELECT c_mktsegment AS scenario, r_name AS method, SUM(c_acctbal) / 1000 AS score, MIN(c_custkey) AS pos FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY c_mktsegment, r_name""",
    "scenario_unit": """
        SELECT c_mktsegment AS scenario, c_custkey AS pos, CASE WHEN c_acctbal < 0 THEN NULL WHEN length(c_mktsegment) > 8 THEN '1 m3' ELSE '1 kg' END AS functional_unit FROM customer""",
    "cell": """
        SELECT c_mktsegment AS process, n_name AS category, SUM(c_acctbal) AS computed, SUM(CASE WHEN c_custkey % 200 = 7 THEN c_acctbal * 1.2 ELSE c_acctbal END) AS reference FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY c_mktsegment, n_name""",
    "flow_list": """
        SELECT c_nationkey * 1000 + c_custkey % 37 AS flow_id, c_mktsegment AS name, CASE WHEN c_acctbal > 5000 THEN 'MJ' ELSE 'kg' END AS unit, concat(CASE WHEN c_acctbal < 2000 THEN 'resource' ELSE 'air' END, ' / ', c_mktsegment, ' / ') AS context, CASE WHEN c_acctbal > 9000 THEN 'Resource' ELSE 'Emission' END AS class FROM customer""",
}

#: Views that a view reads.
NEEDS = {"product": ("output",), "factor": ("output", "product", "declared"), "cyclic": ("technosphere",),
         "import_exchange": ("import_line",), **{f"import_{n}": ("import_line", "import_exchange") for n in ("inside", "conversion", "step", "factor")}}


def register(spark: SparkSession, sf_dir: str) -> None:
    for name in TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


class Views:
    """The views of one data folder as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        register(spark, sf_dir)
        self.spark = spark
        self.stored: dict[str, str] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in VIEWS:
            raise AttributeError(name)
        return self.spark.sql(with_views(f"SELECT * FROM {name}", name, stored=self.stored))

    def store(self, name: str) -> None:
        """From now on the view, and those that need it, read its rows as written once."""
        path = new_path(self.spark, name)
        cut(getattr(self, name), path)
        self.stored[name] = f"SELECT * FROM parquet.`{path}`"


def with_views(body: str, *names: str, recursive: str = "", stored: dict[str, str] | None = None) -> str:
    """A statement with the views it names, and what they need, in front; `recursive` is a recursive part, stored views have other statements."""
    order, stored = [], stored or {}
    for name in names:
        for n in (*(() if name in stored else NEEDS.get(name, ())), name):
            if n not in order:
                order.append(n)
    parts = [f"{n} AS ({stored.get(n, VIEWS[n])})" for n in order] + ([recursive] if recursive else [])
    head = f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(parts)} " if parts else ""
    return head + body
