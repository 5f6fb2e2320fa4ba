"""Sources: process, flow and foreground scans with explicit schemas, content identity, gates."""

from __future__ import annotations

import hashlib
import warnings
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fluxweave.functions import schemas
from fluxweave.operators import guards, search
from fluxweave.sources import versions

#: Names of source archives: an id, an underscore and a release hash.
SOURCE_NAME = r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}_[0-9A-Za-z]+\.zip$"
#: Bytes of a file that are read at once.
BLOCK_BYTES = 8 << 20


def require_columns(df: DataFrame, table: str) -> DataFrame:
    """df, if it has the columns that the table needs."""
    guards.require_columns(df, schemas.REQUIRED[table], table)
    return df


def read_processes(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """raw_process: one row per JSON document (a file, or a line), with its source folder; documents without an id are skipped."""
    raw = spark.read.schema(schemas.PROCESS).option("multiLine", not lines).option("recursiveFileLookup", True).json(path)
    source = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/processes/[^/]+$", 1)
    return raw.select(source.alias("source"), F.col("`@id`").alias("process_id"), "name", "version", F.col("lastChange").alias("last_change"), F.col("location.name").alias("location_name"), F.col("defaultAllocationMethod").alias("default_allocation"), "exchanges", F.col("allocationFactors").alias("allocation_factors")).where("process_id is not null")


def read_flows(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """flow: the last source in name order wins."""
    raw = spark.read.schema(schemas.FLOW).option("multiLine", not lines).option("recursiveFileLookup", True).json(path)
    source = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/flows/[^/]+$", 1)
    rows = raw.select(source.alias("source"), F.col("`@id`").alias("flow_id"), "name", F.col("flowType").alias("flow_type"), F.col("flowProperties").alias("flow_properties")).where("flow_id is not null")
    row = F.struct("name", "flow_type", "flow_properties")
    return rows.groupBy("flow_id").agg(F.max_by(row, "source").alias("row")).select("flow_id", "row.*")


def explode_exchanges(processes: DataFrame) -> DataFrame:
    """raw_exchange: one row per exchange with its position; what is missing gets its default."""
    e = F.col("e")
    rows = processes.select("process_id", F.posexplode("exchanges").alias("pos", "e"))
    flag = lambda f: F.coalesce(e[f], F.lit(False))
    return rows.select(
        "process_id", "pos", e["internalId"].alias("internal_id"), F.coalesce(e["amount"], F.lit(0.0)).alias("amount"), F.coalesce(e["unit"]["name"], F.lit("")).alias("unit"), F.coalesce(e["flowProperty"]["@id"], F.lit("")).alias("fp_id"),
        e["flow"]["@id"].alias("flow_id"), e["flow"]["name"].alias("flow_name"), e["flow"]["flowType"].alias("flow_type"), flag("isInput").alias("is_input"), flag("isQuantitativeReference").alias("is_ref"), flag("isAvoidedProduct").alias("is_avoided"),
        e["defaultProvider"]["@id"].alias("provider_id"), e["defaultProvider"]["name"].alias("provider_name"),
    )


def explode_factors(processes: DataFrame) -> DataFrame:
    f = F.col("f")
    return processes.select("process_id", F.posexplode("allocation_factors").alias("pos", "f")).select("process_id", "pos", f["allocationType"].alias("allocation_type"), f["product"]["@id"].alias("product_flow_id"), f["exchange"]["internalId"].alias("internal_id"), f["value"].alias("value"))


def _digests(files: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in files:
        yield rows.assign(sha256=[_digest(path) for path in rows["path"]])


def _digest(path: str) -> str:
    """SHA-256 of a file, of which one block at a time is in memory."""
    store, name = versions.locate(path)
    state = hashlib.sha256()
    with store.open_input_stream(name) as stream:
        while block := stream.read(BLOCK_BYTES):
            state.update(block)
    return state.hexdigest()


def content_hashes(spark: SparkSession, path: str) -> DataFrame:
    """path, name, sha256 and n_bytes of each file. A file is a stream of blocks in the task that owns it, never one row; Spark lists no empty files."""
    files = spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("n_bytes"))
    hashed = files.mapInPandas(_digests, "path string, n_bytes long, sha256 string")
    return hashed.select("path", F.regexp_extract("path", "([^/]+)$", 1).alias("name"), "sha256", "n_bytes")


def discover_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Files of a folder: path, name, sha256, and whether the name is one of a source."""
    return content_hashes(spark, folder).select("path", "name", "sha256", F.col("name").rlike(SOURCE_NAME).alias("accepted"))


def choose_sources(found: DataFrame, full: str | None = None) -> DataFrame:
    """The files a build reads: those with a source's name, or the one called `full`. None at all is an error."""
    chosen = found.where(F.col("accepted") if full is None else F.col("name") == full)
    guards.require_some(chosen, "no source has an accepted name" if full is None else f"the full source {full} is absent")
    return chosen


def source_identity(spark: SparkSession, path: str) -> DataFrame:
    """name, sha256 and 40-character release suffix of each file."""
    return content_hashes(spark, path).select("name", "sha256", F.regexp_extract("name", "_([0-9a-f]{40})[.]", 1).alias("release"))


def check_pin(identity: DataFrame, name: str | None, sha256: str | None) -> None:
    """Fail if the named source is there with another content; one that is absent is not checked, and without a pin there is a warning."""
    if not name or not sha256:
        warnings.warn("the conversion table names no source: its version cannot be checked", stacklevel=2)
        return
    other = identity.where((F.col("name") == name) & (F.col("sha256") != sha256)).count()
    if other:
        raise ValueError(f"{name} is not the pinned source")


def read_foreground(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a user's CSV with their record number, the header being record 1."""
    raw = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path)
    require_columns(raw, "foreground")
    # One file made by hand; numbering it is the one place that needs an order of input rows.
    numbered = raw.withColumn("at", F.monotonically_increasing_id())
    rows = numbered.withColumn("lineno", F.row_number().over(Window.orderBy("at")) + 1).drop("at")
    if rows.isEmpty():
        raise ValueError("the inventory has no rows")
    return rows


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A Parquet table, if it has the columns it needs."""
    return require_columns(spark.read.parquet(path), table)


def read_stored(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """A table that a sink wrote, as its newest version has it, if it has the columns that the table needs."""
    rows = versions.read(spark, path)
    return rows if table is None else require_columns(rows, table)


def read_reference_scores(df: DataFrame) -> DataFrame:
    """process, mode, category, ol_score: null scores are 0, rows without a category go."""
    return df.where(F.col("category").isNotNull()).withColumn("ol_score", F.coalesce("ol_score", F.lit(0.0)))


def read_catalogue(spark: SparkSession, path: str, db: str | None = None) -> DataFrame:
    """code, name and builds of the activities in a store (pos, db, code, name), of one build or of all; none is an error."""
    rows = read_stored(spark, path)
    rows = rows if db is None else rows.where(F.col("db") == db)
    guards.require_some(rows, "no build is there")
    return search.merge_builds(rows)


def read_library(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(processes, flows, cumulative inventory) of a solved library: three Parquet tables; ids of an index occur once."""
    processes, flows, inventory = (read_table(spark, f"{path}/{t}", f"library_{t}") for t in ("process", "flow", "inventory"))
    for index, key in ((processes, "process_id"), (flows, "row")):
        guards.require_empty(guards.repeated(index, key), "ids that occur twice in the index")
    return processes, flows, inventory
