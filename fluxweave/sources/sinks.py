"""Sinks: guarded stores, replace-by-scenario results, manifests, tagged validation tables.

Stores are versioned tables (`versions`): a write is seen whole or not at all; `read_stored` reads them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from fluxweave.sources import versions


def write_store(df: DataFrame, path: str, key: str = "db", overwrite: bool = False, confirm: Callable[[str], bool] | None = None) -> None:
    """Activities or exchanges by database; an existing store is kept unless overwrite is set or confirm(path) agrees."""
    if versions.exists(path) and not overwrite and (confirm is None or not confirm(path)):
        raise FileExistsError(f"{path} already exists")
    versions.write(df, path, [key], whole=True)


def replace_partitions(df: DataFrame, path: str, key: str) -> None:
    """Rewrite only the partitions that df has rows for."""
    versions.write(df, path, [key])


def write_results(df: DataFrame, path: str) -> int:
    """Results by scenario: a scenario that was there is replaced. The number of scenarios now stored."""
    replace_partitions(df, path, "scenario")
    return len(versions.live(path))


def write_contributions(df: DataFrame, path: str) -> int:
    """Rows written; none, and no table, when df is empty."""
    if df.isEmpty():
        return 0
    written = Observation()
    replace_partitions(df.observe(written, F.count(F.lit(1)).alias("n")), path, "scenario")
    return written.get["n"]


def write_cf(df: DataFrame, path: str) -> None:
    replace_partitions(df, path, "method")


def write_manifest(df: DataFrame, path: str) -> None:
    """One nested row as JSON."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_link_audit(df: DataFrame, path: str) -> None:
    replace_partitions(df, path, "db")


def write_conversions(df: DataFrame, path: str) -> None:
    versions.write(df, path, [])


def inherit_vintage(df: DataFrame, meta: DataFrame, background: str) -> DataFrame:
    """Rows to stamp with the vintage of the background build they rest on; null if that has none."""
    vintage = meta.where(F.col("db") == background).agg(F.max("vintage").alias("vintage"))
    return df.drop("vintage").join(F.broadcast(vintage), F.lit(True))


def stamp_build(df: DataFrame, path: str) -> None:
    """Insert or replace the rows of build_meta of the databases in df."""
    replace_partitions(df, path, "db")


def write_validation(df: DataFrame, path: str, vintage: str, partial: bool) -> None:
    """Runs of another vintage, and partial runs, go to partitions of their own."""
    tagged = df.withColumn("vintage", F.lit(vintage)).withColumn("partial", F.lit(partial))
    versions.write(tagged, path, ["mode", "vintage", "partial"])
