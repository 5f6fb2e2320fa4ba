"""Guards: each counts violations and stops a build before anything is written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class GuardError(ValueError):
    """A guard found rows it must not let through."""


def require_empty(rows: DataFrame, message: str, shown: int = 5) -> None:
    """Raise, with a few rows as examples, unless rows is empty."""
    found = rows.limit(shown).collect()
    if found:
        raise GuardError(f"{message}: {'; '.join(str(r.asDict()) for r in found)}")


def require_some(rows: DataFrame, message: str) -> None:
    """Raise if rows is empty."""
    if rows.isEmpty():
        raise GuardError(message)


def require_columns(df: DataFrame, names: tuple[str, ...], table: str) -> None:
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise GuardError(f"{table}: missing columns {', '.join(missing)}")


# What violates a guard, as rows. The guards below raise on them; `report` counts them.


def empty_columns(consumed: DataFrame, columns: DataFrame) -> DataFrame:
    """Causal co-products that links consume and that have no exchanges of their own."""
    return consumed.select("coproduct_code").distinct().join(columns.select("coproduct_code").distinct(), "coproduct_code", "left_anti")


def without_flow(exchanges: DataFrame) -> DataFrame:
    return exchanges.where("flow_id is null").select("process_id")


def without_production(activities: DataFrame, production: DataFrame) -> DataFrame:
    return activities.select("code").join(production.select("code").distinct(), "code", "left_anti")


def impossible(decisions: DataFrame) -> DataFrame:
    return decisions.where("method = 'failed'")


def unpinned(identity: DataFrame, pins: DataFrame) -> DataFrame:
    """identity and pins: name, sha256. Sources that are there with another content than pinned."""
    return identity.join(pins.withColumnRenamed("sha256", "pinned"), "name").where("sha256 <> pinned")


def repeated(index: DataFrame, key: str) -> DataFrame:
    return index.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def missing_builds(wanted: DataFrame, meta: DataFrame) -> DataFrame:
    return wanted.select("db").distinct().join(meta.select("db").distinct(), "db", "left_anti")


def report(found: dict[str, DataFrame]) -> DataFrame:
    """guard and n_violations for the violations of several guards."""
    counts = [rows.agg(F.count(F.lit(1)).alias("n_violations")).select(F.lit(name).alias("guard"), "n_violations") for name, rows in found.items()]
    whole = counts[0]
    for c in counts[1:]:
        whole = whole.unionByName(c)
    return whole


def known_units(unknown: DataFrame, allow: bool = False) -> None:
    if not allow:
        require_empty(unknown, "unknown units")


def consumed_columns_filled(consumed: DataFrame, columns: DataFrame) -> None:
    """Causal co-products that links consume must have exchanges of their own."""
    require_empty(empty_columns(consumed, columns), "consumed co-products without exchanges")


def flows_named(exchanges: DataFrame) -> None:
    require_empty(without_flow(exchanges), "exchanges without a flow")


def production_present(activities: DataFrame, production: DataFrame) -> None:
    require_empty(without_production(activities, production), "activities without production")


def allocation_possible(decisions: DataFrame) -> None:
    """Several outputs need a reference, and a mass fallback needs a mass of the reference."""
    require_empty(impossible(decisions), "allocation is impossible")


def flow_list(flows: DataFrame, conflicts: DataFrame, least: int, columns: tuple[str, ...] = ()) -> None:
    """The list has its columns and enough rows, and no id names two flows."""
    require_columns(flows, columns, "flow list")
    n = flows.count()
    if n < least:
        raise GuardError(f"the flow list has {n} rows, {least} are expected at least")
    require_empty(conflicts, "flow ids with several identities")


def hash_pinned(identity: DataFrame, pins: DataFrame) -> None:
    """identity and pins: name, sha256."""
    require_empty(unpinned(identity, pins), "content differs from its pin")


def method_count(cf: DataFrame, expected: int) -> None:
    n = cf.select("method").distinct().count()
    if n != expected:
        raise GuardError(f"{n} methods, {expected} are expected")


def plausible(rows: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Rows outside the plausible range; a warning, not an error."""
    return rows.where(~F.col(column).between(low, high))


def index_complete(index: DataFrame, key: str, expected: int) -> None:
    n = index.count()
    if n != expected:
        raise GuardError(f"the index has {n} entries for {expected} rows")
    require_empty(repeated(index, key), "ids that occur twice in the index")


def single_reference(several: DataFrame) -> None:
    require_empty(several, "processes with more than one reference")


def stale(meta: DataFrame, current: str) -> DataFrame:
    """Builds stamped with another flow-list version than the current one."""
    return meta.withColumn("stale", ~F.col("flow_version").eqNullSafe(F.lit(current)))


def require_build(meta: DataFrame, db: str) -> None:
    if meta.where(F.col("db") == db).isEmpty():
        known = sorted(r["db"] for r in meta.select("db").distinct().limit(100).collect())
        raise GuardError(f"no build {db!r}; there are {', '.join(known)}")
