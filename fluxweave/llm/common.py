"""Shared helpers: the shared folder, materialised tables, Arrow batch limits and hot-key joins."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxweave.plans.lineage import cut, new_path  # noqa: F401  (operators take new_path from here)

#: Bytes of one Arrow batch sent to a Python worker, so that long texts do not add up.
BATCH_BYTES = 16 << 20
#: Rows up to which a narrow table is broadcast where several such tables may meet: the driver builds each, at 100 to 250 bytes a row.
FEW = 100_000
#: Bits of a filter for each key, the most bits of a filter (8 MiB), and those that one task packs.
BITS, MOST_BITS, PACK = 64, 1 << 26, 1 << 16


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends, lost executors do not matter."""
    return cut(df, new_path(df.sparkSession, name), compression="zstd")


def arrow_limits(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes as well as by rows."""
    for key, value in (("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES)), ("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")):
        spark.conf.set(key, value)


def clean_text(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, so other columns can have any names."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def join_groups(rows: DataFrame, groups: DataFrame, key: str | list[str], size_col: str, total: int, shares: int = 1000) -> DataFrame:
    """Left-join rows to one-row-per-key groups without sending a hot key to one task.

    Groups that hold more than total / shares rows number at most `shares`, which bounds the
    broadcast; every other key is joined by a shuffle in which no key is large.
    """
    limit = max(1, total // shares)
    hot, cold = groups.where(F.col(size_col) > limit), groups.where(F.col(size_col) <= limit)
    extra = [c for c in groups.columns if c not in ([key] if isinstance(key, str) else key)]
    marked = rows.join(F.broadcast(hot.withColumn("is_hot_", F.lit(True))), key, "left")
    done = marked.where("is_hot_").drop("is_hot_")
    cold = cold if total <= FEW else cold.hint("merge")
    rest = marked.where("is_hot_ is null").drop("is_hot_", *extra).join(cold, key, "left")
    return done.select(*rows.columns, *extra).unionByName(rest.select(*rows.columns, *extra))


def broadcast_if_small(df: DataFrame, rows: int, limit: int = 500_000) -> DataFrame:
    """Broadcast this narrow table only when its counted rows are under the limit; else both sides are shuffled.

    Beyond the limit Spark does not choose by the size of the files, which are many times smaller than the rows.
    """
    return F.broadcast(df) if rows <= limit else df.hint("merge")


def bit_filter(keys: DataFrame, n: int) -> np.ndarray:
    """Bits that are set at the hash (`at_bit`) of each of the n rows of one column: of at most MOST_BITS, however many rows."""
    bits = min(MOST_BITS, max(PACK, 1 << (BITS * max(n, 1) - 1).bit_length()))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        on = np.zeros(PACK, bool)
        on[rows["bit"].to_numpy() % PACK] = True
        return pd.DataFrame({"slice": [int(rows["bit"].iat[0]) // PACK], "packed": [np.packbits(on).tobytes()]})

    hashed = keys.select(at_bit(F.col(keys.columns[0]), bits).alias("bit")).distinct()
    packed = hashed.groupBy((F.col("bit") / PACK).cast("long").alias("of")).applyInPandas(pack, "slice long, packed binary")
    out = np.zeros((bits // PACK, PACK // 8), np.uint8)
    for r in packed.toLocalIterator():
        out[r["slice"]] = np.frombuffer(r["packed"], np.uint8)
    return out.ravel()


def at_bit(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))
