"""Exact duplicates by immutable snapshots: binary fuse filters screen, exact buckets confirm.

Every snapshot's filters are written once, a file for each snapshot and bucket, and loaded by each later
batch, whatever its size: a snapshot is named by its content, and the number of its buckets, a power of
two, belongs to it. An incoming batch is reduced to one row per digest (hot texts shrink map-side). Each
digest is probed against the filters of its bucket in all snapshots; a batch that needs more buckets than
a snapshot has splits its own side, and the snapshot's filter goes to each part. Positives join the bucket's
exact digests and the two texts are compared byte by byte; negatives are certainly new to the snapshot.
Copies inside the batch are grouped on their own and never touch a filter.

Defined cases: null text counts as empty; a null doc_id loses to any other and a group with only
null ids keeps id null; repeated rows of the winning doc_id all carry kept = true; an empty table
gives an empty result; very long texts are hashed and compared whole; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fuse_filter
from .common import arrow_limits, broadcast_if_small, id_and_text, join_groups, materialize, new_path

#: Distinct digests meant for one bucket, and so for one filter and one task.
BUCKET_KEYS = 100_000
#: Stands for a null id while grouping; it loses to any other.
NO_ID = -(2**63)
FILTER = "seed string, segment int, segments int, slots binary, buckets int, snapshot string, bucket int"


def with_digest(docs: DataFrame) -> DataFrame:
    """doc_id (NO_ID for null), text and text_sha256."""
    return id_and_text(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID))).withColumn("text_sha256", F.sha2(F.col("text").cast("binary"), 256))


def bucket_of(buckets: Column) -> Column:
    """With powers of two, buckets of a larger number lie within those of a smaller one."""
    return F.pmod(F.conv(F.substring("text_sha256", 1, 8), 16, 10).cast("long"), buckets).cast("int")


def group_digests(rows: DataFrame) -> DataFrame:
    """One row per digest: how many rows, and the largest id."""
    return rows.groupBy("text_sha256").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("top_id"))


def buckets_for(n: int) -> int:
    """The power of two that leaves at most BUCKET_KEYS of n digests to a bucket, on average."""
    return 1 << max(0, -(-n // BUCKET_KEYS) - 1).bit_length()


def name_snapshots(digests: DataFrame) -> DataFrame:
    """(old_, snapshot, buckets) of each snapshot in distinct (old_, text_sha256): its name says what its digests are."""
    part = lambda k: F.bit_xor(F.conv(F.substring("text_sha256", 16 * k + 1, 15), 16, 10).cast("long"))
    named = digests.groupBy("old_").agg(F.count(F.lit(1)).alias("n"), *(part(k).alias(f"x{k}") for k in range(4)))
    buckets = F.lit(1)
    for k in range(1, 31):
        buckets = F.when(F.col("n") > BUCKET_KEYS << (k - 1), 1 << k).otherwise(buckets)
    return named.select("old_", F.sha2(F.concat_ws("-", "n", *(f"x{k}" for k in range(4))), 256).alias("snapshot"), buckets.alias("buckets"))


def write_filters(snapshots: DataFrame, store: str) -> DataFrame:
    """Filters of all snapshots in (old_, text_sha256), one for each snapshot and bucket; those that the store has are not built again."""
    spark = snapshots.sparkSession

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        seed, segment, count, table = fuse_filter.build(_keys(pdf["text_sha256"]))
        return pd.DataFrame({"snapshot": [pdf["snapshot"].iat[0]], "bucket": [pdf["bucket"].iat[0]], "buckets": [pdf["buckets"].iat[0]], "seed": [str(seed)], "segment": [segment], "segments": [count], "slots": [table]})

    digests = materialize(snapshots.distinct(), "snapshot-digests")
    named = materialize(name_snapshots(digests), "snapshot-names")
    # A name is listed after its filters are whole; what a lost driver left without a name is built again, and harmless.
    listed = f"{store}/names"
    spark.createDataFrame([], "snapshot string").write.mode("append").parquet(listed)
    missing = materialize(named.join(spark.read.schema("snapshot string").parquet(listed).distinct(), "snapshot", "left_anti"), "snapshots-missing")
    dealt = digests.join(F.broadcast(missing), "old_").withColumn("bucket", bucket_of(F.col("buckets")))
    dealt.groupBy("snapshot", "bucket").applyInPandas(one, FILTER).write.partitionBy("snapshot", "bucket").mode("append").parquet(f"{store}/filters")
    missing.select("snapshot").distinct().write.mode("append").parquet(listed)
    built = spark.read.schema(FILTER).parquet(f"{store}/filters")
    return built.join(F.broadcast(named.select("snapshot").distinct()), "snapshot", "left_semi")


def _keys(digests: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(bytes.fromhex(x[16:32]) for x in digests), ">u8").astype(np.uint64)


def screen(batch: DataFrame, filters: DataFrame, n: int) -> DataFrame:
    """batch (text_sha256, ...), of n rows, with `maybe`: false means certainly in none of the snapshots."""
    fields = batch.schema.add("maybe", "boolean")

    def probe(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        hit = np.zeros(len(left), bool)
        for f in right.itertuples() if len(left) else ():
            hit |= fuse_filter.probe(_keys(left["text_sha256"]), int(f.seed), f.segment, f.segments, f.slots)
        return left.drop(columns="bucket").assign(maybe=hit)

    # The finest of all divisions, so that neither a filter nor a part of the batch outgrows a task.
    parts = max(buckets_for(n), filters.agg(F.max("buckets")).first()[0] or 1)
    spread = F.sequence(F.col("bucket"), F.lit(parts - 1), F.col("buckets"))
    shared = filters.withColumn("bucket", F.explode(spread))
    dealt = batch.withColumn("bucket", bucket_of(F.lit(parts)))
    return dealt.groupBy("bucket").cogroup(shared.groupBy("bucket")).applyInPandas(probe, fields)


def confirm_bytes(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """Of pairs (text_sha256, old_id, new_id), those whose two texts are equal byte by byte."""
    n = pairs.count()
    wanted = pairs.select("text_sha256", F.explode(F.array("old_id", "new_id")).alias("doc_id")).distinct()
    texts = rows.select("doc_id", "text_sha256", "text").join(broadcast_if_small(wanted, 2 * n), ["text_sha256", "doc_id"], "left_semi")
    same = texts.groupBy("text_sha256").agg(F.min("text").alias("a"), F.max("text").alias("b")).where("a = b")
    return pairs.join(same.select("text_sha256"), "text_sha256", "left_semi")


def exact_dedup(docs: DataFrame, in_snapshot: Column | None = None, store: str | None = None) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256.

    in_snapshot: which rows make one earlier snapshot; by default a hash of doc_id deals half of the rows to two.
    store: folder of filters, which later batches load; one writer at a time. By default one of this run alone.
    """
    spark = docs.sparkSession
    arrow_limits(spark)
    dealt = F.pmod(F.xxhash64("doc_id"), F.lit(4)).cast("int")
    rows = with_digest(docs).withColumn("old_", F.when(dealt < 2, dealt) if in_snapshot is None else F.when(in_snapshot, 0))
    digests = materialize(rows.select("doc_id", "text_sha256", "old_"), "digests")
    snapshot = materialize(group_digests(digests.where("old_ is not null")), "snapshot")
    batch = materialize(group_digests(digests.where("old_ is null")), "batch")
    old = digests.where("old_ is not null").select("old_", "text_sha256")
    filters = write_filters(old, store or new_path(spark, "filters"))
    screened = materialize(screen(batch, filters, batch.count()), "screened")
    exact = snapshot.withColumnsRenamed({"n": "old_n", "top_id": "old_id"})
    positive = screened.where("maybe").join(exact, "text_sha256").select("text_sha256", "old_id", F.col("top_id").alias("new_id"))
    known = materialize(confirm_bytes(positive, rows).select("text_sha256"), "known")
    groups = _merge(snapshot, screened, known)
    total = digests.count()
    joined = join_groups(digests.drop("old_"), groups, "text_sha256", "group_size", max(1, total))
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(c)
    return joined.select(real("doc_id"), real("keep_id"), "group_size", (F.col("doc_id") == F.col("keep_id")).alias("kept"), "text_sha256")


def _merge(snapshot: DataFrame, screened: DataFrame, known: DataFrame) -> DataFrame:
    """Group sizes over snapshot and batch.

    A batch digest that the filter refused, or whose bytes differ, stays a group of its own; with
    equal digests its bytes never differ, so digests name the groups.
    """
    again = screened.join(known, "text_sha256", "left_semi").select("text_sha256", "n", "top_id")
    fresh = screened.join(known, "text_sha256", "left_anti").select("text_sha256", "n", "top_id")
    merged = snapshot.select("text_sha256", "n", "top_id").unionByName(again).groupBy("text_sha256").agg(F.sum("n").alias("n"), F.max("top_id").alias("top_id"))
    return merged.unionByName(fresh).select("text_sha256", F.col("n").alias("group_size"), F.col("top_id").alias("keep_id"))
