"""Catalogue search: merged builds, an index of grams, ranked matches, suggestions, look-up of a target."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fluxweave.functions.text import head_segment, tokens
from fluxweave.plans.lineage import cut

#: Most queries that are sent to every task at once.
BLOCK = 1000
#: Characters of the longest gram; grams of a token that are looked up, the rarest first.
GRAM, PROBES = 3, 2


def merge_builds(catalogue: DataFrame) -> DataFrame:
    """code, name and the builds that have it, in the order of pos (code, name, db, pos)."""
    seen = F.transform(F.array_sort(F.collect_list(F.struct("pos", "db"))), lambda s: s["db"])
    return catalogue.groupBy("code", "name").agg(F.array_join(F.array_distinct(seen), ",").alias("dbs"), F.min("pos").alias("first_pos"))


def match(name: Column, query: Column) -> Column:
    """Every token of the query occurs in the name."""
    return F.forall(tokens(query), lambda t: F.lower(name).contains(t))


def rank_key(name: Column, query: Column) -> list[Column]:
    """Sort keys, best first: exact name, all tokens in the head, prefix, length, name."""
    q, low = F.lower(F.trim(query)), F.lower(name)
    head = F.forall(tokens(query), lambda t: head_segment(name).contains(t))
    return [F.when(low == q, 0).otherwise(1), F.when(head, 0).otherwise(1), F.when(low.startswith(q), 0).otherwise(1), F.length(name), name]


def against_all(rows: DataFrame, queries: DataFrame, on: Column) -> DataFrame:
    """rows beside each query for which `on` holds. Queries go to every task in blocks of about BLOCK."""
    n = max(1, -(-queries.count() // BLOCK))
    blocks = [queries.where(F.pmod(F.xxhash64("query"), F.lit(n)) == i) for i in range(n)] if n > 1 else [queries]
    return reduce(DataFrame.unionByName, [rows.join(F.broadcast(b), on) for b in blocks])


class Index(NamedTuple):
    """entries (code, name, key), postings (gram, key) and their number (gram, n_keys); a key stands for a lower-case name."""

    entries: DataFrame
    postings: DataFrame
    counts: DataFrame


def _grams(low: Column, size: int) -> Column:
    n = F.length(low) - size + 1
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.substr(low, i, F.lit(size)))).otherwise(F.array().cast("array<string>"))


def build_index(catalogue: DataFrame, path: str) -> Index:
    """An index of the catalogue's names (code, name), written once and read by every later search.

    Grams of one to three characters are rows, not lists, laid out by (gram, key): a gram that every name holds is
    spread over tasks and files. The empty gram stands for every name. Names that are null are found by nothing.
    """
    rows = catalogue.where("name is not null").select("code", "name", F.xxhash64(F.lower("name")).alias("key"))
    rows.write.parquet(f"{path}/entries")
    low = F.lower("name")
    every = F.array_distinct(F.concat(F.array(F.lit("")), *(_grams(low, k) for k in range(1, GRAM + 1))))
    names = rows.select("key", low.alias("name")).distinct()
    postings = names.select(F.explode(every).alias("gram"), "key").distinct()
    postings = cut(postings.repartitionByRange("gram", "key").sortWithinPartitions("gram", "key"), f"{path}/postings")
    postings.groupBy("gram").agg(F.count(F.lit(1)).alias("n_keys")).write.parquet(f"{path}/counts")
    return open_index(catalogue.sparkSession, path)


def open_index(spark: SparkSession, path: str) -> Index:
    return Index(*(spark.read.parquet(f"{path}/{part}") for part in Index._fields))


def candidates(index: Index, queries: DataFrame) -> DataFrame:
    """query and the keys of all names that hold the rarest grams of each of its tokens."""
    own = F.when(F.length("token") < GRAM, F.array("token")).otherwise(F.array_distinct(_grams(F.col("token"), GRAM)))
    words = F.when(F.size(tokens(F.col("query"))) > 0, F.array_distinct(tokens(F.col("query")))).otherwise(F.array(F.lit("")))
    wanted = queries.select("query").distinct().select("query", F.explode(words).alias("token")).select("query", "token", F.explode(own).alias("gram"))
    # A gram that no name holds comes first, and leaves its query without candidates.
    w = Window.partitionBy("query", "token").orderBy(F.coalesce("n_keys", F.lit(0)), "gram")
    probes = wanted.join(index.counts, "gram", "left").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= PROBES).select("query", "gram").distinct()
    needed = probes.groupBy("query").agg(F.count(F.lit(1)).alias("needed"))
    held = probes.join(index.postings, "gram").groupBy("query", "key").agg(F.count(F.lit(1)).alias("held"))
    return held.join(needed, "query").where("held = needed").select("query", "key")


def search(index: Index, queries: DataFrame, limit: int = 20) -> DataFrame:
    """Best matches of each query (query): query, rank, code, name, total. limit 0 gives all.

    Candidates come from the index and are verified; the catalogue itself is met by key alone.
    """
    hits = candidates(index, queries).join(index.entries, "key").where(match(F.col("name"), F.col("query")))
    w = Window.partitionBy("query").orderBy(*rank_key(F.col("name"), F.col("query")), "code")
    total = hits.groupBy("query").agg(F.count(F.lit(1)).alias("total"))
    ranked = hits.withColumn("rank", F.row_number().over(w))
    if limit:
        ranked = ranked.where(F.col("rank") <= limit)
    return ranked.join(total, "query").select("query", "rank", "code", "name", "total")


def suggest(catalogue: DataFrame, queries: DataFrame, limit: int = 5, cutoff: float = 0.6) -> DataFrame:
    """Distinct head segments most like each query, by one minus the edit distance over the longer length."""
    heads = catalogue.select(head_segment(F.col("name")).alias("head")).distinct()
    q = F.lower(F.trim(F.col("query")))
    likeness = 1 - F.levenshtein(F.col("head"), q) / F.greatest(F.length("head"), F.length(q), F.lit(1))
    rows = against_all(heads, queries, likeness >= cutoff).withColumn("likeness", likeness)
    w = Window.partitionBy("query").orderBy(F.desc("likeness"), "head")
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit).select("query", "rank", "head", "likeness")


def lookup(catalogue: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted (db, code): found there, or the builds where the code exists. A release suffix is ignored."""
    bare = wanted.select("db", F.regexp_replace("code", "_[0-9a-f]{40}$", "").alias("code"))
    builds = catalogue.groupBy("code").agg(F.array_sort(F.collect_set("db")).alias("builds"))
    rows = bare.join(builds, "code", "left")
    found = F.coalesce(F.array_contains("builds", F.col("db")), F.lit(False))
    return rows.select("db", "code", found.alias("found"), F.when(found, "").otherwise(F.coalesce(F.array_join("builds", ","), F.lit(""))).alias("elsewhere"))
