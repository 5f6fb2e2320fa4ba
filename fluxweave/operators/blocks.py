"""Network solve by strongly connected components in topological order.

Where amounts run in circles that amplify them the series of `solve.propagate` has no limit, though the
network has a solution. Here every node gets the rank of its component in the network without cycles, once; the
edges are stored by the rank of their source, so each is read once. Rank by rank, what has arrived at
nodes outside of cycles is final and passed on. A component of more than one node, or with an edge to itself, is
solved for all keys: x = b + W x. Small ones are dense systems in tasks of bounded size; large ones are solved
together by conjugate gradients on the normal equations, whose products are joins and whose inner products are
aggregates for each key and component.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fluxweave.plans.lineage import cut, drop, new_path

#: Rounds that make one job, nodes of a component that one task solves, rows of its right-hand sides.
STEP, DENSE, SHARE = 4, 600, 200_000
#: Steps, there and back along the edges, that close the small networks.
LOOKS = 3
#: Rows of edges and right-hand sides that components solved in one call share, and numbers of one batch of systems.
BIN, CELLS = 50_000, 2_000_000
#: Residual over right-hand side at which the iteration ends, and its most rounds.
TOLERANCE, MAX_ROUNDS = 1e-12, 2_000


class Singular(RuntimeError):
    """A component has no single solution."""


def _trim(edges: DataFrame, folder: str) -> DataFrame:
    """Edges that lie on cycles or between them: those from sources and to sinks go until none is left."""
    edges, n, step = cut(edges, f"{folder}/trim=0"), -1, 0
    while (now := edges.count()) != n and now:
        n, step = now, step + 1
        for _ in range(STEP if step > 1 else 1):  # where nothing goes, one round shows it
            edges = edges.join(edges.select(F.col("dst").alias("src")).distinct(), "src", "left_semi")
            edges = edges.join(edges.select(F.col("src").alias("dst")).distinct(), "dst", "left_semi")
        edges = cut(edges.select("src", "dst"), f"{folder}/trim={step}")
        drop(edges.sparkSession, f"{folder}/trim={step - 1}")
    return edges


def _spread(labels: DataFrame, edges: DataFrame, path: str) -> DataFrame:
    """labels (node, label), each node's the largest of those that lead to it along edges (src, dst)."""
    step, changed = 0, True
    labels = cut(labels, f"{path}=0")
    while changed:
        before, step = labels, step + 1
        for _ in range(STEP):
            given = labels.join(edges, F.col("node") == F.col("src")).select(F.col("dst").alias("node"), "label")
            labels = labels.unionByName(given).groupBy("node").agg(F.max("label").alias("label"))
        labels = cut(labels, f"{path}={step}")
        changed = not labels.join(before, ["node", "label"], "left_anti").isEmpty()
        drop(labels.sparkSession, f"{path}={step - 1}")
    return labels


def strong_components(edges: DataFrame, folder: str) -> DataFrame:
    """node, comp of all nodes on cycles; comp is one of the component's nodes.

    Every node takes the largest node that leads to it and the largest that it leads to. The ends of an edge
    inside a component agree in both, so other edges go. Where none goes any more, the two largest are one node,
    which leads to all of its part and back.
    """
    live, turn = _trim(edges.select("src", "dst").distinct(), f"{folder}/0"), 0
    while True:
        turn += 1
        nodes = live.select(F.col("src").alias("node")).unionByName(live.select(F.col("dst").alias("node"))).distinct().withColumn("label", F.col("node"))
        above = _spread(nodes, live, f"{folder}/{turn}/above")
        below = _spread(nodes, live.select(F.col("dst").alias("src"), F.col("src").alias("dst")), f"{folder}/{turn}/below")
        both = above.join(below.withColumnRenamed("label", "low"), "node").withColumn("l", F.struct("label", "low")).select("node", "l")
        kept = live.join(both.select(F.col("node").alias("src"), F.col("l").alias("a")), "src").join(both.select(F.col("node").alias("dst"), F.col("l").alias("b")), "dst").where("a = b").select("src", "dst")
        n, kept = live.count(), cut(kept, f"{folder}/{turn}/kept")
        if kept.count() == n:
            return above.withColumnRenamed("label", "comp")
        live = _trim(kept, f"{folder}/{turn}")


def ranks(nodes: DataFrame, edges: DataFrame, folder: str) -> DataFrame:
    """node, comp (null outside of cycles), rank: every edge between components leads to a higher rank."""
    comps = cut(strong_components(edges, f"{folder}/scc"), f"{folder}/components")
    placed = cut(nodes.join(comps, "node", "left").withColumn("part", F.coalesce("comp", "node")), f"{folder}/parts")
    of = lambda end: placed.select(F.col("node").alias(end), F.col("part").alias(f"{end}_part"))
    between = cut(edges.join(of("src"), "src").join(of("dst"), "dst").where("src_part <> dst_part").select(F.col("src_part").alias("src"), F.col("dst_part").alias("dst")).distinct(), f"{folder}/between")
    rank, step, changed = cut(placed.select(F.col("part").alias("node"), F.lit(0).alias("label")).distinct(), f"{folder}/rank=0"), 0, True
    while changed:
        before, step = rank, step + 1
        for _ in range(STEP):
            given = rank.join(between, F.col("node") == F.col("src")).select(F.col("dst").alias("node"), (F.col("label") + 1).alias("label"))
            rank = rank.unionByName(given).groupBy("node").agg(F.max("label").alias("label"))
        rank = cut(rank, f"{folder}/rank={step}")
        changed = not rank.join(before, ["node", "label"], "left_anti").isEmpty()
        drop(rank.sparkSession, f"{folder}/rank={step - 1}")
    return placed.join(rank.select(F.col("node").alias("part"), F.col("label").alias("rank")), "part").select("node", "comp", "rank")


def _dense(b: pd.DataFrame, w: pd.DataFrame, leave: bool = False) -> pd.DataFrame:
    """Small components, some of the keys of each: (I - W) x = b. Those with equally many nodes and keys are one batch.

    leave: one that has no single solution is no error; its right-hand side comes back with `left`.
    """
    if b.empty:
        return b[["key", "node", "v"]].assign(**{"left": False} if leave else {})
    comps = pd.Index(b.comp.unique())
    w = w[w.comp.isin(comps)]
    ends = pd.concat([w[["comp", end]].set_axis(["comp", "node"], axis=1) for end in ("src", "dst")]).drop_duplicates("node")
    nodes, owner = pd.Index(ends.node), comps.get_indexer(ends.comp)
    row = ends.groupby("comp").cumcount().to_numpy()
    side = b.groupby(["comp", "key"], sort=False, dropna=False).ngroup().to_numpy()
    first = np.unique(side, return_index=True)[1]
    side_owner = comps.get_indexer(b.comp.iloc[first])
    column, keys = pd.Series(side_owner).groupby(side_owner).cumcount().to_numpy(), b.key.to_numpy()[first]
    n, k = np.bincount(owner, minlength=len(comps)), np.bincount(side_owner, minlength=len(comps))
    # Place of each component in the order of its shape, and of its batch.
    order = np.lexsort((k, n))
    shape = np.cumsum(np.r_[0, (np.diff(n[order]) != 0) | (np.diff(k[order]) != 0)])
    place = np.arange(len(order)) - np.searchsorted(shape, shape)
    most = np.maximum(1, CELLS // (n * (n + k)))[order]
    number = np.cumsum(np.r_[0, (np.diff(shape) != 0) | (np.diff(place // most) != 0)])
    batch, slot = np.empty_like(order), np.empty_like(order)
    batch[order], slot[order] = number, place % most

    def by_batch(of):
        """Row numbers of each batch, given the component of every row."""
        sorted_ = np.argsort(batch[of], kind="stable")
        return np.split(sorted_, np.searchsorted(batch[of][sorted_], np.arange(1, number[-1] + 1)))

    w_comp, b_comp = comps.get_indexer(w.comp), comps.get_indexer(b.comp)
    w_src, w_dst, b_node = row[nodes.get_indexer(w.src)], row[nodes.get_indexer(w.dst)], row[nodes.get_indexer(b.node)]
    w_value, b_value, found = w.w.to_numpy(float), b.v.to_numpy(float), []
    members = np.split(order, np.searchsorted(number, np.arange(1, number[-1] + 1)))
    for mine, of_w, of_b, of_node, of_side in zip(members, by_batch(w_comp), by_batch(b_comp), by_batch(owner), by_batch(side_owner), strict=True):
        size, width = n[mine[0]], k[mine[0]]
        m = np.tile(np.eye(size), (len(mine), 1, 1))
        np.subtract.at(m, (slot[w_comp[of_w]], w_dst[of_w], w_src[of_w]), w_value[of_w])
        right = np.zeros((len(mine), size, width))
        np.add.at(right, (slot[b_comp[of_b]], b_node[of_b], column[side[of_b]]), b_value[of_b])
        bad = ~(np.linalg.cond(m) <= 1e14)
        if bad.any() and not leave:
            raise Singular(f"the component of {comps[mine[bad][0]]} has no single solution")
        m[bad] = np.eye(size)
        x = np.linalg.solve(m, right)
        name, key = np.empty((len(mine), size), int), np.empty((len(mine), width), int)
        name[slot[owner[of_node]], row[of_node]] = of_node
        key[slot[side_owner[of_side]], column[of_side]] = of_side
        c, i, j = np.nonzero(x)
        found.append(pd.DataFrame({"key": keys[key[c, j]], "node": nodes.to_numpy()[name[c, i]], "v": x[c, i, j]} | ({"left": bad[c]} if leave else {})))
    return pd.concat(found)


def _in_calls(mine: DataFrame, inner: DataFrame, n_edges: int, salt: int, schema: StructType, leave: bool = False) -> DataFrame:
    """_dense of components: mine (comp, key, node, v), inner (comp, src, dst, w)."""
    shares = mine.groupBy("comp").agg(F.ceil(F.count(F.lit(1)) / SHARE).cast("int").alias("shares"))
    # A call costs far more than a small system, so components share calls; their number grows with the rows.
    bins = 1 + (mine.count() + n_edges) // BIN
    bin_ = F.pmod(F.xxhash64("comp", F.lit(salt)), F.lit(bins)).cast("long").alias("bin")
    dealt = mine.join(shares, "comp").withColumn("share", F.pmod(F.xxhash64("key"), "shares").cast("int"))
    sent = inner.join(shares, "comp").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
    return dealt.select(bin_, "share", "comp", "key", "node", "v").groupBy("bin", "share").cogroup(sent.select(bin_, "share", "comp", "src", "dst", "w").groupBy("bin", "share")).applyInPandas(lambda b, w: _dense(b[["comp", "key", "node", "v"]], w, leave), schema)


def _islands(seed: DataFrame, edges: DataFrame, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(key, node, v of small networks that nothing else leads to or from; seed and edges of all others).

    Every node takes the smallest node that a few steps along edges, either way, lead to. Where no edge leaves those of
    one label they are one network, which one task solves whole. What the steps don't close is left, as is what has no
    single solution by one system.
    """
    labels = edges.select(F.col("src").alias("node")).unionByName(edges.select(F.col("dst").alias("node"))).distinct().withColumn("label", F.col("node"))
    for step in range(LOOKS):
        low = edges.join(labels, F.col("src") == F.col("node")).groupBy("dst").agg(F.min("label").alias("label")).withColumnRenamed("dst", "node")
        labels = labels.unionByName(low).groupBy("node").agg(F.min("label").alias("label"))
        low = edges.join(labels, F.col("dst") == F.col("node")).groupBy("src").agg(F.min("label").alias("label")).withColumnRenamed("src", "node")
        # Each step is written, so that no more than its own shuffles lie on disk.
        labels = cut(labels.unionByName(low).groupBy("node").agg(F.min("label").alias("label")), f"{folder}/labels={step}")
        drop(edges.sparkSession, f"{folder}/labels={step - 1}")
    of = lambda end: labels.select(F.col("node").alias(end), F.col("label").alias(f"{end}_label"))
    placed = cut(edges.join(of("src"), "src").join(of("dst"), "dst"), f"{folder}/labelled")
    open_ = placed.where("src_label <> dst_label").select(F.explode(F.array("src_label", "dst_label")).alias("label"))
    large = labels.groupBy("label").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > DENSE).select("label")
    open_ = cut(open_.unionByName(large).distinct(), f"{folder}/open")
    inner = placed.join(open_, F.col("src_label") == F.col("label"), "left_anti").select(F.col("src_label").alias("comp"), "src", "dst", "w")
    n = inner.count()
    if not n:
        return seed.select("key", "node", F.col("value").alias("v")).where(F.lit(False)), seed, edges
    closed = labels.join(open_, "label", "left_anti").select("node", F.col("label").alias("comp"))
    mine = cut(seed.join(closed, "node").groupBy("comp", "key", "node").agg(F.sum("value").alias("v")), f"{folder}/islands")
    schema = mine.select("key", "node", "v", F.lit(True).alias("left")).schema
    solved = cut(_in_calls(mine, inner, n, 0, schema, True), f"{folder}/solved")
    drop(edges.sparkSession, f"{folder}/islands")
    left = solved.where("left").select("node").distinct()
    if left.isEmpty():
        done = closed
    else:
        done = closed.join(cut(left.join(closed, "node").select("comp").distinct(), f"{folder}/left"), "comp", "left_anti")
    rest = cut(seed.join(done, "node", "left_anti"), f"{folder}/rest")
    behind = cut(edges.join(done.select(F.col("node").alias("src")), "src", "left_anti"), f"{folder}/rest-edges")
    drop(edges.sparkSession, f"{folder}/labelled")
    return solved.join(left, "node", "left_anti").select("key", "node", "v"), rest, behind


def _krylov(b: DataFrame, inner: DataFrame, folder: str) -> DataFrame:
    """key, node, v with x = b + W x for b (key, comp, node, v) and the edges (comp, src, dst, w) of large components."""
    zero = F.lit(0.0)

    def times(v: DataFrame, name: str, out: str, back: bool = False) -> DataFrame:
        """(I - W) v, or its transpose's product."""
        a, z = ("dst", "src") if back else ("src", "dst")
        moved = v.select("key", "comp", F.col("node").alias(a), name).join(inner, ["comp", a]).select("key", "comp", F.col(z).alias("node"), (-F.col(name) * F.col("w")).alias(out))
        return v.select("key", "comp", "node", F.col(name).alias(out)).unionByName(moved).groupBy("key", "comp", "node").agg(F.sum(out).alias(out))

    group, at = ["key", "comp"], ["key", "comp", "node"]
    start = b.groupBy(*at).agg(F.sum("v").alias("r"))
    state = cut(times(start, "r", "z", back=True).join(start, at, "full").select(*at, zero.alias("x"), F.coalesce("r", zero).alias("r"), F.coalesce("z", zero).alias("z")).withColumn("p", F.col("z")), f"{folder}/step=0")
    norms = cut(state.groupBy(*group).agg(F.sum(F.col("r") ** 2).alias("b2"), F.sum(F.col("z") ** 2).alias("z2")), f"{folder}/norm=0")
    for step in range(1, MAX_ROUNDS + 1):
        w = cut(times(state, "p", "w"), f"{folder}/w={step}")
        alpha = w.groupBy(*group).agg(F.sum(F.col("w") ** 2).alias("w2")).join(norms, group).select(*group, F.try_divide("z2", "w2").alias("alpha"))
        moved = state.join(w, at, "full").join(alpha, group, "left").select(*at, *((F.coalesce(c, zero) + s * F.coalesce("alpha", zero) * F.coalesce(o, zero)).alias(c) for c, s, o in (("x", 1, "p"), ("r", -1, "w"))), F.coalesce("p", zero).alias("p"))
        moved = cut(moved, f"{folder}/moved={step}")
        slope = times(moved, "r", "z", back=True)
        both = cut(moved.join(slope, at, "full").select(*at, *(F.coalesce(c, zero).alias(c) for c in ("x", "r", "z", "p"))), f"{folder}/both={step}")
        new = both.groupBy(*group).agg(F.sum(F.col("r") ** 2).alias("r2"), F.sum(F.col("z") ** 2).alias("new_z2"))
        new = cut(new.join(norms, group), f"{folder}/norms={step}")
        if new.where(F.col("r2") > TOLERANCE**2 * F.col("b2")).isEmpty():
            return both.where("x <> 0").select("key", "node", F.col("x").alias("v"))
        beta = new.select(*group, F.coalesce(F.try_divide("new_z2", "z2"), zero).alias("beta"))
        state = cut(both.join(beta, group).select(*at, "x", "r", "z", (F.col("z") + F.col("beta") * F.col("p")).alias("p")), f"{folder}/step={step}")
        norms = new.select(*group, "b2", F.col("new_z2").alias("z2"))
    raise Singular(f"no solution of a component in {MAX_ROUNDS} rounds")


def ordered_totals(seed: DataFrame, edges: DataFrame) -> DataFrame:
    """seed (key, node, value) and all that the edges (src, dst, w) pass on, cycles solved: key, node, total."""
    spark = seed.sparkSession
    folder = new_path(spark, "ordered")
    edges = cut(edges.select("src", "dst", "w"), f"{folder}/edges")
    seed = cut(seed.select("key", "node", "value"), f"{folder}/seed")
    islands, seed, edges = _islands(seed, edges, f"{folder}/islands-of")
    if seed.isEmpty():
        return islands.withColumnRenamed("v", "total")
    nodes = edges.select(F.col("src").alias("node")).unionByName(edges.select(F.col("dst").alias("node"))).unionByName(seed.select("node")).distinct()
    ranked = cut(ranks(nodes, edges.select("src", "dst"), folder), f"{folder}/ranked")
    a, b = (ranked.select(F.col("node").alias(e), F.col("comp").alias(f"{e}_comp"), F.col("rank").alias(f"{e}_rank")) for e in ("src", "dst"))
    stored = edges.join(a, "src").join(b, "dst").withColumn("inner", F.coalesce(F.col("src_comp") == F.col("dst_comp"), F.lit(False)))
    stored = stored.select("src", "dst", "w", F.col("src_comp").alias("comp"), "dst_rank", "inner", "src_rank")
    stored.write.partitionBy("inner", "src_rank").parquet(f"{folder}/by-rank")
    by_rank = spark.read.schema(stored.schema).parquet(f"{folder}/by-rank")
    sizes = ranked.where("comp is not null").groupBy("comp", "rank").agg(F.count(F.lit(1)).alias("n"))
    sizes = cut(sizes, f"{folder}/sizes")
    cyclic = {r["rank"]: (r["small"], r["large"]) for r in sizes.groupBy("rank").agg(F.max(F.col("n") <= DENSE).alias("small"), F.max(F.col("n") > DENSE).alias("large")).collect()}
    edges_at = {r["src_rank"]: r["n"] for r in by_rank.where("inner").groupBy("src_rank").agg(F.count(F.lit(1)).alias("n")).collect()}
    deepest = ranked.agg(F.max("rank")).first()[0]
    first = seed.groupBy("key", "node").agg(F.sum("value").alias("v")).join(ranked.select("node", "comp", F.col("rank").alias("at")), "node").select("key", "node", "v", "comp", "at")
    arrived, total = f"{folder}/arrived", f"{folder}/total"
    first.write.partitionBy("at").parquet(arrived)
    shape = first.select("key", "node", "v", "comp", "at").schema
    done = spark.createDataFrame([], first.select("key", "node", "v").schema)
    for rank in range((-1 if deepest is None else deepest) + 1):
        here = spark.read.schema(shape).parquet(arrived).where(F.col("at") == rank).groupBy("key", "node", "comp").agg(F.sum("v").alias("v"))
        small, large = cyclic.get(rank, (False, False))
        parts = [here.where("comp is null").select("key", "node", "v")]
        if small or large:
            here = cut(here.join(sizes.where(F.col("rank") == rank).select("comp", "n"), "comp", "left"), f"{folder}/here={rank}")
            parts = [here.where("comp is null").select("key", "node", "v")]
            inner = by_rank.where(F.col("inner") & (F.col("src_rank") == rank)).select("comp", "src", "dst", "w")
        if small:
            parts.append(_in_calls(here.where(F.col("n") <= DENSE), inner, edges_at.get(rank, 0), rank, done.schema))
        if large:
            big = sizes.where((F.col("rank") == rank) & (F.col("n") > DENSE)).select("comp")
            parts.append(_krylov(here.where(F.col("n") > DENSE).select("key", "comp", "node", "v"), cut(inner.join(big, "comp", "left_semi"), f"{folder}/inner={rank}"), f"{folder}/krylov={rank}"))
        now = cut(reduce(DataFrame.unionByName, parts), f"{total}/rank={rank}")
        if rank < deepest:
            out = by_rank.where(~F.col("inner") & (F.col("src_rank") == rank)).select(F.col("src").alias("node"), "dst", "w", F.col("dst_rank").alias("at"))
            given = now.where("v <> 0").join(out, "node").groupBy("key", F.col("dst").alias("node"), "at").agg(F.sum(F.col("v") * F.col("w")).alias("v"))
            given.join(ranked.select("node", "comp"), "node").select("key", "node", "v", "comp", "at").write.mode("append").partitionBy("at").parquet(arrived)
    if deepest is None:
        return islands.unionByName(done).withColumnRenamed("v", "total")
    return islands.unionByName(spark.read.schema(done.schema).parquet(*(f"{total}/rank={r}" for r in range(deepest + 1)))).withColumnRenamed("v", "total")
