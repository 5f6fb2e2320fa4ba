"""Network solve: many demands at once, or every activity at once, by rounds of join and aggregate.

The amounts of few keys are columns of one row for each node. Where seeds lie all over the network, nodes outside of
cycles are met in order: each waits for all of its edges and passes its total on once. Elsewhere one round passes the
newest amounts, the frontier, along the edges. A few rounds make one job, which writes
what arrives in each: a round's exchange serves both the write and the next round. Only the frontier is
joined and shuffled; the totals are one sum over all rounds at the end. Rounds end when nothing moves any
more. On a cyclic network amounts only die down: there, now and then, the frontier is held against the sum of
absolute amounts that reached its nodes, a ratio which no unit can disturb. Before that what lies on cycles or behind
them is contracted: a node with one edge into it is a multiple of the node before it, whose edges take its place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from fluxweave.operators.blocks import ordered_totals
from fluxweave.plans.lineage import cut, new_path

#: Smallest live share, most rounds, rounds in a job, and after how many it is first looked whether any share lives.
#: A look sums the rounds since the one before it and comes a quarter of all rounds after it.
TOLERANCE, MAX_ROUNDS, STEP, LOOK = 1e-12, 1000, 4, 8
#: Keys up to which amounts are columns; edges for each seeded node up to which nodes are met in order.
KEYS, SPREAD = 16, 8
#: Share of the nodes that a contraction must take, and the largest edge of a node to itself that is divided out.
LEAST, LOOP = 0.1, 0.5
#: Factors up to which they are broadcast; more of them are joined by a shuffle.
FEW = 500_000


class Diverged(RuntimeError):
    """The amounts did not die down."""


def coefficients(technosphere: DataFrame, production: DataFrame) -> DataFrame:
    """src (consumer), dst (provider), w: provider amount per unit of the consumer's product.

    production (code, amount) may hold several rows of an activity; they are summed.
    """
    made = production.groupBy(F.col("code").alias("src")).agg(F.sum("amount").alias("made"))
    edges = technosphere.groupBy(F.col("consumer").alias("src"), F.col("provider").alias("dst")).agg(F.sum("amount").alias("amount"))
    return edges.join(made, "src").select("src", "dst", (F.col("amount") / F.col("made")).alias("w"))


def distinct_keys(rows: DataFrame, key: str, value: str) -> list | None:
    """The keys of rows that lie in a file, if they are few and no value is null; else None."""
    found = rows.groupBy(key).agg(F.max(F.col(value).isNull()).alias("gap")).limit(KEYS + 1).collect()
    return None if len(found) > KEYS or any(r["gap"] for r in found) else [r[key] for r in found]


def widened(rows: DataFrame, key: str, keys: list, by: str, value: str) -> DataFrame:
    """One row for each `by`: the sum of the first key's values as v0, and so on; null where it has none."""
    kind = rows.schema[key].dataType
    return rows.groupBy(by).agg(*(F.sum(F.when(F.col(key).eqNullSafe(F.lit(k).cast(kind)), F.col(value).cast("double"))).alias(f"v{i}") for i, k in enumerate(keys)))


def lengthened(wide: DataFrame, key: str, keys: list, kind: DataType, value: str) -> DataFrame:
    """The rows that `widened` has laid out: the other columns, key, value."""
    columns = [f"v{i}" for i in range(len(keys))]
    cells = F.array(*(F.struct(F.lit(k).cast(kind).alias(key), F.col(c).alias(value)) for k, c in zip(keys, columns, strict=True)))
    rest = [c for c in wide.columns if c not in columns]
    return wide.select(*rest, F.explode(cells).alias("cell")).select(*rest, "cell.*").where(F.col(value).isNotNull())


def _passed_on(frontier: DataFrame, edges: DataFrame, by: list[str], values: list[str]) -> DataFrame:
    """by, node, values: what the frontier's amounts give to the nodes behind their edges."""
    given = (F.sum(F.nullif(F.col(c), F.lit(0.0)) * F.col("w")).alias(c) for c in values)
    return frontier.where(_moves(values)).join(edges, F.col("node") == F.col("src")).groupBy(*by, F.col("dst").alias("node")).agg(*given)


def _moves(values: list[str]) -> Column:
    return reduce(Column.__or__, (F.coalesce(F.col(c) != 0, F.lit(False)) for c in values))


def _plus(a: Column, b: Column) -> Column:
    """The sum of what is there."""
    return F.coalesce(a + b, a, b)


def _diverged(rows: DataFrame, by: list[str], values: list[str], keys: list, newest: int) -> Diverged:
    size = F.greatest(*(F.abs(c) for c in values)) if len(values) > 1 else F.abs(values[0])
    worst = [f"{r['key'] if by else next(k for k, c in zip(keys, values, strict=True) if r[c] is not None and abs(r[c]) == r['size'])}/{r['node']}" for r in rows.withColumn("size", size).orderBy(F.desc("size")).limit(5).collect()]
    return Diverged(f"no convergence in {newest} rounds; largest at {', '.join(worst)}")


def _series(start: DataFrame, edges: DataFrame, by: list[str], values: list[str], keys: list, folder: str, tolerance: float, max_rounds: int) -> DataFrame:
    """start (by, node, values) summed with all that the edges pass on, round by round."""
    spark, at = start.sparkSession, [*by, "node"]
    path, newest, look = f"{folder}/from=0", 0, LOOK
    frontier = cut(start.withColumn("round", F.lit(0)), path)
    # What has reached a node: sums and absolute sums up to the last look, and the rounds since.
    sizes, shape = [f"size_{c}" for c in values], frontier.schema
    looked, since = None, [path]

    def reached() -> DataFrame:
        rows = spark.read.schema(shape).parquet(*since).select(*at, *values, *(F.abs(c).alias(f"size_{c}") for c in values))
        rows = rows if looked is None else rows.unionByName(looked)
        return rows.groupBy(*at).agg(*(F.sum(c).alias(c) for c in (*values, *sizes)))

    while True:
        live = frontier.where(_moves(values))
        if newest >= look:
            look = newest + max(LOOK, newest // 4)
            looked = cut(reached(), f"{folder}/looked={newest}")
            since = []
            live = live.join(looked.select(*at, *sizes), at).where(reduce(Column.__or__, (F.coalesce(F.abs(c) > tolerance * F.col(f"size_{c}"), F.lit(False)) for c in values)))
        if live.isEmpty():
            return (reached() if since else looked).select(*at, *values)
        if newest >= max_rounds:
            raise _diverged(frontier, by, values, keys, newest)
        rounds = []
        for newest in range(newest + 1, newest + STEP + 1):
            frontier = _passed_on(frontier, edges, by, values)
            rounds.append(frontier.withColumn("round", F.lit(newest)))
        since.append(f"{folder}/from={newest - STEP + 1}")
        frontier = cut(reduce(DataFrame.unionByName, rounds), since[-1]).where(F.col("round") == newest)


def _contracted(start: DataFrame, edges: DataFrame, values: list[str], keys: list, folder: str, tolerance: float, max_rounds: int) -> DataFrame:
    """The series of one row a node, on a smaller network with the same solution.

    Where one edge leads into a node, x = b + w x' with the node x' before it: what it passes on comes from x' and from b
    instead, and the node goes, until too few go at once. Of neighbours that could go one stays for that turn. No turn adds
    edges. The series solves what is left; then those that went are worked out, the last ones first.
    """
    spark, turn, went = start.sparkSession, 0, []
    rows, live = start.select("node", *values), edges.groupBy("src", "dst").agg(F.sum("w").alias("w"))
    while True:
        turn += 1
        here = F.col("src") == F.col("dst")
        entering = live.groupBy(F.col("dst").alias("node")).agg(F.count_if(~here).alias("n"), F.coalesce(F.sum(F.when(here, F.col("w"))), F.lit(0.0)).alias("loop"), F.max(F.when(~here, F.col("src"))).alias("before"), F.sum(F.when(~here, F.col("w"))).alias("w_in"))
        nodes = rows.join(entering, "node", "left").withColumn("loop", F.coalesce("loop", F.lit(0.0)))
        # An edge to itself multiplies all that arrives.
        nodes = nodes.withColumn("times", F.when(F.abs("loop") <= LOOP, 1 / (1 - F.col("loop"))).otherwise(1.0)).withColumn("could", (F.coalesce("n", F.lit(0)) <= 1) & (F.abs("loop") <= LOOP))
        nodes = nodes.select("node", "times", "could", "before", (F.col("w_in") * F.col("times")).alias("w_in"), *((F.col(c) * F.col("times")).alias(c) for c in values))
        nodes = cut(nodes, f"{folder}/nodes={turn}")
        could = nodes.where("could")
        # Of two neighbours that could both go, the one with the smaller hash may.
        ends = could.select("node", "before").join(could.select(F.col("node").alias("before")), "before")
        waits = ends.select(F.when(F.struct(F.xxhash64("node"), "node") > F.struct(F.xxhash64("before"), "before"), F.col("node")).otherwise(F.col("before")).alias("node")).distinct()
        goes = cut(could.join(waits, "node", "left_anti").select("node", "before", "w_in", *values), f"{folder}/goes={turn}")
        n_goes, n = goes.count(), nodes.count()
        if n_goes <= LEAST * n:
            break
        went.append(goes)
        # Edges into nodes that go are gone with them; those out of them begin one node earlier, and bring their own amount.
        out = goes.select(F.col("node").alias("src"), "before", "w_in", F.lit(True).alias("gone"), *values)
        stay = nodes.join(goes.select("node"), "node", "left_anti")
        kept = live.where(~here | (F.abs("w") > LOOP)).join(stay.select(F.col("node").alias("dst"), "times"), "dst").withColumn("w", F.col("w") * F.col("times")).join(out, "src", "left")
        kept = kept.select(F.when(F.col("gone"), F.col("before")).otherwise(F.col("src")).alias("src"), "dst", (F.col("w") * F.coalesce("w_in", F.lit(1.0))).alias("w"), "gone", *((F.col(c) * F.col("w")).alias(c) for c in values))
        kept = cut(kept, f"{folder}/edges={turn}")
        live = kept.where("src is not null").groupBy("src", "dst").agg(F.sum("w").alias("w"))
        rows = stay.select("node", *values).unionByName(kept.where("gone").select(F.col("dst").alias("node"), *values)).groupBy("node").agg(*(F.sum(c).alias(c) for c in values))
    if not went:
        return _series(start, edges, [], values, keys, f"{folder}/series", tolerance, max_rounds)
    try:
        found = [_series(rows, cut(live, f"{folder}/core"), [], values, keys, f"{folder}/series", tolerance, max_rounds)]
    except Diverged:  # amounts of both signs: the whole series may die down where the smaller one does not
        return _series(start, edges, [], values, keys, f"{folder}/whole", tolerance, max_rounds)
    found = [cut(found[0], f"{folder}/found=0")]
    for i, goes in enumerate(reversed(went), 1):
        known = reduce(DataFrame.unionByName, found).select(F.col("node").alias("before"), *(F.col(c).alias(f"x_{c}") for c in values))
        found.append(cut(goes.join(known, "before", "left").select("node", *(_plus(F.col(c), F.col("w_in") * F.col(f"x_{c}")).alias(c) for c in values)), f"{folder}/found={i}"))
    return reduce(DataFrame.unionByName, found)


def _in_order(start: DataFrame, edges: DataFrame, values: list[str], keys: list, folder: str, tolerance: float, max_rounds: int) -> DataFrame:
    """The same for one row a node: a node waits until all its edges have brought theirs, and then passes its total on once.

    What lies on cycles or behind them waits for ever and is left to the series.
    """
    spark = start.sparkSession
    entering = edges.groupBy(F.col("dst").alias("node")).agg(F.count(F.lit(1)).alias("n_in"))
    ends = edges.select(F.col("src").alias("node")).distinct()
    own = [F.col(c).alias(f"own_{c}") for c in values]
    nodes = cut(start.select("node", *own).join(entering, "node", "full").join(ends, "node", "full").withColumn("n_in", F.coalesce("n_in", F.lit(0))), f"{folder}/nodes")
    # A node that waits has a way to itself, so that a round is one join.
    stays = nodes.where("n_in > 0").select(F.col("node").alias("src"), F.col("node").alias("dst"), F.lit(1.0).alias("w"), F.lit(True).alias("stay"))
    ways = cut(edges.select("src", "dst", F.col("w").cast("double").alias("w"), F.lit(False).alias("stay")).unionByName(stays), f"{folder}/ways")
    state = nodes.where("n_in = 0").select("node", F.lit(0).cast("long").alias("n"), *(F.col(f"own_{c}").alias(c) for c in values), F.lit(True).alias("ready"), F.lit(0).alias("round"))
    newest, paths = 0, [f"{folder}/ordered=0"]
    state = done = cut(state, paths[0])
    while not state.where("ready").isEmpty():
        if newest >= max_rounds:
            raise _diverged(state.where("ready"), [], values, keys, newest)
        rounds = []
        for newest in range(newest + 1, newest + STEP + 1):
            given = state.join(ways, (F.col("node") == F.col("src")) & (F.col("ready") != F.col("stay")))
            arrived = given.groupBy(F.col("dst").alias("node")).agg(F.sum(F.when(F.col("stay"), F.col("n")).otherwise(1)).alias("n"), *(F.sum(F.col(c) * F.col("w")).alias(c) for c in values))
            ready = F.col("n") == F.col("n_in")
            state = arrived.join(nodes, "node").select("node", "n", *(F.when(ready, _plus(F.col(c), F.col(f"own_{c}"))).otherwise(F.col(c)).alias(c) for c in values), ready.alias("ready"))
            rounds.append((state if len(rounds) == STEP - 1 else state.where("ready")).withColumn("round", F.lit(newest)))
        paths.append(f"{folder}/ordered={newest}")
        state = cut(reduce(DataFrame.unionByName, rounds), paths[-1]).where(F.col("round") == newest)
        done = spark.read.schema(done.schema).parquet(*paths)
    total = done.where("ready").select("node", *values)
    if total.count() == nodes.count():
        return total
    waiting = state.select("node", *values)
    rest = nodes.join(total.select("node"), "node", "left_anti").join(waiting, "node", "left").select("node", *(_plus(F.col(c), F.col(f"own_{c}")).alias(c) for c in values))
    rest = cut(rest, f"{folder}/cyclic")
    inner = cut(edges.join(rest.select(F.col("node").alias("src")), "src", "left_semi").select("src", "dst", "w"), f"{folder}/cyclic-edges")
    return total.unionByName(_contracted(rest, inner, values, keys, f"{folder}/contracted", tolerance, max_rounds))


def propagate(seed: DataFrame, edges: DataFrame, tolerance: float = TOLERANCE, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """seed (key, node, value) summed with all that the edges (src, dst, w) pass on: key, node, total."""
    folder = new_path(seed.sparkSession, "propagate")
    edges = cut(edges, f"{folder}/edges")
    seed = cut(seed.select("key", "node", F.col("value").cast("double").alias("v")), f"{folder}/seed")
    keys = distinct_keys(seed, "key", "v")
    if not keys or not edges.where("w is null").isEmpty():
        rows = seed.groupBy("key", "node").agg(F.sum("v").alias("v"))
        return _series(rows, edges, ["key"], ["v"], [], folder, tolerance, max_rounds).select("key", "node", F.col("v").alias("total"))
    values = [f"v{i}" for i in range(len(keys))]
    wide = cut(widened(seed, "key", keys, "node", "v"), f"{folder}/wide")
    # Few seeds reach few nodes: only where they lie all over the network is all of it gone through.
    if SPREAD * wide.count() >= edges.count():
        out = _in_order(wide, edges, values, keys, folder, tolerance, max_rounds)
    else:
        out = _series(wide, edges, [], values, keys, folder, tolerance, max_rounds)
    return lengthened(out, "key", keys, seed.schema["key"].dataType, "total").select("key", "node", "total")


def supply(demand: DataFrame, technosphere: DataFrame, production: DataFrame, ordered: bool = False) -> DataFrame:
    """demand_id, code, quantity (of product) and level (runs of the activity) for demand (demand_id, code, quantity).

    ordered: by components in topological order instead of the series, which solves networks whose series diverges.
    """
    seed = demand.select(F.col("demand_id").alias("key"), F.col("code").alias("node"), F.col("quantity").alias("value"))
    made = production.groupBy("code").agg(F.sum("amount").alias("made"))
    out = (ordered_totals if ordered else propagate)(seed, coefficients(technosphere, production)).select(F.col("key").alias("demand_id"), F.col("node").alias("code"), F.col("total").alias("quantity"))
    return out.join(made, "code", "left").select("demand_id", "code", "quantity", F.try_divide("quantity", "made").alias("level"))


def supplied(rows: DataFrame) -> DataFrame:
    """Activities that a demand reaches; negative levels count, exact zeros do not."""
    return rows.where("quantity <> 0")


def characterized(biosphere: DataFrame, cf: DataFrame) -> DataFrame:
    """code, method, direct: score of one run of each activity's own exchanges."""
    factors = cut(cf.select("method", "flow_id", "cf"), new_path(cf.sparkSession, "factors"))
    factors = F.broadcast(factors) if factors.count() <= FEW else factors
    return biosphere.join(factors, "flow_id").groupBy("code", "method").agg(F.sum(F.col("amount") * F.col("cf")).alias("direct"))


def contributions(levels: DataFrame, direct: DataFrame, threshold: float = 1e-30) -> DataFrame:
    """demand_id, method, code, score of every activity in a demand's chain.

    levels has one row for each demand and code, as `supply` gives it. Few methods meet it as one row of each code.
    """
    direct = cut(direct.select("code", "method", "direct"), new_path(direct.sparkSession, "direct"))
    methods = distinct_keys(direct, "method", "direct")
    if methods:
        per = lengthened(levels.select("demand_id", "code", "level").join(widened(direct, "method", methods, "code", "direct"), "code"), "method", methods, direct.schema["method"].dataType, "direct")
        rows = per.select("demand_id", "method", "code", (F.col("level") * F.col("direct")).alias("score"))
    else:
        rows = levels.join(direct, "code").groupBy("demand_id", "method", "code").agg(F.sum(F.col("level") * F.col("direct")).alias("score"))
    return rows.where(F.abs("score") >= threshold)


def scores(contributed: DataFrame) -> DataFrame:
    return contributed.groupBy("demand_id", "method").agg(F.sum("score").alias("score"))


def unit_scores(technosphere: DataFrame, production: DataFrame, direct: DataFrame, ordered: bool = False) -> DataFrame:
    """code, method, unit_score: the whole-chain score of one unit of every activity's product."""
    made = production.groupBy("code").agg(F.sum("amount").alias("made"))
    seed = direct.join(made, "code").select(F.col("method").alias("key"), F.col("code").alias("node"), (F.col("direct") / F.col("made")).alias("value"))
    back = coefficients(technosphere, production).select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w")
    return (ordered_totals if ordered else propagate)(seed, back).select(F.col("node").alias("code"), F.col("key").alias("method"), F.col("total").alias("unit_score"))


def study(demand: DataFrame, units: DataFrame) -> DataFrame:
    """Scores of many demands from unit scores: one join and one sum, of one row for each code and input where methods are few."""
    units = cut(units.select("code", "method", "unit_score"), new_path(units.sparkSession, "units"))
    methods = distinct_keys(units, "method", "unit_score")
    if not methods:
        return demand.join(units, "code").groupBy("demand_id", "method").agg(F.sum(F.col("quantity") * F.col("unit_score")).alias("score"))
    values = [f"v{i}" for i in range(len(methods))]
    used = demand.select("demand_id", "code", "quantity").join(widened(units, "method", methods, "code", "unit_score"), "code")
    # Inputs that meet in a code hardly share a demand, so they move before they are summed, not through a map of all demands.
    used = used.repartition("demand_id")
    # A demand has a score, null if need be, by each method that any of its inputs has: one bit a method.
    seen = F.bit_or(reduce(Column.__add__, (F.when(F.col(c).isNotNull(), 1 << i).otherwise(0) for i, c in enumerate(values))))
    sums = used.groupBy("demand_id").agg(*(F.sum(F.col("quantity") * F.col(c)).alias(c) for c in values), seen.alias("seen"))
    cells = sums.select("demand_id", *(F.when(F.col("seen").bitwiseAND(1 << i) != 0, F.struct(F.col(c).alias("score"))).alias(c) for i, c in enumerate(values)))
    return lengthened(cells, "method", methods, units.schema["method"].dataType, "cell_").select("demand_id", "method", "cell_.score")
