"""Prefix trie of rebuilt conversations, from composable fingerprints instead of rebuilt texts.

A conversation c begins with a head, the first turns of its base c - c % 100, and goes on with its own turns
after as many of them. A sequence of turns t1, t2, ... has the fingerprint sum t_i B^i and the length n; the
pair is a monoid: (s, n) + (s', n') = (s + s' B^n, n + n'). So the fingerprint of every prefix of a rebuilt
conversation follows from prefix sums over the turns as stored: of the base up to m, and of c from its first own
turn on, moved by B^(m - h). No rebuilt text exists anywhere; a turn is a 128-bit name and a reference to
where it is stored. Two moduli-sized sums (2^61 - 1, two bases) make a fingerprint.

Prefixes with equal fingerprint and depth are a node. Equality is then verified: members of a node must have one
parent node and one name of their last turn, and where they refer to different stored turns under one name,
role and text of these are compared. What fails is never merged: other bases are taken, and names that stand
for two texts stop the run.

Positions and prefix sums are a scan over a range-partitioned sort, so a conversation that holds a third of
all turns is spread over tasks; each task sums its part, and the few parts of a conversation are added up.
Sums over subtrees use doubling: after k rounds a node has the sum over its descendants nearer than 2^k, and
hands it to its ancestor at that distance, looked up as (conversation, depth), a key that no two nodes share.
Hashes of members' ids are streamed: sorted runs become byte chunks, which one hash state then reads.

Defined cases: null role or text is empty; turns are ordered by turn (null first), then role, then the text's
name, so repeated rows are repeated turns; rows with a null conv_id belong to no conversation and are left out;
a base that is absent gives no head; conversations without turns end at the root; an empty table gives an empty
result; other columns are ignored; texts of any length are hashed whole and never moved.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_limits, broadcast_if_small, join_groups, materialize

#: Every base has the number c - c % FAMILY; heads have at most HEAD turns.
FAMILY, HEAD = 100, 5
PRIME = (1 << 61) - 1
#: Pairs of bases; the next pair is taken where a node's members turn out to differ.
BASES = ((1_142_870_531_287_911, 998_244_353_000_133), (774_363_421_890_221, 1_733_115_900_217), (51_539_607_553, 2_305_843_009_213_693))
#: Ids that one task keeps as bytes before it passes a chunk on.
CHUNK = 1 << 16


class Unequal(RuntimeError):
    """Different turns under one name."""


def _turn(role: Column, text: Column) -> Column:
    """128 bits that name a turn: of the role's length, the role and the text."""
    return F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 32)


def stored_turns(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, name (of role and text), n_chars of every row that has a conversation."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    return rows.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), _turn(role, text).alias("name"), F.char_length(text).cast("long").alias("n_chars"))


def head_length(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string").cast("binary")) % (HEAD + 1)).cast("int")


def _scan(bases: tuple[int, int]):
    """Sorted rows get their place in the task and the task's sums, for each conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, conv, place, sums, powers = TaskContext.get().partitionId(), None, 0, [0, 0], [1, 1]
        for b in batches:
            convs, names = b.column("conv_id").to_pylist(), b.column("name").to_pylist()
            places, ends = [], [[], []]
            for c, name in zip(convs, names, strict=True):
                if c != conv:
                    conv, place, sums, powers = c, 0, [0, 0], [1, 1]
                place += 1
                t = int(name, 16) % PRIME + 1
                for i, base in enumerate(bases):
                    powers[i] = powers[i] * base % PRIME
                    sums[i] = (sums[i] + t * powers[i]) % PRIME
                    ends[i].append(sums[i])
                places.append(place)
            columns = [b.column("conv_id"), pa.array([task] * len(convs), pa.int32()), pa.array(places, pa.int64()), *(pa.array(e, pa.int64()) for e in ends), b.column("name"), b.column("n_chars")]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "task", "place", "s0", "s1", "name", "n_chars"])

    return run


def _power(column: str, base: int):
    """base^column mod PRIME for each row, by a user function on whole batches."""

    @F.pandas_udf("long")
    def power(n: pd.Series) -> pd.Series:
        return n.map(lambda x: pow(base, int(x), PRIME))

    return power(F.col(column).cast("long"))


def _mul(a: Column, b: Column) -> Column:
    """Product modulo PRIME; both are below 2^61, so it fits 38 digits."""
    return ((a.cast("decimal(19,0)") * b.cast("decimal(19,0)")).cast("decimal(38,0)") % F.lit(PRIME).cast("decimal(19,0)")).cast("long")


def _plus(a: Column, b: Column) -> Column:
    return (a + b) % F.lit(PRIME)


def positions(turns: DataFrame, bases: tuple[int, int], tasks: int) -> DataFrame:
    """conv_id, pos (from 1), s0, s1 (sums over the turns up to pos), name, n_chars."""
    # Rows that repeat whole are numbered, so that ranges can part them too.
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "name", "copy"]
    counted = turns.groupBy("conv_id", "turn", "role", "name", "n_chars").agg(F.count(F.lit(1)).alias("copies"))
    each = counted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copies")
    local = each.repartitionByRange(tasks, *order).sortWithinPartitions(*order).select("conv_id", "name", "n_chars")
    local = materialize(local.mapInArrow(_scan(bases), "conv_id long, task int, place long, s0 long, s1 long, name string, n_chars long"), "scan")
    parts = local.groupBy("conv_id", "task").agg(F.max("place").alias("n"), F.max_by("s0", "place").alias("e0"), F.max_by("s1", "place").alias("e1"))
    w = Window.partitionBy("conv_id").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0)))
    # The sums of a conversation's earlier parts, each moved by what lies before it; there are as many parts as tasks at most.
    split = materialize(parts.withColumn("q0", _power("before", bases[0])).withColumn("q1", _power("before", bases[1])), "parts")
    total = lambda e, q: F.coalesce((F.sum(_mul(F.col(e), F.col(q)).cast("decimal(38,0)")).over(w) % PRIME).cast("long"), F.lit(0))
    split = split.withColumn("o0", total("e0", "q0")).withColumn("o1", total("e1", "q1")).where("before > 0").select("conv_id", "task", "before", "q0", "q1", "o0", "o1")
    split = materialize(split, "offsets")
    rows = local.join(broadcast_if_small(split, split.count()), ["conv_id", "task"], "left")
    of = lambda i: F.when(F.col("before").isNull(), F.col(f"s{i}")).otherwise(_plus(F.col(f"o{i}"), _mul(F.col(f"s{i}"), F.col(f"q{i}"))))
    return rows.select("conv_id", (F.col("place") + F.coalesce("before", F.lit(0))).alias("pos"), of(0).alias("s0"), of(1).alias("s1"), "name", "n_chars")


def rebuilt(turns: DataFrame, bases: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    """(turns of rebuilt conversations, conversations).

    Turns: conv_id, depth, f0, f1 (fingerprint of the prefix), name, n_chars, ref_conv, ref_pos. Conversations:
    conv_id, length (of the rebuilt one), n_own.
    """
    heads = turns.where(F.col("pos") <= HEAD).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "s0", "s1", "name", "n_chars"))).alias("head"))
    own = turns.groupBy("conv_id").agg(F.max("pos").alias("n_own")).withColumn("h", head_length(F.col("conv_id"))).withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY)
    convs = own.join(heads, "conv_id").withColumnRenamed("head", "first")
    convs = convs.join(heads.select(F.col("conv_id").alias("base"), "head"), "base", "left")
    convs = convs.withColumn("head", F.coalesce(F.slice("head", 1, F.greatest("h", F.lit(1))), F.array().cast("array<struct<pos:bigint,s0:bigint,s1:bigint,name:string,n_chars:bigint>>")))
    convs = convs.withColumn("head", F.when(F.col("h") > 0, F.col("head")).otherwise(F.slice("head", 1, 0))).withColumn("m", F.size("head"))
    last = lambda part, n, f: F.when(n > 0, F.get(part, n - 1)[f]).otherwise(F.lit(0))
    cut = F.least(F.col("h").cast("long"), F.col("n_own")).cast("int")
    for i, base in enumerate(bases):
        # B^(m - h): the own turns begin at h + 1 and go to depth m + 1. m - h is 0 or down to -HEAD.
        shifts = F.array(*(F.lit(pow(base, PRIME - 1 - d, PRIME)) for d in range(HEAD + 1)))
        convs = convs.withColumn(f"b{i}", last(F.col("head"), F.col("m"), f"s{i}")).withColumn(f"c{i}", last(F.col("first"), cut, f"s{i}")).withColumn(f"x{i}", F.get(shifts, F.col("h") - F.col("m")))
    convs = convs.withColumn("length", F.col("m") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0)))
    convs = materialize(convs.select("conv_id", "base", "n_own", "h", "m", "head", "length", "b0", "b1", "c0", "c1", "x0", "x1"), "conversations")
    in_head = convs.select("conv_id", "base", F.explode("head").alias("t")).select("conv_id", F.col("t.pos").alias("depth"), F.col("t.s0").alias("f0"), F.col("t.s1").alias("f1"), F.col("t.name").alias("name"), F.col("t.n_chars").alias("n_chars"), F.col("base").alias("ref_conv"), F.col("t.pos").alias("ref_pos"))
    moved = join_groups(turns, convs.select("conv_id", "h", "m", "b0", "b1", "c0", "c1", "x0", "x1", "n_own"), "conv_id", "n_own", turns.count()).where(F.col("pos") > F.col("h"))
    f = lambda i: _plus(F.col(f"b{i}"), _mul(_plus(F.col(f"s{i}"), F.lit(PRIME) - F.col(f"c{i}")), F.col(f"x{i}")))
    behind = moved.select("conv_id", (F.col("pos") - F.col("h") + F.col("m")).alias("depth"), f(0).alias("f0"), f(1).alias("f1"), "name", "n_chars", F.col("conv_id").alias("ref_conv"), F.col("pos").alias("ref_pos"))
    return in_head.unionByName(behind), convs.select("conv_id", F.col("length").cast("long").alias("length"))


def _hash_runs():
    """Sorted (node, depth, conv_id): whole nodes become a hash, a task's first and last node chunks of bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        key, first, text, parts, n = None, None, [], 0, 0

        def flush(closed: bool) -> None:
            nonlocal text, parts, first
            if not text:
                return
            data = ",".join(text).encode()
            if closed and parts == 0 and n > 1:
                done.append((*key, None, None, hashlib.sha256(data).hexdigest()))
            else:
                done.append((*key, first, data, None))
                parts += 1
            text, first = [], None

        def table() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) if done else [[]] * 5
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["node", "depth", "first", "ids", "ends_sha256"])

        size = 0
        for b in batches:
            for node, depth, conv in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if (node, depth) != key:
                    if key is not None:
                        flush(True)
                    key, parts, n, size = (node, depth), 0, n + 1, 0
                if first is None:
                    first = conv
                text.append(str(conv))
                size += len(text[-1]) + 1
                if size >= CHUNK:
                    flush(False)
                    size = 0
            yield table()
        if key is not None:
            n = 0  # the last node may go on in the next task
            flush(True)
        yield table()

    return run


def _hash_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks sorted by node and first id: one hash state reads a node's chunks one after the other."""
    key, state = None, None

    def row(k, s) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k[0]], pa.int64()), pa.array([k[1]], pa.int64()), pa.array([s.hexdigest()])], ["node", "depth", "ends_sha256"])

    for b in batches:
        for node, depth, ids in zip(b.column("node").to_pylist(), b.column("depth").to_pylist(), b.column("ids"), strict=True):
            if (node, depth) != key:
                if key is not None:
                    yield row(key, state)
                key, state = (node, depth), hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.as_buffer())
    if key is not None:
        yield row(key, state)


def ends_hash(ends: DataFrame, tasks: int) -> DataFrame:
    """node, depth, ends_sha256: of the ids (conv_id) of each node, ascending and joined by commas."""
    order = ["node", "depth", "conv_id"]
    runs = ends.select(*order).repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    runs = materialize(runs.mapInArrow(_hash_runs(), "node long, depth long, first long, ids binary, ends_sha256 string"), "end-runs")
    chunks = runs.where("ids is not null").select("node", "depth", "first", "ids").repartition("node", "depth").sortWithinPartitions("node", "depth", "first")
    return runs.where("ids is null").select("node", "depth", "ends_sha256").unionByName(chunks.mapInArrow(_hash_chunks, "node long, depth long, ends_sha256 string"))


def subtree_sums(nodes: DataFrame, paths: DataFrame, columns: list[str]) -> DataFrame:
    """nodes (node, depth, weights) with every weight summed over the node's subtree.

    paths: conv_id, depth, node for the prefixes of at least every conversation that names a node.
    """
    now = materialize(nodes.select("node", "depth", *columns), "subtree")
    deepest = now.agg(F.max("depth")).first()[0] or 0
    step = 1
    while step <= deepest:
        up = now.where(F.col("depth") >= step).withColumn("at", F.col("depth") - step)
        at = paths.select(F.col("conv_id").alias("node"), F.col("depth").alias("at"), F.col("node").alias("above"))
        given = up.join(at, ["node", "at"]).groupBy(F.col("above").alias("node"), F.col("at").alias("depth")).agg(*(F.sum(c).alias(f"{c}_given") for c in columns))
        now = materialize(now.join(given, ["node", "depth"], "left").select("node", "depth", *((F.col(c) + F.coalesce(f"{c}_given", F.lit(0))).alias(c) for c in columns)), "subtree")
        step *= 2
    return now


def _check_names(rows: DataFrame, shared: DataFrame) -> None:
    """Stored turns of one name, where a node's members refer to several of them, have one role and text."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    names = materialize(shared.select(F.col("name").alias("shared_name")).distinct(), "shared-names")
    seen = rows.where("conv_id is not null").select(_turn(role, text).alias("name"), F.struct(role.alias("role"), text.alias("text")).alias("turn"))
    seen = seen.join(broadcast_if_small(names, names.count(), 100_000), F.col("name") == F.col("shared_name"), "left_semi")
    if not seen.groupBy("name").agg(F.min("turn").alias("a"), F.max("turn").alias("b")).where("a <> b").isEmpty():
        raise Unequal("two different turns share a 128-bit name")


def prefix_trie(rows: DataFrame) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = rows.sparkSession
    arrow_limits(spark)
    rows = rows.select("conv_id", "turn", "role", "text")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.rdd.getNumPartitions())
    turns = stored_turns(rows)
    for bases in BASES:
        placed = materialize(positions(turns, bases, tasks), "turns")
        prefixes, convs = rebuilt(placed, bases)
        prefixes = materialize(prefixes, "prefixes")
        # A node is a depth and a fingerprint; its name is its smallest member.
        groups = prefixes.groupBy("depth", "f0", "f1").agg(
            F.min("conv_id").alias("node"), F.count(F.lit(1)).alias("n_convs"), F.min("name").alias("name"), F.max("name").alias("other_name"), F.max("n_chars").alias("n_chars"),
            F.min(F.struct("ref_conv", "ref_pos")).alias("ref"), F.max(F.struct("ref_conv", "ref_pos")).alias("other_ref"),
        )
        groups = materialize(groups, "groups")
        total = prefixes.count()
        paths = join_groups(prefixes.select("conv_id", "depth", "f0", "f1"), groups.select("depth", "f0", "f1", "node", "n_convs"), ["depth", "f0", "f1"], "n_convs", total).select("conv_id", "depth", "node")
        ranked = convs.agg(F.min("conv_id").alias("root"), F.count(F.lit(1)).alias("n_convs"), F.max("length").alias("deepest")).first()
        if ranked["root"] is None:
            return spark.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
        paths = materialize(paths.unionByName(convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(ranked["root"]).cast("long").alias("node"))), "paths")
        above = paths.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"))
        # All members' parents: a node with two was merged by chance, as one with two last turns was.
        parents = prefixes.select("conv_id", "depth", "f0", "f1").join(above, ["conv_id", "depth"]).groupBy("depth", "f0", "f1").agg(F.min("parent").alias("parent"), F.max("parent").alias("other_parent"))
        known = materialize(groups.join(parents, ["depth", "f0", "f1"]), "nodes")
        if known.where("name <> other_name or parent <> other_parent").isEmpty():
            break
    else:
        raise Unequal("no pair of bases tells all prefixes apart")
    _check_names(rows, known.where("ref <> other_ref"))
    root = spark.createDataFrame([(ranked["root"], 0, None, ranked["n_convs"], 0)], "node long, depth long, parent long, n_convs long, n_chars long")
    nodes = known.select("node", "depth", "parent", "n_convs", "n_chars").unionByName(root)
    children = known.groupBy(F.col("parent").alias("node"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, ["node", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = materialize(nodes.withColumn("n_leaves", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")).withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("n_chars")), "trie")
    sums = subtree_sums(nodes, paths, ["n_leaves", "saved_tokens"])
    last = join_groups(paths.select("conv_id", "depth", "node"), convs.select("conv_id", "length"), "conv_id", "length", paths.count()).where(F.col("depth") == F.col("length"))
    hashed = ends_hash(last, tasks)
    out = nodes.drop("n_leaves", "saved_tokens").join(sums, ["node", "depth"]).join(hashed, ["node", "depth"], "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select(F.col("node").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))
