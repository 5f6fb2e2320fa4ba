"""Chat formatting: the cheapest legal sequence of roles, then rendering.

A legal sequence is an optional system turn and then user and assistant by turns, user first,
assistant last. A turn may be relabelled, merged with the turn before it, or have an empty turn
inserted before it; dynamic programming over the automaton's states (start, system, user, assistant)
finds the cheapest way. Each turn is a 4 x 4 matrix of costs and a run of turns is their (min, +)
product, so a conversation that spans many partitions is repaired in pieces: every piece reports its
product, the pieces of a conversation are chained, and each piece is then traced back between its
known first and last state. The result has a row for each turn, so no conversation is one value.

Defined cases: turns are ordered by turn (nulls first), role, text; equal rows follow each other; a
null or unknown role can become any role at the price of a relabel; null text renders as empty; a
null conv_id is a conversation of its own; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_limits, broadcast_if_small, materialize

ROLES = ("system", "user", "assistant")
RELABEL, MERGE, INSERT = 3, 1, 2
#: Steps between states (0 start, 1 system, 2 user, 3 assistant): cost, and the role of an empty turn between.
STEPS = {
    (0, 1): (0, ""), (0, 2): (0, ""), (0, 3): (INSERT, "user"),
    (1, 1): (MERGE, ""), (1, 2): (0, ""), (1, 3): (INSERT, "user"),
    (2, 2): (MERGE, ""), (2, 3): (0, ""),
    (3, 3): (MERGE, ""), (3, 2): (0, ""),
}
#: Ending after an assistant turn is free; elsewhere empty turns close the conversation.
CLOSE = (0, 2 * INSERT, INSERT, 0)
#: Empty turns that close a conversation ending in each state.
CLOSING = ((), ("user", "assistant"), ("assistant",), ())
FAR = 10**12
#: Text bytes that one group of a task holds.
SHARE = 16 << 20


def matrix(role: str | None) -> np.ndarray:
    """Costs of one turn from state to state."""
    m = np.full((4, 4), FAR, np.int64)
    for (a, b), (cost, _) in STEPS.items():
        m[a, b] = cost + (0 if ROLES[b - 1] == role else RELABEL)
    return m


_MATRIX = {r: matrix(r) for r in (*ROLES, None)}


def _known(role: object) -> str | None:
    return role if isinstance(role, str) and role in ROLES else None


def product(roles: list) -> np.ndarray:
    """The (min, +) product of a run of turns."""
    total = np.where(np.eye(4, dtype=bool), 0, FAR)
    for r in roles:
        total = np.minimum(FAR, (total[:, :, None] + _MATRIX[_known(r)][None]).min(axis=1))
    return total


def trace(roles: list, first: int, last: int) -> list[int]:
    """States after each turn of the cheapest way from first to last; of equals, the lowest state."""
    costs = [np.full(4, FAR, np.int64)]
    costs[0][first] = 0
    for r in roles:
        costs.append(np.minimum(FAR, (costs[-1][:, None] + _MATRIX[_known(r)]).min(axis=0)))
    states, at = [], last
    for i in range(len(roles), 0, -1):
        states.append(at)
        at = int((costs[i - 1] + _MATRIX[_known(roles[i - 1])][:, at]).argmin())
    return states[::-1]


def chain(products: list[np.ndarray]) -> list[tuple[int, int]]:
    """First and last state of every piece of one conversation, in order."""
    costs = [np.array([0, FAR, FAR, FAR], np.int64)]
    for p in products:
        costs.append(np.minimum(FAR, (costs[-1][:, None] + p).min(axis=0)))
    at = int((costs[-1] + np.array(CLOSE)).argmin())
    out = []
    for i in range(len(products), 0, -1):
        before = int((costs[i - 1] + products[i - 1][:, at]).argmin())
        out.append((before, at))
        at = before
    return out[::-1]


def _turn(role: str, text: str = "") -> str:
    return f"<|im_start|>{role}\n{text}"


END = "<|im_end|>\n"


def render(roles: list, texts: list, first: int, last: int, ends: bool) -> list[tuple]:
    """(role_out, action, inserted, cost, segment) of each turn; the segments of a conversation join to its text.

    ends: whether the conversation ends here.
    """
    states = trace(roles, first, last)
    out = []
    for i, (role, text, state) in enumerate(zip(roles, texts, states, strict=True)):
        before = first if i == 0 else states[i - 1]
        cost, inserted = STEPS[before, state]
        name, merged = ROLES[state - 1], before == state
        relabelled = _known(role) != name
        action = "+".join(x for x, on in (("merge", merged), ("relabel", relabelled), ("insert", bool(inserted))) if on) or "keep"
        segment = ("\n" + text) if merged else ((END if before else "") + (_turn(inserted) + END if inserted else "") + _turn(name, text))
        closing = ",".join(CLOSING[state]) if ends and i == len(roles) - 1 else ""
        if ends and i == len(roles) - 1:
            segment += END + "".join(_turn(r) + END for r in CLOSING[state])
            cost += CLOSE[state]
        out.append((name, action, ",".join(x for x in (inserted, closing) if x), cost + RELABEL * relabelled, segment))
    return out


TURNS = "conv_id long, turn long, role string, role_out string, action string, inserted string, cost long, segment string"


def _runs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole runs of a conversation within a sorted partition."""
    kept = None
    for pdf in frames:
        if not len(pdf):
            continue
        kept = pdf if kept is None else pd.concat([kept, pdf], ignore_index=True)
        conv = kept["conv"]
        cuts = np.flatnonzero((conv != conv.shift()).to_numpy())
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield kept.iloc[a:b]
        kept = kept.iloc[cuts[-1] :]
    if kept is not None:
        yield kept


def repair(conversations: DataFrame) -> DataFrame:
    """One row for each turn, repaired and rendered."""
    spark = conversations.sparkSession
    arrow_limits(spark)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    order = ["conv", "turn", "role", "text"]
    # A number that is given is kept, so a group's size does not grow with the table.
    held = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-held // SHARE))
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = materialize(ranged.withColumn("part", F.spark_partition_id()), "turns")

    def report(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The first and the last run of the partition; only these can go on elsewhere."""
        first = last = None
        for run in _runs(frames):
            item = (run["conv"].iat[0], int(run["part"].iat[0]), product(run["role"].tolist()).ravel().tolist())
            first, last = first or item, item
        found = [] if first is None else [first] if first is last else [first, last]
        yield pd.DataFrame(found, columns=["conv", "part", "product"])

    # A partition that was written is read in order and whole: sorting by the same keys restores it at need.
    kept = placed.repartition("part").sortWithinPartitions("part", *order)
    spans = kept.groupBy("part").applyInPandas(lambda pdf: next(report(iter([pdf]))), "conv string, part int, product array<long>")
    several = spans.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("conv")
    pieces = spans.join(several, "conv", "left_semi")

    def join_pieces(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        ends = chain([np.array(p, np.int64).reshape(4, 4) for p in pdf["product"]])
        return pd.DataFrame({"conv": pdf["conv"], "part": pdf["part"], "first": [a for a, _ in ends], "last": [b for _, b in ends], "ends": [False] * (len(pdf) - 1) + [True]})

    # Two rows for each partition at most; beyond the limit they are joined by a shuffle.
    joints = materialize(pieces.groupBy("conv").applyInPandas(join_pieces, "conv string, part int, first int, last int, ends boolean"), "joints")
    joints = broadcast_if_small(joints, joints.count())

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for run in _runs(iter([pdf.sort_values(order, na_position="first", kind="stable")])):
            roles = run["role"].tolist()
            if pd.isna(run["first"].iat[0]):
                (first, last), ends = chain([product(roles)])[0], True
            else:
                first, last, ends = int(run["first"].iat[0]), int(run["last"].iat[0]), bool(run["ends"].iat[0])
            for row, done in zip(run.itertuples(index=False), render(roles, run["text"].tolist(), first, last, ends), strict=True):
                out.append((row.conv_id, row.turn, row.role, *done))
        got = pd.DataFrame(out, columns=["conv_id", "turn", "role", "role_out", "action", "inserted", "cost", "segment"])
        return got.astype({"conv_id": "Int64", "turn": "Int64"})

    return placed.join(joints, ["conv", "part"], "left").groupBy("part").applyInPandas(finish, TURNS)
