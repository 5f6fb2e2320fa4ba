"""Exact Jaccard join of word n-gram sets as a metric-space join.

Jaccard distance is a metric. A region's pivots each meet all of its sets, are linked with those
within the threshold eps, and leave. The sets left go to the cell of their nearest pivot, which is their
home. If x is at home in the cell of p and y in the cell of q, and they link, then
d(y, p) <= d(y, q) + 2 eps; so boundary sets are also guests of the cells inside that window. Cells
are regions again, joined recursively, until no home is left. Of two cells the earlier takes the other's
guests, and guests of a cell do not meet, so every pair is met once at most and no pair has to be stored
to count it once.

Unrelated texts all lie at distance 1 from any pivot, so pivots alone cannot part a whole corpus. The
outermost regions therefore come from an exact pigeonhole argument: two sets that differ in at most D
elements agree entirely on one of D + 1 classes of elements. Sets that agree on a class, and on as many
more as a link needs, are a family with the sets connected through them; links never leave it. Each family is joined with pivots: by one task
where it fits, else its cells are formed by Spark jobs until they fit.

A caller that needs components alone does not ask for every link: then sets whose components are
known to be one do not meet any more.

Defined cases: null text counts as empty; a text without words has no shingles and is its own
component; shorter texts are one shingle; equal sets are linked; repeated rows give equal rows; a
null doc_id takes its component's smallest id; an empty table gives an empty result; other columns
are ignored. Shingles are compared as 64-bit hashes; a set is named by 128 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .common import arrow_limits, at_bit, bit_filter, broadcast_if_small, id_and_text, join_groups, materialize
from .graph import components

U64 = np.uint64
#: Members and shingles of the largest region that one task joins; pivots of a region; rounds of splitting by Spark jobs.
MEMBERS, SHINGLES, PIVOTS, ROUNDS = 2_000, 2_000_000, 16, 8
#: Cells of the largest 0/1 matrix of sets and shared shingles that a task lays out; beyond it shingles are marked one set at a time.
MATRIX = 16_000_000
#: Hashes of words that a worker keeps.
WORDS = 500_000
#: Signatures are below this; how many of them one task sorts, and how many it reports at once.
SIGN, SLICE, REPORT = 1 << 48, 4_000_000, 1_000_000
#: A set at home meets all of its region; a guest meets those at home; one of a tile meets its guests alone.
GUEST, HOME, TILE = 0, 1, 2
#: Added to distances that are compared, for their rounding.
TOUCH = 1e-9


# --- sets ----------------------------------------------------------------------------------------


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(h: np.ndarray) -> np.ndarray:
    """Murmur finaliser; its two multipliers are fixed values."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> U64(33))
        h = h * U64(0xFF51AFD7ED558CCD)
        h = h ^ (h >> U64(33))
        h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def shingles(text: str, n: int, hashes: dict | None = None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of n-word shingles; A-Z in lower case, words between ASCII blanks."""
    words = text.encode("utf-8").lower().split()
    if not words:
        return np.zeros(0, U64)
    hashes = _WordHashes() if hashes is None else hashes
    h = np.fromiter(map(hashes.__getitem__, words), U64, len(words))
    size = min(n, len(words))
    state = np.full(len(words) - size + 1, size, U64)
    for j in range(size):
        with np.errstate(over="ignore"):
            state = _mix(state * U64(0x9E3779B97F4A7C15) + h[j : len(h) - size + 1 + j])
    return np.unique(state)


# --- pigeonhole classes ------------------------------------------------------------------------------


class Classes:
    """Signatures of which sets with Jaccard >= num/den share one at least.

    Sizes fall into levels such that a set is at most one level above any smaller set it links with.
    For links whose smaller set is in level k, both sets cut their elements into the same m classes.
    They differ in at most D elements, so m - D classes agree. m leaves room for E thin classes (fewer
    than `thin` elements), and a set with at most E of them need not sign those.
    """

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.starts, self.shape = [0, 1], [(1, 0, 1)]
        self._grow(1)

    def _grow(self, size: int) -> None:
        while self.starts[-1] <= size:
            s = self.starts[len(self.shape)]
            top = s * self.den // self.num
            self.starts.append(top + 1)
            apart = (self.den - self.num) * top // self.num
            self.shape.append(self._classes(s, apart))

    @staticmethod
    def _classes(size: int, apart: int) -> tuple[int, int, int]:
        """(classes, thin classes allowed, elements below which a class is thin)."""
        for thin in (3, 2, 1):
            room = 0
            for _ in range(12):
                m = apart + 1 + room
                mean = size / m
                share = sum(math.exp(-mean) * mean**i / math.factorial(i) for i in range(thin))
                need = math.ceil(m * share + 4 * math.sqrt(m * share))
                if need <= room:
                    return m, room, thin
                room = need
                if room > (apart + 1) // 4 + 3 and thin > 1:
                    break
            else:
                return apart + 1 + room, room, thin
        raise AssertionError("unreachable")

    def level(self, size: int) -> int:
        self._grow(size)
        return int(np.searchsorted(self.starts, size, "right")) - 1

    def needed(self, k: int) -> int:
        """Classes that agree at least, of two linked sets the smaller of which is in level k."""
        while len(self.shape) <= k:
            self._grow(self.starts[-1])
        return self.shape[k][1] + 1

    def signatures(self, s: np.ndarray) -> np.ndarray:
        return self.signed(s)[0]

    def signed(self, s: np.ndarray) -> tuple[np.ndarray, int, bytes, bytes]:
        """(signatures, level, a byte of each class for links with the level below, and for those within the level)."""
        if not len(s):
            return np.zeros(0, U64), 0, b"", b""
        level = self.level(len(s))
        below, own = (self._signed(s, k) if k >= 0 else (np.zeros(0, U64), b"") for k in (level - 1, level))
        return np.concatenate([below[0], own[0]]), level, below[1], own[1]

    def _signed(self, s: np.ndarray, k: int) -> tuple[np.ndarray, bytes]:
        m, room, thin = self.shape[k]
        h = _mix(s + U64(k))
        place = ((h >> U64(32)) * U64(m)) >> U64(32)
        count = np.bincount(place.astype(np.int64), minlength=m)
        sums = np.zeros(m, U64)
        np.add.at(sums, place.astype(np.int64), _mix(h + U64(0x51ED27)))
        keep = count >= thin if (count < thin).sum() <= room else np.ones(m, bool)
        tag = np.arange(m).astype(U64) + U64(k << 32)
        signs = _mix(sums + _mix(tag + U64(7)))
        return signs[keep] & U64(SIGN - 1), (signs >> U64(56)).astype(np.uint8).tobytes()


@lru_cache(maxsize=4)
def classes(num: int, den: int) -> Classes:
    return Classes(num, den)


def signed_rows(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """doc_id, n_shingles, hi and lo (128 bits that name the set; null for an empty one), its signatures, level and class bytes."""
    arrow_limits(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, signer = _WordHashes(), classes(num, den)
        for b in batches:
            sets = [shingles(t, n, hashes) for t in b.column(1).to_pylist()]
            signed = [signer.signed(s) for s in sets]
            cols = [b.column(0), pa.array([len(s) for s in sets], pa.int64()), *_names(sets), pa.array([x[0].view(np.int64) for x in signed], pa.list_(pa.int64()))]
            cols += [pa.array([x[1] for x in signed], pa.int32()), pa.array([x[2] for x in signed], pa.binary()), pa.array([x[3] for x in signed], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_shingles", "hi", "lo", "signs", "level", "below", "own"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, n_shingles long, hi long, lo long, signs array<long>, level int, below binary, own binary")


def _names(sets: list[np.ndarray]) -> list[pa.Array]:
    """hi and lo of each set."""
    raw = [np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64) if len(s) else (None, None) for s in sets]
    return [pa.array([r[i] for r in raw], pa.int64()) for i in (0, 1)]


def _small(df: DataFrame, rows: int) -> DataFrame:
    return broadcast_if_small(df, rows, common.FEW)


def sets_of(docs: DataFrame, n: int, bits: np.ndarray | None = None) -> DataFrame:
    """hi, lo, n and items (sorted 64-bit hashes as bytes) of each text that has shingles; with bits, if its doc_id may be among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for b in batches:
            texts = b.column(0)
            if bits is not None:
                at = b.column(1).to_numpy()
                texts = texts.filter(pa.array((bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1))
            sets = [s for t in texts.to_pylist() if len(s := shingles(t, n, hashes))]
            yield pa.RecordBatch.from_arrays([*_names(sets), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["hi", "lo", "n", "items"])

    read = ["text"] if bits is None else ["text", at_bit(F.col("doc_id"), 8 * len(bits)).alias("bit")]
    return docs.select(*read).mapInArrow(run, "hi long, lo long, n long, items binary")


def sets_of_ids(docs: DataFrame, ids: DataFrame, n_ids: int, n: int) -> DataFrame:
    """sets_of the rows whose doc_id is the one column of ids, and perhaps of others; each set once.

    Many ids reach the tasks as a bit filter, so neither does the driver hold them nor are texts shuffled.
    """
    if n_ids <= common.FEW:
        found = sets_of(docs.join(F.broadcast(ids), F.col("doc_id").eqNullSafe(F.col(ids.columns[0])), "left_semi"), n)
    else:
        found = sets_of(docs, n, bit_filter(ids, n_ids))
    return found.dropDuplicates(["hi", "lo"])


# --- one region in one task ----------------------------------------------------------------------------


class Region:
    """Joins the sets of one region. `counts` holds, per set, the weight of the sets it links with (all of them if
    `every`); `root` the smallest index of its component; `found` the links met at each depth of the recursion."""

    def __init__(self, keys: list[int], items: list[bytes], roles: list[int], weights: list[int], num: int, den: int, every: bool = False):
        self.keys, self.num, self.den, self.eps, self.every = np.array(keys, np.int64), num, den, 1 - num / den, every
        sets = [np.frombuffer(x, U64) for x in items]
        self.size, self.weight = np.array([len(s) for s in sets], np.int64), np.array(weights, np.int64)
        self._lay_out(sets)
        self.root, self.counts = np.arange(len(keys)), np.zeros(len(keys), np.int64)
        self.found: dict[int, int] = {}
        roles = np.array(roles)
        guests = np.flatnonzero(roles == GUEST)
        open_ = [(np.flatnonzero(roles == HOME), guests, True, 0), (np.flatnonzero(roles == TILE), guests, False, 0)]
        while open_:
            for homes, visitors, inner, depth in self.unsettled(*open_.pop()):
                open_ += self.meet(homes, visitors, inner, depth)

    def _lay_out(self, sets: list[np.ndarray]) -> None:
        """Shingles of two sets at least, as rows of a 0/1 matrix or as numbered lists."""
        _, ids, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = times[ids] > 1
        number = np.cumsum(times > 1) - 1
        owner = np.repeat(np.arange(len(sets)), self.size)[shared]
        ids = number[ids[shared]]
        self.width = int((times > 1).sum())
        self.matrix = None
        if len(sets) * self.width <= MATRIX:
            self.matrix = np.zeros((len(sets), self.width), np.float32)
            self.matrix[owner, ids] = 1
        else:
            self.parts = np.split(ids, np.cumsum(np.bincount(owner, minlength=len(sets)))[:-1])

    def shared(self, pivots: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Shingles that each pivot shares with each of the others."""
        if self.matrix is not None:
            return np.rint(self.matrix[pivots] @ self.matrix[others].T).astype(np.int64)
        ids = np.concatenate([self.parts[i] for i in others])
        ends = np.cumsum([len(self.parts[i]) for i in others])
        mark, out = np.zeros(self.width, np.int64), np.empty((len(pivots), len(others)), np.int64)
        for row, p in enumerate(pivots):
            mark[self.parts[p]] = 1
            out[row] = np.diff(np.concatenate([[0], np.cumsum(mark[ids])])[np.concatenate([[0], ends])])
            mark[self.parts[p]] = 0
        return out

    def unsettled(self, homes: np.ndarray, guests: np.ndarray, inner: bool, depth: int) -> list[tuple]:
        """The parts of a region whose sets still have to meet: all, or those of different components."""
        if not len(homes) or len(homes) * inner + len(guests) < 1 + inner:
            return []
        if self.every:
            return [(homes, guests, inner, depth)]
        values, times = np.unique(self.root[homes], return_counts=True)
        most = values[times.argmax()]
        main, apart = homes[self.root[homes] == most], homes[self.root[homes] != most]
        strangers = guests[self.root[guests] != most]
        if not len(apart):
            return [(main, strangers, False, depth)] if len(strangers) else []
        meeting = (apart, np.concatenate([main, guests]) if inner else guests, inner, depth)
        return [meeting, (main, strangers, False, depth)] if len(strangers) else [meeting]

    def meet(self, homes: np.ndarray, guests: np.ndarray, inner: bool, depth: int) -> list[tuple]:
        """Pivots of a region meet its sets and leave; the cells of the others."""
        pivots = homes[np.unique(np.linspace(0, len(homes) - 1, min(PIVOTS, len(homes))).astype(int))]
        left = np.setdiff1d(homes, pivots, assume_unique=True)
        others = np.concatenate([left, guests])
        d = self.link(pivots, np.concatenate([left, guests]) if inner else guests, depth)
        if inner and len(pivots) > 1:
            self.link(pivots, pivots, depth)
        if not len(left):
            return []
        if not inner:
            d = np.concatenate([self.distances(pivots, left), d], axis=1)
        home = d[:, : len(left)].argmin(axis=0)
        window = d <= d.min(axis=0) + 2 * self.eps + TOUCH
        cells = []
        for j in np.unique(home):
            visits = window[j].copy()
            visits[: len(left)] &= (home > j) & inner
            cells.append((left[home == j], others[visits], inner, depth + 1))
        return cells

    def distances(self, pivots: np.ndarray, others: np.ndarray) -> np.ndarray:
        inter = self.shared(pivots, others)
        return 1 - inter / (self.size[pivots][:, None] + self.size[others] - inter)

    def link(self, pivots: np.ndarray, others: np.ndarray, depth: int) -> np.ndarray:
        """Distances of pivots and others; those within the threshold are linked. Given twice, pivots meet each other once."""
        if not len(others):
            return np.zeros((len(pivots), 0))
        inter = self.shared(pivots, others)
        union = self.size[pivots][:, None] + self.size[others] - inter
        linked = self.den * inter >= self.num * union
        if others is pivots:
            linked = np.triu(linked, 1)
        self.found[depth] = self.found.get(depth, 0) + int(linked.sum())
        self.counts[pivots] += linked @ self.weight[others]
        self.counts[others] += self.weight[pivots] @ linked
        for p, near in zip(pivots, linked, strict=True):
            if near.any():
                roots = np.unique(self.root[np.append(others[near], p)])
                if len(roots) > 1:
                    self.root[np.isin(self.root, roots)] = roots[0]
        return 1 - inter / union

    def rows(self) -> pd.DataFrame:
        """Links (a, b) that span the components, and counts (a, n) if `every`."""
        apart, linked = np.flatnonzero(self.root != np.arange(len(self.root))), np.flatnonzero(self.counts * self.every)
        spans = pd.DataFrame({"a": self.keys[apart], "b": pd.array(self.keys[self.root[apart]], "Int64"), "n": pd.array([0] * len(apart), "Int64")})
        return pd.concat([spans, pd.DataFrame({"a": self.keys[linked], "b": pd.array([None] * len(linked), "Int64"), "n": pd.array(self.counts[linked], "Int64")})])


FOUND = "a long, b long, n long"


def join_regions(tasks: DataFrame, num: int, den: int, every: bool = False) -> DataFrame:
    """Links (a, b) and counts (a, n) of rows (region, role, key, weight, items), each region joined by one task. Sorting keeps each together."""
    names = ["region", "role", "key", "weight", "items"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in whole_regions(frames):
            if len(g) > 1:
                g = g.sort_values("key")
                yield Region(*(g[c].tolist() for c in ("key", "items", "role", "weight")), num, den, every).rows()

    return tasks.select(*names).repartition("region").sortWithinPartitions("region").mapInPandas(run, FOUND)


# --- cells of large regions by Spark jobs -----------------------------------------------------------------


def pivot_distances(large: DataFrame, sizes: DataFrame, sets: DataFrame, rounds: int, num: int, den: int) -> DataFrame:
    """Per set of a region and pivot: pivot, d, linked (the pair is one to link), and the set's role in the pivot's cell, if any.

    A region's sets are dealt in shares and each share gets the pivots' sets, so no task holds a region.
    """
    eps = 1 - num / den
    picks = [F.min_by("key", F.xxhash64("key", F.lit(rounds * PIVOTS + j))).alias(f"p{j}") for j in range(PIVOTS)]
    chosen = large.where(F.col("role") == HOME).groupBy("region").agg(*picks).select("region", F.explode(F.array_distinct(F.array(*(f"p{j}" for j in range(PIVOTS))))).alias("key"))
    pivots = chosen.join(sets, "key").groupBy("region").agg(F.sort_array(F.collect_list(F.struct("key", "items"))).alias("pivots"))
    shares = sizes.select("region", F.greatest(F.lit(1), F.ceil(F.greatest(F.col("members") / MEMBERS, F.col("total") / SHINGLES))).cast("int").alias("shares"))
    dealt = pivots.join(shares, "region").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).select("region", "share", "pivots")
    rows = large.join(_small(shares, shares.count()), "region").withColumn("share", F.pmod(F.xxhash64("key", F.lit(3)), "shares").cast("int"))
    rows = rows.join(sets.select("key", "items"), "key").join(dealt, ["region", "share"]).select("region", "key", "role", "items", "pivots")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for region, key, role, items, near in zip(*(c.to_pylist() for c in b.columns), strict=True):
                x, names = np.frombuffer(items, U64), [p["key"] for p in near]
                centres = [np.frombuffer(p["items"], U64) for p in near]
                inter = np.array([len(np.intersect1d(x, c, assume_unique=True)) for c in centres])
                union = len(x) + np.array([len(c) for c in centres]) - inter
                d, linked = 1 - inter / union, den * inter >= num * union
                if key in names:  # pivots meet each other once, and leave
                    out += [(region, key, names[j], d[j], True, None) for j in range(names.index(key)) if linked[j]]
                    continue
                home = int(d.argmin()) if role == HOME else -1
                inside = d <= d.min() + 2 * eps + TOUCH
                inside &= np.arange(len(d)) <= home if role == HOME else True
                out += [(region, key, names[j], d[j], bool(linked[j]), (HOME if j == home else GUEST) if inside[j] else None) for j in np.flatnonzero(inside | linked)]
            cols = list(zip(*out, strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.bool_(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["region", "key", "pivot", "d", "linked", "role"])

    return rows.mapInArrow(run, "region long, key long, pivot long, d double, linked boolean, role int")


def split_regions(large: DataFrame, sizes: DataFrame, sets: DataFrame, rounds: int, num: int, den: int, every: bool) -> tuple[DataFrame, DataFrame]:
    """(links (a, b) of pivots, rows (region, key, role, was) of the cells, with the size of the region they come from).

    Unless `every` link counts, sets within eps of a cell's pivot are known to be connected: of them only
    those stay that a set beyond eps could link with.
    """
    eps = 1 - num / den
    far = materialize(pivot_distances(large, sizes, sets, rounds, num, den), "distances")
    links = far.where("linked").select(F.col("pivot").alias("a"), F.col("key").alias("b"))
    inside = far.where("role is not null")
    if not every:
        edge = materialize(inside.where("not linked").groupBy("region", "pivot").agg(F.min("d").alias("first")), "edge")
        inside = inside.join(_small(edge, edge.count()), ["region", "pivot"]).where(~F.col("linked") | (F.col("d") >= F.col("first") - eps - TOUCH))
    was = sizes.select("region", F.col("members").alias("was"))
    rows = inside.join(_small(was, was.count()), "region").select(F.xxhash64("region", "pivot", F.lit(rounds)).alias("region"), "key", "role", "was")
    return links, rows


def tiles(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows (region, key, role) of tiles of MEMBERS / 2 sets, each with each, for regions that pivots do not shrink.

    The exact way out for a region whose sets all lie at like distances from each other.
    """
    dealt = rows.join(sizes, "region").withColumn("n", F.greatest(F.lit(1), F.ceil(2 * F.greatest(F.col("members") / MEMBERS, F.col("total") / SHINGLES))).cast("int"))
    dealt = dealt.withColumn("tile", F.pmod(F.xxhash64("key", F.lit(99)), F.col("n")).cast("int"))
    each = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    home = each.where(F.col("role") == HOME)
    within = home.where("tile = other").select(F.xxhash64("region", "tile").alias("region"), "key", "role")
    left = home.where("tile < other").select(F.xxhash64("region", "tile", "other").alias("region"), "key", F.lit(TILE).alias("role"))
    right = home.where("tile > other").select(F.xxhash64("region", "other", "tile").alias("region"), "key", F.lit(GUEST).alias("role"))
    hosts = home.select(F.xxhash64("region", "tile", "other", F.lit(1)).alias("region"), "key", F.lit(TILE).alias("role"))
    guests = each.where(F.col("role") == GUEST).select(F.xxhash64("region", "other", "tile", F.lit(1)).alias("region"), "key", "role")
    return within.unionByName(left).unionByName(right).unionByName(hosts).unionByName(guests)


# --- the join ------------------------------------------------------------------------------------------------


def shared_signatures(rows: DataFrame) -> DataFrame:
    """Signatures (region) that occur more than once.

    Most occur once, so tasks send them alone, sorted and packed to six bytes, to slices of the value
    range; a task sends one at most twice, however often it meets it.
    """
    total = rows.agg(F.sum(F.size("signs"))).first()[0] or 0
    slices = max(1, -(-total // SLICE))

    def pack(found: list[np.ndarray]) -> pa.RecordBatch:
        values, count = np.unique(np.concatenate(found), return_counts=True)
        values = np.repeat(values, np.minimum(count, 2))
        cuts = np.searchsorted(values, np.arange(slices + 1) * (SIGN // slices + 1))
        parts = [(i, values[a:b].view(np.uint8).reshape(-1, 8)[:, :6].T.tobytes()) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a]
        return pa.RecordBatch.from_arrays([pa.array([i for i, _ in parts], pa.int32()), pa.array([p for _, p in parts], pa.binary())], ["slice", "packed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held, seen = [], 0, set()
        for b in batches:
            for key, signs in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if key in seen:
                    continue
                if len(seen) < WORDS:
                    seen.add(key)
                found.append(signs.values.to_numpy(zero_copy_only=False).astype(np.uint64))
                held += len(found[-1])
            if held > REPORT:
                yield pack(found)
                found, held = [], 0
        if held:
            yield pack(found)

    def repeated(pdf: pd.DataFrame) -> pd.DataFrame:
        values = []
        for p in pdf["packed"]:
            wide = np.zeros((len(p) // 6, 8), np.uint8)
            wide[:, :6] = np.frombuffer(p, np.uint8).reshape(6, -1).T
            values.append(wide.view(np.int64).ravel())
        value, count = np.unique(np.concatenate(values), return_counts=True)
        return pd.DataFrame({"region": value[count > 1]})

    sent = rows.where("lo is not null").select("lo", "signs").mapInArrow(run, "slice int, packed binary")
    return sent.groupBy("slice").applyInPandas(repeated, "region long")


def whole_regions(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Regions of a partition sorted by region, each whole."""
    kept = None
    for pdf in frames:
        if not len(pdf):
            continue
        kept = pdf if kept is None else pd.concat([kept, pdf], ignore_index=True)
        ids = kept["region"].to_numpy()
        cuts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield kept.iloc[a:b]
        kept = kept.iloc[cuts[-1] :].reset_index(drop=True)
    if kept is not None:
        yield kept


def families(rows: DataFrame, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(names: hi, lo and a number `key` of the sets that share a signature with another; vertex and root of each family)."""
    shared = materialize(shared_signatures(rows), "shared")
    signed = rows.where("lo is not null").select("hi", "lo", F.explode("signs").alias("region"))
    members = materialize(signed.join(shared.hint("shuffle_hash"), "region", "left_semi").distinct(), "members")
    several = members.groupBy("region").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1").select("region")
    members = materialize(members.join(several, "region", "left_semi"), "members")
    names = materialize(members.select("hi", "lo").distinct().withColumn("key", F.monotonically_increasing_id()), "names")
    n_names = names.count()
    numbered = materialize(members.join(_small(names, n_names), ["hi", "lo"]).select("region", "key"), "numbered")
    # Signatures that agree in their smallest set are one block, so copies that share many of them move once.
    low = numbered.groupBy("region").agg(F.min("key").alias("block"))
    blocks = materialize(numbered.join(low, "region").select("block", "key").distinct(), "blocks")
    marks = rows.where("lo is not null").join(_small(names, n_names), ["hi", "lo"]).select("key", "n_shingles", "level", "below", "own").dropDuplicates(["key"])
    return names, materialize(components(likely_edges(blocks, materialize(marks, "marks"), num, den)), "families")


def likely_edges(blocks: DataFrame, marks: DataFrame, num: int, den: int) -> DataFrame:
    """Edges (a, b) that connect, in each block, the sets that agree in as many classes as a link needs.

    Texts with a passage in common agree in a class or two; without this they would chain to one family.
    A block too large for one task is connected whole.
    """
    sizes = blocks.groupBy("block").agg(F.count(F.lit(1)).alias("members"))
    large = blocks.join(sizes.where(F.col("members") > MEMBERS).select("block"), "block", "left_semi").select(F.col("key").alias("a"), F.col("block").alias("b"))
    small = blocks.join(sizes.where(F.col("members") <= MEMBERS).select("block"), "block", "left_semi").join(marks, "key")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        signer = classes(num, den)
        for g in whole_regions(frames):
            keys, root = g["key"].to_numpy(), np.arange(len(g))
            size, level = g["n_shingles"].to_numpy(), g["level"].to_numpy()
            for k in np.unique(level):
                at = np.flatnonzero((level == k) | (level == k + 1))
                marked = np.stack([np.frombuffer(g["own"].iat[i] if level[i] == k else g["below"].iat[i], np.uint8) for i in at])
                for row in np.flatnonzero(level[at] == k):
                    p = at[row]
                    open_ = (root[at] != root[p]) & (den * size[at] >= num * size[p]) & (den * size[p] >= num * size[at])
                    near = np.flatnonzero(open_)
                    near = at[near[(marked[near] == marked[row]).sum(axis=1) >= signer.needed(int(k))]]
                    if len(near):
                        roots = np.unique(root[np.append(near, p)])
                        root[np.isin(root, roots)] = roots[0]
            apart = np.flatnonzero(root != np.arange(len(root)))
            yield pd.DataFrame({"a": keys[apart], "b": keys[root[apart]]})

    rows = small.select(F.col("block").alias("region"), "key", "n_shingles", "level", "below", "own")
    return large.unionByName(rows.repartition("region").sortWithinPartitions("region").mapInPandas(run, "a long, b long"))


def link_regions(regions: DataFrame, sets: DataFrame, num: int, den: int, every: bool = False) -> DataFrame:
    """Links (a, b) that span components, and counts (a, n) if `every`, of rows (region, key)."""
    held = sets.select("key", "n").hint("merge")
    rows = materialize(regions.select("region", "key", F.lit(HOME).alias("role"), F.lit(None).cast("long").alias("was")), "regions")
    tasks, found = [], []
    for rounds in range(ROUNDS + 1):
        at_home = F.count_if(F.col("role") == HOME)
        sizes = rows.join(held, "key").groupBy("region").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("total"), F.max("was").alias("was"), at_home.alias("homes")).where("homes > 0")
        sizes = materialize(sizes, "sizes")
        big = (F.col("members") > MEMBERS) | (F.col("total") > SHINGLES)
        stuck = big & ((F.col("was").isNotNull() & (F.col("members") > 0.9 * F.col("was"))) | F.lit(rounds == ROUNDS) | (F.col("homes") <= PIVOTS))
        n_big, n_stuck, most = sizes.agg(F.count_if(big & ~stuck), F.count_if(stuck), F.max("members")).first()
        if not most:
            break
        tasks.append(rows.join(sizes.where(~big).select("region"), "region", "left_semi").select("region", "key", "role"))
        if n_stuck:
            tasks.append(tiles(rows.select("region", "key", "role"), sizes.where(stuck).select("region", "members", "total")))
        if not n_big:
            break
        large = rows.join(sizes.where(big & ~stuck).select("region"), "region", "left_semi").select("region", "key", "role")
        links, cells = split_regions(large, sizes.where(big & ~stuck), sets, rounds, num, den, every)
        found.append(links)
        rows = materialize(cells, "cells")
    whole = regions.where(F.lit(False)).select("region", "key", F.lit(HOME).alias("role"))
    for t in tasks:
        whole = whole.unionByName(t)
    links = join_regions(whole.join(sets.select("key", "weight", "items"), "key"), num, den, every)
    weight = sets.select(F.col("key").alias("b"), F.col("weight").alias("n"))
    for f in found:
        links = links.unionByName(f.select("a", "b", F.lit(0).cast("long").alias("n")))
        if every:
            both = f.unionByName(f.select(F.col("b").alias("a"), F.col("a").alias("b")))
            links = links.unionByName(both.join(weight, "b").groupBy("a").agg(F.sum("n").alias("n")).select("a", F.lit(None).cast("long").alias("b"), "n"))
    return links


def ngram_jaccard_join(docs: DataFrame, words: int = 3, num: int = 90, den: int = 100, every: bool = False) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id. Two texts link when den * shared >= num * union.

    With `every` no link is left out, and n_links is the number of other rows that the row links with,
    its equals among them. Without, links are only found as far as components need them.
    """
    name = ["hi", "lo"]
    rows = materialize(signed_rows(docs, words, num, den), "signed")
    groups = materialize(rows.where("lo is not null").groupBy(*name).agg(F.count(F.lit(1)).alias("size_"), F.min("doc_id").alias("low")), "groups")
    names, family = families(rows, num, den)
    n_keys = family.count()
    names = names.join(_small(family.select(F.col("vertex").alias("key"), F.col("root").alias("family")), n_keys), "key")
    named = materialize(groups.join(_small(names, n_keys), name), "named")
    found = sets_of_ids(id_and_text(docs), named.select(F.col("low").alias("rep_id")).distinct(), n_keys, words)
    sets = found.join(_small(named.select(*name, "key", F.col("size_").alias("weight")), n_keys), name)
    sets = materialize(sets.select("key", "weight", "n", "items"), "sets")
    found = materialize(link_regions(named.select(F.col("family").alias("region"), "key"), sets, num, den, every), "found")
    roots = materialize(components(found.where("b is not null").select("a", "b")), "roots")
    rooted = named.join(_small(roots, roots.count()), F.col("key") == F.col("vertex"), "left").select("key", *name, "low", F.coalesce("root", "key").alias("root"))
    lows = materialize(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "lows")
    facts = rooted.join(_small(lows, lows.count()), "root").select("key", *name, "component_id")
    if every:
        near = materialize(found.where("b is null").groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("n_near")), "near")
        facts = facts.join(_small(near, near.count()), "key", "left")
    facts = materialize(facts.drop("key"), "facts")
    counts = [(F.col("size_") - 1 + F.coalesce("n_near", F.lit(0))).alias("n_links")] if every else []
    whole = groups.join(_small(facts, n_keys), name, "left").select(*name, "size_", F.coalesce("component_id", "low").alias("component_id"), *counts)
    joined = join_groups(rows.select("doc_id", "n_shingles", *name), whole, name, "size_", rows.count())
    links = [F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")] if every else []
    return joined.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), *links)
