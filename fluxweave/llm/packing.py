"""Packing into fixed windows: non-negative least squares over the length histogram.

Every document is its token ids and an end id. Full windows are cut off its front; the rest (shorter
than a window) is an item. Only the histogram of item lengths, at most window - 1 numbers, reaches
the driver. There, combinations of up to three lengths that fill a window exactly are enumerated,
their repeat counts solved by non-negative least squares against the histogram and rounded: down
first, then up by largest remainder as far as the histogram allows. What that leaves over is enumerated
and solved again until no combination is left, then in the same way with combinations of up to eight. The residual items are packed greedily, the longest that
fits first, into windows that this fills exactly; the few then left are laid end to end and cut at window
ends, so only they are cut. The last, partly filled window is cut into powers of two, which need no
padding.

An item's place follows from its length and its rank among items of that length: ranks are kept per
task and shifted by prefix sums, so no length class is ever sorted in one place.

Defined cases: null text counts as empty and gives the end id alone; rows that repeat are packed
each; a null doc_id stays null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import arrow_limits, id_and_text, materialize

MODEL = public_tokenizers.path("word_bpe_49k.json")
WINDOW, END = 2048, 1
#: Words, and pre-tokens, that a worker keeps (the first it meets, which the frequent ones are among); longest kept.
WORDS, PARTS, WORD = 350_000, 700_000, 48
#: Combinations enumerated for each length at once (more come once those are placed), and lengths of the deepest; the
#: solver ends when a step moves the counts by less than this share, and in any case after so many steps.
PARTNERS, DEPTH, SETTLED, STEPS = 6, 8, 1e-4, 5_000

# --- token ids ---------------------------------------------------------------------------------

#: The byte-to-character table of byte-level vocabularies keeps printable bytes as they are.
_KEPT = [*range(33, 127), *range(161, 173), *range(174, 256)]
_CHARS = {b: chr(b) for b in _KEPT} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _KEPT)}
#: Words of these characters alone are cut here; all others go through the tokenizer whole.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-įĲ-ľŁ-ňŊ-ž]*")
#: The tokenizer's own pattern for such characters, in lower case.
_PART = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ž]+|[0-9]|[^a-zß-öø-ž0-9]+")


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> Tokenizer:
    if sys.byteorder != "little":
        raise RuntimeError("ids are kept in little-endian order")
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    found = Tokenizer.from_file(path)
    found.model._resize_cache(0)  # the caches here hold more
    return found


class Ids(dict):
    """16-bit ids of each word between ASCII blanks, as bytes; the tokenizer drops white space, so words join."""

    def __init__(self, path: str):
        super().__init__({"": b""})
        self.whole, self.parts = _tokenizer(path), {}
        self.model = self.whole.model
        self.special = os.path.commonprefix([t.content for t in self.whole.get_added_tokens_decoder().values()])
        if self.whole.get_vocab_size() > 65536:
            raise ValueError("ids need 16 bits")

    def __missing__(self, word: str) -> bytes:
        if word.isalpha() and word.isascii() and len(word) <= WORD:
            got = self.part(word.lower())
        elif len(word) <= WORD and _PLAIN.fullmatch(word) and self.special and self.special not in word:
            got = b"".join(map(self.part, _PART.findall(word.lower())))
        else:
            got = np.array(self.whole.encode(word, add_special_tokens=False).ids, "<u2").tobytes()
        if len(word) <= WORD and len(self) < WORDS:
            self[word] = got
        return got

    def part(self, p: str) -> bytes:
        got = self.parts.get(p)
        if got is None:
            text = p if p.isascii() else "".join(_CHARS[b] for b in p.encode("utf-8"))
            got = array("H", [t.id for t in self.model.tokenize(text)]).tobytes()
            if len(self.parts) < PARTS:
                self.parts[p] = got
        return got

    def of(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").replace("\t", " ").split(" ")))


def token_rows(docs: DataFrame, model: str = MODEL, window: int = WINDOW, end: int = END) -> DataFrame:
    """doc_id, ids (16-bit, with the end id), and the row's task, number, item length and rank in its task."""
    arrow_limits(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, task, number = Ids(model), TaskContext.get().partitionId(), 0
        last = np.array([end], "<u2").tobytes()
        ranks, full = np.zeros(window, np.int64), 0
        for b in batches:
            ids = [table.of(t) + last for t in b.column(1).to_pylist()]
            n = np.array([len(x) // 2 for x in ids], np.int64)
            rest, whole = n % window, n // window
            rank = np.empty(len(n), np.int64)
            for i, r in enumerate(rest):
                rank[i] = ranks[r]
                ranks[r] += 1
            windows = full + np.cumsum(whole) - whole
            full += int(whole.sum())
            rows = number + np.arange(len(n))
            number += len(n)
            cols = [b.column(0), pa.array(ids, pa.binary()), pa.array(np.full(len(n), task)), pa.array(rows), pa.array(n), pa.array(rest), pa.array(rank), pa.array(windows)]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "ids", "task", "row", "n", "rest", "rank", "windows"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, ids binary, task long, row long, n long, rest long, rank long, windows long")


# --- the plan, from the histogram alone ----------------------------------------------------------


def combinations(hist: np.ndarray, window: int) -> np.ndarray:
    """Rows of three lengths (0: none) that fill the window and that the histogram holds: all pairs, and some triples of each length."""
    have = np.flatnonzero(hist)
    pairs = np.array([(window - a, a, 0) for a in have if hist[window - a] and (a * 2 < window or (a * 2 == window and hist[a] > 1))], np.int64).reshape(-1, 3)
    common = have[np.argsort(-hist[have], kind="stable")]
    found: list[np.ndarray] = [pairs]
    for a in have:
        b = common[common + a < window]
        c = window - a - b
        ok = (hist[c] > 0) & (b <= c) & (hist[b] > (b == c) + (b == a).astype(int)) & (hist[c] > (c == a))
        take = np.flatnonzero(ok)[:PARTNERS]
        if len(take):
            found.append(np.sort(np.stack([np.full(len(take), a), b[take], c[take]], 1), axis=1)[:, ::-1])
    return np.unique(np.concatenate(found), axis=0)


def deeper(hist: np.ndarray, window: int) -> np.ndarray:
    """Rows of DEPTH lengths (0: none) that fill the window and that the histogram holds: for each length, common lengths until a pair fits."""
    have = np.flatnonzero(hist)
    common = have[np.argsort(-hist[have], kind="stable")]
    free, found = np.append(hist, np.zeros(window, np.int64)), []
    for n, a in enumerate(have.tolist()):
        chosen, room, k = [a], window - a, n
        free[a] -= 1
        while room > 1 and len(chosen) <= DEPTH - 2:
            b = common[(common < room) & (free[common] > 0)]
            fits = np.flatnonzero(free[room - b] > (b * 2 == room))
            if len(fits):
                b = int(b[fits[n % len(fits)]])
                found.append(sorted([*chosen, b, room - b], reverse=True) + [0] * (DEPTH - 2 - len(chosen)))
                break
            if not len(b):
                break
            k = (k * 7 + 1) % len(b)
            chosen.append(int(b[k]))
            free[chosen[-1]] -= 1
            room -= chosen[-1]
        for length in chosen:
            free[length] += 1
    return np.unique(np.array(found, np.int64).reshape(-1, DEPTH), axis=0)


def solve(patterns: np.ndarray, hist: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """min |A x - h| for x >= 0 by accelerated projected gradient; A holds each pattern's lengths."""
    used = patterns > 0
    size = len(hist)
    forward = lambda x: np.bincount(patterns.ravel(), (x[:, None] * used).ravel(), size)
    back = lambda r: (r[patterns] * used).sum(1)
    x = y = np.zeros(len(patterns))
    goal, t = hist.astype(float), 1.0
    bound = max(1.0, float(back(forward(np.ones(len(patterns)))).max()))
    for _ in range(steps):
        new = np.maximum(0, y - back(forward(y) - goal) / bound)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        moved = np.abs(new - x).sum()
        x, t = new, t_new
        if moved <= SETTLED * x.sum():
            break
    return x


class Plan:
    """Where the item (length, rank) goes."""

    def __init__(self, hist: np.ndarray, window: int = WINDOW):
        self.window, self.left = window, hist.copy()
        self.left[0] = 0
        self.fitted, self.taken = 0, np.zeros(len(hist), np.int64)
        self.by_length: dict[int, list | np.ndarray] = {}
        for enumerate_ in (combinations, deeper):
            while len(patterns := enumerate_(self.left, window)):
                counts = solve(patterns, self.left)
                whole = np.floor(counts + 1e-9)
                for k in np.argsort(-whole, kind="stable"):
                    self.fill(patterns[k], whole[k])
                for k in np.argsort(whole - counts, kind="stable"):
                    self.fill(patterns[k], 1)
        self.combined = self.fitted
        self.pack_greedily()
        self.by_length = {k: np.array(v, np.int64) for k, v in self.by_length.items()}
        lengths = np.arange(len(hist))
        self.stream = np.concatenate([[0], np.cumsum(self.left * lengths)])  # where each length's residual items begin
        self.total = int(self.stream[-1])

    def fill(self, lengths: np.ndarray, times: float) -> bool:
        """Windows of these lengths, so many times or as often as items are left."""
        lengths = lengths[lengths > 0]
        kinds, multiple = np.unique(lengths, return_counts=True)
        times = int(min(times, (self.left[kinds] // multiple).min()))
        if times <= 0:
            return False
        offset = 0
        for length in lengths.tolist():
            self.by_length.setdefault(length, []).append((int(self.taken[length]), self.fitted, offset))
            self.taken[length] += times
            self.left[length] -= times
            offset += length
        self.fitted += times
        return True

    def pack_greedily(self) -> None:
        """Windows of the longest length left and, again and again, the longest that still fits, where that ends full."""
        for longest in reversed(np.flatnonzero(self.left).tolist()):
            while self.left[longest]:
                free, room, chosen = self.left.copy(), self.window, []
                while len(fits := np.flatnonzero(free[: room + 1])) and len(chosen) < self.window:
                    length = longest if not chosen else int(fits[-1])
                    chosen.append(length)
                    free[length] -= 1
                    room -= length
                if room or not self.fill(np.array(chosen), np.inf):
                    break

    def tail(self, at: int) -> tuple[int, int, int]:
        """(piece of the last window, its start, its length) that holds position `at` of the last, partly filled window."""
        rest, start, k = self.total % self.window, 0, 0
        for bit in reversed(range(rest.bit_length())):
            if rest >> bit & 1:
                if at < start + (1 << bit):
                    return k, start, 1 << bit
                start, k = start + (1 << bit), k + 1
        raise ValueError("past the end")

    def place(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """Pieces (start in item, length, sequence, offset) of an item."""
        if rank < self.taken[length]:
            table = self.by_length[length]
            start, first, offset = table[np.searchsorted(table[:, 0], rank, "right") - 1]
            return [(0, length, int(first + rank - start), int(offset))]
        at, done, out = int(self.stream[length] + (rank - self.taken[length]) * length), 0, []
        while done < length:
            w, inside = divmod(at + done, self.window)
            k, start, room = (0, 0, self.window) if w < self.total // self.window else self.tail(inside)
            n = min(length - done, start + room - inside)
            out.append((done, n, self.fitted + w + k, inside - start))
            done += n
        return out

    @property
    def sequences(self) -> int:
        return self.fitted + self.total // self.window + (self.total % self.window).bit_count()


# --- the job ---------------------------------------------------------------------------------------

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, window: int = WINDOW, model: str = MODEL) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset."""
    return cut_pieces(materialize(token_rows(docs, model, window), "token-ids"), window)


def cut_pieces(rows: DataFrame, window: int) -> DataFrame:
    spark = rows.sparkSession
    counts = rows.groupBy("task", "rest").agg(F.count(F.lit(1)).alias("items"), F.sum(F.expr(f"n div {window}")).alias("fulls"))
    counts = materialize(counts, "length-counts")
    hist = np.zeros(window, np.int64)
    for r in counts.groupBy("rest").agg(F.sum("items").alias("items")).collect():
        hist[r["rest"]] = r["items"]
    plan = spark.sparkContext.broadcast(Plan(hist, window))
    before = Window.partitionBy("rest").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    ranks = counts.select("task", "rest", F.coalesce(F.sum("items").over(before), F.lit(0)).alias("rank_base"))
    tasks = window_bases(counts)
    # Narrow columns find their places; the ids meet them again by (task, row).
    placed = rows.select("task", "row", "n", "rest", "rank", "windows").join(ranks, ["task", "rest"]).join(tasks, "task")
    placed = placed.select("task", "row", (F.col("rank") + F.col("rank_base")).alias("rank"), (F.col("windows") + F.col("window_base")).alias("first_window"))
    joined = rows.select("doc_id", "ids", "task", "row", "n").join(placed, ["task", "row"]).select("doc_id", "ids", "n", "rank", "first_window")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = plan.value
        for b in batches:
            out = []
            for doc_id, ids, n, rank, first in zip(*(c.to_pylist() for c in b.columns), strict=True):
                wide = np.frombuffer(ids, "<u2").astype("<u4").tobytes()
                whole = n // window
                pieces = [(k * window, window, p.sequences + first + k, 0) for k in range(whole)]
                if n % window:
                    pieces += [(whole * window + a, m, s, o) for a, m, s, o in p.place(n % window, rank)]
                out += [(doc_id, a, m, zlib.crc32(wide[4 * a : 4 * (a + m)]), n, s, o) for a, m, s, o in pieces]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return joined.mapInArrow(run, PIECES)


def window_bases(counts: DataFrame) -> DataFrame:
    """For each task, the full windows of the tasks before it: a prefix sum in blocks of tasks."""
    block = F.expr("task div 1000")
    per = counts.groupBy("task").agg(F.sum("fulls").alias("fulls")).withColumn("block", block)
    inside = Window.partitionBy("block").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    blocks = per.groupBy("block").agg(F.sum("fulls").alias("fulls"))
    # A thousandth of the tasks: few rows, so one window over all of them.
    above = blocks.select("block", F.coalesce(F.sum("fulls").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("above"))
    return per.select("task", "block", F.coalesce(F.sum("fulls").over(inside), F.lit(0)).alias("inner")).join(above, "block").select("task", (F.col("inner") + F.col("above")).alias("window_base"))
