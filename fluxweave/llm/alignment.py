"""Cross-tokenizer alignment by interval coalescing.

Tokens of both tokenizers are byte intervals. All tokens of a batch of texts are sorted by start together; a
running maximum of their ends tells where a group breaks: where a start reaches it, every token before has
ended, on both sides. Inside a group the overlaps are expanded: to each A token the run of B tokens that it
touches. All of it works on whole arrays; the texts of a batch lie one behind the other, so no interval
reaches from one into the next.

Words between single spaces are encoded once and kept in a worker's cache as the tokens of both sides, since
neither tokenizer reaches across such a space; a text for which that is not certain is encoded whole.

How often an id pair is linked is a count over the corpus. Each task sums its own pairs and writes the sums beside
its rows, which hold their distinct pairs; so texts are encoded once. The most frequent pairs, a bounded number,
are broadcast and looked up in place; what a row holds beyond them is joined by pair, and no pair left for
the join is frequent. The highest count of each B id has one row for each B id, which the vocabulary bounds.

Defined cases: null and empty texts, and texts whose tokens do not spell a space and the text (such with
U+2581, which one side reads as a space), have no tokens: all counts are 0 and the hash is the empty string;
rows that repeat are rows of their own and count each; a null doc_id stays null; an empty table gives an empty
result; other columns are ignored; long texts are encoded whole, long words are not cached.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import arrow_limits, id_and_text, materialize

A_MODEL, B_MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
#: Words that a worker keeps, longest kept, pairs that a task sums before it writes them, pairs that are broadcast.
WORDS, WORD, SUMMED, FREQUENT = 300_000, 48, 1_000_000, 400_000
#: Characters of text aligned at once.
BLOCK = 1 << 20

#: The byte-to-character table of byte-level vocabularies keeps printable bytes as they are.
_KEPT = [*range(33, 127), *range(161, 173), *range(174, 256)]
_CHARS = {b: chr(b) for b in _KEPT} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _KEPT)}


class Side:
    """The bytes and decimal id of every token of a vocabulary."""

    def __init__(self, spelled: list[bytes]):
        self.spelled = spelled
        self.size = np.array([len(x) for x in spelled], np.int64)


@lru_cache(maxsize=2)
def models(a_path: str, b_path: str) -> tuple[Tokenizer, sentencepiece.SentencePieceProcessor, Side, Side]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    byte = {c: b for b, c in _CHARS.items()}
    entries = sorted(json.loads(a.to_str())["model"]["vocab"].items(), key=lambda x: x[1])
    spelled = [b""] * (a.get_vocab_size() + 1)
    for token, i in entries:
        spelled[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
    b = sentencepiece.SentencePieceProcessor(model_file=b_path)
    pieces = []
    for i in range(b.get_piece_size()):
        piece = b.id_to_piece(i)
        pieces.append(bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode())
        if " " in pieces[-1].decode("utf-8", "replace").lstrip(" "):
            raise ValueError(f"{piece!r} reaches across words")
    return a, b, Side(spelled), Side(pieces)


#: Where a space does not part a text for certain: other white space next to it, white space at an end, the space mark.
_UNCERTAIN = re.compile(r" \s|\s |^\s|\s\Z|▁")
#: Words that are one run of Latin letters and one of marks, which the A side takes apart there.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ɏ]+)([.,;:!?]*)")


class Words(dict):
    """Numbers of words; the tokens of both sides lie in flat arrays, each word's between two offsets."""

    def __init__(self, a_path: str, b_path: str):
        super().__init__()
        self.a, self.b, self.sa, self.sb = models(a_path, b_path)
        self.model, self.marks = self.a.model, {"": []}
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.ids, self.ends, self.same = (array("i"), array("i")), (array("q", [0]), array("q", [0])), array("b")

    def _a(self, text: str) -> list[int]:
        return [t.id for t in self.model.tokenize("".join(_CHARS[b] for b in text.encode()))]

    def _plain(self, word: str) -> list[int] | None:
        found = _PLAIN.fullmatch(word)
        if found is None:
            return None
        stem, mark = found.groups()
        if mark not in self.marks:
            self.marks[mark] = self._a(mark)
        return [t.id for t in self.model.tokenize("Ġ" + stem)] + self.marks[mark] if stem.isascii() else self._a(" " + stem) + self.marks[mark]

    def add(self, words: list[str]) -> None:
        """Numbers for words that have none; each stands for a space and the word."""
        a_ids = list(map(self._plain, words))
        odd = [i for i, x in enumerate(a_ids) if x is None]
        for i, e in zip(odd, self.a.encode_batch([" " + words[i] for i in odd], add_special_tokens=False), strict=True):
            a_ids[i] = e.ids
        for word, a, b in zip(words, a_ids, self.b.encode(words, num_threads=1), strict=True):
            whole = (" " + word).encode()
            same = b"".join(map(self.sb.spelled.__getitem__, b)) == whole and b"".join(map(self.sa.spelled.__getitem__, a)) == whole
            self[word] = len(self.same)
            self.same.append(same)
            for flat, ends, ids in zip(self.ids, self.ends, (a, b), strict=True):
                flat.extend(ids)
                ends.append(len(flat))

    def drop(self, words: list[str]) -> None:
        """Takes back the words that were added last."""
        n = len(self.same) - len(words)
        for w in words:
            del self[w]
        del self.same[n:]
        for flat, ends in zip(self.ids, self.ends, strict=True):
            del flat[ends[n] :], ends[n + 1 :]

    def gather(self, side: int, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one behind the other, and how many each has."""
        flat, ends = np.array(self.ids[side], np.int32), np.array(self.ends[side], np.int64)
        n = ends[codes + 1] - ends[codes]
        at = np.repeat(ends[codes] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return flat[at], n


def encode(texts: list[str], words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Token ids of both sides, all texts one behind the other, and how many of each side a text has: 0 where they do not spell it."""
    parts = [([t] if _UNCERTAIN.search(t) else t.split(" ")) if t else [] for t in texts]
    if len(words) > WORDS:
        words.clear()
    new = {w for w in set(chain.from_iterable(parts)) if w not in words}
    long = [w for w in new if len(w) > WORD]
    words.add([w for w in new if len(w) <= WORD])
    words.add(long)
    sizes = np.array([len(p) for p in parts], np.int64)
    codes = np.fromiter(map(words.__getitem__, chain.from_iterable(parts)), np.int64, int(sizes.sum()))
    owner = np.repeat(np.arange(len(texts)), sizes)
    wrong = np.bincount(owner[np.array(words.same, bool)[codes] == 0], minlength=len(texts)) > 0
    codes, owner = codes[~wrong[owner]], owner[~wrong[owner]]
    (a, n_a), (b, n_b) = words.gather(0, codes), words.gather(1, codes)
    words.drop(long)
    return a, b, np.bincount(owner, n_a, len(texts)).astype(np.int64), np.bincount(owner, n_b, len(texts)).astype(np.int64)


def coalesce(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Group numbers of intervals that are sorted by start: a group breaks where a start reaches the running maximum of the ends."""
    if not len(start):
        return np.zeros(0, np.int64)
    reach = np.maximum.accumulate(end)
    return np.concatenate([[0], np.cumsum(start[1:] >= reach[:-1])])


def align(a: np.ndarray, b: np.ndarray, a_size: np.ndarray, b_size: np.ndarray) -> dict[str, np.ndarray]:
    """Of token ids and byte lengths that spell the same bytes: order, side and group of all tokens, and links as positions in a and b."""
    a_end, b_end = np.cumsum(a_size), np.cumsum(b_size)
    a_start, b_start = a_end - a_size, b_end - b_size
    start, end = np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end])
    side = np.concatenate([np.zeros(len(a), np.int8), np.ones(len(b), np.int8)])
    order = np.lexsort((side, start))
    group = coalesce(start[order], end[order])
    # Within its group an A token overlaps the B tokens from the one that ends behind its start to the one that starts before its end.
    first, last = np.searchsorted(b_end, a_start, "right"), np.searchsorted(b_start, a_end, "left")
    n = last - first
    left = np.repeat(np.arange(len(a)), n)
    right = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    return {"order": order, "side": side, "group": group, "left": left, "right": right}


@lru_cache(maxsize=2)
def _written(size: int) -> np.ndarray:
    """Every id with each of the three signs that can follow it."""
    return np.array([f"{i}{sign}" for sign in ",|;" for i in range(size)], object)


def _spell(ids: np.ndarray, side: np.ndarray, group: np.ndarray, size: int) -> str:
    """`a1,a2|b1;a3|b2,b3` of tokens sorted by group, then side; size: above all ids."""
    sign = np.zeros(len(ids), np.int64)
    sign[:-1][side[:-1] < side[1:]] = 1
    sign[:-1][group[:-1] < group[1:]] = 2
    return "".join(_written(size)[sign * size + ids].tolist())[:-1]


def _blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= BLOCK:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


_ROW = "kind int, row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<bigint>, counts array<int>, pair long, total long"
_COLUMNS = [x.split()[0] for x in _ROW.split(", ")]
_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int64(), pa.int64()]


def _aligner(a_path: str, b_path: str):
    """Rows of kind 0 for texts, and rows of kind 1 with a task's sums of pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, row = Words(a_path, b_path), TaskContext.get().partitionId() << 40
        keys, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        a_len, b_len = words.sa.size, words.sb.size
        most = max(len(a_len), len(b_len))

        def summed() -> pa.RecordBatch:
            n = len(keys)
            return pa.RecordBatch.from_arrays([pa.array([1] * n, pa.int32()), *(pa.nulls(n, t) for t in _TYPES[1:10]), pa.array(keys), pa.array(sums)], _COLUMNS)

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in _blocks(texts):
                a, b, n_a, n_b = encode(texts[lo:hi], words)
                got = align(a, b, a_len[a], b_len[b])
                # Sorted by start, a group's tokens are sorted by side in a second, stable step.
                place = got["order"][np.lexsort((got["side"][got["order"]], got["group"]))]
                every, side, group = np.concatenate([a, b])[place], got["side"][place], np.sort(got["group"])
                pair = a[got["left"]].astype(np.int64) << 32 | b[got["right"]]
                ends, ends_links = np.cumsum(n_a + n_b), np.searchsorted(got["left"], np.cumsum(n_a), "left")
                out, at, at_link = [], 0, 0
                for i in range(lo, hi):
                    if n_a[i - lo] == 0:
                        out.append((0, row, ids[i], 0, 0, 0, 0, "", [], [], None, None))
                    else:
                        cut, links = slice(at, ends[i - lo]), pair[at_link : ends_links[i - lo]]
                        at, at_link = ends[i - lo], ends_links[i - lo]
                        found, count = np.unique(links, return_counts=True)
                        digest = hashlib.sha256(_spell(every[cut], side[cut], group[cut], most).encode()).hexdigest()
                        out.append((0, row, ids[i], n_a[i - lo], n_b[i - lo], int(group[cut][-1] - group[cut][0]) + 1, len(links), digest, found, count.astype(np.int32), None, None))
                    row += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _TYPES, strict=True)], _COLUMNS)
                both, at_both = np.unique(np.concatenate([keys, pair]), return_inverse=True)
                sums = np.bincount(at_both, np.concatenate([sums, np.ones(len(pair), np.int64)]), len(both)).astype(np.int64)
                keys = both
                if len(keys) > SUMMED:
                    yield summed()
                    keys, sums = keys[:0], sums[:0]
        yield summed()

    return run


_LOOKED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, best long, total long, rare array<bigint>, times array<int>"


def _looker(table):
    """Sums over the frequent pairs of a row, and its other pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, top = table.value
        for b in batches:
            offsets, pairs, times = b.column("pairs").offsets.to_numpy(), b.column("pairs").values.to_numpy(), b.column("counts").values.to_numpy()
            base, offsets = offsets[0], offsets - offsets[0]
            pairs, times = pairs[base : base + offsets[-1]], times[base : base + offsets[-1]]
            at = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
            hit = keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)
            owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
            n, w = len(offsets) - 1, times.astype(np.int64)
            best, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
            np.add.at(total, owner[hit], (w * (counts[at] if len(keys) else 0))[hit])
            np.add.at(best, owner[hit], (w * (top[at] if len(keys) else 0))[hit])
            left = np.concatenate([[0], np.cumsum(np.bincount(owner[~hit], minlength=n))]).astype(np.int32)
            rare, rare_times = pa.ListArray.from_arrays(pa.array(left), pa.array(pairs[~hit])), pa.ListArray.from_arrays(pa.array(left), pa.array(times[~hit]))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(7)), pa.array(best), pa.array(total), rare, rare_times], [x.split()[0] for x in _LOOKED.split(", ")])

    return run


def pair_counts(sums: DataFrame) -> DataFrame:
    """pair, links (how many hold it), top (whether no pair of its B id has more)."""
    counts = materialize(sums.groupBy("pair").agg(F.sum("total").alias("links")).withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))), "pair-counts")
    most = counts.groupBy("b").agg(F.max("links").alias("most"))  # a row for each B id at most
    return counts.join(F.broadcast(most), "b").select("pair", "links", (F.col("links") == F.col("most")).alias("top"))


def align_rows(docs: DataFrame, a_model: str = A_MODEL, b_model: str = B_MODEL) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    arrow_limits(spark)
    written = materialize(id_and_text(docs).mapInArrow(_aligner(a_model, b_model), _ROW), "aligned")
    counted = materialize(pair_counts(written.where("kind = 1")), "pairs")
    frequent = counted.orderBy(F.desc("links"), "pair").limit(FREQUENT).toArrow()
    keys = frequent.column("pair").to_numpy()
    order = np.argsort(keys)
    table = spark.sparkContext.broadcast((keys[order], frequent.column("links").to_numpy()[order], frequent.column("top").to_numpy()[order].astype(np.int64)))
    rows = written.where("kind = 0").select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "counts")
    looked = materialize(rows.mapInArrow(_looker(table), _LOOKED), "looked-up")
    rare = looked.where(F.size("rare") > 0).select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("pair"), F.col("x.times").alias("times"))
    found = rare.join(counted, "pair").groupBy("row").agg(F.sum(F.when(F.col("top"), F.col("times")).otherwise(0)).alias("rare_best"), F.sum(F.col("times") * F.col("links")).alias("rare_total"))
    out = looked.drop("rare", "times").join(found, "row", "left")
    best, total = F.col("best") + F.coalesce("rare_best", F.lit(0)), F.col("total") + F.coalesce("rare_total", F.lit(0))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", best.alias("n_best"), total.alias("count_sum"), "groups_sha256")
