"""SentencePiece encoding and decoding with a suffix array over the batch's text.

The distinct pre-tokens of a batch are laid end to end, in blocks. The suffixes of a block, as far as
the longest piece reaches, are sorted once; each vocabulary piece finds the range of its occurrences
by binary search; the occurrences are the edges of a lattice. Sorted by position they are relaxed from
left to right, all pre-tokens of a block at once. A bounded cache, the second tier, keeps the ids of
pre-tokens of earlier batches, which are not indexed again. The vocabulary is a merge (BPE) one, where a path is the encoding
exactly if every two neighbouring pieces encode to themselves; so each position has one last piece,
and relaxing keeps the edge whose pair with the last piece before it holds. Characters without an
edge fall back to byte pieces.

Defined cases: null text counts as empty and has no ids; texts with runs of spaces are taken as one
pre-token each run; a null doc_id stays null; rows that repeat give equal rows; an empty table gives
an empty result; very long texts are encoded whole, in memory for a few numbers a character; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_limits, id_and_text
from .tokens import MODEL, processor

#: Pre-tokens that a worker keeps (the first it meets, which the frequent ones are among); characters from which
#: one is not kept and is cut into parts; characters indexed at once; pairs kept.
CACHED, WORD, INDEXED, PAIRS = 300_000, 48, 1 << 17, 500_000
#: A text's pre-tokens: spaces with the word after them, or a line feed.
_CUT = re.compile("▁+[^▁\n]*|\n|[^▁\n]+")


class Vocabulary:
    def __init__(self, path: str):
        sp = processor(path)
        normal = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.ids = {sp.id_to_piece(i): i for i in normal}
        self.score = {sp.id_to_piece(i): sp.get_score(i) for i in normal}
        self.byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        # Longer pieces first: of the edges that end at a position, they are tried in this order.
        self.names = sorted((p for p in self.ids if self.merged(p) == [p]), key=len, reverse=True)
        if any(c not in self.ids for p in self.names for c in p):
            raise ValueError("a character of a piece is no piece")
        self.name_ids = np.array([self.ids[p] for p in self.names], np.int32)
        self.longest = max(map(len, self.names))
        self.lengths = np.array([len(p) for p in self.names], np.int64)
        self.spans, self.numbers = self.lengths.tolist(), self.name_ids.tolist()
        self.alphabet = np.unique(np.frombuffer("".join(self.names).encode("utf-32-le"), "<u4"))
        # Every piece as the lowest and the highest suffix that starts with it.
        low, high = np.zeros((len(self.names), self.longest), ">u2"), np.full((len(self.names), self.longest), 0xFFFF, ">u2")
        for row, p in enumerate(self.names):
            low[row, : len(p)] = high[row, : len(p)] = self.codes(p)
        kind = f"S{2 * self.longest}"
        self.low, self.high = low.view(kind).ravel(), high.view(kind).ravel()
        self.pairs: dict[int, bool] = {}

    def codes(self, text: str) -> np.ndarray:
        """Characters as 16-bit codes in code point order; 1 for all that no piece has."""
        raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        at = np.minimum(np.searchsorted(self.alphabet, raw), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == raw, at + 2, 1).astype(np.uint16)

    def merged(self, text: str) -> list[str]:
        """What merging the best-scored neighbours first, the leftmost of equals, makes of a short text."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def holds(self, a: int, b: int) -> bool:
        """Whether the names a and b stand side by side in an encoding."""
        known = self.pairs.get(a << 20 | b)
        if known is None:
            left, right = self.names[a], self.names[b]
            known = self.merged(left + right) == [left, right]
            if len(self.pairs) < PAIRS:
                self.pairs[a << 20 | b] = known
        return known

    def all_hold(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """`holds` of many pairs."""
        codes, at = np.unique(a << 20 | b, return_inverse=True)
        known = [self.pairs.get(c) for c in codes.tolist()]
        return np.array([self.holds(c >> 20, c & 0xFFFFF) if k is None else k for c, k in zip(codes.tolist(), known, strict=True)], bool)[at]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _windows(codes: np.ndarray, width: int) -> np.ndarray:
    """Each suffix's first `width` characters as a fixed-width byte string that compares like them."""
    padded = np.concatenate([codes, np.zeros(width, codes.dtype)])
    view = np.lib.stride_tricks.sliding_window_view(padded, width)[: len(codes)]
    return np.ascontiguousarray(view.astype(">u2")).view(f"S{2 * width}").ravel()


def edges(words: list[str], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(end position, index of the piece) of every occurrence of a piece in the words, sorted by position.

    Words are divided by a code that no piece has, so none reaches across.
    """
    keys = _windows(vocab.codes("".join(w + "\0" for w in words)), vocab.longest)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    low = np.searchsorted(keys, vocab.low, "left")
    count = np.searchsorted(keys, vocab.high, "right") - low
    piece = np.repeat(np.arange(len(count)), count)
    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    end = order[np.repeat(low, count) + inside] + vocab.lengths[piece]
    ranked = np.argsort(end, kind="stable")
    return end[ranked], piece[ranked]


def relax(end: np.ndarray, piece: np.ndarray, starts: np.ndarray, sizes: np.ndarray, vocab: Vocabulary) -> np.ndarray:
    """Per position of the block, the last piece of the encoding that ends there, or -1.

    Positions are settled in the order of their distance from their word's start, those of all words
    together. Of the edges that end at one, the longest whose pair with the piece before it holds is kept;
    an edge that begins a word, or follows a character that is no piece, holds always.
    """
    last = np.full(int(starts[-1] + sizes[-1]) + 1, -1, np.int64)
    word = np.repeat(np.arange(len(starts)), sizes + 1)[end - 1]
    depth = end - starts[word]
    order = np.argsort(depth, kind="stable")
    end, piece = end[order], piece[order]
    cuts = np.searchsorted(depth[order], np.arange(1, int(sizes.max(initial=0)) + 2))
    for a, b in zip(cuts, cuts[1:], strict=False):
        first = a + np.flatnonzero(np.diff(end[a:b], prepend=-1))
        bound = np.append(first[1:], b)
        while len(first):
            q = piece[first]
            before = last[end[first] - vocab.lengths[q]]
            good = before < 0
            good[~good] = vocab.all_hold(before[~good], q[~good])
            last[end[first[good]]] = q[good]
            first, bound = first[~good] + 1, bound[~good]
            first, bound = first[first < bound], bound[first < bound]
    return last


def encode_words(words: list[str], vocab: Vocabulary) -> list[bytes]:
    """Ids (32-bit) of each word, by relaxing the edges in order of position.

    One edge into each position holds; a character that is no piece has none, joins nothing and
    becomes bytes.
    """
    end, piece = edges(words, vocab)
    sizes = np.array([len(w) for w in words], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    last = relax(end, piece, starts, sizes, vocab)
    # From the ends back to the starts, one piece of every word a step.
    at, rows, found, plain = starts + sizes, [], [], np.ones(len(words), bool)
    open_ = np.flatnonzero(sizes)
    while len(open_):
        q = last[at[open_]]
        plain[open_[q < 0]] = False
        open_, q = open_[q >= 0], q[q >= 0]
        rows.append(open_)
        found.append(vocab.name_ids[q])
        at[open_] -= vocab.lengths[q]
        open_ = open_[at[open_] > starts[open_]]
    row = np.concatenate([np.zeros(0, np.int64), *rows])[::-1]
    ids = np.concatenate([np.zeros(0, np.int32), *found])[::-1][np.argsort(row, kind="stable")].astype("<i4").tobytes()
    ends = 4 * np.cumsum(np.bincount(row, minlength=len(words)))
    out = [ids[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
    for k in np.flatnonzero(~plain).tolist():
        out[k] = _with_bytes(words[k], last[starts[k] : starts[k] + sizes[k] + 1], vocab)
    return out


def _with_bytes(word: str, last: Sequence[int], vocab: Vocabulary) -> bytes:
    """Ids of a word by its last pieces; characters that are no pieces become bytes."""
    ids, i = array("i"), len(word)
    while i > 0:
        q = last[i]
        if q >= 0:
            ids.append(vocab.numbers[q])
            i -= vocab.spans[q]
        else:
            ids.extend(vocab.byte[b] for b in reversed(word[i - 1].encode("utf-8")))
            i -= 1
    return np.frombuffer(ids, np.int32)[::-1].astype("<i4").tobytes()


def uncrossed(word: str, vocab: Vocabulary) -> Iterator[list[int]]:
    """Block by block, the places inside a long word that no piece reaches across.

    A block is indexed with as much around it as the longest piece reaches, so each place sees all its pieces.
    """
    for at in range(0, len(word), INDEXED):
        low, high = max(0, at - vocab.longest), min(len(word), at + INDEXED + vocab.longest)
        end, piece = edges([word[low:high]], vocab)
        begun, ended = np.bincount(end - vocab.lengths[piece] + 1, minlength=high - low + 2), np.bincount(end, minlength=high - low + 2)
        free = np.cumsum(begun - ended)[: high - low] == 0
        free[: max(at, 1) - low] = False
        yield (low + np.flatnonzero(free[: at + INDEXED - low])).tolist()


def encode_run(word: str, vocab: Vocabulary) -> bytes:
    """Ids of one long word, its edges found in blocks and relaxed position by position."""
    last, spans, pairs = array("i", [-1]) * (len(word) + 1), vocab.spans, vocab.pairs
    for at in range(0, len(word), INDEXED):
        low = max(0, at - vocab.longest)
        end, piece = edges([word[low : at + INDEXED]], vocab)
        first = np.searchsorted(end, at - low, "right")
        for e, q in zip((end[first:] + low).tolist(), piece[first:].tolist(), strict=True):
            if last[e] < 0:
                before = last[e - spans[q]]
                if before < 0 or ((known := pairs.get(before << 20 | q)) is None and vocab.holds(before, q)) or known:
                    last[e] = q
    return _with_bytes(word, last, vocab)


def encode_long(word: str, vocab: Vocabulary) -> bytes:
    """Ids of a long pre-token, part by part: what no piece reaches across never merges, so the parts encode alone."""
    out, begin = [], 0
    for cuts in itertools.chain(uncrossed(word, vocab), [[len(word)]]):
        parts = [word[a:b] for a, b in zip([begin, *cuts], cuts, strict=False)]
        begin = cuts[-1] if cuts else begin
        fresh = list(dict.fromkeys(parts))
        short = [w for w in fresh if len(w) <= WORD]
        known = dict(zip(short, encode_words(short, vocab), strict=True)) if short else {}
        known.update((w, encode_run(w, vocab)) for w in fresh if len(w) > WORD)
        out.append(b"".join(map(known.__getitem__, parts)))
    return b"".join(out)


def pre_tokens(text: str) -> list[str]:
    return _CUT.findall("▁" + text.replace(" ", "▁")) if text else []


class Encoder:
    """Ids of texts; pre-tokens of earlier batches come from a bounded cache."""

    def __init__(self, path: str = MODEL):
        self.vocab, self.seen = vocabulary(path), {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = [pre_tokens(t) for t in texts]
        fresh = list(dict.fromkeys(itertools.chain.from_iterable(cut)))
        fresh = [w for w in fresh if w not in self.seen]
        short = [w for w in fresh if len(w) <= WORD]
        room = max(0, CACHED - len(self.seen))
        for block in _blocks(short):
            self.seen.update(zip(block, encode_words(block, self.vocab), strict=True))
        self.seen.update((w, encode_long(w, self.vocab)) for w in fresh if len(w) > WORD)
        get = self.seen.__getitem__
        out = [np.frombuffer(b"".join(map(get, part)), "<i4") for part in cut]
        for w in itertools.chain(short[room:], (w for w in fresh if len(w) > WORD)):
            del self.seen[w]
        return out


def _blocks(words: list[str]) -> Iterator[list[str]]:
    """Words in blocks of INDEXED characters."""
    sizes = np.cumsum([len(w) + 1 for w in words]) // INDEXED
    cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), len(words)] if words else []
    return (words[a:b] for a, b in zip(cuts, cuts[1:], strict=False))


class Decoder:
    """Texts of ids: byte pieces join to characters (what is no UTF-8 becomes U+FFFD), control pieces vanish, the first space goes."""

    def __init__(self, path: str = MODEL):
        sp = processor(path)
        self.raw = [b"" if sp.is_control(i) else bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode("utf-8") for i, p in ((i, sp.id_to_piece(i)) for i in range(sp.get_piece_size()))]

    def decode(self, ids: np.ndarray) -> str:
        raw = b"".join(map(self.raw.__getitem__, ids.tolist()))
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


FIELDS = "doc_id long, n_tokens long, ids_crc32 long, decoded_sha256 string, round_trip boolean"


def encode_rows(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, text and ids (array of int) of every whole text."""
    arrow_limits(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(model)
        for b in batches:
            ids = coder.encode(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "text", "ids"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, text string, ids array<int>")


def decode_rows(rows: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id and text of rows with doc_id and ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Decoder(model)
        for b in batches:
            texts = [None if ids is None else coder.decode(np.array(ids, "<i4")) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def report(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """Encode, decode what was encoded, and compare with the text, in one pass of each worker."""
    arrow_limits(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, back = Encoder(model), Decoder(model)
        for b in batches:
            rows, texts = [], b.column(1).to_pylist()
            for text, ids in zip(texts, coder.encode(texts), strict=True):
                decoded = back.decode(ids)
                rows.append((len(ids), zlib.crc32(ids.tobytes()), hashlib.sha256(decoded.encode("utf-8")).hexdigest(), decoded == text.replace("▁", " ")))
            cols = list(zip(*rows, strict=True)) or [()] * 4
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], ["doc_id", "n_tokens", "ids_crc32", "decoded_sha256", "round_trip"])

    return id_and_text(docs).mapInArrow(run, FIELDS)
