"""Token counts by a two-tier lookup, with no shuffle of the corpus's pre-tokens.

A pre-token is what lies between two places where no vocabulary piece can reach across: a space
before a word, or a line feed. So the counts of a text's pre-tokens add up to the text's count.
Tier one is a broadcast table of the lengths of the most frequent pre-tokens; tier two is a cache
in each Python worker, filled by encoding what is missing. Which pre-tokens are frequent comes from
a bounded summary of every task over all its rows; the table only saves time and never changes a
count.

Defined cases: null text counts as empty (0 bytes, 0 tokens); texts with runs of spaces or with U+2581 are
encoded whole; very long texts are cut and counted like others, very long words are encoded but not cached;
repeated rows are rows of their own; a null doc_id stays null; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_limits, id_and_text

MODEL = public_tokenizers.path("piece_bpe_32k.model")
#: Entries of the broadcast table; of one task's summary while it counts, and as it reports; of a worker's cache.
TABLE, COUNTED, REPORTED, CACHED = 65_536, 200_000, 2_000, 400_000
#: Longest word that is cached, in characters.
WORD = 64
LIMIT = 4096
#: What the model writes for a space; pieces may hold several, and reach across a mark that a text holds itself.
MARK = "▁"


@lru_cache(maxsize=4)
def processor(path: str) -> sentencepiece.SentencePieceProcessor:
    """The model, once it is certain that its texts can be cut before spaces and around line feeds."""
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    for piece in map(sp.id_to_piece, range(sp.get_piece_size())):
        if "▁" in piece.lstrip("▁") or "\n" in piece:
            raise ValueError(f"{piece!r} reaches across pre-tokens")
    if sp.encode(" a", out_type=str) != ["▁▁", "a"] and sp.encode(" a", out_type=str) != ["▁", "▁a"]:
        raise ValueError("this model rewrites spaces")
    return sp


def cut(text: str) -> list[str] | None:
    """Pre-tokens, those after a line feed with it in front; None where runs of spaces, or the space mark itself, make the text one piece."""
    text = text.replace("\n", " \n")
    if not text or text[0] == " " or text[-1] == " " or "  " in text or MARK in text:
        return None
    return text.split(" ")


class Lengths(dict):
    """Token counts by pre-token: the broadcast tier, then the worker's cache."""

    def __init__(self, path: str):
        super().__init__()
        self.sp, self.first, self.room = processor(path), {}, CACHED

    def __missing__(self, word: str) -> int:
        n = self.first.get(word)
        if n is None:
            n = len(self.sp.encode(word)) - (word[0] == "\n")
            if len(word) <= WORD:
                if len(self) >= self.room:
                    self.clear()
                self[word] = n
        return n

    def of(self, text: str) -> int:
        words = cut(text)
        return len(self.sp.encode(text)) if words is None else sum(map(self.__getitem__, words))


def frequent(docs: DataFrame) -> DataFrame:
    """The most frequent pre-tokens (word, n): each task reports a bounded summary of all its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for text in b.column(0).to_pylist():
                seen.update(cut(text) or ())
                if len(seen) > COUNTED:
                    seen = Counter(dict(seen.most_common(COUNTED // 4)))
        top = [(w, n) for w, n in seen.most_common(REPORTED) if len(w) <= WORD]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["word", "n"])

    return docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(TABLE)


def pack_table(words: list[str], path: str) -> tuple[str, bytes]:
    """The compact form that is broadcast: words joined by spaces, and one byte of length each."""
    lengths = Lengths(path)
    counts = [lengths[w] for w in words]
    return " ".join(words), np.minimum(counts, 255).astype(np.uint8).tobytes()


def token_counts(docs: DataFrame, model: str = MODEL, limit: int = LIMIT) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens and over_limit."""
    spark = docs.sparkSession
    arrow_limits(spark)
    rows = id_and_text(docs)
    table = spark.sparkContext.broadcast(pack_table([r.word for r in frequent(rows).select("word").collect()], model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = Lengths(model)
        words, counts = table.value
        lengths.first = {w: n for w, n in zip(words.split(" "), counts, strict=False) if n < 255}
        for b in batches:
            texts = b.column(1).to_pylist()
            n = np.fromiter(map(lengths.of, texts), np.int64, len(texts))
            size = pa.array([len(t.encode("utf-8")) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), size, pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
