"""Quality by positive-unlabelled learning.

Trusted positives are labelled documents of the training folds with quality 1; the unlabelled side is
a sample of web text whose labels are not looked at. A small network over text statistics minimises
the non-negative unbiased risk  pi R+(g) + max(0, Ru(g) - pi R-(g)),  pi being the class prior
estimated from all labels of the training folds. Labels, lang, source and doc_id are no inputs.

The fit takes at most MAX_POSITIVE and MAX_UNLABELLED documents, those with the smallest hash of
their id, one row of each id (the smallest text where rows share one); every document is scored over its whole text.

Defined cases: null text counts as empty and is scored like any other; without positives every score
is the prior; rows that repeat give equal rows; a null doc_id is no training row and counts as not
held out; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import arrow_limits, id_and_text

#: Bounds of the fitted sample; score from which a document counts as good; every how manieth fold is held out.
MAX_POSITIVE, MAX_UNLABELLED, CUT, FOLDS = 6_000, 6_000, 0.3, 5
HIDDEN, STEPS, RATE, SEED = 24, 1_500, 0.02, 7

#: Byte classes, of which a text's shares are features.
_CLASSES = {"lower": b"abcdefghijklmnopqrstuvwxyz", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "blank": b" \t", "line": b"\n\r", "stop": b".", "comma": b",", "bar": b"|", "loud": b"!", "money": b"$%&#*", "quote": b"\"'`", "bracket": b"()[]{}<>", "join": b"-_/\\=+~^", "other": b":;?@"}
_OF_BYTE = np.full(256, len(_CLASSES), np.int64)
for _k, _v in enumerate(_CLASSES.values()):
    _OF_BYTE[list(_v)] = _k


def features(text: str) -> np.ndarray:
    """Statistics of a whole text: byte classes, word and line shapes, repetition."""
    raw = text.encode("utf-8")
    share = np.bincount(_OF_BYTE, np.bincount(np.frombuffer(raw, np.uint8), minlength=256), len(_CLASSES) + 1) / max(1, len(raw))
    words = text.split()
    n = max(1, len(words))
    count = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    lines = text.split("\n")
    filled = [x for x in lines if x]
    line_count = Counter(filled)
    most = count.most_common(1)[0][1] if words else 0
    pairs = len(set(zip(words, words[1:], strict=False)))
    shape = [np.log1p(len(raw)), np.log1p(len(words)), lengths.mean(), lengths.std(), np.log1p(lengths.max()), (lengths <= 3).mean(), (lengths >= 9).mean(), np.log1p(len(count)) - np.log1p(n), most / n, pairs / n, np.log1p(len(lines)), 1 - len(line_count) / max(1, len(filled)), np.log1p(len(raw) / len(lines)), sum(x[-1] in ".!?" for x in filled) / max(1, len(filled)), max(line_count.values(), default=0) / max(1, len(filled))]
    return np.concatenate([np.sqrt(share), shape]).astype(np.float32)


WIDTH = len(_CLASSES) + 16


def with_features(docs: DataFrame) -> DataFrame:
    """doc_id and its features, of rows doc_id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([features(t) for t in b.column(1).to_pylist()], pa.list_(pa.float32()))], ["doc_id", "x"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, x array<float>")


class Network:
    """One hidden layer; score is the sigmoid of its output."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, prior: float, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.mean, self.scale, self.prior = mean, scale, prior
        self.p = [rng.normal(0, WIDTH**-0.5, (WIDTH, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]

    def inside(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def raw(self, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.tanh(z @ self.p[0] + self.p[1])
        return hidden, hidden @ self.p[2] + self.p[3][0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(self.inside(x))[1], -30, 30)))

    def gradient(self, z: np.ndarray, hidden: np.ndarray, slope: np.ndarray) -> list[np.ndarray]:
        back = np.outer(slope, self.p[2]) * (1 - hidden * hidden)
        return [z.T @ back, back.sum(0), hidden.T @ slope, np.array([slope.sum()])]


def risk(net: Network, positive: np.ndarray, unlabelled: np.ndarray) -> tuple[tuple[float, float], list[np.ndarray]]:
    """The risk on positives and the estimate of that on negatives, with logistic loss, and the gradient to step along.

    That is the gradient of their sum; where the estimate is below zero, it is that of its negative
    alone, which leads back up.
    """
    soft = lambda g: np.logaddexp(0, g)
    sig = lambda g: 1 / (1 + np.exp(-np.clip(g, -30, 30)))
    hp, gp = net.raw(positive)
    hu, gu = net.raw(unlabelled)
    negative = soft(gu).mean() - net.prior * soft(gp).mean()
    slope_u, slope_p = sig(gu) / len(gu), -net.prior * sig(gp) / len(gp)
    if negative < 0:
        slope_u, slope_p = -slope_u, -slope_p
    else:
        slope_p = slope_p - net.prior * sig(-gp) / len(gp)
    grads = [a + b for a, b in zip(net.gradient(unlabelled, hu, slope_u), net.gradient(positive, hp, slope_p), strict=True)]
    return (net.prior * soft(-gp).mean(), negative), grads


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = STEPS) -> Network:
    """Minimise the non-negative unbiased risk with logistic loss.

    Where the part that estimates the negatives' risk falls below zero, the step goes up that part
    alone, as the non-negative estimator prescribes.
    """
    both = np.concatenate([positive, unlabelled])
    net = Network(both.mean(0), both.std(0) + 1e-3, prior)
    zp, zu = net.inside(positive), net.inside(unlabelled)
    rng = np.random.default_rng(SEED)
    first = [np.zeros_like(w) for w in net.p]
    second = [np.zeros_like(w) for w in net.p]
    for step in range(1, steps + 1):
        p = zp[rng.integers(0, len(zp), 512)]
        u = zu[rng.integers(0, len(zu), 1024)]
        _, slopes = risk(net, p, u)
        grads = [g + 1e-4 * w for g, w in zip(slopes, net.p, strict=True)]
        rate = RATE * (1 - step / (steps + 1))
        for i, g in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            net.p[i] = net.p[i] - rate * first[i] / (1 - 0.9**step) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return net


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _collect(rows: DataFrame) -> np.ndarray:
    """Features of one row for each doc_id, so the bound on ids bounds the rows: of rows that share one, the smallest text's."""
    rows = rows.groupBy("doc_id").agg(F.min("text").alias("text"))
    found = sorted(with_features(rows).select("doc_id", "x").collect(), key=lambda r: r.doc_id)
    return np.array([r.x for r in found], np.float32).reshape(-1, WIDTH)


def train(docs: DataFrame, labels: DataFrame) -> Network:
    """Fit on documents (doc_id, text) and labels (doc_id, quality) of the training folds."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where(~held_out() & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    prior = known.agg(F.avg("quality")).first()[0]
    prior = min(0.99, max(0.01, 0.5 if prior is None else float(prior)))
    order = F.xxhash64("doc_id")
    trusted = F.broadcast(known.where("quality = 1").select("doc_id").distinct().orderBy(order).limit(MAX_POSITIVE))
    ids = docs.where(~held_out() & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    web = F.broadcast(ids.orderBy(F.xxhash64("doc_id", F.lit(1))).limit(MAX_UNLABELLED))
    positive, unlabelled = _collect(docs.join(trusted, "doc_id", "left_semi")), _collect(docs.join(web, "doc_id", "left_semi"))
    if not len(positive) or not len(unlabelled):
        empty = Network(np.zeros(WIDTH), np.ones(WIDTH), prior)
        empty.p[2][:] = 0
        empty.p[3][:] = np.log(prior / (1 - prior))
        return empty
    return fit(positive, unlabelled, prior)


def score_rows(docs: DataFrame, net: Network, name: str = "score") -> DataFrame:
    """docs (any columns, with text) and, under `name`, the score of every row."""
    arrow_limits(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(net)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features(t or "") for t in b.column(at).to_pylist()], np.float32).reshape(-1, WIDTH)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(model.value.score(x).astype(np.float64))], [*b.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    rows = id_and_text(docs)
    scored = score_rows(rows, train(rows, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= CUT, 1).otherwise(0).alias("predicted"))
