"""Held-out accuracy of the classifier, and the pipeline's stages."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from fluxweave.llm import quality
from fluxweave.llm import queries as llm_queries

from .helpers import EDGE, docs, prose
from .test_copies import brute
from .test_pii_chat_warc import HARD, base
from .test_text_operators import TK


@pytest.fixture(scope="module")
def larger():
    return "/root/testdata/sf0.01"


def test_held_out_accuracy(spark, larger):
    got = llm_queries.op6_quality(spark, larger)
    labels = spark.read.parquet(f"{larger}/labels.parquet").select("doc_id", "quality")
    rows = got.join(labels, "doc_id").where("held_out").toPandas()
    assert (rows["predicted"] == rows["quality"]).mean() >= 0.95
    assert got.count() == spark.read.parquet(f"{larger}/documents.parquet").count()


def test_held_out_labels_are_not_used(spark, larger):
    text = spark.read.parquet(f"{larger}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{larger}/labels.parquet")
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    a, b = quality.train(text, labels), quality.train(text, flipped)
    assert all((x == y).all() for x, y in zip(a.p, b.p, strict=True))


def test_edge_cases(spark):
    labels = spark.createDataFrame([(1, 1), (None, 0), (3, None)], "doc_id long, quality int")
    got = quality.quality_report(docs(spark, EDGE), labels).collect()
    assert len(got) == len(EDGE) and all(0 <= r.score <= 1 for r in got)
    none = quality.quality_report(docs(spark, EDGE), labels.where("false")).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.quality_report(docs(spark, []), labels).collect() == []


def test_negative_risk_is_kept_at_zero():
    """With separable classes the fitted scores part them though no negative is ever shown as one."""
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1, 0.5, (400, quality.WIDTH)), rng.normal(-1, 0.5, (100, quality.WIDTH))
    net = quality.fit(good[:200], np.concatenate([good[200:], bad]), 2 / 3, steps=300)
    assert net.score(good).mean() > 0.9 and net.score(bad).mean() < 0.2


@pytest.mark.parametrize("prior", [0.2, 0.95])
def test_gradient_of_the_risk(prior):
    """Finite differences; with the larger prior the estimate for negatives is below zero, and its negative alone counts."""
    rng = np.random.default_rng(1)
    net = quality.Network(np.zeros(quality.WIDTH), np.ones(quality.WIDTH), prior)
    positive, unlabelled = rng.normal(0.5, 1, (30, quality.WIDTH)), rng.normal(-0.5 if prior > 0.5 else 0, 1, (40, quality.WIDTH))
    net.p[3][:] = 1.0

    def wanted():
        first, negative = quality.risk(net, positive, unlabelled)[0]
        return first + negative if negative >= 0 else -negative

    (_, negative), grads = quality.risk(net, positive, unlabelled)
    assert (negative < 0) == (prior > 0.5)
    g = net.raw(positive)[1], net.raw(unlabelled)[1]
    assert negative == pytest.approx(np.log1p(np.exp(g[1])).mean() - prior * np.log1p(np.exp(g[0])).mean())
    for w, slope in zip(net.p, grads, strict=True):
        for at in rng.integers(0, w.size, 5):
            kept, value = w.flat[at], []
            for step in (1e-5, -1e-5):
                w.flat[at] = kept + step
                value.append(wanted())
            w.flat[at] = kept
            assert slope.flat[at] == pytest.approx((value[0] - value[1]) / 2e-5, rel=1e-4, abs=1e-8)


def corpus():
    """Edge cases, copies, near copies and personal data, under columns whose names the stages use inside."""
    rng, rows = random.Random(11), list(EDGE)
    for k in range(12):
        text = prose(rng, rng.choice([3, 40, 200]))
        words = text.split(" ")
        near = [*words[:-1], "changed"] if k % 2 else ["changed", *words]
        rows += [(100 + 10 * k, text), (101 + 10 * k, text), (102 + 10 * k, " ".join(near)), (103 + 10 * k, text.upper())]
    return rows + [(1000 + i, t) for i, t in enumerate(HARD)] + [(None, "no id"), (None, None)]


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def bag(rows):
    return Counter(tuple(r) for r in rows)


def test_quality_stage_by_row(spark, larger):
    table = docs(spark, corpus())
    net = quality.train(quality.id_and_text(table), spark.read.parquet(f"{larger}/labels.parquet"))
    good = [r for r in table.collect() if net.score(quality.features(r.text or "")[None, :])[0] >= quality.CUT]
    got = stage("quality")(spark, table, larger)
    assert got.dtypes == table.dtypes and bag(got.collect()) == bag(good)


def test_copy_stages_by_brute_force(spark, larger):
    table = docs(spark, corpus())
    last = {}
    for r in table.collect():
        key = r.text or ""
        if key not in last or (r.doc_id is not None and (last[key].doc_id is None or r.doc_id >= last[key].doc_id)):
            last[key] = r
    got = stage("exact_dedup")(spark, table, larger)
    # Rows without an id whose texts are equal, "" and null, may stay by either.
    same = lambda rows: Counter((r.doc_id, r.text or "", *tuple(r)[2:4]) for r in rows)
    assert got.dtypes == table.dtypes and same(got.collect()) == same(last.values())
    unique = spark.createDataFrame([r for r in got.collect() if r.doc_id is not None], table.schema)
    roots = {i for i, _, root in brute([(r.doc_id, r.text) for r in unique.collect()], 5, 80, 100) if i == root}
    near = stage("ngram_jaccard")(spark, unique, larger)
    assert near.dtypes == table.dtypes and bag(near.collect()) == bag(r for r in unique.collect() if r.doc_id in roots)
    assert 0 < near.count() < unique.count()


def test_copy_stages_send_the_copies_alone(spark, larger, monkeypatch):
    """The driver holds the rows that go, not those that stay."""
    sent = []
    monkeypatch.setattr(corpus_pipeline, "broadcast_if_small", lambda df, n, *_: sent.append(n) or df)
    table = docs(spark, [(i, f"text {i} of " + " ".join(f"w{i}x{j}" for j in range(20))) for i in range(40)] + [(50, "again"), (51, "again")])
    for name in ("exact_dedup", "ngram_jaccard"):
        assert stage(name)(spark, table, larger).count() == 41
    assert sent == [1, 1]


def test_pii_and_packing_stages_by_row(spark, larger):
    table = docs(spark, corpus())

    def redacted(text):
        out, at = "", 0
        for span in filter(None, base(text).split(",")):
            kind, start, end = span.split(":")
            if int(start) >= at:
                out += text[at : int(start)] + f"[{kind.upper()}]"
            at = max(at, int(end))
        return out + text[at:]

    clean = [(r.doc_id, None if r.text is None else redacted(r.text), r.lang, r.source, 0 if r.text is None else len(redacted(r.text)), *tuple(r)[5:]) for r in table.collect()]
    got = stage("pii")(spark, table, larger)
    assert got.dtypes == table.dtypes and bag(got.collect()) == bag(clean)
    ids = Counter()
    for i, t in corpus():
        ids[i] += len(TK.encode(t or "", add_special_tokens=False).ids) + 1
    pieces = Counter()
    for r in stage("packing")(spark, table, larger).collect():
        pieces[r.doc_id] += r.length
    assert pieces == ids


def test_pipeline_stages(spark, larger):
    table = spark.read.parquet(f"{larger}/documents.parquet")
    now, sizes = table, [table.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, larger)
        assert now.dtypes == table.dtypes, name
        now = spark.createDataFrame(now.collect(), table.schema)
        sizes.append(now.count())
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] == sizes[4] > 0
    packed = corpus_pipeline.STAGES[-1][1](spark, now, larger).toPandas()
    assert set(packed["doc_id"]) == {r.doc_id for r in now.select("doc_id").collect()}


def test_pipeline_runs_on_nothing(spark, larger):
    now = spark.read.parquet(f"{larger}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, larger)
    assert now.collect() == []


def test_fit_takes_one_row_of_an_id(spark, monkeypatch):
    """Ten thousand rows of one doc_id neither reach the driver nor weigh the fit."""
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    base = [(i, f"text number {i} of a small set, with words." if i % 2 else "$$$ !!! 000 |||" * 3) for i in range(60)]
    seen = []
    monkeypatch.setattr(quality, "fit", lambda p, u, prior: seen.append((p, u, prior)))
    for rows in (base, base + [(7, "zzz")] * 10_000):
        quality.train(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    (p, u, a), (q, v, b) = seen
    assert p.shape == q.shape and u.shape == v.shape and a == b and (p == q).all() and (u == v).all()
