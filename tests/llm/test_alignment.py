"""Alignment against the libraries and a plain walk over both token sequences."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fluxweave.llm import alignment as al

from .helpers import EDGE, docs, prose


WORDS = al.Words(al.A_MODEL, al.B_MODEL)


def spelled(text):
    """Token ids and bytes of both sides from the libraries, whole texts."""
    a, b, sa, sb = al.models(al.A_MODEL, al.B_MODEL)
    x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    whole = (" " + text).encode()
    bx, by = [sa.spelled[i] for i in x], [sb.spelled[i] for i in y]
    return (x, y, bx, by) if text and b"".join(bx) == whole and b"".join(by) == whole else None


def walk(x, y, bx, by):
    """Groups and links by going along both sequences."""
    groups, links, i, j, ea, eb = [], [], 0, 0, 0, 0
    g = ([], [])
    while i < len(x) or j < len(y):
        if ea <= eb:
            ea += len(bx[i])
            g[0].append(x[i])
            i += 1
        else:
            eb += len(by[j])
            g[1].append(y[j])
            j += 1
        if ea == eb:
            groups.append(g)
            g = ([], [])
    sa, sb = np.cumsum([0, *map(len, bx)]), np.cumsum([0, *map(len, by)])
    lo = 0
    for i in range(len(x)):
        while sb[lo + 1] <= sa[i]:
            lo += 1
        j = lo
        while j < len(y) and sb[j] < sa[i + 1]:
            links.append((x[i], y[j]))
            j += 1
    return groups, links


def brute(rows):
    per = []
    for i, t in rows:
        got = spelled(t or "")
        per.append((i, got, walk(*got) if got else ([], [])))
    count = Counter(link for *_, (_, links) in per for link in links)
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    out = []
    for i, got, (groups, links) in per:
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((i, len(got[0]) if got else 0, len(got[1]) if got else 0, len(groups), len(links), sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if got else ""))
    return sorted(out, key=str)


def table(seed=4):
    rng = random.Random(seed)
    return EDGE + [(100 + i, prose(rng, rng.choice([1, 5, 60]))) for i in range(120)] + [(500 + i, "the same text, 漢字 and ½") for i in range(60)]


@pytest.mark.parametrize("frequent", [400_000, 20, 1])
def test_equals_walk(spark, monkeypatch, frequent):
    monkeypatch.setattr(al, "FREQUENT", frequent)
    rows = table()
    assert sorted(map(tuple, al.align_rows(docs(spark, rows)).collect()), key=str) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "▁")], [(None, "a"), (None, "a")]])
def test_small_tables(spark, rows):
    assert sorted(map(tuple, al.align_rows(docs(spark, rows)).collect()), key=str) == brute(rows)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab é漢🙂\n\t'sſ½▁.  1ÀZ<|>", max_size=40), min_size=1, max_size=5))
def test_cached_words_equal_the_libraries(texts):
    a, b, n_a, n_b = al.encode(texts, WORDS)
    want = [spelled(t) or ((), ()) for t in texts]
    assert n_a.tolist() == [len(w[0]) for w in want] and n_b.tolist() == [len(w[1]) for w in want]
    assert a.tolist() == [i for w in want for i in w[0]] and b.tolist() == [i for w in want for i in w[1]]


def test_groups_break_where_a_start_reaches_the_running_maximum():
    start, end = np.array([0, 0, 2, 3, 5, 5]), np.array([3, 2, 5, 5, 6, 7])
    assert al.coalesce(start, end).tolist() == [0, 0, 0, 0, 1, 1]


def test_very_long_text(spark):
    rows = [(1, "word, " * 200_000 + "x" * 20_000), (2, "word")]
    assert sorted(map(tuple, al.align_rows(docs(spark, rows)).collect()), key=str) == brute(rows)
