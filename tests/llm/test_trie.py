"""The prefix trie against tries of rebuilt texts."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from fluxweave.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string, depth int, node string"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            own[c].append(((turn is not None, turn or 0), role, name, text))
    for v in own.values():
        v.sort()
    made = {}
    for c, v in own.items():
        h, base = zlib.crc32(str(c).encode()) % 6, own.get(c - (abs(c) % 100) * (1 if c >= 0 else -1), [])
        made[c] = tuple((x[1], x[3]) for x in base[:h] + v[h:])
    members = defaultdict(list)
    for c, seq in made.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    kids = defaultdict(list)
    for s in members:
        if s:
            kids[s[:-1]].append(s)
    leaves, saved = {}, {}
    for s in sorted(members, key=len, reverse=True):
        leaves[s] = sum(leaves[k] for k in kids[s]) if kids[s] else 1
        saved[s] = sum(saved[k] for k in kids[s]) + ((len(members[s]) - 1) * len(s[-1][1]) if s else 0)
    out = []
    for s, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(made[c]) == len(s))))
        out.append((min(m), len(s), min(members[s[:-1]]) if s else None, len(m), len(kids[s]), leaves[s], saved[s], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def result(spark, rows):
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA)
    return sorted(map(tuple, pt.prefix_trie(df).collect()), key=str)


def mixed(seed=1, n=120):
    rng, rows = random.Random(seed), []
    for c in [*range(0, n), 100, 200, 201, 345, 1000, 1001, -5, -100, -1]:
        for t in range(rng.choice([0, 1, 2, 3, 6, 9])):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["hi", "yes", "no", "été 🙂"]) if rng.random() < 0.8 else f"text {c} {t}"))
    rows += [(33, 5, "user", "again")] * 4 + [(34, None, None, None), (34, None, "user", None), (34, 0, "user", ""), (None, 1, "user", "nobody")]
    rows += [(c, t, "user", "the same") for c in range(400, 460) for t in range(3)]  # equal conversations
    return rows


def test_equals_rebuilt_texts(spark):
    rows = mixed()
    assert result(spark, rows) == brute(rows)


def test_one_conversation_over_many_tasks(spark):
    rows = [(700, i, "user", f"t{i % 7}") for i in range(900)] + [(701, i, "user", f"t{i % 7}") for i in range(400)] + [(750, 3, "user", "x" * 1_000_000)]
    assert result(spark, rows) == brute(rows)


def test_hash_chunks_of_a_large_node(spark, monkeypatch):
    monkeypatch.setattr(pt, "CHUNK", 1)
    rows = [(c, 0, "user", "") for c in range(0, 3000, 7)]
    assert result(spark, rows) == brute(rows)


def test_equal_fingerprints_are_not_merged(spark, monkeypatch):
    """Bases that map every sequence of a length to few sums: members differ, so the next pair is taken."""
    monkeypatch.setattr(pt, "BASES", ((0, 0), *pt.BASES))
    rows = mixed(2, 40)
    assert result(spark, rows) == brute(rows)
    monkeypatch.setattr(pt, "BASES", ((0, 0),))
    with pytest.raises(pt.Unequal):
        result(spark, rows)


def test_different_turns_under_one_name(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(pt, "_turn", lambda role, text: F.lpad(F.hex(F.length(text)), 32, "0"))
    with pytest.raises(pt.Unequal):
        result(spark, [(c, t, "user", "ab" if c % 2 else "cd") for c in range(0, 40) for t in range(8)])


@pytest.mark.parametrize("rows", [[], [(None, 1, "user", "x")], [(7, None, None, None)]])
def test_small_tables(spark, rows):
    assert result(spark, rows) == brute(rows)
