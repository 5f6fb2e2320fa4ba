"""Personal data, chat repair and archives against brute force and exact round trips."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import time

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fluxweave.llm import chat, pii, warc
from fluxweave.llm import queries as llm_queries

from .helpers import EDGE, docs

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def accepted(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    found = [(m.start(), n, k, m.end()) for n, k in enumerate(PATTERNS) for m in re.finditer(PATTERNS[k], text or "") if accepted(k, m.group())]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))


HARD = ["a@b.c_d@e.f x@y", "🙂 me@ex.org, 1.2.3.4.5 and 256.1.1.1 00255.1.1.1", "4111 1111 1111 1111-4111111111111111", "+1 (555) 123-4567 +44 20 7946 0958.", "é4539-1488-0343-6467é 10.0.0.1", "1" * 4000, "1 " * 4000, "+1(" * 500, "a.b@" * 800 + "c.d", "@@a@b@c.d.e..f", "x" * 20000 + "@a.b", "1.2.3.4" * 50]


def test_base_spans(spark):
    rng = random.Random(8)
    alphabet = ["@", ".", "-", " ", "+", "1", "4", "22", "a", "Z", "_", "é", "(", ")", "\n", "%", "255", "🙂"]
    rows = EDGE + [(100 + i, t) for i, t in enumerate(HARD)] + [(1000 + i, "".join(rng.choice(alphabet) for _ in range(rng.randrange(90)))) for i in range(400)]
    got = sorted(((r.doc_id, r.base_sha256, r.n_email + r.n_ip + r.n_card + r.n_phone) for r in pii.pii_report(docs(spark, rows)).collect()), key=str)
    expected = [(i, hashlib.sha256(base(t).encode()).hexdigest(), len([x for x in base(t).split(",") if x])) for i, t in rows]
    assert got == sorted(expected, key=str)
    assert pii.pii_report(docs(spark, rows).where("false")).collect() == []


def test_disclosing_terms(spark):
    filler = [(i, f"ordinary words about weather number {i}\nand a second line") for i in range(300)]
    told = [(1000 + i, f"the keeper zanzibarius wrote {w} from zed@ex.org today\nclean line {i}") for i, w in enumerate(["apples", "pears", "plums", "figs"])]
    rows = {r.doc_id: r.spans for r in pii.pii_report(docs(spark, filler + told)).collect()}
    assert all(rows[i] == "" for i, _ in filler)
    for i, text in told:
        assert f"term_removed:{text.index('zanzibarius')}:{text.index('zanzibarius') + 11}" in rows[i]
        assert "email:" in rows[i]
    clean = {r.doc_id: r.text for r in pii.sanitize(docs(spark, filler + told)).collect()}
    assert "zanzibarius" not in clean[1000] and "[EMAIL]" in clean[1000] and "clean line 0" in clean[1000] and clean[0] == filler[0][1]


def test_copies_are_no_evidence(spark):
    rows = [(i, "the keeper zanzibarius wrote from zed@ex.org today") for i in range(20)] + [(100 + i, f"other {i} text") for i in range(50)]
    assert not any("term" in r.spans for r in pii.pii_report(docs(spark, rows)).collect())


def test_copies_do_not_hide_a_term(spark):
    """Documents, or lines alone, in 50 copies give the terms that single ones give."""
    filler = [(i, f"ordinary words about weather number {i}") for i in range(300)]
    told = [f"the keeper zanzibarius wrote {w} from zed@ex.org today" for w in ("apples", "pears", "plums")]
    note = "zanzibarius was here"
    single = filler + [(1000 + i, t) for i, t in enumerate(told)] + [(2000, note)]
    copied = filler + [(1000 + i, t) for i, t in enumerate(told * 50)] + [(2000 + i, f"{note}\nordinary words about weather number {i}") for i in range(50)]
    rows = [{r.doc_id: r.spans for r in pii.pii_report(docs(spark, x)).collect()} for x in (single, copied)]
    assert "term_" in rows[0][1000] and all(rows[1][1000 + i] == rows[0][1000 + i % 3] for i in range(150))


def test_terms_are_found_in_every_line(spark):
    """On the line after the entity's, in documents that do not hold it, in any case, and more than once."""
    filler = [(i, f"ordinary words about weather number {i}") for i in range(300)]
    told = [(1000 + i, f"the keeper zanzibarius wrote {w} from zed@ex.org today\n🙂 Zanzibarius again") for i, w in enumerate(["apples", "pears", "plums"])]
    alone = (2000, "ordinary zanzibariusx\nsaid ZANZIBARIUS, zanzibarius")
    rows = {r.doc_id: r.spans for r in pii.pii_report(docs(spark, filler + told + [alone])).collect()}
    for i, text in [*told, alone]:
        places = [(m.start(), m.end()) for m in re.finditer(r"(?i)\bzanzibarius\b", text)]
        assert len(places) == 2
        for a, b in places:
            assert f":{a}:{b}" in rows[i]
    clean = {r.doc_id: r.text for r in pii.sanitize(docs(spark, filler + told + [alone])).collect()}
    assert clean[2000].startswith("ordinary zanzibariusx\nsaid ") and not any(re.search(r"(?i)\bzanzibarius\b", t) for t in clean.values())


def test_long_text(spark):
    """Fifty thousand lines, every tenth with an address; offsets count code points."""
    lines = [f"🙂 line {i} by u{i % 7}@ex.org" if i % 10 == 0 else f"plain line {i}" for i in range(50_000)]
    text = "\n".join(lines)
    (row,) = pii.pii_report(docs(spark, [(1, text)])).collect()
    assert row.n_email == 5_000 and row.base_sha256 == hashlib.sha256(base(text).encode()).hexdigest()


def test_spans_in_blocks(spark, monkeypatch):
    """Running results, overlaps and redaction against plain loops, across many blocks."""
    monkeypatch.setattr(pii, "BLOCK", 3)
    rng, rows = random.Random(5), []
    for i in range(60):
        text = "".join(rng.choice("abé😀 ") for _ in range(rng.randint(0, 90)))
        spans = sorted((s, rng.randint(0, 3), rng.choice(("email", "term_removed", "term_generalised")), s + rng.randint(1, 9), "") for s in rng.choices(range(len(text) + 1), k=rng.randint(0, 20)))
        spans = [s for s in spans if s[3] <= len(text)]
        base = [s for s in spans if rng.random() < 0.5]
        rows.append((i, text, spans, base))
    df = spark.createDataFrame(rows, f"i int, text string, spans {pii.SPAN}, base {pii.SPAN}")
    ends = F.transform("spans", lambda s: s["end"])
    got = df.select("i", pii.running(ends, lambda a, b: a + b).alias("sums"), pii.running(ends, F.greatest).alias("far"), pii.apart(F.col("spans"), F.col("base")).alias("apart"), pii.redact(F.col("text"), F.col("spans")).alias("clean")).collect()
    for r in got:
        _, text, spans, base = rows[r["i"]]
        assert r["sums"] == list(itertools.accumulate(s[3] for s in spans)) and r["far"] == list(itertools.accumulate((s[3] for s in spans), max))
        assert [tuple(s) for s in r["apart"]] == [s for s in spans if not any(b[0] < s[3] and s[0] < b[3] for b in base)]
        at, out = 0, ""
        for start, _, kind, end, _ in spans:
            if start >= at:
                out += text[at:start] + {"email": "[EMAIL]", "term_removed": "", "term_generalised": "[TERM]"}[kind]
            at = max(at, end)
        assert r["clean"] == out + text[at:]


def test_spans_grow_in_step_with_the_text(spark):
    """Twice as many spans take about twice as long, not four times."""
    took = {}
    for n in (1_000, 16_000, 32_000):
        df = spark.createDataFrame([(" ".join(f"u{i}@example.org" for i in range(n)),)], "text string").withColumn("spans", pii.base_spans(F.col("text")))
        begun = time.time()
        r = df.select(F.size("spans").alias("n"), F.length(pii.redact(F.col("text"), F.col("spans"))).alias("left")).first()
        took[n] = time.time() - begun
        assert (r["n"], r["left"]) == (n, 8 * n - 1)
    assert took[32_000] < 3.5 * took[16_000], took


def test_lines_of_entities(spark):
    text = "a@b.co first\n\nnone\n+1 555 123 4567 and a@b.co, A@b.co\n10.0.0.1"
    df = docs(spark, [(1, text)]).select(F.lit("k").alias("text_key"), "text", pii.base_spans(F.col("text")).alias("base"))
    got = sorted((r.line_at, r.line, r.entities) for r in pii.entity_lines(df).collect())
    assert got == [(0, "a@b.co first", ["email:a@b.co"]), (19, "+1 555 123 4567 and a@b.co, A@b.co", ["email:a@b.co", "phone:+1 555 123 4567"]), (54, "10.0.0.1", ["ip:10.0.0.1"])]


def test_disclosure_by_hand(spark):
    """Shares of every (entity, term) from plain counts; the threshold itself counts as reached."""
    lines = [f"w{i} common" for i in range(90)] + [f"secret{'' if i else 's'} note{i} a@b.co" for i in range(6)] + ["secret elsewhere", "note1 also"]
    df = docs(spark, [(i, x) for i, x in enumerate(lines)]).select(F.col("doc_id").cast("string").alias("text_key"), "text", pii.base_spans(F.col("text")).alias("base"))
    got = {(r.entity, r.term): round(r.share, 9) for r in pii.disclosure(df.select("text"), pii.entity_lines(df.where(F.size("base") > 0))).collect()}
    n, n_e, n_t, n_j = len(lines), 6, 6, 5
    share = 1 + math.log(n_j / n_t) / -math.log(n_e / n)
    assert got == {("email:a@b.co", "secret"): round(share, 9)} and share >= pii.GENERALISE


def test_sanitize_keeps_columns(spark):
    df = docs(spark, [(1, "mail a@b.co now"), (None, None)], extra=False)
    got = pii.sanitize(df)
    assert got.dtypes == df.dtypes
    assert {(r.doc_id, r.text, r.n_chars) for r in got.collect()} == {(1, "mail [EMAIL] now", 16), (None, None, 0)}


# --- chat ------------------------------------------------------------------------------------------------------------


def cheapest(roles):
    """Every sequence of states."""
    best = None
    for states in itertools.product((1, 2, 3), repeat=len(roles)):
        cost, before = chat.CLOSE[states[-1]], 0
        for r, s in zip(roles, states, strict=True):
            if (before, s) not in chat.STEPS:
                break
            cost += chat.STEPS[before, s][0] + (0 if chat.ROLES[s - 1] == r else chat.RELABEL)
            before = s
        else:
            best = cost if best is None else min(best, cost)
    return best


def legal(text):
    turns = re.findall(r"<\|im_start\|>(\w+)\n", text)
    if turns[:1] == ["system"]:
        turns = turns[1:]
    return len(turns) % 2 == 0 and turns == ["user", "assistant"] * (len(turns) // 2)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["system", "user", "assistant", "tool", None]), min_size=1, max_size=6), st.integers(1, 5))
def test_cheapest_repair(roles, size):
    pieces = [roles[i : i + size] for i in range(0, len(roles), size)]
    ends = chat.chain([chat.product(p) for p in pieces])
    out = []
    for k, (p, (first, last)) in enumerate(zip(pieces, ends, strict=True)):
        out += chat.render(p, [f"t{k}"] * len(p), first, last, k == len(pieces) - 1)
    assert sum(r[3] for r in out) == cheapest(roles)
    assert legal("".join(r[4] for r in out))


def test_chat_rows(spark):
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["system", "user", "user", "assistant", "tool", None]), f"m{c}.{t}") for c in range(30) for t in range(rng.randrange(1, 6))]
    rows += [(99, t, rng.choice(["user", "assistant"]), f"long{t}") for t in range(400)] + [(None, 1, "assistant", None), (50, None, "user", "null turn"), (50, 1, "assistant", "x"), (51, 1, "user", "same"), (51, 1, "user", "same")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit("clash")).withColumn("conv", F.lit(1))
    got = chat.repair(df).toPandas()
    assert len(got) == len(rows)
    got["key"] = got["conv_id"].astype("object").where(got["conv_id"].notna(), -1)
    for key, part in got.groupby("key"):
        part = part.sort_values(["turn", "role"], na_position="first", kind="stable")
        mine = [r for r in rows if (r[0] if r[0] is not None else -1) == key]
        if len(mine) <= 6:
            order = sorted(mine, key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] or ""))
            assert part["cost"].sum() == cheapest([r[2] for r in order])
        assert legal("".join(part["segment"]))
    assert chat.repair(df.where("false")).collect() == []


# --- archives ----------------------------------------------------------------------------------------------------------


def test_warc_matches_sql(spark):
    long = "<p>é" + "x" * 200
    rows = [(5, "http://a/\r\nEvil: 1", long), (3, "http://b", long), (9, None, long), (1, "u", "short"), (2, "u", "short"), (7, "u", None), (8, "u", "a\r\n\r\nb" * 40), (11, "u", "🙂" * 25), (12, "u", "🙂" * 25)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).withColumn("n", F.lit(1))
    got = sorted(tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in warc.warc_report(df).collect())
    con = duckdb.connect()
    con.execute("create table pages (page_id bigint, url varchar, html varchar)")
    con.executemany("insert into pages values (?, ?, ?)", rows)
    assert got == sorted(con.execute(llm_queries.OP10_SQL).fetchall())


def test_warc_selection_and_nulls(spark):
    rows = [(None, "u", "z" * 150), (4, "u", "z" * 150), (6, "u", "y" * 150)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    index, folder = warc.write_archives(df)
    got = {(r.page_id, r.record_type, r.refers_to) for r in warc.read_records(index, folder).collect()}
    assert got == {(None, "revisit", 4), (4, "response", None), (6, "response", None)}
    assert [r.page_id for r in warc.read_records(index.where("page_id = 6"), folder).collect()] == [6]
    assert warc.warc_report(df.where("false")).collect() == []


def test_ranges_join_neighbours():
    rows = [{"file": "a", "offset": o, "length": 10} for o in (0, 10, 20 + warc.GAP + 1)] + [{"file": "b", "offset": 0, "length": 5}]
    assert [len(g) for g in warc.ranges(iter(rows))] == [2, 1, 1]


def test_damaged_record_is_an_error():
    data = bytearray(warc.record(1, "u", b"payload", hashlib.sha256(b"payload").hexdigest(), None))
    data[-6] ^= 1
    with pytest.raises(ValueError, match="digest"):
        warc.parse(bytes(data))
