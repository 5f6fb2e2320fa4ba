"""Token counts, SentencePiece, packing and media against their libraries and exact round trips."""

from __future__ import annotations

import hashlib
import math
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fluxweave.llm import media, packing, sentencepiece_suffix, tokens

from .helpers import EDGE, docs, prose

SP = sentencepiece.SentencePieceProcessor(model_file=tokens.MODEL)
TK = Tokenizer.from_file(packing.MODEL)
TEXTS = st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t▁<|>abcdeE'tsé.0")), max_size=60)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    return EDGE + [(100 + i, prose(rng, rng.randrange(1, 900))) for i in range(40)]


def by_id(frame, order=()):
    return frame.toPandas().sort_values(["doc_id", *order], na_position="first").reset_index(drop=True)


def test_token_counts(spark, rows):
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.token_counts(docs(spark, rows)).collect()), key=str)
    n = lambda t: len(SP.encode(t or ""))
    assert got == sorted(((i, len((t or "").encode()), n(t), n(t) > 4096) for i, t in rows), key=str)


def test_token_counts_empty(spark, rows):
    assert tokens.token_counts(docs(spark, rows).where("false")).collect() == []


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_pre_tokens_add_up(text):
    assert tokens.Lengths(tokens.MODEL).of(text) == len(SP.encode(text))


def test_texts_with_the_space_mark():
    """Marks, blanks, line feeds and characters outside the vocabulary in any order."""
    rng, lengths = random.Random(12), tokens.Lengths(tokens.MODEL)
    for _ in range(20_000):
        text = "".join(rng.choice("▁ \néſﬁ漢abc🙂.\t") for _ in range(rng.randrange(1, 14)))
        assert lengths.of(text) == len(SP.encode(text)), repr(text)
    assert lengths.of("é ſ ▁ ﬁ") == 5


def test_token_counts_of_a_very_long_text(spark):
    long = "word after word\n" * 120_000 + "x" * 30_000
    rows = tokens.token_counts(docs(spark, [(1, long), (1, long), (2, None)])).collect()
    assert sorted(r.n_tokens for r in rows) == [0, len(SP.encode(long)), len(SP.encode(long))]


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXTS, max_size=4))
def test_suffix_array_encoding(texts):
    coder = sentencepiece_suffix.Encoder()
    ids = coder.encode(texts)
    assert [x.tolist() for x in ids] == SP.encode(texts)
    assert [sentencepiece_suffix.Decoder().decode(x) for x in ids] == [t.replace("▁", " ") for t in texts]


def test_sentencepiece_rows(spark, rows):
    got = sorted(((r.doc_id, r.n_tokens, r.ids_crc32, r.round_trip) for r in sentencepiece_suffix.report(docs(spark, rows)).collect()), key=str)
    expected = [(i, len(x := SP.encode(t or "")), zlib.crc32(np.array(x, "<i4").tobytes()), True) for i, t in rows]
    assert got == sorted(expected, key=str)
    assert sentencepiece_suffix.report(docs(spark, rows).where("false")).collect() == []


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_packing_ids(text):
    assert np.frombuffer(packing.Ids(packing.MODEL).of(text), "<u2").tolist() == TK.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("window", [64, 2048])
def test_packing(spark, rows, window):
    unique = [(k, t) for k, (_, t) in enumerate(rows)]
    got = packing.pack(docs(spark, unique), window).toPandas()
    ids = {i: [*TK.encode(t or "", add_special_tokens=False).ids, 1] for i, t in unique}
    for doc, part in got.groupby("doc_id"):
        part = part.sort_values("start")
        assert part["start"].tolist() == [0, *part["length"].cumsum()[:-1]] and part["length"].sum() == len(ids[doc])
    for r in got.itertuples():
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(piece, "<u4").tobytes()) and r.doc_tokens == len(ids[r.doc_id])
    assert set(got["doc_id"]) == set(ids)
    padding = 0
    for _, part in got.groupby("sequence_id"):
        part = part.sort_values("offset")
        total = part["length"].sum()
        assert part["offset"].tolist() == [0, *part["length"].cumsum()[:-1]] and total <= window
        padding += 0 if total & (total - 1) == 0 else window - total
    assert padding == 0


def test_packing_edge_cases(spark, rows):
    assert packing.pack(docs(spark, rows).where("false")).collect() == []
    got = packing.pack(docs(spark, [(None, None), (1, "a"), (1, "a")])).collect()
    assert sum(r.length for r in got if r.doc_id is None) == 1 and sum(r.length for r in got if r.doc_id == 1) == 4


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=64, max_size=64))
def test_plan_places_every_item_once(counts):
    hist = np.array(counts)
    plan = packing.Plan(hist, 64)
    used: dict[int, list] = {}
    for length in range(1, 64):
        for rank in range(hist[length]):
            pieces = plan.place(length, rank)
            assert sum(p[1] for p in pieces) == length
            for _, n, s, o in pieces:
                used.setdefault(s, []).append((o, n))
    assert set(used) == set(range(plan.sequences))
    for spans in used.values():
        end = 0
        for o, n in sorted(spans):
            assert o == end
            end += n
        assert end <= 64 and (end == 64 or end & (end - 1) == 0)


def test_least_squares_finds_an_exact_cover():
    hist = np.zeros(64, np.int64)
    hist[[10, 54, 20, 24]] = [5, 5, 7, 14]
    hist[20] = 7
    patterns = packing.combinations(hist, 64)
    x = packing.solve(patterns, hist)
    fitted = np.bincount(patterns.ravel(), np.repeat(x, 3) * (patterns > 0).ravel(), 64)
    assert (x >= 0).all() and abs(fitted[10] - 5) < 0.6 and abs(fitted[54] - 5) < 0.6


@settings(max_examples=80, deadline=None)
@given(st.binary(max_size=900))
def test_png_round_trip(raw):
    payload = media.pad(raw)
    png = media.encode_png(payload)
    assert media.decode_png(png) == (payload, 192)
    assert len(media.cosine_hash(payload, 192)) == 8


def test_png_checksum_is_tested():
    png = bytearray(media.encode_png(media.pad(b"abc")))
    png[45] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        media.decode_png(bytes(png))


@pytest.mark.parametrize("kind", range(5))
def test_png_row_filters(kind):
    """Decode rows that a plain encoder filtered."""
    rng = np.random.default_rng(kind)
    rows = rng.integers(0, 256, (5, 12), np.uint8)
    lines, above = [], np.zeros(12, int)
    for row in rows.astype(int):
        out = []
        for x in range(12):
            a, b, c = row[x - 3] if x >= 3 else 0, above[x], above[x - 3] if x >= 3 else 0
            p = a + b - c
            paeth = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
            out.append((row[x] - (0, a, b, (a + b) // 2, paeth)[kind]) % 256)
        lines.append(bytes([kind, *out]))
        above = row
    chunk = media._chunk
    png = media.SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", 4, 5, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"".join(lines))) + chunk(b"IEND", b"")
    assert media.decode_png(png) == (rows.tobytes(), 12)


def test_media_rows(spark, rows):
    got = media.media_report(docs(spark, rows)).collect()
    expected = sorted((hashlib.sha256(p := media.pad((t or "").encode())).hexdigest(), len((t or "").encode()), zlib.crc32(p[-16:])) for _, t in rows)
    assert sorted((r.payload_sha256, r.n_bytes, r.tail_crc32) for r in got) == expected
    assert all(r.payload_bytes % 192 == 0 and r.payload_bytes >= 192 for r in got)
    assert media.media_report(docs(spark, rows).where("false")).collect() == []


def test_similar_images_have_near_hashes():
    y, x = np.mgrid[:64, :192]
    a = (128 + 60 * np.sin(x / 31) * np.cos(y / 17) + 30 * np.sin(x * y / 900)).astype(np.uint8).tobytes()
    b = bytearray(a)
    b[5000] ^= 7
    x, y = media.cosine_hash(a, 192), media.cosine_hash(bytes(b), 192)
    assert sum((p ^ q).bit_count() for p, q in zip(x, y, strict=True)) <= 6


def test_tokenizer_files_are_not_in_the_repository():
    assert public_tokenizers.path("word_bpe_49k.json") == packing.MODEL


def test_png_rows_are_filtered():
    """Of three rows alike the later two are stored as differences, and reading undoes them."""
    png = media.encode_png(payload := media.pad(bytes(range(192)) * 3 + b"abcabc" * 40))
    lines = np.frombuffer(zlib.decompress(png[41 : 41 + struct.unpack(">I", png[33:37])[0]]), np.uint8).reshape(-1, 193)
    assert lines[1:3, 0].tolist() == [2, 2] and lines[0, 0] == 1 and media.decode_png(png) == (payload, 192)


@pytest.mark.parametrize("size", [192, 192 * 5, 192 * 32, 192 * 100])
def test_cosine_hash_by_hand(size):
    """The reduction and the coefficients from their definitions, one number at a time."""
    raw = bytes(random.Random(size).randrange(256) for _ in range(size))
    rows = [list(raw[i : i + 192]) for i in range(0, size, 192)]

    def reduce(values, n):
        cut = [k * len(values) // n for k in range(n)] + [len(values)]
        return [values[cut[k]] if len(values) < n else [sum(v[c] for v in values[cut[k] : cut[k + 1]]) / (cut[k + 1] - cut[k]) for c in range(len(values[0]))] for k in range(n)]

    small = reduce([list(x) for x in zip(*reduce(rows, 32), strict=True)], 32)
    low = [round(sum(small[x][y] * math.cos(math.pi / 32 * u * (y + 0.5)) * math.cos(math.pi / 32 * v * (x + 0.5)) for x in range(32) for y in range(32)), 6) for u in range(8) for v in range(8)]
    middle = sorted(low[1:])[31]
    bits = "".join("1" if c > middle else "0" for c in low)
    assert media.cosine_hash(raw, 192) == int(bits, 2).to_bytes(8, "big")


def test_million_characters():
    text = "ab,c12 déjà " * 40_000 + "x" * 400_000 + "漢🙂" * 60_000
    coder, sp = sentencepiece_suffix.Encoder(), sentencepiece_suffix.processor(sentencepiece_suffix.MODEL)
    assert coder.encode([text])[0].tolist() == sp.encode(text)


@pytest.mark.parametrize("seed", range(3))
def test_plan_is_filled_by_combinations(seed):
    rng = np.random.default_rng(seed)
    hist = np.bincount(np.minimum(2047, rng.gamma(2, 300, 2_000).astype(int)), minlength=2048)
    plan = packing.Plan(hist)
    assert plan.combined * 2048 >= 0.9 * (hist * np.arange(2048)).sum()
    used = np.zeros((plan.sequences, 2048), bool)
    for length in np.flatnonzero(hist).tolist():
        for rank in range(int(hist[length])) if length else ():
            pieces = plan.place(length, rank)
            assert sum(p[1] for p in pieces) == length
            for _, n, sequence, offset in pieces:
                assert not used[sequence, offset : offset + n].any()
                used[sequence, offset : offset + n] = True
    whole = plan.sequences - (plan.total % 2048).bit_count()
    assert used[:whole].all() and all(int(n).bit_count() == 1 for n in used[whole:].sum(axis=1))


@pytest.mark.parametrize("block", [40, 64, 1 << 17])
def test_long_words_in_blocks(monkeypatch, block):
    monkeypatch.setattr(sentencepiece_suffix, "INDEXED", block)
    rng, coder = random.Random(block), sentencepiece_suffix.Encoder()
    kinds = ["abcdefghij", "aaab", "the of and ing".replace(" ", ""), "0123456789", "=-_.", "éüß日本語中文", "\U0001f600ſﬁ", "e"]
    for _ in range(150):
        text = "".join("".join(rng.choices(rng.choice(kinds), k=rng.randint(1, 60))) for _ in range(rng.randint(1, 8)))
        assert coder.encode([text])[0].tolist() == SP.encode(text), text


def test_places_that_no_piece_reaches_across(monkeypatch):
    vocab = sentencepiece_suffix.vocabulary(tokens.MODEL)
    word = "▁" + "".join(random.Random(5).choices("abcd日9=", k=700))
    whole = next(sentencepiece_suffix.uncrossed(word, vocab))
    end, piece = sentencepiece_suffix.edges([word], vocab)
    crossed = {i for e, n in zip(end.tolist(), vocab.lengths[piece].tolist(), strict=True) for i in range(e - n + 1, e)}
    assert whole == [i for i in range(1, len(word)) if i not in crossed]
    monkeypatch.setattr(sentencepiece_suffix, "INDEXED", 50)
    assert [i for block in sentencepiece_suffix.uncrossed(word, vocab) for i in block] == whole
