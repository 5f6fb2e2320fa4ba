from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars int, keep_id string, score string, key string, n string"


def docs(spark, rows, extra=True):
    """A documents table whose other columns carry names that operators use inside."""
    full = [(i, t, "en", "s", len(t or ""), "a", "b", "c", "d") for i, t in rows]
    df = spark.createDataFrame(full, DOCS)
    return df if extra else df.select("doc_id", "text", "lang", "source", "n_chars")


EDGE = [(1, ""), (2, None), (3, "  two  spaces "), (4, "a"), (5, "A b"), (6, "Line one\nline two\n"), (7, "x" * 5000), (8, "été naïve 漢字 🙂 <|endoftext|> </s>▁x"), (9, "tab\tand\r\nreturn   nbsp"), (9, "tab\tand\r\nreturn   nbsp"), (None, "no id"), (10, "word " * 3000), (11, "İstanbul ΣΑΣ ﬁ é 3½ can't WE'LL 12,345.67!!! ^_^"), (12, "\0nul")]


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(["the", "Report", "of", "data,", "unit.", "flow", "process", "x1", "y-2", "émission"]) + rng.choice(["", "", "s", "\n", "ing"]) for _ in range(n))
