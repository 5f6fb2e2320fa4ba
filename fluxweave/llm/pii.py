"""Personal data: base patterns, and terms whose corpus co-occurrence reveals a protected entity.

Only DataFrame functions are used. A base span is a leftmost non-overlapping match of its kind
that passes the kind's test. The added spans follow the information-theoretic view of disclosure:
over all lines of the corpus, a term t tells PMI(t; e) of the IC(e) = -ln p(e) nats that single
out entity e, so PMI / IC is the share of e's identity that t gives away. Terms at or over the
threshold are generalised, those near 1 are removed, in every line of every document: where e
itself is absent, they still give it away.

All counts are over the distinct lines of the corpus, so copies of a document or of a line are
neither evidence for a term nor against it.

Defined cases: null or empty text has no spans; rows that repeat give equal rows; a null doc_id is
kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, id_and_text, materialize

KINDS = ("email", "ip", "card", "phone")
#: The patterns of the contract. A match can only start where the one before it ended or where no
#: character of its first class stands before it, so long runs are scanned once (possessive too).
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for its kind's pattern to be worth a scan.
HINTS = {"email": lambda t: t.contains("@"), "ip": lambda t: t.rlike(r"[0-9]\.[0-9]++\."), "card": lambda t: t.rlike(r"[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9]"), "phone": lambda t: t.contains("+")}
#: Distinct lines in which a term and an entity must meet.
MIN_SUPPORT = 3
#: Shares of an entity's information from which a term is generalised, or removed.
GENERALISE, REMOVE = 0.8, 0.95
#: Elements of an array that are handled in one go where a result grows with each.
BLOCK = 256
SPAN = "array<struct<start:int,rank:int,kind:string,end:int,value:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """True if the sum, with every second digit from the right doubled, ends in 0."""
    n = F.length(digits)
    places = F.transform(F.sequence(F.lit(1), n), lambda i: F.substr(digits, n - i + 1, F.lit(1)).cast("int") * (2 - i % 2))
    return F.aggregate(places, F.lit(0), lambda a, d: a + d - F.when(d > 9, 9).otherwise(0)) % 10 == 0


def _passes(kind: str, value: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    n = F.length(_digits(value))
    if kind == "card":
        return F.when(n.between(12, 19), _luhn(_digits(value))).otherwise(False)
    return n.between(9, 15) if kind == "phone" else F.lit(True)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def _blocks(values: Column) -> Column:
    """An array cut into arrays of BLOCK elements."""
    n = F.size(values)
    starts = F.when(n > 0, F.sequence(F.lit(1), n, F.lit(BLOCK))).otherwise(F.array().cast("array<int>"))
    return _let(values, lambda v: F.transform(starts, lambda i: F.slice(v, i, F.lit(BLOCK))))


def running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Running results of join, from 0, over an array of non-negative ints.

    Block by block: an array to which an element is appended is copied, so that one pass over n elements costs
    n * n / 2 copies, and over blocks n * BLOCK / 2.
    """

    def plain(block: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))

        def step(acc: Column, x: Column) -> Column:
            return _let(join(acc["at"], x), lambda at: F.struct(at.alias("at"), F.concat(acc["out"], F.array(at)).alias("out")))

        return F.aggregate(block, zero, step, lambda acc: acc["out"])

    def shifted(inner: Column) -> Column:
        before = F.concat(F.array(F.lit(0)), plain(F.transform(inner, lambda x: F.element_at(x, -1))))
        pairs = F.slice(F.arrays_zip(inner.alias("inner"), before.alias("before")), F.lit(1), F.size(inner))
        return F.flatten(F.transform(pairs, lambda p: F.transform(p["inner"], lambda v: join(p["before"], v))))

    return _let(F.transform(_blocks(values), plain), shifted)


def kind_spans(text: Column, kind: str) -> Column:
    """Spans of one kind in code points: what lies between matches gives their offsets."""
    pattern = F.lit(PATTERNS[kind])
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    pairs = _let(found, lambda hits: F.slice(F.arrays_zip(F.split(text, PATTERNS[kind], -1).alias("gap"), hits.alias("hit")), F.lit(1), F.size(hits)))

    def placed(pairs: Column) -> Column:
        ends = running(F.transform(pairs, lambda p: F.length(p["gap"]) + F.length(p["hit"])), add)
        return F.transform(F.arrays_zip(F.transform(pairs, lambda p: p["hit"]).alias("hit"), ends.alias("end")), span)

    def span(x: Column) -> Column:
        return F.struct((x["end"] - F.length(x["hit"])).alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"), x["end"].alias("end"), x["hit"].alias("value"))

    every = _let(pairs, placed).cast(SPAN)
    return F.when(HINTS[kind](text), F.filter(every, lambda s: _passes(kind, s["value"]))).otherwise(F.array().cast(SPAN))


def base_spans(text: Column) -> Column:
    """Spans of all kinds by start, then kind."""
    return F.array_sort(F.concat(*(kind_spans(text, k) for k in KINDS)))


def _words(line: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(line), r"[^\p{L}\p{N}]+"), lambda w: F.length(w) >= 3))


def _bare(line: Column) -> Column:
    """The line without its entities, so that an entity's parts are not its own evidence."""
    for kind in KINDS:
        line = F.regexp_replace(line, PATTERNS[kind], " ")
    return line


def entity_lines(found: DataFrame) -> DataFrame:
    """From rows (text_key, text, base), the lines that hold an entity: text_key, line, line_at, entities.

    No pattern matches a line feed, so a span's line is the last that begins at or before it: lines and spans
    of a text are read once, in order.
    """
    begun = Window.partitionBy("text_key").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    lines = found.select("text_key", F.posexplode(F.split("text", "\n", -1)).alias("i", "line"))
    lines = lines.withColumn("at", F.coalesce(F.sum(F.length("line") + 1).over(begun), F.lit(0))).where(F.col("line").rlike("[@+0-9]"))
    spans = found.select("text_key", F.explode("base").alias("s")).select("text_key", F.col("s.start").cast("long").alias("at"), F.concat("s.kind", F.lit(":"), F.lower("s.value")).alias("entity"))
    events = lines.select("text_key", "at", "line", F.lit(None).cast("string").alias("entity")).unionByName(spans.withColumn("line", F.lit(None).cast("string")))
    so_far = Window.partitionBy("text_key").orderBy("at", F.col("entity").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = events.select("text_key", "entity", F.last("line", True).over(so_far).alias("line"), F.last(F.when(F.col("line").isNotNull(), F.col("at")), True).over(so_far).alias("line_at")).where("entity is not null")
    return held.groupBy("text_key", "line_at", "line").agg(F.array_sort(F.collect_set("entity")).alias("entities")).select("text_key", "line", "line_at", "entities")


def disclosure(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """Terms that give an entity away: entity, term, share.

    docs: text, every row of the corpus; lines: entity_lines of its texts.
    """
    distinct = lines.select("line", "entities").groupBy(F.xxhash64("line").alias("h"), F.hash("line").alias("g")).agg(F.min("line").alias("line"), F.min("entities").alias("entities"))
    entity = materialize(distinct.select("h", "line", F.explode("entities").alias("entity")), "pii-entities")
    counts = entity.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity")).where(F.col("n_entity") >= MIN_SUPPORT)
    supported = entity.join(counts, "entity")
    pairs = supported.select("entity", "n_entity", F.explode(_words(_bare(F.col("line")))).alias("term"))
    joint = materialize(pairs.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_joint"), F.max("n_entity").alias("n_entity")).where(F.col("n_joint") >= MIN_SUPPORT), "pii-joint")
    terms = joint.select("term").distinct()
    n_terms = terms.count()
    # The empty term stands for the line itself, so its count is that of all distinct lines.
    # Lines are made distinct before their words are taken: far fewer rows move than (term, name of line) would be.
    corpus_lines = docs.select(F.explode(F.split("text", "\n")).alias("line")).distinct()
    each = corpus_lines.select(F.explode(F.concat(F.array(F.lit("")), _words(F.col("line")))).alias("term"))
    wanted = terms.unionByName(docs.sparkSession.range(1).select(F.lit("").alias("term")))
    own = materialize(each.join(broadcast_if_small(wanted, n_terms + 1), "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("n_term")), "pii-terms")
    n_lines = (own.where("term = ''").first() or {"n_term": 1})["n_term"]
    content = -F.log(F.col("n_entity") / F.lit(n_lines))
    share = 1 + F.log(F.least(F.lit(1.0), F.col("n_joint") / F.col("n_term"))) / content
    scored = joint.join(own, "term").where(content > 0)
    return scored.select("entity", "term", share.alias("share")).where(F.col("share") >= GENERALISE)


def told_hits(rows: DataFrame, told: DataFrame) -> DataFrame:
    """Per text (text_key) that holds disclosing terms, wherever in it: terms, each with its largest share."""
    terms = materialize(told.groupBy("term").agg(F.max("share").alias("share")), "pii-told-terms")
    words = rows.select("text_key", F.explode(_words(F.col("text"))).alias("term"))
    hits = words.join(broadcast_if_small(terms, terms.count()), "term").distinct()
    return hits.groupBy("text_key").agg(F.collect_list(F.struct("term", "share")).alias("terms"))


def term_spans(text: Column, terms: Column) -> Column:
    """Spans of the terms (term, share) in a text."""

    def of_term(t: Column) -> Column:
        pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])"), t["term"], F.lit(r"(?![\p{L}\p{N}])"))
        kind = F.when(t["share"] >= REMOVE, "term_removed").otherwise("term_generalised")
        steps = _let(F.split(text, pattern, -1), lambda gaps: F.transform(F.slice(gaps, F.lit(1), F.size(gaps) - 1), lambda g: F.length(g) + F.length(t["term"])))
        return F.transform(running(steps, add), lambda end: F.struct((end - F.length(t["term"])).alias("start"), F.lit(len(KINDS)).alias("rank"), kind.alias("kind"), end.alias("end"), F.lit("").alias("value")))

    return F.flatten(F.transform(terms, of_term)).cast(SPAN)


def apart(added: Column, base: Column) -> Column:
    """The added spans that meet no base span (those by start): a search by halves for the base spans that start
    before an added one ends, and the farthest end among them."""

    def clear(far: Column) -> Column:
        n = F.size(base)
        bits = F.sequence(F.lit(29), F.lit(0))

        def met(t: Column) -> Column:
            def longer(at: Column, bit: Column) -> Column:
                to = at + F.pow(F.lit(2.0), bit).cast("int")
                return F.when((to <= n) & (F.try_element_at(base, to)["start"] < t["end"]), to).otherwise(at)

            before = F.aggregate(bits, F.lit(0), longer)
            return _let(before, lambda k: (k > 0) & (F.try_element_at(far, F.greatest(k, F.lit(1))) > t["start"]))

        return F.filter(added, lambda t: ~met(t))

    return F.when((F.size(base) == 0) | (F.size(added) == 0), added).otherwise(_let(running(F.transform(base, lambda b: b["end"]), F.greatest), clear))


def find_spans(docs: DataFrame) -> DataFrame:
    """Per row: row (its columns), text, base (spans of the four kinds) and spans (base and added, by start)."""
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    rows = docs.select(F.struct("*").alias("row")).withColumn("text", text)
    key = F.concat_ws("-", F.xxhash64("text"), F.hash("text"), F.length("text"))
    rows = rows.withColumn("base", base_spans(F.col("text"))).withColumn("text_key", key)
    found = materialize(rows.where(F.size("base") > 0).select("text_key", "text", "base").dropDuplicates(["text_key"]), "pii-found")
    lines = materialize(entity_lines(found), "pii-lines")
    told = materialize(disclosure(rows.select("text"), lines), "pii-told")
    hits = materialize(told_hits(rows, told), "pii-hits")
    # The text is in the row already; it need not be sent twice.
    n_terms = hits.agg(F.sum(F.size("terms") + 1)).first()[0] or 0
    joined = rows.drop("text").join(broadcast_if_small(hits, n_terms, 100_000), "text_key", "left").withColumn("text", text)
    added = F.when(F.col("terms").isNotNull(), term_spans(F.col("text"), F.col("terms"))).otherwise(F.array().cast(SPAN))
    return joined.withColumn("added", added).select("row", "text", "base", F.array_sort(F.concat("base", apart(F.col("added"), F.col("base")))).alias("spans"))


def _joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def pii_report(docs: DataFrame) -> DataFrame:
    """Counts and spans per row; positions are code points, ends exclusive."""
    of_kind = lambda k: lambda s: s["kind"] == k
    counts = [F.size(F.filter("base", of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return find_spans(id_and_text(docs)).select("row.doc_id", *counts, F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


def redact(text: Column, spans: Column) -> Column:
    """The text with each span as a placeholder; removed terms vanish; what overlaps goes with the first.

    Finding a position reads a text from its start, so each block of spans takes its own part of the text first.
    """
    name = lambda k: F.when(k == "term_removed", "").when(k == "term_generalised", "[TERM]").otherwise(F.concat(F.lit("["), F.upper(k), F.lit("]")))

    def piece(part: Column, begin: Column, x: Column) -> Column:
        new = x["s"]["start"] >= x["at"]
        return F.when(new, F.concat(F.substr(part, x["at"] - begin + 1, x["s"]["start"] - x["at"]), name(x["s"]["kind"]))).otherwise("")

    def of_block(block: Column) -> Column:
        begin, last = block[0]["at"], F.element_at(block, -1)["s"]["start"]
        part = F.substr(text, begin + 1, F.greatest(last - begin, F.lit(0)))
        return _let(part, lambda part: F.array_join(F.transform(block, lambda x: piece(part, begin, x)), ""))

    def clean(ends: Column) -> Column:
        at = F.concat(F.array(F.lit(0)), F.slice(ends, F.lit(1), F.size(ends) - 1))
        pieces = F.transform(_blocks(F.arrays_zip(spans.alias("s"), at.alias("at"))), of_block)
        return F.concat(F.array_join(pieces, ""), F.substr(text, F.element_at(ends, -1) + 1, F.length(text)))

    return F.when(F.size(spans) == 0, text).otherwise(_let(running(F.transform(spans, lambda s: s["end"]), F.greatest), clean))


def sanitize(docs: DataFrame) -> DataFrame:
    """docs with sanitised texts; n_chars, where there is one, follows."""
    clean = find_spans(docs).select("row", redact(F.col("text"), F.col("spans")).alias("clean"))
    new = {"text": F.when(F.col("row.text").isNotNull(), F.col("clean")), "n_chars": F.when(F.col("row.text").isNotNull(), F.length("clean")).otherwise(0)}
    return clean.select(*(new[c].cast(docs.schema[c].dataType).alias(c) if c in new else F.col("row").getField(c).alias(c) for c in docs.columns))
