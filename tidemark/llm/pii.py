"""Personal data: patterns propose spans, checksums confirm them, nearby words
move the score. Built-in SQL functions only.

``find_pii`` adds an array of spans per row, ``redact`` replaces the spans by
tags. Both work row by row: no shuffle, nothing kept between rows.

A pattern is searched leftmost and without overlap per kind; a match that fails
its check is dropped and its characters are not searched again. Positions are
code points, end exclusive. They come from the pieces between the matches
(``split`` with the same pattern), so one text costs two passes per kind that
occurs in it. Running sums over the matches go by blocks: within a block, and over
the blocks' totals. An account number may take in words of capitals that follow it;
the longest part of the match up to a blank that passes its checks is the span.

The plain definitions have open repeats such as ``[0-9]+`` or ``(x)+`` that cost
quadratic time or deep recursion on very long runs. The patterns below find the
same matches from the start of each run only, with possessive repeats.

Cases: a null text counts as empty; an empty text has an empty array; a null id
is kept; repeated rows each get their own result; an empty table stays empty;
other columns pass through and a column called like the output is replaced."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in the order of all digests; the first four are the base.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "secret")
BASE = KINDS[:4]

PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # a maximal chain of 16 to 19 digits with single blanks or hyphens between
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?",
    "ssn": r"(?<![0-9])[0-9]++-[0-9]++-[0-9]++",
    "secret": r"(?:[Tt]oken|[Ss]ecret|[Aa]pi_key|[Pp]assword)[ ]{0,4}[:=][ ]{0,4}[\x22']?[A-Za-z0-9_/+.-]{16,}",
}
_NEEDS = {"email": "@", "ip": ".", "phone": "+", "ssn": "-"}
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"

#: Score of a confirmed span without and the gain with a context word before it.
SCORES = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.4, "secret": 0.8}
CONTEXT_GAIN = 0.2
CONTEXT_CHARS = 40
KEEP_SCORE = 0.5
CONTEXT = {
    "email": "mail|contact|write",
    "ip": "ip|host|server|address",
    "card": "card|visa|credit|pay",
    "phone": "phone|tel|call|mobile|fax",
    "iban": "iban|bank|account",
    "ssn": "ssn|social|security",
    "secret": "key|auth|login",
}


#: Matches of one block of a running sum.
BLOCK = 256


def _let(value: Column, use) -> Column:
    """use(value) with ``value`` computed once: inside lambdas an expression runs again for each element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _blocks(items: Column, size) -> Column:
    """An array in slices of ``size`` items; it must not be empty."""
    last = F.floor((F.size(items) - 1) / size).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(items, (i * size + 1).cast("int"), F.lit(size) if isinstance(size, int) else size))


def _mod97(value: Column) -> Column:
    """Remainder of an account number read as digits, its first four characters last."""
    s = F.regexp_replace(value, " ", "")
    moved = F.concat(F.substr(s, F.lit(5)), F.substring(s, 1, 4))
    chars = F.filter(F.split(moved, ""), lambda c: c != "")
    return F.aggregate(chars, F.lit(0), lambda acc, c: F.when(
        c.between("0", "9"), (acc * 10 + F.ascii(c) - 48) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97))


def _confirmed(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^(?:{_BYTE}\.){{3}}{_BYTE}$")
    if kind == "card":
        return F.call_function("luhn_check", F.regexp_replace(value, r"[\x20-]", ""))
    if kind == "phone":
        return F.length(F.regexp_replace(value, "[^0-9]", "")).between(8, 15)
    if kind == "ssn":
        return value.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$")
    return F.lit(True)


def _account(value: Column) -> Column:
    """The longest part of a match, whole or up to a blank, that is an account number, or null."""
    tokens = F.split(value, " ")
    parts = F.transform(F.sequence(F.size(tokens), F.lit(1)), lambda k: F.array_join(F.slice(tokens, F.lit(1), k), " "))
    good = F.filter(parts, lambda v: F.length(F.regexp_replace(v, " ", "")).between(15, 34) & v.rlike(f"^{PATTERNS['iban']}$") & (_mod97(v) == 1))
    return F.get(good, F.lit(0))


_SPAN = "array<struct<kind:string,start:int,end:int,score:double>>"


def _spans(text: Column, kind: str) -> Column:
    """Confirmed spans of one kind, by start."""
    pattern = F.lit(PATTERNS[kind])
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.split(text, pattern, -1)
    # of the text before a match its length and its end are needed
    pairs = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, m: F.struct(
        F.length(g).alias("gap"), F.right(g, F.lit(CONTEXT_CHARS)).alias("tail"), m.alias("value")))

    def last(*parts):
        return F.right(F.concat(*parts), F.lit(CONTEXT_CHARS))

    def totals(block):  # length of a block and its last characters
        zero = F.struct(F.lit(0).alias("size"), F.lit("").alias("tail"))
        return F.aggregate(block, zero, lambda acc, x: F.struct(
            (acc.size + x.gap + F.length(x.value)).alias("size"), last(acc.tail, x.tail, x.value).alias("tail")))

    def before_each(sums):  # where each block begins, and the characters before it
        begin = F.struct(F.lit(0).alias("pos"), F.lit("").alias("tail"), F.array().cast("array<struct<pos:int,tail:string>>").alias("out"))
        return F.aggregate(sums, begin, lambda acc, x: F.struct(
            (acc.pos + x.size).alias("pos"), last(acc.tail, x.tail).alias("tail"),
            F.concat(acc.out, F.array(F.struct(acc.pos.alias("pos"), acc.tail.alias("tail")))).alias("out")), lambda acc: acc.out)

    def place(block, at):
        begin = F.struct(at.pos.alias("pos"), at.tail.alias("tail"), F.array().cast("array<struct<start:int,value:string,before:string>>").alias("out"))
        return F.aggregate(block, begin, lambda acc, x: F.struct(
            (acc.pos + x.gap + F.length(x.value)).alias("pos"), last(acc.tail, x.tail, x.value).alias("tail"),
            F.concat(acc.out, F.array(F.struct((acc.pos + x.gap).alias("start"), x.value.alias("value"), last(acc.tail, x.tail).alias("before")))).alias("out")),
            lambda acc: acc.out)

    placed = _let(pairs, lambda p: _let(_blocks(p, BLOCK), lambda bs: _let(
        before_each(F.transform(bs, totals)), lambda at: F.flatten(F.transform(bs, lambda b, i: place(b, F.get(at, i)))))))

    def scored(x):
        gain = F.when(F.lower(x["before"]).rlike(CONTEXT[kind]), CONTEXT_GAIN).otherwise(0.0)
        return F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"),
                        (x["start"] + F.length(x["value"])).alias("end"), (F.lit(SCORES[kind]) + gain).alias("score"))

    if kind == "iban":
        own = F.transform(placed, lambda x: F.struct(x["start"].alias("start"), _account(x["value"]).alias("value"), x["before"].alias("before")))
        sure = F.filter(own, lambda x: x["value"].isNotNull())
    else:
        sure = F.filter(placed, lambda x: _confirmed(kind, x["value"]))
    kept = F.filter(F.transform(sure, scored), lambda s: s.score >= KEEP_SCORE)
    some = F.size(found) > 0
    if kind in _NEEDS:
        some = F.when(text.contains(_NEEDS[kind]), some).otherwise(False)
    return F.when(some, kept).otherwise(F.array().cast(_SPAN))


def find_pii(df: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """``df`` with ``out``: array of (kind, start, end, score), by kind as in KINDS, then by start."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return df.withColumn(out, F.concat(*[_spans(whole, k) for k in KINDS]))


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with every span of ``text`` replaced by its tag, such as ``[EMAIL]``.

    Overlapping spans become one tag, that of the first. A null text stays null."""
    spans = "__pii_spans"
    found = find_pii(df, text, spans)
    body = F.col(text)
    order = F.array_sort(F.transform(F.col(spans), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s.kind.alias("kind"))))
    size = F.ceil(F.sqrt(F.size(spans).cast("double"))).cast("int")  # text is cut from its start: once per block, then inside the block's part

    def reach(blocks):  # how far the spans before each block, and all of them, reach
        begin = F.array(F.lit(0))
        return F.aggregate(blocks, begin, lambda acc, b: F.concat(acc, F.array(F.greatest(
            F.element_at(acc, -1), F.array_max(F.transform(b, lambda s: s["end"]))))))

    def cleaned(block, low, high):
        def step(acc, s):
            piece = F.concat(acc.out, F.substr(acc.part, acc.pos - low + 1, s["start"] - acc.pos), F.lit("["), F.upper(s.kind), F.lit("]"))
            return F.struct(F.greatest(acc.pos, s["end"]).alias("pos"), acc.part.alias("part"), F.when(s["start"] >= acc.pos, piece).otherwise(acc.out).alias("out"))

        begin = F.struct(low.alias("pos"), F.substr(body, low + 1, high - low).alias("part"), F.lit("").alias("out"))
        return F.aggregate(block, begin, step, lambda acc: acc.out)

    clean = _let(order, lambda o: _let(_blocks(o, size), lambda bs: _let(reach(bs), lambda to: F.concat(
        F.array_join(F.transform(bs, lambda b, i: cleaned(b, F.get(to, i), F.get(to, i + 1))), ""), F.substr(body, F.element_at(to, -1) + 1)))))
    return found.withColumn(text, F.when(F.size(spans) > 0, clean).otherwise(body)).drop(spans)


def digest(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s.kind, s["start"].cast("string"), s["end"].cast("string"))))
