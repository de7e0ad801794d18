"""Personal data: patterns propose spans, checksums confirm them, nearby words
adjust the score.

One pass over the table without a shuffle, all in built-in functions. A
pattern's places follow from the pieces between its matches: the start of a
match is the length of everything before it. The patterns use possessive
repeats and start only where a run starts, so they take linear time and no
recursion on very long runs; they find what the plain forms in ``PLAIN`` find.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.store import text_or_empty

#: The plain patterns, in the order in which kinds are listed.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z][A-Z][0-9][0-9](\x20?[A-Z0-9][A-Z0-9][A-Z0-9][A-Z0-9]){2,7}(\x20?[A-Z0-9]{1,3})?",
    "ssn": r"[0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9][0-9][0-9]",
}
#: The same matches for the JVM's engine, which backtracks.
FAST = PLAIN | {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
}
#: A text without this can't hold the kind.
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+", "iban": "", "ssn": "-"}
BASE = ["email", "ip", "card", "phone"]
#: Score of a confirmed span, and words that raise it when they stand near.
SCORES = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.9, "ssn": 0.3}
WORDS = {
    "email": "mail|contact|write",
    "ip": "host|server|address|login",
    "card": "card|visa|credit|payment",
    "phone": "phone|call|tel|mobile",
    "iban": "iban|bank|account",
    "ssn": "ssn|social|security",
}
NEAR, RAISE, LEAST = 30, 0.2, 0.5
_CHUNK = 256
_SPAN = "array<struct<start:bigint,end:bigint,value:string,near:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    d = F.reverse(_digits(value))

    def add(total, i):
        x = F.substring(d, i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, x).when(x < 5, 2 * x).otherwise(2 * x - 9)

    total = F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), add)
    return F.length(d).between(13, 19) & (total % 10 == 0)


def _mod97(value: Column) -> Column:
    plain = F.regexp_replace(value, " ", "")
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))

    def add(rest, c):
        code = F.ascii(c)
        return F.when(code < 65, rest * 10 + code - 48).otherwise(rest * 100 + code - 55) % 97

    rest = F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.when(c == "", a).otherwise(add(a, c)))
    return F.length(plain).between(15, 34) & (rest == 1)


CONFIRM = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: F.forall(
        F.split(v, r"\."), lambda x: x.rlike(r"^0*+(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$")
    ),
    "card": _luhn,
    "phone": lambda v: F.length(_digits(v)).between(9, 15),
    "iban": _mod97,
    "ssn": lambda v: F.lit(True),
}


def _with_places(rows: DataFrame, kind: str) -> DataFrame:
    """``rows`` with the column of ``kind``: start, end, value and neighbourhood of
    each match, in code points. Chunks of matches are placed relative to
    themselves first and then moved, so the work stays near linear in the number
    of matches. Each step is a column of its own: a lambda that held the step
    before as an expression would work it out again for each element."""
    text, pattern = F.col("_text"), FAST[kind]
    pieces, found, chunks, before = (F.col(f"_{name}") for name in ("pieces", "found", "chunks", "before"))
    may = F.contains(text, F.lit(NEEDS[kind])) & (F.lit(True) if kind == "email" else F.col("_number"))
    rows = rows.withColumns(
        {
            "_values": F.when(may, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))),
            "_pieces": F.when(may, F.split(text, pattern, -1)),
        }
    )
    gaps = F.transform(
        pieces,
        lambda p, i: F.struct(
            F.length(p).cast("long").alias("gap"),
            F.concat_ws(" ", F.right(p, F.lit(NEAR)), F.left(F.get(pieces, i + 1), F.lit(NEAR))).alias("near"),
            F.get(F.col("_values"), i).alias("v"),
        ),
    )
    rows = rows.withColumn("_found", F.slice(gaps, F.lit(1), F.greatest(F.size("_values"), F.lit(0))))

    def step(acc, z):
        start = acc["at"] + z["gap"]
        end = start + F.length(z["v"])
        span = F.struct(start.alias("start"), end.alias("end"), z["v"].alias("value"), z["near"].alias("near"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    none = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_SPAN).alias("spans"))
    each = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(found) - 1) / _CHUNK).cast("int")),
        lambda c: F.aggregate(F.slice(found, c * _CHUNK + 1, F.lit(_CHUNK)), none, step),
    )
    rows = rows.withColumn("_chunks", F.when(F.size(found) > 0, each))
    sums = F.aggregate(
        chunks,
        F.array(F.lit(0).cast("long")),
        lambda acc, c: F.concat(acc, F.array(F.element_at(acc, -1) + c["at"])),
    )
    rows = rows.withColumn("_before", sums)
    moved = F.transform(
        chunks,
        lambda c, k: F.transform(
            c["spans"],
            lambda s: F.struct(
                (s["start"] + before[k]).alias("start"),
                (s["end"] + before[k]).alias("end"),
                s["value"].alias("value"),
                s["near"].alias("near"),
            ),
        ),
    )
    rows = rows.withColumn(f"_{kind}", F.flatten(moved))
    return rows.drop("_values", "_pieces", "_found", "_chunks", "_before")


def _confirmed(kind: str) -> Column:
    """The spans of one kind that pass their check, with their scores."""

    def scored(s):
        near = F.when(F.lower(s["near"]).rlike(WORDS[kind]), RAISE).otherwise(0.0)
        score = (F.lit(SCORES[kind]) + near).alias("score")
        return F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), score
        )

    spans = F.transform(F.filter(F.col(f"_{kind}"), lambda s: CONFIRM[kind](s["value"])), scored)
    if kind not in BASE:
        spans = F.filter(spans, lambda s: s["score"] >= LEAST)
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,value:string,score:double>>")
    return F.coalesce(spans, none)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id`` and ``found``, an array of structs (kind,
    start, end, value, score) by kind as listed in ``PLAIN``, then start; code
    points, end exclusive. Base kinds are there whenever confirmed; the others
    from a score of ``LEAST`` on. Null and empty texts have none. Repeated rows
    each get their row; other columns are not read."""
    text = F.col("_text")
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("_text"))
    rows = rows.withColumn("_number", text.rlike("[0-9]"))
    for kind in PLAIN:
        rows = _with_places(rows, kind)
    parts = [_confirmed(kind) for kind in PLAIN]
    return rows.select("doc_id", F.concat(*parts).alias("found"))


def pii_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns of ``find_pii`` over ``documents``."""
    found = F.col("found")

    def told(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
            ",",
        )

    def of(kind):
        return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(found, lambda s: s["kind"].isin(BASE))
    return find_pii(docs).select(
        "doc_id",
        *[of(kind) for kind in PLAIN],
        F.sha2(told(base), 256).alias("base_sha256"),
        told(found).alias("spans"),
    )
