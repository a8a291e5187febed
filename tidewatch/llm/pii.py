"""Personal data by patterns, checksums and context (operator 2).

Column expressions only: every step is a regular expression or an array
function, so the whole operator is one projection over the text (no shuffle,
no Python).

* Regular expressions propose spans.  Patterns with a run in front use
  possessive quantifiers and start-of-run conditions: they find the same
  leftmost matches as the plain forms, without backtracking, so very long
  runs of digits or letters cost linear time and no stack.
* Checksum validators confirm: Luhn for cards, mod-97 for IBANs, part and
  digit ranges for addresses and phones.
* Words nearby (``CONTEXT`` characters on either side) adjust the score of a
  span.  Base kinds always stay; added kinds (iban, ssn) stay from
  ``MIN_SCORE``.

Positions are code points, end exclusive.  Null or empty text has no spans; a
null doc_id is kept; repeated rows give repeated results; extra columns of the
input pass through ``with_pii`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("iban", "ssn")
CONTEXT = 40
MIN_SCORE = 0.5

# leftmost matches of the plain forms; (?<!..) marks the start of a run
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}",
    "card": r"[0-9](?<![0-9][0-9])(?<![0-9][\x20-][0-9])(?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3}+)?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
# a text without this character has no match
_HINT = {"email": "@", "phone": "+", "ip": ".", "ssn": "-"}
# score before context
_PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.3}
_SUPPORT = {
    "email": r"\b(?:e-?mail|contact|write|mailto|correo|kontakt)\b",
    "ip": r"\b(?:ip|address|host|server|login|adresse)\b",
    "card": r"\b(?:card|visa|mastercard|credit|payment|tarjeta|karte|carte)\b",
    "phone": r"\b(?:phone|tel|call|mobile|fax|telefon|teléfono|téléphone)\b",
    "iban": r"\b(?:iban|account|bank|konto|cuenta|compte)\b",
    "ssn": r"\b(?:ssn|social|security|taxpayer)\b",
}
_AGAINST = r"\b(?:version|isbn|issn|order|invoice|tracking|example|sample|test)\b"
_SPANS = "array<struct<kind:string,start:int,end:int,value:string,score:double>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _chars(value: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(value)), lambda i: F.substr(value, i, F.lit(1)))


def luhn(digits: Column) -> Column:
    """True if a string of digits passes the Luhn check."""
    def part(c: Column, i: Column) -> Column:
        d = c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)
    parts = F.transform(_chars(F.reverse(digits)), part)
    return F.aggregate(parts, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(iban: Column) -> Column:
    """True if a compact IBAN has remainder 1."""
    moved = F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4)))
    value = F.aggregate(_chars(moved), F.lit(0), lambda a, c: F.when(
        c.rlike("[0-9]"), (a * 10 + c.cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97))
    return value == 1


def confirmed(kind: str, value: Column) -> Column:
    if kind == "ip":
        # a part of any length; leading zeros do not count
        return F.forall(F.split(value, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")).between(0, 3)
                        & (F.regexp_replace(p, "^0+(?=.)", "").substr(1, 4).cast("int") <= 255))
    if kind == "card":
        return luhn(_digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    if kind == "iban":
        return mod97(F.replace(value, F.lit(" "), F.lit("")))
    return F.lit(True)


def _located(found: Column, gaps: Column) -> Column:
    """Spans of the matches, from the texts between them."""
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    start = F.struct(F.lit(0).alias("pos"), empty.alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        a = acc["pos"] + F.length(x["gap"])
        b = a + F.length(x["found"])
        span = F.struct(a.alias("start"), b.alias("end"), x["found"].alias("value"))
        return F.struct(b.alias("pos"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    pairs = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found,
                       lambda g, v: F.struct(g.alias("gap"), v.alias("found")))
    return F.aggregate(pairs, start, step, lambda acc: acc["spans"])


def _scored(kind: str, spans: Column, text: Column) -> Column:
    def score(s: Column) -> Column:
        lead = F.greatest(s["start"] - CONTEXT, F.lit(0))
        near = F.lower(F.concat(F.substr(text, lead + 1, s["start"] - lead), F.lit(" "),
                                F.substr(text, s["end"] + 1, F.lit(CONTEXT))))
        value = (F.lit(_PRIOR[kind]) + F.when(near.rlike(_SUPPORT[kind]), 0.3).otherwise(0.0)
                 - F.when(near.rlike(_AGAINST), 0.2).otherwise(0.0))
        return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                        s["value"].alias("value"), F.round(F.least(value, F.lit(1.0)), 2).alias("score"))
    out = F.transform(F.filter(spans, lambda s: confirmed(kind, s["value"])), score)
    return out if kind in BASE_KINDS else F.filter(out, lambda s: s["score"] >= MIN_SCORE)


def with_pii(docs: DataFrame, text_col: str = "text", out_col: str = "pii") -> DataFrame:
    """``docs`` plus an array of (kind, start, end, value, score), by kind as in
    ``KINDS`` and then by start.  A column of that name is replaced."""
    own = [c for c in docs.columns if c != out_col]
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    none = F.array().cast("array<string>")

    def proposed(kind: str) -> Column:
        found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
        return F.when(F.contains(text, F.lit(_HINT[kind])), found).otherwise(none) if kind in _HINT else found

    df = docs.select(*[F.col(f"`{c}`") for c in own], *[proposed(k).alias(f"__found_{k}") for k in KINDS])
    spans = []
    for k in KINDS:
        found = F.col(f"__found_{k}")
        located = _located(found, F.split(text, PATTERNS[k], -1))
        spans.append(F.when(F.size(found) > 0, _scored(k, located, text)).otherwise(F.array().cast(_SPANS)))
    return df.select(*[F.col(f"`{c}`") for c in own], F.concat(*spans).cast(_SPANS).alias(out_col))


def redact(docs: DataFrame, text_col: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets, e.g. ``[EMAIL]``:
    all of the base kinds, those of added kinds from ``min_score``.
    Overlapping spans become one, named after the first; null text stays null."""
    df = with_pii(docs, text_col, "__pii")
    text = F.col(f"`{text_col}`")
    order = F.array_sort(F.transform(
        F.filter("__pii", lambda s: s["kind"].isin(*BASE_KINDS) | (s["score"] >= min_score)),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("pos"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        put = F.concat(acc["out"], F.substr(text, acc["pos"] + 1, s["start"] - acc["pos"]),
                       F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.greatest(acc["pos"], s["end"]).alias("pos"),
                        F.when(s["start"] >= acc["pos"], put).otherwise(acc["out"]).alias("out"))

    clean = F.aggregate(order, start, step,
                        lambda acc: F.concat(acc["out"], F.substr(text, acc["pos"] + 1)))
    return df.withColumn(text_col, F.when(F.size("__pii") > 0, clean).otherwise(text)).drop("__pii")


def pii_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, max_score)."""
    df = with_pii(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))

    def joined(spans: Column) -> Column:
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    base = F.filter("pii", lambda s: s["kind"].isin(*BASE_KINDS))

    def count(kind: str) -> Column:
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return df.select("doc_id", *[count(k) for k in BASE_KINDS], F.sha2(joined(base), 256).alias("base_sha256"),
                     joined(F.col("pii")).alias("spans"),
                     F.array_max(F.transform("pii", lambda s: s["score"])).alias("max_score"))
