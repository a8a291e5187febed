"""Column expressions for text: cleaning, hashing, multi-value fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# every Unicode white space character (Java's and RE2's own classes are ASCII only)
WHITE_SPACE = (r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}"
               r"\x{202F}\x{205F}\x{3000}")
_URL = f"http[^{WHITE_SPACE}]+"
_NOT_LETTERS = r"[^a-z]++"   # of lower-cased text; possessive: a run is never given back
# white space other than the plain space, and runs of what is neither (lower-cased) letter nor
# plain space: Java is ten times slower on one negated class with all of these ranges
_OTHER_SPACES = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                                  0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_MARKS = r"[^a-z ]+"
_NOT_LETTER = f"[^a-zA-Z{WHITE_SPACE}]"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clean_text(col: str | Column, punct: str = " ") -> Column:
    """Lower, drop URLs, non-letters -> ``punct``, collapse spaces, trim.

    ``punct=" "`` is the pipeline variant ("AI-music" -> "ai music");
    ``punct=""`` the notebook variant ("AI-music" -> "aimusic").
    """
    text = F.lower(F.coalesce(_c(col), F.lit("")))
    # most texts name no URL: looking for its first letters is far cheaper than the pattern
    text = F.when(F.contains(text, F.lit("http")), F.regexp_replace(text, _URL, "")).otherwise(text)
    if punct == " ":
        # every maximal run of non-letters (whitespace included) becomes one
        # space: the same result as "non-letter -> space, then collapse spaces"
        return F.trim(F.regexp_replace(text, _NOT_LETTERS, " "))
    if punct != "":
        text = F.regexp_replace(text, _NOT_LETTER, punct)
    text = F.translate(text, _OTHER_SPACES, " " * len(_OTHER_SPACES))
    if punct == "":
        text = F.regexp_replace(text, _MARKS, "")
    return F.trim(F.regexp_replace(text, " {2,}", " "))


def stable_seed(col: str | Column) -> Column:
    """Sum over characters of (position * code point), mod 2^32 - 1."""
    c = _c(col)
    total = F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.length(c), F.lit(1))),
        F.lit(0).cast("bigint"),
        lambda acc, i: acc + F.when(F.length(c) >= i,
                                    i.cast("bigint") * F.ascii(F.substring(c, i, 1)))
        .otherwise(F.lit(0).cast("bigint")),
    )
    return F.pmod(total, F.lit(4294967295).cast("bigint"))


def normalize_text(col: str | Column) -> Column:
    """Null / 'nan' -> '', trimmed."""
    t = F.trim(F.coalesce(_c(col).cast("string"), F.lit("")))
    return F.when(F.lower(t) == "nan", F.lit("")).otherwise(t)


def split_multi_value(col: str | Column) -> Column:
    """Split on '|' if present, else ';', else keep whole; trim; drop blanks."""
    t = normalize_text(col)
    parts = (F.when(t.contains("|"), F.split(t, r"\|"))
             .when(t.contains(";"), F.split(t, ";"))
             .otherwise(F.array(t)))
    return F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: p != "")


def join_multi_value(col: str | Column) -> Column:
    """K3: array -> ' | ' joined string (blank items dropped)."""
    return F.array_join(F.filter(F.transform(_c(col), lambda p: F.trim(p)),
                                 lambda p: p != ""), " | ")


def count_occurrences(text: str | Column, keyword: str) -> Column:
    """Non-overlapping substring occurrences of a literal keyword
    (length lost by deleting every occurrence / keyword length)."""
    t = F.coalesce(_c(text), F.lit(""))
    return ((F.length(t) - F.length(F.replace(t, F.lit(keyword), F.lit(""))))
            / F.lit(len(keyword))).cast("bigint")
