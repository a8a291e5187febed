"""Lexicon polarity of cleaned text.

The polarity model is a parameter table ``(word, polarity)``.  A record's
sentiment is the mean polarity of its lexicon hits; a hit directly preceded by
a negator counts with factor -0.5; no hits -> 0.0; result clipped to [-1, 1].

Scoring is a per-record projection inside the JVM: the text is split into words
once, each word is looked up in a hash set of the lexicon together with the
word before it, and only the hits are weighed and summed.  No pattern runs
over the text, no shuffle, no Python worker.  A word costs one look-up
whatever the number of entries; a hit costs one per different polarity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_NEGATORS = ("not", "no", "never")
NEGATION_FACTOR = -0.5


def _lexicon_pairs(lexicon) -> dict[str, float]:
    if isinstance(lexicon, dict):
        pairs = list(lexicon.items())
    elif isinstance(lexicon, DataFrame):
        pairs = [(r["word"], r["polarity"]) for r in lexicon.select("word", "polarity").collect()]   # configuration
    else:
        pairs = list(lexicon)
    merged: dict[str, float] = {}
    for w, p in pairs:   # last entry for a word wins; words matched lower-case
        if w and p is not None:
            merged[str(w).lower()] = float(p)
    return merged


def _polarity(word: Column, lexicon: dict[str, float]) -> Column:
    """The word's polarity, null outside the lexicon: one hash set per polarity."""
    groups: dict[float, list[str]] = {}
    for entry, value in lexicon.items():
        groups.setdefault(value, []).append(entry)
    found = None
    for value, entries in groups.items():
        hit = word.isin(entries)
        found = F.when(hit, F.lit(value)) if found is None else found.when(hit, F.lit(value))
    return found


def lexicon_sentiment(clean: Column, lexicon, negators=None) -> Column:
    """Mean signed polarity of a cleaned text (tokens separated by one space)."""
    lex = _lexicon_pairs(lexicon)
    negs = [n for n in (negators if negators is not None else DEFAULT_NEGATORS) if n]
    if not lex:
        return F.lit(0.0)
    words = F.split(F.coalesce(clean, F.lit("")), " ")

    def score(tokens: Column) -> Column:
        def weigh(word: Column, i: Column) -> Column:
            value = _polarity(word, lex)
            if negs:
                before = F.when(i > 0, F.get(tokens, i - 1))
                value = value * F.when(before.isin(negs), F.lit(NEGATION_FACTOR)).otherwise(F.lit(1.0))
            return F.when(word.isin(list(lex)), value)

        hits = F.filter(F.transform(tokens, weigh), lambda v: v.isNotNull())
        return F.aggregate(hits, F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("n")),
                           lambda acc, v: F.struct((acc["sum"] + v).alias("sum"), (acc["n"] + 1).alias("n")))

    # a one-element array binds the words to a variable: they are split off once a record
    total = F.get(F.transform(F.array(words), score), F.lit(0))
    mean = F.get(F.transform(F.array(total), lambda t: F.when(
        t["n"] > 0, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), t["sum"] / t["n"])))), F.lit(0))
    return F.coalesce(mean, F.lit(0.0))
