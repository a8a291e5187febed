"""Many keywords in one pass over a text.

Keywords (any substrings, also overlapping ones and parts of each other) are
compiled into one Aho-Corasick automaton, so a text is read once whatever the
number of keywords; trying each keyword on each text costs their product, which pays
only for a few of them (``FEW``): the automaton makes an object of every occurrence.
Texts go to the Python workers in Arrow batches; only a few numbers per
text come back.  The automaton is built once per task from the keywords in
the function's closure (configuration, not data).

A blank keyword matches nothing; a null text is an empty one.  Case is the
caller's business.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


FEW = 24   # keywords up to which a search for each is cheaper than the automaton


class Matcher:
    """Occurrences of the keywords of several groups in a text."""

    def __init__(self, groups: Sequence[Sequence[str]]):
        import ahocorasick
        self.size = len(groups)
        owners: dict[str, list[int]] = {}
        for g, words in enumerate(groups):
            for word in words:
                if word:
                    owners.setdefault(word, []).append(g)
        self.words, self.own = list(owners), list(owners.values())
        # a keyword that begins as it ends can overlap itself
        self.folds = [any(w.startswith(w[i:]) for i in range(1, len(w))) for w in self.words]
        self.automaton = ahocorasick.Automaton()
        for k, word in enumerate(self.words):
            self.automaton.add_word(word, k)
        self.empty = not owners
        if owners:
            self.automaton.make_automaton()

    def found(self, text: str | None) -> Iterator[int]:
        """The number of the keyword of every occurrence."""
        return iter(()) if self.empty or not text else map(itemgetter(1), self.automaton.iter(text))

    def first_group(self, text: str | None) -> int | None:
        """The first group with a keyword in the text."""
        best = None
        for k in self.found(text):
            if best is None or self.own[k][0] < best:
                best = self.own[k][0]
                if not best:
                    break
        return best

    def distinct(self, text: str | None) -> list[int]:
        """Different keywords of each group in the text."""
        out = [0] * self.size
        if len(self.words) <= FEW:
            seen = [k for k, word in enumerate(self.words) if word in text] if text else ()
        else:
            seen = set(self.found(text))
        for k in seen:
            for g in dict.fromkeys(self.own[k]):
                out[g] += 1
        return out

    def counts(self, text: str | None) -> list[int]:
        """Occurrences of each group's keywords; those of one keyword do not
        overlap (leftmost first), those of different ones may."""
        out = [0] * self.size
        few = len(self.words) <= FEW
        if few:
            found = [(k, text.count(word)) for k, word in enumerate(self.words)] if text else ()
        else:
            found = Counter(self.found(text)).items()
        for k, n in found:
            if self.folds[k] and not few:
                n = text.count(self.words[k])
            for g in self.own[k]:
                out[g] += n
        return out


def _per_text(text: Column, groups: Sequence[Sequence[str]], what: str, kind: str) -> Column:
    groups = [list(g) for g in groups]

    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = getattr(Matcher(groups), what)
        for texts in batches:
            yield pd.Series([one(t) for t in texts], dtype=object if kind.startswith("array") else "Int32")

    return run(text)


def first_group(text: Column, groups: Sequence[Sequence[str]]) -> Column:
    """Number (from 0) of the first group with a keyword in the text, else null."""
    return _per_text(text, groups, "first_group", "int")


def distinct_hits(text: Column, groups: Sequence[Sequence[str]]) -> Column:
    """Per group, the number of its different keywords in the text."""
    return _per_text(text, groups, "distinct", "array<int>")


def occurrences(text: Column, groups: Sequence[Sequence[str]]) -> Column:
    """Per group, the occurrences of its keywords in the text."""
    return _per_text(text, groups, "counts", "array<bigint>")
