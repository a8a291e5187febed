"""Source divergence audit (operator 12).

How far the word use of each (language, source) group is from the other
sources of its language, and which terms it uses more than its language does.

Terms are the runs of ASCII letters and non-ASCII characters, with A-Z
lower-cased.  A language keeps the V terms that occur in at least
``LEAST_DOCS`` of its documents.  With ``n`` occurrences of a kept term in a
group of ``N`` kept occurrences its share is
``p = 1 + floor(10**9 * (n + 2) / (N + 2 * V))`` (also where n is 0), and two
shares diverge by ``floor((p - q)**2 / (p + q))``.

Method, counting: length-bucketed packing.  The bytes of a slice of whole
documents are cut into terms at once.  Terms of at most 8 bytes become one
big-endian uint64, terms of at most 16 bytes two (a term holds no zero byte, so
the padding is unambiguous); they are radix-sorted by 16-bit digits, least
significant first, the group's number being the first digit, and equal runs are
counted in numpy.  Longer terms are sorted as bytes in buckets of doubling
width.  The sorts are stable and documents come in order, so the documents
of a run are counted by its changes of document.

Runs are summed per (language, source, term) before and after one shuffle, then
gathered per (language, term): one entry per source.  Pairs of sources are summed
in numpy inside tasks, over a block of terms at a time, and only one row per
pair and task is shuffled.  A language's work is V times the pairs of its
sources, and its result holds all of those pairs.

All arithmetic is exact: shares are taken in decimals (Spark) or in Python's
integers where 10**9 * (n + 2) would not fit 64 bits, and a pair's sum is below
2 * 10**9 + 4 * V.

Edge cases: null text, language and source count as empty strings; a text
of any length is cut whole (a slice is whole documents); repeated rows are
documents of their own, null ids too, ids are not read; a language without kept
terms has value 0 for its pairs and no terms; a source alone in its language
has no pairs; ties are ranked by the item's bytes; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm import kernels as K
from tidewatch.llm.store import Scratch
from tidewatch.operators.joins import checked_broadcast

LEAST_DOCS = 10
TOP = 10
SCALE = 1_000_000_000
SLICE = 8 << 20          # bytes of text counted together
BLOCK = 1 << 20          # shares held at once while pairs are summed

_LETTERS = np.array([c >= 128 or chr(c).isalpha() for c in range(256)])
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], dtype=np.uint8)


def radix_order(keys: list[np.ndarray], order: np.ndarray | None = None) -> np.ndarray:
    """Stable order of rows by uint64 ``keys``, the first key least significant.

    Passes over 16-bit digits (a stable sort of 16-bit numbers is a radix
    sort in numpy); digits that are the same in all rows are skipped.
    """
    n = len(keys[0])
    order = np.arange(n) if order is None else order
    for key in keys:
        differs = int(np.bitwise_or.reduce(key ^ key[0])) if n else 0
        for shift in (0, 16, 32, 48):
            if differs >> shift & 0xFFFF:
                digit = (key[order] >> np.uint64(shift)).astype(np.uint16)
                order = order[np.argsort(digit, kind="stable")]
    return order


def _runs(order: np.ndarray, keys: list[np.ndarray], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first row, rows, documents) of each run of equal keys in ``order``."""
    change = np.zeros(len(order), dtype=bool)
    change[0] = True
    for key in keys:
        k = key[order]
        change[1:] |= k[1:] != k[:-1]
    d = docs[order]
    new = change.copy()
    new[1:] |= d[1:] != d[:-1]
    at = np.flatnonzero(change)
    return order[at], np.diff(np.append(at, len(order))), np.add.reduceat(new.astype(np.int64), at)


def count_terms(raw: np.ndarray, off: np.ndarray, groups: np.ndarray) -> Iterator[tuple]:
    """(group, term bytes, occurrences, documents) of whole documents
    ``raw[off[i]:off[i + 1]]`` that belong to ``groups[i]``, as arrays per bucket."""
    size = int(off[-1] - off[0])
    buf = np.zeros(size + 16, dtype=np.uint8)
    buf[:size] = _LOWER[raw[off[0]:off[-1]]]
    rel = off - off[0]
    starts, ends = K.word_bounds(buf[:size], rel, ~_LETTERS)
    if not len(starts):
        return
    lengths = ends - starts
    doc = np.searchsorted(rel, starts, side="right") - 1
    group = groups[doc].astype(np.uint64)
    width = np.where(lengths <= 8, 8, np.where(lengths <= 16, 16, 0))
    long = width == 0
    # powers of two at or above the length
    width[long] = 1 << np.ceil(np.log2(lengths[long])).astype(np.int64)
    for w in np.unique(width).tolist():
        own = np.flatnonzero(width == w)
        s, n, g, d = starts[own], lengths[own], group[own], doc[own]
        if w <= 16:
            keys = [K.pack(buf, s, n, at) for at in range(0, w, 8)]
            order = radix_order([g, *reversed(keys)])
        else:
            # a term holds no zero byte, so numpy's own padding is unambiguous too
            keys = [np.array([buf[a:b].tobytes() for a, b in zip(s.tolist(), (s + n).tolist())], dtype=f"S{w}")]
            order = radix_order([g])
            order = order[np.argsort(keys[0][order], kind="stable")]
        first, rows, docs = _runs(order, [*keys, g], d)
        yield g[first].astype(np.int64), _spans(buf, s[first], n[first]), rows, docs


def _spans(buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The terms as a string column."""
    off = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(lengths, out=off[1:])
    at = np.arange(off[-1]) + np.repeat(starts - off[:-1], lengths)
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(off), pa.py_buffer(buf[at])).cast(pa.string())


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, off = K.text_buffers(batch.column(2))
        codes = [batch.column(k).dictionary_encode() for k in (0, 1)]
        pair = (codes[0].indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(codes[1].dictionary)
                + codes[1].indices.to_numpy(zero_copy_only=False))
        _, first, groups = np.unique(pair, return_index=True, return_inverse=True)
        for i, j in K.slices(off, SLICE):
            for g, terms, rows, docs in count_terms(raw, off[i:j + 1], groups[i:j]):
                at = pa.array(first[g])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), terms, pa.array(rows, pa.int64()),
                                                  pa.array(docs, pa.int64())], ["lang", "source", "term", "n", "docs"])


def share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10**9 * (n + 2) / (total + 2 * kept)), exactly."""
    x = F.lit(SCALE).cast("decimal(10,0)") * (n + 2).cast("decimal(20,0)")
    return F.lit(1).cast("bigint") + F.call_function("div", x, (total + 2 * kept).cast("decimal(20,0)"))


def shares(n: np.ndarray, total: np.ndarray, kept: int) -> np.ndarray:
    """``share`` of counts in numpy."""
    x = n + 2
    if x.size and int(x.max()) > (2 ** 63 - 1) // SCALE:
        x = x.astype(object)
    return (1 + x * SCALE // (total + 2 * kept)).astype(np.int64)


def pair_sums(counts: np.ndarray, total: np.ndarray, kept: int) -> np.ndarray:
    """Divergence summed over terms for the pairs of ``np.triu_indices(sources, 1)``;
    ``counts`` has a row per term and a column per source."""
    a, b = np.triu_indices(counts.shape[1], 1)
    out = np.zeros(len(a), dtype=np.int64)
    step = max(1, BLOCK // max(1, len(a)))
    for i in range(0, len(counts), step):
        p = shares(counts[i:i + step], total, kept)
        out += ((p[:, a] - p[:, b]) ** 2 // (p[:, a] + p[:, b])).sum(axis=0)
    return out


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums per language and pair over the rows (lang, sources, totals, kept, at,
    n) of one task; a row is a term, ``at`` the places of its sources."""
    known: dict = {}
    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        codes = langs.indices.to_numpy(zero_copy_only=False)
        for code, lang in enumerate(langs.dictionary.to_pylist()):
            own = batch.take(pa.array(np.flatnonzero(codes == code)))
            if lang not in known:
                sources, total = own.column(1)[0].as_py(), np.array(own.column(2)[0].as_py(), dtype=np.int64)
                known[lang] = [sources, total, own.column(3)[0].as_py(), np.zeros(len(sources) * (len(sources) - 1) // 2, dtype=np.int64)]
            sources, total, kept, sums = known[lang]
            rows = max(1, BLOCK // len(sources))
            for i in range(0, own.num_rows, rows):
                at, n = own.column(4).slice(i, rows), own.column(5).slice(i, rows)
                counts = np.zeros((len(at), len(sources)), dtype=np.int64)
                where = np.repeat(np.arange(len(at)), at.value_lengths().to_numpy())
                counts[where, at.flatten().to_numpy()] = n.flatten().to_numpy()
                sums += pair_sums(counts, total, kept)
    for lang, (sources, _, _, sums) in known.items():
        a, b = np.triu_indices(len(sources), 1)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(a), pa.string()), pa.array([sources[k] for k in a], pa.string()),
                                          pa.array([sources[k] for k in b], pa.string()), pa.array(sums)], ["lang", "a", "b", "value"])


def term_table(docs: DataFrame, scratch: Scratch, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
               least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, term, n, by) of the kept terms: occurrences in the language, and
    ``by``, one (source, n) per source that has the term."""
    text, lang, source = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (text_col, lang_col, source_col))
    counted = (docs.select(lang.alias("lang"), source.alias("source"), text.alias("text"))
               .mapInArrow(_count, "lang string, source string, term string, n bigint, docs bigint")
               .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    kept = (counted.groupBy("lang", "term")
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("by"))
            .where(F.col("docs") >= least_docs).drop("docs"))
    return scratch.keep(kept, "terms")


def source_divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                      least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` has every other source
    of the language by divergence, part ``term`` the ``top`` terms that the group
    uses more than its language."""
    scratch = Scratch(docs.sparkSession, "divergence")
    terms = term_table(docs, scratch, text_col, lang_col, source_col, least_docs)

    # one row per group: small next to the texts, yet not bounded, so it is measured before it is broadcast
    lang, source = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (lang_col, source_col))
    groups = docs.groupBy(lang.alias("lang"), source.alias("source")).agg(F.lit(1).alias("_one")).drop("_one")
    in_group = terms.select("lang", F.explode("by").alias("e")).groupBy("lang", "e.source").agg(F.sum("e.n").alias("total"))
    in_lang = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("n").alias("lang_total"))
    groups = scratch.keep(groups.join(in_group, ["lang", "source"], "left").join(in_lang, "lang", "left")
                          .select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
                                                      for c in ("total", "kept", "lang_total")]), "groups")

    uses = (terms.select("lang", "term", F.col("n").alias("lang_n"), F.explode("by").alias("e"))
            .select("lang", "term", "lang_n", "e.source", "e.n").join(checked_broadcast(groups), ["lang", "source"])
            .select("lang", "source", "term", share(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
                    share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q")).where("p > q"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    tops = (uses.select("lang", "source", F.col("term").alias("item"), F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
            .withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)
            .select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))

    # the sources of a language in one order, and where each stands
    entry = F.sort_array(F.collect_list(F.struct("source", "total")))
    langs = (groups.groupBy("lang").agg(entry.alias("_g"), F.max("kept").alias("kept"))
             .select("lang", "kept", F.col("_g.source").alias("sources"), F.col("_g.total").alias("totals")))
    langs = scratch.keep(langs, "langs")
    place = F.transform("by", lambda e: (F.array_position("sources", e["source"]) - 1).cast("int"))
    sums = (terms.join(checked_broadcast(langs.where(F.size("sources") > 1), 10_000), "lang")
            .select("lang", "sources", "totals", "kept", place.alias("at"), F.col("by.n").alias("n"))
            .mapInArrow(_pairs, "lang string, a string, b string, value bigint")
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    sums = scratch.keep(sums, "sums")
    both = (sums.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value")
            .unionByName(sums.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value")))
    # a language without kept terms has all its pairs too
    every = (langs.select("lang", "sources", F.explode("sources").alias("source"))
             .select("lang", "source", F.explode("sources").alias("item")).where("source <> item"))
    pairs = (every.join(both, ["lang", "source", "item"], "left").withColumn("value", F.coalesce("value", F.lit(0).cast("bigint")))
             .withColumn("rank", F.row_number().over(by_value))
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank"))
    return pairs.unionByName(tops)


DIVERGENCE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(text, '') AS t, coalesce(lang, '') AS lang, coalesce(source, '') AS source
           FROM documents),
o AS (SELECT id, lang, source, unnest(regexp_extract_all(
        translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT id) AS docs FROM o GROUP BY ALL),
k AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL HAVING sum(docs) >= 10),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS kept, sum(n) AS total FROM k GROUP BY ALL),
t AS (SELECT lang, source, sum(c.n) AS total FROM c SEMI JOIN k USING (lang, term) GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
        1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(t.total, 0) + 2 * v.kept) AS p,
        1 + (1000000000::HUGEINT * (k.n + 2)) // (v.total + 2 * v.kept) AS q
      FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN t ON t.lang = g.lang AND t.source = g.source
        LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
e AS (SELECT x.lang, x.source, y.source AS item FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source),
r AS (SELECT lang, source, 'pair' AS part, item, coalesce(value, 0)::BIGINT AS value FROM e LEFT JOIN s USING (lang, source, item)
      UNION ALL
      SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank FROM (
  SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM r)
WHERE part = 'pair' OR rank <= 10
"""
