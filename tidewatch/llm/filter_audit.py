"""Filter interaction audit (operator 13).

Which filter removes what, in every order of the filters: with k filters a
document is described by the mask of the filters it fails, and an order removes
it at the first filter of its mask.

Method: the orders are numbered by their Lehmer rank (lexicographic order).  All
orders with a given beginning of ``s`` filters are one interval of
``(k - s)!`` ranks, so the orders in which a mask is removed at step ``s`` (the
beginning's last filter is in the mask, none before it is) are a few
intervals, worked out once per mask.  A mask's document counts are added at the
start and taken off at the end of its intervals; the prefix sum over the ranks
then gives the totals of every order.  No document is looked at per order.

Documents are reduced to counts by (part, mask, labels) before anything else
happens, so the audit itself works on at most 4 * 2**k rows a part, and one
window holds k! ranks.

Duplicates: a document fails ``E`` if a smaller id holds the identical text.
Texts are compared by their SHA-256; the smallest id of each digest is combined
before the shuffle, and the documents meet it on (digest, id), so a group of
copies of any size is spread over all tasks.

Edge cases: null text counts as empty, null part as the empty string; a null
id is no smaller id and has none, so it never fails ``E``; rows of the same id
are each counted and are no duplicates of each other; a document without a
label loses neither a good nor a toxic one; several labels of an id count as
one that holds where any of them does; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.store import Scratch

DUPLICATE = "E"
MOST_FILTERS = 6   # 720 ranks; the tables per part grow with the factorial


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions that a text alone decides."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n = F.size(words)
    return {
        "A": n < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * n,
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.char_length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def lehmer_rank(beginning: tuple[int, ...], k: int) -> int:
    """Rank of the first order of ``0 .. k-1`` that starts with ``beginning``."""
    rank = 0
    for i, item in enumerate(beginning):
        smaller = item - sum(b < item for b in beginning[:i])
        rank += smaller * factorial(k - 1 - i)
    return rank


def removal_intervals(k: int) -> list[tuple[int, int, bool, int, int]]:
    """(mask, step, first, start, end): in the orders of rank ``start <= r < end``
    the filter at ``step`` is in the mask; with ``first`` none before it is
    (the document is removed there), without it one is."""
    out = []
    for step in range(1, k + 1):
        spans: dict = {}
        for beginning in permutations(range(k), step):
            start = lehmer_rank(beginning, k)
            end = start + factorial(k - step)
            before = sum(1 << b for b in beginning[:-1])
            for mask in range(1 << k):
                if mask >> beginning[-1] & 1:
                    rows = spans.setdefault((mask, mask & before == 0), [])
                    if rows and rows[-1][1] == start:
                        rows[-1][1] = end
                    else:
                        rows.append([start, end])
        out += [(mask, step, first, lo, hi) for (mask, first), rows in spans.items() for lo, hi in rows]
    return out


def document_masks(docs: DataFrame, labels: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text",
                   part_col: str = "lang", filters=text_filters) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part by the filters they fail."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    tests = filters(F.col("_text"))
    bits = sum((F.when(test, F.lit(1 << i)).otherwise(F.lit(0)) for i, test in enumerate(tests.values())), F.lit(0))
    facts = (docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                         text.alias("_text"))
             .select("doc_id", "part", bits.alias("mask"), F.unhex(F.sha2("_text", 256)).alias("digest")))
    # read twice: written once, so that no text is judged again
    facts = scratch.keep(facts, "facts")
    firsts = facts.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    marks = (labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id"))
             .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
                  F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")))
    copy = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    judged = (facts.join(firsts, ["digest", "doc_id"], "left")
              .select("doc_id", "part", (F.col("mask") + F.when(copy, F.lit(1 << len(tests))).otherwise(F.lit(0))).alias("mask"))
              .join(marks, "doc_id", "left"))
    one = lambda c: F.sum(F.when(F.col(c), F.lit(1)).otherwise(F.lit(0)).cast("bigint"))
    return judged.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), one("good").alias("good"), one("toxic").alias("toxic"))


def filter_orders(masks: DataFrame, names: str) -> DataFrame:
    """The audit of every order from (part, mask, n, good, toxic) rows; bit i
    of a mask stands for the i-th filter of ``names`` (in ascending order).

    One row per part, order and step, zeros included.
    """
    k = len(names)
    if not 0 < k <= MOST_FILTERS or sorted(set(names)) != list(names):
        raise ValueError(f"names are 1 to {MOST_FILTERS} different letters in ascending order")
    spark, ranks = masks.sparkSession, factorial(k)
    intervals = spark.createDataFrame(removal_intervals(k), "mask int, step int, first boolean, start int, end int")

    def at_ends(count: str, first: bool, name: str) -> Column:
        sign = F.when(F.col("first") == first, F.col("end.sign")).otherwise(F.lit(0))
        return F.sum(F.col(count) * sign).alias(name)

    # fixed by k: 2**k masks times the intervals of each
    ends = (masks.join(F.broadcast(intervals), "mask")
            .select("part", "step", "first", "n", "good", "toxic", F.explode(F.array(
                F.struct(F.col("start").alias("rank"), F.lit(1).alias("sign")),
                F.struct(F.col("end").alias("rank"), F.lit(-1).alias("sign")))).alias("end")))
    changes = (ends.groupBy("part", "step", F.col("end.rank").alias("rank"))
               .agg(at_ends("n", True, "removed"), at_ends("n", False, "redundant"), at_ends("good", True, "good_lost"),
                    at_ends("toxic", True, "toxic_lost")))

    alone = F.array(*[F.sum(F.when(F.col("mask") == 1 << i, F.col("n")).otherwise(F.lit(0))) for i in range(k)])
    grid = (masks.groupBy("part").agg(F.sum("n").alias("all"), alone.alias("alone"))
            .select("part", "all", "alone", F.explode(F.sequence(F.lit(0), F.lit(ranks - 1))).alias("rank"))
            .select("part", "all", "alone", "rank", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("step")))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(names)])
    totals = ("removed", "redundant", "good_lost", "toxic_lost")
    so_far = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    rows = (grid.join(changes, ["part", "step", "rank"], "left")
            .select("part", "all", "alone", "rank", "step",
                    *[F.sum(F.coalesce(F.col(c), F.lit(0))).over(so_far).cast("bigint").alias(c) for c in totals])
            .withColumn("filter_order", F.element_at(orders, F.col("rank") + 1))
            .withColumn("letter", F.expr("substring(filter_order, step, 1)")))
    steps = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return rows.select(
        "part", "filter_order", "step", (F.col("all") - F.sum("removed").over(steps)).cast("bigint").alias("kept"), "removed",
        "redundant", F.element_at("alone", F.instr(F.lit(names), F.col("letter"))).cast("bigint").alias("unique_fails"),
        "good_lost", "toxic_lost", F.sum("removed").over(Window.partitionBy("part", "letter")).cast("bigint").alias("shapley"))


def filter_audit(docs: DataFrame, labels: DataFrame, **columns) -> DataFrame:
    """Every order of the filters A to D and duplicates (E) over whole texts."""
    scratch = Scratch(docs.sparkSession, "filters")
    names = "".join(text_filters(F.lit(""))) + DUPLICATE
    return filter_orders(scratch.keep(document_masks(docs, labels, scratch, **columns), "masks"), names)


FILTER_AUDIT_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d),
l AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
      FROM labels GROUP BY doc_id),
f AS (SELECT w.doc_id, part, len(words) < 100 AS a, 100 * len(list_distinct(words)) < 80 * len(words) AS b,
        100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
        coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY t), false) AS e,
        coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
      FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
m AS (SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask, count(*) AS n,
        count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY ALL),
x AS (SELECT i, substr('ABCDE', i + 1, 1) AS letter FROM range(5) AS r(i)),
o AS (SELECT p.letter || q.letter || r.letter || s.letter || t.letter AS filter_order, [p.i, q.i, r.i, s.i, t.i] AS places
      FROM x p, x q, x r, x s, x t
      WHERE len(list_distinct([p.i, q.i, r.i, s.i, t.i])) = 5),
s AS (SELECT filter_order, k AS step, (1 << places[k])::INT AS own,
        list_sum(list_transform(places[1:k], lambda y: 1 << y))::INT - (1 << places[k])::INT AS before
      FROM o, range(1, 6) AS z(k)),
g AS (SELECT part, filter_order, step, own,
        coalesce(sum(n) FILTER (mask & (own | before) = 0), 0) AS kept,
        coalesce(sum(n) FILTER (mask & own <> 0 AND mask & before = 0), 0) AS removed,
        coalesce(sum(n) FILTER (mask & own <> 0 AND mask & before <> 0), 0) AS redundant,
        coalesce(sum(n) FILTER (mask = own), 0) AS unique_fails,
        coalesce(sum(good) FILTER (mask & own <> 0 AND mask & before = 0), 0) AS good_lost,
        coalesce(sum(toxic) FILTER (mask & own <> 0 AND mask & before = 0), 0) AS toxic_lost
      FROM m, s GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM g
"""
