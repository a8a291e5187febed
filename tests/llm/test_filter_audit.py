"""Operator 13 against its SQL form and a loop over all orders."""

import random
import re
from collections import Counter
from itertools import permutations

import duckdb
import pytest
from pyspark.sql import functions as F

from tidewatch.llm.filter_audit import FILTER_AUDIT_SQL, filter_audit, filter_orders, lehmer_rank, removal_intervals

SF = "/root/testdata/sf0.001"
COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def brute(rows, labels):
    """Every order applied to every document."""
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, t in labels if d is not None and t == 1}
    docs = []
    for doc_id, text, lang in rows:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        smaller = doc_id is not None and any(o is not None and o < doc_id and (t or "") == text for o, t, _ in rows)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
                 "D": bool(re.search(r"[#$%&*|]", text)), "E": smaller}
        docs.append((lang or "", {k for k, v in fails.items() if v}, doc_id in good, doc_id in toxic))
    out, shapley = [], Counter()
    for part in {p for p, *_ in docs}:
        own = [d for d in docs if d[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, letter in enumerate(order, 1):
                removed = [d for d in left if letter in d[1]]
                left = [d for d in left if letter not in d[1]]
                shapley[part, letter] += len(removed)
                out.append((part, order, step, len(left), len(removed), sum(letter in d[1] for d in own) - len(removed),
                            sum(d[1] == {letter} for d in own), sum(d[2] for d in removed), sum(d[3] for d in removed)))
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def got(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_equals_brute_force(spark):
    r = random.Random(3)
    texts = [None, "", " \t\n", "A", "#", "word " * 120, "Ünï çødé " * 60, "X" * 50_000,
             " ".join(f"w{i}" for i in range(150)), " ".join(f"w{i}" for i in range(150)) + " & UP UP", "a\x0bb\x0cc\rd " * 40, "a b " * 101]
    rows = [(i, r.choice(texts), r.choice(["en", "de", None, ""])) for i in range(160)]
    rows += [(5, "again", "en"), (5, "again", "en"), (7, "again", "fr"), (None, "again", "en"), (None, "alone", "en"), (4, "again", None)]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1, None])) for i in range(0, 160, 2)] + [(2, 1, 1), (None, 1, 1), (999, 1, 1)]
    docs = spark.createDataFrame([(*x, "E", 3) for x in rows], "doc_id long, text string, lang string, part string, mask int")
    marks = spark.createDataFrame([(*x, "z") for x in labels], "doc_id long, quality int, toxic int, digest string")
    assert got(filter_audit(docs, marks)) == brute(rows, labels)


def test_equals_sql(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    con = duckdb.connect()
    for n in ("documents", "labels"):
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{SF}/{n}.parquet')")
    want = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({FILTER_AUDIT_SQL})").fetchall()
    assert got(filter_audit(docs, labels)) == sorted(want) and len(want) % 600 == 0


@pytest.mark.parametrize("k", [1, 2, 3, 4, 5])
def test_intervals_cover_each_order_once(k):
    orders = list(permutations(range(k)))
    assert [lehmer_rank(o, k) for o in orders] == list(range(len(orders)))
    cover = Counter((mask, step, first, r) for mask, step, first, lo, hi in removal_intervals(k) for r in range(lo, hi))
    want = Counter()
    for r, order in enumerate(orders):
        for mask in range(1 << k):
            seen = False
            for step, item in enumerate(order, 1):
                if mask >> item & 1:
                    want[mask, step, not seen, r] += 1
                    seen = True
    assert cover == want


def test_other_filters_and_empty(spark):
    masks = spark.createDataFrame([("p", 0, 4, 0, 0), ("p", 3, 2, 1, 0), ("p", 2, 1, 0, 1)], "part string, mask int, n long, good long, toxic long")
    rows = {(r.filter_order, r.step): r.asDict() for r in filter_orders(masks, "XY").collect()}
    assert len(rows) == 4 and rows["XY", 1]["removed"] == 2 and rows["XY", 2]["removed"] == 1 and rows["XY", 2]["redundant"] == 2
    assert rows["YX", 1]["kept"] == 4 and rows["YX", 2]["removed"] == 0 and rows["YX", 2]["shapley"] == 2
    with pytest.raises(ValueError):
        filter_orders(masks, "YX")
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit(docs, labels).collect() == []
    assert filter_audit(docs.unionByName(spark.createDataFrame([(1, None, None)], docs.schema)), labels).where(F.col("removed") > 0).count() == 120
