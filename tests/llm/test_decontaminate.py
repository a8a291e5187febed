"""Operator 1 against brute force alignment."""

import random
import re

import numpy as np
import pytest

from tidewatch.llm.decontaminate import contaminated, drop_contaminated, smith_waterman


def words(text):
    return re.findall(r"[A-Za-z0-9\x80-\U0010ffff]+", (text or "").lower())


def local_score(a, b):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(max(0, row[j - 1] + (2 if x == y else -1), row[j] - 1, new[-1] - 1))
        row = new
        best = max(best, max(row))
    return best


def corpus():
    r = random.Random(6)
    vocab = [f"w{i}" for i in range(2900)] + [f"é{i}ö" for i in range(100)]
    items = [(i, " ".join(r.choice(vocab) for _ in range(r.choice([2, 8, 30, 45])))) for i in range(12)]
    items += [(12, " ".join(r.choice(vocab) for _ in range(700))), (13, None), (14, "..."), (None, "w1 w2 w3 w4"), (15, items[3][1])]
    rows = []
    for d in range(120):
        w = [r.choice(vocab) for _ in range(r.randint(0, 120))]
        if d % 3 == 0:
            x = words(r.choice(items)[1] or "")
            for _ in range(len(x) // r.choice([4, 8, 100])):
                k = r.randrange(len(x))
                x[k:k + 1] = r.choice([[], [r.choice(vocab)], [x[k], r.choice(vocab)]])
            at = r.randint(0, len(w))
            w[at:at] = [t.upper() + r.choice(["", ",", "!"]) for t in x]
        rows.append((d, " ".join(w)))
    return rows + [(200, None), (201, ""), (None, items[3][1])], items


@pytest.mark.parametrize("block_words", [1_000_000, 60])
def test_pairs_equal_brute_force(spark, block_words):
    rows, items = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in contaminated(docs, bench, block_words=block_words).collect()}
    want = {}
    for d, t in rows:
        for i, b in items:
            x = words(b)
            if d is None or i is None or not x:
                continue
            s = sum(local_score(x[a:a + 256], words(t)) for a in range(0, len(x), 256)) / (2 * len(x))
            if s >= 0.4:
                want[d, i] = s
    # a pair can only be missed if no run of three item words survived the edits
    for pair in set(want) - set(got):
        x, y = words(dict(items)[pair[1]]), words(dict(rows)[pair[0]])
        runs = {tuple(y[k:k + 3]) for k in range(len(y))}
        assert len(x) < 3 or not any(tuple(x[k:k + 3]) in runs for k in range(len(x) - 2))
    assert set(got) <= set(want) and len(got) > 25
    assert all(got[p] == pytest.approx(want[p]) for p in got)


def test_alignment_positions():
    x = np.array([1, 2, 3, 4])
    y = np.array([9, 9, 1, 2, 8, 3, 4, 9])
    assert smith_waterman([x, np.array([7])], [y, y]) == [(7, 2, 7), (0, 0, 0)]


def test_drop_keeps_clean_documents_and_columns(spark):
    item = " ".join(f"q{i}" for i in range(30))
    docs = spark.createDataFrame([(1, f"x {item} y", "a"), (2, "clean text", "b"), (None, item, "c")],
                                 "doc_id long, text string, score string")
    bench = spark.createDataFrame([(5, item)], "item_id long, text string")
    out = drop_contaminated(docs, bench)
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == {2, None}
    none = spark.createDataFrame([], "item_id long, text string")
    assert drop_contaminated(docs, none).count() == 3
    assert contaminated(docs.limit(0), bench).collect() == []
