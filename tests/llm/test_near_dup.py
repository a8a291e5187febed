"""Operator 5 against brute force."""

import random
import re

import pytest

from tidewatch.llm import kernels as K
from tidewatch.llm.near_dup import estimate, near_duplicates, shingle_sets

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1)))


def brute(rows, size, percent=80):
    sets = {d: shingle_set(t, size) for d, t in rows}
    comp = {d: d for d in sets}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                ra, rb = find(a), find(b)
                comp[max(ra, rb)] = min(ra, rb)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


def corpus(seed, n=260):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)] + ["É", "naïve", "x" * 40]
    base = [[r.choice(vocab) for _ in range(r.choice([1, 2, 3, 8, 30, 60]))] for _ in range(25)]
    phrase = [f"common{i}" for i in range(12)]
    rows = []
    for d in range(n):
        w = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 2, 4])):
            w[r.randrange(len(w))] = r.choice(vocab)
        if r.random() < 0.3:
            w = phrase + w
        rows.append((d, r.choice([" ", "\n", "\t ", "  "]).join(w).upper() if r.random() < 0.2 else " ".join(w)))
    rows += [(n, None), (n + 1, ""), (n + 2, " \n\t"), (n + 3, "solo"), (n + 4, "SOLO"), (n + 5, "long " * 5000)]
    return rows


@pytest.mark.parametrize("size,short", [(2, 32), (2, 3), (5, 4)])
def test_components_equal_brute_force(spark, size, short):
    rows = corpus(size * 10 + short)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept)
           for r in near_duplicates(df, shingle=size, short_list=short, block=16).collect()}
    assert got == brute(rows, size)


def test_large_group_of_near_copies(spark):
    r = random.Random(5)
    base = [f"t{i}" for i in range(80)]
    rows = []
    for d in range(300):
        w = list(base)
        for _ in range(r.choice([1, 2, 5, 9])):
            w[r.randrange(80)] = f"u{r.randrange(10**6)}"
        rows.append((d, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: (x.n_shingles, x.component_id, x.kept) for x in near_duplicates(df, shingle=2, short_list=8, block=40).collect()}
    assert got == brute(rows, 2)


@pytest.mark.parametrize("size,short", [(2, 32), (2, 2), (5, 32)])
def test_short_texts_with_a_word_more(spark, size, short):
    r = random.Random(size + short)
    rows = []
    for n in (size + 1, size + 2, size + 3, size + 4):
        for k in range(6):
            w = [f"s{n}x{k}y{i}" for i in range(n)]
            rows += [" ".join(w), " ".join([*w, "more"]), " ".join([*w, "other"]), " ".join(["first", *w])]
    r.shuffle(rows)
    rows = list(enumerate(rows))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: (x.n_shingles, x.component_id, x.kept) for x in near_duplicates(df, shingle=size, short_list=short, block=4).collect()}
    assert got == brute(rows, size)


def test_empty_table_and_extra_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string, n long, kept string")
    assert near_duplicates(df).collect() == []
    df = spark.createDataFrame([(1, "a b c d e f", 3, "x"), (1, "a b c d e f", 3, "x"), (None, "a b", 1, "y")],
                               "doc_id long, text string, n long, kept string")
    got = sorted(near_duplicates(df).collect(), key=str)
    assert [(r.doc_id, r.component_id) for r in got] == [(1, 1), (1, 1), (None, None)]


def test_kernel_words_match_regex():
    import pyarrow as pa
    texts = ["Ab cd\x0bé", "", None, "  x y ", "z"]
    raw, off = K.text_buffers(pa.array(texts))
    sizes = []
    for i, j in K.slices(off, 4):
        _, first = K.words_of(raw, off, i, j)
        sizes += [b - a for a, b in zip(first[:-1], first[1:])]
    assert sizes == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
    sets = [len(s) for s in shingle_sets(raw, off, 2)]
    assert sets == [len(shingle_set(t, 2)) for t in texts]


def test_estimate_is_exact_on_small_sets():
    import numpy as np
    a, b = np.arange(0, 50, dtype=np.uint32), np.arange(10, 60, dtype=np.uint32)
    assert estimate(a.tobytes(), b.tobytes()) == pytest.approx(40 / 60)
