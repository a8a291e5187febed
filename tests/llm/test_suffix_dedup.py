"""Operator 3 against brute force."""

import hashlib
import random

import numpy as np
import pytest

from tidewatch.llm.suffix_dedup import long_prefix_classes, remove_repeats


def brute(rows, length):
    seen, out = set(), {}
    for doc, text in sorted(rows):
        b = (text or "").encode()
        gone = np.zeros(len(b) + 1, dtype=bool)
        for s in range(len(b) - length + 1):
            x = b[s:s + length]
            if x in seen:
                gone[s:s + length] = True
            seen.add(x)
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + gone[0])
        out[doc] = (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed, n=120):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 6)))
    para = lambda k: " ".join(word() for _ in range(k))
    shared = [para(40) for _ in range(6)]
    line = para(14)
    rows = []
    for d in range(n):
        parts = []
        for _ in range(r.randint(0, 5)):
            parts.append(r.choice([para(25), r.choice(shared), line, r.choice(shared)[7:150]]))
        rows.append((d, " ".join(parts)))
    rows += [(n, rows[3][1]), (n + 1, rows[3][1]), (n + 2, None), (n + 3, ""), (n + 4, "a" * 700),
             (n + 5, "xyz" * 400), (n + 6, "x" * 99)]
    return rows


def result(df, **kw):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(df, **kw).collect()}


@pytest.mark.parametrize("length,gram,hot", [(100, 32, 2000), (100, 32, 1), (40, 16, 2000), (40, 16, 2)])
def test_equals_brute_force(spark, length, gram, hot):
    rows = corpus(length + hot)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert result(df, length=length, gram=gram, hot=hot) == brute(rows, length)


def test_one_document_of_many_slices(spark):
    r = random.Random(1)
    text = "".join(r.choice("abcdefgh ") for _ in range(150_000))
    rows = [(1, text + text[500:90_000]), (2, "z" * 50 + text[1000:1200])]
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows, 100)


def test_null_ids_repeated_rows_and_empty(spark):
    schema = "doc_id long, text string, a string, n_bytes long"
    assert result(spark.createDataFrame([], schema)) == {}
    t = "word " * 10 + "".join(chr(97 + i % 23) + str(i) for i in range(60))
    rows = [(5, t, "x", 1), (5, t, "x", 1), (None, t, "y", 2)]
    got = remove_repeats(spark.createDataFrame(rows, schema)).collect()
    assert sorted(r.n_removed for r in got) == [0, 0, 0]


def test_classes_by_interval_expansion():
    r = random.Random(2)
    text = np.array([r.choice([1, 2, 3]) for _ in range(3000)] + [0], dtype=np.uint16)
    text[700:900] = text[100:300]
    for length in (1, 5, 12, 60):
        order, cls = long_prefix_classes(text, length)
        twice = np.concatenate([text, text])
        word = [tuple(twice[p:p + length]) for p in order]
        assert all((word[i] == word[i - 1]) == (cls[i] == cls[i - 1]) for i in range(1, len(word)))
