"""X3 on one row per record against plain counting."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidewatch.functions import terms as TM
from tidewatch.operators import topics as TP

STOPS = ["the", "of"]


def words_of(text):
    return [w for w in (text or "").split(" ") if len(w.encode("utf-16-le")) >= 4 and w not in STOPS]


def terms_of(text):
    words = words_of(text)
    return Counter(words) + Counter(f"{a} {b}" for a, b in zip(words, words[1:]))


def texts(n, seed):
    r = random.Random(seed)
    words = ["ab", "cd", "the", "of", "x", "", "é", "日本", "long" * 9, "ef", "abcdefghi", "gh"]
    return [r.choice([None, "", *[" ".join(r.choices(words, k=r.randint(1, 30)))] * 8]) for _ in range(n)]


def test_vocabulary_counts(monkeypatch):
    rows, vocab = texts(150, 1), ["cd", "ab", "ab cd", "日本 ab", "never seen", "abcdefghi", "x", "cd x", "the", "gh gh"]
    for size in (1 << 20, 7, 40):
        monkeypatch.setattr(TM, "SLICE", size)
        sizes, index, n = TM.VocabularyCounts(STOPS, vocab).add(pa.array(rows, pa.string()))
        ends = np.cumsum(sizes)
        for text, a, b in zip(rows, ends - sizes, ends):
            want = terms_of(text)
            assert dict(zip((vocab[i] for i in index[a:b]), n[a:b])) == {t: want[t] for t in vocab if want[t]}
            assert list(index[a:b]) == sorted(index[a:b])
    for rows, vocab in (([], vocab), ([None, "ab"], [])):
        sizes, index, n = TM.VocabularyCounts(STOPS, vocab).add(pa.array(rows, pa.string()))
        assert len(sizes) == len(rows) and not len(index) and not len(n)


@pytest.mark.parametrize("ids", ["unique", "repeated"])
def test_weights_of_records(spark, ids):
    """Records of one id are one document; those without an id count in the frequencies, as one."""
    rows = [(i if ids == "unique" else (None if i % 9 == 0 else i % 40), t) for i, t in enumerate(texts(120, 2))]
    df = spark.createDataFrame(rows, "doc_id long, clean_text string").repartition(3)
    vocab = TP.corpus_vocabulary(df, cap=12, stop_words=STOPS)
    counts = TP.doc_term_counts(df, stop_words=STOPS, vocab=vocab)
    got = {(r.doc_id, r.term): r.weight for r in TP.record_tfidf(counts, docs=df, vocab=vocab).collect()}
    docs = {}
    for i, t in rows:
        docs.setdefault(i, Counter()).update(terms_of(t))
    known = {r.term: r.term_index for r in vocab.collect()}
    frequency = Counter(t for c in docs.values() for t in c if t in known)
    want = {}
    for i, c in docs.items():
        w = {t: n * (math.log((1 + len(rows)) / (1 + frequency[t])) + 1) for t, n in c.items() if t in known}
        if i is not None:
            want |= {(i, t): x / math.sqrt(sum(v * v for v in w.values())) for t, x in w.items()}
    assert got == pytest.approx(want) and len(known) == 12
    packed = TP.record_tfidf(counts, docs=df, vocab=vocab, packed=True)
    flat = TP.record_tfidf(counts, docs=df, vocab=vocab)
    assert np.allclose(TP.lsa_embedding(packed)[2], TP.lsa_embedding(flat)[2])


def test_no_row_per_occurrence_and_no_shuffle_of_weights(spark):
    """A row per token and bigram was made, and every weight was moved by its document and back."""
    df = spark.createDataFrame([(1, "ab cd ab"), (2, "cd ef")], "doc_id long, clean_text string")
    vocab = TP.corpus_vocabulary(df)
    counts = TP.doc_term_counts(df, vocab=vocab)
    plan = TP.record_tfidf(counts, docs=df, vocab=vocab)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert "Generate" not in TP.doc_term_counts(df)._jdf.queryExecution().toString()


def test_no_records(spark):
    df = spark.createDataFrame([], "doc_id long, clean_text string")
    vocab = TP.corpus_vocabulary(df)
    assert TP.record_tfidf(TP.doc_term_counts(df, vocab=vocab), docs=df, vocab=vocab).count() == 0
