"""Terms counted inside tasks against the rows of one term each."""

import random
from collections import Counter

import pyarrow as pa

from tidewatch.functions import terms as TM
from tidewatch.operators import network as N
from tidewatch.operators import topics as TP

STOPS = ["the", "of"]


def plain(rows):
    out = Counter()
    for group, text in rows:
        words = [w for w in (text or "").split(" ") if len(w.encode("utf-16-le")) >= 4 and w not in STOPS]
        out.update((group, w) for w in words)
        out.update((group, f"{a} {b}") for a, b in zip(words, words[1:]))
    return out


def rows_of(n, seed=5):
    r = random.Random(seed)
    words = ["ab", "cd", "the", "of", "x", "", "é", "日本", "😀", "long" * 9, "ef"]
    return [(r.choice(["p", "q", None, ""]), r.choice([None, "", " ".join(r.choices(words, k=r.randint(0, 30)))])) for _ in range(n)]


def test_task_sums_over_slices_and_restarts(monkeypatch):
    rows = rows_of(200)
    for size, held in ((1 << 20, 1 << 21), (16, 4), (17, 50)):
        monkeypatch.setattr(TM, "SLICE", size)
        monkeypatch.setattr(TM, "HELD_KEYS", held)
        sums, got, parts = TM.TermSums(STOPS), Counter(), 0

        def take(out):
            for values, terms, counts in out:
                for g, t, c in zip(values, terms.to_pylist(), counts):
                    got[g, t] += int(c)
        for start in range(0, len(rows), 50):
            part = rows[start:start + 50]
            take(sums.add(pa.array([t for _, t in part], pa.string()), pa.array([g for g, _ in part], pa.string())))
        take(sums.flush())
        assert got == plain(rows)


def test_equals_a_row_per_term(spark):
    rows = rows_of(300, 6)
    df = spark.createDataFrame(rows, "topic string, clean_text string").repartition(3)
    want = Counter((r.topic, r.term) for r in N.record_terms(df, stop_words=STOPS).collect())
    assert want == plain(rows)
    assert {(r.topic, r.term): r.tf for r in N.term_counts(df, "topic", stop_words=STOPS).collect()} == want
    named = {k: n for k, n in want.items() if k[0] is not None}
    assert {(r.topic, r.term): r.tf for r in N.topic_term_counts(df, stop_words=STOPS).collect()} == named
    totals = Counter()
    for (_, term), n in want.items():
        totals[term] += n
    assert {r.term: r.tf for r in N.term_counts(df, stop_words=STOPS).collect()} == totals
    assert N.term_counts(df.limit(0), "topic").count() == 0


def test_no_row_per_occurrence(spark):
    """A task hands on its sums; a row per token and bigram made the shuffle's input grow with the texts."""
    df = spark.createDataFrame([("p", 1, "ab cd ab")], "topic string, cluster int, clean_text string")
    for out in (N.topic_term_counts(df), N.term_counts(df, "cluster")):
        assert "Generate" not in out._jdf.queryExecution().toString()
    assert TP.class_tfidf(df).first().cluster == 1


def numbered(rows, stops=STOPS):
    sums, got = TM.TermSums(stops), Counter()
    texts = pa.array([None] + [t for _, t in rows], pa.string()).slice(1)   # an array that begins inside its buffers
    for part in (*sums.add(texts, pa.array([g for g, _ in rows], pa.string())), *sums.flush()):
        for g, t, c in zip(*part):
            got[g, t.as_py()] += int(c)
    return got


def test_words_of_every_length(monkeypatch):
    """Words of one or two integers, longer ones, words that share a slot, and bytes 0."""
    r = random.Random(7)
    words = ["abcdefghijklmnopqrstuvwxyz"[:n] for n in range(1, 21)] + ["abcdefgh" + x for x in "xyz"] + ["é" * n for n in range(1, 10)]
    words += ["the", "of", "日本", "😀"] + ["".join(r.choices("abcd", k=r.randint(2, 12))) for _ in range(300)]
    rows = [(r.choice("pq"), " ".join(r.choices(words, k=40))) for _ in range(100)] + [("p", ""), ("q", " a  ab "), ("p", None)]
    for bits in (1, 4, 19):
        monkeypatch.setattr(TM, "SLOT_BITS", bits)
        assert numbered(rows) == plain(rows)
    rows.append(("p", "ab\0 ab ab\0\0 abcdefghi\0 abcdefghi"))
    assert numbered(rows) == plain(rows)


def test_known_words_cost_no_look_up():
    """Each slice used to hash all its tokens and to look each of its words up once more."""
    sums = TM.TermSums(STOPS)
    texts = pa.array(["many words and a few more"] * 5, pa.string())
    list(sums.add(texts))
    sums.words.one = None   # a look-up would fail
    list(sums.add(texts))
    assert sum(int(n) for _, _, counts in sums.flush() for n in counts) == 10 * (5 + 4)
