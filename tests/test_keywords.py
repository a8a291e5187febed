"""The keyword automaton against one pass per keyword."""

import random
import time

from pyspark.sql import functions as F

from tidewatch.functions import keywords as KW
from tidewatch.functions.text import count_occurrences


def test_equals_one_pass_per_keyword(spark):
    r = random.Random(4)
    text = lambda n: "".join(r.choice(["a", "b", "ab", "é", "日", " ", "aa"]) for _ in range(n))
    groups = [["a", "aa", "ab"], ["é", "日é", "", "aa"], [], ["bab", "a a", "aa", "aa"]]
    texts = [None, ""] + [text(r.randint(0, 40)) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = df.select("i", KW.first_group(F.col("t"), groups).alias("f"), KW.distinct_hits(F.col("t"), groups).alias("d"),
                    KW.occurrences(F.col("t"), groups).alias("o")).collect()
    for row in got:
        t = texts[row.i] or ""
        hit = [[bool(w) and w in t for w in g] for g in groups]
        assert row.f == next((g for g, h in enumerate(hit) if any(h)), None)
        assert row.d == [len({w for w in g if w and w in t}) for g in groups]
        assert row.o == [sum(t.count(w) for w in g if w) for g in groups]
    some = df.where("i > 1").select("i", count_occurrences("t", "aa").alias("n")).collect()
    assert {x.i: x.n for x in some} == {i: t.count("aa") for i, t in enumerate(texts) if i > 1}


def test_sums_and_no_keywords(spark):
    df = spark.createDataFrame([("x", "art artist"), ("x", "smart"), ("y", None)], "topic string, t string")
    hits = KW.occurrences(F.col("t"), [["art"], ["artist"]])
    out = df.groupBy("topic").agg(F.sum(F.get(hits, F.lit(0))).alias("a"), F.sum(F.get(hits, F.lit(1))).alias("b")).collect()
    assert {(r.topic, r.a, r.b) for r in out} == {("x", 3, 1), ("y", 0, 0)}
    assert [r.f for r in df.select(KW.first_group(F.col("t"), []).alias("f")).collect()] == [None] * 3


def test_a_hundred_thousand_terms(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", F.lower("text").alias("t"))
    groups = [[f"{a}{i}" for i in range(20_000)] for a in ("the ", "zz", "tion", "q", "ing the ")]
    groups[3][0], groups[4][0] = "que ", "ing the"
    t0 = time.time()
    got = {r.doc_id: r.f for r in docs.select("doc_id", KW.first_group(F.col("t"), groups).alias("f")).collect()}
    assert time.time() - t0 < 30
    for r in docs.collect():
        want = 3 if "que " in r.t else 4 if "ing the" in r.t else None
        assert got[r.doc_id] == want or got[r.doc_id] < (want if want is not None else 5)


def test_genre_summary_reads_only_what_the_genre_needs(spark):
    """Without partials neither sentiment nor image features are computed for genre counts."""
    from tidewatch.operators import modal as M
    df = spark.createDataFrame([("p", "a", "s", 0.5), ("p", "a", None, 0.1), ("p", None, "s", 0.1), (None, "a", "s", 0.1), ("q", "b", "s", None)],
                               "topic string, audio_genre_label string, source string, x double")
    full = df.select("*", *[F.raise_error(F.lit("not needed")).cast("double").alias(c) for c in M.MODAL_MEANS])
    got = [tuple(r) for r in M.audio_genre_summary(full).collect()]
    assert got == [("p", "a", 2, 1.0), ("q", "b", 1, 1.0)]


def test_keywords_that_overlap_themselves():
    m = KW.Matcher([["aa", "aba"], ["b", "aa"]])
    for text in ("aaaaa", "ababababa", "", "aabaab", "xaaabax"):
        assert m.counts(text) == [text.count("aa") + text.count("aba"), text.count("b") + text.count("aa")]


def test_few_keywords_are_searched_one_by_one(monkeypatch):
    """Either way gives the same numbers; for a few keywords the automaton, which makes an object of every occurrence, stays idle."""
    r = random.Random(9)
    groups = [["ab", "b", "aba", ""], ["aa", "ab"], [], ["日", "aab"]]
    texts = [None, ""] + ["".join(r.choice("ab日 ") for _ in range(r.randint(0, 60))) for _ in range(200)]
    few = KW.Matcher(groups)
    with monkeypatch.context() as m:
        m.setattr(KW, "FEW", 0)
        want = [(few.distinct(t), few.counts(t)) for t in texts]
    few.automaton = None
    assert [(few.distinct(t), few.counts(t)) for t in texts] == want
    assert KW.Matcher([]).counts("ab") == [] and KW.Matcher([[""]]).distinct("ab") == [0]
