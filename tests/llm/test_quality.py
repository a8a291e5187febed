"""Operator 7 against its SQL form and a plain loop."""

import random
import re
from collections import Counter

import duckdb

from tidewatch.llm.quality import QUALITY_SQL, clean_documents, line_fails, quality_report

SF = "/root/testdata/sf0.001"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = set()
    for i in range(len(w) - 2):
        if grams[w[i], w[i + 1], w[i + 2]] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
        seen.add(line)
    n = len(w)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def samples():
    r = random.Random(8)
    bits = ["a", "b", "C", "é", "日本", "##", "|", "word", "\n", "\n\n", " \t", "x", " ", "end.", "!!", "\x0b", "\x1c"]
    out = [r.choice(["", " "]).join(r.choice(bits) + r.choice(["", " "]) for _ in range(r.randint(0, 150))) for _ in range(300)]
    out += ["He kept a blog in Paris.\nPlease LOG IN.\néco cookie\nlog inn\n" + w * 39 + "end" + stop
            for w in ("शब्द ", "word ") for stop in ("", "।", "۔", "？", "…", ".")]
    return out + [None, "", " \n ", "same line here.\n" * 40, "w " * 40_000]


def test_base_measures_equal_plain_loop(spark):
    rows = list(enumerate(samples()))
    got = {r.doc_id: tuple(r[c] for c in BASE) for r in quality_report(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: base(t) for d, t in rows}


def test_equals_sql(spark):
    out = quality_report(spark.read.parquet(f"{SF}/documents.parquet")).drop("clean")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = con.execute(f"SELECT {', '.join(out.columns)} FROM ({QUALITY_SQL})").fetchall()
    assert sorted(map(tuple, out.collect())) == sorted(want)


def test_samples_equal_sql(spark):
    rows = [(d, t) for d, t in enumerate(samples()) if len(t or "") < 10_000]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = quality_report(df).drop("clean")
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    want = con.execute(f"SELECT {', '.join(out.columns)} FROM ({QUALITY_SQL})").fetchall()
    assert sorted(map(tuple, out.collect())) == sorted(want)


def test_line_rules_and_verdict(spark):
    fails = lambda s: line_fails(s, s.split())
    assert fails("Home | News | About") and fails("we use Cookies here.") and fails("BUY NOW AND SAVE MORE")
    assert fails("go! go! go! go! go!") and fails("w " * 30) and fails("a### b***")
    assert not fails("A plain sentence, with 10% of things & more words in it.") and not fails("NASA")
    # phrases are whole words, stops those of any script
    assert fails("Please log in first.") and fails("(Sign up) now.") and fails("ÉCOLE: cookie.")
    assert not fails("He kept a blog in Paris.") and not fails("A design uploaded here.") and not fails("Le cookié est cuit.")
    assert not fails("शब्द " * 39 + "अंत।") and not fails("كلمة " * 39 + "نهاية؟") and fails("शब्द " * 39 + "अंत")
    text = " ".join(f"Sentence{i} says{i} thing{i} of note{i}." for i in range(20))
    rows = [(1, text + "\nHome | News | About", "x"), (2, "\n".join(f"One{i} | two{i} | three{i}" for i in range(40)) + "\nEnd.", "y"),
            (3, None, "z"), (None, text, "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = {r.doc_id: (r.kept, r.clean) for r in quality_report(df).collect()}
    assert got[1] == (True, text) and got[2][0] is False and got[3][0] is False and got[None] == (True, text)
    out = clean_documents(df)
    assert out.columns == df.columns
    assert sorted((r.text, r.kept) for r in out.collect()) == [(text, "n"), (text, "x")]


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string, n_words long")
    assert quality_report(df).collect() == [] and clean_documents(df).collect() == []
