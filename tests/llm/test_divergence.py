"""Operator 12 against its SQL form and plain counting."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from tidewatch.llm import divergence as D

SF = "/root/testdata/sf0.001"
COLUMNS = ("lang", "source", "part", "item", "value", "rank")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute(rows, least=10, top=10):
    rows = [(x or "", lang or "", source or "") for x, lang, source in rows]
    groups, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        own = terms_of(text)
        groups[lang, source].update(own)
        docs[lang].update(set(own))
    out = []
    for lang in {k[0] for k in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        sources = sorted(s for x, s in groups if x == lang)
        total = {s: sum(groups[lang, s][t] for t in kept) for s in sources}
        whole = {t: sum(groups[lang, s][t] for s in sources) for t in kept}

        def p(n, of):
            return 1 + 10 ** 9 * (n + 2) // (of + 2 * len(kept))

        def f(a, b):
            return (a - b) ** 2 // (a + b)
        share = {s: {t: p(groups[lang, s][t], total[s]) for t in kept} for s in sources}
        mean = {t: p(whole[t], sum(whole.values())) for t in kept}
        for s in sources:
            pairs = [(o, sum(f(share[s][t], share[o][t]) for t in kept)) for o in sources if o != s]
            more = [(t, f(share[s][t], mean[t])) for t in kept if groups[lang, s][t] and share[s][t] > mean[t]]
            for part, items, limit in (("pair", pairs, None), ("term", more, top)):
                for rank, (item, value) in enumerate(sorted(items, key=lambda x: (-x[1], x[0].encode()))[:limit], 1):
                    out.append((lang, s, part, item, value, rank))
    return sorted(out)


def got(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def sample():
    r = random.Random(5)
    words = ["a", "The", "the", "ÉTÉ", "été", "日本語テキスト", "eightchr", "ninechars", "sixteen" * 2 + "ab", "seventeenletters" + "x",
             "x" * 32, "x" * 33, "x" * 70, "ab1cd", "don't", "[z]", "`q`", "Ünï", "naïve-text", "\x00nul\x01", "K", "ſ", "é" * 9]
    rows = []
    for i in range(240):
        text = r.choice(["", " ", ", "]).join(r.choice(words) + r.choice(["", " ", "\n", "7"]) for _ in range(r.randint(0, 30)))
        rows.append((text, r.choice(["en", "en", "de", None, ""]), r.choice(["s1", "s2", "s3", "é", None])))
    rows += [(None, "en", "s9"), ("", "xx", "only"), ("few words here", "zz", "a"), ("other words", "zz", "b")]
    return rows + [("the " * 30_000 + "y" * 5000, "en", "s1")] + [("same text again", "de", "s2")] * 12


def test_equals_brute_force(spark):
    rows = sample()
    df = spark.createDataFrame([(i, *x, "t", 4) for i, x in enumerate(rows)], "doc_id long, text string, lang string, source string, term string, n int")
    assert got(D.source_divergence(df)) == brute(rows)


def test_equals_sql(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({D.DIVERGENCE_SQL})").fetchall()
    assert got(D.source_divergence(docs)) == sorted(want)


def test_radix_order_is_stable():
    r = np.random.default_rng(1)
    a, b = r.integers(0, 5, 3000).astype(np.uint64), r.integers(0, 2 ** 64, 3000, dtype=np.uint64) >> np.uint64(3)
    b[::7] = 9
    assert (D.radix_order([a, b]) == np.lexsort((np.arange(3000), a, b))).all()
    assert D.radix_order([np.zeros(0, dtype=np.uint64)]).tolist() == []


@pytest.mark.parametrize("limit", [1, 50, 1 << 20])
def test_counts_do_not_depend_on_slices(limit, monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(D, "SLICE", limit)
    rows = sample()
    batch = pa.RecordBatch.from_pydict({"lang": [x[1] or "" for x in rows], "source": [x[2] or "" for x in rows], "text": [x[0] for x in rows]})
    n, docs, want, in_docs = Counter(), Counter(), Counter(), Counter()
    for b in D._count(iter([batch])):
        for x in b.to_pylist():
            n[x["lang"], x["source"], x["term"]] += x["n"]
            docs[x["lang"], x["source"], x["term"]] += x["docs"]
    for text, lang, source in rows:
        own = [(lang or "", source or "", t) for t in terms_of(text)]
        want.update(own)
        in_docs.update(set(own))
    assert n == want and docs == in_docs


def test_shares_beyond_64_bits():
    n = np.array([0, 5, 10 ** 13, 2 ** 62], dtype=np.int64)
    assert D.shares(n, np.array(2 ** 62), 7).tolist() == [1 + 10 ** 9 * (int(x) + 2) // (2 ** 62 + 14) for x in n]


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert D.source_divergence(df).collect() == []
