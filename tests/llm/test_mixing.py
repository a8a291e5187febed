"""Operator 4 against the SQL form and the target weights."""

import math
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tidewatch.llm.mixing import MIX_SQL, mix_sources, poisson_count, source_rates

SF = "/root/testdata/sf0.01"


def test_equals_sql(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = mix_sources(docs)
    assert out.columns == [*docs.columns, "copy", "mix_key"]
    got = sorted((r.doc_id, r.copy, r.mix_key) for r in out.select("doc_id", "copy", "mix_key").collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = sorted(con.execute(f"SELECT doc_id, copy, mix_key FROM ({MIX_SQL.format(docs='documents')})").fetchall())
    assert got == want


def test_poisson_inverse(spark):
    u = [0.0, 0.1, 0.3678, 0.3679, 0.5, 0.7357, 0.7358, 0.9999999]
    df = spark.createDataFrame([(x, lam) for x in u for lam in (0.01, 1.0, 8.0)], "u double, lam double")
    for r in df.select("u", "lam", poisson_count(F.col("u"), F.col("lam")).alias("n")).collect():
        cdf, term, n = math.exp(-r.lam), math.exp(-r.lam), 0
        while cdf <= r.u and term > 1e-17:
            n += 1
            term *= r.lam / n
            cdf += term
        assert abs(r.n - n) <= 0, r


def test_shares_reach_the_target(spark):
    rows = [(d, "x" * 100, "big" if d < 6000 else "small") for d in range(8000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    rates = {r.source: r.rate for r in source_rates(docs, {"big": 1, "small": 1}).collect()}
    assert rates == {"big": pytest.approx(2 / 3), "small": pytest.approx(2.0)}
    n = Counter(r.source for r in mix_sources(docs, {"big": 1, "small": 1}).collect())
    assert abs(n["big"] - 4000) < 250 and abs(n["small"] - 4000) < 250


def test_high_rates_follow_the_distribution(spark):
    u = [0.0, 1e-9, 0.1, 0.5, 0.9, 0.999999, 1 - 1e-9]
    df = spark.createDataFrame([(x, lam) for x in u for lam in (20.0, 40.0, 500.0, 1500.0)], "u double, lam double")
    for r in df.select("u", "lam", poisson_count(F.col("u"), F.col("lam")).alias("n")).collect():
        cdf, n = math.exp(-r.lam), 0
        while cdf <= r.u:
            n += 1
            cdf += math.exp(n * math.log(r.lam) - r.lam - math.lgamma(n + 1))
        assert r.n == n


def test_small_source_reaches_its_target(spark):
    # 0.1 % of the characters, half of the target
    rows = [(d, "x" * 100, "big" if d < 9990 else "small") for d in range(10_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    rates = {r.source: r.rate for r in source_rates(docs).collect()}
    assert rates == {"big": pytest.approx(5000 / 9990), "small": pytest.approx(500.0)}
    n = Counter(r.source for r in mix_sources(docs).select("source").collect())
    assert abs(n["big"] - 5000) < 250 and abs(n["small"] - 5000) < 350
    capped = {r.source: r.rate for r in source_rates(docs, max_rate=8.0).collect()}
    assert capped["small"] == 8.0


def test_high_rates_equal_sql(spark):
    # rates of about 0.51, 17, 101 and 760; a source without text, one that is null
    sizes = {"big": (1500, 200), "mid": (50, 180), None: (30, 50), "small": (2, 100), "blank": (3, 0)}
    rows, d = [], 0
    for source, (n, length) in sizes.items():
        for _ in range(n):
            rows.append((d, "x" * length, "en", source, length))
            d += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert max(r.rate for r in source_rates(docs).collect()) > 300
    got = sorted((r.doc_id, r.copy, r.mix_key) for r in mix_sources(docs).select("doc_id", "copy", "mix_key").collect())
    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"source": object}))
    want = sorted(con.execute(f"SELECT doc_id, copy, mix_key FROM ({MIX_SQL.format(docs='documents')})").fetchall())
    assert got == want and len(got) > 1500


def test_edges(spark):
    schema = "doc_id long, text string, source string, copy string, rate int"
    assert mix_sources(spark.createDataFrame([], schema)).collect() == []
    docs = spark.createDataFrame([(1, "abc", "a", "q", 1), (1, "abc", "a", "q", 1), (None, None, None, "q", 1), (3, "", "b", "q", 1)], schema)
    out = mix_sources(docs, {"a": 2.0, "zero": 1.0})
    assert out.columns == ["doc_id", "text", "source", "rate", "copy", "mix_key"]
    counts = Counter((r.doc_id, r.copy) for r in out.collect())
    assert all(v == 2 for (d, _), v in counts.items() if d == 1)
