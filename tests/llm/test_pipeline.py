"""The corpus pipeline: each stage on its predecessor's output, against brute force."""

import re

import duckdb

import corpus_pipeline as P
from tests.llm.test_decontaminate import local_score, words
from tests.llm.test_near_dup import brute as near_groups
from tests.llm.test_pii import base
from tidewatch.llm.toxicity import labelled_sample, train

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, outs = docs.columns, []
    for k, (_, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / str(k)))
        nxt = spark.read.parquet(str(tmp_path / str(k)))
        if k < len(P.STAGES) - 1:
            assert nxt.columns == columns
        outs.append((rows_of(docs), rows_of(nxt)))
        docs = nxt

    (before, after) = outs[0]
    model = train(labelled_sample(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")))
    assert after == [r for r in before if model.score(r[1]) < 0.7]

    (before, after) = outs[1]
    groups = near_groups([(r[0], r[1]) for r in before], 5)
    assert after == [r for r in before if groups[r[0]][2]]
    assert len(after) < len(before)

    (before, after) = outs[2]
    items = [words(t) for _, t in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    sets = [{tuple(x[k:k + 3]) for k in range(len(x) - 2)} for x in items]
    kept = []
    for r in before:
        y = words(r[1])
        runs = {tuple(y[k:k + 3]) for k in range(len(y) - 2)}
        if not any(len(s & runs) >= 3 and local_score(x, y) >= 0.4 * 2 * len(x) for x, s in zip(items, sets)):
            kept.append(r)
    assert after == kept and len(after) < len(before)

    (before, after) = outs[3]
    assert [(r[0], *r[2:]) for r in before] == [(r[0], *r[2:]) for r in after]
    for x, y in zip(before, after):
        counts, _ = base(x[1])
        assert (x[1] == y[1]) == (sum(counts[:4]) == 0 and "[IBAN]" not in y[1] and "[SSN]" not in y[1])
        assert not re.search(r"[A-Za-z0-9]@[A-Za-z0-9-]+\.", y[1])

    (before, after) = outs[4]
    sizes = {}
    for r in before:
        sizes[r[3]] = sizes.get(r[3], 0) + len(r[1])
    assert {r[0] for r in after} <= {r[0] for r in before}
    texts = {r[0]: r[1] for r in before}
    assert all(texts[r[0]] == r[1] for r in after)


def test_mixing_stage_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    from tidewatch.llm.mixing import MIX_SQL
    want = con.execute(f"SELECT doc_id, copy FROM ({MIX_SQL.format(docs='documents')}) ORDER BY ALL").fetchall()
    got = P.mix(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF).select("doc_id", "copy").collect()
    assert sorted(map(tuple, got)) == want


def test_null_ids_and_empty_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(None, None, None, None, None), (None, "a@b.cd", "en", "s", 6), (1, "", "en", "s", 0),
                                  (1, "", "en", "s", 0)], schema)
    for d in (docs, docs.limit(0)):
        n = d.count()
        for _, stage in P.STAGES[:-1]:
            d = stage(spark, d, SF)
            assert d.columns == docs.columns
        assert d.count() == n
        assert P.STAGES[-1][1](spark, d, SF).where("doc_id = 1").count() % 2 == 0


def test_pii_stage_leaves_no_weak_phone_or_address(spark):
    df = spark.createDataFrame([(1, "order +1 (068) 555-2748 end", "en", "s", 27), (2, "213.174.22.103, x@mail7.example.com", "en", "s", 35)],
                               "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in P.remove_pii(spark, df, SF).collect()}
    assert got == {1: "order [PHONE] end", 2: "[IP], [EMAIL]"}
