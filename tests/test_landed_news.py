"""Landed news: the same articles as ``signals``, paged without moving texts."""

import datetime as dt

import pytest

from tidewatch.plans import q_ingest as Q
from tidewatch.sources import ingest as I
from tidewatch.sources import tables


@pytest.fixture
def sf_dir(spark, tmp_path):
    docs = [(i, f"title {i}\nbody\n{i}" if i else None, "en", "s") for i in range(4)] + [(2, "again", "en", "s"), (None, "lost", "en", "s")]
    day = dt.datetime(2024, 1, 1)
    events = [(i, day + dt.timedelta(days=i % 3 // 2) if i % 7 else None, ("a", "b", None)[i % 3 // 1 % 3] if i < 300 else "hot", 1.0)
              for i in range(600)] + [(5, day, "a", 1.0), (None, day, "a", 1.0)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    (spark.createDataFrame(events, "event_id long, ts timestamp, event_type string, value double")
     .write.parquet(f"{tmp_path}/events.parquet"))
    return str(tmp_path)


def test_landed_articles_are_the_signals(spark, sf_dir):
    path = Q._landed_news(spark, sf_dir)
    got = sorted((r["source_item_id"], str(r["topic"]), str(r["date"]), r["text"]) for r in I.news_signals(spark, path).collect())
    want = sorted((f"doc://{r['source_item_id']}", str(r["topic"]), str(r["date"]), " ".join((r["text"] or "").split("\n", 1)).strip())
                  for r in tables.signals(spark, sf_dir).collect())
    assert got == want
    sizes = [len(r["articles"]) for r in spark.read.schema(I.NEWS_SCHEMA).json(path).collect()]
    assert max(sizes) <= Q.PAGE_SIZE and max(sizes) > 1


def test_texts_are_not_shuffled_to_be_paged(spark, sf_dir):
    plan = tables.signal_pages(spark, sf_dir, 20)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("SortMergeJoin")[0]
