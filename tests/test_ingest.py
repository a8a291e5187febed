"""Connectors on tiny landed files (2-3 rows, a null, a duplicate id, a missing field)."""

import json
import os
import tempfile

import pytest

from tidewatch.sources import config as C
from tidewatch.sources import ingest as I


def _write(lines, name, d):
    path = os.path.join(d, name)
    with open(path, "w") as f:
        for doc in lines:
            f.write(json.dumps(doc) + "\n")
    return path


@pytest.fixture()
def tmp():
    return tempfile.mkdtemp(prefix="tidewatch-test-")


def test_news(spark, tmp):
    p = _write([{"topic": "AI music", "request_ordinal": 0, "articles": [
        {"title": "AI beats", "description": "new synth", "publishedAt": "2024-05-01T10:00:00Z",
         "url": "u1", "urlToImage": "http://img"},
        {"title": None, "description": "only desc", "publishedAt": "bad", "url": None}]}], "news.json", tmp)
    rows = sorted(I.news_signals(spark, p).collect(), key=lambda r: r["text"])
    assert rows[0]["text"] == "AI beats new synth" and rows[0]["engagement"] == 1.0
    assert str(rows[0]["date"]) == "2024-05-01"
    assert rows[1]["text"] == "only desc" and rows[1]["date"] is None and rows[1]["source_item_id"] == ""


def test_tracks_with_features(spark, tmp):
    t = _write([{"topic": "AI music", "request_ordinal": 0, "harvested_at": "2024-06-01", "tracks": {"items": [
        {"id": "t1", "name": "Song", "popularity": 55, "artists": [{"name": "Ann"}],
         "album": {"images": [{"url": "http://a"}]}, "external_urls": {"spotify": "s1"}},
        {"id": "t2", "name": "Other", "popularity": 10, "artists": [], "album": {"images": []}}]}}],
        "tracks.json", tmp)
    f = _write([{"request_ordinal": 0, "audio_features": [None, {"id": "t1", "danceability": 0.1, "energy": 0.2}]},
                {"request_ordinal": 1, "audio_features": [{"id": "t1", "danceability": 0.9, "energy": 0.8}]}],
               "features.json", tmp)
    rows = {r["source_item_id"]: r for r in I.track_signals(spark, t, f).collect()}
    assert rows["t1"]["text"] == "Song by Ann" and rows["t1"]["audio_danceability"] == 0.9
    assert rows["t2"]["text"] == "Other by Unknown artist" and rows["t2"]["audio_energy"] is None
    assert str(rows["t1"]["date"]) == "2024-06-01"


def _post(i, score=1, thumb="self"):
    return {"data": {"id": i, "title": f"t{i}", "selftext": "", "score": score, "num_comments": 2,
                     "created_utc": 1704067200, "permalink": f"/r/x/{i}", "thumbnail": thumb}}


def test_posts_dedup_and_cap(spark, tmp):
    docs = [{"topic": "A", "request_ordinal": 0, "data": {"children": [_post("p1", thumb="http://t"), _post("p2")]}},
            {"topic": "A", "request_ordinal": 1, "data": {"children": [_post("p3"), _post("p1")]}},
            {"topic": "A", "request_ordinal": 2, "data": {"children": [_post("p4")]}},
            {"topic": "B", "request_ordinal": 3, "data": {"children": [_post("p2"), _post(""), _post("p5")]}}]
    p = _write(docs, "posts.json", tmp)
    rows = {r["source_item_id"]: r for r in I.post_signals(spark, p, max_posts_per_topic=3).collect()}
    # p1 first seen in request 0; A reaches 3 rows after request 1, so request 2 is dropped
    assert set(rows) == {"p1", "p2", "p3", "p5"}
    assert rows["p2"]["topic"] == "A" and rows["p5"]["topic"] == "B"
    assert rows["p1"]["media_url"] == "http://t" and rows["p3"]["media_url"] == ""
    assert rows["p1"]["engagement"] == 3.0 and str(rows["p1"]["date"]) == "2024-01-01"


def test_csv_posts_and_matcher(spark, tmp):
    path = os.path.join(tmp, "x.csv")
    with open(path, "w") as f:
        f.write("full_text,likes,retweets,created_at,tweet_id\n")
        f.write("Love this AI MUSIC track,3,x,2024-02-02T00:00:00,1\n")
        f.write("nothing relevant,1,1,2024-02-02,2\n")
        f.write("mindfulness and digital art,1,1,2024-02-03,3\n")
    topics = C.topics_frame(spark)
    rows = {r["source_item_id"]: r for r in I.x_csv_signals(spark, path, topics).collect()}
    assert set(rows) == {"1", "3"}
    assert rows["1"]["topic"] == "AI music" and rows["1"]["engagement"] == 3.0
    # both Mindfulness and Digital art match; configuration order decides
    assert rows["3"]["topic"] == "Mindfulness"
    with pytest.raises(FileNotFoundError):
        I.x_csv_signals(spark, os.path.join(tmp, "missing.csv"), topics)


def test_x_api(spark, tmp):
    p = _write([{"topic": "AI music", "request_ordinal": 0,
                 "data": [{"id": "9", "text": "hi", "created_at": "2024-03-01T00:00:00Z",
                           "public_metrics": {"like_count": 1, "retweet_count": 2, "reply_count": 3,
                                              "quote_count": 4},
                           "attachments": {"media_keys": ["m2", "m1"]}}],
                 "includes": {"media": [{"media_key": "m2", "preview_image_url": "http://p"},
                                        {"media_key": "m1", "url": "http://u"}]}}], "xapi.json", tmp)
    r = I.x_api_signals(spark, p).first()
    assert r["engagement"] == 10.0 and r["media_url"] == "http://p"
    assert r["detail"] == "https://x.com/i/web/status/9"


def test_topic_config_roundtrip(spark, tmp):
    path = os.path.join(tmp, "topics.csv")
    with open(path, "w") as f:
        f.write("name,news_query,spotify_query,reddit_terms,reddit_subreddits\n")
        f.write("Jazz,,,bebop | swing,\n")
        f.write(",x,y,z,w\n")
        f.write("Tea,tea news,,a;b,r1 | r2\n")
    t = C.load_topics(spark, path).orderBy("topic_ordinal").collect()
    assert [r["name"] for r in t] == ["Jazz", "Tea"]
    assert t[0]["spotify_query"] == "Jazz" and t[0]["reddit_terms"] == ["bebop", "swing"]
    assert t[0]["reddit_subreddits"] == ["*"] and t[1]["reddit_terms"] == ["a", "b"]
    out = os.path.join(tmp, "saved")
    C.save_topics(C.load_topics(spark, path), out)
    again = C.load_topics(spark, out).orderBy("topic_ordinal").collect()
    assert [r["reddit_terms"] for r in again] == [["bebop", "swing"], ["a", "b"]]
    assert len(C.load_topics(spark, os.path.join(tmp, "none.csv")).collect()) == 4
    bad = os.path.join(tmp, "bad.csv")
    with open(bad, "w") as f:
        f.write("name,news_query\nA,b\n")
    with pytest.raises(ValueError):
        C.load_topics(spark, bad)


def test_union_and_status(spark, tmp):
    p = _write([{"topic": "A", "request_ordinal": 0, "articles": [{"title": "x"}]}], "n.json", tmp)
    sig = I.union_signals([I.news_signals(spark, p)])
    st = {r["source"]: r for r in I.source_status(
        spark, [("NewsAPI", True, False, False, "ok"), ("X", False, False, False, "none"),
                ("Reddit", True, True, False, "boom")], sig).collect()}
    assert st["NewsAPI"]["status"] == "loaded" and st["NewsAPI"]["record_count"] == 1
    assert st["X"]["status"] == "skipped" and st["Reddit"]["status"] == "failed"
    with pytest.raises(ValueError):
        I.union_signals([])


def test_missing_artifact_reads_empty(spark, tmp):
    df = C.load_table_or_empty(spark, os.path.join(tmp, "nope"), "topic string, score double")
    assert df.count() == 0 and df.columns == ["topic", "score"]


def test_harvest_log_is_idempotent_per_batch(spark, tmp):
    path = os.path.join(tmp, "log")
    I.append_harvest_log(spark, path, 0, "live", "AI music", "m")
    I.append_harvest_log(spark, path, 1, "live", "Mindfulness", "m")
    I.append_harvest_log(spark, path, 1, "live", "Digital art", "m")   # replay of batch 1
    rows = {r["iteration"]: r["top_topic"] for r in spark.read.parquet(path).collect()}
    assert rows == {1: "AI music", 2: "Digital art"}


def test_community_listing_keeps_every_post(spark, tmp):
    docs = [{"topic": "running", "request_ordinal": i, "data": {"children": [_post(f"r{i}{j}") for j in range(10)]}}
            for i in range(3)]
    p = _write(docs, "hot.json", tmp)
    rows = I.community_signals(spark, p).collect()
    assert len(rows) == 30 and {r["topic"] for r in rows} == {"running"}


# --- probes of paths, duplicates and missing ordinals ---------------------------

def test_uris_are_read_and_the_log_keeps_every_batch(spark, tmp):
    log = f"file://{tmp}/log"
    for batch in range(3):
        I.append_harvest_log(spark, log, batch, "live", f"t{batch}", "m")
    assert spark.read.parquet(log).count() == 3
    with open(os.path.join(tmp, "topics.csv"), "w") as f:
        f.write("name,news_query,spotify_query,reddit_terms,reddit_subreddits\nJazz,,,,\n")
    assert [r["name"] for r in C.load_topics(spark, f"file://{tmp}/topics.csv").collect()] == ["Jazz"]
    spark.range(5).write.parquet(f"file://{tmp}/table")
    assert C.load_table_or_empty(spark, f"file://{tmp}/table", "id long").count() == 5
    with open(os.path.join(tmp, "x.csv"), "w") as f:
        f.write("text,tweet_id,topic\nhello,1,T\n")
    assert I.x_csv_signals(spark, f"file://{tmp}/x.csv", C.topics_frame(spark)).count() == 1


def test_posts_without_ordinal_stay_and_ids_are_kept_once(spark, tmp):
    p = _write([{"topic": "A", "data": {"children": [_post("p1"), _post("p2")]}}], "a.json", tmp)
    assert {r["source_item_id"] for r in I.post_signals(spark, p).collect()} == {"p1", "p2"}
    # ordinals that start anew for each topic
    p = _write([{"topic": t, "request_ordinal": 0, "data": {"children": [_post("q1", score=s), _post(f"q{t}")]}}
                for t, s in (("B", 2), ("A", 1))], "b.json", tmp)
    rows = sorted((r["source_item_id"], r["topic"]) for r in I.post_signals(spark, p).collect())
    assert rows == [("q1", "A"), ("qA", "A"), ("qB", "B")]


def test_a_post_beyond_the_budget_counts_where_it_is_seen_next(spark, tmp):
    docs = [{"topic": "A", "request_ordinal": 0, "data": {"children": [_post("a"), _post("b")]}},
            {"topic": "A", "request_ordinal": 1, "data": {"children": [_post("c")]}},
            {"topic": "B", "request_ordinal": 2, "data": {"children": [_post("c")]}}]
    p = _write(docs, "c.json", tmp)
    rows = {r["source_item_id"]: r["topic"] for r in I.post_signals(spark, p, max_posts_per_topic=2).collect()}
    assert rows == {"a": "A", "b": "A", "c": "B"}


def test_media_without_ordinal_and_last_duplicate(spark, tmp):
    p = _write([{"topic": "T", "data": [{"id": "1", "attachments": {"media_keys": ["m"]}}, {"id": "2"}],
                 "includes": {"media": [{"media_key": "m", "url": "http://first"}, {"media_key": "m", "url": "http://last"},
                                        {"media_key": "m"}]}}, {"topic": "T", "data": [{"id": "3"}]}], "m.json", tmp)
    rows = {r["source_item_id"]: r["media_url"] for r in I.x_api_signals(spark, p).collect()}
    assert rows == {"1": "http://last", "2": "", "3": ""}


def test_a_failed_batch_empties_the_audio_lookup(spark, tmp):
    good = {"request_ordinal": 0, "audio_features": [{"id": "t1", "danceability": 0.1}]}
    assert I.audio_feature_lookup(spark, _write([good], "g.json", tmp)).count() == 1
    bad = _write([good, {"request_ordinal": 1, "error": "429"}], "e.json", tmp)
    assert I.audio_feature_lookup(spark, bad).count() == 0
    torn = os.path.join(tmp, "torn.json")
    with open(torn, "w") as f:
        f.write(json.dumps(good) + "\n{\"audio_features\": [\n")
    assert I.audio_feature_lookup(spark, torn).count() == 0


def test_cleaning_knows_every_white_space(spark):
    from tidewatch.functions.text import clean_text
    text = "ai\u00a0music http://x\u00a0jazz\u2003now\u3000http\x1cend"
    r = spark.createDataFrame([(text,)], "t string").select(clean_text("t"), clean_text("t", "")).first()
    assert r[0] == "ai music jazz now http end" and r[1] == "ai music jazz now http end"
