"""Registered queries: the connectors and the topic file, on payloads that Spark
lands from the whole given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.plans.registry import ORACLE, register
from tidewatch.session import scratch_path
from tidewatch.sources import config as C
from tidewatch.sources import ingest as I
from tidewatch.sources import tables

PAGE_SIZE = 20   # items of a landed request


def _land(payload, spark, name: str) -> str:
    path = scratch_path(spark, f"landed-{name}")
    payload.write.mode("overwrite").json(path)
    return path


def _pages(rows, topic, item, name: str):
    """One request per (topic, page) with its items in id order."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct(F.col("_order"), item.alias("i")))), lambda x: x["i"])
    return (rows.withColumn("topic", topic).withColumn("_page", F.floor(F.col("_order") / PAGE_SIZE))
            .groupBy("topic", F.col("_page").alias("request_ordinal")).agg(listed.alias(name)))


# --- S3, S4, J6: tracks with audio features -----------------------------------------

@register("s3_s4_track_ingest", """
WITH f AS (SELECT vec_id, embedding, vec_id % 10 = 0 AS twice FROM embeddings)
SELECT DATE '2024-02-01' AS date, 'Spotify' AS source, lang AS topic,
  trim('doc ' || d.doc_id || ' by ' || CASE WHEN d.doc_id % 7 = 0 THEN 'Unknown artist' ELSE d.source END) AS text,
  CAST(n_chars % 100 AS DOUBLE) AS engagement, 'track://' || d.doc_id AS detail,
  CASE WHEN d.doc_id % 3 = 0 THEN '' ELSE 'img://' || d.doc_id END AS media_url, 't' || d.doc_id AS source_item_id,
  'text+audio+image' AS modality_hint, '' AS preview_url,
  CASE WHEN d.doc_id % 7 = 0 THEN 'Unknown artist' ELSE d.source END AS artist_name,
  CASE WHEN twice THEN 0.5 ELSE round((1 + CAST(embedding[1] AS DOUBLE)) / 2, 6) END AS audio_danceability,
  CASE WHEN NOT twice THEN round((1 + CAST(embedding[2] AS DOUBLE)) / 2, 6) END AS audio_energy
FROM documents d LEFT JOIN f ON f.vec_id = d.doc_id""")
def s3_s4_track_ingest(spark, sf_dir):
    """Every document as a track; a tenth of the feature rows comes twice (the last wins)."""
    d = tables.read_table(spark, sf_dir, "documents").withColumn("_order", F.col("doc_id"))
    key = F.col("doc_id").cast("string")
    item = F.struct(
        F.concat(F.lit("t"), key).alias("id"), F.concat(F.lit("doc "), key).alias("name"),
        (F.col("n_chars") % 100).cast("double").alias("popularity"),
        F.when(F.col("doc_id") % 7 != 0, F.array(F.struct(F.col("source").alias("name")))).otherwise(
            F.array().cast("array<struct<name:string>>")).alias("artists"),
        F.struct(F.when(F.col("doc_id") % 3 != 0, F.array(F.struct(F.concat(F.lit("img://"), key).alias("url")))).otherwise(
            F.array().cast("array<struct<url:string>>")).alias("images")).alias("album"),
        F.struct(F.concat(F.lit("track://"), key).alias("spotify")).alias("external_urls"))
    tracks = _pages(d, F.col("lang"), item, "items").select(
        "topic", "request_ordinal", F.lit("2024-02-01T08:00:00Z").alias("harvested_at"), F.struct("items").alias("tracks"))
    audio = tables.audio(spark, sf_dir).withColumn("_order", F.col("vec_id"))
    feature = F.struct(F.concat(F.lit("t"), F.col("vec_id").cast("string")).alias("id"),
                       F.col("audio_danceability").alias("danceability"), F.col("audio_energy").alias("energy"))
    once = _pages(audio, F.lit(""), feature, "audio_features")
    again = _pages(audio.where("vec_id % 10 = 0").withColumn("audio_danceability", F.lit(0.5))
                   .withColumn("audio_energy", F.lit(None).cast("double")), F.lit(""), feature, "audio_features")
    later = once.agg(F.max("request_ordinal").alias("m")).first()["m"]
    features = once.unionByName(again.withColumn("request_ordinal", F.col("request_ordinal") + F.lit(later or 0) + 1))
    out = I.track_signals(spark, _land(tracks, spark, "tracks"), _land(features.drop("topic"), spark, "features"))
    return out.drop("audio_valence", "audio_tempo", "audio_acousticness", "audio_instrumentalness", "audio_speechiness")


# --- S5, R6, S15: posts, first sighting wins -------------------------------------------

def _posts(spark, sf_dir, topic: str) -> str:
    d = tables.read_table(spark, sf_dir, "documents").withColumn("_order", F.col("doc_id"))
    # a fifth of the posts repeats the id of a post on the page before
    pid = F.when((F.col("doc_id") % 5 == 4) & (F.col("doc_id") > 20), F.col("doc_id") - 21).otherwise(F.col("doc_id"))
    item = F.struct(F.struct(
        pid.cast("string").alias("id"), F.concat(F.lit("title "), F.col("doc_id").cast("string")).alias("title"),
        F.col("text").alias("selftext"), (F.col("n_chars") % 50).cast("double").alias("score"),
        (F.col("doc_id") % 9).cast("double").alias("num_comments"),
        (F.lit(1704067200.0) + F.col("doc_id") * 3600).alias("created_utc"),
        F.concat(F.lit("/p/"), F.col("doc_id").cast("string")).alias("permalink"),
        F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("http://i/"), F.col("doc_id").cast("string")))
        .otherwise(F.lit("self")).alias("thumbnail")).alias("data"))
    payload = _pages(d, F.col(topic), item, "children").select("topic", "request_ordinal", F.struct("children").alias("data"))
    return _land(payload, spark, f"posts-{topic}")


def _posts_sql(topic: str) -> str:
    return f"""
WITH p AS (SELECT *, CASE WHEN doc_id % 5 = 4 AND doc_id > 20 THEN doc_id - 21 ELSE doc_id END AS pid FROM documents),
k AS (SELECT pid, arg_min(doc_id, (doc_id // {PAGE_SIZE}, {topic}, doc_id)) AS doc_id FROM p GROUP BY pid)
SELECT CAST(TIMESTAMP '2024-01-01' + to_hours(CAST(d.doc_id AS INTEGER)) AS DATE) AS date, 'Reddit' AS source,
  d.{topic} AS topic, trim('title ' || d.doc_id || ' ' || coalesce(d.text, '')) AS text,
  CAST(n_chars % 50 + d.doc_id % 9 AS DOUBLE) AS engagement, 'https://www.reddit.com/p/' || d.doc_id AS detail,
  CASE WHEN d.doc_id % 4 = 0 THEN 'http://i/' || d.doc_id ELSE '' END AS media_url,
  CAST(k.pid AS VARCHAR) AS source_item_id, 'text' AS modality_hint
FROM k JOIN documents d USING (doc_id)"""


@register("s5_r6_post_ingest", _posts_sql("lang"))
def s5_r6_post_ingest(spark, sf_dir):
    return I.post_signals(spark, _posts(spark, sf_dir, "lang"))


@register("s15_community_ingest", _posts_sql("source"))
def s15_community_ingest(spark, sf_dir):
    """Listings whose community (the source) is the topic."""
    return I.community_signals(spark, _posts(spark, sf_dir, "source"))


# --- S7: post CSV, S9: post API ----------------------------------------------------------

@register("s7_post_csv_ingest", """
SELECT CAST(DATE '2024-01-01' + CAST(doc_id % 300 AS INTEGER) AS DATE) AS date, 'X' AS source, lang AS topic,
  'post ' || doc_id || ' of ' || source AS text, CAST(n_chars % 11 + doc_id % 5 AS DOUBLE) AS engagement,
  'u://' || doc_id AS detail, '' AS media_url, CAST(doc_id AS VARCHAR) AS source_item_id, 'text+image' AS modality_hint
FROM documents WHERE doc_id % 6 <> 0""")
def s7_post_csv_ingest(spark, sf_dir):
    """Every document as a row of a post export; rows without topic match no term and go."""
    d = tables.read_table(spark, sf_dir, "documents")
    path = scratch_path(spark, "landed-post-csv")
    key = F.col("doc_id").cast("string")
    (d.select(F.concat(F.lit("post "), key, F.lit(" of "), F.col("source")).alias("full_text"),
              (F.col("n_chars") % 11).alias("likes"), (F.col("doc_id") % 5).alias("retweets"), F.lit("n/a").alias("quotes"),
              F.concat(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 300).cast("int")).cast("string"),
                       F.lit("T10:00:00")).alias("created_at"),
              F.concat(F.lit("u://"), key).alias("tweet_url"), key.alias("tweet_id"),
              F.when(F.col("doc_id") % 6 != 0, F.col("lang")).alias("topic"))
     .write.mode("overwrite").option("header", True).option("escape", '"').csv(path))
    return I.x_csv_signals(spark, path, C.topics_frame(spark, [("no such topic", "zq zq", "zq zq", ["zq zq"], ["*"])]))


@register("s9_post_api_ingest", """
SELECT DATE '2024-03-01' AS date, 'X' AS source, source AS topic, coalesce(text, '') AS text,
  CAST(n_chars % 4 + doc_id % 3 AS DOUBLE) AS engagement, 'https://x.com/i/web/status/' || doc_id AS detail,
  CASE WHEN doc_id % 3 = 0 THEN '' WHEN doc_id % 2 = 0 THEN 'last://' || doc_id ELSE 'prev://' || doc_id END AS media_url,
  CAST(doc_id AS VARCHAR) AS source_item_id, 'text+image' AS modality_hint
FROM documents""")
def s9_post_api_ingest(spark, sf_dir):
    """Every document as a post; media keys that come twice take their last url."""
    d = tables.read_table(spark, sf_dir, "documents").withColumn("_order", F.col("doc_id"))
    key = F.col("doc_id").cast("string")
    none = F.lit(None).cast("string")

    def media(url, preview):
        return F.struct(key.alias("media_key"), url.alias("url"), preview.alias("preview_image_url"))

    both = F.struct(
        F.struct(key.alias("id"), F.col("text"), F.lit("2024-03-01T00:00:00Z").alias("created_at"),
                 F.struct((F.col("n_chars") % 4).cast("double").alias("like_count"),
                          (F.col("doc_id") % 3).cast("double").alias("retweet_count")).alias("public_metrics"),
                 F.when(F.col("doc_id") % 3 != 0, F.struct(F.array(key).alias("media_keys"))).alias("attachments")).alias("p"),
        F.when(F.col("doc_id") % 2 == 0, F.array(media(F.concat(F.lit("first://"), key), none),
                                                 media(F.concat(F.lit("last://"), key), none)))
        .otherwise(F.array(media(none, F.concat(F.lit("prev://"), key)))).alias("m"))
    pages = _pages(d, F.col("source"), both, "items")
    payload = pages.select("topic", F.transform("items", lambda i: i["p"]).alias("data"),
                           F.struct(F.flatten(F.transform("items", lambda i: i["m"])).alias("media")).alias("includes"))
    return I.x_api_signals(spark, _land(payload, spark, "post-api"))


# --- S11: one table of several sources ------------------------------------------------------

_SOURCES = ("s3_s4_track_ingest", "s5_r6_post_ingest", "s7_post_csv_ingest", "s9_post_api_ingest")


@register("s11_source_union", "\nUNION ALL BY NAME\n".join(f"SELECT * FROM ({ORACLE[n]})" for n in _SOURCES))
def s11_source_union(spark, sf_dir):
    """Tracks, posts, the post export and the post API in one table; columns
    that only tracks have are null elsewhere, a source that was not loaded is
    left out."""
    frames = [fn(spark, sf_dir) for fn in (s3_s4_track_ingest, s5_r6_post_ingest, s7_post_csv_ingest, s9_post_api_ingest)]
    return I.union_signals([frames[0], None, *frames[1:]])


# --- S1, K2, K3, P27, P28: the topic file --------------------------------------------------

@register("s1_k2_k3_topic_file", """
SELECT trim(n_name) AS name, CASE WHEN n_nationkey % 2 = 0 THEN lower(n_name) ELSE trim(n_name) END AS news_query,
  CASE WHEN n_nationkey % 2 = 0 THEN lower(n_name) ELSE trim(n_name) END AS spotify_query,
  CASE WHEN n_nationkey % 3 = 0 THEN trim(n_name) ELSE trim(n_name) || ' | ' || trim(r_name) END AS reddit_terms,
  CASE WHEN n_nationkey % 5 = 0 THEN '*' ELSE 'r' || n_regionkey || ' | r' || n_nationkey END AS reddit_subreddits
FROM nation JOIN region ON n_regionkey = r_regionkey""")
def s1_k2_k3_topic_file(spark, sf_dir):
    """Nations as topics: written with blanks, 'nan' and both separators, read
    with defaults, saved, and read again."""
    n, r = (tables.read_table(spark, sf_dir, t) for t in ("nation", "region"))
    rows = n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.concat(F.lit(" "), F.trim("n_name"), F.lit(" ")).alias("name"),
        F.when(F.col("n_nationkey") % 2 == 0, F.lower("n_name")).otherwise(F.lit("nan")).alias("news_query"),
        F.lit("").alias("spotify_query"),
        F.when(F.col("n_nationkey") % 3 != 0, F.concat(F.trim("n_name"), F.lit(" ; "), F.trim("r_name"))).otherwise(
            F.lit("")).alias("reddit_terms"),
        F.when(F.col("n_nationkey") % 5 != 0, F.concat(F.lit("r"), F.col("n_regionkey").cast("string"), F.lit("||r"),
                                                       F.col("n_nationkey").cast("string"))).alias("reddit_subreddits"))
    nameless = rows.limit(1).withColumn("name", F.lit(" "))
    path, saved = scratch_path(spark, "topics-csv"), scratch_path(spark, "topics-saved")
    rows.unionByName(nameless).write.mode("overwrite").option("header", True).csv(path)
    C.save_topics(C.load_topics(spark, path), saved)
    return C.topics_to_rows(C.load_topics(spark, saved))
