"""Landed payloads -> canonical ``signals`` rows.

Fetching over HTTP is out of scope: each connector reads landed JSON/CSV files
(JSON Lines by default, ``multi_line=True`` for one document per file; one
document per request, carrying the ``topic`` it was issued for and a
``request_ordinal`` giving the order requests were made) with an explicit
schema and flattens them with explode / field access.  Everything is a
DataFrame job; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.functions.keywords import first_group
from tidewatch.operators.joins import checked_broadcast, one_row
from tidewatch.session import path_exists

SIGNAL_COLUMNS = ("date", "source", "topic", "text", "engagement", "detail", "media_url",
                  "source_item_id", "modality_hint")
AUDIO_FIELDS = ("danceability", "energy", "valence", "tempo", "acousticness",
                "instrumentalness", "speechiness")

NEWS_SCHEMA = ("topic string, request_ordinal long, articles array<struct<title: string, "
               "description: string, publishedAt: string, url: string, urlToImage: string>>")
TRACKS_SCHEMA = ("topic string, request_ordinal long, harvested_at string, tracks struct<items: "
                 "array<struct<id: string, name: string, popularity: double, preview_url: string, "
                 "artists: array<struct<name: string>>, album: struct<images: array<struct<url: string>>>, "
                 "external_urls: struct<spotify: string>>>>")
AUDIO_SCHEMA = ("request_ordinal long, audio_features array<struct<id: string, danceability: double, "
                "energy: double, valence: double, tempo: double, acousticness: double, "
                "instrumentalness: double, speechiness: double>>")
POSTS_SCHEMA = ("topic string, request_ordinal long, data struct<children: array<struct<data: "
                "struct<id: string, title: string, selftext: string, score: double, num_comments: double, "
                "created_utc: double, permalink: string, thumbnail: string>>>>")
XAPI_SCHEMA = ("topic string, request_ordinal long, data array<struct<id: string, text: string, "
               "created_at: string, public_metrics: struct<like_count: double, retweet_count: double, "
               "reply_count: double, quote_count: double>, attachments: struct<media_keys: "
               "array<string>>>>, includes struct<media: array<struct<media_key: string, url: string, "
               "preview_image_url: string>>>")


def _s(c) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def _signals(df: DataFrame) -> DataFrame:
    return df.select(*SIGNAL_COLUMNS, *[c for c in df.columns if c not in SIGNAL_COLUMNS])


def news_signals(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Articles -> one row each; engagement = max(len(title) / 10, 1)."""
    raw = spark.read.schema(NEWS_SCHEMA).option("multiLine", multi_line).json(path)
    a = raw.select("topic", F.explode("articles").alias("a"))
    title = _s(F.col("a.title"))
    return _signals(a.select(
        F.expr("try_to_date(substring(a.publishedAt, 1, 10))").alias("date"),
        F.lit("NewsAPI").alias("source"), "topic",
        F.trim(F.concat_ws(" ", title, _s(F.col("a.description")))).alias("text"),
        F.greatest(F.length(title) / 10.0, F.lit(1.0)).alias("engagement"),
        _s(F.col("a.url")).alias("detail"), _s(F.col("a.urlToImage")).alias("media_url"),
        _s(F.col("a.url")).alias("source_item_id"), F.lit("text+image").alias("modality_hint")))


def audio_feature_lookup(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Id-keyed features; null items dropped; the last duplicate wins.

    A landed batch that failed (a document with an ``error``, or one that is
    not valid JSON) empties the whole lookup.
    """
    raw = (spark.read.schema(AUDIO_SCHEMA + ", error string, _corrupt string")
           .option("columnNameOfCorruptRecord", "_corrupt").option("multiLine", multi_line).json(path))
    failed = raw.agg(F.max((F.col("error").isNotNull() | F.col("_corrupt").isNotNull()).cast("int")).alias("_failed"))
    raw = raw.join(one_row(failed), on=F.coalesce(F.col("_failed"), F.lit(0)) == 0)
    items = (raw.select(F.coalesce("request_ordinal", F.lit(0)).alias("_req"),
                        F.posexplode("audio_features").alias("_pos", "f"))
             .where(F.col("f").isNotNull() & (F.coalesce(F.col("f.id"), F.lit("")) != "")))
    order = F.struct("_req", "_pos")
    return items.groupBy(F.col("f.id").alias("track_id")).agg(
        *[F.max_by(F.col(f"f.{k}"), order).alias(f"audio_{k}") for k in AUDIO_FIELDS])


def track_signals(spark: SparkSession, path: str, features_path: str | None = None,
                  multi_line: bool = False) -> DataFrame:
    """S3 + J6: tracks with the first artist and album image; date is the harvest day."""
    raw = spark.read.schema(TRACKS_SCHEMA).option("multiLine", multi_line).json(path)
    t = raw.select("topic", "harvested_at", F.explode("tracks.items").alias("t"))
    artist = F.coalesce(F.try_element_at(F.col("t.artists"), F.lit(1))["name"], F.lit("Unknown artist"))
    image = F.coalesce(F.try_element_at(F.col("t.album.images"), F.lit(1))["url"], F.lit(""))
    out = t.select(
        F.coalesce(F.expr("try_to_date(substring(harvested_at, 1, 10))"), F.current_date()).alias("date"),
        F.lit("Spotify").alias("source"), "topic",
        F.trim(F.concat(_s(F.col("t.name")), F.lit(" by "), artist)).alias("text"),
        F.coalesce(F.col("t.popularity"), F.lit(0.0)).alias("engagement"),
        _s(F.col("t.external_urls.spotify")).alias("detail"), image.alias("media_url"),
        _s(F.col("t.id")).alias("source_item_id"), F.lit("text+audio+image").alias("modality_hint"),
        _s(F.col("t.preview_url")).alias("preview_url"), artist.alias("artist_name"))
    if features_path:
        feats = audio_feature_lookup(spark, features_path, multi_line)
        out = out.join(feats, out.source_item_id == feats.track_id, "left").drop("track_id")
    else:
        for k in AUDIO_FIELDS:
            out = out.withColumn(f"audio_{k}", F.lit(None).cast("double"))
    return _signals(out)


def post_signals(spark: SparkSession, path: str, max_posts_per_topic: int | None = None,
                 source: str = "Reddit", multi_line: bool = False) -> DataFrame:
    """Posts; the first sighting of an id over all requests wins.

    Requests are ordered by ``request_ordinal`` (missing ones last, then by
    topic and file), posts by their position.  All landed posts are kept;
    ``max_posts_per_topic`` is an opt-in that replays a collector's budget: a
    request counts while the topic's new posts before it are below the
    budget (so the last one may overshoot), and only posts of such requests
    compete for the first sighting.
    """
    raw = spark.read.schema(POSTS_SCHEMA).option("multiLine", multi_line).json(path)
    request = F.struct(F.coalesce("request_ordinal", F.lit((1 << 62))).alias("o"),
                       F.coalesce("topic", F.lit("")).alias("t"), F.col("_metadata.file_path").alias("f"),
                       F.col("_metadata.file_block_start").alias("b"))
    p = (raw.select("topic", request.alias("_req"), F.posexplode("data.children").alias("_pos", "c"))
         .select("topic", "_req", "_pos", F.col("c.data").alias("d"))
         .where(F.coalesce(F.col("d.id"), F.lit("")) != "")
         .withColumn("_id", F.col("d.id")))
    # a file may hold several requests: the id ends the order, rows equal in all of it are one sighting
    order = F.struct("_req", "_pos")
    if max_posts_per_topic is not None:
        # first sightings per (topic, request), then the running sum of each topic
        per_req = (p.groupBy("_id").agg(F.min(order).alias("_o"), F.min_by("topic", order).alias("topic"))
                   .groupBy("topic", F.col("_o._req").alias("_req")).agg(F.count(F.lit(1)).alias("_n")))
        every = p.select("topic", "_req").distinct().join(per_req, ["topic", "_req"], "left")
        w = Window.partitionBy("topic").orderBy("_req").rowsBetween(Window.unboundedPreceding, -1)
        allowed = (every.withColumn("_before", F.coalesce(F.sum(F.coalesce("_n", F.lit(0))).over(w), F.lit(0)))
                   .where(F.col("_before") < max_posts_per_topic)
                   .select(F.col("topic").alias("_t"), F.col("_req").alias("_r")))
        p = p.join(allowed, p.topic.eqNullSafe(allowed._t) & (p._req == allowed._r), "left_semi")
    kept = p.groupBy("_id").agg(F.min_by(F.struct("topic", "d"), order).alias("_first")).select("_first.*")
    thumb = _s(F.col("d.thumbnail"))
    return _signals(kept.select(
        F.to_date(F.timestamp_seconds(F.coalesce(F.col("d.created_utc"), F.lit(0.0)))).alias("date"),
        F.lit(source).alias("source"), "topic",
        F.trim(F.concat_ws(" ", _s(F.col("d.title")), _s(F.col("d.selftext")))).alias("text"),
        (F.coalesce(F.col("d.score"), F.lit(0.0)) + F.coalesce(F.col("d.num_comments"), F.lit(0.0)))
        .alias("engagement"),
        F.concat(F.lit("https://www.reddit.com"), _s(F.col("d.permalink"))).alias("detail"),
        F.when(thumb.startswith("http"), thumb).otherwise(F.lit("")).alias("media_url"),
        F.col("d.id").alias("source_item_id"), F.lit("text").alias("modality_hint")))


def community_signals(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Community listings where the community name is the topic."""
    return post_signals(spark, path, multi_line=multi_line)


# --- S8: topic matcher -----------------------------------------------------------

def topic_terms(topics: DataFrame) -> DataFrame:
    """(topic_ordinal, topic, term) with every matchable term lower-cased."""
    arr = F.array_distinct(F.transform(
        F.concat(F.array("name", "news_query", "spotify_query"), F.col("reddit_terms")),
        lambda t: F.lower(t)))
    return topics.select("topic_ordinal", F.col("name").alias("topic"),
                         F.explode(arr).alias("term")).where(F.col("term") != "")


def match_topic(text: Column, topics: DataFrame) -> Column:
    """Case-insensitive substring match of any topic term; the first topic in
    configuration order wins; null when nothing matches.

    All terms are found in one pass over the text, however many there are.
    """
    rows = (topic_terms(topics).groupBy("topic_ordinal", "topic").agg(F.collect_list("term").alias("terms"))
            .orderBy("topic_ordinal", "topic").collect())   # configuration
    if not rows:
        return F.lit(None).cast("string")
    found = first_group(F.lower(F.coalesce(text, F.lit(""))), [r["terms"] for r in rows])
    return F.get(F.lit([r["topic"] for r in rows]), found)


def x_csv_signals(spark: SparkSession, path: str, topics: DataFrame) -> DataFrame:
    """Post CSV export with alternate column names."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"post CSV not found at {path}")
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    cols = set(raw.columns)

    def first_of(*names):
        present = [F.nullif(F.col(n), F.lit("")) for n in names if n in cols]
        return F.coalesce(*present, F.lit("")) if present else F.lit("")

    text = first_of("text", "full_text")
    metrics = [F.coalesce(F.expr(f"try_cast(`{m}` AS double)"), F.lit(0.0))
               for m in ("likes", "retweets", "reposts", "replies", "quotes", "bookmarks") if m in cols]
    summed = sum(metrics, F.lit(0.0))
    engagement = (F.coalesce(F.expr("try_cast(engagement AS double)"), summed)
                  if "engagement" in cols else summed)
    topic = F.nullif(F.trim(F.col("topic")), F.lit("")) if "topic" in cols else F.lit(None).cast("string")
    topic = F.coalesce(topic, match_topic(text, topics))
    out = raw.select(
        F.expr("try_to_date(substring({}, 1, 10))".format(
            "coalesce(" + ", ".join(f"`{c}`" for c in ("date", "created_at") if c in cols) + ")"
            if {"date", "created_at"} & cols else "CAST(NULL AS STRING)")).alias("date"),
        F.lit("X").alias("source"), topic.alias("topic"), text.alias("text"),
        engagement.alias("engagement"), first_of("url", "tweet_url").alias("detail"),
        first_of("media_url", "image_url").alias("media_url"),
        first_of("id", "tweet_id").alias("source_item_id"), F.lit("text+image").alias("modality_hint"))
    return _signals(out.where(F.col("topic").isNotNull()))


def x_api_signals(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Posts with media resolved through the first attached media key."""
    raw = spark.read.schema(XAPI_SCHEMA).option("multiLine", multi_line).json(path)
    # each document resolves its own media: the last entry of a key that has a url wins
    named = F.filter("includes.media", lambda m: (F.coalesce(m["media_key"], F.lit("")) != "")
                     & (F.coalesce(m["url"], m["preview_image_url"], F.lit("")) != ""))
    posts = raw.select("topic", F.coalesce(named, F.array().cast(raw.schema["includes"].dataType["media"].dataType))
                       .alias("_media"), F.explode("data").alias("p"))
    key = F.try_element_at(F.col("p.attachments.media_keys"), F.lit(1))
    hit = F.try_element_at(F.filter("_media", lambda m: m["media_key"] == key), F.lit(-1))
    j = posts.withColumn("_murl", F.coalesce(hit["url"], hit["preview_image_url"]))
    m = F.col("p.public_metrics")
    eng = sum((F.coalesce(m[k], F.lit(0.0)) for k in ("like_count", "retweet_count", "reply_count",
                                                       "quote_count")), F.lit(0.0))
    return _signals(j.select(
        F.expr("try_to_date(substring(p.created_at, 1, 10))").alias("date"),
        F.lit("X").alias("source"), "topic", _s(F.col("p.text")).alias("text"), eng.alias("engagement"),
        F.concat(F.lit("https://x.com/i/web/status/"), _s(F.col("p.id"))).alias("detail"),
        F.coalesce(F.col("_murl"), F.lit("")).alias("media_url"),
        _s(F.col("p.id")).alias("source_item_id"), F.lit("text+image").alias("modality_hint")))


def union_signals(frames: list[DataFrame]) -> DataFrame:
    """Union by name, missing columns null; error when nothing was loaded."""
    frames = [f for f in frames if f is not None]
    if not frames:
        raise ValueError("No data was loaded from any source.")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def source_status(spark: SparkSession, manifest: list[tuple], signals: DataFrame | None) -> DataFrame:
    """One row per expected source: status, record_count, note.

    ``manifest`` rows are (source, configured, failed, partial, note).
    """
    m = spark.createDataFrame(manifest, "source string, configured boolean, failed boolean, "
                                        "partial boolean, note string")
    if signals is not None:
        counts = signals.groupBy("source").agg(F.count(F.lit(1)).alias("_n"))
        m = m.join(checked_broadcast(counts), "source", "left")
    else:
        m = m.withColumn("_n", F.lit(None).cast("bigint"))
    status = (F.when(~F.col("configured"), "skipped").when(F.col("failed"), "failed")
              .when(F.col("partial"), "loaded_partial").otherwise("loaded"))
    return m.select("source", status.alias("status"),
                    F.when(F.col("configured") & ~F.col("failed"), F.coalesce("_n", F.lit(0)))
                    .otherwise(F.lit(0)).cast("bigint").alias("record_count"), "note")


def append_harvest_log(spark: SparkSession, path: str, batch_id: int, mode: str, top_topic: str,
                       method: str) -> None:
    """One snapshot row per run; rows keyed by batch id, so a
    replayed batch overwrites its own row instead of duplicating it."""
    row = spark.createDataFrame([(batch_id + 1, mode, top_topic, method)],
                                "iteration long, mode string, top_topic string, topic_model_method string")
    row = row.withColumn("captured_at_utc", F.current_timestamp())
    (row.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("iteration").parquet(path))
