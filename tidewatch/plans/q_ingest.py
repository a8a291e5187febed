"""Registered queries: topic matching and landed-payload ingest over data that
Spark derives from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.plans import params
from tidewatch.plans.fixture_sql import SIGNALS, with_ctes
from tidewatch.plans.registry import register
from tidewatch.session import scratch_path
from tidewatch.sources import config as C
from tidewatch.sources import ingest as I
from tidewatch.sources import tables


def fixture_topics(spark):
    return C.topics_frame(spark, params.FIXTURE_TOPICS)


def _terms_sql() -> str:
    rows = []
    for i, (name, news, track, terms, _) in enumerate(params.FIXTURE_TOPICS):
        for t in dict.fromkeys(x.lower() for x in (name, news, track, *terms)):
            rows.append(f"({i}, '{name}', '{t}')")
    return "terms(o, topic, term) AS (VALUES " + ", ".join(rows) + ")"


@register("s8_topic_match", with_ctes(SIGNALS, _terms_sql()) + """
SELECT s.source_item_id, m.topic AS matched_topic
FROM signals s LEFT JOIN (
  SELECT source_item_id, arg_min(t.topic, t.o) AS topic
  FROM signals s2 JOIN terms t ON contains(lower(coalesce(s2.text, '')), t.term)
  GROUP BY source_item_id) m ON m.source_item_id = s.source_item_id""")
def s8_topic_match(spark, sf_dir):
    s = tables.signals(spark, sf_dir)
    return s.select("source_item_id",
                    I.match_topic(F.col("text"), fixture_topics(spark)).alias("matched_topic"))


PAGE_SIZE = 20   # articles per landed request


def _landed_news(spark, sf_dir) -> str:
    """Documents + events landed as article payloads (JSON Lines, one document
    per request, compressed), written by Spark to the shared folder.

    A request holds a topic's articles of one day and text, at most PAGE_SIZE of
    them, however hot a topic-day is; texts are not shuffled to be grouped."""
    title = F.substring_index("text", "\n", 1)
    rest = F.expr("substring(text, length(substring_index(text, '\n', 1)) + 2)")
    pages = tables.signal_pages(spark, sf_dir, PAGE_SIZE).select(
        "topic", "ids", title.alias("_title"), rest.alias("_rest"), F.date_format("date", "yyyy-MM-dd'T'00:00:00'Z'").alias("_at"))
    art = F.transform("ids", lambda i: F.struct(
        F.col("_title").alias("title"), F.col("_rest").alias("description"), F.col("_at").alias("publishedAt"),
        F.concat(F.lit("doc://"), i.cast("string")).alias("url"), F.lit(None).cast("string").alias("urlToImage")))
    payload = pages.select("topic", F.lit(0).cast("bigint").alias("request_ordinal"), art.alias("articles"))
    path = scratch_path(spark, "landed-news")
    payload.write.mode("overwrite").option("compression", "gzip").json(path)
    return path


@register("s2_news_ingest", with_ctes(SIGNALS) + """,
a AS (SELECT *, split_part(text, chr(10), 1) AS title FROM signals)
SELECT date, 'NewsAPI' AS source, topic,
       trim(concat_ws(' ', title, coalesce(substr(text, length(title) + 2), ''))) AS text,
       round(greatest(length(title) / 10.0, 1.0), 6) AS engagement,
       'doc://' || CAST(source_item_id AS VARCHAR) AS detail, '' AS media_url,
       'doc://' || CAST(source_item_id AS VARCHAR) AS source_item_id, 'text+image' AS modality_hint
FROM a""")
def s2_news_ingest(spark, sf_dir):
    """Article payloads derived from documents are landed, then normalised."""
    return I.news_signals(spark, _landed_news(spark, sf_dir))


@register("s11_s12_source_status", with_ctes(SIGNALS) + """
SELECT 'NewsAPI' AS source, 'loaded' AS status, CAST(count(*) AS BIGINT) AS record_count,
       'articles landed' AS note FROM signals
UNION ALL SELECT 'Spotify', 'skipped', CAST(0 AS BIGINT), 'no track payloads configured'
UNION ALL SELECT 'Reddit', 'skipped', CAST(0 AS BIGINT), 'no post payloads configured'
UNION ALL SELECT 'X', 'skipped', CAST(0 AS BIGINT), 'no post export configured'""")
def s11_s12_source_status(spark, sf_dir):
    news = I.news_signals(spark, _landed_news(spark, sf_dir))
    sig = I.union_signals([news])
    manifest = [("NewsAPI", True, False, False, "articles landed"),
                ("Spotify", False, False, False, "no track payloads configured"),
                ("Reddit", False, False, False, "no post payloads configured"),
                ("X", False, False, False, "no post export configured")]
    return I.source_status(spark, manifest, sig)
