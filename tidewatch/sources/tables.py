"""Readers for the parquet tables and the fixture views built on top of them.

The views map the driver's generic tables onto the pipeline's data model:

* ``signals``  one row per mention with text (all events, documents dealt to them in turn)
* ``mentions`` one row per mention without text (all events)
* ``mentions_long`` a multi-year daily series (orders)
* ``audio`` / ``pixels`` per-item audio features and 4x4 RGB images (embeddings)
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Order in which the first seven embedding dimensions become audio features.
AUDIO_DIMENSIONS = ("danceability", "energy", "valence", "tempo",
                    "acousticness", "instrumentalness", "speechiness")
IMAGE_SIDE = 4  # pixels per image row / column in the ``pixels`` view


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _events_and_documents(spark: SparkSession, sf_dir: str, about=()) -> tuple[DataFrame, DataFrame, int]:
    """Events dealt by ``_doc``, documents by ``doc_id``, and the number of documents.

    ``about`` are tables of facts on single events, left-joined by ``source_item_id``.
    Both sides are dealt out by the key over the session's shuffle partitions: the
    join's output carries a text per event, far more than what is shuffled, so
    partitions must not be merged by the size of its input.
    """
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    n = d.select("doc_id").count()
    if not n:
        e, n = e.limit(0), 1
    for facts in about:
        e = e.join(facts.withColumnRenamed("source_item_id", "event_id"), "event_id", "left")
    e = e.withColumn("_doc", F.pmod("event_id", F.lit(n)))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return e.repartition(parts, "_doc"), d.repartition(parts, "doc_id"), n


def signals(spark: SparkSession, sf_dir: str, about=()) -> DataFrame:
    """Mention records with text: every event, with document ``event_id`` modulo
    the number of documents (ids are 0 .. n-1, so no key is hot).

    The columns of the tables in ``about`` (see ``_events_and_documents``) follow.  They
    are joined to the events, before these get their texts: a join with the
    finished records would move every text once more, and in an order that compresses badly."""
    e, d, _ = _events_and_documents(spark, sf_dir, about)
    return (d.hint("merge").join(e, d.doc_id == e["_doc"], "inner")
            .select(F.col("event_id").alias("source_item_id"),
                    F.col("event_type").alias("topic"),
                    F.col("source"),
                    F.col("lang"),
                    F.col("ts").cast("date").alias("date"),
                    F.col("text"),
                    F.col("value").alias("engagement"),
                    *[c for facts in about for c in facts.columns if c != "source_item_id"]))


def signal_pages(spark: SparkSession, sf_dir: str, page_size: int) -> DataFrame:
    """``signals`` by page: (topic, date, text, ids), the events of one topic, day and
    text that fall in a block of ``page_size`` of the text's events.

    The pages are made of event ids, before the texts are joined: no text is moved
    after the join, and where the events are already dealt out by document.
    """
    e, d, n = _events_and_documents(spark, sf_dir)
    block = F.floor(F.col("event_id") / (F.lit(page_size) * F.lit(n)))
    e = (e.where("_doc IS NOT NULL")
         .groupBy("_doc", F.col("event_type").alias("topic"), F.col("ts").cast("date").alias("date"), block.alias("_block"))
         .agg(F.collect_list("event_id").alias("ids")))
    return d.hint("merge").join(e, d.doc_id == e["_doc"], "inner").select("topic", "date", "text", "ids")


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id"),
        F.col("event_type").alias("topic"),
        F.concat(F.lit("u"), F.pmod(F.col("user_id"), F.lit(4)).cast("string")).alias("source"),
        F.col("ts").cast("date").alias("date"),
        F.col("value").alias("engagement"),
    )


def mentions_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderpriority").alias("topic"),
                    F.col("o_orderdate").cast("date").alias("day"),
                    F.col("o_totalprice").alias("engagement"))


def _unit(v) -> F.Column:
    return (F.lit(1.0) + v.cast("double")) / F.lit(2.0)


def audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audio features per item: ``(1 + embedding[i]) / 2``; tempo scaled to 60..180."""
    emb = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    cols = [F.col("vec_id")]
    for i, name in enumerate(AUDIO_DIMENSIONS):
        v = _unit(F.element_at("embedding", i + 1))
        if name == "tempo":
            v = v * F.lit(120.0) + F.lit(60.0)
        cols.append(v.alias(f"audio_{name}"))
    return emb.select(*cols)


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long pixel table (image, x, y, r, g, b) from the first 48 embedding values.

    Built per row with array functions (no shuffle): value i is channel i % 3
    of pixel i div 3, pixels laid out row-major on a 4x4 grid.
    """
    emb = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    n_px = IMAGE_SIDE * IMAGE_SIDE

    def chan(p, k):
        v = F.element_at(F.col("embedding"), p * 3 + k + 1).cast("double")
        return (F.least(F.greatest(v, F.lit(-1.0)), F.lit(1.0)) + 1.0) / 2.0

    px = F.transform(F.sequence(F.lit(0), F.lit(n_px - 1)),
                     lambda p: F.struct(p.alias("p"), chan(p, 0).alias("r"),
                                        chan(p, 1).alias("g"), chan(p, 2).alias("b")))
    return (emb.select(F.col("vec_id").alias("image"), F.explode(px).alias("px"))
            .select("image",
                    F.pmod(F.col("px.p"), F.lit(IMAGE_SIDE)).alias("x"),
                    F.floor(F.col("px.p") / IMAGE_SIDE).cast("int").alias("y"),
                    F.col("px.r").alias("r"), F.col("px.g").alias("g"),
                    F.col("px.b").alias("b")))


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per image of ``pixels``: (image, width, r, g, b), the channels as
    row-major arrays; values that the embedding lacks are null."""
    emb = read_table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("image"), "embedding")

    def channel(k):
        return F.transform(F.sequence(F.lit(0), F.lit(IMAGE_SIDE * IMAGE_SIDE - 1)), lambda p: (F.least(F.greatest(
            F.get("embedding", p * 3 + k).cast("double"), F.lit(-1.0)), F.lit(1.0)) + 1.0) / 2.0)

    return (emb.where("embedding IS NOT NULL")
            .select("image", F.lit(IMAGE_SIDE).alias("width"), *[channel(k).alias(c) for k, c in enumerate("rgb")]))
