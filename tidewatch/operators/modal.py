"""Visual and audio modality features.

All per-record features are column expressions evaluated in place.  Image
statistics are computed once per distinct media key (J11) from a long pixel
table with one shuffle keyed by image (bounded group: the pixels of one
picture), then attached to the records through a size-checked broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.keywords import distinct_hits
from tidewatch.functions.text import stable_seed
from tidewatch.operators.joins import checked_broadcast
from tidewatch.plans import params

VISUAL_COLS = ("visual_brightness", "visual_colorfulness", "visual_saturation",
               "visual_edge_density")
IMAGE_COLS = tuple("_img_" + c[7:] for c in VISUAL_COLS)   # statistics attached to a record
AUDIO_FEATURES = ("audio_danceability", "audio_energy", "audio_valence", "audio_tempo",
                  "audio_acousticness", "audio_instrumentalness", "audio_speechiness")


def _clip01(c: Column) -> Column:
    return F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))


def _known(topic: Column, table, idx: int) -> Column:
    expr = None
    for row in table:
        cond = topic == F.lit(row[0])
        expr = F.when(cond, F.lit(row[idx])) if expr is None else expr.when(cond, F.lit(row[idx]))
    return expr.otherwise(F.lit(None).cast("double"))


def visual_defaults(topic: Column) -> dict[str, Column]:
    """Fixed profile for known topics, else derived from the topic's seed."""
    seed = stable_seed(topic)
    v = params.TOPIC_VISUAL_DEFAULTS
    return {
        "visual_brightness": F.coalesce(
            _known(topic, v, 1), F.round(0.48 + F.pmod(seed, F.lit(24)) / 100.0, 3)),
        "visual_colorfulness": F.coalesce(
            _known(topic, v, 2), F.round(0.34 + F.pmod(F.floor(seed / 3), F.lit(40)) / 100.0, 3)),
        "visual_edge_density": F.coalesce(
            _known(topic, v, 3), F.round(0.28 + F.pmod(F.floor(seed / 5), F.lit(42)) / 100.0, 3)),
    }


def audio_defaults(topic: Column) -> dict[str, Column]:
    """P9."""
    seed = stable_seed(topic)
    a = params.TOPIC_AUDIO_DEFAULTS
    return {
        "audio_energy_score": F.coalesce(
            _known(topic, a, 1), F.round(0.38 + F.pmod(seed, F.lit(30)) / 100.0, 3)),
        "audio_novelty_signal": F.coalesce(
            _known(topic, a, 2), F.round(0.34 + F.pmod(F.floor(seed / 7), F.lit(34)) / 100.0, 3)),
    }


def topic_defaults(topics: DataFrame) -> DataFrame:
    """P7-P9 as a table: one row per topic with its seed and default profiles."""
    t = F.col("topic")
    cols = {**visual_defaults(t), **audio_defaults(t)}
    return topics.select("topic", stable_seed(t).alias("topic_seed"),
                         *[c.alias(n) for n, c in cols.items()])


# --- A12 / J11: image statistics ---------------------------------------------

def pixel_stats(pixels: DataFrame) -> DataFrame:
    """A12 on a long pixel table (image, x, y, r, g, b) with channels in [0, 1]."""
    gray = (F.col("r") + F.col("g") + F.col("b")) / 3.0
    mx = F.greatest("r", "g", "b")
    mn = F.least("r", "g", "b")
    px = pixels.select(
        "image", "x", "y", gray.alias("gray"),
        ((mx - mn) / F.when(mx == 0, F.lit(1.0)).otherwise(mx)).alias("sat"),
        F.abs(F.col("r") - F.col("g")).alias("rg"),
        F.abs(0.5 * (F.col("r") + F.col("g")) - F.col("b")).alias("yb"))
    row_major = Window.partitionBy("image").orderBy("y", "x")
    col_major = Window.partitionBy("image").orderBy("x", "y")
    px = (px.withColumn("_dx", F.when((F.lag("y").over(row_major) == F.col("y"))
                                      & (F.lag("x").over(row_major) == F.col("x") - 1),
                                      F.abs(F.col("gray") - F.lag("gray").over(row_major))))
          .withColumn("_dy", F.when((F.lag("x").over(col_major) == F.col("x"))
                                    & (F.lag("y").over(col_major) == F.col("y") - 1),
                                    F.abs(F.col("gray") - F.lag("gray").over(col_major)))))
    colorful = (F.sqrt(F.var_pop("rg") + F.var_pop("yb"))
                + 0.3 * F.sqrt(F.avg("rg") ** 2 + F.avg("yb") ** 2)) / 1.5
    return px.groupBy("image").agg(
        F.avg("gray").alias("visual_brightness"),
        F.least(F.lit(1.0), colorful).alias("visual_colorfulness"),
        F.avg("sat").alias("visual_saturation"),
        F.least(F.lit(1.0), 6.0 * (F.coalesce(F.avg("_dx"), F.lit(0.0))
                                   + F.coalesce(F.avg("_dy"), F.lit(0.0)))).alias("visual_edge_density"))


def _mean(values):
    """Mean of an array's values that are not null (null if there are none)."""
    kept = F.filter(values, lambda v: v.isNotNull())
    return F.when(F.size(kept) > 0, F.aggregate(kept, F.lit(0.0), lambda s, v: s + v) / F.size(kept))


def image_stats(images: DataFrame) -> DataFrame:
    """A12 on whole images (image, width, r, g, b; row-major channel arrays):
    one projection without pixel rows, windows or shuffles.  The table has one
    row per image; pixels with a null channel take part in nothing."""
    def per_pixel(f):
        return F.transform(F.arrays_zip("r", "g", "b"), lambda p: f(p["r"], p["g"], p["b"]))

    def whole(r, g, b, value):   # least and greatest would skip a null channel
        return F.when(r.isNotNull() & g.isNotNull() & b.isNotNull(), value)

    def saturation(r, g, b):
        top = F.greatest(r, g, b)
        return whole(r, g, b, (top - F.least(r, g, b)) / F.when(top == 0, F.lit(1.0)).otherwise(top))

    px = images.select("image", "width", per_pixel(lambda r, g, b: (r + g + b) / 3.0).alias("_gray"),
                       per_pixel(saturation).alias("_sat"), per_pixel(lambda r, g, b: whole(r, g, b, F.abs(r - g))).alias("_rg"),
                       per_pixel(lambda r, g, b: F.abs(0.5 * (r + g) - b)).alias("_yb"))
    gray, width, n = F.col("_gray"), F.col("width"), F.size("_gray")
    # a pixel less its left neighbour (none in the first column) and less the one above
    across = F.transform(F.slice(gray, F.lit(2), F.greatest(n - 1, F.lit(0))), lambda v, i: F.when(
        F.pmod(i + 1, width) != 0, F.abs(v - F.get(gray, i))))
    down = F.transform(F.slice(gray, width + 1, F.greatest(n - width, F.lit(0))), lambda v, i: F.abs(v - F.get(gray, i)))
    px = px.select("image", _mean(gray).alias("visual_brightness"), _mean(F.col("_sat")).alias("visual_saturation"),
                   "_rg", "_yb", _mean(F.col("_rg")).alias("_mrg"), _mean(F.col("_yb")).alias("_myb"),
                   _mean(across).alias("_dx"), _mean(down).alias("_dy"))
    spread = [_mean(F.transform(c, lambda v: (v - F.col(m)) * (v - F.col(m)))) for c, m in (("_rg", "_mrg"), ("_yb", "_myb"))]
    colorful = (F.sqrt(spread[0] + spread[1]) + 0.3 * F.sqrt(F.col("_mrg") ** 2 + F.col("_myb") ** 2)) / 1.5
    return px.select("image", "visual_brightness", F.least(F.lit(1.0), colorful).alias("visual_colorfulness"), "visual_saturation",
                     F.least(F.lit(1.0), 6.0 * (F.coalesce("_dx", F.lit(0.0)) + F.coalesce("_dy", F.lit(0.0))))
                     .alias("visual_edge_density"))


def image_features_for(records: DataFrame, pictures: DataFrame, key: str = "media_url") -> DataFrame:
    """Statistics once per distinct referenced media key.  ``pictures`` is a
    table of whole images (see ``image_stats``) or a long pixel table."""
    keys = records.where(F.col(key).isNotNull()).select(F.col(key).alias("image")).distinct()
    used = pictures.join(keys, "image", "left_semi")
    return (image_stats(used) if "width" in pictures.columns else pixel_stats(used)).withColumnRenamed("image", key)


# --- P11 / P12: visual features per record ------------------------------------

def image_columns(image_features: DataFrame, key: str = "media_url") -> DataFrame:
    """The statistics as ``IMAGE_COLS`` by ``key``, to be joined to records; broadcast up to a checked size."""
    return checked_broadcast(image_features.select(key, *[F.col(c).alias(i) for c, i in zip(VISUAL_COLS, IMAGE_COLS)]))


def visual_features(records: DataFrame, image_features: DataFrame | None = None,
                    key: str = "media_url") -> DataFrame:
    """Attach image statistics (if any) and fall back to the topic profile.

    Records that have ``IMAGE_COLS`` already need no ``image_features``: with very many
    pictures these are best joined before the records get their texts."""
    out = records
    if image_features is not None:
        out = out.join(image_columns(image_features, key), key, "left")
    attached = IMAGE_COLS[0] in out.columns
    has = F.col("_img_brightness").isNotNull() if attached else F.lit(False)
    d = visual_defaults(F.col("topic"))
    sent = F.coalesce(F.col("sentiment").cast("double"), F.lit(0.0))

    def pick(name, fallback):
        img = F.col("_img_" + name[7:]) if attached else F.lit(None)
        return F.when(has, img).otherwise(fallback)

    out = out.select(
        "*",
        pick("visual_brightness", _clip01(d["visual_brightness"] + 0.10 * sent)).alias("visual_brightness"),
        pick("visual_colorfulness", d["visual_colorfulness"]).alias("visual_colorfulness"),
        pick("visual_saturation", F.least(F.lit(1.0), d["visual_colorfulness"] * 0.85 + 0.08))
        .alias("visual_saturation"),
        pick("visual_edge_density", d["visual_edge_density"]).alias("visual_edge_density"))
    out = out.drop(*IMAGE_COLS)
    b, c = F.col("visual_brightness"), F.col("visual_colorfulness")
    e, s = F.col("visual_edge_density"), F.col("visual_saturation")
    return (out.withColumn("visual_energy", 0.35 * b + 0.35 * c + 0.30 * e)
            .withColumn("visual_innovation",
                        0.45 * c + 0.35 * e + 0.20 * (1 - F.abs(0.5 - s))))


# --- P13 / P14: audio features per record -------------------------------------

def _num(name: str, df_cols) -> Column:
    return F.col(name).cast("double") if name in df_cols else F.lit(None).cast("double")


def audio_features(records: DataFrame, genre_keywords=None) -> DataFrame:
    cols = set(records.columns)
    d, e, v, t, a, i, sp = (_num(c, cols) for c in AUDIO_FEATURES)
    defaults = audio_defaults(F.col("topic"))
    missing = d.isNull() | e.isNull() | v.isNull()
    tempo_norm = F.when(t.isNull(), F.lit(0.0)).otherwise(
        _clip01((F.when(t == 0, F.lit(120.0)).otherwise(t) - 60.0) / 120.0))
    a0, i0, sp0 = (F.coalesce(x, F.lit(0.0)) for x in (a, i, sp))
    energy = _clip01(0.35 * e + 0.25 * d + 0.20 * v + 0.20 * tempo_norm)
    novelty = _clip01(0.35 * (1 - a0) + 0.30 * i0 + 0.20 * sp0 + 0.15 * tempo_norm)
    # the keyword scan is materialised once; the rule chain refers to it often
    records = records.withColumn("_kw", keyword_struct(
        F.col("text") if "text" in cols else F.lit(""), genre_keywords))
    label, conf = genre_columns(records, genre_keywords, kw_col="_kw")
    return records.select(
        "*",
        F.when(missing, defaults["audio_energy_score"]).otherwise(energy).alias("audio_energy_score"),
        F.when(missing, defaults["audio_novelty_signal"]).otherwise(novelty).alias("audio_novelty_signal"),
        F.when(missing, defaults["audio_energy_score"]).otherwise(tempo_norm).alias("audio_tempo_norm"),
        label.alias("audio_genre_label"), conf.alias("audio_genre_confidence")).drop("_kw")


def keyword_struct(text: Column, genre_keywords=None) -> Column:
    """struct(hits, neg_ord, genre) of the genre with most distinct keyword
    hits (ties -> table order)."""
    table = genre_keywords or params.GENRE_KEYWORDS
    hits = distinct_hits(F.lower(F.coalesce(text, F.lit(""))), [kws for _, kws in table])
    genres = F.lit([genre for genre, _ in table])
    return F.array_max(F.transform(hits, lambda n, i: F.struct(n.alias("hits"), (-i).alias("neg_ord"), F.get(genres, i).alias("genre"))))


def keyword_genre(text: Column, genre_keywords=None) -> tuple[Column, Column]:
    """Genre with most distinct keyword hits (ties -> table order) and its hit count."""
    best = keyword_struct(text, genre_keywords)
    return best["genre"], best["hits"]


def genre_columns(records: DataFrame, genre_keywords=None, kw_col: str | None = None) -> tuple[Column, Column]:
    """(label, confidence) from audio features with keyword fallbacks.
    ``kw_col`` names an already computed ``keyword_struct`` column."""
    cols = set(records.columns)
    d, e, v, _, a, i, sp = (_num(c, cols) for c in AUDIO_FEATURES)
    if kw_col:
        kg, hits = F.col(kw_col)["genre"], F.col(kw_col)["hits"]
    else:
        kg, hits = keyword_genre(F.col("text") if "text" in cols else F.lit(""), genre_keywords)
    v0 = F.coalesce(v, F.lit(0.5))
    a0, i0, sp0 = (F.coalesce(x, F.lit(0.0)) for x in (a, i, sp))
    topic_default = _known_str(F.col("topic"), params.TOPIC_DEFAULT_GENRE, params.FALLBACK_GENRE)
    no_audio = d.isNull() | e.isNull()
    label = (F.when(no_audio, F.when(hits > 0, kg).otherwise(topic_default))
             .when((a0 > 0.65) & (i0 > 0.35), F.lit("ambient"))
             .when(sp0 > 0.33, F.lit("hiphop"))
             .when((e > 0.72) & (d > 0.58), F.lit("electronic"))
             .when((a0 > 0.45) & (e < 0.45), F.lit("indie"))
             .when((i0 > 0.55) & (a0 > 0.45), F.lit("classical"))
             .when((v0 > 0.58) & (d > 0.55), F.lit("pop"))
             .otherwise(kg))
    conf = (F.when(no_audio, F.when(hits > 0, F.lit(0.75)).otherwise(F.lit(0.55)))
            .when((a0 > 0.65) & (i0 > 0.35), F.lit(0.82))
            .when(sp0 > 0.33, F.lit(0.78))
            .when((e > 0.72) & (d > 0.58), F.lit(0.80))
            .when((a0 > 0.45) & (e < 0.45), F.lit(0.73))
            .when((i0 > 0.55) & (a0 > 0.45), F.lit(0.70))
            .when((v0 > 0.58) & (d > 0.55), F.lit(0.68))
            .otherwise(F.when(hits > 0, F.lit(0.60)).otherwise(F.lit(0.52))))
    return label, conf


def _known_str(topic: Column, table, default: str) -> Column:
    expr = None
    for name, value in table:
        cond = topic == F.lit(name)
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return expr.otherwise(F.lit(default))


def enrich(records: DataFrame, image_features: DataFrame | None = None,
           genre_keywords=None, key: str = "media_url") -> DataFrame:
    """Visual + audio enrichment of prepared records."""
    return audio_features(visual_features(records, image_features, key), genre_keywords)


# --- A3 / A4 / W7 / N7 ---------------------------------------------------------

MODAL_MEANS = ("visual_brightness", "visual_colorfulness", "visual_edge_density", "visual_energy",
               "visual_innovation", "audio_energy_score", "audio_novelty_signal",
               "audio_tempo_norm", "audio_genre_confidence")


def _modal_partials(enriched: DataFrame, extra_sums: dict | None = None) -> DataFrame:
    """One pass over the records: counts and feature sums per (topic, genre,
    source).  Every topic-level summary is derived from this small table.
    ``extra_sums`` (name -> per-record column) adds further additive sums."""
    extra = extra_sums or {}
    return (enriched.where(F.col("topic").isNotNull())
            .groupBy("topic", "audio_genre_label", "source")
            .agg(F.count(F.lit(1)).alias("_n"),
                 *[F.sum(c).alias(f"_s_{c}") for c in MODAL_MEANS],
                 *[F.count(c).alias(f"_c_{c}") for c in MODAL_MEANS],
                 *[F.sum(col).alias(name) for name, col in extra.items()])).checkpoint()


def genre_counts(enriched: DataFrame, partials: DataFrame | None = None) -> DataFrame:
    """Records per (topic, genre); without ``partials`` only what the genre needs is computed."""
    if partials is None:
        named = enriched.where(F.col("topic").isNotNull() & F.col("audio_genre_label").isNotNull())
        return named.groupBy("topic", "audio_genre_label").agg(F.count(F.lit(1)).alias("record_count"))
    return (partials.where(F.col("audio_genre_label").isNotNull())
            .groupBy("topic", "audio_genre_label").agg(F.sum("_n").alias("record_count")))


def audio_genre_summary(enriched: DataFrame, partials: DataFrame | None = None) -> DataFrame:
    """A4 + N7: counts per (topic, genre) and share within topic."""
    counts = genre_counts(enriched, partials)
    w = Window.partitionBy("topic")  # topic x genre table: a handful of rows per topic
    tot = F.sum("record_count").over(w)
    return (counts.withColumn("share_within_topic", F.col("record_count")
                              / F.when(tot == 0, F.lit(1)).otherwise(tot))
            .orderBy(F.asc("topic"), F.desc("share_within_topic"), F.asc("audio_genre_label")))


def dominant_genre(enriched: DataFrame, partials: DataFrame | None = None) -> DataFrame:
    """Most frequent genre per topic, ties -> smallest label."""
    w = Window.partitionBy("topic").orderBy(F.desc("record_count"), F.asc("audio_genre_label"))
    return (genre_counts(enriched, partials).withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1)
            .select("topic", F.col("audio_genre_label").alias("dominant_audio_genre")))


def modal_topic_summary(enriched: DataFrame, partials: DataFrame | None = None) -> DataFrame:
    """A3 + J2 from one aggregation pass over the records."""
    p = partials if partials is not None else _modal_partials(enriched)
    summary = (p.groupBy("topic")
               .agg(*[(F.sum(f"_s_{c}") / F.sum(f"_c_{c}")).alias(c) for c in MODAL_MEANS],
                    F.count_distinct("source").alias("modality_coverage")))
    return summary.join(dominant_genre(enriched, p), "topic", "left")
