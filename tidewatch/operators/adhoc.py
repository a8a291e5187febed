"""Ad-hoc search and report-view table operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.joins import one_row


def parse_search_terms(requests: DataFrame, text_col: str, key_cols: list[str]) -> DataFrame:
    """Newline -> comma, split, trim, drop blanks, case-insensitive
    first-wins dedup within each request.  Output (keys..., pos, term)."""
    parts = requests.select(*key_cols, F.posexplode(
        F.split(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), "\n", ","), ",")).alias("pos", "raw"))
    terms = parts.select(*key_cols, "pos", F.trim("raw").alias("term")).where(F.col("term") != "")
    # per request and lower-cased term keep the first position (grouped on a
    # high-cardinality request key, so no hot group)
    first = terms.groupBy(*key_cols, F.lower("term").alias("_k")).agg(
        F.min_by(F.struct("pos", "term"), F.col("pos")).alias("_f"))
    return first.select(*key_cols, F.col("_f.pos").alias("pos"), F.col("_f.term").alias("term"))


def union_first_wins(primary: DataFrame, secondary: DataFrame, name_col: str = "name",
                     order_cols: tuple[str, ...] = ()) -> DataFrame:
    """Rows of ``primary`` win over ``secondary`` on lower(name); within a
    side the smallest ``order_cols`` wins.  Output (name, origin)."""
    def side(df, prio, origin):
        order = F.struct(F.lit(prio).alias("_p"), *[F.col(c) for c in order_cols]) if order_cols \
            else F.struct(F.lit(prio).alias("_p"))
        return df.select(F.col(name_col).alias("name"), order.alias("_o"), F.lit(origin).alias("origin"))
    both = side(primary, 0, "search").unionByName(side(secondary, 1, "saved"))
    best = both.groupBy(F.lower("name").alias("_k")).agg(F.min_by(F.struct("name", "origin"), F.col("_o")).alias("_b"))
    return best.select(F.col("_b.name").alias("name"), F.col("_b.origin").alias("origin"))


def filter_topics(df: DataFrame, selected: DataFrame) -> DataFrame:
    """Keep rows whose topic is in the selection (left-semi join; the
    planner broadcasts a selection of small size)."""
    return df.join(selected.select("topic").distinct(), "topic", "left_semi")


def kpis(final: DataFrame, status: DataFrame | None = None, log: DataFrame | None = None) -> DataFrame:
    """A10: top topic, loaded sources, total mentions, last harvest time."""
    k = final.agg(F.max_by("topic", F.struct("final_score_with_novelty", F.col("topic"))).alias("top_topic"),
                  F.sum("mention_count").cast("bigint").alias("total_mentions"))
    if status is not None:
        s = status.agg(F.count_if(F.col("status").isin("loaded", "loaded_partial")).cast("bigint")
                       .alias("active_sources"))
        k = k.crossJoin(one_row(s))
    if log is not None:
        k = k.crossJoin(one_row(log.agg(F.max("captured_at_utc").alias("last_harvest_utc"))))
    return k


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Frequency table, most frequent first."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), F.asc(col))


def topic_list(df: DataFrame) -> DataFrame:
    """Distinct non-null topics."""
    return df.where(F.col("topic").isNotNull()).select("topic").distinct()
