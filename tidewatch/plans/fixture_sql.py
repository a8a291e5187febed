"""DuckDB definitions of the fixture views, used by the oracle SQL.

They mirror ``tidewatch.sources.tables`` and the parameter tables in
``tidewatch.plans.params`` and are prepended as CTEs.
"""

from __future__ import annotations

from tidewatch.functions.text import WHITE_SPACE
from tidewatch.plans import params

SIGNALS = """signals AS (
  SELECT e.event_id AS source_item_id, e.event_type AS topic, d.source, d.lang,
         CAST(e.ts AS DATE) AS date, d.text, e.value AS engagement
  FROM events e JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents))"""

MENTIONS = """mentions AS (
  SELECT event_id, event_type AS topic, 'u' || CAST(user_id % 4 AS VARCHAR) AS source,
         CAST(ts AS DATE) AS date, value AS engagement
  FROM events)"""

MENTIONS_LONG = """mentions_long AS (
  SELECT o_orderpriority AS topic, CAST(o_orderdate AS DATE) AS day,
         o_totalprice AS engagement
  FROM orders)"""

AUDIO = """audio AS (
  SELECT vec_id,
    (1 + CAST(list_extract(embedding, 1) AS DOUBLE)) / 2 AS audio_danceability,
    (1 + CAST(list_extract(embedding, 2) AS DOUBLE)) / 2 AS audio_energy,
    (1 + CAST(list_extract(embedding, 3) AS DOUBLE)) / 2 AS audio_valence,
    (1 + CAST(list_extract(embedding, 4) AS DOUBLE)) / 2 * 120 + 60 AS audio_tempo,
    (1 + CAST(list_extract(embedding, 5) AS DOUBLE)) / 2 AS audio_acousticness,
    (1 + CAST(list_extract(embedding, 6) AS DOUBLE)) / 2 AS audio_instrumentalness,
    (1 + CAST(list_extract(embedding, 7) AS DOUBLE)) / 2 AS audio_speechiness
  FROM embeddings)"""

PIXELS = """pixels AS (
  SELECT image, p % 4 AS x, p // 4 AS y,
         max(CASE WHEN k = 0 THEN v END) AS r,
         max(CASE WHEN k = 1 THEN v END) AS g,
         max(CASE WHEN k = 2 THEN v END) AS b
  FROM (
    SELECT vec_id AS image, (i - 1) // 3 AS p, (i - 1) % 3 AS k,
           (least(greatest(CAST(embedding[i] AS DOUBLE), -1.0), 1.0) + 1.0) / 2.0 AS v
    FROM embeddings, range(1, 49) t(i))
  GROUP BY image, p)"""

_CLEAN = ("trim(regexp_replace(regexp_replace(regexp_replace(lower(coalesce(@c, '')), "
          "'http[^@s]+', '', 'g'), '[^a-zA-Z@s]', '@p', 'g'), '[@s]+', ' ', 'g'))")


def clean(col: str, punct: str = " ") -> str:
    return _CLEAN.replace("@c", col).replace("@p", punct).replace("@s", WHITE_SPACE)


def lexicon_cte() -> str:
    rows = ", ".join(f"('{w}', CAST({p} AS DOUBLE))" for w, p in params.LEXICON)
    return f"lexicon(word, polarity) AS (VALUES {rows})"


def negators_cte() -> str:
    rows = ", ".join(f"('{w}')" for w in params.NEGATORS)
    return f"negators(word) AS (VALUES {rows})"


def sentiment_cte(src: str = "signals") -> str:
    """Per-record lexicon sentiment (P3) computed the long way: unnest + lag."""
    return f"""toks AS (
  SELECT source_item_id, tok, pos,
         lag(tok) OVER (PARTITION BY source_item_id ORDER BY pos) AS prev
  FROM (SELECT source_item_id,
               unnest(string_split(ct, ' ')) AS tok,
               unnest(range(1, len(string_split(ct, ' ')) + 1)) AS pos
        FROM (SELECT source_item_id, {clean('text')} AS ct FROM {src}) WHERE ct <> '')),
sent AS (
  SELECT t.source_item_id,
         least(greatest(avg(l.polarity * CASE WHEN t.prev IN (SELECT word FROM negators)
                                              THEN -0.5 ELSE 1.0 END), -1.0), 1.0) AS sentiment
  FROM toks t JOIN lexicon l ON l.word = t.tok
  GROUP BY t.source_item_id)"""


def prepared_cte(src: str = "signals") -> str:
    """P2 + P1 + P3 + N1 over ``src``: adds clean_text, sentiment, engagement_norm."""
    return f"""{lexicon_cte()}, {negators_cte()}, {sentiment_cte(src)},
smax AS (SELECT source, max(engagement) AS m FROM {src} WHERE source IS NOT NULL GROUP BY source),
prepared AS (
  SELECT s.*, {clean('s.text')} AS clean_text, coalesce(se.sentiment, 0.0) AS sentiment,
         s.engagement / CASE WHEN smax.m = 0 THEN 1 ELSE smax.m END AS engagement_norm
  FROM {src} s LEFT JOIN smax ON smax.source = s.source
  LEFT JOIN sent se ON se.source_item_id = s.source_item_id)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
