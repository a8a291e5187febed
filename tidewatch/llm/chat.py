"""Chat formatting in budgeted windows (operator 8).

Column expressions and windows only.  Prefix sums of turn tokens put each turn
into the span ``before // span_budget`` (``before``: tokens of the turns before
it), so spans are turn-aligned and found without a sequential pass.  A window
holds, in order: the conversation's system turn (if its first turn is one),
the turns right before the span within ``history_budget`` tokens, and the
span's own turns.  Repeated turns stand outside the loss mask; each assistant
turn is a target exactly once.

Template: ``<|role|>\\n`` text ``<|end|>\\n``.  Inside texts ``~`` becomes
``~0`` and ``<|`` becomes ``~1`` (in roles also ``|`` to ``~2``), so no text
can hold a control string and reading back restores it.

The prefix sum is taken in two levels (inside ``CHUNK`` turns, then over the
chunk sums), so one conversation holding a third of all rows is spread over
many tasks; a window gathers no more than its budget plus one turn.

Edge cases: null text or role counts as empty; turns are ordered by turn
number (null first), then role and text; repeated rows are turns of their own;
a null conv_id is a conversation; empty table, empty result; extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPAN_BUDGET = 512
HISTORY_BUDGET = 256
CHUNK = 256
TURN_OVERHEAD = 4


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("~"), F.lit("~0")), F.lit("<|"), F.lit("~1"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("~1"), F.lit("<|")), F.lit("~0"), F.lit("~"))


def turn_tokens(text: Column) -> Column:
    """Token estimate of a turn: a token per four bytes plus the template's."""
    return F.ceil(F.octet_length(text) / 4).cast("bigint") + TURN_OVERHEAD


def chat_windows(turns: DataFrame, span_budget: int = SPAN_BUDGET, history_budget: int = HISTORY_BUDGET) -> DataFrame:
    """(conv_id, span, formatted, loss, n_turns, n_repeated, n_tokens): one row
    per window; ``loss`` are (start, end) code point ranges of ``formatted``."""
    if not 0 <= history_budget < span_budget:
        raise ValueError("the history has to be smaller than a span")
    rows = turns.select(
        F.col("conv_id"), F.coalesce(F.col("turn").cast("bigint"), F.lit(-(1 << 62))).alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumns({"tokens": turn_tokens(F.col("text")), "chunk": F.floor(F.col("turn") / CHUNK)})

    before = Window.unboundedPreceding, -1
    inside = Window.partitionBy("conv_id", "chunk").orderBy("turn", "role", "text").rowsBetween(*before)
    sums = rows.groupBy(F.col("conv_id").alias("c"), F.col("chunk").alias("k")).agg(F.sum("tokens").alias("s"))
    base = sums.select("c", "k", F.coalesce(F.sum("s").over(
        Window.partitionBy("c").orderBy("k").rowsBetween(*before)), F.lit(0)).alias("base"))
    heads = rows.groupBy(F.col("conv_id").alias("hc")).agg(
        F.min(F.struct("turn", "role", "text")).alias("head"), F.sum("tokens").alias("total"))
    placed = (rows.withColumn("within", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
              .join(base, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("chunk") == F.col("k")))
              .withColumn("before", F.col("base") + F.col("within"))
              .withColumn("span", F.floor(F.col("before") / span_budget))
              .select("conv_id", "role", "text", "tokens", "before", "span"))

    own = Window.partitionBy("conv_id", "span")
    placed = (placed.withColumn("first", F.min("before").over(own))
              .withColumn("end", F.max(F.col("before") + F.col("tokens")).over(own))
              .join(heads, F.col("conv_id").eqNullSafe(F.col("hc"))))
    system = (F.col("head.role") == "system")
    starts = (F.col("before") == F.col("first"))

    def entry(span: Column, pos: Column, role: Column, text: Column, repeated: bool) -> Column:
        return F.struct(span.alias("span"), pos.alias("pos"), role.alias("role"), text.alias("text"),
                        F.lit(repeated).alias("repeated"))

    target = entry(F.col("span"), F.col("before"), F.col("role"), F.col("text"), False)
    history = F.when((F.col("end") - F.col("before") <= history_budget) & (F.col("end") < F.col("total"))
                     & ~(system & (F.col("before") == 0)),
                     entry(F.floor(F.col("end") / span_budget), F.col("before"), F.col("role"), F.col("text"), True))
    again = F.when(starts & system & (F.col("before") > 0),
                   entry(F.col("span"), F.lit(-1).cast("bigint"), F.col("head.role"), F.col("head.text"), True))
    entries = (placed.select("conv_id", F.explode(F.filter(F.array(target, history, again), lambda e: e.isNotNull()))
                             .alias("e")).select("conv_id", "e.*"))

    lead = F.concat(F.lit("<|"), F.replace(escape(F.col("role")), F.lit("|"), F.lit("~2")), F.lit("|>\n"))
    body = escape(F.col("text"))
    entries = entries.withColumns({"lead": lead, "body": body})
    entries = entries.withColumn("shown", F.concat("lead", "body", F.lit("<|end|>\n")))
    offset = F.coalesce(F.sum(F.length("shown")).over(
        Window.partitionBy("conv_id", "span").orderBy("pos").rowsBetween(*before)), F.lit(0))
    entries = entries.withColumn("at", (offset + F.length("lead")).cast("int"))
    loss = F.when(~F.col("repeated") & (F.col("role") == "assistant") & (F.length("body") > 0),
                  F.struct(F.col("at").alias("start"), (F.col("at") + F.length("body")).alias("end")))
    gathered = (entries.select("conv_id", "span", "pos", "shown", "repeated", loss.alias("loss"),
                               turn_tokens(F.col("text")).alias("tokens"))
                .groupBy("conv_id", "span")
                .agg(F.array_sort(F.collect_list(F.struct("pos", "shown"))).alias("parts"),
                     F.array_sort(F.collect_list("loss")).alias("loss"),
                     F.count(F.lit(1)).alias("n_turns"),
                     F.sum(F.col("repeated").cast("int")).alias("n_repeated"), F.sum("tokens").alias("n_tokens")))
    return gathered.select("conv_id", "span", F.concat_ws("", F.transform("parts", lambda p: p["shown"])).alias("formatted"),
                           "loss", "n_turns", "n_repeated", "n_tokens")


def read_back(windows: DataFrame) -> DataFrame:
    """(conv_id, span, turns, loss_text, formatted): the turns that a window
    does not repeat as (role, text), and its unescaped loss text, parsed from
    the formatted string alone."""
    parts = F.split(F.col("formatted"), r"<\|end\|>\n", -1)
    fresh = F.slice(parts, F.col("n_repeated").cast("int") + 1,
                    F.size(parts) - F.lit(1) - F.col("n_repeated").cast("int"))

    def turn(p: Column) -> Column:
        cut = F.position(F.lit("|>\n"), p)
        role = unescape(F.replace(F.substr(p, F.lit(3), cut - 3), F.lit("~2"), F.lit("|")))
        return F.struct(role.alias("role"), unescape(F.substr(p, cut + 3)).alias("text"))

    loss = F.transform("loss", lambda s: unescape(F.substr(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])))
    return windows.select("conv_id", "span", F.transform(fresh, turn).alias("turns"),
                          F.concat_ws("", loss).alias("loss_text"), "formatted")


def conversation_digests(windows: DataFrame) -> DataFrame:
    """Per conversation what its windows say (the digest of a conversation
    needs its text as one value, so this report gathers a conversation)."""
    text = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    per_window = read_back(windows).select(
        "conv_id", "span", F.size("turns").alias("n"), text.alias("said"), "loss_text",
        F.length("formatted").alias("chars"))
    whole = per_window.groupBy("conv_id").agg(
        F.sum("n").cast("bigint").alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("span", "said", "loss_text"))).alias("w"),
        F.sum("chars").cast("bigint").alias("formatted_chars"))
    loss = F.concat_ws("", F.transform("w", lambda x: x["loss_text"]))
    return whole.select(
        "conv_id", "n_turns", F.sha2(F.concat_ws("", F.transform("w", lambda x: x["said"])), 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")


CHAT_SQL = """
WITH t0 AS (
  SELECT conv_id, coalesce(turn, -4611686018427387904) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
t1 AS (SELECT *, (strlen(text) + 3) // 4 + 4 AS tokens,
         length('<||>
<|end|>
') + length(replace(replace(replace(role, '~', '~0'), '<|', '~1'), '|', '~2'))
           + length(replace(replace(text, '~', '~0'), '<|', '~1')) AS chars FROM t0),
t2 AS (SELECT *, coalesce(sum(tokens) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
         sum(tokens) OVER (PARTITION BY conv_id) AS total, first_value(role) OVER o AS head, first_value(chars) OVER o AS head_chars
       FROM t1 WINDOW o AS (PARTITION BY conv_id ORDER BY turn, role, text)),
t3 AS (SELECT *, before // 512 AS span FROM t2),
t4 AS (SELECT *, max(before + tokens) OVER p AS e, min(before) OVER p AS f FROM t3 WINDOW p AS (PARTITION BY conv_id, span))
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY before)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY before) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (sum(chars) + coalesce(sum(chars) FILTER (e - before <= 256 AND e < total AND NOT (head = 'system' AND before = 0)), 0)
    + coalesce(sum(head_chars) FILTER (before = f AND before > 0 AND head = 'system'), 0))::BIGINT AS formatted_chars
FROM t4 GROUP BY conv_id
"""
