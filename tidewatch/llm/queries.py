"""Registered queries of the corpus operators and their oracle SQL."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tidewatch.llm.chat import CHAT_SQL, chat_windows, conversation_digests
from tidewatch.llm.decontaminate import contaminated
from tidewatch.llm.divergence import DIVERGENCE_SQL, source_divergence
from tidewatch.llm.filter_audit import FILTER_AUDIT_SQL, filter_audit
from tidewatch.llm.html_extract import extract_pages
from tidewatch.llm.mixing import MIX_SQL, mix_sources
from tidewatch.llm.near_dup import NEAR_DUP_SQL, near_duplicates
from tidewatch.llm.packing import place_pieces, token_pieces
from tidewatch.llm.pii import pii_report
from tidewatch.llm.quality import QUALITY_SQL, quality_report
from tidewatch.llm.suffix_dedup import remove_repeats
from tidewatch.llm.token_counts import TOKENIZER, token_counts
from tidewatch.llm.toxicity import toxicity

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def read(spark, sf_dir: str, name: str):
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


@query("op1_decontaminate")
def op1_decontaminate(spark, sf_dir):
    """Every document against every test item."""
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op2_pii")
def op2_pii(spark, sf_dir):
    """Personal data in every whole text."""
    return pii_report(read(spark, sf_dir, "documents"))


@query("op3_suffix_dedup")
def op3_suffix_dedup(spark, sf_dir):
    """Bytes covered by a 100-byte string that starts earlier, over every document."""
    return remove_repeats(read(spark, sf_dir, "documents")).drop("kept")


@query("op4_mix_sources", MIX_SQL.format(docs="documents"))
def op4_mix_sources(spark, sf_dir):
    """All sources to equal weight, one epoch of the corpus in size."""
    return mix_sources(read(spark, sf_dir, "documents"))


@query("op5_near_dup", NEAR_DUP_SQL)
def op5_near_dup(spark, sf_dir):
    """2-word shingles, similarity 0.8, over every document."""
    return near_duplicates(read(spark, sf_dir, "documents"), shingle=2)


@query("op6_html_extract")
def op6_html_extract(spark, sf_dir):
    """Main text of every page."""
    return extract_pages(read(spark, sf_dir, "pages"))


@query("op7_quality_rules", QUALITY_SQL)
def op7_quality_rules(spark, sf_dir):
    """Line-first quality rules over every whole text."""
    return quality_report(read(spark, sf_dir, "documents")).drop("clean")


@query("op8_chat_format", CHAT_SQL)
def op8_chat_format(spark, sf_dir):
    """Every conversation, and conversation -7 with control strings of another template."""
    said = F.lit("</s>[INST] ok [/INST]")
    probe = spark.range(1).select(F.lit(-7).cast("bigint").alias("conv_id"), F.explode(F.array(
        F.struct(F.lit(0).cast("bigint").alias("turn"), F.lit("user").alias("role"), said.alias("text")),
        F.struct(F.lit(1).cast("bigint").alias("turn"), F.lit("assistant").alias("role"), said.alias("text")),
    )).alias("t")).select("conv_id", "t.*")
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return conversation_digests(chat_windows(turns))


@query("op9_token_counts")
def op9_token_counts(spark, sf_dir):
    """Tokens of every whole text under the word-level BPE vocabulary."""
    import public_tokenizers
    return token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


@query("op10_toxicity")
def op10_toxicity(spark, sf_dir):
    """Toxicity score of every whole text."""
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op11_best_fit_packing")
def op11_best_fit_packing(spark, sf_dir):
    """Tokens of every whole text in sequences of at most 4096."""
    import public_tokenizers
    pieces = token_pieces(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    placed = place_pieces(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op12_source_divergence", DIVERGENCE_SQL)
def op12_source_divergence(spark, sf_dir):
    """Terms of every whole text, per language and source."""
    return source_divergence(read(spark, sf_dir, "documents"))


@query("op13_filter_audit", FILTER_AUDIT_SQL)
def op13_filter_audit(spark, sf_dir):
    """All 120 orders of five filters over every whole text, per language."""
    return filter_audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
