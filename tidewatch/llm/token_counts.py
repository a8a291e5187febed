"""Token counts through a digest cache (operator 9).

Method: every text gets the digest of its normalised content, the digests are
joined to stored counts for the same tokenizer version (the digest of the
tokenizer file), only distinct misses are encoded, and their counts are
appended to the cache.

* Normalisation is Unicode NFC if the tokenizer itself applies it first (its
  file says so) and none otherwise, so equal digests mean equal counts.  A text with ``<`` (where a special string
  may begin, which the library looks for before it normalises) is digested as
  it is.
* Misses are distinct by digest before they are encoded: copies of a document
  (thousands of them in one group) cost one encoding.  One representative row
  (the smallest id) carries the text; the others only their digest.
* The cache is a Parquet table ``(tokenizer, digest, n_tokens)`` partitioned
  by tokenizer version, appended to once per run; a run that fails before the
  append changes nothing, and a duplicate entry (two runs at once) is harmless
  because lookups take one count per digest.
* A worker encodes batches with the tokenizer library.  Texts are cut at
  spaces and line feeds, where this tokenizer's words end anyway, and counts of
  pieces are kept in a bounded dictionary, so the library sees each distinct
  piece once per worker; ``split_safe`` is checked from the tokenizer file and
  any other tokenizer is given whole texts.

Edge cases: null text counts as empty (0 tokens); special strings inside a
text are handled as the library does by default; repeated rows and null ids
keep their rows; empty table, empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.store import Scratch, exists

LIMIT = 2048
TOKENIZER = "word_bpe_49k.json"
PIECE_CACHE = 1_000_000   # distinct pieces that a worker remembers (some 150 MB)

_COUNTERS: dict = {}      # one per worker process and tokenizer


# a full stop or comma between a letter and white space is a word of its own
_STOP = re.compile(r"(?<=[A-Za-z])([.,])(?=[ \n]|\Z)")


def split_pieces(text: str) -> list[str]:
    """Pieces whose counts add up to the text's, with fewer different ones:
    stops come off their words, ASCII text is lower-cased (as the tokenizer
    does; not where a special string may begin)."""
    if "<" not in text and text.isascii():
        text = text.lower()
    return _STOP.sub(r" \1", text).replace("\n", " ").split(" ")


def tokenizer_version(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()[:32]


def split_safe(path: str) -> bool:
    """True if a space or line feed always separates two words of the
    tokenizer, so that counts of pieces add up."""
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [spec.get("pre_tokenizer") or {}]
    first = steps[0]
    norm = spec.get("normalizer") or {}
    kinds = [n.get("type") for n in norm.get("normalizers", [norm]) if n]
    pattern = (first.get("pattern") or {}).get("Regex", " ")
    return (first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True
            and " " not in pattern and r"[^\s" in pattern and set(kinds) <= {"NFC", "Replace", "Lowercase"}
            and "Lowercase" in kinds and r"[\p{L}]+" in pattern
            and not any(t.get("lstrip") or t.get("rstrip") for t in spec.get("added_tokens", []))
            and not any(" " in t["content"] or "\n" in t["content"] for t in spec.get("added_tokens", [])))


def applies_nfc(path: str) -> bool:
    """True if the tokenizer's first normalisation step is NFC."""
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as f:
        norm = json.load(f).get("normalizer") or {}
    return (norm.get("normalizers") or [norm])[0].get("type") == "NFC"


class Counter:
    """Token counts of texts as the tokenizer library gives them."""

    def __init__(self, path: str):
        self.pieces: dict[str, int] | None = {} if split_safe(path) else None
        if path.endswith(".json"):
            from tokenizers import Tokenizer
            tok = Tokenizer.from_file(path)
            tok.no_truncation()
            tok.no_padding()
            self._encode = lambda texts: [len(e.ids) for e in tok.encode_batch(texts, add_special_tokens=False)]
        else:
            import sentencepiece
            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            self._encode = lambda texts: [len(ids) for ids in sp.encode(texts, num_threads=1)]

    def count(self, texts: list[str]) -> list[int]:
        if self.pieces is None:
            return self._encode(texts)
        out = []
        for text in texts:
            pieces = split_pieces(text)
            known = self.pieces
            fresh = [p for p in dict.fromkeys(pieces) if p not in known]
            if fresh:
                if len(known) + len(fresh) > PIECE_CACHE:
                    known.clear()
                    fresh = list(dict.fromkeys(pieces))
                known.update(zip(fresh, self._encode(fresh)))
            out.append(sum(map(known.__getitem__, pieces)))
        return out


def counter(path: str) -> Counter:
    if path not in _COUNTERS:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def content_digest(text: str | None, nfc: bool = True) -> bytes:
    text = text or ""
    if nfc and "<" not in text:
        text = unicodedata.normalize("NFC", text)
    return hashlib.blake2b(text.encode(), digest_size=16).digest()


def _digests(nfc: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = pa.array([content_digest(t, nfc) for t in batch.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, digests], ["doc_id", "text", "digest"])
    return run


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in batches:
            n = []
            for i in range(0, batch.num_rows, 64):
                n += count.count([t or "" for t in batch.column(1).slice(i, 64).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], ["digest", "n_tokens"])
    return run


def token_counts(docs: DataFrame, tokenizer_path: str, cache_path: str | None = None, limit: int = LIMIT,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs``.

    ``cache_path`` is a Parquet folder that all executors share; without one
    the run gets a cache of its own in the session's shared folder.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "tokens")
    cache_path = cache_path or scratch.path("cache")
    version = tokenizer_version(tokenizer_path)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    digested = rows.mapInArrow(_digests(applies_nfc(tokenizer_path)), f"doc_id {kind}, text string, digest binary")
    # distinct texts, combined before the shuffle
    distinct = digested.groupBy("digest").agg(F.first(F.coalesce("text", F.lit(""))).alias("text"))
    if exists(spark, cache_path):
        distinct = distinct.join(_stored(spark, cache_path, version), "digest", "left_anti")
    counts = distinct.mapInArrow(_encode(tokenizer_path), "digest binary, n_tokens bigint")
    # written aside first: an append that is retried must not leave half a run
    fresh = scratch.keep(counts, "fresh")
    fresh.withColumn("tokenizer", F.lit(version)).write.mode("append").partitionBy("tokenizer").parquet(cache_path)

    known = digested.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"), "digest")
    return (known.join(_stored(spark, cache_path, version), "digest", "left")
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))


def _stored(spark, cache_path: str, version: str) -> DataFrame:
    """(digest, n_tokens) of one tokenizer version, one row per digest."""
    return (spark.read.schema("digest binary, n_tokens bigint, tokenizer string").parquet(cache_path)
            .where(F.col("tokenizer") == version).groupBy("digest").agg(F.min("n_tokens").alias("n_tokens")))
