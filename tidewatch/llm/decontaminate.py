"""Benchmark decontamination (operator 1).

Method: rare n-gram seeds join training passages to test items, then
Smith-Waterman alignment scores paraphrased or edited copies.

1. *Words* are runs of letters and digits (any non-ASCII byte counts as a
   letter) of the lower-cased text, so punctuation and case do not matter.
2. *Seeds* are the items' runs of ``GRAM`` words whose chance frequency (the
   product of their words' shares of the corpus) is at most ``RARE``; the
   shares are counted over all documents.  Judging rarity by the words and not
   by the run's own count keeps the seeds of a passage that leaked into a
   third of all documents.  An item without rare runs keeps its rarest ones.
3. *Passages.*  Every position of every document is looked up among the
   seeds; hits of one item on nearby diagonals make a passage of a bit more
   than the item's length, which is joined to its item.
4. *Alignment.*  Smith-Waterman over words (match 2, mismatch -1, gap -1); the
   best local score over the item's perfect score is the similarity, and pairs
   from ``MIN_SCORE`` on are contaminated.  Items of more than ``PIECE`` words
   are aligned in pieces of that size, whose best scores add up, so the cost
   of a long item grows with its length and not with its square.

Items reach the tasks in blocks of at most ``BLOCK_WORDS`` words, so what is
broadcast is bounded whatever the size of the benchmark; each block is one
scan of the documents.  Documents are never shuffled.

Edge cases: null or empty texts and items without words match nothing; an item
shorter than a seed is one seed; equal items each get their pairs; repeated
documents give one pair per doc_id; rows with a null doc_id or item_id take no
part; empty tables, empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import kernels as K
from tidewatch.llm.store import Scratch

GRAM = 3
RARE = 1e-7           # chance frequency of a seed per corpus position
RAREST = 5            # seeds of an item that has no rare ones
MIN_SCORE = 0.4
BLOCK_WORDS = 1_000_000
PIECE = 256
MATCH, MISMATCH, GAP = 2, -1, -1

_BITS = 22


def item_words(texts: list[str | None]) -> list[np.ndarray]:
    raw, off = K.text_buffers(pa.array([t or "" for t in texts], pa.string()))
    out: list[np.ndarray] = []
    for i, j in K.slices(off):
        words, first = K.words_of(raw, off, i, j, breaks=K.PUNCTUATION)
        out += [words[a:b] for a, b in zip(first[:-1], first[1:])]
    return out


def word_shares(docs: DataFrame, vocabulary: np.ndarray) -> dict[int, float]:
    """Share of each word of ``vocabulary`` (sorted hashes) among all words of
    the documents; at most one number per word reaches the driver."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        counts, total = np.zeros(len(vocab), dtype=np.int64), 0
        for batch in batches:
            raw, off = K.text_buffers(batch.column(0))
            for i, j in K.slices(off):
                words, _ = K.words_of(raw, off, i, j, breaks=K.PUNCTUATION)
                at = np.minimum(np.searchsorted(vocab, words), len(vocab) - 1)
                counts += np.bincount(at[vocab[at] == words], minlength=len(vocab))
                total += len(words)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(seen, -1)), pa.array(np.append(counts[seen], total))], ["w", "n"])

    rows = docs.select("text").mapInArrow(count, "w bigint, n bigint").groupBy("w").agg(F.sum("n").alias("n")).toPandas()
    sums = dict(zip(rows["w"].tolist(), rows["n"].tolist()))
    total = max(sums.pop(-1, 0), 1)
    return {int(vocabulary[w]): n / total for w, n in sums.items()}


def pieces(words: np.ndarray) -> list[np.ndarray]:
    return [words[a:a + PIECE] for a in range(0, len(words), PIECE)]


class Seeds:
    """Seed lookup of a block of item pieces; picklable."""

    def __init__(self, ids: list[tuple[int, int]], words: list[np.ndarray], shares: dict[int, float], gram: int = GRAM):
        self.sizes = {i: len(w) for i, w in zip(ids, words)}
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, list]] = {}
        found: dict[int, dict[int, list]] = defaultdict(lambda: defaultdict(list))
        for item, w in zip(ids, words):
            if not len(w):
                continue
            n = min(gram, len(w))
            share = np.array([shares.get(int(x), 0.0) for x in w])
            chance = np.prod([share[k:len(w) - n + 1 + k] for k in range(n)], axis=0)
            keep = np.flatnonzero(chance <= RARE)
            if not len(keep):
                keep = np.argsort(chance, kind="stable")[:RAREST]
            for p, h in zip(keep.tolist(), K.shingles_of(w, n)[keep].tolist()):
                found[n][h].append((item, p))
        for n, places in found.items():
            hashes = np.array(sorted(places), dtype=np.uint64)
            bits = np.zeros(1 << _BITS, dtype=bool)
            bits[(hashes >> np.uint64(64 - _BITS)).astype(np.int64)] = True
            self.by_length[n] = hashes, np.packbits(bits), [places[h] for h in hashes.tolist()]

    def prepared(self):
        return [(n, h, np.unpackbits(b).view(bool), p) for n, (h, b, p) in self.by_length.items()]


def passages(words: np.ndarray, hits: list[tuple], sizes: dict) -> list[tuple]:
    """(item, first word, last word + 1) from hits (item, position, position in item)."""
    out = []
    by_item: dict[tuple, list[int]] = defaultdict(list)
    for item, at, p in hits:
        by_item[item].append(at - p)
    for item, diagonals in by_item.items():
        size = sizes[item]
        pad = size // 4 + 4
        diagonals.sort()
        lo = hi = diagonals[0]
        for d in [*diagonals[1:], None]:
            if d is not None and d - lo <= size:
                hi = d
                continue
            out.append((item, max(0, lo - pad), min(len(words), hi + size + pad)))
            if d is not None:
                lo = hi = d
    return out


def _find(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = shared.value
        tables = seeds.prepared()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            raw, off = K.text_buffers(batch.column(1))
            doc, item, piece, start, body = [], [], [], [], []
            for i, j in K.slices(off):
                words, first = K.words_of(raw, off, i, j, breaks=K.PUNCTUATION)
                hits: dict[int, list] = defaultdict(list)
                for n, hashes, bits, places in tables:
                    runs = K.shingles_of(words, n)
                    maybe = np.flatnonzero(bits[(runs >> np.uint64(64 - _BITS)).astype(np.int64)])
                    k = np.minimum(np.searchsorted(hashes, runs[maybe]), len(hashes) - 1)
                    real = hashes[k] == runs[maybe]
                    at, k = maybe[real], k[real]
                    row = np.searchsorted(first, at, side="right") - 1
                    inside = at + n <= first[row + 1]
                    for r, a, s in zip(row[inside].tolist(), at[inside].tolist(), k[inside].tolist()):
                        hits[r] += [(it, a - int(first[r]), p) for it, p in places[s]]
                for r, found in hits.items():
                    own = words[first[r]:first[r + 1]]
                    for it, a, b in passages(own, found, seeds.sizes):
                        doc.append(ids[i + r])
                        item.append(it[0])
                        piece.append(it[1])
                        start.append(a)
                        body.append(own[a:b].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(item, pa.int64()), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(body, pa.list_(pa.int64()))],
                ["doc_id", "item_id", "piece", "start", "passage"])
    return run


def smith_waterman(items: list[np.ndarray], texts: list[np.ndarray]) -> list[tuple[int, int, int]]:
    """Best local alignment of each item with its text: (score, first text
    position, end text position).  All pairs advance together, a row per item
    word; the running maximum along a row settles the gaps in the text."""
    n, rows, cols = len(items), max(map(len, items)), max(map(len, texts))
    x = np.zeros((n, rows), dtype=np.int64)
    y = np.zeros((n, cols), dtype=np.int64)
    valid_x, valid_y = np.zeros((n, rows), dtype=bool), np.zeros((n, cols), dtype=bool)
    for k, (a, b) in enumerate(zip(items, texts)):
        x[k, :len(a)], y[k, :len(b)] = a, b
        valid_x[k, :len(a)], valid_y[k, :len(b)] = True, True
    slope = GAP * np.arange(cols + 1, dtype=np.int64)
    h = np.zeros((n, cols + 1), dtype=np.int64)
    # score and origin travel as one number: score * 2**20 + (2**20 - 1 - first position)
    base = 1 << 20
    origin = base - 1 - np.arange(cols + 1, dtype=np.int64)
    h += origin
    best, end = np.full(n, 0, dtype=np.int64), np.zeros(n, dtype=np.int64)
    for i in range(rows):
        same = (y == x[:, i:i + 1]) & valid_y & valid_x[:, i:i + 1]
        step = np.where(same, MATCH, MISMATCH) * base
        new = np.empty_like(h)
        new[:, 0] = origin[0]
        new[:, 1:] = np.maximum(h[:, :-1] + step, h[:, 1:] + GAP * base)
        new[:, 1:] = np.maximum(new[:, 1:], origin[1:])
        # best of the cells to the left, each gap position costing GAP
        new = np.maximum.accumulate(new - slope * base, axis=1) + slope * base
        new = np.maximum(new, origin)
        h = np.where(valid_x[:, i:i + 1], new, h)
        masked = np.where(valid_y, h[:, 1:], -1)
        top = masked.argmax(axis=1)
        value = masked[np.arange(n), top]
        better = valid_x[:, i] & (value // base > best // base)
        best, end = np.where(better, value, best), np.where(better, top + 1, end)
    return [(int(b // base), int(base - 1 - b % base) if b // base else 0, int(e)) for b, e in zip(best, end)]


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            items, texts = ([np.array(v, dtype=np.int64) for v in part.column(c).to_pylist()] for c in (5, 6))
            found = smith_waterman(items, texts)
            start = part.column(3).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:3], part.column(4), pa.array([f[0] for f in found], pa.int64()),
                 pa.array([s + f[1] for s, f in zip(start, found)], pa.int64()),
                 pa.array([s + f[2] for s, f in zip(start, found)], pa.int64())],
                ["doc_id", "item_id", "piece", "size", "points", "first_word", "end_word"])


def contaminated(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE, gram: int = GRAM,
                 block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, score, first_word, end_word): each document with each
    test item of which it holds a copy, with its best alignment."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontaminate")
    texts = docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.lower(F.col("text").cast("string")).alias("text"))
    items = (benchmark.where("item_id IS NOT NULL AND text IS NOT NULL")
             .select(F.col("item_id").cast("bigint").alias("item_id"), F.lower(F.col("text").cast("string")).alias("text"))
             .dropDuplicates(["item_id"]))
    # blocks of items by their running size; an item is never cut
    size = F.length("text") / 2 + 1
    parts = int(items.agg(F.ceil(F.sum(size) / block_words).alias("b")).first()["b"] or 0)
    items = scratch.keep(items.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(max(parts, 1)))), "items")
    found = None
    for block in range(parts):
        rows = items.where(F.col("block") == block).select("item_id", "text").collect()   # bounded by block_words
        cut = [((r["item_id"], k), w) for r, words in zip(rows, item_words([r["text"] for r in rows]))
               for k, w in enumerate(pieces(words))]
        if not cut:
            continue
        vocabulary = np.unique(np.concatenate([w for _, w in cut]))
        seeds = Seeds([i for i, _ in cut], [w for _, w in cut], word_shares(texts, vocabulary), gram)
        hits = scratch.keep(texts.mapInArrow(
            _find(spark.sparkContext.broadcast(seeds)),
            "doc_id bigint, item_id bigint, piece int, start bigint, passage array<bigint>"), f"passages{block}")
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return spark.createDataFrame([], "doc_id bigint, item_id bigint, score double, first_word bigint, end_word bigint")

    def cut_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, k, len(words), w.view(np.int64))
                    for i, words in zip(batch.column(0).to_pylist(), item_words(batch.column(1).to_pylist()))
                    for k, w in enumerate(pieces(words))]
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in enumerate(kinds)],
                                             ["item_id", "piece", "size", "item"])

    tokens = items.select("item_id", "text").mapInArrow(cut_items, "item_id bigint, piece int, size bigint, item array<bigint>")
    points = (found.join(tokens, ["item_id", "piece"])
              .select("doc_id", "item_id", "piece", "start", "size", "item", "passage")
              .mapInArrow(_align, "doc_id bigint, item_id bigint, piece int, size bigint, points bigint, "
                                  "first_word bigint, end_word bigint"))
    best = (points.groupBy("doc_id", "item_id", "piece", "size")
            .agg(F.max(F.struct("points", (-F.col("first_word")).alias("back"), "end_word")).alias("b")))
    return (best.groupBy("doc_id", "item_id")
            .agg((F.sum("b.points") / (F.first("size") * MATCH)).alias("score"),
                 (-F.max("b.back")).alias("first_word"), F.max("b.end_word").alias("end_word"))
            .where(F.col("score") >= min_score))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The documents without a copy of any test item; null doc_ids are kept."""
    bad = contaminated(docs, benchmark, min_score).select("doc_id").distinct()
    return docs.join(bad, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
