"""Best-fit packing of tokenised documents (operator 11).

Documents become token ids (the tokenizer's, without special tokens, and one
end id each), are cut only where they exceed a sequence's capacity, and are
dealt into as few sequences of that capacity as best fit finds.

Method: large-item matching.  Pieces longer than a third of the capacity go at
most twice into a sequence: the longest is matched with the longest that still
fits, which needs the fewest sequences for them.  The smaller pieces then go,
longest first, each into the smallest remaining gap that takes it; a new
sequence is opened only where none does.

Only lengths decide, and there are at most ``capacity`` different ones, so the
whole packing is planned from the counts per length: equal sequences are one
entry with a multiplicity.  A step of the plan uses up a length or splits a
group of equal sequences, and a group's gap at least halves each time it is filled,
so the plan has O(capacity * log(capacity)) entries whatever the number of
documents (``plan_packing`` states and checks the bound); it is all that is
sent to the tasks.  Pieces of a length are numbered in parallel (salted by the
count of their length, so a length that holds a third of all rows is spread),
and each looks its number up in the plan.

Tokenising happens once, where the texts are read: texts are not shuffled.  A
slice of whole documents is cut at spaces and line feeds, where this
tokenizer's words end anyway, equal words are found by comparing them as one
or two uint64 (longer ones as bytes), and only words that the worker has not seen
are encoded; ids are then gathered in numpy.  A tokenizer without that property
(``split_safe``) is given whole texts.

Edge cases: null text counts as empty and is one piece with the end id alone;
a text of exactly the capacity minus one fills a sequence; repeated rows and null ids
are packed like any other row; ties of equal length are taken by id; an empty
table gives an empty result; extra columns are ignored by ``token_pieces`` and
kept by ``place_pieces``.
"""

from __future__ import annotations

import bisect
import math
import os
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm import kernels as K
from tidewatch.llm.store import Scratch
from tidewatch.llm.token_counts import split_safe

CAPACITY = 4096
END_ID = 1
SLICE = 8 << 20          # bytes of text encoded together
WORD_CACHE = 500_000     # words in a generation that a worker remembers (some 100 MB)
GROUP_ROWS = 2_000       # pieces of one length that are numbered in one group

_ENCODERS: dict = {}     # one per worker process and tokenizer
_BREAKS = np.zeros(256, dtype=bool)
_BREAKS[[0x20, 0x0A]] = True
_LETTER = np.array([c < 128 and chr(c).isalpha() for c in range(256)])
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], dtype=np.uint8)
_STOP = np.zeros(256, dtype=bool)
_STOP[list(b".,")] = True
_ODD = np.array([c >= 128 or c == ord("<") for c in range(256)])


# --- documents to pieces of token ids -------------------------------------------

class Encoder:
    """Token ids of whole documents, as the tokenizer library gives them.

    A worker keeps the ids of the words it has seen in two generations of
    ``cache`` words: when the new one is full the old one is forgotten, and a word
    found in the old one moves to the new one.
    """

    def __init__(self, path: str, cache: int = WORD_CACHE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.cache, self.known, self.old = cache, {}, {}
        self.by_word = split_safe(path)
        if path.endswith(".json"):
            from tokenizers import Tokenizer
            self._tok = Tokenizer.from_file(path)
            self._tok.no_truncation()
            self._tok.no_padding()
            self._ids = lambda texts: [e.ids for e in self._tok.encode_batch(texts, add_special_tokens=False)]
        else:
            import sentencepiece
            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            self._ids = lambda texts: sp.encode(texts, num_threads=1)

    def encode(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents ``raw[off[i]:off[i + 1]]``, ids per document)."""
        if not self.by_word:
            rows = [np.array(ids, dtype="<u4") for ids in
                    self._ids([raw[a:b].tobytes().decode() for a, b in zip(off[:-1].tolist(), off[1:].tolist())])]
            return np.concatenate([np.zeros(0, dtype="<u4"), *rows]), np.array([len(r) for r in rows], dtype=np.int64)
        buf, starts, ends, places = cut_words(raw, off)
        if not len(starts):
            return np.zeros(0, dtype="<u4"), np.zeros(len(off) - 1, dtype=np.int64)
        codes, words = distinct_words(buf, starts, ends - starts)
        rows = self._lookup(words)
        counts = np.fromiter(map(len, rows), np.int64, len(rows)) // 4
        table, first = np.frombuffer(b"".join(rows), dtype="<u4"), np.cumsum(counts) - counts
        n = counts[codes]
        before = np.concatenate([[0], np.cumsum(n)])
        ids = table[np.arange(before[-1]) + np.repeat(first[codes] - before[:-1], n)]
        return ids, np.diff(before[places])

    def _lookup(self, words: list[bytes]) -> list[bytes]:
        known, old, rows, fresh = self.known, self.old, list(map(self.known.get, words)), []
        for i, row in enumerate(rows):
            if row is None:
                row = old.get(words[i])
                if row is None:
                    fresh.append(i)
                else:
                    rows[i] = known[words[i]] = row
        for i in range(0, len(fresh), 20_000):
            part = fresh[i:i + 20_000]
            for k, row in zip(part, self._encode_words([words[k] for k in part])):
                rows[k] = known[words[k]] = row
        if len(known) > self.cache:
            self.known, self.old = {}, known
        return rows

    def _encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, encoded as one text with a space between them; the
        tokens' places in that text say whose they are."""
        texts = [w.decode() for w in words]
        found = self._tok.encode(" ".join(texts), add_special_tokens=False)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        starts = np.concatenate([[0], np.cumsum(lengths + 1)])
        ids = np.array(found.ids, dtype="<u4")
        # a token never crosses a space, and one that stands for no character (none here) would stay in order
        at = np.fromiter((o[0] for o in found.offsets), np.int64, len(ids))
        cuts = (np.searchsorted(at, starts) * 4).tolist()
        data = ids.tobytes()
        return [data[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def cut_words(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, first word of each document and the end) of the words
    of documents ``raw[off[i]:off[i + 1]]``, with 16 bytes behind the last.

    ASCII words are lower-cased, as the tokenizer does, and a stop behind a letter
    at a word's end is a word of its own, as it is a token of its own; words with
    ``<``, where a special string may begin, stay as they are.
    """
    size = int(off[-1] - off[0])
    buf = np.zeros(2 * size + 16, dtype=np.uint8)   # lower-cased bytes, then the bytes as they are
    buf[size:2 * size] = raw[off[0]:off[-1]]
    own = buf[size:2 * size]
    buf[:size] = _LOWER[own]
    starts, ends = K.word_bounds(own, off - off[0], _BREAKS)
    if not len(starts):
        return buf, starts, ends, np.zeros(len(off), dtype=np.int64)
    odd = np.zeros(size + 1, dtype=np.int32)
    np.cumsum(_ODD[own], out=odd[1:])
    plain = odd[starts] == odd[ends]
    stop = plain & (ends - starts > 1) & _STOP[own[ends - 1]] & _LETTER[own[np.maximum(ends - 2, 0)]]
    at = np.flatnonzero(stop)
    points = ends[at] - 1
    ends[at] = points
    starts, ends, plain = np.insert(starts, at + 1, points), np.insert(ends, at + 1, points + 1), np.insert(plain, at + 1, True)
    places = np.searchsorted(starts, off - off[0])
    shift = np.where(plain, 0, size)
    return buf, starts + shift, ends + shift, places


def distinct_words(buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """(number of each word's text, the texts).  ``buf`` has 16 bytes behind the last word."""
    codes = np.empty(len(starts), dtype=np.int64)
    data = buf.tobytes()
    short = lengths <= 16
    s, n = starts[short], lengths[short]
    a, b = K.pack(buf, s, n, 0), K.pack(buf, s, n, 8)
    own, found = pd.factorize(K.mix(a ^ K.mix(b + n.astype(np.uint64))))
    first = np.empty(len(found), dtype=np.int64)
    first[own[::-1]] = np.arange(len(own))[::-1]
    at = first[own]
    if not ((a == a[at]) & (b == b[at]) & (n == n[at])).all():   # two words with one hash
        _, first, own = np.unique(np.stack([a, b, n.astype(np.uint64)]), axis=1, return_index=True, return_inverse=True)
    codes[short] = own
    s, n = s[first], n[first]
    words = [data[i:j] for i, j in zip(s.tolist(), (s + n).tolist())]
    if not short.all():
        s, n = starts[~short], lengths[~short]
        own, found = pd.factorize(np.array([data[i:j] for i, j in zip(s.tolist(), (s + n).tolist())], dtype=object))
        codes[~short] = own + len(words)
        words += found.tolist()
    return codes, words


def cut_pieces(counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, number, length) of the pieces of documents of ``counts`` tokens."""
    pieces = -(-counts // capacity)
    doc = np.repeat(np.arange(len(counts)), pieces)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    return doc, number, np.minimum(capacity, counts[doc] - number * capacity)


def _pieces(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _ENCODERS:
            _ENCODERS[path] = Encoder(path)
        for batch in batches:
            raw, off = K.text_buffers(batch.column(2))
            for i, j in K.slices(off, SLICE):
                ids, counts = _ENCODERS[path].encode(raw, off[i:j + 1])
                ended = np.full(len(ids) + j - i, end_id, dtype="<u4")
                ended[np.arange(len(ids)) + np.repeat(np.arange(j - i), counts)] = ids
                doc, number, length = cut_pieces(counts + 1, capacity)
                edges = np.zeros(len(doc) + 1, dtype=np.int64)
                np.cumsum(length * 4, out=edges[1:])
                cells = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(doc), [None, pa.py_buffer(edges), pa.py_buffer(ended)])
                at = pa.array(doc + i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(number, pa.int32()),
                     pa.array(number * capacity), pa.array(length), cells.cast(pa.binary())],
                    ["row", "doc_id", "piece", "start", "length", "ids"])
    return run


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, piece, start, length, ids): every document's ids, cut where they exceed
    ``capacity``; ``ids`` holds little-endian unsigned 32-bit numbers, ``row`` tells
    rows of equal ids apart."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_pieces(tokenizer_path, capacity, end_id),
                           f"row bigint, doc_id {kind}, piece int, start bigint, length bigint, ids binary")


# --- the plan ---------------------------------------------------------------------

def plan_packing(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Entries (length, from, to, per sequence, first sequence, offset): the pieces
    of that length numbered ``from <= r < to`` go ``per sequence`` each into the sequences from
    ``first sequence`` on, starting at ``offset``."""
    left = [0] * (capacity + 1)
    for length, n in counts.items():
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens does not fit")
        left[length] = n
    total = list(left)
    entries: list[tuple] = []
    gaps: dict[int, list] = defaultdict(list)   # gap -> groups (first sequence, sequences)
    opened = 0

    def put(length: int, sequences: int, each: int, first: int, offset: int) -> None:
        start = total[length] - left[length]
        left[length] -= sequences * each
        entries.append((length, start, start + sequences * each, each, first, offset))

    def leave(gap: int, first: int, sequences: int) -> None:
        if gap and sequences:
            if not gaps[gap]:
                bisect.insort(open_gaps, gap)
            gaps[gap].append((first, sequences))

    open_gaps: list[int] = []
    least = capacity // 3 + 1
    # the longest length at or below each that still has pieces
    below = list(range(capacity + 1))

    def longest(length: int) -> int:
        at = length
        while at >= least and not left[at]:
            at = below[at] if below[at] != at else at - 1
        while length > at:
            below[length], length = at, below[length] if below[length] != length else length - 1
        return at if at >= least else 0

    for x in range(capacity, least - 1, -1):
        while left[x]:
            y = longest(min(x, capacity - x)) if capacity - x >= least else 0
            if y == x and left[x] == 1:
                y = longest(x - 1)
            if not y:
                n = left[x]
                put(x, n, 1, opened, 0)
            elif y == x:
                n = left[x] // 2
                put(x, n, 2, opened, 0)
            else:
                n = min(left[x], left[y])
                put(x, n, 1, opened, 0)
                put(y, n, 1, opened, x)
            leave(capacity - x - y, opened, n)
            opened += n

    for x in range(least - 1, 0, -1):
        while left[x]:
            at = bisect.bisect_left(open_gaps, x)
            if at < len(open_gaps):
                gap = open_gaps[at]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del open_gaps[at]
            else:   # as many new sequences as the rest needs
                gap, first, n = capacity, opened, -(-left[x] // (capacity // x))
                opened += n
            each = gap // x
            full = min(n, left[x] // each)
            if full:
                put(x, full, each, first, capacity - gap)
                leave(gap - each * x, first, full)
            else:
                rest = left[x]
                put(x, 1, rest, first, capacity - gap)
                leave(gap - rest * x, first, 1)
                full = 1
            leave(gap, first + full, n - full)
    bound = 8 * (capacity + 1) * max(1, capacity.bit_length())
    if len(entries) > bound:
        raise RuntimeError(f"{len(entries)} entries for a capacity of {capacity}")
    return np.array(sorted(entries), dtype=np.int64).reshape(-1, 6)


_RANK_BITS = 40


def _assign(plan: np.ndarray):
    keys = (plan[:, 0] << _RANK_BITS) + plan[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            length, rank = (batch.column(names.index(c)).to_numpy() for c in ("length", "_rank"))
            own = plan[np.searchsorted(keys, (length << _RANK_BITS) + rank, side="right") - 1]
            turn = rank - own[:, 1]
            columns = [c for c, name in zip(batch.columns, names) if name != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(own[:, 4] + turn // own[:, 3]), pa.array(own[:, 5] + turn % own[:, 3] * length)],
                [*(n for n in names if n != "_rank"), "sequence_id", "offset"])
    return run


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (row, doc_id, piece, length and any other columns) with their
    ``sequence_id`` and ``offset``; the offsets of a sequence are gapless from 0."""
    spark = pieces.sparkSession
    scratch = Scratch(spark, "packing")
    pieces = scratch.keep(pieces, "pieces")
    # at most one row per length
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = plan_packing(counts, capacity)
    if not counts:
        return pieces.select("*", F.lit(0).cast("bigint").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    salts = spark.createDataFrame([(length, math.ceil(n / GROUP_ROWS)) for length, n in counts.items()], "length bigint, _salts int")
    salted = (pieces.join(F.broadcast(salts), "length")
              .withColumn("_salt", F.pmod(F.xxhash64("row", "piece"), F.col("_salts")).cast("int")).drop("_salts"))
    groups = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "row")
    ranked = (salted.withColumn("_own", F.row_number().over(own)).join(groups, ["length", "_salt"])
              .select(*pieces.columns, (F.col("_before") + F.col("_own") - 1).cast("bigint").alias("_rank")))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.mapInArrow(_assign(plan), f"{schema}, sequence_id bigint, offset bigint")


def packed_sequences(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, **columns) -> DataFrame:
    """(sequence_id, n_tokens, ids, documents): the sequences themselves.  ``ids`` are
    the concatenated token ids, ``documents`` says which piece of which document
    stands where.  A sequence has at most ``capacity`` pieces."""
    placed = place_pieces(token_pieces(docs, tokenizer_path, capacity, end_id, **columns), capacity)
    cell = F.struct("offset", "length", "doc_id", "piece", "start", "ids")
    return (placed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.sort_array(F.collect_list(cell)).alias("_cells"))
            .select("sequence_id", "n_tokens",
                    F.aggregate("_cells", F.lit(b""), lambda acc, c: F.concat(acc, c["ids"])).alias("ids"),
                    F.transform("_cells", lambda c: F.struct(*[c[k].alias(k) for k in ("offset", "length", "doc_id", "piece", "start")]))
                    .alias("documents")))
