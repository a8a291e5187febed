"""Repeated byte strings by threshold-bounded interval expansion (operator 3).

Every byte covered by a ``LENGTH``-byte string that also starts earlier
(smaller doc_id, or same document and earlier start) is removed; strings are
judged on the input and never cross documents.

Method: a Burrows-Wheeler transform of candidate text, breadth-first backward
extension of its intervals, which sets common-prefix values in increasing
order and stops at ``LENGTH``: the positions still without a value are those
whose common prefix is at least that long.  One transform over the whole
corpus would need one task to see all text, so the text is first dealt out:

1. *Anchors.*  In each ``LENGTH``-byte string the ``GRAM``-byte gram with the
   least hash (leftmost on ties) is its anchor, a function of the string
   alone.  Consecutive strings with one anchor form a segment (at most
   ``2 * LENGTH - GRAM`` bytes).  Equal strings have equal anchors, so a
   string can only repeat inside the group of its anchor hash; anchors seen
   once are dropped after a count that is combined before the shuffle.
2. *Equal segments* (anchor hash and digest) are pre-aggregated to their first
   occurrence; every later occurrence is a repeat in its whole length.  That
   keeps a passage held by a third of all documents at one row per copy.
3. *Interval expansion.*  Anchor groups with several different segments go,
   as the bytes of one occurrence each, to tasks by anchor hash.  Each task
   builds the transform over groups of a few MB and expands intervals up to
   ``LENGTH``; in each class of equal strings all but the first occurrence are
   repeats.
4. *Hot anchors* with more than ``HOT`` different segments (a common line in
   endless contexts) are split into their single strings, whose digests are
   aggregated with map-side combine instead, so no task holds the group.

Removed runs are joined back to the text by doc_id.

Edge cases: null or empty text and texts shorter than ``LENGTH`` keep all
their bytes; rows with a null doc_id take no part and are kept whole; repeated
rows of a doc_id count as one document; empty table, empty result; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import kernels as K
from tidewatch.llm.store import Scratch

LENGTH = 100
GRAM = 32
HOT = 2000
TRANSFORM_BYTES = 1 << 20
_POS = np.uint64((1 << 24) - 1)


def _window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum over x[i : i + w] for each i with a whole window."""
    size = 1
    while size * 2 <= w:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = w - size
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest else x


def segments(buf: np.ndarray, off: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(document, start, size, anchor hash, digest) of the segments of each
    document in ``buf`` (documents are buf[off[d]:off[d + 1]])."""
    n = len(buf)
    none = np.zeros(0, dtype=np.int64)
    if n < length:
        return none, none, none, none, none
    total, inv = K.prefix_sums(buf)
    grams = K.mix((total[gram:] - total[:-gram]) * inv[:n - gram + 1])
    if n <= int(_POS):
        low = _window_min((grams & ~_POS) | np.arange(len(grams), dtype=np.uint64), length - gram + 1)
        anchor = (low & _POS).astype(np.int64)
    else:  # a longer single document: positions relative to windows of blocks
        step, w = int(_POS) - length, length - gram + 1
        anchor = np.concatenate([
            (_window_min((grams[a:a + step + w - 1] & ~_POS)
                         | np.arange(len(grams[a:a + step + w - 1]), dtype=np.uint64), w) & _POS).astype(np.int64) + a
            for a in range(0, len(grams) - w + 1, step)])
    sizes = np.diff(off)
    live = np.flatnonzero(sizes >= length)
    if not len(live):
        return none, none, none, none, none
    # starts that lie in one document with their whole string
    count = sizes[live] - length + 1
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    start = np.arange(int(count.sum())) + np.repeat(off[live] - first, count)
    doc = np.repeat(live, count)
    own = anchor[start]
    fresh = np.empty(len(start), dtype=bool)
    fresh[0] = True
    np.not_equal(own[1:], own[:-1], out=fresh[1:])
    fresh[first] = True
    a = np.flatnonzero(fresh)
    b = np.append(a[1:], len(start)) - 1
    s0, s1, where = start[a], start[b] + length, doc[a]
    digest = K.mix((total[s1] - total[s0]) * inv[s0] + (s1 - s0).astype(np.uint64))
    return where, s0 - off[where], s1 - s0, (grams[own[a]] >> np.uint64(16)).view(np.int64), digest.view(np.int64)


def _anchor_rows(length: int, gram: int, full: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            raw, off = K.text_buffers(batch.column(1))
            for i, j in K.slices(off):
                doc, s0, size, h, d = segments(raw[off[i]:off[j]], off[i:j + 1] - off[i], length, gram)
                if full:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h), pa.array(d), pa.array(ids[i + doc], pa.int64()),
                         pa.array(s0, pa.int32()), pa.array(size, pa.int16())], ["h", "d", "doc_id", "s0", "n"])
                else:
                    u, c = np.unique(h, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(c, pa.int64())], ["h", "c"])
    return run


def rotation_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of the circular ``text`` sorted by their first ``depth`` symbols or more."""
    n = len(text)
    key = np.zeros(n, dtype=np.uint64)
    for k in range(7):
        key = (key << np.uint64(9)) | np.roll(text, -k).astype(np.uint64)
    done = 7
    while True:
        order = np.argsort(key)
        ranked = key[order]
        step = np.empty(n, dtype=np.int64)
        step[0] = 0
        np.cumsum(ranked[1:] != ranked[:-1], out=step[1:])
        if done >= depth or step[-1] == n - 1:
            return order
        rank = np.empty(n, dtype=np.uint64)
        rank[order] = step
        # the ranks of the following stretches: two more if three fit 64 bits
        stretches = 3 if n < 1 << 21 else 2
        key = rank.copy()
        for k in range(1, stretches):
            key = key * np.uint64(n) + np.roll(rank, -done * k)
        done *= stretches


def long_prefix_classes(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Rotation order of ``text`` and the class of each entry: entries of one
    class agree in their first ``length`` symbols, and only those.

    Backward extension on the transform, breadth first: the intervals of all
    strings of one length are extended by every preceding symbol at once; a
    right end that has no value yet gets that length as its common prefix and
    its interval goes on to the next round.
    """
    n = len(text)
    order = rotation_order(text, length)
    bwt = text[order - 1]
    by_symbol = np.argsort(bwt, kind="stable")
    to = np.empty(n, dtype=np.int64)          # where the preceding symbol's rotation stands
    to[by_symbol] = np.arange(n)
    known = np.zeros(n + 1, dtype=bool)       # a common prefix below ``length`` starts a class
    known[0] = known[n] = True
    owner = np.full(n + 2, -1, dtype=np.int64)
    lo, hi = np.array([0]), np.array([n])
    stamp = 0
    for _ in range(length):
        if not len(lo):
            break
        size = hi - lo
        which = np.repeat(np.arange(len(lo)), size)
        at = np.arange(int(size.sum())) + np.repeat(lo - (np.cumsum(size) - size), size)
        place = to[at]
        mark = stamp + which * 512 + bwt[at]
        owner[place] = mark
        stamp += len(lo) * 512
        lo = np.sort(place[owner[place - 1] != mark])
        hi = np.sort(place[owner[place + 1] != mark]) + 1
        new = ~known[hi]
        known[hi[new]] = True
        lo, hi = lo[new], hi[new]
    return order, np.cumsum(known[:n])


def repeats(parts: list[bytes], docs: np.ndarray, starts: np.ndarray,
            length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(doc, start) of each string in the given segments that also starts
    earlier in one of them."""
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    text = np.zeros(int(sizes.sum()) + len(parts), dtype=np.uint16)   # 0 ends a segment
    begin = np.cumsum(sizes + 1) - (sizes + 1)
    solid = np.ones(len(text), dtype=bool)
    solid[begin + sizes] = False
    text[solid] = np.frombuffer(b"".join(parts), dtype=np.uint8).astype(np.uint16) + 1
    order, cls = long_prefix_classes(text, length)
    seg = np.repeat(np.arange(len(parts)), sizes + 1)
    inside = np.arange(len(text)) - begin[seg]
    whole = inside + length <= sizes[seg]
    keep = whole[order]
    pos, cls = order[keep], cls[keep]
    count = np.bincount(cls)
    several = count[cls] > 1
    pos, cls = pos[several], cls[several]
    doc, start = docs[seg[pos]], starts[seg[pos]] + inside[pos]
    by = np.lexsort((start, doc, cls))
    cls, doc, start = cls[by], doc[by], start[by]
    later = np.zeros(len(cls), dtype=bool)
    later[1:] = cls[1:] == cls[:-1]
    return doc[later], start[later]


def _runs(doc: np.ndarray, start: np.ndarray, length: int) -> pa.RecordBatch:
    """Merged byte ranges (doc_id, a, b) of strings given by their starts."""
    by = np.lexsort((start, doc))
    doc, start = doc[by], start[by]
    cut = np.ones(len(doc), dtype=bool)
    cut[1:] = (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + length)
    first = np.flatnonzero(cut)
    last = np.append(first[1:], len(doc)) - 1
    return pa.RecordBatch.from_arrays(
        [pa.array(doc[first], pa.int64()), pa.array(start[first], pa.int32()),
         pa.array(start[last] + length, pa.int32())], ["doc_id", "a", "b"])


def _may_repeat(parts: list[bytes], hashes: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Which segments can share a string with another one of their anchor: a
    string reaches half of its remaining bytes to the left or to the right of
    the anchor, so one of these two stretches has to come twice."""
    half = (length - gram + 1) // 2
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    begin = np.cumsum(sizes) - sizes
    buf = np.frombuffer(b"".join(parts), dtype=np.uint8)
    total, inv = K.prefix_sums(buf)
    grams = (K.mix((total[gram:] - total[:-gram]) * inv[:len(buf) - gram + 1]) >> np.uint64(16)).view(np.int64)
    owner = np.repeat(np.arange(len(parts)), sizes)[:len(grams)]
    at = np.flatnonzero(grams == hashes[owner])
    at = at[at + gram <= (begin + sizes)[owner[at]]]
    which, first = np.unique(owner[at], return_index=True)
    anchor = np.zeros(len(parts), dtype=np.int64)
    anchor[which] = at[first]
    out = np.zeros(len(parts), dtype=bool)
    for a, b in ((anchor - half, anchor + gram), (anchor, anchor + gram + half)):
        fits = np.flatnonzero((a >= begin) & (b <= begin + sizes))
        stretch = K.mix((total[b[fits]] - total[a[fits]]) * inv[a[fits]] + hashes[fits].view(np.uint64))
        _, kind, count = np.unique(stretch, return_inverse=True, return_counts=True)
        out[fits] |= count[kind] > 1
    return out


def _expand(length: int, gram: int):
    """Interval expansion over rows (h, doc_id, s0, bytes) sorted by h."""
    def solve(hashes, docs, starts, parts):
        able = _may_repeat(parts, np.array(hashes, dtype=np.int64), length, gram)
        if not able.any():
            return None
        doc, start = repeats([p for p, k in zip(parts, able) if k], np.array(docs, dtype=np.int64)[able],
                             np.array(starts, dtype=np.int64)[able], length)
        return _runs(doc, start, length) if len(doc) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, last = ([], [], [], []), 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != last and size >= TRANSFORM_BYTES:
                    if (out := solve(*rows)) is not None:
                        yield out
                    rows, size = ([], [], [], []), 0
                last = row[0]
                for column, value in zip(rows, row):
                    column.append(value)
                size += len(row[3])
        if rows[0] and (out := solve(*rows)) is not None:
            yield out
    return run


def _cut(hot: bool, length: int):
    """Bytes of the wanted segments of each document: whole segments, or for
    hot anchors the digest of each of their strings."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = K.text_buffers(batch.column(1))
            out = ([], [], [], [])
            for row, (doc, wanted) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())):
                text = raw[off[row]:off[row + 1]].tobytes()
                for w in wanted:
                    for s in range(w["s0"], w["s0"] + w["n"] - length + 1) if hot else (w["s0"],):
                        out[0].append(w["h"])
                        out[1].append(doc)
                        out[2].append(s)
                        out[3].append(xxhash.xxh3_128_digest(text[s:s + length]) if hot else text[s:s + w["n"]])
                if len(out[0]) >= 20_000:
                    yield _cut_batch(out)
                    out = ([], [], [], [])
            yield _cut_batch(out)
    return run


def _cut_batch(out) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                                       pa.array(out[2], pa.int32()), pa.array(out[3], pa.binary())],
                                      ["h", "doc_id", "s0", "x"])


def repeated_ranges(docs: DataFrame, scratch: Scratch, length: int = LENGTH, gram: int = GRAM,
                    hot: int = HOT) -> DataFrame:
    """(doc_id, a, b): byte ranges to remove, not yet merged per document."""
    rows = docs.where("doc_id IS NOT NULL").select("doc_id", "text")
    seen = (rows.mapInArrow(_anchor_rows(length, gram, False), "h bigint, c bigint")
            .groupBy("h").agg(F.sum("c").alias("c")).where("c > 1").select("h"))
    anchors = rows.mapInArrow(_anchor_rows(length, gram, True), "h bigint, d bigint, doc_id bigint, s0 int, n smallint")
    common = scratch.keep(anchors.join(seen, "h", "left_semi"), "common")

    place = F.struct("doc_id", "s0", "n")
    kinds = scratch.keep(common.groupBy("h", "d").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("c")), "kinds")
    repeated = kinds.where("c > 1").select("h", "d", F.col("first.doc_id").alias("fd"), F.col("first.s0").alias("fs"))
    again = scratch.keep(common.join(repeated, ["h", "d"]).where("doc_id <> fd OR s0 <> fs")
                         .select("doc_id", F.col("s0").alias("a"), (F.col("s0") + F.col("n")).alias("b")), "again")
    scratch.drop("common")

    mixed = kinds.groupBy("h").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    wanted = (kinds.join(mixed, "h")
              .select(F.col("first.doc_id").alias("doc_id"), "k",
                      F.struct("h", F.col("first.s0").alias("s0"), F.col("first.n").alias("n")).alias("w"))
              .groupBy("doc_id").agg(F.collect_list(F.when(F.col("k") <= hot, F.col("w"))).alias("plain"),
                                     F.collect_list(F.when(F.col("k") > hot, F.col("w"))).alias("hot")))
    wanted = scratch.keep(wanted, "wanted")
    scratch.drop("kinds")
    schema = "h bigint, doc_id bigint, s0 int, x binary"
    cut = (rows.join(wanted.where(F.size("plain") > 0).select("doc_id", "plain"), "doc_id")
           .select("doc_id", "text", "plain").mapInArrow(_cut(False, length), schema))
    mixed_ranges = (cut.repartition("h").sortWithinPartitions("h")
                    .mapInArrow(_expand(length, gram), "doc_id bigint, a int, b int"))
    ranges = again.unionByName(mixed_ranges)
    if wanted.where(F.size("hot") > 0).limit(1).count():
        strings = scratch.keep(
            rows.join(wanted.where(F.size("hot") > 0).select("doc_id", "hot"), "doc_id")
            .select("doc_id", "text", "hot").mapInArrow(_cut(True, length), schema), "strings")
        firsts = (strings.groupBy("x").agg(F.min(F.struct("doc_id", "s0")).alias("f"), F.count(F.lit(1)).alias("c"))
                  .where("c > 1").select("x", F.col("f.doc_id").alias("fd"), F.col("f.s0").alias("fs")))
        ranges = ranges.unionByName(strings.join(firsts, "x").where("doc_id <> fd OR s0 <> fs")
                                    .select("doc_id", F.col("s0").alias("a"), (F.col("s0") + length).alias("b")))
    return ranges


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, off = K.text_buffers(batch.column(1))
        size, gone, spans, digest, kept = [], [], [], [], []
        for row, ranges in enumerate(batch.column(2).to_pylist()):
            text = raw[off[row]:off[row + 1]].tobytes()
            runs: list[list[int]] = []
            for r in sorted((r["a"], r["b"]) for r in ranges or ()):
                if runs and r[0] <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], r[1])
                else:
                    runs.append(list(r))
            edges = [0] + [e for run in runs for e in run] + [len(text)]
            left = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
            size.append(len(text))
            gone.append(len(text) - len(left))
            spans.append(len(runs))
            digest.append(hashlib.sha256(left).hexdigest())
            kept.append(left)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()),
             pa.array(digest, pa.string()), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) per row; ``kept``
    are the remaining bytes (a cut may fall inside a character)."""
    scratch = Scratch(docs.sparkSession, "suffix")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ranges = repeated_ranges(rows, scratch, length, gram, hot)
    per_doc = scratch.keep(ranges.groupBy("doc_id").agg(F.collect_set(F.struct("a", "b")).alias("ranges")), "ranges")
    scratch.drop("again", "wanted", "strings")
    return (rows.join(per_doc, "doc_id", "left").select("doc_id", "text", "ranges")
            .mapInArrow(_strip, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, "
                                "kept_sha256 string, kept binary"))
