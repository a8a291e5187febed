"""Near-duplicate documents by bottom-k sketches (operator 5).

Method: every document keeps the lowest values of its shingles under one hash
function, inverted lists of the retained values generate overlapping pairs,
the sketch of the union estimates their similarity, and the exact Jaccard
coefficient on the full sets confirms each link.

* **Retained values.**  A document's distinct shingle hashes are put in order,
  and each two neighbours are hashed to one value: two documents with
  similarity 0.8 or more differ in at most a fifth of their union, so at least
  ``0.6 u - 1`` neighbour pairs of a union of u are the same in both, while
  unrelated documents that share common shingles hardly share any.  The
  ``KEYS`` lowest values are retained.  A link shares about half of them; it is
  a candidate from ``OVERLAP`` on (chance of a miss at the threshold below
  1e-9, none for sets of up to ``KEYS`` shingles, which retain everything).
* **Copies.**  Documents with equal sets collapse into the smallest doc_id
  before any list is built, so a group of exact copies costs one row per copy.
  Sets of fewer than four shingles can only link to equal ones.
* **First round.**  In every list each member is paired with the list's
  smallest doc_id only; a document keeps its most frequent partner.  Members
  of long lists also meet in blocks of a few of their lists and take their
  best partners there.  After exact verification most groups are one component.
* **Second round.**  Only lists that still hold two components are looked at.
  Short ones (at most ``SHORT_LIST`` members) join across components.  In long
  ones, documents with more than a few values in long lists are compared in
  blocks inside tasks: those outside the list's largest component against all.
  (Any other link has enough values in short lists.)  Pairs inside one
  component are never formed, no list is cut.
* **Estimate.**  The union sketch of ``SKETCH`` uniform values rejects a pair
  only five standard deviations below the threshold (less than one in 10**6 of
  the links that lie right at it; none if the sets fit the sketch); everything
  else is verified exactly.

Edge cases: null or empty text has an empty set (n_shingles 0) and links with
nothing; a text with fewer words than a shingle has its whole sequence as its
one shingle; repeated rows of a document collapse (an id with several texts is
compared by one of them); null doc_id rows are kept as rows of their own with
null component; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm import kernels as K
from tidewatch.llm.components import connected_components
from tidewatch.llm.store import Scratch

SHINGLE_WORDS = 5
PERCENT = 80
KEYS = 48            # retained values of a document
OVERLAP = 3          # retained values that a link has to share
SKETCH = 256         # uniform values of a document's estimate sketch
SHORT_LIST = 32
BLOCK = 1024         # members of a long list compared in one task
SHARED = 6           # retained values that a link shares at least (see _long_list_pairs)
FIRST_LISTS = 4      # those in which it first looks for partners
FIRST_PARTNERS = 2
LEAST_SET = 4        # smaller sets at similarity 0.8 are equal


def shingle_sets(raw: np.ndarray, off: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Per document its sorted distinct shingle hashes; empty without words."""
    for i, j in K.slices(off):
        words, first = K.words_of(raw, off, i, j)
        every = K.shingles_of(words, size)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= size:
                own = np.sort(every[a:b - size + 1])
                fresh = np.empty(len(own), dtype=bool)
                fresh[0] = True
                np.not_equal(own[1:], own[:-1], out=fresh[1:])
                yield own[fresh]
            elif b > a:
                yield np.array([K.sequence_hash(words[a:b])], dtype=np.uint64)
            else:
                yield np.zeros(0, dtype=np.uint64)


def retained(own: np.ndarray) -> np.ndarray:
    """The lowest values of neighbouring shingles."""
    return np.sort(K.mix(own[:-1] * np.uint64(0x9E3779B97F4A7C15) + own[1:]))[:KEYS]


def _describe(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = K.text_buffers(batch.column(1))
            n, digest, kept = [], [], []
            for own in shingle_sets(raw, off, size):
                n.append(len(own))
                digest.append(xxhash.xxh3_128_digest(own.tobytes()))
                kept.append(retained(own))
            ends = np.cumsum([0] + [len(x) for x in kept])
            values = np.concatenate(kept).view(np.int64) if kept else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))], ["doc_id", "n", "digest", "kept"])
    return run


def _sketches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = K.text_buffers(batch.column(1))
            n, sketch = [], []
            for own in shingle_sets(raw, off, size):
                n.append(len(own))
                sketch.append(np.unique((own[:SKETCH] >> np.uint64(32)).astype(np.uint32)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(sketch, pa.binary())],
                                             ["doc_id", "n", "sketch"])
    return run


def _full_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = K.text_buffers(batch.column(1))
            sets = [own.tobytes() for own in shingle_sets(raw, off, size)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["doc_id", "shingles"])
    return run


def estimate(a: bytes, b: bytes) -> float:
    """Jaccard estimate from the sketch of the union (exact for small sets)."""
    x, y = np.frombuffer(a, dtype=np.uint32), np.frombuffer(b, dtype=np.uint32)
    both = np.concatenate([x, y])
    both.sort()
    same = np.empty(len(both), dtype=bool)
    same[-1:] = False
    np.equal(both[1:], both[:-1], out=same[:-1])
    # the union's lowest SKETCH values: a duplicate pair counts once
    size = min(SKETCH, len(both) - int(same.sum()))
    shared = np.cumsum(same)
    rank = np.arange(1, len(both) + 1) - (shared - same)   # distinct values up to here
    cut = int(np.searchsorted(rank, size, side="right"))
    return float(same[:cut].sum()) / max(size, 1)


def least_estimate(percent: int, n_a, n_b):
    """Estimates below this are no links: five standard deviations under the
    threshold, without replacement, so sets that fit the sketch are exact."""
    p = percent / 100
    union = (np.asarray(n_a, dtype=float) + n_b) / (1 + p)
    unseen = np.clip((union - SKETCH) / np.maximum(union - 1, 1), 0, 1)
    return p - 5 * np.sqrt(p * (1 - p) / SKETCH * unseen) - 1e-6


def _likely(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            mask = pa.array([bool(estimate(x["sketch"], y["sketch"]) >= least_estimate(percent, x["n"], y["n"]))
                             for x, y in rows], pa.bool_())
            yield batch.select([0, 1]).filter(mask)
    return run


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3)):
                a, b = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                both = np.concatenate([a, b])
                both.sort()
                inter = int(np.count_nonzero(both[1:] == both[:-1]))
                ok.append(100 * inter >= percent * (len(both) - inter))
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))
    return run


def _with_both(pairs: DataFrame, table: DataFrame, col: str) -> DataFrame:
    """a, b and the column of either side; the side is joined to pairs, whose
    hot ids the skew join splits."""
    def side(k):
        return table.select(F.col("doc_id").alias(k), F.col(col).alias(f"{col}_{k}"))
    return pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").select("a", "b", f"{col}_a", f"{col}_b")


def likely_pairs(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    described = sketches.select("doc_id", F.struct("n", "sketch").alias("s"))
    return _with_both(pairs, described, "s").mapInArrow(_likely(percent), "a bigint, b bigint")


def verified(pairs: DataFrame, rows: DataFrame, scratch: Scratch, name: str, size: int, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold.  Sets are built anew
    from the text, of the documents in ``pairs`` only."""
    ids = scratch.keep(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), f"{name}_ids")
    sets = scratch.keep(rows.where("doc_id IS NOT NULL").join(ids, "doc_id", "left_semi")
                        .mapInArrow(_full_sets(size), "doc_id bigint, shingles binary")
                        .groupBy("doc_id").agg(F.first("shingles").alias("shingles")), f"{name}_sets")
    out = scratch.keep(_with_both(pairs, sets, "shingles").mapInArrow(_confirmed(percent), "a bigint, b bigint"),
                       f"{name}_links")
    scratch.drop(f"{name}_ids", f"{name}_sets")
    return out


def _sizes_fit(x: str, y: str, percent: int):
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def _products(xs: list[np.ndarray], ys: list[np.ndarray]) -> np.ndarray:
    """Number of values that each x shares with each y (sets of distinct
    values), as matrix products over slices of the common values."""
    values, count = np.unique(np.concatenate([*xs, *ys]), return_counts=True)
    values = values[count > 1]
    out = np.zeros((len(xs), len(ys)), dtype=np.float32)
    for at in range(0, len(values), 4096):
        part = values[at:at + 4096]

        def incidence(side: list[np.ndarray]) -> np.ndarray:
            m = np.zeros((len(side), len(part)), dtype=np.float32)
            for i, s in enumerate(side):
                k = np.searchsorted(part, s)
                k[k == len(part)] = 0
                m[i, k[part[k] == s]] = 1
            return m
        out += incidence(xs) @ incidence(ys).T
    return out


def sketch_overlap(x: list[bytes], y: list[bytes]) -> np.ndarray:
    """For each pair of sketches the shared values over the size of the union
    sketch (never below the estimate)."""
    xs, ys = ([np.frombuffer(s, dtype=np.uint32) for s in side] for side in (x, y))
    shared = _products(xs, ys)
    union = np.array([len(s) for s in xs])[:, None] + np.array([len(s) for s in ys])[None, :] - shared
    return shared / np.maximum(np.minimum(union, SKETCH), 1)


def _block_pairs(q: pd.DataFrame, m: pd.DataFrame, percent: int, best: int | None = None) -> pd.DataFrame:
    """Likely pairs (a < b) of different components between two blocks of one
    list.  With ``best`` only that many partners of each member of q; without,
    only pairs that share no lower list, so that each pair comes up once."""
    if not len(q) or not len(m):
        return pd.DataFrame({"a": [], "b": []}, dtype="int64")
    score = sketch_overlap(q["sketch"].tolist(), m["sketch"].tolist())
    qn, mn = q["n"].to_numpy()[:, None], m["n"].to_numpy()[None, :]
    able = ((score >= least_estimate(percent, qn, mn)) & (np.minimum(mn, qn) * 100 >= np.maximum(mn, qn) * percent)
            & (q["component"].to_numpy()[:, None] != m["component"].to_numpy()[None, :]))
    if best is None:
        v = q["v"].iat[0]
        able &= _products(*([np.array([k for k in ks if k < v], dtype=np.int64) for ks in side["lists"]]
                            for side in (q, m))) == 0
    elif able.shape[1] > best:
        score = np.where(able, score, -1)
        able &= score >= np.partition(score, -best, axis=1)[:, -best][:, None]
    x, y = np.nonzero(able)
    a, b = q["doc"].to_numpy()[x], m["doc"].to_numpy()[y]
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}, dtype="int64").drop_duplicates()


def _partners_in_blocks(hot: DataFrame, sketches: DataFrame, percent: int, block: int) -> DataFrame:
    """First round in long lists: members meet in random blocks of a few of
    their lists, and each takes its best partners there."""
    few = F.row_number().over(Window.partitionBy("doc").orderBy("v"))
    rows = (hot.withColumn("k", few).where(F.col("k") <= FIRST_LISTS)
            .withColumn("block", F.pmod(F.xxhash64("doc", "v"), F.ceil(F.col("c") / block)))
            .select("v", "block", "doc", "n", F.col("doc").alias("component"))
            .join(sketches.select(F.col("doc_id").alias("doc"), "sketch"), "doc"))
    return (rows.groupBy("v", "block").applyInPandas(
        lambda m: _block_pairs(m, m, percent, FIRST_PARTNERS), "a bigint, b bigint").distinct())


def _long_list_pairs(members: DataFrame, sketches: DataFrame, percent: int, block: int) -> DataFrame:
    """Likely pairs across components inside long lists.

    ``members`` (v, doc, n, component) are the lists that hold several
    components.  A link without a common short list shares at least
    ``SHARED`` of these (fewer only for sets so small that 0.6 n - 1 is less;
    at the threshold with the chance of 1e-9 that a candidate is missed at
    all).  So of h lists the first h - SHARED + 1 of both sides have one in
    common (prefix filter), and a document takes part in those.  Members
    outside the largest component are compared with all members, a block of at
    most about ``block`` of each in one task.
    """
    least = F.least(F.lit(SHARED), F.greatest(F.lit(1), F.floor((F.col("n") * 6 - 10) / 10))).cast("int")
    members = (members.groupBy("doc", "n", "component").agg(F.sort_array(F.collect_set("v")).alias("lists"))
               .withColumn("lists", F.slice("lists", F.lit(1), F.greatest(F.lit(1), F.size("lists") - least + 1)))
               .select("doc", "n", "component", "lists", F.explode("lists").alias("v")))
    sizes = members.groupBy("v", "component").agg(F.count(F.lit(1)).alias("k"))
    main = sizes.groupBy("v").agg(F.max_by("component", F.struct("k", "component")).alias("main"),
                                  F.sum("k").alias("c"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    rows = (members.join(main, "v")
            .join(sketches.select(F.col("doc_id").alias("doc"), "sketch"), "doc")
            .withColumn("blocks", F.ceil(F.col("c") / block).cast("int"))
            .withColumn("own", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int")))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    cols = ("v", "qb", "mb", "doc", "n", "component", "lists", "sketch")
    right = rows.select("*", F.col("own").alias("mb"), F.explode(every).alias("qb")).select(*cols)
    left = (rows.where("component <> main")
            .select("*", F.col("own").alias("qb"), F.explode(every).alias("mb"))
            .select(*[F.col(c).alias(f"q_{c}") for c in cols]))

    def compare(q: pd.DataFrame, m: pd.DataFrame) -> pd.DataFrame:
        return _block_pairs(q.rename(columns=lambda c: c[2:]), m, percent)

    keys = ["v", "qb", "mb"]
    return (left.groupBy(*[f"q_{k}" for k in keys]).cogroup(right.groupBy(*keys))
            .applyInPandas(compare, "a bigint, b bigint").distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE_WORDS, percent: int = PERCENT,
                    short_list: int = SHORT_LIST, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Linked are documents with 100 * intersection >= percent * union of their
    distinct ``shingle``-word shingles; component_id is the smallest doc_id
    reachable over links; kept marks the row that stays.  ``percent`` is 80 or
    more: the retained values are laid out for that.
    """
    if percent < 80:
        raise ValueError("similarity has to be 80 percent or more")
    scratch = Scratch(docs.sparkSession, "neardup")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    described = scratch.keep(rows.mapInArrow(
        _describe(shingle), "doc_id bigint, n bigint, digest binary, kept array<bigint>"), "described")
    known = described.where("n > 0 AND doc_id IS NOT NULL")
    copies = scratch.keep(known.groupBy("digest").agg(F.min("doc_id").alias("rep")), "copies")
    reps = copies.select(F.col("rep").alias("doc_id"))

    # one row per retained value of each distinct set
    # dealt by value once: the lists are counted and joined back on the same shuffle
    entries = (known.where(F.col("n") >= LEAST_SET).select("doc_id", "n", "kept").join(reps, "doc_id", "left_semi")
               .select(F.col("doc_id").alias("doc"), "n", F.explode("kept").alias("v")).repartition("v"))
    lists = (entries.groupBy("v").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("doc", "n")).alias("lead"))
             .where("c > 1").select("v", "c", F.col("lead.doc").alias("leader"), F.col("lead.n").alias("leader_n")))
    listed = scratch.keep(entries.join(lists, "v"), "listed")
    # retained values of all documents are not read again
    narrow = scratch.keep(described.select("doc_id", "n", "digest"), "narrow")
    scratch.drop("described")
    # sketches are the widest table: built from the texts once they are needed, and never held
    # next to the retained values or of documents without lists
    sketches = rows.where("doc_id IS NOT NULL").mapInArrow(_sketches(shingle), "doc_id bigint, n bigint, sketch binary").where("n >= 1")
    sketches = scratch.keep(sketches.join(listed.select(F.col("doc").alias("doc_id")).distinct(), "doc_id", "left_semi")
                            .dropDuplicates(["doc_id"]), "sketches")

    # first round: the most frequent leader of each document
    first = (listed.where(F.col("doc") != F.col("leader")).where(_sizes_fit("n", "leader_n", percent))
             .groupBy("doc", "leader").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
             .groupBy("doc").agg(F.max_by("leader", F.struct(F.col("k"), -F.col("leader"))).alias("a"))
             .select("a", F.col("doc").alias("b")))
    # with no more values than ``allowed`` in long lists, a link shows in a short one
    allowed = F.least(F.lit(4), F.greatest(F.lit(0), F.floor((F.col("n") * 6 - 20) / 10)))
    hot = listed.groupBy("doc").agg(F.sum(F.when(F.col("c") > short_list, 1).otherwise(0)).alias("hot"))
    members = scratch.keep(listed.select("v", "doc", "n", "c").join(hot, "doc"), "members")
    in_long = members.where((F.col("c") > short_list) & (F.col("hot") > allowed))
    likely = scratch.keep(likely_pairs(first, sketches, percent).unionByName(
        _partners_in_blocks(in_long, sketches, percent, block)).distinct(), "likely1")
    scratch.drop("listed")
    links = verified(likely, rows, scratch, "first", shingle, percent)
    so_far = connected_components(links, scratch, "cc1")

    # second round: lists that still hold several components
    placed = (members.join(so_far.select(F.col("id").alias("doc"), "component"), "doc", "left")
              .withColumn("component", F.coalesce("component", "doc")))
    placed = scratch.keep(placed, "placed")
    scratch.drop("members", "likely1")
    open_lists = (placed.groupBy("v").agg(F.min("component").alias("x"), F.max("component").alias("y"))
                  .where("x <> y").select("v"))
    still = scratch.keep(placed.join(open_lists, "v", "left_semi"), "open")
    scratch.drop("placed")
    short = still.where(F.col("c") <= short_list)
    x, y = (short.select("v", *[F.col(k).alias(f"{k}_{s}") for k in ("doc", "n", "component", "hot")])
            for s in "xy")
    # values that a link of this size shares at least, up to OVERLAP
    share = F.least(F.lit(OVERLAP), F.greatest(F.lit(1), F.floor((F.col("n") * 6 - 10) / 10)))
    across = (x.join(y, "v").where("doc_x < doc_y AND component_x <> component_y")
              .where(_sizes_fit("n_x", "n_y", percent))
              .groupBy(F.col("doc_x").alias("a"), F.col("doc_y").alias("b"))
              .agg(F.count(F.lit(1)).alias("k"), F.min(F.least("hot_x", "hot_y")).alias("hot"),
                   F.min(F.greatest("n_x", "n_y")).alias("n"))
              .where(F.col("k") + F.col("hot") >= share).select("a", "b"))
    within = _long_list_pairs(still.where((F.col("c") > short_list) & (F.col("hot") > allowed)), sketches, percent, block)
    second = scratch.keep(likely_pairs(across, sketches, percent).unionByName(within).distinct(), "likely2")
    scratch.drop("sketches", "open")
    links = links.unionByName(verified(second, rows, scratch, "second", shingle, percent))
    final = connected_components(links, scratch, "cc2")
    scratch.drop("likely2")

    by_set = (copies.join(final.select(F.col("id").alias("rep"), "component"), "rep", "left")
              .select("digest", F.coalesce("component", "rep").alias("component")))
    out = narrow.select("doc_id", F.col("n").alias("n_shingles"),
                           F.when(F.col("n") > 0, F.col("digest")).alias("digest"))
    return (out.join(by_set, "digest", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


# whole-table SQL of the two-word form: every pair that shares a shingle
NEAR_DUP_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 1 THEN w
        ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS x FROM w),
n AS (SELECT w.doc_id, count(s.x) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY w.doc_id),
z AS (SELECT s.doc_id, s.x, n.n FROM s JOIN n USING (doc_id)),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS i
      FROM z a JOIN z b ON a.x = b.x AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
      GROUP BY 1, 2),
l AS (SELECT a, b FROM p WHERE 100 * i >= 80 * (na + nb - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM n UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id AND r.c < e.b)
SELECT n.doc_id, n.n AS n_shingles, min(r.c) AS component_id, n.doc_id = min(r.c) AS kept
FROM n JOIN r USING (doc_id) GROUP BY n.doc_id, n.n
"""
