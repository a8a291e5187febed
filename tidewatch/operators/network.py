"""Topic similarity network.

Term counts are built in long form ``(topic, term, tf)`` and added up inside
the tasks, so a topic holding a third of all records is spread over
every task of the scan and collapses to one row per distinct term before the
shuffle.  Everything after that is topic-level: its size is bounded by the
number of configured topics (checked) times the vocabulary.
"""

from __future__ import annotations

import heapq

import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import NGram, RegexTokenizer, StopWordsRemover
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions import terms as TM
from tidewatch.operators.joins import checked_broadcast, one_row
from tidewatch.plans.params import STOP_WORDS
from tidewatch.session import keep

TOP_NEIGHBOURS = 2
SEED_TERMS = 8         # heaviest shared terms of a topic that set its floor
GRADES = 4             # grades of document frequency per doubling
SLACK = 1e-9           # rounding of sums that are compared with a floor
DAMPING = 0.85
PR_MAX_ITER = 100
PR_TOL = 1e-6


def record_terms(records: DataFrame, clean_col: str = "clean_text", id_cols=("topic",),
                 stop_words=None) -> DataFrame:
    """X1 in long form: one row per (id_cols..., term) occurrence.

    Tokenising, stop-word removal and bigrams run in Spark ML's JVM
    transformers (tokens of >= 2 letters, stop words removed before pairing).
    """
    stops = list(STOP_WORDS if stop_words is None else stop_words)
    base = records.select(*id_cols, F.coalesce(F.col(clean_col), F.lit("")).alias("_ct"))
    tok = RegexTokenizer(inputCol="_ct", outputCol="_tok", pattern=" ", gaps=True,
                         minTokenLength=TM.MIN_TOKEN_CHARS, toLowercase=False)
    rem = StopWordsRemover(inputCol="_tok", outputCol="_uni", stopWords=stops, caseSensitive=True)
    ngr = NGram(n=2, inputCol="_uni", outputCol="_bi")
    out = ngr.transform(rem.transform(tok.transform(base)))
    return out.select(*id_cols, F.explode(F.concat("_uni", "_bi")).alias("term"))


def term_counts(records: DataFrame, by: str | None = None, clean_col: str = "clean_text", stop_words=None) -> DataFrame:
    """(``by``, term, tf), the terms of ``record_terms`` counted (without ``by`` over all records).

    Tasks add up their own records first (``TermSums``): no row is made per occurrence.
    """
    stops = list(STOP_WORDS if stop_words is None else stop_words)
    cols = [by] if by else []
    schema = T.StructType([records.schema[c] for c in cols] + [T.StructField("term", T.StringType()), T.StructField("tf", T.LongType())])

    def run(batches):
        sums, kind = TM.TermSums(stops), None

        def rows(parts):
            for values, terms, counts in parts:
                yield pa.RecordBatch.from_arrays(([pa.array(values, kind)] if cols else []) + [terms, pa.array(counts, pa.int64())],
                                                 schema.names)
        for batch in batches:
            kind = batch.column(0).type
            yield from rows(sums.add(batch.column(len(cols)), batch.column(0) if cols else None))
        yield from rows(sums.flush())

    return (records.select(*cols, F.col(clean_col).alias("_ct")).mapInArrow(run, schema)
            .groupBy(*cols, "term").agg(F.sum("tf").alias("tf")))


def topic_term_counts(records: DataFrame, clean_col: str = "clean_text", stop_words=None) -> DataFrame:
    return term_counts(records.where(F.col("topic").isNotNull()), "topic", clean_col, stop_words)


def topic_tfidf(counts: DataFrame) -> DataFrame:
    """Raw tf x smooth idf ln((1+n)/(1+df)) + 1, L2-normalised per topic.

    The (topic, term, tf) table feeds four branches, so it is written
    once instead of re-tokenising the corpus for each.
    """
    counts = keep(counts, "topic-terms")
    n = counts.agg(F.count_distinct("topic").alias("_n"))
    # document frequency as a window keyed by term: a term's group holds at
    # most one row per topic, and the result stays hash-partitioned by term,
    # which the cosine self-join on term then reuses without a new shuffle
    by_term = Window.partitionBy("term")
    w = (counts.crossJoin(one_row(n))
         .withColumn("_df", F.count(F.lit(1)).over(by_term))
         .withColumn("w", F.col("tf") * (F.log((1.0 + F.col("_n")) / (1.0 + F.col("_df"))) + 1.0)))
    w = keep(w, "topic-weights")   # read for the norms and, twice, by the similarity join
    norm = w.groupBy("topic").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("_norm"))
    return (w.join(checked_broadcast(norm), "topic")
            .select("topic", "term", (F.col("w") / F.col("_norm")).alias("weight")))


def topic_similarity(tfidf: DataFrame) -> DataFrame:
    """Cosine of every topic pair sharing a term (a.topic < b.topic).

    A term of very many topics is a hot key of the self-join: the skew join
    splits its partition, and the products of a pair are summed before the
    shuffle.
    """
    a = tfidf.select(F.col("topic").alias("topic_a"), "term", F.col("weight").alias("wa"))
    b = tfidf.select(F.col("topic").alias("topic_b"), "term", F.col("weight").alias("wb"))
    return (a.join(b, "term").where(F.col("topic_a") < F.col("topic_b"))
            .groupBy("topic_a", "topic_b").agg(F.sum(F.col("wa") * F.col("wb")).alias("similarity")))


def nearest_topics(tfidf: DataFrame, k: int = TOP_NEIGHBOURS) -> DataFrame:
    """(src, dst, similarity), each topic's ``k`` most similar topics
    (similarity > 0, ties by topic), without comparing all pairs.

    An inverted index with prefix filtering, exact:

    1. *Floor.*  Each topic meets the heaviest holders of its ``SEED_TERMS``
       heaviest shared terms; those pairs are scored in full, and the k-th best
       score is a floor under the topic's k-th neighbour.
    2. *Prefix.*  A topic's terms are graded by how many topics share them.  With
       ``m`` the largest weight of a term anywhere, a topic that shares only
       grades above some grade with it scores at most the sum of ``w * m``
       over these grades, and at most their norm.  The most common grades whose bound stays
       under the floor need no look-up: what is left is the topic's prefix.
    3. *Look-up.*  Only prefix terms are joined with the index; pairs not yet
       scored are scored in full, and the k best of each topic are kept.

    Bounds are taken per (topic, grade), combined before the shuffle, so a topic with
    very many terms is never sorted in one task.  A topic without k
    neighbours so far has floor 0 and looks up all its terms.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    # one shuffle by term: how many topics hold it, its largest weight, its heaviest holders
    by_term = Window.partitionBy("term")
    heaviest = by_term.orderBy(F.desc("weight"), "topic")
    index = (tfidf.select("topic", "term", "weight", F.count(F.lit(1)).over(by_term).alias("df"),
                          F.max("weight").over(by_term).alias("most"), F.row_number().over(heaviest).alias("place"))
             .where("weight > 0 AND df > 1"))   # terms of one topic alone cannot add to any pair
    # from here a term is a number, that of its first row: the result names topics only
    index = index.withColumn("_row", F.monotonically_increasing_id())
    index = keep(index.select("topic", F.min("_row").over(by_term).alias("term"), "weight", "df", "most", "place"), "topic-index")

    by_weight = Window.partitionBy("topic").orderBy(F.desc(F.col("weight") * F.col("most")), "term")
    seeds = (index.withColumn("_rn", F.row_number().over(by_weight)).where(F.col("_rn") <= SEED_TERMS)
             .select(F.col("topic").alias("src"), "term"))
    champions = index.where(F.col("place") <= k + 1).select("term", F.col("topic").alias("dst"))
    scored = _score_pairs(champions.join(checked_broadcast(seeds), "term"), index).checkpoint()

    floor = (_both_ways(scored).transform(_best, k).groupBy(F.col("src").alias("topic"))
             .agg(F.when(F.count(F.lit(1)) >= k, F.min("similarity")).alias("floor")))
    grade = F.floor(GRADES * F.log2("df")).cast("int")
    graded = (index.groupBy("topic", grade.alias("grade"))
              .agg(F.sum(F.col("weight") * F.col("most")).alias("reach"), F.sum(F.col("weight") * F.col("weight")).alias("square")))
    # one row per topic and grade, at most GRADES * log2(topics) of them a topic
    above = Window.partitionBy("topic").orderBy(F.desc("grade")).rowsBetween(Window.unboundedPreceding, 0)
    bound = F.least(F.sum("reach").over(above), F.sqrt(F.sum("square").over(above)))
    last = (graded.withColumn("bound", bound).join(floor, "topic", "left")
            .where(F.coalesce(F.col("bound") >= F.col("floor") * (1.0 - SLACK) - SLACK, F.lit(True)))
            .groupBy("topic").agg(F.max("grade").alias("last")))
    prefix = index.join(last, "topic").where(grade <= F.col("last")).select(F.col("topic").alias("src"), "term")
    found = (prefix.join(index.select("term", F.col("topic").alias("dst")), "term")
             .select(F.least("src", "dst").alias("topic_a"), F.greatest("src", "dst").alias("topic_b"))
             .where("topic_a < topic_b").distinct().join(scored, ["topic_a", "topic_b"], "left_anti"))
    pairs = _score_pairs(found.select(F.col("topic_a").alias("src"), F.col("topic_b").alias("dst")), index).unionByName(scored)
    return _best(_both_ways(pairs), k)


def _score_pairs(pairs: DataFrame, index: DataFrame) -> DataFrame:
    """(topic_a, topic_b, similarity) of the given (src, dst) pairs, each once."""
    pairs = (pairs.select(F.least("src", "dst").alias("topic_a"), F.greatest("src", "dst").alias("topic_b"))
             .where("topic_a < topic_b").distinct())
    pairs = checked_broadcast(pairs)   # few: the index is then moved once, dealt by topic and term
    a = index.select(F.col("topic").alias("topic_a"), "term", F.col("weight").alias("wa"))
    b = index.select(F.col("topic").alias("topic_b"), "term", F.col("weight").alias("wb"))
    return (pairs.join(a, "topic_a").join(b, ["topic_b", "term"])
            .groupBy("topic_a", "topic_b").agg(F.sum(F.col("wa") * F.col("wb")).alias("similarity")))


def _both_ways(pairs: DataFrame) -> DataFrame:
    return (pairs.select(F.col("topic_a").alias("src"), F.col("topic_b").alias("dst"), "similarity")
            .unionByName(pairs.select(F.col("topic_b").alias("src"), F.col("topic_a").alias("dst"), "similarity")))


def _best(directed: DataFrame, k: int) -> DataFrame:
    """The k largest similarities above 0 of each ``src``, ties by topic."""
    w = Window.partitionBy("src").orderBy(F.desc("similarity"), F.asc("dst"))
    return (directed.where("similarity > 0").withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") <= k).drop("_rn"))


def _merge_edges(top: DataFrame) -> DataFrame:
    return (top.groupBy(F.least("src", "dst").alias("source_topic"), F.greatest("src", "dst").alias("target_topic"))
            .agg(F.max("similarity").alias("weight")))


def similarity_edges(sim: DataFrame, k: int = TOP_NEIGHBOURS) -> DataFrame:
    """X5 / W8 / R9 from ready similarities of pairs: each topic's top-k neighbours
    (weight > 0, ties by topic), undirected and merged by max weight."""
    return _merge_edges(_best(_both_ways(sim), k))


def topic_edges(tfidf: DataFrame, k: int = TOP_NEIGHBOURS) -> DataFrame:
    """X5 / W8 / R9 from weighted terms: the same edges without all pairs."""
    return _merge_edges(nearest_topics(tfidf, k))


def degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Degree and weighted degree; isolated topics get 0."""
    ends = (edges.select(F.col("source_topic").alias("topic"), "weight")
            .unionByName(edges.select(F.col("target_topic").alias("topic"), "weight")))
    agg = ends.groupBy("topic").agg(F.count(F.lit(1)).alias("degree"),
                                    F.sum("weight").alias("weighted_degree"))
    return (nodes.select("topic").join(agg, "topic", "left")
            .select("topic", F.coalesce("degree", F.lit(0)).cast("bigint").alias("degree"),
                    F.coalesce("weighted_degree", F.lit(0.0)).alias("weighted_degree")))


# --- X6: PageRank as an iterative DataFrame job --------------------------------

_SINK = "\u0000dangling"   # virtual node that collects the rank of dangling topics
PR_BLOCK = 10              # iterations planned into one job


def pagerank(nodes: DataFrame, edges: DataFrame, damping: float = DAMPING,
             max_iter: int = PR_MAX_ITER, tol: float = PR_TOL, block: int = PR_BLOCK) -> DataFrame:
    """Weighted PageRank on the undirected graph (both directions).

    Uniform start and teleport; the rank of nodes without edges (dangling) is
    spread uniformly.  Stops at the first iteration whose L1 change is below
    n * tol.

    ``block`` iterations are planned into one job.  Each step refers to the
    previous one once (the plan grows linearly): ranks flow over the edge
    table, dangling rank flows to a virtual sink, and a zero-weight self edge
    carries each node's rank history through the same aggregate.  After a
    block the state is checkpointed to the shared folder (short lineage; a
    lost executor repeats at most one block) and one small aggregate reads the
    L1 change of every step of the block.  The edge table is broadcast up to a
    checked size and shuffled beyond it.  Raises if the ranks do not settle.
    """
    node_ids = nodes.select("topic").distinct().checkpoint()
    n = node_ids.count()
    if n == 0:
        return nodes.select("topic", F.lit(0.0).alias("pagerank"))
    directed = (edges.select(F.col("source_topic").alias("src"), F.col("target_topic").alias("dst"), "weight")
                .unionByName(edges.select(F.col("target_topic").alias("src"),
                                          F.col("source_topic").alias("dst"), "weight")))
    out_w = directed.groupBy("src").agg(F.sum("weight").alias("_out"))
    dangling = (node_ids.join(out_w.withColumnRenamed("src", "topic"), "topic", "left_anti")
                .select(F.col("topic").alias("src"), F.lit(_SINK).alias("dst"), F.lit(1.0).alias("p"),
                        F.lit(False).alias("self")))
    selfs = node_ids.select(F.col("topic").alias("src"), F.col("topic").alias("dst"),
                            F.lit(0.0).alias("p"), F.lit(True).alias("self"))
    trans = (directed.join(out_w, "src")
             .select("src", "dst", (F.col("weight") / F.col("_out")).alias("p"), F.lit(False).alias("self"))
             .unionByName(dangling).unionByName(selfs))
    trans = checked_broadcast(trans)
    everything = Window.partitionBy()   # over the node table only: one row per topic

    def step(r: DataFrame) -> DataFrame:
        agg = (r.join(trans, r.topic == trans.src)
               .groupBy(F.col("dst").alias("topic"))
               .agg(F.sum(F.col("rank") * F.col("p")).alias("_c"),
                    F.max(F.when(F.col("self"), F.col("hist"))).alias("hist")))
        dm = F.max(F.when(F.col("topic") == _SINK, F.col("_c"))).over(everything)
        new_rank = (damping * F.col("_c") + (damping * F.coalesce(F.col("_dm"), F.lit(0.0))
                                             + (1.0 - damping)) / n)
        return (agg.withColumn("_dm", dm).where(F.col("topic") != _SINK)
                .withColumn("rank", new_rank)
                .select("topic", "rank", F.concat("hist", F.array("rank")).alias("hist")))

    state = node_ids.select("topic", F.lit(1.0 / n).alias("rank"),
                            F.array(F.lit(1.0 / n)).alias("hist")).checkpoint()
    done = 0
    while done < max_iter:
        k = min(block, max_iter - done)
        cur = state
        for _ in range(k):
            cur = step(cur)
        cur = cur.checkpoint()
        errs = cur.agg(*[F.sum(F.abs(F.element_at("hist", i + 2) - F.element_at("hist", i + 1)))
                         .alias(f"e{i}") for i in range(k)]).first()
        hit = next((i for i in range(k) if errs[f"e{i}"] < n * tol), None)
        if hit is not None:
            return cur.select("topic", F.element_at("hist", hit + 2).alias("pagerank"))
        state = cur.select("topic", "rank", F.array("rank").alias("hist"))
        done += k
    raise RuntimeError(f"PageRank did not settle within {max_iter} iterations")


# --- X7: betweenness (Brandes) as joins over (source, node) rows ----------------

SOURCE_BLOCK = 2_000   # sources whose rows are held at once
HOP_BLOCK = 4          # rounds planned into one job
TASK_EDGES = 500_000   # a graph of at most so many edges fits a task (some 100 MB)


def shortest_paths(start: DataFrame, links: DataFrame, block: int = HOP_BLOCK) -> DataFrame:
    """(source, node, far, paths, hops) of every node within reach of the sources
    in ``start``: distance, number of shortest paths and hops of the longest of them.

    ``links`` is (src, dst, weight) in both directions, weights above 0.  A round
    offers every row to the node's neighbours and keeps the nearest offers, with
    the paths of equally near ones added up; the rows settle after as many rounds as the
    longest shortest path has hops.  ``block`` rounds are one job, checkpointed to
    the shared folder, then one more round shows whether anything still changes.
    """
    first = start.select(F.col("topic").alias("source"), F.col("topic").alias("node"), F.lit(0.0).alias("far"),
                         F.lit(1.0).alias("paths"), F.lit(0).alias("hops")).checkpoint()

    def step(rows: DataFrame) -> DataFrame:
        offers = (rows.join(links, rows["node"] == links["src"])
                  .select("source", F.col("dst").alias("node"), (F.col("far") + F.col("weight")).alias("far"), "paths",
                          (F.col("hops") + 1).alias("hops")).unionByName(first))
        # a node has at most one offer per neighbour
        equal = offers.groupBy("source", "node", "far").agg(F.sum("paths").alias("paths"), F.max("hops").alias("hops"))
        near = equal.groupBy("source", "node").agg(F.min(F.struct("far", "paths", "hops")).alias("_n"))
        return near.select("source", "node", "_n.far", "_n.paths", "_n.hops")

    rows = first
    while True:
        for _ in range(block):
            rows = step(rows)
        rows = rows.checkpoint()
        after = step(rows).checkpoint()
        if not after.join(rows, rows.columns, "left_anti").limit(1).count():
            return after
        rows = after


def dependencies(paths: DataFrame, links: DataFrame, block: int = HOP_BLOCK) -> DataFrame:
    """(source, node, share): Brandes' dependency of each source on each node.

    Every step of a shortest path hands the share of the node behind it, plus one, back
    to the node before it, in proportion to the paths through that node.
    All steps are laid out once; after as many rounds as the longest path has hops
    the shares are exact.
    """
    near = paths.select("source", F.col("node").alias("src"), F.col("far").alias("_far"), F.col("paths").alias("_paths"))
    there = paths.select("source", F.col("node").alias("dst"), "far", "paths")
    steps = (near.join(links, "src").join(there, ["source", "dst"]).where(F.col("_far") + F.col("weight") == F.col("far"))
             .select("source", "src", "dst", (F.col("_paths") / F.col("paths")).alias("part")).checkpoint())
    hops = paths.agg(F.max("hops")).first()[0] or 0

    def step(shares: DataFrame) -> DataFrame:
        behind = shares.select("source", F.col("node").alias("dst"), "share")
        return (steps.join(behind, ["source", "dst"], "left")
                .groupBy("source", F.col("src").alias("node"))
                .agg(F.sum(F.col("part") * (1.0 + F.coalesce("share", F.lit(0.0)))).alias("share")))

    shares = steps.select("source", F.col("src").alias("node"), F.lit(0.0).alias("share")).limit(0)
    for done in range(hops):
        shares = step(shares)
        if (done + 1) % block == 0:
            shares = shares.checkpoint()
    return shares.where("source <> node")


def _distances(graph: dict, start: str) -> list:
    """(distance, node) of all reachable nodes, nearest first."""
    settled: dict[str, float] = {}
    order, frontier = [], [(0.0, start)]
    while frontier:
        far, node = heapq.heappop(frontier)
        if node in settled:
            continue
        settled[node] = far
        order.append((far, node))
        for other, length in graph[node]:
            if other not in settled:
                heapq.heappush(frontier, (far + length, other))
    return order


def source_dependencies(graph: dict, start: str) -> dict[str, float]:
    """Brandes' dependencies of one source: paths are counted outwards over the
    shortest-path graph, and each node hands its share back to the nodes that
    lead to it, farthest first."""
    order = _distances(graph, start)
    far = {node: d for d, node in order}
    leads = {node: [other for other, length in graph[node] if other in far and far[other] + length == d and other != node]
             for d, node in order}
    paths = {start: 1.0}
    for _, node in order[1:]:
        paths[node] = sum(paths.get(other, 0.0) for other in leads[node])
    share = dict.fromkeys(far, 0.0)
    for _, node in reversed(order[1:]):
        for other in leads[node]:
            if paths[node]:
                share[other] += paths.get(other, 0.0) / paths[node] * (1.0 + share[node])
    share.pop(start)
    return share


def _dependencies_in_tasks(chosen: DataFrame, links: DataFrame, tasks: int) -> DataFrame:
    """(source, node, share) with one task per group of sources, each given the whole
    (checked) graph: far fewer rows than joins, and long chains cost no rounds."""
    def run(key, sources, edges):
        graph: dict[str, list] = {topic: [] for topic in sources["topic"]}
        for a, b, w in zip(edges["src"], edges["dst"], edges["weight"]):
            graph.setdefault(a, []).append((b, w))
            graph.setdefault(b, [])
        total: dict[str, float] = {}
        for topic in sources["topic"]:
            for node, value in source_dependencies(graph, topic).items():
                total[node] = total.get(node, 0.0) + value
        return pd.DataFrame({"node": pd.Series(list(total), dtype=object), "share": pd.Series(list(total.values()), dtype=float)})

    own = chosen.withColumn("task", F.pmod(F.xxhash64("topic"), F.lit(tasks)).cast("int")).groupBy("task")
    each = links.withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1)))).groupBy("task")
    return own.cogroup(each).applyInPandas(run, "node string, share double")


def betweenness(nodes: DataFrame, edges: DataFrame, sources: int | None = None, source_block: int = SOURCE_BLOCK,
                task_edges: int = TASK_EDGES) -> DataFrame:
    """Normalised weighted betweenness: sum over sources / ((n-1)(n-2)).

    Shortest paths use the edge weight as distance (the similarity itself, as
    in the original model).  Neither the driver nor a broadcast sees the graph.
    Up to ``task_edges`` edges (counted first) it is dealt to every group of sources
    as rows, and each task runs its sources on it.  Beyond that, paths and
    dependencies are joins and sums over (source, node) rows in checkpointed rounds, in blocks
    of ``source_block`` sources, as many rounds as the longest path has hops.
    The cost is topics times edges; ``sources`` estimates the result from that many sources (those
    with the lowest hash), scaled up.
    """
    node_ids = nodes.select("topic").distinct().checkpoint()
    n = node_ids.count()
    links = edges.select(F.col("source_topic").alias("src"), F.col("target_topic").alias("dst"), F.col("weight").cast("double").alias("weight"))
    links = (links.unionByName(links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
             .where("src <> dst AND weight > 0").checkpoint())
    scale = 1.0 / ((n - 1) * (n - 2)) if n > 2 else 0.0
    chosen, many = node_ids, n
    if sources is not None and sources < n:
        chosen, many = node_ids.orderBy(F.xxhash64("topic"), "topic").limit(sources).checkpoint(), sources
        scale *= n / sources
    if links.limit(2 * task_edges + 1).count() <= 2 * task_edges:
        tasks = max(1, min(many, nodes.sparkSession.sparkContext.defaultParallelism))
        total = _dependencies_in_tasks(chosen, links, tasks).select(F.col("node").alias("topic"), F.col("share").alias("_b"))
    else:
        # a source without links leads nowhere
        chosen = chosen.join(links.select(F.col("src").alias("topic")).distinct(), "topic", "left_semi").checkpoint()
        blocks = max(1, -(-many // source_block))
        total = None
        for b in range(blocks):
            own = chosen if blocks == 1 else chosen.where(F.pmod(F.xxhash64("topic"), F.lit(blocks)) == b)
            part = (dependencies(shortest_paths(own, links), links).groupBy(F.col("node").alias("topic"))
                    .agg(F.sum("share").alias("_b")).checkpoint())
            total = part if total is None else total.unionByName(part)
    summed = total.groupBy("topic").agg(F.sum("_b").alias("_b"))
    return (node_ids.join(summed, "topic", "left")
            .select("topic", (F.coalesce(F.col("_b"), F.lit(0.0)) * scale).alias("betweenness")))


def build_topic_network(records: DataFrame, stop_words=None) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) from prepared records with ``clean_text``."""
    tfidf = topic_tfidf(topic_term_counts(records, stop_words=stop_words))
    edges = topic_edges(tfidf).checkpoint()
    nodes = records.where(F.col("topic").isNotNull()).select("topic").distinct().checkpoint()
    pr = pagerank(nodes, edges)
    bt = betweenness(nodes, edges)
    dg = degrees(nodes, edges)
    out = (nodes.join(pr, "topic", "left").join(bt, "topic", "left").join(dg, "topic", "left")
           .select("topic", F.coalesce("pagerank", F.lit(0.0)).alias("pagerank"),
                   F.coalesce("betweenness", F.lit(0.0)).alias("betweenness"),
                   "degree", "weighted_degree"))
    return out, edges
