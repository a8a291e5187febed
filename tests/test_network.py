"""Topic network against brute force: nearest topics, shortest paths, betweenness."""

import heapq
import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import network as N


def _weights(rows):
    """{topic: {term: weight}} normalised like X2."""
    norm = defaultdict(float)
    for t, _, w in rows:
        norm[t] += w * w
    return [(t, term, w / math.sqrt(norm[t])) for t, term, w in rows]


def _top(rows, k):
    vec = defaultdict(dict)
    for t, term, w in rows:
        vec[t][term] = w
    out = set()
    for a in vec:
        sims = [(-sum(w * vec[b].get(term, 0.0) for term, w in vec[a].items()), b) for b in vec if b != a]
        out |= {(a, b, round(-s, 9)) for s, b in sorted(sims)[:k] if s < 0}
    return out


@pytest.mark.parametrize("seed", range(4))
def test_nearest_topics_equal_all_pairs(spark, seed):
    r = random.Random(seed)
    rows = []
    for t in range(60):
        for term in {int(r.paretovariate(0.7)) % 80 for _ in range(r.randint(1, 25))}:
            rows.append((f"t{t:03d}", f"w{term}", r.random() + 0.1))
    rows += [("alone", "nobody else", 1.0), ("pair1", "shared", 1.0), ("pair2", "shared", 1.0)]
    rows = _weights(rows)
    df = spark.createDataFrame(rows, "topic string, term string, weight double")
    got = {(x.src, x.dst, round(x.similarity, 9)) for x in N.nearest_topics(df, 2).collect()}
    assert got == _top(rows, 2)
    edges = {(e.source_topic, e.target_topic, round(e.weight, 9)) for e in N.topic_edges(df).collect()}
    full = {(e.source_topic, e.target_topic, round(e.weight, 9)) for e in N.similarity_edges(N.topic_similarity(df)).collect()}
    assert edges == full


def test_nearest_topics_scores_few_pairs(spark):
    """20,000 topics in which a few terms are everywhere: all pairs would be 2e8."""
    n = 20_000
    t = spark.range(n)
    common = t.select(F.col("id"), F.explode(F.array([F.lit(f"all{i}") for i in range(4)])).alias("term"), F.lit(0.02).alias("w"))
    own = t.select("id", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("j")).select(
        "id", F.concat(F.lit("g"), F.floor(F.col("id") / 5).cast("string"), F.lit("_"), F.col("j").cast("string")).alias("term"),
        (F.lit(0.2) + F.pmod(F.xxhash64("id", "j"), F.lit(100)) / 200.0).alias("w"))
    rows = common.unionByName(own).select(F.format_string("t%05d", "id").alias("topic"), "term", "w").checkpoint()
    norm = rows.groupBy("topic").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("n"))
    tfidf = rows.join(norm, "topic").select("topic", "term", (F.col("w") / F.col("n")).alias("weight"))
    seen = []
    plain = N._score_pairs

    def counted(pairs, index):
        kept = pairs.checkpoint()
        seen.append(kept.count())
        return plain(kept, index)
    N._score_pairs = counted
    try:
        top = N.nearest_topics(tfidf, 2).checkpoint()
    finally:
        N._score_pairs = plain
    assert top.count() == 2 * n and sum(seen) < 100 * n < n * n / 100
    same = F.floor(F.substring("src", 2, 5).cast("int") / 5) == F.floor(F.substring("dst", 2, 5).cast("int") / 5)
    assert top.where(~same).count() == 0


def _brandes(nodes, links):
    """Plain Brandes over a dictionary graph."""
    score = dict.fromkeys(nodes, 0.0)
    for s in nodes:
        far, done, heap, order = {s: 0.0}, set(), [(0.0, s)], []
        while heap:
            d, v = heapq.heappop(heap)
            if v in done:
                continue
            done.add(v)
            order.append(v)
            for u, w in links[v].items():
                if d + w < far.get(u, math.inf):
                    far[u] = d + w
                    heapq.heappush(heap, (d + w, u))
        before = {v: [u for u in links[v] if u in far and far[u] + links[u][v] == far[v]] for v in order}
        paths = {s: 1.0}
        for v in order[1:]:
            paths[v] = sum(paths[u] for u in before[v])
        share = dict.fromkeys(order, 0.0)
        for v in reversed(order[1:]):
            for u in before[v]:
                share[u] += paths[u] / paths[v] * (1 + share[v])
        for v in order[1:]:
            score[v] += share[v]
    n = len(nodes)
    return {v: x / ((n - 1) * (n - 2)) if n > 2 else 0.0 for v, x in score.items()}


@pytest.mark.parametrize("seed,block,task_edges", [(1, 2_000, 0), (2, 7, 0), (3, 2_000, 500)])
def test_betweenness_equals_brandes(spark, seed, block, task_edges):
    r = random.Random(seed)
    nodes = [f"n{i}" for i in range(24)]
    links = defaultdict(dict)
    for _ in range(40):
        a, b = r.sample(nodes[:-2], 2)      # the last two stay alone
        links[a][b] = links[b][a] = r.choice([0.25, 0.5, 0.75, 1.0])   # many ties, exact sums
    chain = nodes[:10]                      # a long path: more rounds than one job plans
    for a, b in zip(chain, chain[1:]):
        links[a][b] = links[b][a] = 0.125
    edges = spark.createDataFrame([(a, b, w) for a in links for b, w in links[a].items() if a < b],
                                  "source_topic string, target_topic string, weight double")
    out = N.betweenness(spark.createDataFrame([(v,) for v in nodes], "topic string"), edges,
                        source_block=block, task_edges=task_edges)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert ("Pandas" in plan) == (task_edges > 0)
    got = {x.topic: x.betweenness for x in out.collect()}
    assert got == pytest.approx(_brandes(nodes, links))


def test_no_edges_and_no_nodes(spark):
    edges = spark.createDataFrame([], "source_topic string, target_topic string, weight double")
    nodes = spark.createDataFrame([("a",), ("b",)], "topic string")
    for task_edges in (0, 10):   # a table without rows is below any bound, one edge is above 0
        assert {x.topic: x.betweenness for x in N.betweenness(nodes, edges, task_edges=task_edges).collect()} == {"a": 0.0, "b": 0.0}
        assert N.betweenness(nodes.limit(0), edges, task_edges=task_edges).collect() == []
    empty = spark.createDataFrame([], "topic string, term string, weight double")
    assert N.nearest_topics(empty).collect() == []
