"""Connected components of a link table, as joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.store import Scratch

MAX_ROUNDS = 60


def _roots(step: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(id, to) with every chain of ``to`` followed to its end, by doubling."""
    for i in range(MAX_ROUNDS):
        jump = step.select(F.col("id").alias("to"), F.col("to").alias("further"))
        new = scratch.keep(step.join(jump, "to").select("id", F.col("to").alias("was"), F.col("further").alias("to")),
                           f"{name}_{i}")
        if not new.where("was <> to").limit(1).count():
            return new.select("id", "to")
        step = new.select("id", "to")
    raise RuntimeError("chains of labels did not settle")


def connected_components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(id, component) for every id in ``links`` (columns a, b).

    Each round every id points to its smallest neighbour (itself if smaller),
    chains are followed to their ends, and the links are contracted to links
    between those ends; a round at least halves the ids that still have links,
    and links inside a component are gone after it.  Tables are written to the
    shared folder.  An id with very many links is split by the skew join; the
    minimum is combined before the shuffle.  Empty links give an empty table.
    Raises if it does not settle.
    """
    edges = scratch.keep(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                         .distinct(), f"{name}_edges")
    labels = None
    for i in range(MAX_ROUNDS):
        both = edges.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.col("b").alias("near")),
                                              F.struct(F.col("b").alias("id"), F.col("a").alias("near")))).alias("e"))
        step = scratch.keep(both.groupBy(F.col("e.id").alias("id")).agg(F.min("e.near").alias("m"))
                            .select("id", F.least("id", "m").alias("to")), f"{name}_step{i}")
        roots = _roots(step, scratch, f"{name}_root{i}")
        if labels is None:
            labels = roots.select("id", F.col("to").alias("component"))
        else:
            moved = roots.select(F.col("id").alias("component"), "to")
            labels = scratch.keep(labels.join(moved, "component", "left")
                                  .select("id", F.coalesce("to", "component").alias("component")), f"{name}_labels{i}")
        ends = (edges.join(roots.select(F.col("id").alias("a"), F.col("to").alias("x")), "a")
                .join(roots.select(F.col("id").alias("b"), F.col("to").alias("y")), "b").where("x <> y"))
        edges = scratch.keep(ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
                             f"{name}_edges{i}")
        if not edges.limit(1).count():
            return labels
    raise RuntimeError("connected components did not settle")
