"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import Scratch

STEPS = 60  # far above the logarithmic number that any graph needs


def _star(edges: DataFrame, near: DataFrame) -> DataFrame:
    """Edges (node, neighbour) with the least of the node and its neighbours beside each."""
    least = near.groupBy("node").agg(F.min("next").alias("least"))
    least = least.select("node", F.least("least", "node").alias("least"))
    return edges.join(least, "node")


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b): the least node reachable.

    Each step writes its edges to the shared folder and the next reads them. A step moves
    every edge twice and aggregates before it shuffles; a hub's edges are the probe side of a
    join with one row a node. Null ends and loops connect nothing.
    """
    pairs = edges.selectExpr("a AS node", "b AS next").where("node <> next")
    nodes = edges.selectExpr("a AS node").union(edges.selectExpr("b AS node")).where("node IS NOT NULL").distinct()
    current = scratch.save(
        pairs.select(F.greatest("node", "next").alias("node"), F.least("node", "next").alias("next")).distinct(), "edges-0"
    )
    state = None
    for step in range(1, STEPS + 1):
        both = current.unionByName(current.selectExpr("next AS node", "node AS next"))
        large = _star(both, both).where("next > node").selectExpr("next AS node", "least AS next")
        large = scratch.save(large.where("node <> next").distinct(), f"large-{step}")
        small = _star(large, large)
        out = small.selectExpr("next AS node", "least AS next").union(small.selectExpr("node", "least AS next"))
        current = scratch.save(out.where("node <> next").distinct(), f"edges-{step}")
        counted = current.agg(F.count("*"), F.sum(F.xxhash64("node", "next").cast("decimal(38,0)"))).first()
        scratch.drop(f"large-{step}"), scratch.drop(f"edges-{step - 1}")
        if counted == state:
            break
        state = counted
    else:
        raise RuntimeError("the components did not settle")
    roots = current.groupBy("node").agg(F.min("next").alias("component"))
    return nodes.join(roots, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
