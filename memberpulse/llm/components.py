"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from memberpulse.llm.common import Workspace


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) of the given edges; roots are left out.

    At most one edge per node, so a dense group of links leaves a task as a star.
    """
    nodes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = inverse[: len(a)], inverse[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    child = label != np.arange(len(nodes))
    return nodes[child], nodes[label[child]]


#: A node with more than this share of all links, and more than so many, is a hub.
HUB_SHARE, LEAST_HUB = 10_000, 256


def _with_least(edges: DataFrame, low: DataFrame, links: int) -> DataFrame:
    """``edges(a, b)`` with ``m`` of ``low(a, m, n)``; ``n`` is the node's number of links, ``links`` that of all.

    A hub's links are dealt to as many tasks as it has shares, each with a copy of its row.
    At most 2 * HUB_SHARE nodes are hubs, whatever the number of links, so their list is broadcast.
    """
    hub = max(LEAST_HUB, links // HUB_SHARE)
    parts = F.when(F.col("n") > hub, F.ceil(F.col("n") / hub)).otherwise(1).cast("int")
    hubs = F.broadcast(low.where(F.col("n") > hub).select("a", parts.alias("parts")))
    dealt = edges.join(hubs, "a", "left").select("a", "b", F.coalesce(
        F.pmod(F.xxhash64("b"), F.col("parts")), F.lit(0)).cast("int").alias("part"))
    copies = low.select("a", "m", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    return dealt.join(copies, ["a", "part"]).select("a", "b", "m")


def connected_components(edges: DataFrame, ws: Workspace, prefix: str = "cc") -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``: component = the smallest node reachable.

    Both star steps are a grouped minimum (combined map-side) and a join back on the same
    key, in which a hub's links are dealt to several tasks by their measured number; no
    group is ever collected.  Every round is a staged table; the previous one is
    dropped.  NULL ends and self loops are ignored.  No edges: an empty table.
    """
    current = ws.stage(f"{prefix}_0", edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    signature, step = _signature(current), 0
    while signature[0]:
        both = current.union(current.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).select("a", F.least("a", "m").alias("m"), "n")
        large = (_with_least(both.where("b > a"), low, signature[0]).select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        small = _with_least(large, low, signature[0]).select(F.explode(F.array(
            F.struct(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")),
            F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").where("a <> b").distinct()
        step += 1
        following = ws.stage(f"{prefix}_{step}", small)
        ws.drop(f"{prefix}_{step - 1}")
        current, before, signature = following, signature, _signature(following)
        if signature == before:
            break
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        current.select("b", "b").distinct())


def _signature(edges: DataFrame) -> tuple:
    """Edge count and an order-free checksum: equal signatures mean that a round changed nothing."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")),
                    F.sum(F.xxhash64("b", "a").cast("decimal(20,0)"))).first()
    return tuple(row)
