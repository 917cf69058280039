"""Connected components of a graph of any size, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, map_arrow

#: Edges that a task contracts together.
HELD = 1 << 20


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) of these edges alone, for nodes that are not the least."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(nodes))
    while True:
        least, new = np.minimum(label[a], label[b]), label.copy()
        for side in (a, b, label[a], label[b]):
            np.minimum.at(new, side, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def _contracted(batches):
    """Each task's edges as stars: no more than its nodes, and no longer chains than tasks make together."""
    held, size = [], 0
    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        size += batch.num_rows
        if size > HELD:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in stars(*map(np.concatenate, zip(*held, strict=True)))], ["u", "v"])
            held, size = [], 0
    if size:
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in stars(*map(np.concatenate, zip(*held, strict=True)))], ["u", "v"])


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first())


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the edges (u, v); root is the component's least node.

    Each round points every node's larger neighbours, then its smaller ones, to
    the least node it knows; a round is a few shuffles of the edges, cut by a
    checkpoint, and their number grows with the logarithm of the graph. Loops,
    repeated edges and either direction do no harm; nulls are left out; no edges, no rows.
    """
    now = map_arrow(edges.where("u <> v").select(F.col("u").cast("long"), F.col("v").cast("long")), _contracted, "u long, v long").distinct()
    now, before = cut(now), None
    mark = _mark(now)
    for _ in range(rounds):
        if mark == before:
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = cut(small.unionByName(least.select("u", F.col("m").alias("v"))).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        before, mark = mark, _mark(now)
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
