"""Connected components of an edge table: of few edges in one task, else by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, new_path, staged


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (a, b) with a > b: nodes are tied to the least node around them.

    The large step looks at both directions and moves the larger neighbours; the small step looks
    from each node at its smaller neighbours and moves those and the node itself. Only minima are
    gathered per node, so a hub's edges are reduced before the shuffle.
    """
    if large:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        moved = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        joined = edges.join(least, "a")
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(joined.select("a", F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


#: Edges that a file of a round's table holds at least, where there are as many.
FILE_EDGES = 200_000
#: Edges that one task takes: about 100 MB there. Star rounds over so few would be thousands of tasks without work.
TASK_EDGES = 1_000_000


def least_reachable(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, the least node that each reaches) of edges: roots are hung below the least root beside them until each edge has one."""
    nodes, places = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = places[: len(a)], places[len(a) :]
    root = np.arange(len(nodes))
    while True:
        high, low = np.maximum(root[x], root[y]), np.minimum(root[x], root[y])
        apart = high != low
        if not apart.any():
            return nodes, nodes[root]
        x, y = x[apart], y[apart]
        np.minimum.at(root, high[apart], low[apart])
        while not np.array_equal(root, up := root[root]):
            root = up


def _in_one_task(edges: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = [(x.column(0).to_numpy(), x.column(1).to_numpy()) for x in batches]
        if whole:
            nodes, least = least_reachable(*map(np.concatenate, zip(*whole, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(least)], ["node", "component"])

    return edges.coalesce(1).mapInArrow(run, "node long, component long")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of edges (a, b): component is the least node reachable.

    Self loops and repeated edges count for nothing. Edges are written to the shared folder, which ends their
    lineage; up to TASK_EDGES of them are then read by one task. Of more, each star round's edges are written
    and those of the round before are deleted; only their number and a hash sum come to the driver. Rounds grow
    as the logarithm of the longest path.
    """
    spark = edges.sparkSession
    place = new_path(spark, "edges")
    now = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges", place)
    state, n = None, now.count()
    if n <= TASK_EDGES:
        return _in_one_task(now)
    while True:
        before, place = place, new_path(spark, "edges")
        now = staged(_stars(_stars(now, large=True), large=False).coalesce(1 + n // FILE_EDGES), "edges", place)
        discard(spark, before)
        new = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if new == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select("b", "b").toDF("node", "component")).distinct()
        state, n = new, new[0]
