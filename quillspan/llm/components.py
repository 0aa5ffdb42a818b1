"""Connected components of a large undirected graph, by alternating large-star and small-star steps.

Each step sends every edge to a smaller neighbour and keeps the graph's connectivity; the steps converge in a logarithmic
number of rounds to one star per component. A node of very many neighbours is handled by joining the edges with the
node's minimum, not by gathering its neighbours in one place. Every round is a written table, so a lost executor costs
one round at most.

Up to ``ONE_TASK`` edges are joined by one task instead: rounds of small queries take little time and much of the driver's memory
(plans, broadcast tables, compiled code), whatever the number of edges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, small_batches

MAX_ROUNDS = 60
#: Edges that one task joins; more go by rounds.
ONE_TASK = 1 << 17
#: Rows in one file of a round's table: a round on few edges writes few files.
FILE_ROWS = 500_000


class Forest:
    """Union-find over local indices; the root of a tree is its smallest index."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root) of the edges of one task."""
    held = [np.array([c.to_numpy(zero_copy_only=False) for c in batch.columns]) for batch in batches if batch.num_rows]
    if held:
        nodes, ends = np.unique(np.concatenate(held, axis=1), return_inverse=True)
        forest = Forest(len(nodes))
        for u, v in ends.reshape(2, -1).T.tolist():
            forest.join(u, v)
        roots = np.array([forest.find(x) for x in range(len(nodes))])
        low = roots != np.arange(len(nodes))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[low]), pa.array(nodes[roots[low]])], ["node", "root"])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.union(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, files: int = 1) -> DataFrame:
    """(node, root) of every node of ``edges`` (u, v: long) that isn't itself the smallest of its component.

    No edges give no rows; loops and repeated edges don't matter. Null ends are dropped. ``files``: of the first table.
    """
    now = materialise(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().coalesce(files), "edges")
    if now.count() <= ONE_TASK:
        small_batches(now.sparkSession)
        return materialise(now.coalesce(1).mapInArrow(_joined, "node long, root long"), "stars")
    before = None
    for _ in range(MAX_ROUNDS):
        now = materialise(_small_star(_large_star(now)).coalesce(files), "stars")
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before, files = state, 1 + state.n // FILE_ROWS
    raise RuntimeError("components did not converge")
