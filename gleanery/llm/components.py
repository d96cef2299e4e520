"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import Scratch, mapped


FEW = 1 << 16  # edges that a task joins at a time


class Forest:
    """Union-find over few nodes; the smallest node is the root."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, node: int) -> int:
        root = node
        while (up := self.parent.get(root, root)) != root:
            root = up
        while (up := self.parent.get(node, node)) != root:
            self.parent[node] = root
            node = up
        return root

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def _forests(batches) -> Iterator[Forest]:
    """The edges of a task, joined until a forest has about FEW."""
    forest = Forest()
    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            forest.join(u, v)
        if len(forest.parent) >= FEW:
            yield forest
            forest = Forest()
    yield forest


def _rows(nodes: list[int], forest: Forest, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.array(nodes, np.int64)), pa.array(np.array([forest.find(n) for n in nodes], np.int64))], names=names)


def _contract(batches):
    """Edges as stars around the smallest node that those of a forest connect to."""
    for forest in _forests(batches):
        yield _rows(list(forest.parent), forest, ["u", "v"])


def _labelled(batches):
    """Nodes of fewer than FEW edges, all in one forest, with their smallest node."""
    for forest in _forests(batches):
        children = list(forest.parent)
        yield _rows(children + list({forest.find(n) for n in children}), forest, ["node", "component"])


def _checked(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")).first()
    return row["n"], row["s"]


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) of all nodes that edges (a, b) touch; the component is its
    smallest node. Edges are first contracted task by task, which turns most components
    into stars. If fewer than FEW are left, one more task does the rest. Else every round joins edges with the smallest neighbour of a node, which is
    combined before the shuffle, and contracts again. Minima go to a table before they
    are joined, so that a node with very many edges can be split by a skewed join. Rounds
    grow with the logarithm of the longest chain."""
    proper = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
    now = scratch.keep(mapped(proper, _contract, "u bigint, v bigint").where("u <> v"))
    state = _checked(now)
    while state[0]:
        if state[0] < FEW:
            return scratch.keep(mapped(now.coalesce(1), _labelled, "node bigint, component bigint"))
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = scratch.keep(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        # both ends of an edge take the smaller of their minima
        met = now.join(least.withColumnRenamed("m", "mu"), "u").join(least.select(F.col("u").alias("v"), F.col("m").alias("mv")), "v")
        low = F.least("mu", "mv")
        pairs = F.array(*[F.struct(end.alias("u"), low.alias("v")) for end in (F.col("u"), F.col("v"), F.col("mu"), F.col("mv"))])
        stars = met.select(F.explode(pairs).alias("p")).select("p.*").where("u <> v")
        after = scratch.keep(mapped(stars, _contract, "u bigint, v bigint").where("u <> v").distinct())
        scratch.drop(now, least)
        now, before, state = after, state, _checked(after)
        if state == before:
            break
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
