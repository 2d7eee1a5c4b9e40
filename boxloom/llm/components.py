"""Connected components by alternating large-star and small-star steps over edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.llm.common import store


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node of `edges` (a, b: long).

    Each step hands a node's neighbours its smallest neighbour, found by partial aggregation. The smallest
    neighbours are stored before they are joined, so the join has two plain shuffles and a node with very many
    neighbours can be split at run time. Every round is a table in the shared folder.
    """
    here = store(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        size = here.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if size == before or size[0] == 0:
            break
        before = size
        both = here.unionByName(here.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = store(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), "smallest")
        large = store(both.where("b > a").join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large")
        smallest = store(large.groupBy("a").agg(F.min("b").alias("m")), "smallest")
        small = large.join(smallest, "a").where("b <> m").select("b", "m").toDF("a", "b")
        here = store(small.unionByName(smallest.toDF("a", "b")).distinct(), "edges")
    return here.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        here.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


class Forest:
    """Union-find inside one task."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while x != root:
            parent[x], x = root, parent.get(x, x)
        return root

    def union(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            low, high = (x, y) if x < y else (y, x)
            self.parent[high] = low

    def edges(self) -> tuple[list[int], list[int]]:
        """A star per component: node, root."""
        nodes = list(self.parent)
        pairs = [(x, r) for x in nodes if (r := self.find(x)) != x]
        return [x for x, _ in pairs], [r for _, r in pairs]
