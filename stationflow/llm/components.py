"""Connected components of a link table, without bringing links together in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


class Forest:
    """Union-find over the links one task meets; only links that join two trees are kept."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        top = parent.setdefault(x, x)
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    def link(self, x: int, y: int) -> None:
        a, b = self.root(x), self.root(y)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def edges(self) -> tuple[list[int], list[int]]:
        """Every node with the smallest of its tree."""
        pairs = [(self.root(x), x) for x in list(self.parent) if self.root(x) != x]
        return [a for a, _ in pairs], [b for _, b in pairs]


def label_components(links: DataFrame) -> DataFrame:
    """(fp, root) of every node of ``links`` (columns a, b); root is the least node of its component.

    Each round hangs a node's larger neighbours, then its smaller ones, on its least neighbour, until the links are
    stars. Rounds grow with the logarithm of the number of nodes. Least neighbours come from combining aggregations,
    so a node with very many links is no hot spot, and links never grow in number.
    """
    edges = cut_lineage(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = _state(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = cut_lineage(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = _state(edges)
        if now == state:
            return edges.select(F.col("u").alias("fp"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("fp"), F.col("v").alias("root")).distinct())
        state = now


def _state(edges: DataFrame):
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]
