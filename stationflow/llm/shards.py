"""Sharding by a hierarchical weighted hash tree: region, then rack, then shard, each by weighted hash draws.

At a node, every child draws ``-ln(u) / weight`` with ``u`` hashed from the row's key and the child's name; the
smallest draw wins. So a child gets rows in proportion to its weight, and changing one child's weight moves rows only between it and its
siblings. A shard added after the first layout is a region of its own: it takes rows only into itself.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hexadecimal digits of an MD5 that make a draw: 52 bits, exact in a double.
DIGITS = 13
RANGE = float(1 << 4 * DIGITS)
#: Rows of a block that one task numbers, and copies of one row that one task writes.
BLOCK_ROWS = 50_000


@dataclass(frozen=True)
class Tree:
    """Weights of shards by (region, rack, shard); a node weighs what its shards weigh together."""
    weights: tuple[tuple[tuple[str, str, int], float], ...]

    @classmethod
    def of(cls, shards: int, base: int = 40, racks: int = 2, per_rack: int = 4) -> Tree:
        """The first ``base`` shards fill racks and regions in turn; every later one opens a region of its own."""
        out = []
        for s in range(shards):
            region = str(s // (racks * per_rack)) if s < base else f"x{s}"
            rack = str(s // per_rack % racks) if s < base else "0"
            out.append(((region, rack, s), 1.0))
        return cls(tuple(out))

    def children(self) -> dict[str, list[tuple[str, float]]]:
        """Children of every node, by name, with their weights. Names are paths; the root's is empty."""
        out: dict[str, dict[str, float]] = {}
        for path, weight in self.weights:
            for depth in range(3):
                below = out.setdefault("/".join(map(str, path[:depth])), {})
                child = "/".join(map(str, path[:depth + 1]))
                below[child] = below.get(child, 0.0) + weight
        return {node: list(below.items()) for node, below in out.items()}


def hashed(key: Column, name: Column) -> Column:
    """A whole number below 2^52 from a key and a name."""
    return F.conv(F.substring(F.md5(F.concat(key, F.lit(":"), name)), 1, DIGITS), 16, 10).cast("bigint")


def draw(key: Column, name: Column, weight: Column) -> Column:
    return -F.ln((hashed(key, name) + 0.5) / RANGE) / weight


def with_shard(rows: DataFrame, key: str, tree: Tree, out: str) -> DataFrame:
    """``rows`` with the shard of the string column ``key``, by descent through the three levels; each is one lookup and one draw per child."""
    nodes = tree.children()
    table = F.create_map(*[x for node, below in nodes.items() for x in (
        F.lit(node), F.array(*[F.struct(F.lit(n).alias("name"), F.lit(w).alias("weight")) for n, w in below]))])
    rows = rows.withColumn(out, F.lit(""))
    for _ in range(3):
        draws = F.transform(F.element_at(table, F.col(out)), lambda c: F.struct(draw(F.col(key), c["name"], c["weight"]).alias("d"), c["name"].alias("name")))
        rows = rows.withColumn(out, F.array_min(draws)["name"])
    return rows.withColumn(out, F.substring_index(out, "/", -1).cast("int"))


def assign(docs: DataFrame, shards: int = 40, base: int = 40, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row; law ``key``.

    The id and the number of shards decide; a null id is a key like any other. ``size`` is the text's UTF-8 bytes plus 16, a null text counts as
    empty. Slots number the rows of a shard from 0, in the order of a hash of id, size and checksum, so that the rows of one id spread over the
    blocks that number them. Equal rows are counted before the shuffle and written out again at the end, so neither an id with very many
    texts nor a row with very many copies is a hot spot.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    slim = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), (F.octet_length(body) + 16).cast("bigint").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"))
    rows = slim.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("m"))
    rows = rows.withColumn("key", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    placed = with_shard(with_shard(rows, "key", Tree.of(shards, base), "shard"), "key", Tree.of(shards + 1, base), "grown_shard")
    placed = placed.withColumn("h", hashed(F.concat_ws(":", "key", "size", "text_crc32"), F.lit("slot")))
    n_blocks = max(1, math.ceil(docs.count() / (shards * BLOCK_ROWS) * 2))
    placed = placed.withColumn("block", F.floor(F.col("h") / RANGE * n_blocks).cast("int"))
    offsets = slot_offsets(placed.groupBy("shard", "block").agg(F.sum("m").alias("m")))
    numbered = placed.withColumn("before", F.expr("sum(m) OVER (PARTITION BY shard, block ORDER BY h, doc_id NULLS FIRST, size, text_crc32 ROWS UNBOUNDED PRECEDING) - m"))
    numbered = numbered.join(offsets, ["shard", "block"]).withColumn("first", F.col("before") + F.col("offset"))
    numbered = numbered.select("doc_id", "size", "text_crc32", "shard", "grown_shard", "first", "m")
    few = numbered.where(F.col("m") <= BLOCK_ROWS).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    many = numbered.where(F.col("m") > BLOCK_ROWS).withColumn("part", F.explode(F.sequence(F.lit(0), F.floor((F.col("m") - 1) / BLOCK_ROWS))))
    many = many.repartition("doc_id", "size", "text_crc32", "part").withColumn(
        "k", F.explode(F.sequence(F.col("part") * BLOCK_ROWS, F.least(F.col("m"), (F.col("part") + 1) * BLOCK_ROWS) - 1)))
    return few.unionByName(many.drop("part")).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("first") + F.col("k")).cast("bigint").alias("slot"), "grown_shard")


def slot_offsets(counts: DataFrame) -> DataFrame:
    """Rows of the shard in earlier blocks; a shard has one row per block here."""
    return counts.select("shard", "block", F.expr("sum(m) OVER (PARTITION BY shard ORDER BY block ROWS UNBOUNDED PRECEDING) - m").alias("offset"))
