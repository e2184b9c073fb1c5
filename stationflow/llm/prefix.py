"""Running sums over a whole table in one order, without one task that sees the whole table or a whole group."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Rows of a part on average; the session's number of shuffle partitions is the least number of parts.
PART_ROWS = 500_000


def cut_by_range(df: DataFrame, by: Sequence[str], name: str, part_rows: int = PART_ROWS) -> DataFrame:
    """``df`` range-sorted into parts by the columns ``by``, written, with the part's number as ``__part``. Parts follow each other in that order.

    ``df`` is read three times (rows, range bounds, parts), so it should be a written table.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, math.ceil(df.count() / part_rows))
    return cut_lineage(df.repartitionByRange(parts, *by).withColumn("__part", F.spark_partition_id()), name)


def part_ends(ranged: DataFrame, group: Column) -> DataFrame:
    """(__part, __first, __last) group of every part: one row per part."""
    return ranged.groupBy("__part").agg(F.min(group).alias("__first"), F.max(group).alias("__last"))


def running(df: DataFrame, order: Sequence[str], sums: dict[str, Column], group: Sequence[str] = (), name: str = "running", part_rows: int = PART_ROWS) -> DataFrame:
    """``df`` with, for each entry of ``sums``, its sum over the rows of the same group up to and with this one in ``order`` (nulls first).

    Parts are summed on their own; only the first group of a part can have begun earlier, so what is carried over is one row per part.
    Rows equal in group and order have to be interchangeable. Sums are whole numbers; a null counts as nothing.
    """
    add = {f"__s{i}": F.coalesce(c, F.lit(0)).cast("bigint") for i, c in enumerate(sums.values())}
    ranged = cut_by_range(df.withColumns(add), [*group, *order], name, part_rows)
    key = F.struct(*group) if group else F.struct(F.lit(0).alias("all"))
    ranged = ranged.withColumn("__g", key)
    ends = part_ends(ranged, F.col("__g"))
    edges = ranged.join(F.broadcast(ends), "__part").where("__g <=> __last").groupBy("__part").agg(
        F.first("__first").alias("first"), F.first("__last").alias("last"), *[F.sum(s).alias(s) for s in add])
    carried, last, carry = [], None, [0] * len(add)
    for row in sorted(edges.collect(), key=lambda r: r["__part"]):  # one row per part
        goes_on = last is not None and row["first"] == last
        before = carry if goes_on else [0] * len(add)
        carried.append((row["__part"], *before))
        carry = [row[s] + (b if row["first"] == row["last"] else 0) for s, b in zip(add, before)]
        last = row["last"]
    schema = ", ".join(["__part INT", *[f"__b{i} BIGINT" for i in range(len(add))]])
    offsets = ends.join(F.broadcast(df.sparkSession.createDataFrame(carried, schema)), "__part").drop("__last")
    upto = Window.partitionBy("__part", "__g").orderBy(*[F.col(c) if isinstance(c, str) else c for c in order]).rowsBetween(Window.unboundedPreceding, 0)
    out = ranged.join(F.broadcast(offsets), "__part")
    for i, column in enumerate(sums):
        begun = F.when(F.col("__g").eqNullSafe(F.col("__first")), F.col(f"__b{i}")).otherwise(F.lit(0))
        out = out.withColumn(column, F.sum(f"__s{i}").over(upto) + begun)
    return out.drop("__part", "__g", "__first", *add, *[f"__b{i}" for i in range(len(add))])
