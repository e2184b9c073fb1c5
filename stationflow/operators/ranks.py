"""Exact ranks and quantiles per group, however large one group is.

Equal values are counted first (map-side combined), so heavily repeated values shrink to one
row. The distinct values of a group are then cut into value blocks that are ordered
independently; only block totals are ordered per group. A block with many distinct values is cut
again, evenly between its own least and largest value, so blocks stay small where values lie within a narrow range. Quantiles
sort just the blocks that hold a wanted position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

BLOCKS_PER_E_FOLD = 256
#: Distinct values of a block on average, where values are spread evenly within their first block.
BLOCK_VALUES = 4096


def value_block(v: Column, per_e_fold: int = BLOCKS_PER_E_FOLD) -> Column:
    """Block number that never decreases with the value; about 180 blocks per doubling.

    It depends on the value alone, so a rerun of a lost task cuts the same blocks.
    """
    return F.floor(F.signum(v) * F.log1p(F.abs(v) * 1000) * per_e_fold).cast("bigint")


def _counted(df: DataFrame, keys: list[str], value: str, weight: str | None) -> tuple[DataFrame, DataFrame]:
    """Distinct values with counts, and per block: rows before it, its rows, rows of the key.

    ``weight`` holds the number of rows a row of ``df`` stands for (one without it).
    """
    rows = F.col(weight) if weight else F.lit(1)
    base = df.select(*keys, F.col(value).cast("double").alias("_v"), rows.alias("_w")).where(
        "_v IS NOT NULL AND NOT isnan(_v)")
    counts = base.groupBy(*keys, "_v").agg(F.sum("_w").alias("n_equal"))
    counts = _cut(counts.withColumn("_blk", value_block(F.col("_v"))), keys)
    totals = counts.groupBy(*keys, "_blk").agg(F.sum("n_equal").alias("_n"))
    upto = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        *keys, "_blk", "_n", (F.sum("_n").over(upto) - F.col("_n")).alias("_off"),
        F.sum("_n").over(whole).alias("n_all"))
    return counts, offsets


def _cut(counts: DataFrame, keys: list[str]) -> DataFrame:
    """``_blk`` as (first block, piece): a first block of n distinct values has about n / BLOCK_VALUES pieces."""
    sizes = counts.groupBy(*keys, "_blk").agg(
        F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.ceil(F.count(F.lit(1)) / BLOCK_VALUES).alias("_k")).where("_k > 1")
    # subtracting, dividing and multiplying never turn the order of two doubles round, so pieces follow the values
    piece = F.least(F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * F.col("_k")), F.col("_k") - 1)
    return counts.join(sizes, [*keys, "_blk"], "left").withColumn(
        "_blk", F.struct("_blk", F.coalesce(piece, F.lit(0)).alias("piece"))).drop("_lo", "_hi", "_k")


def _ranked(counts: DataFrame, offsets: DataFrame, keys: list[str], value: str) -> DataFrame:
    inside = Window.partitionBy(*keys, "_blk").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    out = counts.join(offsets, [*keys, "_blk"]).withColumn(
        "n_upto", F.sum("n_equal").over(inside) + F.col("_off"))
    return out.select(*keys, F.col("_v").alias(value), "n_equal", "n_upto", "n_all")


def _keyed(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Without keys the whole table is one group, named by a constant."""
    return (df, list(keys)) if keys else (df.withColumn("_all", F.lit(0)), ["_all"])


def value_counts(df: DataFrame, keys: Sequence[str], value: str, weight: str | None = None) -> DataFrame:
    """Distinct values per key with ``n_equal``, ``n_upto`` (rows <= value) and ``n_all``."""
    df, full = _keyed(df, keys)
    counts, offsets = _counted(df, full, value, weight)
    return _ranked(counts, offsets, full, value).drop("_all")


def average_rank() -> Column:
    """Rank with ties averaged, on the output of :func:`value_counts`."""
    return F.col("n_upto") - (F.col("n_equal") - 1) / F.lit(2.0)


def percent_rank() -> Column:
    """(rank - 1) / (rows - 1) with the lowest rank for ties; 0 for a single row."""
    below = F.col("n_upto") - F.col("n_equal")
    return F.coalesce(below / F.nullif(F.col("n_all") - 1, F.lit(0)), F.lit(0.0))


def quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float],
              weight: str | None = None) -> DataFrame:
    """Exact linearly interpolated quantiles, one output column per entry of ``probs``."""
    df, full = _keyed(df, keys)
    counts, offsets = _counted(df, full, value, weight)

    def spots(p: float) -> tuple[Column, Column]:
        pos = (F.col("n_all") - 1) * F.lit(float(p))
        return F.floor(pos), F.ceil(pos)

    wanted = F.lit(False)
    for p in probs.values():
        for at in spots(p):
            wanted = wanted | ((F.col("_off") <= at) & (at < F.col("_off") + F.col("_n")))
    ranked = _ranked(counts, offsets.where(wanted), full, value)
    below = F.col("n_upto") - F.col("n_equal")
    aggs = []
    for name, p in probs.items():
        for side, at in zip(("lo", "hi"), spots(p)):
            hit = (below <= at) & (at < F.col("n_upto"))
            aggs.append(F.max(F.when(hit, F.col(value))).alias(f"_{side}_{name}"))
    out = ranked.groupBy(*full).agg(F.max("n_all").alias("n_all"), *aggs)
    cols = []
    for name, p in probs.items():
        pos = (F.col("n_all") - 1) * F.lit(float(p))
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        cols.append((lo + (hi - lo) * (pos - F.floor(pos))).alias(name))
    return out.select(*keys, *cols, F.col("n_all").alias("n"))


def median(df: DataFrame, keys: Sequence[str], value: str, name: str = "median",
           weight: str | None = None) -> DataFrame:
    return quantiles(df, keys, value, {name: 0.5}, weight).drop("n")


def column_medians(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Median of every column in one pass, as rows ``(keys..., feature, median)``."""
    long = df.select(*keys, *[F.col(c).cast("double") for c in columns]).unpivot(
        list(keys), list(columns), "feature", "value")
    return median(long, [*keys, "feature"], "value")


def series_medians(df: DataFrame, site: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Median of every column per site of an hourly series, as ``<column>_median``.

    For series only: a site holds at most one row per hour (8784 a year), so the built-in
    aggregate keeps a bounded buffer per site whatever the raw data volume was.
    """
    return df.groupBy(*site).agg(*[F.median(c).alias(f"{c}_median") for c in columns])
