"""Outlier filters per site. Statistics are combining aggregates joined back, not windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from . import ranks


def _with_stats(df: DataFrame, site: Sequence[str], value: str, std) -> DataFrame:
    stats = df.groupBy(*site).agg(F.avg(value).alias("_mean"), std(value).alias("_std"))
    if site:
        return df.join(stats, list(site))
    return df.withColumns({c: stats.select(c).scalar() for c in ("_mean", "_std")})


def within_sigma(df: DataFrame, site: Sequence[str], value: str, k: float) -> DataFrame:
    """Keep mean +- k sample standard deviations. ``site`` may be empty (one pool)."""
    out = _with_stats(df, site, value, F.stddev_samp)
    low, high = F.col("_mean") - k * F.col("_std"), F.col("_mean") + k * F.col("_std")
    return out.where(F.col(value).between(low, high)).drop("_mean", "_std")


def below_zscore(df: DataFrame, site: Sequence[str], value: str, limit: float = 3.0) -> DataFrame:
    """Drop rows whose |z| (population standard deviation) exceeds ``limit``.

    A constant series has no z-score and loses no rows.
    """
    out = _with_stats(df, site, value, F.stddev_pop)
    z = F.abs((F.col(value) - F.col("_mean")) / F.nullif(F.col("_std"), F.lit(0.0)))
    return out.where(F.coalesce(z <= limit, F.lit(True))).drop("_mean", "_std")


def normalise(df: DataFrame, site: Sequence[str], value: str, name: str) -> DataFrame:
    """(x - mean) / sample standard deviation."""
    out = _with_stats(df, site, value, F.stddev_samp)
    z = (F.col(value) - F.col("_mean")) / F.nullif(F.col("_std"), F.lit(0.0))
    return out.withColumn(name, z).drop("_mean", "_std")


def _deviations(df: DataFrame, site: Sequence[str], value: str) -> tuple[DataFrame, DataFrame]:
    """Median per site, and distances from it as distinct ``(site, _dev)`` with their row counts ``_w``.

    Both come from the distinct values of a site with their counts, so no full row is shuffled for them.
    """
    counts = df.select(*site, F.col(value).alias("_v")).where("_v IS NOT NULL AND NOT isnan(_v)").groupBy(
        *site, "_v").agg(F.count(F.lit(1)).alias("_w"))
    centre = ranks.median(counts, site, "_v", "_med", weight="_w")
    devs = counts.join(centre, list(site)).select(*site, F.abs(F.col("_v") - F.col("_med")).alias("_dev"), "_w")
    return centre, devs


def robust_score(df: DataFrame, site: Sequence[str], value: str, name: str = "score") -> DataFrame:
    """|x - median| / median absolute deviation per site, with exact medians."""
    centre, devs = _deviations(df, site, value)
    spread = ranks.median(devs, site, "_dev", "_mad", weight="_w")
    out = df.join(centre.join(spread, list(site)), list(site))
    dev = F.abs(F.col(value) - F.col("_med"))
    flat = F.when(dev > 0, F.lit(float("inf"))).otherwise(F.lit(0.0))
    return out.withColumn(name, F.coalesce(dev / F.nullif(F.col("_mad"), F.lit(0.0)), flat)).drop("_med", "_mad")


def drop_most_isolated(df: DataFrame, site: Sequence[str], value: str, contamination: float = 0.02,
                       min_rows: int = 50) -> DataFrame:
    """Drop the most isolated share of values per site; sites below ``min_rows`` stay whole.

    Isolation is distance from the median (scaling it by the median absolute deviation would not change the
    order inside a site). The largest distance that stays is one number per site, so the rows
    themselves are only joined with one limit per site.
    """
    centre, devs = _deviations(df, site, value)
    ranked = ranks.value_counts(devs, site, "_dev", weight="_w")
    limits = ranked.groupBy(*site).agg(
        F.max(F.when(ranks.percent_rank() <= 1 - contamination, F.col("_dev"))).alias("_limit"),
        F.max("n_all").alias("_n")).join(centre, list(site))
    out = df.join(limits, list(site), "left")
    keep = (F.col("_n") < min_rows) | (F.abs(F.col(value) - F.col("_med")) <= F.col("_limit")) | F.col(value).isNull()
    return out.where(keep).select(*df.columns)
