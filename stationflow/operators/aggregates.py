"""Grouped summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import units
from . import ranks


def count_and_mean(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(value).alias("n"), F.avg(value).alias("mean"))


def filter_sites(df: DataFrame, site: str, unit: str, value: str, min_obs: int = 72,
                 min_value: float = 15.0, species: str = "no2") -> DataFrame:
    """Sites with more than ``min_obs`` rows in a unit and a mean of at least ``min_value`` ppb.

    Means are taken per site and unit over all rows of sites that pass the count, then converted.
    """
    stats = count_and_mean(df, [site, unit], value)
    busy = stats.where(F.col("n") > min_obs).select(site).distinct()
    means = stats.join(busy, site, "left_semi")
    ppb = units.to_ppb(F.col("mean"), F.col(unit), species)
    return means.where(ppb >= min_value).select(site).distinct()


def pooled_hourly_mean(df: DataFrame, ts: str, value: str, unit: str = "µg/m³") -> DataFrame:
    """Mean over all sensors per hour, empty hours as NULL."""
    from .align import hourly_mean_gapless
    pooled = hourly_mean_gapless(df.select(F.lit(0).alias("_pool"), ts, value), ["_pool"], ts, [value])
    return pooled.select(ts, F.col(value).alias("avg"), F.lit(unit).alias("unit"))


def site_ratio(df: DataFrame, site: Sequence[str], observed: str, predicted: str,
               first: Sequence[str] = ()) -> DataFrame:
    """mean(observed) / mean(predicted) and its relative change in percent."""
    out = df.groupBy(*site).agg(
        *[F.min(c).alias(c) for c in first],
        F.avg(observed).alias("obs"), F.avg(predicted).alias("pred"))
    ratio = F.col("obs") / F.nullif(F.col("pred"), F.lit(0.0))
    return out.withColumn("ratio", ratio).withColumn("relChange", (F.col("ratio") - 1) * 100)


def unit_plausibility(df: DataFrame, site: Sequence[str], model: str, observed: str, limit: float = 2.0) -> DataFrame:
    """mean(model) / mean(observed), flagged above ``limit`` (a likely unit mistake)."""
    out = df.groupBy(*site).agg((F.avg(model) / F.nullif(F.avg(observed), F.lit(0.0))).alias("ratio"))
    return out.withColumn("suspect", F.col("ratio") > limit)


def site_position(df: DataFrame, site: Sequence[str], ts: str, lat: str, lon: str, location: str) -> DataFrame:
    """Median coordinates rounded to 2 decimals and the name on the earliest row."""
    names = df.groupBy(*site).agg(F.min_by(location, ts).alias("name"))
    la = ranks.median(df, site, lat, "lat").withColumn("lat", F.bround("lat", 2))
    lo = ranks.median(df, site, lon, "lon").withColumn("lon", F.bround("lon", 2))
    return names.join(la, list(site), "left").join(lo, list(site), "left")


def extents(df: DataFrame, lat: str, lon: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.min(lat).alias("south"), F.max(lat).alias("north"), F.min(lon).alias("west"), F.max(lon).alias("east"))


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows ``(feature, n_null, n_rows, n_complete)`` from one pass."""
    complete = F.lit(True)
    for c in columns:
        complete = complete & F.col(c).isNotNull()
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
                 F.count(F.lit(1)).alias("n_rows"), F.count_if(complete).alias("n_complete"))
    return one.unpivot(["n_rows", "n_complete"], list(columns), "feature", "n_null")


def correlations(df: DataFrame, target: str, features: Sequence[str]) -> DataFrame:
    """Rows ``(feature, corr)`` with the target, from one pass."""
    one = df.agg(*[F.corr(target, c).alias(c) for c in features])
    return one.unpivot([], list(features), "feature", "corr")


def pick_features(df: DataFrame, target: str, features: Sequence[str], blacklist: Sequence[str] = (),
                  threshold: float = 0.1) -> DataFrame:
    """Features whose |correlation| with the target exceeds ``threshold``."""
    wanted = [f for f in features if f not in blacklist and f != target]
    return correlations(df, target, wanted).where(F.abs("corr") > threshold)


def with_interval_errors(df: DataFrame, value: str = "value", lower: str = "lower", mid: str = "mid",
                         upper: str = "upper") -> DataFrame:
    """Absolute errors of an interval forecast and whether the value lies inside."""
    v = F.col(value)
    low, high = F.abs(F.col(lower) - v), F.abs(F.col(upper) - v)
    return df.withColumns({
        "absolute_error_lower": low,
        "absolute_error_upper": high,
        "absolute_error_interval": (low + high) / 2,
        "absolute_error_mid": F.abs(F.col(mid) - v),
        "in_bounds": F.coalesce(v.between(F.col(lower), F.col(upper)), F.lit(False)),
    })


def interval_coverage(df: DataFrame, keys: Sequence[str] = (), value: str = "value", lower: str = "lower",
                      upper: str = "upper") -> DataFrame:
    """Percent of rows inside the interval and percent outside either bound."""
    v, lo, hi = F.col(value), F.col(lower), F.col(upper)
    inside = F.coalesce(v.between(lo, hi), F.lit(False))
    rows = F.count(F.lit(1))
    return df.groupBy(*keys).agg(
        (F.avg(inside.cast("int")) * 100).alias("percent_in_bounds"),
        ((F.count_if(hi - v < 0) + F.count_if(v - lo < 0)) / rows * 100).alias("error_percent"),
        rows.alias("n"))


BOX_POINTS = {"lowest": 0.0, "q1": 0.25, "middle": 0.5, "q3": 0.75, "highest": 1.0}


def box_summary(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Quartiles of each column as rows ``(keys..., metric, lowest, q1, middle, q3, highest)``."""
    long = df.select(*keys, *[F.col(c).cast("double") for c in columns]).unpivot(
        list(keys), list(columns), "metric", "value")
    return ranks.quantiles(long, [*keys, "metric"], "value", BOX_POINTS)


def rows_by_source(df: DataFrame, source: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys, source).agg(F.count(F.lit(1)).alias("n"))


def document_header(df: DataFrame, site: Sequence[str], ts: str, timezone: str) -> DataFrame:
    """Row count, first and last time, and the time zone on the first row."""
    def text(c):
        return F.coalesce(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit("N/A"))
    return df.groupBy(*site).agg(
        F.count(F.lit(1)).alias("total_observation"),
        text(F.min(ts)).alias("start_date"), text(F.max(ts)).alias("end_date"),
        F.coalesce(F.min_by(timezone, ts), F.lit("N/A")).alias("timezone"))


def matching_sensors(df: DataFrame, sensors: str, parameter: str, name: str = "sensor_ids") -> DataFrame:
    """Locations with at least one sensor of ``parameter``, and the ids of those sensors."""
    hit = F.filter(sensors, lambda s: s["parameter"]["name"] == parameter)
    return df.withColumn(name, F.transform(hit, lambda s: s["id"])).where(F.size(name) > 0)


def daily_cell_mean(grid: DataFrame, var: str, ts: str, lat: str, lon: str, value: str) -> DataFrame:
    """Mean per variable, day and cell, skipping NaN, with the number of hours used.

    A plain combining aggregation: with the grid stored by variable and date each task reduces its files
    to at most one partial row per cell before the shuffle, which is keyed by cell and so has no hot key.
    """
    v = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    return grid.groupBy(F.col(var).alias("var"), F.to_date(ts).alias("date"), lat, lon).agg(
        F.avg(v).alias("mean"), F.count(v).alias("n_hours"))


def run_log(sites: DataFrame, facts: DataFrame, site: Sequence[str], rules: Sequence[tuple[str, Column]],
            rows: str) -> DataFrame:
    """Status per site: the label of the first rule that holds, else ``ok``; rows used if ok.

    Every site appears, also those without any fact row.
    """
    out = sites.join(facts, list(site), "left")
    status = F.lit("ok")
    for label, condition in reversed(rules):
        status = F.when(F.coalesce(condition, F.lit(True)), F.lit(label)).otherwise(status)
    out = out.withColumn("status", status)
    return out.select(*site, "status", F.coalesce(F.col(rows), F.lit(0)).cast("bigint").alias("n_rows"))
