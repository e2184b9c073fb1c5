"""Reading and aligning observation and model series (all sites at once)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import fixed_values as fv
from ..functions import units
from ..operators import aggregates, align, blocks, clean, joins, nearest, outliers, setops
from ..session import cut_lineage
from ..sources import readers


def merge_series(model: DataFrame, obs: DataFrame, site: Sequence[str], ts: str, start=None, end=None,
                 blacklist: Sequence[str] = ("lat", "lon", "lev"), interpolate: bool = True) -> DataFrame:
    """Outer merge of model and observations, gaps interpolated in time, hourly means, time range.

    Only rows that share a site and time meet; of a duplicated time each side's first row is kept. Rows without a site or time do not take part.
    Both sides are stacked, written and meet in one aggregation, in as many tasks as they have rows for.
    """
    sides = [clean.drop_listed(model, blacklist), obs]
    values = [[c for c in clean.numeric_columns(df) if c not in (*site, ts)] for df in sides]
    every = [c for own in values for c in own]
    known = " AND ".join(f"`{c}` IS NOT NULL" for c in (*site, ts))
    stacked = setops.union_all([df.where(known).select(*site, ts, F.lit(i).alias("_side"), *own) for i, (df, own) in enumerate(zip(sides, values))])
    stacked = cut_lineage(stacked, "stacked")
    tasks = blocks.task_number(stacked, len(every))

    def meet(rows: DataFrame, keys: list[str]) -> DataFrame:
        first = [F.min(F.when(F.col("_side") == i, F.struct(*own))).alias(f"_first{i}") for i, own in enumerate(values) if own]
        return rows.groupBy(*keys).agg(*first).select(*keys, *[F.col(f"_first{i}.{c}").alias(c) for i, own in enumerate(values) for c in own])
    merged = align.interpolate_time(stacked, site, ts, every, settle=meet, tasks=tasks) if interpolate else meet(stacked, [*site, ts])
    return clean.time_range(align.resample_mean(merged, site, ts, every, 3600, tasks), ts, start, end)


PLACE = "_place"


def read_model(grids: Sequence[DataFrame], sites: DataFrame, site: str, ts: str, start=None, end=None,
               columns_wise: DataFrame | None = None) -> DataFrame:
    """Hourly model series of the cell nearest to each site.

    ``grids`` are stores in order of precedence, each wide by variable with ``lat, lon, <ts>``.
    ``columns_wise`` adds further variables to the first store (left values win). Names are
    harmonised before the stores are stacked. All of that happens once for each different place: sites of one
    cell share a series, and get it by the last join.
    """
    at = nearest.site_places(sites.select(site, "lat", "lon"), site, PLACE)
    places = nearest.place_cells(at, PLACE)

    def series(grid: DataFrame) -> DataFrame:
        grid = clean.time_range(grid, ts, start, end)
        cells = nearest.nearest_cell_series(places, grid)
        return clean.harmonise_names(cells.drop("lat", "lon"))
    stores = [series(g) for g in grids]
    if columns_wise is not None:
        stores[0] = joins.side_by_side(stores[0], series(columns_wise), [PLACE, ts])
    out = setops.precedence_union(stores, [PLACE, ts]) if len(stores) > 1 else setops.keep_first(stores[0], [PLACE, ts], [])
    out = clean.add_sum(out, "aod550_ss", ["aod550_sala", "aod550_salc"])
    out = clean.add_calendar_parts(clean.scale_fractions(out), ts)
    return out.join(at, PLACE).select(site, *[c for c in out.columns if c != PLACE])


def sensor_ppb(df: DataFrame, site: Sequence[str], species: str, normalise: bool = False, above: float | None = None) -> DataFrame:
    """Valid rows of one species in ppb, optionally normalised per site.

    Zero is a valid value; ``above`` keeps only values greater than it, in the unit they came in.
    """
    out = clean.valid_value(clean.equals(df, "parameter", species), "value")
    if above is not None:
        out = out.where(F.col("value") > above)
    out = out.withColumn("value", units.to_ppb(F.col("value"), F.col("unit"), species))
    return outliers.normalise(out, site, "value", "value") if normalise else out


def sensor_hourly(cached: DataFrame, new: DataFrame, sensor: str, ts: str, value: str,
                  unit: str = "µg/m³") -> DataFrame:
    """Cached plus newly fetched sensor rows, then the mean over all sensors per hour."""
    both = setops.incremental_append(cached.select(sensor, ts, value), new.select(sensor, ts, value), [sensor, ts])
    return aggregates.pooled_hourly_mean(both, ts, value, unit)


def read_observations(spark: SparkSession, source: str, path: str, species: str, resample: int | None = None,
                      above: float | None = None, **options) -> DataFrame:
    """Observations of one source kind: ``csv``, ``instrument`` or ``sensor``; optionally resampled.

    ``above`` is :func:`sensor_ppb`'s.
    """
    if source == "csv":
        out = readers.observation_csv(spark, path, species=species, **options)
    elif source == "instrument":
        out = readers.instrument_text(spark, path, species)
    elif source == "sensor":
        raw = readers.sensor_pages(spark, path, **options)
        out = sensor_ppb(raw, ["location"], species, above=above).select("time", "value", "location")
    else:
        raise ValueError(f"unknown source {source!r}")
    if resample:
        values = [c for c in ("value", "lat", "lon") if c in out.columns]
        out = align.resample_mean(out, ["location"], "time", values, resample)
    return out


def observation_sites(obs: DataFrame, site: Sequence[str], ts: str = "time") -> DataFrame:
    """Median position, name and default model window of every observed site."""
    place = aggregates.site_position(obs, site, ts, "lat", "lon", "location")
    return place.join(clean.default_window(obs, site, ts), list(site))


def combine_versions(old: DataFrame, new: DataFrame, site: Sequence[str], ts: str) -> DataFrame:
    """Hourly union of both model versions in which the old one wins."""
    return setops.precedence_union([clean.harmonise_names(old), clean.harmonise_names(new)], [*site, ts])


def site_table(registry: DataFrame, species: str = fv.DEFAULT_SPECIES) -> DataFrame:
    return readers.site_options(registry, species)
