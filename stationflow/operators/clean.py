"""Projections, filters and quality rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .. import fixed_values as fv
from ..functions import names, times as t


# ---- columns -------------------------------------------------------------------------------

def harmonise_names(df: DataFrame, mapping: dict[str, str] = fv.VERSION_NAMES) -> DataFrame:
    """Rename version-specific columns; where both spellings exist the common one wins."""
    for old, new in mapping.items():
        if old not in df.columns:
            continue
        if new in df.columns:
            df = df.withColumn(new, F.coalesce(new, old)).drop(old)
        else:
            df = df.withColumnRenamed(old, new)
    return df


def add_sum(df: DataFrame, name: str, parts: Sequence[str]) -> DataFrame:
    """Sum of ``parts`` if all of them exist."""
    if not all(p in df.columns for p in parts):
        return df
    total = F.col(parts[0])
    for p in parts[1:]:
        total = total + F.col(p)
    return df.withColumn(name, total)


def scale_fractions(df: DataFrame, gases: Sequence[str] = fv.FRACTION_GASES) -> DataFrame:
    """Volume fractions to parts per billion."""
    return df.withColumns({g: F.col(g) * fv.PPB_PER_FRACTION for g in gases if g in df.columns})


def add_calendar_parts(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumns(t.calendar_parts(F.col(ts)))


def clean_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[names.clean_column(c) for c in df.columns])


def drop_listed(df: DataFrame, blacklist: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in blacklist])


def keep_listed(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Keep the wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def ensure_columns(df: DataFrame, columns: Sequence[str], dtype: str = "double") -> DataFrame:
    """Add missing columns as NULL."""
    return df.withColumns({c: F.lit(None).cast(dtype) for c in columns if c not in df.columns})


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN is "missing" in every source, so it becomes NULL once at ingest."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in numeric})


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def publish_ready(df: DataFrame, keep: Sequence[str], rename: dict[str, str], corrected: str = "corrected",
                  floor: float = 0.1, digits: int = 2) -> DataFrame:
    """Published columns: renamed, negatives cut to 0, correction at least ``floor``, rounded."""
    out = keep_listed(df, keep).withColumnsRenamed(rename)
    cols = {}
    for f in out.schema.fields:
        if not isinstance(f.dataType, T.NumericType):
            continue
        c = F.col(f.name)
        kept = F.when(c.isNotNull(), F.greatest(c, F.lit(0).cast(f.dataType)))
        if f.name == corrected:
            kept = F.when(kept > 0, kept).otherwise(F.lit(floor))
        cols[f.name] = F.bround(kept, digits) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else kept
    return out.withColumns(cols)


def rounded(c: Column, digits: int = 2) -> Column:
    """Rounded half to even, NaN as NULL."""
    return F.bround(F.nanvl(c.cast("double"), F.lit(None).cast("double")), digits)


def flatten_paths(df: DataFrame, depth: int = 3) -> DataFrame:
    """Nested structs to ``a_b_c`` columns, ``depth`` levels deep."""
    def walk(dtype, path, level):
        for f in dtype.fields:
            here = [*path, f.name]
            if isinstance(f.dataType, T.StructType) and level < depth:
                yield from walk(f.dataType, here, level + 1)
            else:
                quoted = ".".join(f"`{p}`" for p in here)
                yield F.col(quoted).alias("_".join(here))
    return df.select(*walk(df.schema, [], 1))


def metric_list(metrics: Sequence[tuple[str, Column]]) -> Column:
    """``[{name, value}]`` with values as text and ``N/A`` for missing ones."""
    return F.array(*[
        F.struct(F.lit(n).alias("name"), F.coalesce(v.cast("string"), F.lit("N/A")).alias("value"))
        for n, v in metrics])


# ---- filters -------------------------------------------------------------------------------

def time_range(df: DataFrame, ts: str, start=None, end=None) -> DataFrame:
    """Rows with start <= time <= end; either side may be open."""
    if start is not None:
        df = df.where(F.col(ts) >= F.lit(start).cast(t.NTZ))
    if end is not None:
        df = df.where(F.col(ts) <= F.lit(end).cast(t.NTZ))
    return df


def last_months(df: DataFrame, site: Sequence[str], ts: str, months: int = 12) -> DataFrame:
    """Rows no older than ``months`` before the site's latest row."""
    cut = F.max(ts) - F.make_ym_interval(F.lit(0), F.lit(months))
    latest = df.groupBy(*site).agg(cut.alias("_cut"))
    return df.join(latest, list(site)).where(F.col(ts) >= F.col("_cut")).drop("_cut")


def valid_value(df: DataFrame, value: str) -> DataFrame:
    """Non-negative, not missing, not NaN."""
    return df.where((F.col(value) >= 0) & ~F.isnan(value))


def no2_quality(df: DataFrame, conc: str, value: str) -> DataFrame:
    low, high = fv.NO2_RANGE
    return df.where((F.col(conc) != fv.INSTRUMENT_MISSING) & (F.col(value) > low) & (F.col(value) < high))


def o3_quality(df: DataFrame, column: str, flag: str, aod: str) -> DataFrame:
    low, high = fv.O3_RANGE
    return df.where(
        (F.col(column) != fv.INSTRUMENT_MISSING) & F.col(flag).isin(fv.O3_GOOD_FLAGS)
        & F.col(column).between(low, high) & (F.col(aod) >= 0))


def equals(df: DataFrame, column: str, value: str) -> DataFrame:
    """Reference-grade sensors, one species, and similar equality filters."""
    return df.where(F.col(column) == value)


def any_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which at least one of the columns (of those that exist) has a value."""
    have = [c for c in columns if c in df.columns]
    return df.where(F.coalesce(*have).isNotNull()) if have else df


def all_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(how="any", subset=list(columns))


def finite_target(df: DataFrame, target: str) -> DataFrame:
    c = F.col(target).cast("double")
    return df.where(c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))


def drop_empty_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Drop feature columns without a single value (one counting pass over all of them)."""
    counts = df.agg(*[F.count(c).alias(c) for c in features]).first()
    return df.drop(*[c for c in features if counts[c] == 0])


def fresh(df: DataFrame, modified: str, hours: float, now: Column | None = None) -> DataFrame:
    """Entries modified within the last ``hours``."""
    now = F.current_timestamp() if now is None else now
    age = F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col(modified).cast("timestamp"))
    return df.where(age < F.lit(int(hours * 3600 * 1_000_000)))


def latest_run(df: DataFrame, run_date: str, days_back: int, today: Column | None = None) -> DataFrame:
    """Rows of the newest run that is at most ``days_back`` days old."""
    today = F.current_date() if today is None else today
    recent = df.where(F.col(run_date).between(F.date_sub(today, days_back), today))
    newest = recent.agg(F.max(run_date).alias("_newest"))
    return recent.join(newest, recent[run_date] == newest["_newest"], "left_semi")


def default_window(df: DataFrame, site: Sequence[str], ts: str,
                   earliest: str = fv.EARLIEST_START) -> DataFrame:
    """Per site: start = the later of first time and ``earliest``, end = last time."""
    return df.groupBy(*site).agg(
        F.greatest(F.min(ts), F.lit(earliest).cast(t.NTZ)).alias("start"), F.max(ts).alias("end"))


def within_window(df: DataFrame, windows: DataFrame, site: Sequence[str], ts: str) -> DataFrame:
    joined = df.join(windows, list(site))
    return joined.where(F.col(ts).between(F.col("start"), F.col("end"))).drop("start", "end")


def enough_rows(df: DataFrame, site: Sequence[str], minimum: int) -> DataFrame:
    """Rows of sites with at least ``minimum`` rows."""
    big = df.groupBy(*site).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= minimum)
    return df.join(big, list(site), "left_semi")


def sample_status(df: DataFrame, site: Sequence[str], gates: Sequence[int]) -> DataFrame:
    """Row count per site and the largest gate it passes (0 if none)."""
    out = df.groupBy(*site).agg(F.count(F.lit(1)).alias("n_rows"))
    code = F.lit(0)
    for g in sorted(gates):
        code = F.when(F.col("n_rows") >= g, F.lit(g)).otherwise(code)
    return out.withColumn("gate", code)


def work_list(sites: DataFrame, source: str, modified: DataFrame, key: str, wanted: Sequence[str],
              skipped: Sequence[str] = (), forced: Sequence[str] = (), force_all: bool = False,
              hours: float = 48, now: Column | None = None) -> DataFrame:
    """Sites to process: wanted source, not skipped, and forced or without a fresh result.

    ``modified`` holds the inventory ``(key, modified)``.
    """
    todo = sites.where(F.col(source).isin(list(wanted)))
    if skipped:
        todo = todo.where(~F.col(source).isin(list(skipped)))
    if force_all:
        return todo
    current = fresh(modified, "modified", hours, now).select(key).distinct()
    stale = todo.join(current, key, "left_anti")
    if not forced:
        return stale
    is_forced = F.col(source).isin(list(forced))
    return todo.where(is_forced).unionByName(stale.where(~is_forced))
