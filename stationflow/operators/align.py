"""Resampling, regular calendars and gap filling per site."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import times as t
from . import blocks
from .setops import keep_first

DAY = 86400


def _with_missing_steps(df: DataFrame, site: Sequence[str], at: str, seconds: int, pad_seconds: int = 0) -> DataFrame:
    """Add rows for the empty steps between the rows of a site, and ``pad_seconds`` after its last one; other columns are NULL in them.

    ``at`` is a time or epoch seconds, with one row per site and step. Every row brings the empty steps up to the next row, so the calendar is
    made as rows stream by: no task holds the steps of many sites, and only existing rows are ordered.
    """
    numeric = dict(df.dtypes)[at] == "bigint"
    second = F.col(at) if numeric else t.epoch_seconds(F.col(at))
    ahead = F.lead("_second").over(Window.partitionBy(*site).orderBy("_second")) - F.col("_second") - seconds
    out = df.where(F.col(at).isNotNull()).withColumn("_second", second.cast("bigint"))
    out = out.withColumn("_ahead", F.greatest(F.coalesce(ahead, F.lit(pad_seconds)), F.lit(0)).cast("bigint"))
    steps = F.sequence(F.lit(0).cast("bigint"), "_ahead", F.lit(seconds).cast("bigint"))
    out = out.select(*df.columns, F.explode(steps).alias("_off"))
    moved = F.col(at) + (F.col("_off") if numeric else F.make_dt_interval(secs=F.col("_off").cast("double")))
    own = {c: F.when(F.col("_off") == 0, F.col(c)) for c in df.columns if c not in (*site, at)}
    return out.withColumns({**own, at: moved}).select(*df.columns)


def hourly_mean(df: DataFrame, site: Sequence[str], ts: str, values: Sequence[str], tasks: int | None = None) -> DataFrame:
    """Mean per site and hour; hours without rows are absent.

    ``tasks`` deals the rows to so many tasks (:func:`blocks.task_number`) instead of the session's, for series with few rows an hour, which
    do not shrink before the shuffle.
    """
    hourly = df.select(*site, t.hour_floor(F.col(ts)).alias(ts), *values)
    if tasks:
        hourly = hourly.repartition(tasks, *site, ts)
    return hourly.groupBy(*site, ts).agg(*[F.avg(v).alias(v) for v in values])


def hourly_mean_gapless(df: DataFrame, site: Sequence[str], ts: str, values: Sequence[str],
                        pad_hours: int = 0) -> DataFrame:
    """Mean per site and hour from the first to the last hour, empty hours as NULL.

    The means bring the empty hours up to the next one, so filling the gaps costs no join and no second pass over the data.
    Rows without a time do not take part.
    """
    return _with_missing_steps(hourly_mean(df, site, ts, values), site, ts, 3600, pad_hours * 3600)


def regular_calendar(df: DataFrame, site: Sequence[str], ts: str, seconds: int = 3600,
                     pad_seconds: int = 0) -> DataFrame:
    """Insert a row with NULL values for every missing step between first and last time.

    Expects one row per site and time on the step grid.
    """
    return _with_missing_steps(df, site, ts, seconds, pad_seconds)


def resample_mean(df: DataFrame, site: Sequence[str], ts: str, values: Sequence[str],
                  seconds: int, tasks: int | None = None) -> DataFrame:
    """Mean per bin of ``seconds``; empty bins are kept as NULL.

    Bins of a whole number of days start at midnight of the site's first day, shorter bins at
    midnight of every day. Rows are first reduced to partial sums per base bin, so the anchor
    is found on at most one row per site and base bin. Rows without a time do not take part. ``tasks`` is as in :func:`hourly_mean`.
    """
    if seconds > DAY and seconds % DAY:
        raise ValueError("bins longer than a day must be whole days")
    base = min(seconds, DAY)
    if DAY % base:
        raise ValueError("bins shorter than a day must divide it")
    start = F.floor(t.epoch_seconds(F.col(ts)) / base) * base
    binned = df.select(*site, start.cast("bigint").alias("_s"), *values)
    if tasks:
        binned = binned.repartition(tasks, *site, "_s")
    partial = binned.groupBy(*site, "_s").agg(
        *[F.sum(v).alias(f"_sum_{v}") for v in values],
        *[F.count(v).alias(f"_cnt_{v}") for v in values])
    if seconds > DAY:
        first = F.min("_s").over(Window.partitionBy(*site))
        partial = partial.where("_s IS NOT NULL").withColumn("_s", (first + F.floor((F.col("_s") - first) / seconds) * seconds).cast("bigint"))
        partial = partial.groupBy(*site, "_s").agg(*[F.sum(f"{p}_{v}").alias(f"{p}_{v}") for v in values for p in ("_sum", "_cnt")])
    means = partial.select(*site, "_s", *[(F.col(f"_sum_{v}") / F.nullif(F.col(f"_cnt_{v}"), F.lit(0))).alias(v) for v in values])
    filled = _with_missing_steps(means, site, "_s", seconds)
    return filled.select(*site, t.from_epoch_seconds(F.col("_s")).alias(ts), *values)


def resample_groups(df: DataFrame, site: Sequence[str], ts: str, groups: Sequence[Sequence[str]],
                    seconds: int = DAY) -> DataFrame:
    """Resample the distinct columns named in ``groups``."""
    names = list(dict.fromkeys(c for g in groups for c in g))
    return resample_mean(df, site, ts, names, seconds)


def round_and_dedup(df: DataFrame, site: Sequence[str], ts: str, hours: int = 3) -> DataFrame:
    """Snap times to the nearest ``hours`` and keep the earliest original row per slot."""
    snapped = df.withColumn("_at", F.col(ts)).withColumn(ts, t.round_to_hours(F.col(ts), hours))
    return keep_first(snapped, [*site, ts], ["_at"]).drop("_at")


def forward_fill(df: DataFrame, site: Sequence[str], ts: str, values: Sequence[str],
                 limit: int) -> DataFrame:
    """Carry the last value over at most ``limit`` rows of a regular hourly series."""
    def build(w):
        frame = w.rowsBetween(-limit, 0)
        return {v: F.last(v, ignorenulls=True).over(frame) for v in values}
    return blocks.with_trailing_frames(df, site, t.hour_index(F.col(ts)), [(limit, build)])


def fill_all(df: DataFrame, site: Sequence[str], ts: str, values: Sequence[str],
             medians: DataFrame | None = None) -> DataFrame:
    """Forward fill, then backward fill, then the median per site and column.

    ``medians`` has the site columns and ``<v>_median``. A column without any value in a site
    has nothing to carry and no median either, so it stays NULL unless ``medians`` is given.
    """
    out = blocks.with_neighbours(df, site, ts, values)
    filled = {v: F.coalesce(F.col(f"_prev_{v}.v"), F.col(f"_next_{v}.v")) for v in values}
    out = blocks.drop_neighbours(out.withColumns(filled), values)
    if medians is None:
        return out
    out = out.join(medians, list(site), "left")
    return out.withColumns({v: F.coalesce(v, f"{v}_median") for v in values}).drop(
        *[f"{v}_median" for v in values])


def _line(v: str, x, x0: Column, x1: Column) -> Column:
    a, b = F.col(f"_prev_{v}.v"), F.col(f"_next_{v}.v")
    return a + (b - a) * (x - x0) / F.nullif(x1 - x0, F.lit(0))


def interpolate_time(df: DataFrame, site: Sequence[str], ts: str, values: Sequence[str], settle=None,
                     tasks: int | None = None) -> DataFrame:
    """Linear in time between two known points; nothing outside them. ``settle`` and ``tasks`` are :func:`blocks.with_neighbours`'s."""
    out = blocks.with_neighbours(df, site, ts, values, settle=settle, tasks=tasks)
    return blocks.drop_neighbours(out.withColumns({v: _between_times(v, ts) for v in values}), values)


def _between_times(v: str, ts: str) -> Column:
    line = _line(v, t.epoch_micros(F.col(ts)),
                 t.epoch_micros(F.col(f"_prev_{v}.t")), t.epoch_micros(F.col(f"_next_{v}.t")))
    return F.coalesce(F.col(v), line)


def interpolate_time_limited(df: DataFrame, site: Sequence[str], ts: str, value: str,
                             limit: int = 12) -> DataFrame:
    """Linear in time, at most ``limit`` rows into a gap from either end.

    A leading or trailing gap takes the nearest value, also at most ``limit`` rows away.
    """
    out = blocks.with_neighbours(df, site, ts, [value])
    prev, nxt = F.col(f"_prev_{value}"), F.col(f"_next_{value}")
    near_prev = F.coalesce(F.col("_rn") - prev["rn"] <= limit, F.lit(False))
    near_next = F.coalesce(nxt["rn"] - F.col("_rn") <= limit, F.lit(False))
    line = F.coalesce(_between_times(value, ts), prev["v"], nxt["v"])
    filled = F.when(F.col(value).isNotNull(), F.col(value)).when(near_prev | near_next, line)
    return blocks.drop_neighbours(out.withColumn(value, filled), [value])


def interpolate_rows(df: DataFrame, site: Sequence[str], ts: str, value: str, limit: int = 6) -> DataFrame:
    """Linear in row position, the first ``limit`` rows of a gap.

    After the last known point its value is carried ``limit`` rows; before the first known
    point nothing is filled.
    """
    out = blocks.with_neighbours(df, site, ts, [value])
    prev, nxt = F.col(f"_prev_{value}"), F.col(f"_next_{value}")
    line = F.coalesce(_line(value, F.col("_rn"), prev["rn"], nxt["rn"]), prev["v"])
    filled = F.when(F.col(value).isNotNull(), F.col(value)).when(F.col("_rn") - prev["rn"] <= limit, line)
    return blocks.drop_neighbours(out.withColumn(value, filled), [value])


def fill_from_second(df: DataFrame, first: str, second: str, source: str,
                     labels: tuple[str, str]) -> DataFrame:
    """Fill ``first`` from ``second`` and record which one a row came from."""
    return df.withColumns({
        source: F.when(F.col(first).isNull(), F.lit(labels[1])).otherwise(F.lit(labels[0])),
        first: F.coalesce(first, second),
    })


def fill_index(df: DataFrame, index: str, computed: str) -> DataFrame:
    return df.withColumn(index, F.coalesce(F.col(index).cast("double"), F.col(computed)))


def add_local_time(df: DataFrame, ts: str, tz: str, default: str = "UTC") -> DataFrame:
    """Add ``local_time`` and ``timezone`` from a zone column of the site."""
    zone = F.coalesce(F.col(tz), F.lit(default))
    return df.withColumns({"local_time": t.to_local(F.col(ts), zone), "timezone": zone})


def month_chunks(df: DataFrame, start: str, end: str, months: int = 6) -> DataFrame:
    """Split each row's range into fetch chunks of ``months``; a chunk ends a day before the next.

    The number of chunks is the whole months of the range divided by ``months``, plus one.
    """
    span = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    n = F.floor(span / months).cast("int")
    step = F.make_ym_interval(F.lit(0), F.col("chunk") * months)
    nxt = F.make_ym_interval(F.lit(0), (F.col("chunk") + 1) * months)
    out = df.withColumn("chunk", F.explode(F.sequence(F.lit(0), n)))
    return out.withColumns({
        "chunk_start": F.col(start) + step,
        "chunk_end": F.least(F.col(start) + nxt - F.make_dt_interval(F.lit(1)), F.col(end)),
    })


def day_chunks(df: DataFrame, start: str, end: str, days: int = 90) -> DataFrame:
    """Split each row's range into chunks of ``days``; the next one starts a day later."""
    reach = F.make_dt_interval(F.lit(days))
    step = F.make_dt_interval(F.lit(days + 1))
    out = df.withColumn("chunk_start", F.explode(F.sequence(F.col(start), F.col(end), step)))
    return out.withColumn("chunk_end", F.least(F.col("chunk_start") + reach, F.col(end)))
