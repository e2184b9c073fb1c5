"""Lags, rolling means, NowCast and index columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import aqi, times as t
from . import blocks


def indexed(df: DataFrame, site: Sequence[str], ts: str, by: str) -> tuple[DataFrame, str]:
    """Consecutive index column: ``by="rows"`` numbers existing rows, ``"time"`` counts hours.

    ``"time"`` expects a regular hourly series (see ``align.regular_calendar``).
    """
    if by == "time":
        return df.withColumn("_pos", t.hour_index(F.col(ts))), "_pos"
    if by == "rows":
        return blocks.row_index(df, site, [ts], "_pos"), "_pos"
    raise ValueError("by must be 'rows' or 'time'")


def lag_stage(value: str, lags: Sequence[int], suffix: str = "lag{}"):
    def build(w):
        return {f"{value}_{suffix.format(k)}": F.lag(value, k).over(w) for k in lags}
    return max(lags), build


def rolling_stage(value: str, sizes: Sequence[int], suffix: str = "roll{}"):
    def build(w):
        return {f"{value}_{suffix.format(n)}": F.avg(value).over(w.rowsBetween(-(n - 1), 0)) for n in sizes}
    return max(sizes) - 1, build


def lags_and_rolling(df: DataFrame, site: Sequence[str], ts: str, value: str, lags: Sequence[int],
                     sizes: Sequence[int], by: str = "rows") -> DataFrame:
    """Add ``<value>_lag<k>`` and ``<value>_roll<n>`` (mean of up to n rows) per site."""
    df, pos = indexed(df, site, ts, by)
    depth = max([*lags, *[n - 1 for n in sizes]])

    def build(w):
        return {**lag_stage(value, lags)[1](w), **rolling_stage(value, sizes)[1](w)}
    return blocks.with_trailing_frames(df, site, pos, [(depth, build)]).drop(pos)


def nowcast_stages(value: str, hours: int = 12, name: str = "PM25_NowCast_Concentration"):
    return [
        (hours - 1, lambda w: {"_terms": aqi.nowcast_terms(value, w, hours)}),
        (0, lambda w: {"_top": F.array_max("_terms"), "_low": F.array_min("_terms")}),
        (0, lambda w: {"_weight": aqi.nowcast_weight("_top", "_low")}),
        (0, lambda w: {name: aqi.nowcast_mean("_terms", "_weight", "_top")}),
    ]


HELPERS = ("_terms", "_top", "_low", "_weight", "_mean_NO2", "_mean_O3")


def index_stages(species: dict[str, str], avg_hours: dict[str, int] | None = None):
    """Stages for the index columns of each species: NowCast for PM2.5, rolling mean otherwise.

    The caller drops the columns in ``HELPERS``.
    """
    avg_hours = avg_hours or {}
    stages, means, indices = [], {}, {}
    for name, column in species.items():
        if name == "PM2.5":
            stages += nowcast_stages(column)
            indices["PM25_NowCast_AQI"] = ("PM25_NowCast_Concentration", name)
        else:
            means[f"_mean_{name}"] = (column, avg_hours.get(name, 1))
            indices[f"{name}_AQI"] = (f"_mean_{name}", name)
    if means:
        depth = max(n - 1 for _, n in means.values())
        stages.append((depth, lambda w: {
            m: F.avg(c).over(w.rowsBetween(-(n - 1), 0)) for m, (c, n) in means.items()}))
    stages.append((0, lambda w: {out: aqi.sub_index(c, name) for out, (c, name) in indices.items()}))
    return stages


def add_indices(df: DataFrame, site: Sequence[str], ts: str, species: dict[str, str],
                avg_hours: dict[str, int] | None = None, by: str = "time") -> DataFrame:
    """Add NowCast concentration and index columns; columns absent from ``df`` are skipped."""
    present = {s: c for s, c in species.items() if c in df.columns}
    df, pos = indexed(df, site, ts, by)
    out = blocks.with_trailing_frames(df, site, pos, index_stages(present, avg_hours))
    return out.drop(*HELPERS, pos)


def add_overall_index(df: DataFrame, columns: Sequence[str] = ("pm25_aqi", "NO2_AQI", "PM25_NowCast_AQI"),
                      name: str = "overall_aqi") -> DataFrame:
    """Largest of the listed index columns that exist."""
    return df.withColumn(name, aqi.overall_index([c for c in columns if c in df.columns]))
