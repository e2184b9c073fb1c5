"""Daily grid product from hourly grid rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import times as t
from ..operators import aggregates, clean


def daily_grid(grid: DataFrame, variables: Sequence[str], first_day: Column, days: int, var: str = "var", ts: str = "ts",
               lat: str = "lat", lon: str = "lon", value: str = "value") -> DataFrame:
    """Daily means of the wanted variables over ``days`` days, variable and time range pushed to the scan."""
    start = F.date_trunc("DAY", first_day).cast(t.NTZ)
    wanted = grid.where(F.col(var).isin(list(variables)) & (F.col(ts) >= start) & (F.col(ts) < start + F.make_dt_interval(F.lit(days))))
    return aggregates.daily_cell_mean(wanted, var, ts, lat, lon, value)


def write_daily_grid(daily: DataFrame, path: str) -> None:
    """Write by variable and date; one day is spread over row bands of the grid."""
    band = F.floor(F.col("lat") / 10)
    daily.repartition("var", "date", band).write.mode("overwrite").partitionBy("var", "date").parquet(path)


def newest_grid(grid: DataFrame, run_date: str, days_back: int = 3, today: Column | None = None) -> DataFrame:
    return clean.latest_run(grid, run_date, days_back, today)
