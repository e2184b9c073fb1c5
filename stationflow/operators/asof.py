"""Nearest-in-time joins without comparing every pair."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.times import epoch_micros
from ..session import cut_lineage
from . import blocks
from .setops import keep_first


def nearest_in_time(targets: DataFrame, series: DataFrame, keys: Sequence[str], target_ts: str,
                    ts: str, position: str | None = None, prefer: str = "position", limit: int = 50_000) -> DataFrame:
    """For each target the row of ``series`` closest in time, with an exact match first.

    Equal distances: the row that comes first in ``position`` (``prefer="position"``), or the
    earlier time (``prefer="earlier"``). Both sides are stacked on one time axis and every
    target takes its neighbours from there, so the cost grows with rows, not with pairs. The axis is ordered in blocks of
    about ``limit`` rows, also where a key has most of its rows in one hour or second; a key's blocks, one summary row each, are
    what one task orders as a whole. Targets of one time ask once.
    Targets of a key without any series row are dropped.
    """
    payload = [c for c in series.columns if c not in keys]
    order = [position] if position else [ts]
    rows = keep_first(series.where(F.col(ts).isNotNull()), [*keys, ts], order)
    t_cols = [c for c in targets.columns if c not in keys]
    stacked = rows.select(*keys, F.col(ts).alias("_t"), F.struct(*payload).alias("_row"))
    asked = targets.select(*keys, F.col(target_ts).alias("_t")).where("_t IS NOT NULL").distinct().withColumn("_asks", F.lit(True))
    axis = cut_lineage(stacked.join(asked, [*keys, "_t"], "full"), "time-axis")
    near = blocks.with_neighbours(axis, keys, "_t", ["_row"], limit=limit)
    near = near.where("_asks")
    before, after = F.col("_prev__row"), F.col("_next__row")
    back = epoch_micros(F.col("_t")) - epoch_micros(before["t"])
    ahead = epoch_micros(after["t"]) - epoch_micros(F.col("_t"))
    if prefer == "position" and position:
        tie_back = before["v"][position] <= after["v"][position]
    else:
        tie_back = F.lit(True)
    take_back = after["t"].isNull() | (back < ahead) | ((back == ahead) & tie_back)
    chosen = F.when(before["t"].isNotNull() & take_back, before["v"]).otherwise(after["v"])
    picked = near.withColumn("_pick", chosen).where(F.col("_pick").isNotNull()).select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_t", "_pick")
    same = F.col("_t") == F.col(target_ts)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    # planned sizes know nothing of exploded hours or compressed files: both sides are shuffled, not sent through the driver
    out = targets.join(picked.hint("merge"), same)
    return out.select(*keys, *t_cols, *[F.col(f"_pick.{c}").alias(c) for c in payload if c not in t_cols])
