"""Union, precedence, dedup and incremental append."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; columns missing from one are NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first by ``order``, ties broken by the remaining columns.

    A combining aggregation, not a window: copies of a key shrink before the shuffle, so a key
    with very many copies never gathers them in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    order = [(F.col(o) if isinstance(o, str) else o).alias(f"_o{i}") for i, o in enumerate(order)]
    row = F.struct(*order, *rest)
    picked = df.groupBy(*keys).agg(F.min(row).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def precedence_union(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Union in which an earlier frame wins whenever a key occurs in several."""
    ranked = [f.withColumn("_src", F.lit(i)) for i, f in enumerate(frames)]
    return keep_first(union_all(ranked), keys, ["_src"]).drop("_src")


def hand_over(old: DataFrame, new: DataFrame, keys: Sequence[str], ts: str, at: Column) -> DataFrame:
    """Old version up to ``at``, new version from ``at``; the old one wins on the border."""
    return precedence_union([old.where(F.col(ts) <= at), new.where(F.col(ts) >= at)], keys)


def incremental_append(cached: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cached rows plus the new rows whose key is not cached yet."""
    return precedence_union([cached, new], keys)


def restart_points(cached: DataFrame, sensor: str, ts: str) -> DataFrame:
    """Where each sensor's next fetch starts: its last cached time."""
    return cached.groupBy(sensor).agg(F.max(ts).alias("next_start"))


def head_sample(df: DataFrame, order: Sequence[str], n: int = 100) -> DataFrame:
    """First ``n`` rows by ``order``."""
    return df.orderBy(*order).limit(n)
