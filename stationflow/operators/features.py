"""Feature columns and targets of the bias-correction models."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fv
from . import blocks, ranks
from .windows import indexed, lag_stage, rolling_stage

HOURLY_LAGS = (1, 3, 6, 24)
HOURLY_ROLLS = (3, 6)


def cyclic(ts: Column, year_days: float = 365.25) -> dict[str, Column]:
    """Sine and cosine of hour and day of year, weekday (Monday = 0) and weekend flag."""
    hour = 2 * math.pi * F.hour(ts) / 24
    day = 2 * math.pi * F.dayofyear(ts) / year_days
    weekday = F.weekday(ts)
    return {
        "hour_sin": F.sin(hour), "hour_cos": F.cos(hour),
        "doy_sin": F.sin(day), "doy_cos": F.cos(day),
        "weekday": weekday.cast("double"),
        "is_weekend": (weekday >= 5).cast("double"),
    }


def first_containing(columns: Sequence[str], parts: Sequence[str], skip: Sequence[str] = ()) -> str | None:
    """First column whose lower-case name contains one of ``parts``."""
    for c in columns:
        if c not in skip and any(p in c.lower() for p in parts):
            return c
    return None


def species_column(columns: Sequence[str], species: str, prefixes: Sequence[str] = ()) -> str | None:
    """Column that holds the model's own value of a species.

    Exact names come first (``prefixes`` adds ``<prefix>_<species>``), then any name that contains it.
    """
    for exact in (species, f"{species}_col", *[f"{p}_{species}" for p in prefixes]):
        if exact in columns:
            return exact
    return first_containing(columns, [species.lower()], skip=["value"])


def proxies(columns: Sequence[str]) -> dict[str, Column]:
    """Mixing-depth and lapse proxies, as far as their inputs exist. ``columns`` are numeric columns that are neither key nor time."""
    out = {}
    depth = first_containing(columns, ["pbl", "pbh", "kpbl"])
    if depth:
        out["pbl_proxy"] = F.log1p(F.when(F.col(depth).isNotNull(), F.greatest(F.col(depth), F.lit(0.0))))
    surface = first_containing(columns, ["t2m", "ts"])
    aloft = first_containing(columns, ["t850", "t_850"])
    if surface and aloft:
        out["t2m_delta"] = F.col(surface) - F.col(aloft)
    return out


def atmospheric_features(df: DataFrame, site: Sequence[str], ts: str, species: str, by: str = "rows",
                         fill: bool = True) -> DataFrame:
    """Cyclic, proxy, lag and rolling features; new columns are filled with the site's median.

    A feature without any value in a site becomes 0 there.
    """
    before = list(df.columns)
    inputs = [c for c in feature_columns(df, [*site, ts])]
    out = df.withColumns({**cyclic(F.col(ts)), **proxies(inputs)})
    column = species_column(before, species)
    if column:
        out, pos = indexed(out, site, ts, by)
        depth = max(*HOURLY_LAGS, *[n - 1 for n in HOURLY_ROLLS])

        def build(w):
            lags = lag_stage(column, HOURLY_LAGS, "lag{}h")[1](w)
            rolls = rolling_stage(column, HOURLY_ROLLS, "roll{}h")[1](w)
            return {k.replace(column, species, 1): v for k, v in {**lags, **rolls}.items()}
        out = blocks.with_trailing_frames(out, site, pos, [(depth, build)]).drop(pos)
    if not fill:
        return out
    # cyclic features are never missing; only the others need medians
    gaps = [c for c in out.columns if c not in before and c not in cyclic(F.col(ts))]
    return fill_series_with_medians(out, site, gaps) if gaps else out


def fill_with_medians(df: DataFrame, columns: Sequence[str], default: float = 0.0) -> DataFrame:
    """Replace NULL by the exact median of the column over all rows, else by ``default``."""
    med = ranks.column_medians(df, columns)
    wide = med.agg(*[F.max(F.when(F.col("feature") == c, F.col("median"))).alias(c) for c in columns])
    # one scalar subquery with all medians; one for each column would compute them all each time
    out = df.withColumn("_medians", wide.select(F.struct(*columns)).scalar())
    return out.withColumns({
        c: F.coalesce(F.col(c).cast("double"), F.col("_medians")[c], F.lit(default)) for c in columns}).drop("_medians")


def fill_series_with_medians(df: DataFrame, site: Sequence[str], columns: Sequence[str],
                             default: float = 0.0) -> DataFrame:
    """Replace NULL by the median of the column in the site's series, else by ``default``."""
    out = df.join(ranks.series_medians(df, site, columns), list(site), "left")
    return out.withColumns({
        c: F.coalesce(F.col(c).cast("double"), F.col(f"{c}_median"), F.lit(default)) for c in columns
    }).drop(*[f"{c}_median" for c in columns])


def bias_ratio(value: Column, raw: Column, limits: tuple[float, float] = fv.RATIO_LIMITS) -> Column:
    """value / raw within limits; NULL where the raw value is 0 or missing."""
    ratio = value / F.nullif(raw.cast("double"), F.lit(0.0))
    return F.when(ratio.isNotNull(), F.least(F.greatest(ratio, F.lit(limits[0])), F.lit(limits[1])))


def invert_ratio(raw: Column, predicted: Column, limits: tuple[float, float] = fv.RATIO_LIMITS) -> Column:
    """raw times the predicted ratio within limits."""
    inside = F.least(F.greatest(predicted, F.lit(limits[0])), F.lit(limits[1]))
    return F.when(predicted.isNotNull(), raw * inside)


def with_target(df: DataFrame, species: str, value: str = "value") -> tuple[DataFrame, str]:
    """Add the ratio target where the model has the species, else use the value itself."""
    raw = species_column([c for c in df.columns if c != value], species)
    if raw is None:
        return df, "absolute"
    out = df.withColumn("bias_ratio", bias_ratio(F.col(value), F.col(raw)))
    return out.where(F.col("bias_ratio").isNotNull()), "ratio"


def increment_target(value: Column, feature: Column, log: bool = False) -> Column:
    """value - feature, optionally as a logarithm (NULL where it has none)."""
    diff = value - feature
    return F.when(diff > 0, F.log(diff)) if log else diff


def invert_increment(predicted: Column, feature: Column, log: bool = False) -> Column:
    return (F.exp(predicted) if log else predicted) + feature


def feature_columns(df: DataFrame, skip: Sequence[str] = fv.NEVER_FEATURES) -> list[str]:
    """Numeric columns that may be features."""
    from .clean import numeric_columns
    return [c for c in numeric_columns(df) if c not in skip]
