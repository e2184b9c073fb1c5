"""Forecast evaluation with closed-form statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fv
from . import blocks, ranks


ONE = "_series"


def one_series(df: DataFrame) -> DataFrame:
    """Rows without a key as one series."""
    return df.withColumn(ONE, F.lit("all"))


def _d(c: str) -> Column:
    return F.col(c).cast("double")


def mse(actual: str, predicted: str) -> Column:
    return F.avg(F.pow(_d(actual) - _d(predicted), F.lit(2)))


def rmse(actual: str, predicted: str) -> Column:
    return F.sqrt(mse(actual, predicted))


def mae(actual: str, predicted: str) -> Column:
    return F.avg(F.abs(_d(actual) - _d(predicted)))


def r2(actual: str, predicted: str) -> Column:
    """1 - residual variance / variance of the actual values, over rows that have both."""
    both = F.when(F.col(predicted).isNotNull(), _d(actual))
    return 1 - mse(actual, predicted) / F.nullif(F.var_pop(both), F.lit(0.0))


def scores(df: DataFrame, keys: Sequence[str], actual: str, predicted: str) -> DataFrame:
    """R2, MSE, RMSE, MAE and row count per key."""
    both = df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    return both.groupBy(*keys).agg(
        r2(actual, predicted).alias("r2"), mse(actual, predicted).alias("mse"),
        rmse(actual, predicted).alias("rmse"), mae(actual, predicted).alias("mae"),
        F.count(F.lit(1)).alias("n"))


def train_test_scores(df: DataFrame, part: str, actual: str, predicted: str) -> DataFrame:
    """Rows ``(name, value)``: R2, MSE, MAE for training and test rows (``part`` = train/test)."""
    s = scores(df, [part], actual, predicted)
    label = F.when(F.col(part) == "train", F.lit("Training ")).otherwise(F.lit("Test "))
    long = s.select(label.alias("_p"), F.col("r2").alias("R2"), F.col("mse").alias("MSE"),
                    F.col("mae").alias("MAE")).unpivot(["_p"], ["R2", "MSE", "MAE"], "_s", "value")
    return long.select(F.concat("_p", "_s").alias("name"), "value")


def normalised_errors(df: DataFrame, keys: Sequence[str], actual: str, predicted: str) -> DataFrame:
    """nRMSE (RMSE / population standard deviation) and normalised mean bias."""
    both = df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    return both.groupBy(*keys).agg(
        (rmse(actual, predicted) / F.nullif(F.stddev_pop(_d(actual)), F.lit(0.0))).alias("nrmse"),
        (F.sum(_d(predicted) - _d(actual)) / F.nullif(F.sum(_d(actual)), F.lit(0.0))).alias("nmb"))


def rank_correlation(df: DataFrame, keys: Sequence[str], actual: str, predicted: str) -> DataFrame:
    """Spearman correlation with averaged ties."""
    ra = ranks.value_counts(df, keys, actual).select(*keys, actual, ranks.average_rank().alias("_ra"))
    rp = ranks.value_counts(df, keys, predicted).select(*keys, predicted, ranks.average_rank().alias("_rp"))
    both = df.join(ra, [*keys, actual]).join(rp, [*keys, predicted])
    return both.groupBy(*keys).agg(F.corr("_ra", "_rp").alias("spearman"))


def residual_autocorrelation(df: DataFrame, keys: Sequence[str], ts: str, actual: str, predicted: str) -> DataFrame:
    """Correlation of each residual with the next one in time."""
    res = df.select(*keys, ts, (_d(actual) - _d(predicted)).alias("_e"))
    res = blocks.row_index(res, keys, [ts], "_pos")
    res = blocks.with_trailing_frames(res, keys, "_pos", [(1, lambda w: {"_e0": F.lag("_e", 1).over(w)})])
    return res.groupBy(*keys).agg(F.corr("_e0", "_e").alias("autocorr"))


def evaluate(df: DataFrame, keys: Sequence[str], ts: str, actual: str, predicted: str) -> DataFrame:
    """Thirteen statistics per key as rows ``(keys..., Statistic, Value)``; without keys, of the one series there is."""
    keys = list(keys)
    if not keys:
        return evaluate(one_series(df), [ONE], ts, actual, predicted).drop(ONE)
    both = df.select(*keys, ts, _d(actual).alias(actual), _d(predicted).alias(predicted)).where(
        f"{actual} IS NOT NULL AND {predicted} IS NOT NULL AND NOT isnan({actual}) AND NOT isnan({predicted})")
    a, p = F.col(actual), F.col(predicted)
    e = a - p
    top = both.groupBy(*keys).agg(F.max(actual).alias("_top"))
    sized = both.join(top, keys)
    main = sized.groupBy(*keys).agg(
        F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"), F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.avg(F.abs(e / F.nullif(a, F.lit(0.0)))) * 100).alias("mape"),
        (F.avg((F.abs(e) <= 0.1 * F.col("_top")).cast("int")) * 100).alias("within"),
        F.corr(actual, predicted).alias("pearson"),
        (1 - F.avg(e * e) / F.nullif(F.var_pop(actual), F.lit(0.0))).alias("r2"),
        F.stddev_pop(e).alias("std"), F.avg(e).alias("bias"),
        F.avg(actual).alias("mean_actual"), F.avg(predicted).alias("mean_predicted"))
    wide = main.join(rank_correlation(both, keys, actual, predicted), keys, "left").join(
        residual_autocorrelation(both, keys, ts, actual, predicted), keys, "left")
    named = wide.select(*keys, *[F.col(c).alias(label) for c, label in fv.EVALUATION_NAMES])
    return named.unpivot(keys, [label for _, label in fv.EVALUATION_NAMES], "Statistic", "Value")


def recent_rows(df: DataFrame, site: Sequence[str], ts: str, now: Column, days: int = 90,
                minimum: int = 50) -> DataFrame:
    """Rows of the last ``days`` where a site has more than ``minimum`` of them, else all its rows."""
    if not site:
        return recent_rows(one_series(df), [ONE], ts, now, days, minimum).drop(ONE)
    recent = F.col(ts) >= now - F.make_dt_interval(F.lit(days))
    counts = df.groupBy(*site).agg(F.count_if(recent).alias("_n"))
    return df.join(counts, list(site)).where((F.col("_n") <= minimum) | recent).drop("_n")


def recent_validation(df: DataFrame, site: Sequence[str], ts: str, now: Column, actual: str, predicted: str,
                      days: int = 90, minimum: int = 50, poor: float = 0.5) -> DataFrame:
    """Scores on the recent window, flagged where R2 is below ``poor``."""
    s = scores(recent_rows(df, site, ts, now, days, minimum), site, actual, predicted)
    return s.withColumn("poor", F.col("r2") < poor)


def generalisation_gap(df: DataFrame, part: str, actual: str, predicted: str, keys: Sequence[str] = ()) -> DataFrame:
    """|train - test| of RMSE and R2."""
    s = scores(df, [*keys, part], actual, predicted)

    def of(label, c):
        return F.max(F.when(F.col(part) == label, F.col(c)))
    return s.groupBy(*keys).agg(
        F.abs(of("train", "rmse") - of("test", "rmse")).alias("rmse_gap"),
        F.abs(of("train", "r2") - of("test", "r2")).alias("r2_gap"))


def residuals(df: DataFrame, observed: str, predicted: str, name: str = "residual") -> DataFrame:
    """Observed minus predicted on rows that have both."""
    both = df.where(F.col(observed).isNotNull() & F.col(predicted).isNotNull())
    return both.withColumn(name, F.col(observed) - F.col(predicted))


def linear_fit(df: DataFrame, keys: Sequence[str], actual: str, predicted: str) -> DataFrame:
    """Slope and intercept of predicted on actual."""
    return df.groupBy(*keys).agg(
        F.regr_slope(predicted, actual).alias("slope"), F.regr_intercept(predicted, actual).alias("intercept"))


def compare_with_validation(main: DataFrame, other: DataFrame, site: Sequence[str], ts: str,
                            values: Sequence[str], other_values: Sequence[str],
                            first: int = 86400, second: int = 5 * 86400) -> DataFrame:
    """Outer join with an independent sensor, as daily and then five-day means."""
    from .align import resample_mean
    merged = main.select(*site, ts, *values).join(other.select(*site, ts, *other_values), [*site, ts], "full")
    cols = [*values, *other_values]
    return resample_mean(resample_mean(merged, site, ts, cols, first), site, ts, cols, second)
