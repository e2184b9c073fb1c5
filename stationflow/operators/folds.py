"""Train/test splits and cross-validation folds as columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from . import blocks, ranks


def _hash_share(keys: Sequence[str], seed: int) -> Column:
    """Number in [0, 1) that depends on the text of the key columns alone, so reruns, and other engines, split alike."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def train_test(df: DataFrame, keys: Sequence[str], test_share: float = 0.3, seed: int = 7,
               name: str = "part") -> DataFrame:
    """Add ``part`` = train / test by a hash of the row's key."""
    return df.withColumn(name, F.when(_hash_share(keys, seed) < test_share, "test").otherwise("train"))


def shuffled_folds(df: DataFrame, keys: Sequence[str], n: Column | int = 3, seed: int = 42,
                   name: str = "fold") -> DataFrame:
    """Add a fold number 0..n-1 by a hash of the row's key."""
    n = F.lit(n) if isinstance(n, int) else n
    return df.withColumn(name, F.floor(_hash_share(keys, seed) * n).cast("int"))


def grouped_folds(df: DataFrame, site: str, n: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """Add a fold 0..n-1 that all rows of a site share: sites are dealt out by rows, largest first, to and fro over the folds.

    Sites of equal size stand in the order of a hash. Only (site, rows) is ranked, so no site is held anywhere as a whole.
    """
    sizes = df.groupBy(site).agg(F.count(F.lit(1)).alias("_n"))
    order = ranks.value_counts(sizes, [], "_n").select(F.col("_n").cast("bigint").alias("_n"), "n_equal", (F.col("n_all") - F.col("n_upto")).alias("_larger"))
    place = F.col("_larger") + F.floor(_hash_share([site], seed) * F.col("n_equal"))
    turn = (place % (2 * n)).cast("int")
    dealt = sizes.join(order, "_n").select(site, F.when(turn < n, turn).otherwise(2 * n - 1 - turn).alias(name))
    return df.join(dealt, site)


def fold_count(rows: Column, per_fold: int, most: int) -> Column:
    """min(most, max(2, rows / per_fold))."""
    return F.least(F.lit(most), F.greatest(F.lit(2), F.floor(rows / per_fold))).cast("int")


def expanding_folds(df: DataFrame, site: Sequence[str], ts: str, rows_per_fold: int = 500, most: int = 5,
                    name: str = "fold") -> DataFrame:
    """Add ``fold`` and ``n_folds`` for expanding time-series validation per site.

    With k folds every test fold has n // (k + 1) rows; the rows before the first test fold
    are fold 0. Fold i is tested with a model trained on folds 0..i-1.
    """
    counts = df.groupBy(*site).agg(F.count(F.lit(1)).alias("_n"))
    out = blocks.row_index(df, site, [ts], "_at").join(counts, list(site))
    out = out.withColumn("n_folds", fold_count(F.col("_n"), rows_per_fold, most))
    size = F.greatest(F.floor(F.col("_n") / (F.col("n_folds") + 1)), F.lit(1))
    start = F.col("_n") - F.col("n_folds") * size
    fold = F.when(F.col("_at") <= start, F.lit(0)).otherwise(F.floor((F.col("_at") - start - 1) / size) + 1)
    return out.withColumn(name, fold.cast("int")).drop("_n", "_at")


def site_quota(df: DataFrame, site: str, keys: Sequence[str], max_rows: int, seed: int = 42) -> DataFrame:
    """Sampling operator of the pooled trainer: about ``max_rows`` rows, proportional per site.

    Every row draws a hash share and stays if it is below max_rows / all rows; a site always
    keeps at least its row with the lowest share. No row is ordered against another.
    """
    counts = df.groupBy(site).agg(F.count(F.lit(1)).alias("_n"), F.min(_hash_share(keys, seed)).alias("_low"))
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    share = F.least(F.lit(float(max_rows)) / F.nullif(total, F.lit(0)), F.lit(1.0))
    out = df.join(counts, site).withColumn("_h", _hash_share(keys, seed))
    return out.where((F.col("_h") < share) | (F.col("_h") == F.col("_low"))).drop("_n", "_low", "_h")
