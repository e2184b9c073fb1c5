"""Bias-correction models.

Two families, both fitted by distributed jobs:

* site models: one ridge regression per site (or per site and fold). Every Arrow batch is reduced
  to the sums the normal equations need, a few hundred numbers per site, which are then added
  up; the small systems are solved in Arrow batches. Leave-one-site-out, k-fold and expanding time
  validation reuse the same sums (all minus one part, or running totals), so no fold
  is fitted by another pass over the data.
* pooled models: gradient-boosted trees of Spark ML over all sites.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import linear
from ..session import cut_lineage, shared_folder
from . import evaluate, ranks

# ---- ridge regression from sums ------------------------------------------------------------


def product_sums(df: DataFrame, keys: Sequence[str], features: Sequence[str], target: str, weight: Column | None = None) -> DataFrame:
    """Sums of all products of (1, features, target) per key, as one array ``sums``; with ``weight`` every row counts that much.

    Each Arrow batch is reduced to one matrix per key before anything is shuffled, so a large
    site sends a few matrices instead of its rows. Rows with a missing feature or target do not take part.
    """
    keys = list(keys)
    names = [f"_x{i}" for i in range(len(features) + 1)]
    rows = df.select(
        *keys, *[F.col(c).cast("double").alias(n) for c, n in zip([*features, target], names)],
        *([weight.cast("double").alias("_w")] if weight is not None else []))
    reduce_batches = linear.batch_reducer(keys, names, None if weight is None else "_w")
    kinds = ", ".join(f"`{k}` {t}" for k, t in rows.select(*keys).dtypes)
    partial = rows.mapInPandas(reduce_batches, f"{kinds}, part ARRAY<DOUBLE>")
    total = Summarizer.sum(array_to_vector("part"))
    return partial.groupBy(*keys).agg(vector_to_array(total).alias("sums"))


def _coefficients(sums: DataFrame, keys: Sequence[str], n_features: int, ridge: float, least: float = 0.5) -> DataFrame:
    solve = F.pandas_udf(linear.ridge_solver(n_features, ridge), "array<double>")
    n = F.get("sums", F.lit(0))
    return sums.where(n > least).select(*keys, F.round(n).cast("bigint").alias("n_train"), solve("sums").alias("coef"))


def fit_sites(df: DataFrame, keys: Sequence[str], features: Sequence[str], target: str,
              ridge: float = 1e-6) -> DataFrame:
    """One model per key: ``(keys..., n_train, coef)`` with the intercept first."""
    return _coefficients(product_sums(df, keys, features, target), keys, len(features), ridge)


def linear_prediction(features: Sequence[str], coef: str = "coef") -> Column:
    """Value of the model in ``coef``; a missing feature counts as 0."""
    terms = [f"{coef}[{i + 1}] * coalesce(CAST(`{f}` AS DOUBLE), 0D)" for i, f in enumerate(features)]
    return F.expr(" + ".join([f"{coef}[0]", *terms]))


def predict_sites(df: DataFrame, models: DataFrame, keys: Sequence[str], features: Sequence[str],
                  name: str = "prediction") -> DataFrame:
    """Apply each key's model; rows of a key without a model get NULL."""
    out = df.join(models.select(*keys, "coef"), list(keys), "left")
    return out.withColumn(name, linear_prediction(features)).drop("coef")


def cross_validate(df: DataFrame, site: Sequence[str], fold: str, features: Sequence[str], target: str,
                   scheme: str, ridge: float = 1e-6, name: str = "prediction") -> DataFrame:
    """Out-of-fold predictions of site models.

    ``scheme``: ``"kfold"`` trains on all other folds of the site, ``"expanding"`` on all
    earlier folds of the site, ``"leave_out"`` on every row outside the group in ``fold``
    (``site`` empty: for instance fold = site code for leave-one-site-out).
    """
    site = list(site)
    by_fold = product_sums(df, [*site, fold], features, target)
    if scheme == "expanding":
        # at most one matrix per fold of a site is listed here
        before = Window.partitionBy(*site).orderBy(fold).rowsBetween(Window.unboundedPreceding, -1)
        earlier = by_fold.withColumn("_e", F.collect_list("sums").over(before)).where(F.size("_e") > 0)
        added = F.aggregate(F.slice("_e", 2, F.size("_e")), F.get("_e", F.lit(0)),
                            lambda acc, x: F.zip_with(acc, x, lambda a, b: a + b))
        train = earlier.select(*site, fold, added.alias("sums"))
    elif scheme in ("kfold", "leave_out"):
        on = site or ["_all"]
        parts = by_fold if site else by_fold.withColumn("_all", F.lit(0))
        total = parts.groupBy(*on).agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("_total"))
        rest = F.zip_with("_total", "sums", lambda a, b: a - b)
        train = parts.join(total, on).select(*site, fold, rest.alias("sums"))
    else:
        raise ValueError(f"unknown scheme {scheme!r}")
    fitted = _coefficients(train, [*site, fold], len(features), ridge)
    return predict_sites(df, fitted, [*site, fold], features, name)


def fold_scores(predicted: DataFrame, keys: Sequence[str], fold: str, actual: str, prediction: str,
                min_rows: int = 1) -> DataFrame:
    """Mean over folds of RMSE, R2 and MAE; folds below ``min_rows`` are skipped."""
    per_fold = evaluate.scores(predicted, [*keys, fold], actual, prediction).where(F.col("n") >= min_rows)
    return per_fold.groupBy(*keys).agg(
        F.avg("rmse").alias("cv_rmse"), F.avg("r2").alias("cv_r2"), F.avg("mae").alias("cv_mae"),
        F.count(F.lit(1)).alias("n_folds"))


# ---- pooled trees --------------------------------------------------------------------------

POOLED_TREES = {"maxIter": 300, "maxDepth": 8, "stepSize": 0.02, "subsamplingRate": 0.8}


#: Rows of a partition that trees learn from: every level of a tree is a job, so small tables go into few tasks.
TREE_ROWS = 200_000


def tree_pipeline(features: Sequence[str], target: str, prediction: str = "prediction", seed: int = 42, **params) -> Pipeline:
    """Assembler plus gradient-boosted trees. Rows with a missing feature are skipped in training."""
    trees = GBTRegressor(featuresCol="_features", labelCol=target, predictionCol=prediction, seed=seed, minInstancesPerNode=20,
                         featureSubsetStrategy="0.8", checkpointInterval=20, **params)
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="skip"), trees])


def fit_trees(df: DataFrame, features: Sequence[str], target: str, prediction: str = "prediction", seed: int = 42,
              **params) -> PipelineModel:
    """Fit pooled trees on partitions sized to the rows. Errors are checkpointed in the shared folder as trees are added."""
    df.sparkSession.sparkContext.setCheckpointDir(shared_folder(df.sparkSession))
    cols = list(dict.fromkeys([*features, target]))
    data = df.select(*[F.col(c).cast("double") for c in cols]).na.drop()
    data = data.coalesce(max(1, math.ceil(data.count() / TREE_ROWS)))
    return tree_pipeline(features, target, prediction, seed, **(params or POOLED_TREES)).fit(data)


def fit_together(spark, fits: Sequence[Callable[[], PipelineModel]], parallelism: int = 4) -> list[PipelineModel]:
    """Results of independent fits, several at a time: their jobs share the cluster, so short jobs of one fill the gaps of another."""
    with ThreadPool(min(parallelism, max(1, len(fits)))) as pool:
        return pool.map(inheritable_thread_target(spark)(lambda fit: fit()), fits)


def model_features(model: PipelineModel) -> list[str]:
    return model.stages[0].getInputCols()


def predict_trees(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Apply a pooled model; features the table lacks, or that are NULL, count as 0."""
    wanted = model_features(model)
    filled = df.withColumns({
        f"_f_{c}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in df.columns else F.lit(0.0) for c in wanted})
    stage = model.stages[0].copy()
    stage.setInputCols([f"_f_{c}" for c in wanted])
    out = model.stages[1].transform(stage.transform(filled))
    return out.drop("_features", *[f"_f_{c}" for c in wanted])


def importances(model: PipelineModel, spark) -> DataFrame:
    """Rows ``(feature, importance)``: the share of the trees' error reduction."""
    weights = model.stages[1].featureImportances.toArray()
    rows = [(f, float(w)) for f, w in zip(model_features(model), weights)]
    return spark.createDataFrame(rows, "feature STRING, importance DOUBLE")


# ---- selection and intervals ---------------------------------------------------------------

def champion(df: DataFrame, metrics: DataFrame, site: Sequence[str], local: str, pooled: str, score: str = "cv_r2",
             threshold: float = 0.5, name: str = "localised") -> DataFrame:
    """Site model where its score reaches ``threshold``, else (or without a score) the pooled model."""
    out = df.join(metrics.select(*site, score), list(site), "left")
    good = F.coalesce(F.col(score) >= threshold, F.lit(False))
    return out.withColumns({
        name: F.when(good, F.col(local)).otherwise(F.col(pooled)),
        "model_source": F.when(good, F.lit("local")).otherwise(F.lit("global")),
    })


def residual_intervals(df: DataFrame, site: Sequence[str], actual: str, prediction: str, lower: float = 0.15,
                       upper: float = 0.85) -> DataFrame:
    """Add ``lower``, ``mid``, ``upper``: the prediction plus quantiles of the site's residuals."""
    res = df.select(*site, (F.col(actual) - F.col(prediction)).alias("_res"))
    q = ranks.quantiles(res, site, "_res", {"_lo": lower, "_md": 0.5, "_hi": upper}).drop("n")
    out = df.join(q, list(site), "left")
    return out.withColumns({
        "lower": F.col(prediction) + F.col("_lo"), "mid": F.col(prediction) + F.col("_md"),
        "upper": F.col(prediction) + F.col("_hi")}).drop("_lo", "_md", "_hi")


def transfer_sites(df: DataFrame, site: Sequence[str], ts: str, border: Column, features: Sequence[str], target: str, trust: float = 0.1,
                   min_first: int = 100, min_second: int = 50, ridge: float = 1e-3) -> DataFrame:
    """One ridge per site that learnt the rows before ``border`` and is moved to those from ``border`` on: (site, n_old, n_new, tuned, n_train, coef).

    The old period's product matrix, times ``trust``, is the prior precision of the new period's coefficients, so they shrink towards the
    old ones most where the old rows say most. Both periods' matrices come from one pass. A site with fewer than ``min_first`` old rows has all
    its rows as base; with fewer than ``min_second`` new rows the base model stays as it is. Both gates count the site's own complete rows.
    """
    site = list(site)
    parts = product_sums(df.withColumn("_new", F.col(ts) >= border), [*site, "_new"], features, target)
    size = (len(features) + 2) ** 2
    none = F.array_repeat(F.lit(0.0), size)
    sides = parts.groupBy(*site).agg(F.max(F.when(~F.col("_new"), F.col("sums"))).alias("_o"), F.max(F.when(F.col("_new"), F.col("sums"))).alias("_n"))
    sides = sides.withColumns({"_o": F.coalesce("_o", none), "_n": F.coalesce("_n", none)})
    n_old, n_new = (F.round(F.get(c, F.lit(0))).cast("bigint") for c in ("_o", "_n"))
    sides = sides.withColumns({"n_old": n_old, "n_new": n_new, "tuned": n_new >= min_second})
    base = F.when(F.col("n_old") >= min_first, F.col("_o")).otherwise(F.zip_with("_o", "_n", lambda a, b: a + b))
    sides = sides.withColumn("_base", base)
    both = F.zip_with("_base", "_n", lambda a, b: a * F.lit(trust) + b)
    sums = sides.withColumn("sums", F.when(F.col("tuned"), both).otherwise(F.col("_base")))
    keep = [*site, "n_old", "n_new", "tuned"]
    return _coefficients(sums.select(*keep, "sums"), keep, len(features), ridge, least=0.0)


def pinball_sites(df: DataFrame, site: Sequence[str], features: Sequence[str], target: str, taus: Sequence[float], passes: int = 25,
                  ridge: float = 1e-6, near: float = 1e-3) -> DataFrame:
    """(site, tau, coef): one linear quantile regression per site and quantile, by reweighted sums.

    Each pass weights a row by tau or 1 - tau over its distance from the last pass's quantile (at least ``near`` of the site's spread) and
    solves the weighted normal equations, which lowers the pinball loss from pass to pass. All quantiles of all sites share a pass.
    Rows with a missing value do not take part.
    """
    site = list(site)
    cols = [F.col(c).cast("double").alias(c) for c in dict.fromkeys([*features, target])]
    rows = cut_lineage(df.select(*site, *cols).na.drop(), "pinball-rows")
    spread = rows.groupBy(*site).agg(F.greatest(F.stddev_pop(target), F.lit(1e-12)).alias("_s"))
    levels = F.explode(F.array(*[F.lit(float(t)) for t in taus])).alias("tau")
    state = fit_sites(rows, site, features, target, ridge).join(spread, site).select(*site, "_s", "coef", levels)
    for _ in range(passes):
        state = cut_lineage(state.select(*site, "tau", "_s", "coef"), "pinball-state")
        off = F.col(target) - linear_prediction(features)
        weight = F.when(off >= 0, F.col("tau")).otherwise(1 - F.col("tau")) * F.col("_s") * near / F.greatest(F.abs(off), F.col("_s") * near)
        sums = product_sums(rows.join(state, site), [*site, "tau"], features, target, weight)
        state = _coefficients(sums, [*site, "tau"], len(features), ridge, least=0.0).drop("n_train").join(state.drop("coef"), [*site, "tau"])
    return cut_lineage(state.select(*site, "tau", "coef"), "pinball")


def quantile_predictions(df: DataFrame, models: DataFrame, site: Sequence[str], features: Sequence[str], names: dict[str, float]) -> DataFrame:
    """One column per quantile, in the order of ``names``; a row's predictions are sorted, so they never cross."""
    site, found = list(site), [f"_q{i}" for i in range(len(names))]
    wide = models.groupBy(*site).agg(*[F.max(F.when(F.col("tau") == t, F.col("coef"))).alias(q) for q, t in zip(found, names.values())])
    out = df.join(wide, site, "left")
    ordered = F.array_sort(F.array(*[linear_prediction(features, q) for q in found]))
    return out.withColumn("_all", ordered).withColumns({n: F.get("_all", F.lit(i)) for i, n in enumerate(names)}).drop("_all", *found)


# ---- persistence ---------------------------------------------------------------------------

def save_trees(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_trees(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_site_models(models: DataFrame, features: Sequence[str], target_mode: str, path: str, saved_at: Column | None = None) -> None:
    """Coefficients with the feature names and target mode they belong to, and when they were saved."""
    names = F.array(*[F.lit(f) for f in features])
    at = (F.current_timestamp() if saved_at is None else saved_at).cast("timestamp")
    models.withColumns({"features": names, "target": F.lit(target_mode), "saved_at": at}).write.mode("overwrite").parquet(path)


def load_site_models(spark, path: str, now: Column | None = None, max_days: int | None = None) -> DataFrame:
    """Saved site models; with ``max_days`` only those not older than that, the others have to be trained anew."""
    out = spark.read.parquet(path)
    now = (F.current_timestamp() if now is None else now).cast("timestamp")
    return out if max_days is None else out.where(F.col("saved_at") >= now - F.make_dt_interval(F.lit(max_days)))
