"""Training one model over all sites."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as fv
from ..operators import aggregates, blocks, clean, evaluate, features as feat, folds, joins, models, outliers, windows
from ..session import cut_lineage
from .forecasts import back_to_value


@dataclass
class PooledModel:
    model: PipelineModel
    features: list[str]
    target: str
    site_scores: DataFrame
    scores: DataFrame
    log: DataFrame


def training_pool(sites: DataFrame, obs: DataFrame, model: DataFrame, site: str, ts: str, species: str, min_overlap: int = 20,
                  remove_outliers: bool = True, contamination: float = 0.02) -> tuple[DataFrame, DataFrame, str]:
    """All sites' training rows stacked, and a log that says per site why it is in or not.

    ``sites`` has the site column and ``lat, lon``; ``obs`` may hold NULL values.
    """
    valid = obs.where(F.col("value").isNotNull())
    merged = joins.model_with_observations(model, valid.select(site, ts, "value"), [site, ts], "value")
    pool = clean.enough_rows(merged, [site], min_overlap)
    pool = feat.atmospheric_features(pool, [site], ts, species)
    pool, mode = feat.with_target(pool, species)
    target = "bias_ratio" if mode == "ratio" else "value"
    if remove_outliers:
        pool = cut_lineage(pool, "pool-features")
        pool = outliers.drop_most_isolated(pool, [site], target, contamination)
    pool = cut_lineage(pool.withColumnRenamed(site, "_site").withColumnRenamed(ts, "time"), "pool")

    def count(df, name, key=site):
        return df.groupBy(F.col(key).alias(site)).agg(F.count(F.lit(1)).alias(name))
    facts = count(obs, "n_obs").join(count(valid, "n_valid"), site, "left").join(count(model, "n_model"), site, "full") \
        .join(count(merged, "n_overlap"), site, "left").join(count(pool, "n_pool", "_site"), site, "left")
    rules = [
        ("no_obs", F.col("n_obs").isNull()), ("all_nan", F.col("n_valid").isNull()),
        ("no_coords", F.col("lat").isNull() | F.col("lon").isNull()), ("no_model", F.col("n_model").isNull()),
        ("too_few_rows", F.coalesce(F.col("n_overlap"), F.lit(0)) < min_overlap),
    ]
    log = aggregates.run_log(sites, facts, [site], rules, "n_pool")
    return pool, log.withColumn("n_rows", F.when(F.col("status") == "ok", F.col("n_rows")).otherwise(0)), mode


def train_pooled(pool: DataFrame, log: DataFrame, mode: str, species: str, min_site_rows: int = 10, n_folds: int = 3,
                 **trees) -> PooledModel:
    """Pooled trees on all rows, scored per site by trees that never saw the site.

    Sites are packed into ``n_folds`` folds by rows; the trees of a fold learn from all other folds. The fits run side by side.
    """
    target = "bias_ratio" if mode == "ratio" else "value"
    raw = feat.species_column([c for c in pool.columns if c != "value"], species)
    names = feat.feature_columns(pool, fv.NEVER_FEATURES)
    rows = cut_lineage(folds.grouped_folds(clean.finite_target(pool, target), "_site", n_folds), "grouped-folds")
    used = sorted(r["fold"] for r in rows.select("fold").distinct().collect())
    tested = [k for k in used if len(used) > 1]
    fits = [lambda k=k: models.fit_trees(rows.where(F.col("fold") != k), names, target, **trees) for k in tested]
    *by_fold, model = models.fit_together(pool.sparkSession, [*fits, lambda: models.fit_trees(rows, names, target, **trees)], n_folds + 1)
    held_out = rows.select("_site", "fold", "value").withColumn("prediction", F.lit(None).cast("double")).limit(0)
    for k, fitted in zip(tested, by_fold):
        part = models.predict_trees(fitted, rows.where(F.col("fold") == k)).withColumn("prediction", back_to_value(mode, raw, "prediction"))
        held_out = held_out.unionByName(part.select("_site", "fold", "value", "prediction"))
    held_out = cut_lineage(held_out, "held-out")
    per_site = evaluate.scores(held_out, ["_site", "fold"], "value", "prediction").where(F.col("n") >= min_site_rows)
    fitted = models.predict_trees(model, rows).withColumn("prediction", back_to_value(mode, raw, "prediction"))
    fitted = cut_lineage(fitted.select("value", "prediction"), "fitted")
    overall = per_site.agg(F.avg("rmse").alias("cv_rmse"), F.avg("r2").alias("cv_r2"), F.avg("mae").alias("cv_mae"),
                           F.count(F.lit(1)).alias("n_sites"))
    train = evaluate.scores(fitted, [], "value", "prediction").select(F.col("r2").alias("train_r2"), F.col("n").alias("n_train"))
    scores = overall.withColumns({c: train.select(c).scalar() for c in ("train_r2", "n_train")})
    return PooledModel(model, names, mode, per_site, scores, log)


def train_from_pool(pool: DataFrame, target: str = "value", site: str = "_site", ts: str = "time", max_rows: int | None = None,
                    n_splits: int = 3, base: Sequence[str] = tuple(fv.POOLED_FEATURES), seed: int = 42,
                    **trees) -> tuple[PipelineModel, DataFrame, list[str]]:
    """Trainer on a saved pool: lags, imputation, five-sigma filter, hold-out split, k folds, final fit. Returns model, scores and features.

    ``max_rows`` bounds the rows that a fit learns from, by proportional sampling of the training part; lags, medians, filter
    and scores always come from all rows. None learns from all of them.
    """
    rows = pool.where(F.col(target).isNotNull() & F.col(ts).isNotNull())
    rows = rows.withColumns(feat.cyclic(F.col(ts), 365.0)).drop("weekday", "is_weekend")
    rows = blocks.row_index(rows, [site], [ts], "_pos")

    def build(w):
        return {**windows.lag_stage(target, (6, 12, 24), "lag{}h")[1](w),
                **windows.rolling_stage(target, (6, 12), "roll_mean_{}h")[1](w)}
    rows = blocks.with_trailing_frames(rows, [site], "_pos", [(24, build)]).drop("_pos")
    lagged = [f"{target}_lag{k}h" for k in (6, 12, 24)] + [f"{target}_roll_mean_{k}h" for k in (6, 12)]
    names = [c for c in [*base, "hour_sin", "hour_cos", "doy_sin", "doy_cos", *lagged] if c in rows.columns]
    rows = feat.fill_with_medians(rows, names)
    rows = outliers.within_sigma(rows, [], target, 5.0)
    rows = folds.train_test(rows, [site, ts], 0.15, seed)
    rows = cut_lineage(folds.shuffled_folds(rows, [site, ts], n_splits, seed), "pooled-training")
    train = rows.where("part = 'train'")
    learn = cut_lineage(folds.site_quota(train, site, [site, ts], max_rows, seed), "pooled-learning") if max_rows else train

    fits = [lambda k=k: models.fit_trees(learn.where(F.col("fold") != k), names, target, seed=seed, **trees) for k in range(n_splits)]
    *by_fold, model = models.fit_together(pool.sparkSession, [*fits, lambda: models.fit_trees(learn, names, target, seed=seed, **trees)])
    per_fold = None
    for k, fold_model in enumerate(by_fold):
        part = models.predict_trees(fold_model, train.where(F.col("fold") == k)).select(target, "prediction", "fold")
        per_fold = part if per_fold is None else per_fold.unionByName(part)
    cv = evaluate.scores(per_fold, ["fold"], target, "prediction").agg(
        F.avg("r2").alias("cv_r2"), F.avg("rmse").alias("cv_rmse"), F.avg("mae").alias("cv_mae"))
    parts = evaluate.scores(models.predict_trees(model, rows), ["part"], target, "prediction")
    scores = parts.withColumns({c: cv.select(c).scalar() for c in cv.columns})
    return model, scores, names
