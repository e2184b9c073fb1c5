"""Forecast chains: station forecast with model fill, site bias correction, publishing."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fv
from ..functions import times as t
from ..operators import aggregates, align, clean, evaluate, features as feat, folds, joins, models, outliers, ranks, windows
from ..session import cut_lineage
from .series import combine_versions

SPECIES = {"PM2.5": "pm25_rh35", "NO2": "no2", "O3": "o3"}
CORE_COLUMNS = ["pm25_rh35", "no2", "o3", "t", "rh"]


def station_forecast(stations: DataFrame, model: DataFrame, site: Sequence[str], ts: str,
                     labels: tuple[str, str], avg_hours: dict[str, int] | None = None) -> DataFrame:
    """Hourly forecast per site from three-hour station slots, gaps filled from the model.

    ``stations``: slot rows already matched to sites, with ``pm25_conc_cnn``, ``pm25_aqi`` and
    others; ``model``: hourly rows. Slots cover three hours; hours without any core value are
    dropped; index columns are computed and fill the missing station index.
    """
    slots = align.round_and_dedup(stations, site, ts, 3)
    numeric = [c for c in clean.numeric_columns(slots) if c not in (*site, ts)]
    hourly = align.regular_calendar(slots.select(*site, ts, *numeric), site, ts, 3600, pad_seconds=2 * 3600)
    hourly = align.forward_fill(hourly, site, ts, numeric, 2)
    mod_cols = [c for c in clean.numeric_columns(model) if c not in (*site, ts, "lat", "lon")]
    merged = hourly.join(model.select(*site, ts, *mod_cols), [*site, ts], "full")
    merged = align.resample_mean(merged, site, ts, [*numeric, *mod_cols], 3600)
    merged = clean.any_present(merged, [*CORE_COLUMNS, "pm25_conc_cnn"])
    if "pm25_rh35" in merged.columns:
        merged = align.fill_from_second(merged, "pm25_conc_cnn", "pm25_rh35", "pm25source", labels)
    merged = windows.add_indices(merged, site, ts, SPECIES, avg_hours or {"NO2": 3, "O3": 1}, by="rows")
    if "pm25_aqi" in merged.columns and "PM25_NowCast_AQI" in merged.columns:
        merged = align.fill_index(merged, "pm25_aqi", "PM25_NowCast_AQI")
    return windows.add_overall_index(merged)


@dataclass
class SiteForecast:
    """Result of :func:`site_forecast`: predicted rows, scores per site, coefficients."""

    rows: DataFrame
    scores: DataFrame
    models: DataFrame
    features: list[str]


def training_rows(model: DataFrame, obs: DataFrame, site: Sequence[str], ts: str, species: str,
                  remove_outliers: bool = True, contamination: float = 0.02, min_rows: int = 50) -> tuple[DataFrame, str]:
    """Model hours with an observation, features, target; sites below ``min_rows`` are left out."""
    merged = joins.model_with_observations(model, obs.select(*site, ts, "value"), [*site, ts], "value")
    merged = clean.enough_rows(merged, site, min_rows)
    merged = feat.atmospheric_features(merged, site, ts, species)
    merged, mode = feat.with_target(merged, species)
    target = "bias_ratio" if mode == "ratio" else "value"
    if remove_outliers:
        merged = cut_lineage(merged, "features")
        merged = outliers.drop_most_isolated(merged, site, target, contamination)
    return clean.finite_target(merged, target), mode


def site_forecast(model: DataFrame, obs: DataFrame, site: Sequence[str], ts: str, species: str,
                  older: DataFrame | None = None, remove_outliers: bool = True, fill_limit: int = 6,
                  scheme: str = "expanding", ridge: float = 1e-3) -> SiteForecast:
    """Bias-corrected series of every site: train, validate over time folds, predict, attach observations.

    Feature tables are written to the shared folder: fold sums, final fit, scores and the gap
    filling all read them, and a lost executor does not recompute them.
    """
    if older is not None:
        model = combine_versions(older, model, site, ts)
    train, mode = training_rows(model, obs, site, ts, species, remove_outliers)
    train = cut_lineage(train, "training")
    target = "bias_ratio" if mode == "ratio" else "value"
    raw = feat.species_column(model.columns, species)
    names = [c for c in feat.feature_columns(train, [*fv.NEVER_FEATURES, *site, ts])]
    fitted = cut_lineage(models.fit_sites(train, site, names, target, ridge), "site-models")

    if scheme == "expanding":
        folded = folds.expanding_folds(train, site, ts)
        tested = models.cross_validate(folded, site, "fold", names, target, "expanding", ridge).where("fold > 0")
    else:
        counted = train.groupBy(*site).agg(F.count(F.lit(1)).alias("_n"))
        n = folds.fold_count(F.col("_n"), 300, 3)
        folded = folds.shuffled_folds(train.join(counted, list(site)), [*site, ts], n).drop("_n")
        tested = models.cross_validate(folded, site, "fold", names, target, "kfold", ridge)
    tested = tested.withColumn("prediction", back_to_value(mode, raw, "prediction"))
    tested = cut_lineage(tested.select(*site, ts, "fold", "value", "prediction"), "held-out")
    scores = cut_lineage(models.fold_scores(tested, site, "fold", "value", "prediction"), "site-scores")

    # engineered columns have no gaps left; only the model's own columns need carrying
    ready = cut_lineage(feat.atmospheric_features(model, site, ts, species), "prediction-features")
    own = [c for c in names if c in model.columns]
    ready = cut_lineage(align.fill_all(ready, site, ts, own, ranks.series_medians(ready, site, own)), "filled")
    out = models.predict_sites(ready, fitted, site, names, "localised")
    out = cut_lineage(out.withColumn("localised", back_to_value(mode, raw, "localised")), "predicted")
    out = align.interpolate_rows(out, site, ts, "localised", fill_limit)
    out = joins.attach_observations(out, obs.select(*site, ts, "value"), [*site, ts])
    return SiteForecast(windows.add_overall_index(out), scores, fitted, names)


def back_to_value(mode: str, raw: str | None, prediction: str) -> Column:
    """Prediction in units of the observation."""
    if mode == "ratio" and raw:
        return feat.invert_ratio(F.col(raw), F.col(prediction))
    return F.col(prediction)


def champion_forecast(model: DataFrame, obs: DataFrame, site: Sequence[str], ts: str, species: str,
                      pooled: PipelineModel, pooled_mode: str = "absolute", threshold: float = 0.5,
                      fill_limit: int = 6) -> SiteForecast:
    """Site model where its k-fold R2 reaches ``threshold``, else the pooled model."""
    local = site_forecast(model, obs, site, ts, species, scheme="kfold", fill_limit=fill_limit)
    raw = feat.species_column(model.columns, species)
    rows = models.predict_trees(pooled, local.rows.withColumnRenamed("localised", "_local"))
    rows = rows.withColumn("_pooled", back_to_value(pooled_mode, raw, "prediction")).drop("prediction")
    rows = models.champion(rows, local.scores, site, "_local", "_pooled", threshold=threshold)
    return SiteForecast(rows.drop("_local", "_pooled"), local.scores, local.models, local.features)


def two_stage_forecast(old: DataFrame, new: DataFrame, obs: DataFrame, site: Sequence[str], ts: str, species: str,
                       now: Column, contamination: float = 0.05, resample: int = 3600, fill_limit: int = 12,
                       threshold: float = 0.1, keep_all: bool = False, trust: float = 0.1, test_share: float = 0.3) -> tuple[DataFrame, DataFrame]:
    """Base model of every site on the old version's period, moved to the last 60 days; predictions and scores of held-out rows.

    Old version up to 60 days ago, new version from then on; observations are interpolated in time while merging. A hash of the row's key holds out
    ``test_share`` of the rows before anything is learnt: outlier filter, feature pick by correlation, gates and fit (:func:`models.transfer_sites`) see
    the other rows only. Without a feature above ``threshold`` there is no model, unless ``keep_all`` asks for all features then. The final
    observation gaps are filled up to ``fill_limit`` hours.
    """
    from ..operators.setops import hand_over
    from .series import merge_series
    border = now - F.make_dt_interval(F.lit(60))
    model = hand_over(clean.harmonise_names(old), clean.harmonise_names(new), [*site, ts], ts, border)
    merged = merge_series(model, obs.select(*site, ts, "value"), site, ts)
    known = clean.finite_target(merged.where(F.col("value").isNotNull()), "value")
    split = cut_lineage(folds.train_test(known, [*site, ts], test_share), "two-stage")
    train = cut_lineage(outliers.drop_most_isolated(split.where("part = 'train'").drop("part"), site, "value", contamination), "two-stage-training")
    candidates = feat.feature_columns(train, [*fv.NEVER_FEATURES, *site, ts])
    picked = [r["feature"] for r in aggregates.pick_features(train, "value", candidates, threshold=threshold).collect()]
    if not picked and keep_all:
        picked = candidates
    if not picked:
        raise ValueError(f"no feature has a correlation of {threshold} with the target")
    fitted = cut_lineage(models.transfer_sites(train, site, ts, border, picked, "value", trust), "two-stage-models")
    tested = models.predict_sites(split.where("part = 'test'"), fitted, site, picked)
    scores = evaluate.recent_validation(tested, site, ts, now, "value", "prediction")

    out = models.predict_sites(clean.any_present(model, picked), fitted, site, picked, "localised")
    values = [c for c in clean.numeric_columns(out) if c not in (*site, ts)]
    hourly = obs.select(*site, t.hour_floor(F.col(ts)).alias(ts), "value")
    both = joins.merge_and_resample([out.select(*site, ts, *values), hourly], site, ts, [*values, "value"], resample)
    both = align.interpolate_time_limited(both, site, ts, "value", fill_limit)
    return clean.ensure_columns(both, ["no2", "localised", "o3", "pm25_rh35_gcc", "rh", "t10m", "tprec", "hcho", "value"]), scores


def published_rows(rows: DataFrame, site: str, ts: str, tz: str, observed: str, months: int = 12) -> DataFrame:
    """Last year of a corrected series, cleaned, rounded, with local time and index columns."""
    keep = [site, tz, ts, "no2", "localised", "value", "o3", "pm25_rh35", "rh", "t", "tprec", "hcho"]
    from ..operators.setops import keep_first
    unique = keep_first(clean.keep_listed(rows, keep), [site, ts], [])
    recent = clean.last_months(_publish(unique, site, tz, ts, keep, observed), [site], ts, months)
    local = align.add_local_time(recent, ts, tz)
    if tz != "timezone":
        local = local.drop(tz)
    out = windows.add_indices(local, [site], ts, {"PM2.5": "pm25_rh35", "NO2": "corrected", "O3": "o3"},
                              {"NO2": 3, "O3": 1}, by="rows")
    return windows.add_overall_index(out)


def _publish(rows: DataFrame, site: str, tz: str, ts: str, keep: Sequence[str], observed: str) -> DataFrame:
    # the site key may be numeric and must not be clipped or rounded
    keyed = rows.withColumn("_key", F.struct(site, tz))
    wanted = ["_key", *[c for c in keep if c not in (site, tz)]]
    out = clean.publish_ready(keyed, wanted, {"localised": "corrected", "value": observed})
    return out.select(f"_key.{site}", f"_key.{tz}", *[c for c in out.columns if c != "_key"])
