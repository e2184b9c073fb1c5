"""Training and predicting a list of sites in one job, and reports about them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as fv
from ..operators import aggregates, align, clean, evaluate, features as feat, folds, models
from ..operators.nearest import within_radius
from ..session import cut_lineage


@dataclass
class TrainedSites:
    models: DataFrame
    scores: DataFrame
    features: list[str]
    increment: str | None
    log: bool


def train_sites(merged: DataFrame, site: Sequence[str], ts: str, value: str = "value", species: str = fv.DEFAULT_SPECIES,
                min_rows: int = 240, increment: bool = False, log: bool = False, test_share: float = 0.2,
                skip: Sequence[str] = ("location", "lat", "lon"), ridge: float = 1e-3) -> TrainedSites:
    """One model per site with at least ``min_rows`` complete rows, scored on held-out rows.

    ``increment`` learns value minus the model's own species, ``log`` the logarithm of the target.
    """
    names = feat.feature_columns(merged, [*site, ts, value, *skip])
    own = "pm25_rh35_gcc" if species == "pm25" else species
    if increment and own not in names:
        raise ValueError(f"increment training needs the model column {own!r}")
    rows = clean.enough_rows(clean.all_present(merged, [*names, value]), site, min_rows)
    base = F.col(own) if increment else F.lit(0.0)
    target = feat.increment_target(F.col(value), base, log)
    rows = folds.train_test(rows.withColumn("_y", target), [*site, ts], test_share)
    rows = cut_lineage(rows, "site-training")
    fitted = cut_lineage(models.fit_sites(rows.where("part = 'train'"), site, names, "_y", ridge), "site-models")
    predicted = models.predict_sites(rows, fitted, site, names, "_p")
    predicted = predicted.withColumn("prediction", feat.invert_increment(F.col("_p"), base, log))
    predicted = cut_lineage(predicted.select(*site, "part", value, "prediction"), "site-predictions")
    both = [*site, "part"]
    scores = evaluate.scores(predicted, both, value, "prediction").join(
        evaluate.normalised_errors(predicted, both, value, "prediction"), both)
    return TrainedSites(fitted, scores, names, own if increment else None, log)


def predict_trained(trained: TrainedSites, merged: DataFrame, site: Sequence[str], ts: str, value: str = "value",
                    start=None, end=None) -> DataFrame:
    """Prediction and observation of every trained site over a time range."""
    rows = clean.time_range(merged, ts, start, end)
    rows = rows.join(trained.models.select(*site), list(site), "left_semi")
    out = models.predict_sites(rows, trained.models, site, trained.features, "_p")
    base = F.col(trained.increment) if trained.increment else F.lit(0.0)
    out = out.withColumn("prediction", feat.invert_increment(F.col("_p"), base, trained.log))
    return out.select(*site, ts, "prediction", F.col(value).alias("observation"))


def predicted_ratios(trained: TrainedSites, merged: DataFrame, site: Sequence[str], ts: str, start=None, end=None) -> DataFrame:
    """mean(observation) / mean(prediction) per trained site."""
    return aggregates.site_ratio(predict_trained(trained, merged, site, ts, start=start, end=end), site, "observation", "prediction")


def location_report(merged: DataFrame, validation: DataFrame, site: Sequence[str], ts: str, values: Sequence[str],
                    validation_values: Sequence[str]) -> DataFrame:
    """Complete merged rows against an independent sensor, as daily and then five-day means."""
    complete = clean.all_present(merged, values)
    return evaluate.compare_with_validation(complete, validation, site, ts, values, validation_values)


def neighbours_of(locations: DataFrame, lat: float, lon: float, radius_km: float = 10.0) -> DataFrame:
    """Catalogue locations around a site."""
    return within_radius(locations, lat, lon, radius_km)


def interval_report(rows: DataFrame, site: Sequence[str], ts: str, features: Sequence[str], value: str = "value",
                    lower: float = 0.15, upper: float = 0.85, ridge: float = 1e-3, test_share: float = 0.3) -> DataFrame:
    """Test rows with lower, mid and upper prediction; the quantiles come from the training residuals."""
    from ..operators import ranks
    parts = cut_lineage(folds.train_test(clean.all_present(rows, [*features, value]), [*site, ts], test_share), "intervals")
    train = parts.where("part = 'train'")
    fitted = models.fit_sites(train, site, features, value, ridge)
    residuals = models.predict_sites(train, fitted, site, features, "_p").withColumn("_r", F.col(value) - F.col("_p"))
    q = ranks.quantiles(residuals, site, "_r", {"_lo": lower, "_hi": upper}).drop("n")
    test = models.predict_sites(parts.where("part = 'test'"), fitted, site, features, "mid").join(q, list(site), "left")
    return test.select(*site, ts, value, (F.col("mid") + F.col("_lo")).alias("lower"), "mid", (F.col("mid") + F.col("_hi")).alias("upper"))


def quantile_report(rows: DataFrame, site: Sequence[str], ts: str, features: Sequence[str], value: str = "value",
                    lower: float = 0.15, upper: float = 0.85, test_share: float = 0.3, passes: int = 25) -> DataFrame:
    """Held-out rows with lower, mid and upper prediction: three regressions of each site on its other rows, one per quantile."""
    parts = cut_lineage(folds.train_test(clean.all_present(rows, [*features, value]), [*site, ts], test_share), "quantile-report")
    names = {"lower": lower, "mid": 0.5, "upper": upper}
    fitted = models.pinball_sites(parts.where("part = 'train'"), site, features, value, list(names.values()), passes)
    return models.quantile_predictions(parts.where("part = 'test'"), fitted, site, features, names).select(*site, ts, value, *names)
