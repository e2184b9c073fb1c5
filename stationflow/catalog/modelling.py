"""Model queries. Where SQL can restate the fit there is SQL; tree models are checked by rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate, features as feat, folds, models, tuning
from ..plans import forecasts, pooled, sites as site_plans
from ..session import cut_lineage, scratch_path
from .data import PAIRS_SQL, hourly_pairs, json_k, r6, round_columns, table
from .registry import query

SITE = ["site"]


def _share(seed: int, key: str) -> str:
    return f"('0x' || substr(md5('{seed}|' || CAST({key} AS VARCHAR)), 1, 8))::BIGINT / 4294967296.0"


#: Key text of an hourly row, as folds and parts hash it.
_ROW = "site || '|' || CAST(ts AS VARCHAR)"


def _written_pairs(spark, sf_dir):
    """Hourly pairs as a written table: a trainer goes over them many times, over the events once."""
    return cut_lineage(hourly_pairs(spark, sf_dir), "hourly-pairs")


def _model_and_obs(spark, sf_dir):
    pairs = _written_pairs(spark, sf_dir)
    model = pairs.select("site", "ts", F.col("model").alias("no2"), (F.col("model") / 2 + F.hour("ts")).alias("zpbl"))
    return model, pairs.select("site", "ts", "value")


@query(f"""WITH {PAIRS_SQL} SELECT site, count(*) AS n_train, R4(regr_intercept(value, model)) AS intercept, R4(regr_slope(value, model)) AS slope FROM pairs GROUP BY 1""")
def site_regression(spark, sf_dir):
    """One regression per site from aggregated product sums."""
    fit = models.fit_sites(hourly_pairs(spark, sf_dir), SITE, ["model"], "value", ridge=0.0)
    return fit.select("site", "n_train", r6(F.element_at("coef", 1), 4).alias("intercept"), r6(F.element_at("coef", 2), 4).alias("slope"))


@query(f"""WITH {PAIRS_SQL} SELECT site, count(*) AS n_train, 'model' AS feature, 'absolute' AS target, R4(regr_intercept(value, model) + regr_slope(value, model) * 10) AS at_ten
  FROM pairs GROUP BY 1 HAVING count(*) % 2 = 0""")
def saved_site_models(spark, sf_dir):
    """Site models saved, those of them that are young enough loaded again and applied. Models of an odd number of rows are given an older day."""
    fitted = models.fit_sites(hourly_pairs(spark, sf_dir), SITE, ["model"], "value", ridge=0.0)
    path = scratch_path(spark, "saved-site-models")
    now = F.lit("2024-03-20 00:00:00").cast("timestamp")
    models.save_site_models(fitted, ["model"], "absolute", path, now - F.make_dt_interval(F.when(F.col("n_train") % 2 == 0, 7).otherwise(8)))
    young = models.load_site_models(spark, path, now, max_days=7)
    out = models.predict_sites(young.select("site", "n_train", "features", "target", F.lit(10.0).alias("model")), young, SITE, ["model"], "at_ten")
    return out.select("site", "n_train", F.get("features", F.lit(0)).alias("feature"), "target", r6("at_ten", 4).alias("at_ten"))


_LOSO = """t AS (SELECT o.site AS held, regr_slope(p.value, p.model) AS slope, regr_intercept(p.value, p.model) AS icpt
  FROM (SELECT DISTINCT site FROM pairs) o JOIN pairs p ON p.site <> o.site GROUP BY 1)"""


@query(f"""WITH {PAIRS_SQL}, {_LOSO}
SELECT site, R4(1 - avg(pow(value - (icpt + slope * model), 2)) / var_pop(value)) AS r2, R4(sqrt(avg(pow(value - (icpt + slope * model), 2)))) AS rmse,
  R4(avg(abs(value - (icpt + slope * model)))) AS mae, count(*) AS n FROM pairs JOIN t ON held = site GROUP BY 1""")
def leave_one_site_out(spark, sf_dir):
    """Scores of every site under the model trained on all other sites."""
    out = models.cross_validate(hourly_pairs(spark, sf_dir), [], "site", ["model"], "value", "leave_out", ridge=0.0)
    s = evaluate.scores(out, SITE, "value", "prediction").drop("mse")
    return round_columns(s, ["r2", "rmse", "mae"], 4)


@query(f"""WITH {PAIRS_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY ts) AS rn, count(*) OVER (PARTITION BY site) AS c FROM pairs),
k AS (SELECT *, least(5, greatest(2, c // 100)) AS k FROM n), z AS (SELECT *, c // (k + 1) AS size FROM k),
f AS (SELECT *, CASE WHEN rn <= c - k * size THEN 0 ELSE (rn - (c - k * size) - 1) // size + 1 END AS fold FROM z),
t AS (SELECT a.site, a.fold, regr_slope(b.value, b.model) AS slope, regr_intercept(b.value, b.model) AS icpt
  FROM (SELECT DISTINCT site, fold FROM f WHERE fold > 0) a JOIN f b ON b.site = a.site AND b.fold < a.fold GROUP BY 1, 2),
s AS (SELECT f.site, f.fold, sqrt(avg(pow(value - (icpt + slope * model), 2))) AS rmse, 1 - avg(pow(value - (icpt + slope * model), 2)) / var_pop(value) AS r2,
  avg(abs(value - (icpt + slope * model))) AS mae FROM f JOIN t ON t.site = f.site AND t.fold = f.fold GROUP BY 1, 2)
SELECT site, R4(avg(rmse)) AS cv_rmse, R4(avg(r2)) AS cv_r2, R4(avg(mae)) AS cv_mae, count(*) AS n_folds FROM s GROUP BY 1""")
def expanding_validation(spark, sf_dir):
    """Expanding time-series validation of the site regressions."""
    folded = folds.expanding_folds(hourly_pairs(spark, sf_dir), SITE, "ts", rows_per_fold=100)
    out = models.cross_validate(folded, SITE, "fold", ["model"], "value", "expanding", ridge=0.0).where("fold > 0")
    return round_columns(models.fold_scores(out, SITE, "fold", "value", "prediction"), ["cv_rmse", "cv_r2", "cv_mae"], 4)


@query(f"""WITH {PAIRS_SQL}, f AS (SELECT *, CAST(floor({_share(42, _ROW)} * 3) AS INT) AS fold FROM pairs),
t AS (SELECT a.site, a.fold, regr_slope(b.value, b.model) / (1 + 1e-6) AS slope, regr_avgy(b.value, b.model) AS my, regr_avgx(b.value, b.model) AS mx
  FROM (SELECT DISTINCT site, fold FROM f) a JOIN f b ON b.site = a.site AND b.fold <> a.fold GROUP BY 1, 2),
p AS (SELECT f.site, f.fold, value, my + slope * (model - mx) AS p FROM f JOIN t ON t.site = f.site AND t.fold = f.fold),
s AS (SELECT site, fold, sqrt(avg(pow(value - p, 2))) AS rmse, 1 - avg(pow(value - p, 2)) / var_pop(value) AS r2, avg(abs(value - p)) AS mae FROM p GROUP BY 1, 2)
SELECT site, R4(avg(rmse)) AS cv_rmse, R4(avg(r2)) AS cv_r2, R4(avg(mae)) AS cv_mae, count(*) AS n_folds FROM s GROUP BY 1""")
def kfold_validation(spark, sf_dir):
    """Shuffled three-fold validation of the site regressions."""
    folded = folds.shuffled_folds(hourly_pairs(spark, sf_dir), ["site", "ts"], 3)
    out = models.cross_validate(folded, SITE, "fold", ["model"], "value", "kfold")
    return round_columns(models.fold_scores(out, SITE, "fold", "value", "prediction"), ["cv_rmse", "cv_r2", "cv_mae"], 4)


@query(f"""SELECT part, fold, count(*) AS n FROM (SELECT CASE WHEN {_share(7, 'event_id')} < 0.3 THEN 'test' ELSE 'train' END AS part,
  CAST(floor({_share(42, 'event_id')} * 3) AS INT) AS fold FROM events) GROUP BY 1, 2""")
def hash_split(spark, sf_dir):
    """Row counts of a 70/30 split and of three shuffled folds."""
    ev = table(spark, sf_dir, "events").select("event_id")
    both = folds.shuffled_folds(folds.train_test(ev, ["event_id"], 0.3), ["event_id"], 3)
    return both.groupBy("part", "fold").agg(F.count("*").alias("n"))


@query(f"""WITH h AS (SELECT user_id AS site, {_share(42, 'event_id')} AS h FROM events),
g AS (SELECT *, min(h) OVER (PARTITION BY site) AS low, least(500.0 / count(*) OVER (), 1.0) AS share FROM h)
SELECT site, count(*) AS n_all, count(*) FILTER (h < share OR h = low) AS n_kept FROM g GROUP BY 1""")
def proportional_sample(spark, sf_dir):
    """Sampling operator of the pooled trainer: rows kept per site."""
    ev = table(spark, sf_dir, "events").select(F.col("user_id").alias("site"), "event_id")
    total = ev.groupBy("site").agg(F.count("*").alias("n_all"))
    kept = folds.site_quota(ev, "site", ["event_id"], 500).groupBy("site").agg(F.count("*").alias("n_kept"))
    return total.join(kept, "site")


@query()
def site_bias_correction(spark, sf_dir):
    """Features, outlier filter, site models, time validation, prediction, gap fill, observations."""
    model, obs = _model_and_obs(spark, sf_dir)
    out = forecasts.site_forecast(model, obs, SITE, "ts", "no2")
    rows = out.rows.join(out.scores.select("site", "cv_r2"), "site", "left")
    return rows.select("site", "ts", "value", "localised", "cv_r2")


@query()
def pooled_trees(spark, sf_dir):
    """Pooled boosted trees over all sites with leave-one-site-out scores and the site log."""
    model, obs = _model_and_obs(spark, sf_dir)
    who = obs.select("site").distinct().withColumns({"lat": F.lit(1.0), "lon": F.lit(2.0)})
    pool, log, mode = pooled.training_pool(who, obs, model, "site", "ts", "no2")
    trained = pooled.train_pooled(pool, log, mode, "no2")
    return log.join(trained.site_scores.withColumnRenamed("_site", "site").drop("n"), "site", "left")


@query()
def pooled_from_file(spark, sf_dir):
    """Trainer on a saved pool: sampling option, lags, imputation, filter, folds, final fit."""
    pairs = _written_pairs(spark, sf_dir).select(F.col("site").alias("_site"), F.col("ts").alias("time"), "value", F.col("model").alias("no2"))
    _, scores, _ = pooled.train_from_pool(pairs)
    return scores


@query()
def champion_selection(spark, sf_dir):
    """Site model where it validates well, else the pooled trees."""
    model, obs = _model_and_obs(spark, sf_dir)
    train, _ = forecasts.training_rows(model, obs, SITE, "ts", "no2")
    names = feat.feature_columns(train, ["site", "ts", "value", "bias_ratio"])
    trees = models.fit_trees(train, names, "value")
    out = forecasts.champion_forecast(model, obs, SITE, "ts", "no2", trees)
    return out.rows.select("site", "ts", "localised", "model_source", "value")


def _versions(spark, sf_dir):
    """Two versions of the model that differ in their values, the observations, and the time at which the new one is 60 days old."""
    model, obs = _model_and_obs(spark, sf_dir)
    new = model.withColumn("no2", F.col("no2") / 2 + F.hour("ts"))
    return model, new, obs, F.lit("2024-03-20 00:00:00").cast("timestamp_ntz")


@query()
def two_stage_forecast(spark, sf_dir):
    """Base model of every site on the old version, moved to the new one."""
    old, new, obs, now = _versions(spark, sf_dir)
    rows, _ = forecasts.two_stage_forecast(old, new, obs, SITE, "ts", "no2", now, keep_all=True)
    return rows.select("site", "ts", "no2", "localised", "value")


@query(f"""WITH {PAIRS_SQL}, c AS (SELECT site, ts, value, ts >= TIMESTAMP '2024-01-20' AS new, CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN model / 2 + hour(ts) ELSE model END AS x,
  {_share(7, _ROW)} < 0.3 AS test FROM pairs WHERE value IS NOT NULL AND model IS NOT NULL),
n AS (SELECT site, count(*) FILTER (NOT new) AS n_old, count(*) FILTER (new) AS n_new FROM c WHERE NOT test GROUP BY 1),
w AS (SELECT c.*, n_old, n_new, n_new >= 50 AS tuned, CASE WHEN n_old < 100 OR NOT new THEN CASE WHEN n_new >= 50 THEN 0.1 ELSE 1.0 END ELSE 0.0 END + CASE WHEN new AND n_new >= 50 THEN 1.0 ELSE 0.0 END AS w
  FROM c JOIN n USING (site)),
m AS (SELECT site, sum(w) AS sw, sum(w * x) / sum(w) AS mx, sum(w * value) / sum(w) AS my FROM w WHERE NOT test GROUP BY 1),
t AS (SELECT w.site, sum(w * (x - mx) * (value - my)) / sum(w * (x - mx) * (x - mx)) / (1 + 1e-3) AS slope FROM w JOIN m USING (site) WHERE NOT test GROUP BY 1)
SELECT site, n_old, n_new, tuned, R4(sqrt(avg(pow(value - (my + slope * (x - mx)), 2)))) AS rmse, R4(avg(abs(value - (my + slope * (x - mx))))) AS mae, count(*) AS n
FROM w JOIN m USING (site) JOIN t USING (site) WHERE test GROUP BY 1, 2, 3, 4""")
def version_transfer(spark, sf_dir):
    """Held-out scores per site of the model moved from the old version's period to the new one's."""
    pairs = hourly_pairs(spark, sf_dir).dropna()
    border = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    rows = pairs.withColumn("no2", F.when(F.col("ts") >= border, F.col("model") / 2 + F.hour("ts")).otherwise(F.col("model"))).drop("model")
    split = cut_lineage(folds.train_test(rows, ["site", "ts"], 0.3), "transfer-split")
    fitted = cut_lineage(models.transfer_sites(split.where("part = 'train'"), SITE, "ts", border, ["no2"], "value"), "transfer-models")
    tested = models.predict_sites(split.where("part = 'test'"), fitted, SITE, ["no2"])
    scores = evaluate.scores(tested, SITE, "value", "prediction").select("site", "rmse", "mae", "n")
    return round_columns(fitted.select("site", "n_old", "n_new", "tuned").join(scores, "site"), ["rmse", "mae"], 4)


@query(f"""WITH s AS (SELECT user_id AS site, count(*) AS n FROM events GROUP BY 1),
p AS (SELECT *, rank() OVER (ORDER BY n DESC) - 1 + CAST(floor({_share(42, 'site')} * count(*) OVER (PARTITION BY n)) AS BIGINT) AS place FROM s)
SELECT site, n, CAST(CASE WHEN place % 10 < 5 THEN place % 10 ELSE 9 - place % 10 END AS INT) AS fold FROM p""")
def grouped_site_folds(spark, sf_dir):
    """Sites packed into five folds by their rows; every site is in one fold."""
    ev = table(spark, sf_dir, "events").select(F.col("user_id").alias("site"))
    return folds.grouped_folds(ev, "site", 5).groupBy("site", "fold").agg(F.count(F.lit(1)).alias("n"))


#: The two-version trainer's depths, tree numbers and steps.
SEARCH_SPACE = {"maxDepth": [3, 5, 7], "maxIter": [100, 300, 500], "stepSize": [0.01, 0.05, 0.1]}


def _search(spark, sf_dir):
    pairs = hourly_pairs(spark, sf_dir).withColumn("hour", F.hour("ts"))
    return tuning.halving_search(pairs, "site", ["site", "ts"], ["model", "hour"], "value", SEARCH_SPACE)


@query()
def parameter_search(spark, sf_dir):
    """Cross-validated random search over the tree parameters of every site: ten of 27 combinations, three folds, up to 500 trees."""
    return _search(spark, sf_dir)


@query(f"""WITH {PAIRS_SQL} SELECT site, count(*) AS n_rows, 10 AS n_drawn, 1 AS n_best, true AS best_is_least FROM pairs WHERE value IS NOT NULL AND model IS NOT NULL GROUP BY 1""")
def parameter_choice(spark, sf_dir):
    """Per site: rows searched, combinations compared, and that one of those compared on all rows has the least error."""
    found = cut_lineage(_search(spark, sf_dir), "search")
    whole = F.when(F.col("share") == 1, F.col("mse"))
    return found.groupBy("site").agg(F.max("n_rows").alias("n_rows"), F.count(F.lit(1)).cast("int").alias("n_drawn"), F.count_if(F.col("best")).cast("int").alias("n_best"),
                                     (F.min(whole) == F.max(F.when(F.col("best"), F.col("mse")))).alias("best_is_least"))


@query()
def feature_importance(spark, sf_dir):
    pairs = hourly_pairs(spark, sf_dir).withColumns({"hour": F.hour("ts"), "weekday": F.weekday("ts")})
    return models.importances(models.fit_trees(pairs, ["model", "hour", "weekday"], "value"), spark)


@query(f"""WITH {PAIRS_SQL}, c AS (SELECT *, count(*) OVER (PARTITION BY site) AS n FROM pairs WHERE value IS NOT NULL AND model IS NOT NULL),
t AS (SELECT site, regr_slope(value - model, model) / (1 + 1e-3) AS slope, regr_avgy(value - model, model) AS my, regr_avgx(value - model, model) AS mx
  FROM c WHERE n >= 50 AND {_share(7, _ROW)} >= 0.2 GROUP BY 1),
r AS (SELECT site, avg(value) AS obs, avg(my + slope * (coalesce(model, 0) - mx) + model) AS pred FROM pairs JOIN t USING (site) GROUP BY 1)
SELECT site, R4(obs) AS obs, R4(pred) AS pred, R4(obs / nullif(pred, 0)) AS ratio, R4((obs / nullif(pred, 0) - 1) * 100) AS "relChange" FROM r""")
def site_list_training(spark, sf_dir):
    """All sites trained at once on the increment over the model, with their ratios."""
    merged = hourly_pairs(spark, sf_dir).withColumnRenamed("model", "no2")
    trained = site_plans.train_sites(merged, SITE, "ts", min_rows=50, increment=True)
    return round_columns(site_plans.predicted_ratios(trained, merged, SITE, "ts"), ["obs", "pred", "ratio", "relChange"], 4)


@query(f"""WITH {PAIRS_SQL}, c AS (SELECT *, {_share(7, _ROW)} < 0.3 AS test FROM pairs WHERE value IS NOT NULL AND model IS NOT NULL),
t AS (SELECT site, regr_slope(value, model) / (1 + 1e-3) AS slope, regr_avgy(value, model) AS my, regr_avgx(value, model) AS mx FROM c WHERE NOT test GROUP BY 1),
p AS (SELECT c.*, my + slope * (model - mx) AS mid FROM c JOIN t USING (site)),
q AS (SELECT site, quantile_cont(value - mid, 0.15) AS lo, quantile_cont(value - mid, 0.85) AS hi FROM p WHERE NOT test GROUP BY 1)
SELECT site, ts, R4(value) AS value, R4(mid + lo) AS lower, R4(mid) AS mid, R4(mid + hi) AS upper FROM p JOIN q USING (site) WHERE test""")
def interval_report(spark, sf_dir):
    """Held-out rows with lower, mid and upper prediction."""
    return round_columns(site_plans.interval_report(hourly_pairs(spark, sf_dir), SITE, "ts", ["model"]), ["value", "lower", "mid", "upper"], 4)


@query(f"""WITH {PAIRS_SQL}, c AS (SELECT *, {_share(7, _ROW)} < 0.3 AS test FROM pairs WHERE value IS NOT NULL AND model IS NOT NULL)
SELECT site, count(*) AS n, true AS ordered, true AS near FROM c WHERE test GROUP BY 1""")
def quantile_intervals(spark, sf_dir):
    """Held-out rows between the 15 and 85 per cent regressions of their site: how many there are, never crossing, and covered as they should be."""
    out = site_plans.quantile_report(hourly_pairs(spark, sf_dir), SITE, "ts", ["model"])
    inside = (F.col("value") >= F.col("lower")) & (F.col("value") <= F.col("upper"))
    # four standard deviations of a share of n rows
    slack = 4 * F.sqrt(0.7 * 0.3 / F.count(F.lit(1))) + 0.05
    return out.groupBy("site").agg(F.count(F.lit(1)).alias("n"), F.expr("bool_and(lower <= mid AND mid <= upper)").alias("ordered"),
                                   (F.abs(F.avg(inside.cast("int")) - 0.7) <= slack).alias("near"))
