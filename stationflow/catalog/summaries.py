"""Aggregation, grid and evaluation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..operators import aggregates, align, clean, evaluate, folds, models
from .data import (
    DAILY_MODEL_SQL, DAILY_OBS_SQL, HOURLY_TYPE_SQL, PAIRS_SQL, SITES_SQL, by_type, by_user, daily_user,
    hourly_by_type, hourly_pairs, json_k, r6, round_columns, sites, table,
)
from .registry import query

SITE = ["site"]


def _with_units(spark, sf_dir):
    e = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("site"), F.when(e == "view", "ppm").when(e == "click", "µg/m³").otherwise("ppb").alias("unit"),
        "ts", F.when(e == "view", F.col("value") / 1000).otherwise(F.col("value")).alias("value"))


_UNITS = """u AS (SELECT user_id AS site, CASE event_type WHEN 'view' THEN 'ppm' WHEN 'click' THEN 'µg/m³' ELSE 'ppb' END AS unit,
  ts, CASE event_type WHEN 'view' THEN value / 1000 ELSE value END AS value FROM events)"""


@query(f"WITH {_UNITS} SELECT site, unit, count(value) AS n, R6(avg(value)) AS mean FROM u GROUP BY 1, 2")
def count_and_mean(spark, sf_dir):
    return round_columns(aggregates.count_and_mean(_with_units(spark, sf_dir), ["site", "unit"], "value"), ["mean"])


@query(f"""WITH {_UNITS}, s AS (SELECT site, unit, count(value) AS n, avg(value) AS m FROM u GROUP BY 1, 2)
SELECT DISTINCT site FROM s WHERE site IN (SELECT site FROM s WHERE n > 20)
  AND CASE unit WHEN 'ppm' THEN m * 1000 WHEN 'µg/m³' THEN m / 1.88 ELSE m END >= 55""")
def site_filter(spark, sf_dir):
    return aggregates.filter_sites(_with_units(spark, sf_dir), "site", "unit", "value", 20, 55.0)


@query(f"""WITH {PAIRS_SQL} SELECT site, R6(avg(value)) AS obs, R6(avg(model)) AS pred,
  R6(avg(value) / nullif(avg(model), 0)) AS ratio, R6((avg(value) / nullif(avg(model), 0) - 1) * 100) AS "relChange" FROM pairs GROUP BY 1""")
def site_ratio(spark, sf_dir):
    out = aggregates.site_ratio(hourly_pairs(spark, sf_dir), SITE, "value", "model")
    return round_columns(out, ["obs", "pred", "ratio", "relChange"])


@query(f"""WITH {PAIRS_SQL} SELECT site, R6(avg(model) / nullif(avg(value), 0)) AS ratio, avg(model) / nullif(avg(value), 0) > 0.75 AS suspect FROM pairs GROUP BY 1""")
def unit_plausibility(spark, sf_dir):
    return round_columns(aggregates.unit_plausibility(hourly_pairs(spark, sf_dir), SITE, "model", "value", 0.75), ["ratio"])


@query("""SELECT event_type AS site, arg_min(event_id, ts) AS name, R2(round_even(median(value + 0.0012), 2)) AS lat,
  R2(round_even(median(CAST(json_extract_string(props, '$.k') AS DOUBLE)), 2)) AS lon FROM events GROUP BY 1""")
def site_position(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    ev = ev.select(F.col("event_type").alias("site"), "ts", (F.col("value") + 0.0012).alias("lat_"), json_k(ev).alias("lon_"), "event_id")
    out = aggregates.site_position(ev, SITE, "ts", "lat_", "lon_", "event_id")
    return round_columns(out, ["lat", "lon"], 2)


@query(f"WITH {SITES_SQL} SELECT country, min(lat) AS south, max(lat) AS north, min(lon) AS west, max(lon) AS east FROM sites GROUP BY 1")
def extents(spark, sf_dir):
    return aggregates.extents(sites(spark, sf_dir), "lat", "lon", ["country"])


@query("""SELECT 'V' || CAST(l_suppkey % 3 AS VARCHAR) AS var, CAST(l_shipdate AS DATE) AS date, l_suppkey AS lat, l_partkey AS lon,
  R4(avg(CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END)) AS mean,
  count(CASE WHEN l_returnflag <> 'R' THEN 1 END) AS n_hours FROM lineitem GROUP BY 1, 2, 3, 4""")
def grid_daily_mean(spark, sf_dir):
    """Daily mean per variable and cell, skipping NaN, with the number of hours used."""
    grid = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("V"), (F.col("l_suppkey") % 3).cast("string")).alias("v"), F.col("l_shipdate").alias("ts"),
        F.col("l_suppkey").alias("lat"), F.col("l_partkey").alias("lon"),
        F.when(F.col("l_returnflag") == "R", F.lit(float("nan"))).otherwise(F.col("l_extendedprice")).alias("value"))
    return round_columns(aggregates.daily_cell_mean(grid, "v", "ts", "lat", "lon", "value"), ["mean"], 4)


@query(f"""WITH {SITES_SQL}, f AS (SELECT l_suppkey AS site, count(*) AS n, count(CASE WHEN l_returnflag = 'A' THEN 1 END) AS n_a,
  count(CASE WHEN l_returnflag = 'A' AND l_quantity > 25 THEN 1 END) AS n_big FROM lineitem GROUP BY 1)
SELECT sites.site, CASE WHEN n IS NULL THEN 'no_obs' WHEN n_a = 0 THEN 'all_nan' WHEN n_big < 100 THEN 'too_few_rows'
  WHEN balance < 0 THEN 'no_coords' ELSE 'ok' END AS status, coalesce(n_big, 0) AS n_rows
FROM sites LEFT JOIN f ON f.site = sites.site""")
def run_log(spark, sf_dir):
    flag, big = F.col("l_returnflag") == "A", F.col("l_quantity") > 25
    facts = table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_suppkey").alias("site")).agg(
        F.count("*").alias("n"), F.count_if(flag).alias("n_a"), F.count_if(flag & big).alias("n_big"))
    rules = [("no_obs", F.col("n").isNull()), ("all_nan", F.col("n_a") == 0), ("too_few_rows", F.col("n_big") < 100),
             ("no_coords", F.col("balance") < 0)]
    return aggregates.run_log(sites(spark, sf_dir), facts, SITE, rules, "n_big")


@query("""SELECT feature, R6(c) AS corr FROM (SELECT 'l_quantity' AS feature, corr(l_extendedprice, l_quantity) AS c FROM lineitem
  UNION ALL SELECT 'l_discount', corr(l_extendedprice, l_discount) FROM lineitem
  UNION ALL SELECT 'derived', corr(l_extendedprice, l_extendedprice * (1 - l_discount) + l_quantity * 100) FROM lineitem) WHERE abs(c) > 0.1""")
def corr_feature_pick(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumn(
        "derived", F.col("l_extendedprice") * (1 - F.col("l_discount")) + F.col("l_quantity") * 100)
    picked = aggregates.pick_features(li, "l_extendedprice", ["l_quantity", "l_discount", "l_tax", "derived"], ["l_tax"])
    return round_columns(picked, ["corr"])


_INTERVALS = """iv AS (SELECT event_id, event_type AS site, value, k AS lower, k + 60 AS upper, k + 25 AS mid
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events))"""


def _intervals(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    k = json_k(ev)
    return ev.select("event_id", F.col("event_type").alias("site"), "value", k.alias("lower"), (k + 60).alias("upper"),
                     (k + 25).alias("mid"))


@query(f"""WITH {_INTERVALS} SELECT event_id, R6(abs(lower - value)) AS absolute_error_lower, R6(abs(upper - value)) AS absolute_error_upper,
  R6((abs(lower - value) + abs(upper - value)) / 2) AS absolute_error_interval, R6(abs(mid - value)) AS absolute_error_mid,
  value BETWEEN lower AND upper AS in_bounds FROM iv""")
def interval_errors(spark, sf_dir):
    out = aggregates.with_interval_errors(_intervals(spark, sf_dir)).drop("site", "value", "lower", "mid", "upper")
    return round_columns(out, [c for c in out.columns if c.startswith("absolute")])


@query(f"""WITH {_INTERVALS} SELECT site, R6(avg(CASE WHEN value BETWEEN lower AND upper THEN 1.0 ELSE 0 END) * 100) AS percent_in_bounds,
  R6((count(*) FILTER (upper - value < 0) + count(*) FILTER (value - lower < 0)) / count(*) * 100) AS error_percent, count(*) AS n FROM iv GROUP BY 1""")
def interval_coverage(spark, sf_dir):
    return round_columns(aggregates.interval_coverage(_intervals(spark, sf_dir), SITE), ["percent_in_bounds", "error_percent"])


@query(f"""WITH {_INTERVALS}, e AS (SELECT site, 'lower' AS metric, abs(lower - value) AS x FROM iv
  UNION ALL SELECT site, 'upper', abs(upper - value) FROM iv UNION ALL SELECT site, 'mid', abs(mid - value) FROM iv)
SELECT site, metric, R6(min(x)) AS lowest, R6(quantile_cont(x, 0.25)) AS q1, R6(median(x)) AS middle,
  R6(quantile_cont(x, 0.75)) AS q3, R6(max(x)) AS highest, count(*) AS n FROM e GROUP BY 1, 2""")
def box_summary(spark, sf_dir):
    out = aggregates.with_interval_errors(_intervals(spark, sf_dir))
    out = out.select("site", *[F.col(f"absolute_error_{c}").alias(c) for c in ("lower", "upper", "mid")])
    return round_columns(aggregates.box_summary(out, ["lower", "upper", "mid"], SITE), aggregates.BOX_POINTS)


@query("""SELECT event_type, CASE WHEN value > 300 THEN 'second' ELSE 'first' END AS source, count(*) AS n FROM events GROUP BY 1, 2""")
def rows_by_source(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_type", F.when(F.col("value") > 300, F.col("value")).alias("k"), "value")
    out = align.fill_from_second(ev, "k", "value", "source", ("second", "first"))
    return aggregates.rows_by_source(out, "source", ["event_type"])


@query(f"""WITH {SITES_SQL} SELECT user_id AS site, count(*) AS total_observation, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start_date,
  strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS end_date, coalesce(arg_min(tz, ts), 'N/A') AS timezone
FROM events LEFT JOIN sites ON site = user_id GROUP BY 1""")
def document_header(spark, sf_dir):
    zones = sites(spark, sf_dir).select("site", "tz")
    return aggregates.document_header(by_user(spark, sf_dir).join(zones, "site", "left"), SITE, "ts", "tz")


@query("""SELECT user_id AS location, event_id AS sensor FROM events WHERE event_type = 'purchase'""")
def matching_sensors(spark, sf_dir):
    """Sensors of one parameter per location, from nested location records."""
    ev = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("location"), F.to_date("ts").alias("day")).agg(
        F.collect_list(F.struct(F.col("event_id").alias("id"), F.struct(F.col("event_type").alias("name")).alias("parameter"))).alias("sensors"))
    hit = aggregates.matching_sensors(ev, "sensors", "purchase")
    return hit.select("location", F.explode("sensor_ids").alias("sensor"))


# ---- evaluation ----------------------------------------------------------------------------

_EVAL = """ev AS (SELECT site, ts, value AS a, model AS p FROM pairs),
x AS (SELECT *, max(a) OVER (PARTITION BY site) AS top,
  rank() OVER (PARTITION BY site ORDER BY a) + (count(*) OVER (PARTITION BY site, a) - 1) / 2.0 AS ra,
  rank() OVER (PARTITION BY site ORDER BY p) + (count(*) OVER (PARTITION BY site, p) - 1) / 2.0 AS rp,
  lag(a - p) OVER (PARTITION BY site ORDER BY ts) AS e0 FROM ev),
s AS (SELECT site, avg(abs(a - p)) AS mae, avg(pow(a - p, 2)) AS mse, sqrt(avg(pow(a - p, 2))) AS rmse,
  avg(abs((a - p) / nullif(a, 0))) * 100 AS mape, avg(CASE WHEN abs(a - p) <= 0.1 * top THEN 1.0 ELSE 0 END) * 100 AS within,
  corr(a, p) AS pearson, corr(ra, rp) AS spearman, 1 - avg(pow(a - p, 2)) / var_pop(a) AS r2, corr(e0, a - p) AS autocorr,
  stddev_pop(a - p) AS std, avg(a - p) AS bias, avg(a) AS mean_actual, avg(p) AS mean_predicted FROM x GROUP BY site)"""


@query(f"WITH {PAIRS_SQL}, {_EVAL} " + " UNION ALL ".join(
    f"""SELECT site, '{label}' AS "Statistic", R6({c}) AS "Value" FROM s""" for c, label in fv.EVALUATION_NAMES))
def eval13(spark, sf_dir):
    """Thirteen statistics of the model against the observations, per site."""
    return round_columns(evaluate.evaluate(hourly_pairs(spark, sf_dir), SITE, "ts", "value", "model"), ["Value"])


_R2 = "1 - avg(pow(value - model, 2)) / var_pop(value)"


@query(f"""WITH {PAIRS_SQL}, s AS (SELECT CASE WHEN day(ts) <= 20 THEN 'Training ' ELSE 'Test ' END AS part,
  {_R2} AS r2, avg(pow(value - model, 2)) AS mse, avg(abs(value - model)) AS mae FROM pairs GROUP BY 1)
SELECT part || 'R2' AS name, R6(r2) AS value FROM s UNION ALL SELECT part || 'MSE', R6(mse) FROM s UNION ALL SELECT part || 'MAE', R6(mae) FROM s""")
def train_test_scores(spark, sf_dir):
    return round_columns(evaluate.train_test_scores(_parted(spark, sf_dir), "part", "value", "model"), ["value"])


def _parted(spark, sf_dir):
    return hourly_pairs(spark, sf_dir).withColumn("part", F.when(F.dayofmonth("ts") <= 20, "train").otherwise("test"))


@query(f"""WITH {PAIRS_SQL}, s AS (SELECT site, day(ts) <= 20 AS tr, {_R2} AS r2, sqrt(avg(pow(value - model, 2))) AS rmse FROM pairs GROUP BY 1, 2)
SELECT a.site, R6(abs(a.rmse - b.rmse)) AS rmse_gap, R6(abs(a.r2 - b.r2)) AS r2_gap FROM s a JOIN s b ON a.site = b.site AND a.tr AND NOT b.tr""")
def generalisation_gap(spark, sf_dir):
    return round_columns(evaluate.generalisation_gap(_parted(spark, sf_dir), "part", "value", "model", SITE), ["rmse_gap", "r2_gap"])


@query(f"""WITH {PAIRS_SQL} SELECT site, R6(sqrt(avg(pow(value - model, 2))) / stddev_pop(value)) AS nrmse,
  R6(sum(model - value) / sum(value)) AS nmb FROM pairs GROUP BY 1""")
def normalised_errors(spark, sf_dir):
    return round_columns(evaluate.normalised_errors(hourly_pairs(spark, sf_dir), SITE, "value", "model"), ["nrmse", "nmb"])


_NOW = "2024-01-31 00:00:00"


@query(f"""WITH {PAIRS_SQL}, w AS (SELECT *, count(*) FILTER (ts >= TIMESTAMP '{_NOW}' - INTERVAL 9 DAY) OVER (PARTITION BY site) AS n FROM pairs)
SELECT site, R6({_R2}) AS r2, R6(avg(pow(value - model, 2))) AS mse, R6(sqrt(avg(pow(value - model, 2)))) AS rmse,
  R6(avg(abs(value - model))) AS mae, count(*) AS n, {_R2} < 0.5 AS poor
FROM w WHERE n <= 50 OR ts >= TIMESTAMP '{_NOW}' - INTERVAL 9 DAY GROUP BY 1""")
def recent_validation(spark, sf_dir):
    now = F.lit(_NOW).cast("timestamp_ntz")
    out = evaluate.recent_validation(hourly_pairs(spark, sf_dir), SITE, "ts", now, "value", "model", days=9)
    return round_columns(out, ["r2", "mse", "rmse", "mae"])


@query(f"WITH {DAILY_OBS_SQL}, {DAILY_MODEL_SQL} SELECT site, ts, R6(value - model) AS residual FROM obs JOIN model USING (site, ts)")
def residuals(spark, sf_dir):
    both = daily_user(spark, sf_dir, True).join(daily_user(spark, sf_dir, False), ["site", "ts"], "full")
    return round_columns(evaluate.residuals(both, "value", "model").select("site", "ts", "residual"), ["residual"])


@query(f"WITH {PAIRS_SQL} SELECT site, R6(regr_slope(model, value)) AS slope, R6(regr_intercept(model, value)) AS intercept FROM pairs GROUP BY 1")
def linear_fit(spark, sf_dir):
    return round_columns(evaluate.linear_fit(hourly_pairs(spark, sf_dir), SITE, "value", "model"), ["slope", "intercept"])


@query(f"""WITH {PAIRS_SQL}, r AS (SELECT site, ts, model, value - model AS res FROM pairs),
q AS (SELECT site, quantile_cont(res, 0.15) AS lo, quantile_cont(res, 0.5) AS md, quantile_cont(res, 0.85) AS hi FROM r GROUP BY 1)
SELECT r.site, ts, R6(model + lo) AS lower, R6(model + md) AS mid, R6(model + hi) AS upper FROM r JOIN q ON q.site = r.site""")
def prediction_intervals(spark, sf_dir):
    """Residual quantiles per site added to the prediction."""
    out = models.residual_intervals(hourly_pairs(spark, sf_dir), SITE, "value", "model")
    return round_columns(out.select("site", "ts", "lower", "mid", "upper"), ["lower", "mid", "upper"])


# ---- folds ---------------------------------------------------------------------------------

@query(f"""WITH {HOURLY_TYPE_SQL}, n AS (SELECT site, ts, row_number() OVER (PARTITION BY site ORDER BY ts) AS rn,
  count(*) OVER (PARTITION BY site) AS n FROM h),
k AS (SELECT *, least(5, greatest(2, n // 100)) AS k FROM n), z AS (SELECT *, n // (k + 1) AS size FROM k)
SELECT site, ts, CAST(CASE WHEN rn <= n - k * size THEN 0 ELSE (rn - (n - k * size) - 1) // size + 1 END AS INT) AS fold, CAST(k AS INT) AS n_folds FROM z""")
def ts_cv_folds(spark, sf_dir):
    """Expanding time folds: fold 0 is training only, fold i is tested on all rows before it."""
    out = folds.expanding_folds(hourly_by_type(spark, sf_dir), SITE, "ts", rows_per_fold=100)
    return out.select("site", "ts", "fold", "n_folds")
