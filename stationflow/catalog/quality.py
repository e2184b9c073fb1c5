"""Cleaning, unit, filter and outlier queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names, units
from ..operators import aggregates, clean, features, outliers, ranks
from .data import HOURLY_USER_SQL, SITES_SQL, by_type, by_user, hourly_pairs, json_k, r6, round_columns, sites, table
from .registry import query

SITE = ["site"]


@query("""SELECT l_returnflag AS site, l_shipdate AS ts, l_discount * 1e9 AS no2, l_tax * 1e9 AS o3,
  l_quantity AS t, l_extendedprice AS pm25_rh35, R6(l_quantity + l_discount) AS aod550_ss,
  CAST(month(l_shipdate) AS INT) AS month, CAST(hour(l_shipdate) AS INT) AS hour,
  CAST(isodow(l_shipdate) - 1 AS INT) AS weekday
FROM lineitem WHERE l_shipdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31 12:00:00'""")
def model_columns(spark, sf_dir):
    """Renamed, summed, scaled and dated model columns of a time range."""
    raw = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("site"), F.col("l_shipdate").alias("ts"), F.col("l_discount").alias("no2"),
        F.col("l_tax").alias("o3"), F.col("l_quantity").alias("t10m"), F.col("l_extendedprice").alias("pm25_rh35_gcc"),
        F.col("l_quantity").alias("aod550_sala"), F.col("l_discount").alias("aod550_salc"))
    out = clean.time_range(raw, "ts", "1996-01-01", "1998-12-31 12:00:00")
    out = clean.add_sum(clean.harmonise_names(out), "aod550_ss", ["aod550_sala", "aod550_salc"])
    out = clean.add_calendar_parts(clean.scale_fractions(out), "ts")
    return round_columns(clean.drop_listed(out, ["aod550_sala", "aod550_salc"]), ["aod550_ss"])


@query("""SELECT event_id, CASE WHEN event_type = 'view' THEN value ELSE CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS t,
  NULL::DOUBLE AS hcho, ts AS when_utc_ FROM events""")
def harmonised_clash(spark, sf_dir):
    """Both spellings of a column present, an optional column absent, names cleaned."""
    ev = table(spark, sf_dir, "events")
    both = ev.select("event_id", F.when(F.col("event_type") == "view", F.col("value")).alias("t"),
                     json_k(ev).alias("t10m"), F.col("ts").alias("when(utc)"))
    out = clean.clean_column_names(clean.harmonise_names(both, {"t10m": "t"}))
    return clean.ensure_columns(out, ["hcho"])


@query("""SELECT event_id, ts AS time, R2(greatest(value - 100, 0)) AS no2,
  R2(CASE WHEN k - 50 > 0 THEN k - 50 ELSE 0.1 END) AS corrected
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)""")
def publish_ready(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    raw = ev.select("event_id", F.col("ts").alias("time"), (F.col("value") - 100).alias("no2"),
                    (json_k(ev) - 50).alias("localised"), "props")
    out = clean.publish_ready(raw, ["event_id", "time", "no2", "localised"], {"localised": "corrected"})
    return round_columns(out, ["no2", "corrected"], 2)


@query("""SELECT c_custkey AS id, c_name AS site_name, n_name AS site_place_country, r_name AS site_place_area
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def flatten_paths(spark, sf_dir):
    c, n, r = (table(spark, sf_dir, x) for x in ("customer", "nation", "region"))
    nested = c.join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"]).select(
        F.col("c_custkey").alias("id"), F.struct(F.col("c_name").alias("name"), F.struct(
            F.col("n_name").alias("country"), F.col("r_name").alias("area")).alias("place")).alias("site"))
    return clean.flatten_paths(nested)


@query("""WITH m AS (SELECT user_id AS site, CASE WHEN count(*) > 60 THEN CAST(count(*) AS BIGINT) END AS r2,
  CAST(min(event_id) AS BIGINT) AS rmse FROM events GROUP BY 1)
SELECT site, 'r2' AS name, coalesce(CAST(r2 AS VARCHAR), 'N/A') AS value FROM m
UNION ALL SELECT site, 'rmse', CAST(rmse AS VARCHAR) FROM m
UNION ALL SELECT site, 'mae', 'N/A' FROM m""")
def metric_list(spark, sf_dir):
    m = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("site")).agg(
        F.count("*").alias("n"), F.min("event_id").alias("rmse"))
    listed = clean.metric_list([("r2", F.when(F.col("n") > 60, F.col("n"))), ("rmse", F.col("rmse")),
                                ("mae", F.lit(None).cast("double"))])
    return m.select("site", F.inline(listed))


@query("""SELECT event_id, value FROM (SELECT event_id, CASE WHEN event_type = 'view' THEN NULL ELSE value - 50 END AS value
FROM events) WHERE value >= 0""")
def valid_value(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") == "view", F.lit(float("nan"))).otherwise(F.col("value") - 50).alias("value"))
    return clean.valid_value(ev, "value")


@query("""SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
JOIN (SELECT l_returnflag AS f, max(l_shipdate) - INTERVAL 12 MONTH AS cut FROM lineitem GROUP BY 1) ON f = l_returnflag
WHERE l_shipdate >= cut""")
def last_12_months(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_shipdate")
    return clean.last_months(li, ["l_returnflag"], "l_shipdate", 12).drop("l_returnflag")


@query("""SELECT l_orderkey, l_linenumber, conc FROM (SELECT l_orderkey, l_linenumber,
  CASE WHEN l_returnflag = 'R' THEN -9e99 ELSE l_quantity END AS conc, l_extendedprice / 500 AS ppb FROM lineitem)
WHERE conc <> -9e99 AND ppb > 0 AND ppb < 100""")
def no2_quality(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") == "R", F.lit(-9e99)).otherwise(
            F.col("l_quantity")).alias("conc"), (F.col("l_extendedprice") / 500).alias("ppb"))
    return clean.no2_quality(li, "conc", "ppb").drop("ppb")


@query("""SELECT l_orderkey, l_linenumber, l_extendedprice / 100 AS dobson FROM lineitem
WHERE CAST(l_quantity AS INT) IN (0, 1, 2, 10, 11, 12) AND l_extendedprice / 100 BETWEEN 0 AND 500 AND l_tax - 0.02 >= 0""")
def o3_quality(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_extendedprice") / 100).alias("dobson"),
        F.col("l_quantity").cast("int").alias("flag"), (F.col("l_tax") - 0.02).alias("aod"))
    return clean.o3_quality(li, "dobson", "flag", "aod").drop("flag", "aod")


@query("""SELECT event_id, a, b FROM (SELECT event_id, CASE WHEN value > 300 THEN value END AS a,
  CASE WHEN event_type = 'click' THEN value END AS b FROM events) WHERE a IS NOT NULL OR b IS NOT NULL""")
def any_column_present(spark, sf_dir):
    return clean.any_present(_optional(spark, sf_dir), ["a", "b", "absent"])


@query("""SELECT event_id, a, b FROM (SELECT event_id, CASE WHEN value > 300 THEN value END AS a,
  CASE WHEN event_type = 'click' THEN value END AS b FROM events) WHERE a IS NOT NULL AND b IS NOT NULL""")
def all_columns_present(spark, sf_dir):
    return clean.all_present(_optional(spark, sf_dir), ["a", "b"])


def _optional(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("value") > 300, F.col("value")).alias("a"),
        F.when(F.col("event_type") == "click", F.col("value")).alias("b"))


@query("""SELECT event_id, value AS y FROM events WHERE event_type NOT IN ('view', 'click')""")
def finite_target(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") == "view", F.lit(float("nan")))
        .when(F.col("event_type") == "click", F.lit(float("inf"))).otherwise(F.col("value")).alias("y"))
    return clean.finite_target(ev, "y")


@query("SELECT event_id, value FROM events")
def drop_empty_features(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(
        "event_id", "value", F.lit(None).cast("double").alias("hcho"), F.lit(None).cast("double").alias("so2"))
    return clean.drop_empty_features(ev, ["value", "hcho", "so2"])


_NOW = "1998-08-02 00:00:00"


@query(f"""WITH f AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate > TIMESTAMP '{_NOW}' - INTERVAL 2160 HOUR)
SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT c_custkey, c_mktsegment FROM customer
WHERE c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') AND c_custkey NOT IN (SELECT o_custkey FROM f)""")
def fresh_worklist(spark, sf_dir):
    """Wanted sources, one skipped, one forced, the rest only where no fresh result exists."""
    modified = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderdate").alias("modified"))
    todo = clean.work_list(
        table(spark, sf_dir, "customer"), "c_mktsegment", modified, "c_custkey",
        wanted=["BUILDING", "AUTOMOBILE", "MACHINERY", "FURNITURE"], skipped=["FURNITURE"], forced=["BUILDING"],
        hours=2160, now=F.lit(_NOW))
    return todo.select("c_custkey", "c_mktsegment")


@query("""WITH d AS (SELECT CAST(o_orderdate AS DATE) AS run, o_orderkey FROM orders),
t AS (SELECT max(run) + 1 AS today FROM d)
SELECT o_orderkey, run FROM d WHERE run = (SELECT max(run) FROM d, t WHERE run BETWEEN today - 3 AND today)""")
def latest_run(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("run"), "o_orderkey")
    today = o.agg(F.date_add(F.max("run"), 1)).scalar()
    return clean.latest_run(o, "run", 3, today)


@query("""WITH w AS (SELECT l_suppkey, greatest(min(l_shipdate), TIMESTAMP '1996-01-01') AS s, max(l_shipdate) AS e FROM lineitem GROUP BY 1)
SELECT lineitem.l_suppkey, l_orderkey, l_linenumber FROM lineitem JOIN w ON w.l_suppkey = lineitem.l_suppkey WHERE l_shipdate BETWEEN s AND e""")
def default_window(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_shipdate")
    w = clean.default_window(li, ["l_suppkey"], "l_shipdate", "1996-01-01 00:00:00")
    return clean.within_window(li, w, ["l_suppkey"], "l_shipdate").drop("l_shipdate")


@query("""SELECT user_id AS site, count(*) AS n_rows, CASE WHEN count(*) >= 100 THEN 100 WHEN count(*) >= 50 THEN 50
  WHEN count(*) >= 20 THEN 20 WHEN count(*) >= 10 THEN 10 ELSE 0 END AS gate FROM events GROUP BY 1""")
def sample_gates(spark, sf_dir):
    return clean.sample_status(by_user(spark, sf_dir), SITE, [10, 20, 50, 100])


@query("""SELECT user_id AS site, ts, value FROM events WHERE user_id IN (
  SELECT user_id FROM events GROUP BY 1 HAVING count(*) >= 66)""")
def enough_rows(spark, sf_dir):
    return clean.enough_rows(by_user(spark, sf_dir), SITE, 66)


# ---- units ---------------------------------------------------------------------------------

@query("""SELECT event_id, R6(CASE WHEN species = 'pm25' THEN value WHEN unit = 'ppm' THEN value * 1000
  WHEN unit = 'µg/m³' THEN value / CASE species WHEN 'no2' THEN 1.88 WHEN 'o3' THEN 1.97 END ELSE value END) AS ppb
FROM (SELECT *, CASE event_type WHEN 'view' THEN 'ppm' WHEN 'click' THEN 'µg/m³' WHEN 'error' THEN 'µg/m³' ELSE 'ppb' END AS unit,
  CASE event_type WHEN 'error' THEN 'o3' WHEN 'purchase' THEN 'pm25' ELSE 'no2' END AS species FROM events)""")
def units_to_ppb(spark, sf_dir):
    e = F.col("event_type")
    unit = F.when(e == "view", "ppm").when(e.isin("click", "error"), "µg/m³").otherwise("ppb")
    species = F.when(e == "error", "o3").when(e == "purchase", "pm25").otherwise("no2")
    return table(spark, sf_dir, "events").select("event_id", r6(units.to_ppb(F.col("value"), unit, species)).alias("ppb"))


@query("""SELECT l_orderkey, l_linenumber,
  R6(c * 24.45e9 / (0.0821 * tk * (p / 1013.25)) / 40) AS ppb,
  R6(c * 1e-6 * (p * 100 * pow(1 - 0.0065 * l_quantity / (tk + 0.0065 * l_quantity + 273.15), 5.2561)) / (p * 100) * 1e9) AS ppb_sea_level,
  R6(l_extendedprice * (1.0 / 1.88)) AS no2_ppb, R6(l_extendedprice / 1.97) AS o3_ppb
FROM (SELECT *, l_discount * 1e-7 AS c, CAST(280 + l_quantity AS DOUBLE) AS tk, CAST(990 + l_quantity AS DOUBLE) AS p FROM lineitem)""")
def instrument_units(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    c, q = F.col("l_discount") * 1e-7, F.col("l_quantity")
    ppb = units.mole_density_to_ppb(c, q + 280, q + 990) / 40
    sea = units.mole_density_to_ppb_at(c, q + 990, q, q + 280)
    price = F.col("l_extendedprice")
    return li.select("l_orderkey", "l_linenumber", r6(ppb).alias("ppb"), r6(sea).alias("ppb_sea_level"),
                     r6(units.convert(price, "no2", "ugm3", "ppbv")).alias("no2_ppb"),
                     r6(units.ugm3_to_ppb(price, "o3")).alias("o3_ppb"))


@query("""SELECT user_id AS site, ts, R6((value - avg(value) OVER p) / nullif(stddev_samp(value) OVER p, 0)) AS z
FROM events WINDOW p AS (PARTITION BY user_id)""")
def normalised(spark, sf_dir):
    return round_columns(outliers.normalise(by_user(spark, sf_dir), SITE, "value", "z").drop("value"), ["z"])


# ---- outliers ------------------------------------------------------------------------------

@query("""SELECT site, ts, value FROM (SELECT user_id AS site, ts, value, avg(value) OVER p AS m, stddev_samp(value) OVER p AS s
  FROM events WINDOW p AS (PARTITION BY user_id)) WHERE value BETWEEN m - 1.5 * s AND m + 1.5 * s""")
def ksigma(spark, sf_dir):
    return outliers.within_sigma(by_user(spark, sf_dir), SITE, "value", 1.5)


@query("""SELECT site, ts, value FROM (SELECT user_id AS site, ts, value, avg(value) OVER p AS m, stddev_pop(value) OVER p AS s
  FROM events WINDOW p AS (PARTITION BY user_id)) WHERE abs(value - m) <= 2 * s""")
def zscore(spark, sf_dir):
    return outliers.below_zscore(by_user(spark, sf_dir), SITE, "value", 2.0)


@query("""SELECT event_id, value FROM events, (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events)
WHERE value BETWEEN m - 5 * s AND m + 5 * s""")
def sigma5_pool(spark, sf_dir):
    return outliers.within_sigma(table(spark, sf_dir, "events").select("event_id", "value"), [], "value", 5.0)


_ROBUST = """d AS (SELECT event_type AS site, ts, value, abs(value - median(value) OVER (PARTITION BY event_type)) AS dev FROM events)"""


@query(f"""WITH {_ROBUST}
SELECT site, ts, R6(dev / median(dev) OVER (PARTITION BY site)) AS score FROM d""")
def robust_score(spark, sf_dir):
    return round_columns(outliers.robust_score(by_type(spark, sf_dir), SITE, "value").drop("value"), ["score"])


@query(f"""WITH {_ROBUST}
SELECT site, ts, value FROM (SELECT *, percent_rank() OVER (PARTITION BY site ORDER BY dev) AS pr FROM d) WHERE pr <= 0.98""")
def drop_most_isolated(spark, sf_dir):
    """Most isolated two percent of values per site dropped."""
    return outliers.drop_most_isolated(by_type(spark, sf_dir), SITE, "value", 0.02)


# ---- names ---------------------------------------------------------------------------------

@query("""SELECT p_partkey, replace(replace(p_name, ' ', '_'), '-', '_') AS normalized,
  regexp_replace(trim(p_brand), '[^\\w\\-]', '_', 'g') AS safe, lower(p_name) AS lowered,
  CASE WHEN p_retailprice < 1024 THEN printf('%.2f', round_even(p_retailprice, 2)) || ' B'
       ELSE printf('%.2f', round_even(p_retailprice / 1024, 2)) || ' KB' END AS size_label FROM part""")
def part_names(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", names.normalize_name(F.col("p_name")).alias("normalized"),
        names.safe_name(F.col("p_brand")).alias("safe"), F.lower("p_name").alias("lowered"),
        names.size_label(F.col("p_retailprice")).alias("size_label"))


@query(f"""WITH {SITES_SQL}
SELECT site, replace(replace(printf('%.6f', lat), '.', '_'), '-', 'm') AS lat_key,
  replace(replace(printf('%.6f', lon), '.', '_'), '-', 'm') AS lon_key, lat AS lat_back, lon AS lon_back FROM sites""")
def coordinate_keys(spark, sf_dir):
    s = sites(spark, sf_dir)
    out = s.select("site", names.coordinate_key(F.col("lat")).alias("lat_key"), names.coordinate_key(F.col("lon")).alias("lon_key"))
    return out.withColumns({"lat_back": names.coordinate_from_key(F.col("lat_key")),
                            "lon_back": names.coordinate_from_key(F.col("lon_key"))})


@query("""SELECT page_id, coalesce(regexp_replace(list_filter(string_split(regexp_extract(url, '^[a-z]+://[^/]+([^?#]*)', 1), '/'),
  lambda s: s <> '' AND NOT starts_with(s, 'blog'))[1], '[^\\w\\-]', '_', 'g'), substr(md5(url), 1, 10)) AS site FROM pages""")
def site_from_url(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", names.site_from_url(F.col("url"), ("blog",)).alias("site"))


@query("""SELECT event_id, strftime(ts, '%Y-%m-%d %H:00:00') AS hour_key, strftime(ts, '%Y-%m-%d_%H') AS hour_file,
  'https://grid.example.org/Y2024/M01/D05/Grid.hourly.20240105_09z+' || strftime(ts, '%Y%m%d_%H') || '30z.R0.nc4' AS url FROM events""")
def hour_names(spark, sf_dir):
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id", names.hour_key(ts).alias("hour_key"), names.hour_file(ts).alias("hour_file"),
        names.grid_file_url("https://grid.example.org", "Grid", "hourly", "20240105", "09", ts).alias("url"))


# ---- features ------------------------------------------------------------------------------

@query(f"""WITH {HOURLY_USER_SQL}
SELECT site, ts, R6(sin(2 * pi() * hour(ts) / 24)) AS hour_sin, R6(cos(2 * pi() * hour(ts) / 24)) AS hour_cos,
  R6(sin(2 * pi() * dayofyear(ts) / 365.25)) AS doy_sin, R6(cos(2 * pi() * dayofyear(ts) / 365.25)) AS doy_cos,
  CAST(isodow(ts) - 1 AS DOUBLE) AS weekday, CAST(CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS DOUBLE) AS is_weekend FROM h""")
def cyclic_features(spark, sf_dir):
    from .data import hourly_by_user
    out = hourly_by_user(spark, sf_dir).drop("value").withColumns(features.cyclic(F.col("ts")))
    return round_columns(out, ["hour_sin", "hour_cos", "doy_sin", "doy_cos"])


@query("""SELECT l_orderkey, l_linenumber, R6(ln(1 + greatest(l_extendedprice - 50000, 0))) AS pbl_proxy,
  R6(l_quantity - l_tax) AS t2m_delta FROM lineitem""")
def mixing_and_lapse(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_extendedprice") - 50000).alias("zpbl"),
        F.col("l_quantity").alias("t2m"), F.col("l_tax").alias("t850"))
    out = li.withColumns(features.proxies(["zpbl", "t2m", "t850"])).drop("zpbl", "t2m", "t850")
    return round_columns(out, ["pbl_proxy", "t2m_delta"])


@query("""WITH p AS (SELECT event_type AS site, date_trunc('hour', ts) AS ts, avg(value) AS value,
  avg(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS model FROM events GROUP BY 1, 2)
SELECT site, ts, R6(ratio) AS ratio, R6(CASE WHEN ratio IS NOT NULL THEN model * least(greatest(ratio, 0.05), 20) END) AS restored
FROM (SELECT *, CASE WHEN model <> 0 THEN least(greatest(value / model, 0.05), 20) END AS ratio FROM p)""")
def bias_ratio(spark, sf_dir):
    p = hourly_pairs(spark, sf_dir).withColumn("ratio", features.bias_ratio(F.col("value"), F.col("model")))
    return p.select("site", "ts", r6("ratio").alias("ratio"),
                    r6(features.invert_ratio(F.col("model"), F.col("ratio"))).alias("restored"))


@query("""SELECT event_id, R6(CASE WHEN value - k > 0 THEN ln(value - k) END) AS log_increment,
  R6(CASE WHEN value - k > 0 THEN value END) AS restored
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)""")
def log_increment(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    k = json_k(ev)
    inc = features.increment_target(F.col("value"), k, log=True)
    return ev.select("event_id", r6(inc).alias("log_increment"),
                     r6(features.invert_increment(inc, k, log=True)).alias("restored"))


_FEATURE_COLS = [f"no2_lag{k}h" for k in (1, 3, 6, 24)] + ["no2_roll3h", "no2_roll6h"]


@query("""WITH p AS (SELECT event_type AS site, date_trunc('hour', ts) AS ts, avg(value) AS no2 FROM events GROUP BY 1, 2),
f AS (SELECT *, """ + ", ".join(f"lag(no2, {k}) OVER w AS no2_lag{k}h" for k in (1, 3, 6, 24)) + ", " + ", ".join(
    f"avg(no2) OVER (PARTITION BY site ORDER BY ts ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS no2_roll{n}h" for n in (3, 6)) + """
  FROM p WINDOW w AS (PARTITION BY site ORDER BY ts))
SELECT site, ts, """ + ", ".join(f"R6(coalesce({c}, median({c}) OVER (PARTITION BY site), 0)) AS {c}" for c in _FEATURE_COLS) + " FROM f")
def atmospheric_features(spark, sf_dir):
    """Feature matrix: cyclic, lag and rolling columns, gaps filled with the site's median."""
    from .data import hourly_by_type
    series = hourly_by_type(spark, sf_dir).withColumnRenamed("value", "no2")
    out = features.atmospheric_features(series, SITE, "ts", "no2")
    return round_columns(out.select("site", "ts", *_FEATURE_COLS), _FEATURE_COLS)


@query("""SELECT feature, R6(m) AS median FROM (
  SELECT 'l_quantity' AS feature, median(l_quantity) AS m FROM lineitem UNION ALL
  SELECT 'l_extendedprice', median(l_extendedprice) FROM lineitem UNION ALL
  SELECT 'l_discount', median(l_discount) FROM lineitem)""")
def feature_medians(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return round_columns(ranks.column_medians(li, ["l_quantity", "l_extendedprice", "l_discount"]), ["median"])


@query("""WITH d AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN l_quantity END AS q FROM lineitem)
SELECT l_orderkey, l_linenumber, R6(coalesce(q, (SELECT median(q) FROM d))) AS q FROM d""")
def median_imputed(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).alias("q"))
    return round_columns(features.fill_with_medians(li, ["q"]), ["q"])


@query("""SELECT 'value' AS feature, count(*) FILTER (value IS NULL) AS n_null, count(*) AS n_rows,
  count(*) FILTER (value IS NOT NULL AND v IS NOT NULL) AS n_complete FROM n GROUP BY ALL
UNION ALL SELECT 'v', count(*) FILTER (v IS NULL), count(*), count(*) FILTER (value IS NOT NULL AND v IS NOT NULL) FROM n
""".replace("SELECT 'value'", "WITH n AS (SELECT CASE WHEN value > 100 THEN value END AS value, CASE WHEN event_type <> 'view' THEN 1 END AS v FROM events) SELECT 'value'", 1).replace(" GROUP BY ALL", ""))
def null_profile(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(
        F.when(F.col("value") > 100, F.col("value")).alias("value"), F.when(F.col("event_type") != "view", F.lit(1)).alias("v"))
    return aggregates.null_profile(ev, ["value", "v"])
