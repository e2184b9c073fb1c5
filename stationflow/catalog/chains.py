"""Queries over the composite plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import times as t
from ..operators import align, blocks
from ..plans import forecasts, series, sites as site_plans
from ..session import scratch_path
from ..sinks import writers
from .data import (
    HOURLY_TYPE_SQL, HOURLY_USER_SQL, PAIRS_SQL, SITES_SQL, SPINE_SQL, by_type, hourly_by_type, hourly_by_user,
    hourly_pairs, index_sql, json_k, nowcast_sql, r6, round_columns, sites, table,
)
from .registry import query
from .series import _GAPPY, _gappy, _neighbour_sql, _TIME_LINE

SITE = ["site"]


@query(f"""WITH {_GAPPY},
m AS (SELECT user_id AS site, date_trunc('hour', ts) AS ts, avg(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS model FROM events
      WHERE event_type IN ('view', 'click') GROUP BY 1, 2),
j AS (SELECT coalesce(m.site, gappy.site) AS site, coalesce(m.ts, gappy.ts) AS ts, model, value FROM m FULL JOIN gappy ON m.site = gappy.site AND m.ts = gappy.ts),
a AS (SELECT site, ts, value AS v, model AS value FROM j), {_neighbour_sql('a').replace('n AS', 'mi AS', 1)},
b AS (SELECT site, ts, value FROM j), {_neighbour_sql('b').replace('n AS', 'vi AS', 1)},
x AS (SELECT mi.site, mi.ts, coalesce(mi.value, {_TIME_LINE.replace('ts)', 'mi.ts)').replace('v0', 'mi.v0').replace('v1', 'mi.v1').replace('t0', 'mi.t0').replace('t1', 'mi.t1')}) AS model,
  coalesce(vi.value, {_TIME_LINE.replace('ts)', 'vi.ts)').replace('v0', 'vi.v0').replace('v1', 'vi.v1').replace('t0', 'vi.t0').replace('t1', 'vi.t1')}) AS value
  FROM mi JOIN vi ON vi.site = mi.site AND vi.ts = mi.ts),
s AS (SELECT site, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM x GROUP BY site)
SELECT s.site, s.ts, R6(model) AS model, R6(value) AS value FROM s LEFT JOIN x ON x.site = s.site AND x.ts = s.ts
WHERE s.ts >= TIMESTAMP '2024-01-05' AND s.ts <= TIMESTAMP '2024-01-28'""")
def merge_series(spark, sf_dir):
    """Model and observations merged, interpolated in time, made hourly, cut to a range."""
    ev = table(spark, sf_dir, "events")
    model = ev.where(F.col("event_type").isin("view", "click")).select(F.col("user_id").alias("site"), "ts", json_k(ev).alias("model"))
    tasks = blocks.task_number(ev)
    model = align.hourly_mean(model, SITE, "ts", ["model"], tasks).withColumn("lat", F.lit(1.0))
    out = series.merge_series(model, _gappy(spark, sf_dir, tasks), SITE, "ts", "2024-01-05", "2024-01-28")
    return round_columns(out.select("site", "ts", "model", "value"), ["model", "value"])


_SLOT_STATIONS = """st AS (SELECT site, ts, pm25_conc_cnn, pm25_aqi FROM (
  SELECT event_type AS site, make_timestamp(CAST(round_even(epoch_us(ts) / 10800e6, 0) AS BIGINT) * 10800000000) AS ts, value AS pm25_conc_cnn,
    CASE WHEN value > 50 THEN CAST(event_id % 300 AS DOUBLE) END AS pm25_aqi,
    row_number() OVER (PARTITION BY event_type, CAST(round_even(epoch_us(ts) / 10800e6, 0) AS BIGINT) ORDER BY ts) AS rn
  FROM events) WHERE rn = 1),
sp AS (SELECT site, unnest(generate_series(lo, hi + INTERVAL 2 HOUR, INTERVAL 1 HOUR)) AS ts FROM (SELECT site, min(ts) AS lo, max(ts) AS hi FROM st GROUP BY site)),
sg AS (SELECT sp.site, sp.ts, pm25_conc_cnn, pm25_aqi FROM sp LEFT JOIN st ON st.site = sp.site AND st.ts = sp.ts),
sf AS (SELECT site, ts, last_value(pm25_conc_cnn IGNORE NULLS) OVER w AS pm25_conc_cnn, last_value(pm25_aqi IGNORE NULLS) OVER w AS pm25_aqi
  FROM sg WINDOW w AS (PARTITION BY site ORDER BY ts ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))"""


@query(f"""WITH {PAIRS_SQL}, {_SLOT_STATIONS},
mg AS (SELECT coalesce(sf.site, p.site) AS site, coalesce(sf.ts, p.ts) AS ts, pm25_conc_cnn, pm25_aqi, value AS pm25_rh35, model AS no2
  FROM sf FULL JOIN (SELECT site, ts, CASE WHEN hour(ts) <> 5 THEN value END AS value, CASE WHEN hour(ts) <> 5 THEN model END AS model FROM pairs) p ON sf.site = p.site AND sf.ts = p.ts),
kept AS (SELECT *, CASE WHEN pm25_conc_cnn IS NULL THEN 'model' ELSE 'station' END AS pm25source FROM mg
  WHERE pm25_rh35 IS NOT NULL OR no2 IS NOT NULL OR pm25_conc_cnn IS NOT NULL),
i AS (SELECT *, {index_sql('nowcast', 'PM2.5')} AS pm, {index_sql('roll', 'NO2')} AS na FROM
  (SELECT *, avg(no2) OVER (PARTITION BY site ORDER BY ts ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS roll FROM {nowcast_sql('kept', 'pm25_rh35')}))
SELECT site, ts, R6(coalesce(pm25_conc_cnn, pm25_rh35)) AS pm25_conc_cnn, coalesce(pm25_aqi, pm) AS pm25_aqi, pm25source, R6(nowcast) AS nowcast,
  pm AS "PM25_NowCast_AQI", na AS "NO2_AQI", greatest(coalesce(pm25_aqi, pm), na, pm) AS overall_aqi FROM i""")
def station_forecast(spark, sf_dir):
    """Three-hour station slots made hourly, filled from the model, with indices."""
    ev = table(spark, sf_dir, "events")
    st = ev.select(F.col("event_type").alias("site"), "ts", F.col("value").alias("pm25_conc_cnn"),
                   F.when(F.col("value") > 50, (F.col("event_id") % 300).cast("double")).alias("pm25_aqi"))
    known = F.hour("ts") != 5
    mod = hourly_pairs(spark, sf_dir).select("site", "ts", F.when(known, F.col("value")).alias("pm25_rh35"), F.when(known, F.col("model")).alias("no2"))
    out = forecasts.station_forecast(st, mod, SITE, "ts", ("station", "model"))
    return out.select("site", "ts", r6("pm25_conc_cnn").alias("pm25_conc_cnn"), "pm25_aqi", "pm25source",
                      r6("PM25_NowCast_Concentration").alias("nowcast"), "PM25_NowCast_AQI", "NO2_AQI", "overall_aqi")


@query(f"""WITH {SITES_SQL},
cells AS (SELECT site, least(greatest(CAST(floor((lat + 0.1 + 90) / 0.25 + 0.5) AS INT), 0), 720) AS r,
                 least(greatest(CAST(floor((lon + 0.1 + 180) / 0.25 + 0.5) AS INT), 0), 1439) AS c FROM sites),
g AS (SELECT l_shipdate AS ts, CAST((l_suppkey * 37) % 180 - 90 AS DOUBLE) AS lat, CAST((l_suppkey * 73) % 360 - 180 AS DOUBLE) AS lon,
  min(l_discount) AS no2, min(l_quantity) AS t10m, max(l_tax) AS sala, l_linestatus = 'O' AS old FROM lineitem GROUP BY ALL),
s AS (SELECT site, ts, old, no2, t10m, sala FROM g JOIN cells ON r = CAST(floor((lat + 90) / 0.25 + 0.5) AS INT) AND c = CAST(floor((lon + 180) / 0.25 + 0.5) AS INT)),
p AS (SELECT * FROM s WHERE old UNION ALL SELECT * FROM s a WHERE NOT old AND NOT EXISTS (SELECT 1 FROM s b WHERE b.old AND b.site = a.site AND b.ts = a.ts))
SELECT site, ts, R2(no2 * 1e9) AS no2, t10m AS t, R6(sala * 3) AS aod550_ss, CAST(month(ts) AS INT) AS month, CAST(hour(ts) AS INT) AS hour,
  CAST(isodow(ts) - 1 AS INT) AS weekday FROM p WHERE ts >= TIMESTAMP '1996-01-01'""")
def read_model(spark, sf_dir):
    """Cell series of two stores: nearest cell, harmonised, older store first, scaled, dated."""
    key = F.col("l_suppkey")
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("ts"), ((key * 37) % 180 - 90).cast("double").alias("lat"), ((key * 73) % 360 - 180).cast("double").alias("lon"),
        F.col("l_discount").alias("no2"), F.col("l_quantity").alias("q"), F.col("l_tax").alias("tax"), "l_linestatus")

    def store(status, temperature):
        rows = li.where(F.col("l_linestatus") == status).groupBy("ts", "lat", "lon").agg(
            F.min("no2").alias("no2"), F.min("q").alias(temperature), F.max("tax").alias("aod550_sala"))
        return rows.withColumn("aod550_salc", F.col("aod550_sala") * 2)
    pts = sites(spark, sf_dir).select("site", (F.col("lat") + 0.1).alias("lat"), (F.col("lon") + 0.1).alias("lon"))
    out = series.read_model([store("O", "t10m"), store("F", "t")], pts, "site", "ts", "1996-01-01")
    return out.select("site", "ts", r6("no2", 2).alias("no2"), "t", r6("aod550_ss").alias("aod550_ss"), "month", "hour", "weekday")


@query("""WITH c AS (SELECT event_type AS sensor, ts, value FROM events WHERE ts < TIMESTAMP '2024-01-20'),
n AS (SELECT event_type AS sensor, ts, value * 3 AS value FROM events WHERE ts >= TIMESTAMP '2024-01-15'),
u AS (SELECT * FROM c UNION ALL SELECT * FROM n WHERE ts >= TIMESTAMP '2024-01-20'),
h AS (SELECT date_trunc('hour', ts) AS ts, avg(value) AS v FROM u GROUP BY 1),
s AS (SELECT unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM h)
SELECT s.ts, R6(v) AS avg, 'µg/m³' AS unit FROM s LEFT JOIN h ON h.ts = s.ts""")
def sensor_hourly(spark, sf_dir):
    """Cached and newly fetched sensor rows, then the hourly mean over all sensors."""
    ev = table(spark, sf_dir, "events").select(F.col("event_type").alias("sensor"), "ts", "value")
    cached = ev.where(F.col("ts") < "2024-01-20")
    new = ev.where(F.col("ts") >= "2024-01-15").withColumn("value", F.col("value") * 3)
    return round_columns(series.sensor_hourly(cached, new, "sensor", "ts", "value"), ["avg"])


@query(f"""WITH {PAIRS_SQL},
c AS (SELECT site, ts AS time, R2(model + 0.0012) AS no2, R2(CASE WHEN model - 40 > 0 THEN model - 40 + 0.0012 ELSE 0.1 END) AS corrected,
  R2(value + 0.0012) AS sensor, R2(value / 3 + 0.0012) AS pm25_rh35 FROM pairs),
i AS (SELECT *, {index_sql('nowcast', 'PM2.5')} AS pm, {index_sql('roll', 'NO2')} AS na FROM
  (SELECT *, avg(corrected) OVER (PARTITION BY site ORDER BY time ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS roll
   FROM {nowcast_sql('(SELECT *, time AS ts FROM c)', 'pm25_rh35')}))
SELECT site, time, (time AT TIME ZONE 'UTC') AT TIME ZONE 'Asia/Tokyo' AS local_time, 'Asia/Tokyo' AS timezone, no2, corrected, sensor, pm25_rh35,
  R6(nowcast) AS "PM25_NowCast_Concentration", pm AS "PM25_NowCast_AQI", na AS "NO2_AQI", greatest(na, pm) AS overall_aqi FROM i""")
def published_rows(spark, sf_dir):
    """Corrected series cleaned for publication, with local time and indices."""
    rows = hourly_pairs(spark, sf_dir).select(
        "site", F.lit("Asia/Tokyo").alias("tz"), F.col("ts").alias("time"), r6(F.col("model") + 0.0012, 2).alias("no2"),
        r6(F.when(F.col("model") > 40, F.col("model") - 40 + 0.0012), 2).alias("localised"),
        r6(F.col("value") + 0.0012, 2).alias("value"), r6(F.col("value") / 3 + 0.0012, 2).alias("pm25_rh35"))
    out = forecasts.published_rows(rows, "site", "time", "tz", "sensor")
    return round_columns(out, ["PM25_NowCast_Concentration"])


@query("""WITH h AS (SELECT CASE WHEN event_type = 'view' THEN 1 ELSE 2 END AS site, date_trunc('hour', ts) AS ts, avg(value / 1.88) AS v FROM events GROUP BY 1, 2)
SELECT site, min(ts) AS "start", max(ts) AS "end", count(*) AS n FROM h GROUP BY 1""")
def observation_windows(spark, sf_dir):
    """Observations read from files, resampled, with the default model window per site."""
    ev = table(spark, sf_dir, "events")
    frames = []
    for n, rows in ((1, ev.where("event_type = 'view'")), (2, ev.where("event_type <> 'view'"))):
        path = scratch_path(spark, "observations")
        writers.frame(rows.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("when"), "value"), path, "csv")
        obs = series.read_observations(spark, "csv", path, "no2", time_col="when", time_format="yyyy-MM-dd HH:mm:ss", value_col="value",
                                       unit="ugm3", lat=1.0, lon=2.0)
        frames.append(obs.withColumn("site", F.lit(n)).drop("location"))
    from ..operators import clean, setops
    hourly = align.hourly_mean(setops.union_all(frames), SITE, "time", ["value"])
    counts = hourly.groupBy("site").agg(F.count("*").alias("n"))
    return clean.default_window(hourly, SITE, "time").join(counts, "site")


@query(f"""WITH {HOURLY_TYPE_SQL}, {PAIRS_SQL},
v AS (SELECT site, ts, CASE WHEN hour(ts) BETWEEN 6 AND 18 THEN value END AS ref FROM h),
p AS (SELECT site, ts, model, value FROM pairs WHERE value > 20),
m AS (SELECT coalesce(p.site, v.site) AS site, coalesce(p.ts, v.ts) AS ts, model, value, ref FROM p FULL JOIN v ON p.site = v.site AND p.ts = v.ts),
d AS (SELECT site, date_trunc('day', ts)::TIMESTAMP AS ts, avg(model) AS model, avg(value) AS value, avg(ref) AS ref FROM m GROUP BY 1, 2),
b AS (SELECT site, min(ts) AS first FROM d GROUP BY 1)
SELECT d.site, first + to_days(CAST(date_diff('day', first, ts) // 5 * 5 AS INT)) AS ts, R6(avg(model)) AS model, R6(avg(value)) AS value, R6(avg(ref)) AS ref
FROM d JOIN b ON b.site = d.site GROUP BY 1, 2""")
def location_report(spark, sf_dir):
    merged = hourly_pairs(spark, sf_dir).withColumn("value", F.when(F.col("value") > 20, F.col("value")))
    ref = hourly_by_type(spark, sf_dir).select("site", "ts", F.when(F.hour("ts").between(6, 18), F.col("value")).alias("ref"))
    out = site_plans.location_report(merged, ref, SITE, "ts", ["model", "value"], ["ref"])
    return round_columns(out, ["model", "value", "ref"])
