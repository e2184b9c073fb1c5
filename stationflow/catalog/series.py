"""Alignment, gap filling, windows, index and set-operation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import aqi, times as t
from ..operators import align, blocks, clean, setops, windows
from .data import (
    HOURLY_TYPE_SQL, HOURLY_USER_SQL, PAIRS_SQL, SITES_SQL, SPINE_SQL, by_type, by_user,
    gapless_by_user, hourly_by_type, hourly_by_user, hourly_pairs, index_sql, nowcast_sql, r6,
    round_columns, sites, table,
)
from .registry import query

SITE = ["site"]

FILL2_SQL = """f AS (
  SELECT site, ts, last_value(value IGNORE NULLS) OVER (
    PARTITION BY site ORDER BY ts ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS value FROM g)"""


def _aqi_stages():
    fill = (2, lambda w: {"value": F.last("value", ignorenulls=True).over(w.rowsBetween(-2, 0))})
    return [fill, *windows.index_stages({"PM2.5": "value", "NO2": "value", "O3": "value"}, {"NO2": 3, "O3": 1})]


@query(f"""WITH {HOURLY_TYPE_SQL}, {SPINE_SQL}, {FILL2_SQL},
i AS (SELECT site, ts, value, nowcast, {index_sql('nowcast', 'PM2.5')} AS pm,
       {index_sql('no2', 'NO2')} AS no2_aqi, {index_sql('value', 'O3')} AS o3_aqi
  FROM (SELECT *, avg(value) OVER (PARTITION BY site ORDER BY ts ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS no2
        FROM {nowcast_sql('f', 'value')}))
SELECT site, ts, R6(value) AS value, R6(nowcast) AS "PM25_NowCast_Concentration",
  pm AS "PM25_NowCast_AQI", no2_aqi AS "NO2_AQI", o3_aqi AS "O3_AQI",
  greatest(no2_aqi, pm) AS overall_aqi FROM i""")
def flagship_aqi(spark, sf_dir):
    """Hourly means, regular calendar, short gaps filled, NowCast and air-quality indices."""
    gapless = align.hourly_mean_gapless(by_type(spark, sf_dir), SITE, "ts", ["value"])
    out = blocks.with_trailing_frames(gapless, SITE, t.hour_index(F.col("ts")), _aqi_stages())
    out = out.drop(*windows.HELPERS)
    out = windows.add_overall_index(out)
    return round_columns(out, ["value", "PM25_NowCast_Concentration"])


@query(f"""WITH {HOURLY_USER_SQL}, {SPINE_SQL} SELECT site, ts, R6(value) AS value FROM g""")
def hourly_mean_gapless(spark, sf_dir):
    return round_columns(gapless_by_user(spark, sf_dir), ["value"])


@query("""WITH h AS (SELECT 0 AS site, date_trunc('hour', ts) AS ts, avg(value) AS value FROM events GROUP BY 2),
spine AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts
  FROM (SELECT min(ts) AS lo, max(ts) AS hi FROM h))
SELECT spine.ts, R6(value) AS avg, 'µg/m³' AS unit FROM spine LEFT JOIN h ON h.ts = spine.ts""")
def pooled_hourly_mean(spark, sf_dir):
    from ..operators.aggregates import pooled_hourly_mean as pooled
    return round_columns(pooled(table(spark, sf_dir, "events"), "ts", "value"), ["avg"])


def _resample_sql(source: str, days: int) -> str:
    return f"""WITH d AS (SELECT {source}),
b AS (SELECT site, CAST(date_trunc('day', min(ts)) AS TIMESTAMP) AS first FROM d GROUP BY site),
m AS (SELECT d.site, b.first + to_days(CAST(floor(date_diff('day', b.first, d.ts) / {days}) AS INT) * {days}) AS ts,
        avg(value) AS value FROM d JOIN b ON b.site = d.site GROUP BY 1, 2),
s AS (SELECT site, unnest(generate_series(lo, hi, INTERVAL {days} DAY)) AS ts
  FROM (SELECT site, min(ts) AS lo, max(ts) AS hi FROM m GROUP BY site))
SELECT s.site, CAST(s.ts AS TIMESTAMP) AS ts, R4(m.value) AS value
FROM s LEFT JOIN m ON m.site = s.site AND m.ts = s.ts"""


def _shipments(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("site"), F.col("l_shipdate").alias("ts"), F.col("l_extendedprice").alias("value"))


_SHIP = "l_returnflag AS site, l_shipdate AS ts, l_extendedprice AS value FROM lineitem"


@query(_resample_sql(_SHIP, 1))
def resample_1d(spark, sf_dir):
    return round_columns(align.resample_mean(_shipments(spark, sf_dir), SITE, "ts", ["value"], 86400), ["value"], 4)


@query(_resample_sql(_SHIP, 5))
def resample_5d(spark, sf_dir):
    return round_columns(align.resample_mean(_shipments(spark, sf_dir), SITE, "ts", ["value"], 5 * 86400), ["value"], 4)


@query(_resample_sql("user_id AS site, ts, value FROM events", 10))
def resample_10d(spark, sf_dir):
    return round_columns(align.resample_mean(by_user(spark, sf_dir), SITE, "ts", ["value"], 10 * 86400), ["value"], 4)


@query("""WITH d AS (SELECT user_id AS site, time_bucket(INTERVAL 3 HOUR, ts) AS ts, avg(value) AS value
  FROM events GROUP BY 1, 2),
s AS (SELECT site, unnest(generate_series(lo, hi, INTERVAL 3 HOUR)) AS ts
  FROM (SELECT site, min(ts) AS lo, max(ts) AS hi FROM d GROUP BY site))
SELECT s.site, s.ts, R6(value) AS value FROM s LEFT JOIN d ON d.site = s.site AND d.ts = s.ts""")
def resample_3h(spark, sf_dir):
    return round_columns(align.resample_mean(by_user(spark, sf_dir), SITE, "ts", ["value"], 3 * 3600), ["value"])


@query("""WITH d AS (SELECT l_returnflag AS site, l_shipdate AS ts, avg(l_quantity) AS l_quantity,
  avg(l_discount) AS l_discount FROM lineitem GROUP BY 1, 2),
s AS (SELECT site, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS ts
  FROM (SELECT site, min(ts) AS lo, max(ts) AS hi FROM d GROUP BY site))
SELECT s.site, CAST(s.ts AS TIMESTAMP) AS ts, R4(l_quantity) AS l_quantity,
  R4(l_discount) AS l_discount FROM s LEFT JOIN d ON d.site = s.site AND d.ts = s.ts""")
def resample_column_groups(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("site"), F.col("l_shipdate").alias("ts"), "l_quantity", "l_discount")
    out = align.resample_groups(li, SITE, "ts", [["l_quantity"], ["l_discount", "l_quantity"]])
    return round_columns(out, ["l_quantity", "l_discount"], 4)


@query(f"""WITH {HOURLY_USER_SQL}, {SPINE_SQL}, {FILL2_SQL}
SELECT site, ts, R6(value) AS value FROM f""")
def forward_fill_limit2(spark, sf_dir):
    out = align.forward_fill(gapless_by_user(spark, sf_dir), SITE, "ts", ["value"], 2)
    return round_columns(out, ["value"])


# a column with leading, inner and trailing gaps: only "error" events carry a value
_GAPPY = """gappy AS (SELECT user_id AS site, date_trunc('hour', ts) AS ts,
  avg(CASE WHEN event_type = 'error' THEN value END) AS value FROM events GROUP BY 1, 2)"""


def _gappy(spark, sf_dir, tasks=None):
    ev = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("site"), "ts", F.when(F.col("event_type") == "error", F.col("value")).alias("value"))
    return align.hourly_mean(ev, SITE, "ts", ["value"], tasks)


@query(f"""WITH {_GAPPY}, med AS (SELECT median(value) AS m FROM gappy)
SELECT site, ts, R6(coalesce(
  last_value(value IGNORE NULLS) OVER (PARTITION BY site ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(value IGNORE NULLS) OVER (PARTITION BY site ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
  (SELECT m FROM med))) AS value FROM gappy""")
def fill_both_ways(spark, sf_dir):
    """Forward fill, backward fill, then the overall median for sites without any value."""
    from ..operators.ranks import median
    g = _gappy(spark, sf_dir)
    filled = align.fill_all(g, SITE, "ts", ["value"])
    overall = median(g, [], "value").select("median").scalar()
    return round_columns(filled.withColumn("value", F.coalesce("value", overall)), ["value"])


def _neighbour_sql(source: str) -> str:
    return f"""n AS (SELECT *,
  last_value(CASE WHEN value IS NOT NULL THEN rn END IGNORE NULLS) OVER up AS r0,
  first_value(CASE WHEN value IS NOT NULL THEN rn END IGNORE NULLS) OVER dn AS r1,
  last_value(CASE WHEN value IS NOT NULL THEN ts END IGNORE NULLS) OVER up AS t0,
  first_value(CASE WHEN value IS NOT NULL THEN ts END IGNORE NULLS) OVER dn AS t1,
  last_value(value IGNORE NULLS) OVER up AS v0, first_value(value IGNORE NULLS) OVER dn AS v1
  FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY ts) AS rn FROM {source})
  WINDOW up AS (PARTITION BY site ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         dn AS (PARTITION BY site ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


_TIME_LINE = "v0 + (v1 - v0) * (epoch_us(ts) - epoch_us(t0)) / nullif(epoch_us(t1) - epoch_us(t0), 0)"


@query(f"""WITH {_GAPPY}, {_neighbour_sql('gappy')}
SELECT site, ts, R6(coalesce(value, {_TIME_LINE})) AS value FROM n""")
def interpolate_time(spark, sf_dir):
    return round_columns(align.interpolate_time(_gappy(spark, sf_dir), SITE, "ts", ["value"]), ["value"])


@query(f"""WITH {HOURLY_USER_SQL}, {SPINE_SQL}, {_neighbour_sql('g')}
SELECT site, ts, R6(CASE WHEN value IS NOT NULL THEN value
  WHEN coalesce(rn - r0 <= 12, false) OR coalesce(r1 - rn <= 12, false)
  THEN coalesce({_TIME_LINE}, v0, v1) END) AS value FROM n""")
def interpolate_limit12(spark, sf_dir):
    out = align.interpolate_time_limited(gapless_by_user(spark, sf_dir), SITE, "ts", "value", 12)
    return round_columns(out, ["value"])


@query(f"""WITH {_GAPPY}, {_neighbour_sql('gappy')}
SELECT site, ts, R6(CASE WHEN value IS NOT NULL THEN value
  WHEN rn - r0 <= 6 THEN coalesce(v0 + (v1 - v0) * (rn - r0) / nullif(r1 - r0, 0), v0) END) AS value FROM n""")
def interpolate_limit6(spark, sf_dir):
    return round_columns(align.interpolate_rows(_gappy(spark, sf_dir), SITE, "ts", "value", 6), ["value"])


@query("""SELECT site, ts, R6(value) AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY site, ts ORDER BY original) AS rn FROM (
    SELECT user_id AS site, ts AS original, value,
      make_timestamp(CAST(round_even(epoch_us(ts) / 10800e6, 0) AS BIGINT) * 10800000000) AS ts FROM events))
WHERE rn = 1""")
def round_3h_dedup(spark, sf_dir):
    return round_columns(align.round_and_dedup(by_user(spark, sf_dir), SITE, "ts", 3), ["value"])


@query(f"""WITH {SITES_SQL}
SELECT event_id, ts, (ts AT TIME ZONE 'UTC') AT TIME ZONE tz AS local_time, tz AS timezone
FROM events JOIN sites ON user_id = site""")
def local_time(spark, sf_dir):
    zones = sites(spark, sf_dir).select(F.col("site").alias("user_id"), "tz")
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "ts").join(zones, "user_id")
    return align.add_local_time(ev, "ts", "tz").select("event_id", "ts", "local_time", "timezone")


@query(f"""WITH {SITES_SQL}
SELECT event_id, (ts AT TIME ZONE tz) AT TIME ZONE 'UTC' AS ts FROM events JOIN sites ON user_id = site""")
def strip_zone(spark, sf_dir):
    zones = sites(spark, sf_dir).select(F.col("site").alias("user_id"), "tz")
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "ts").join(zones, "user_id")
    return ev.select("event_id", t.to_utc(F.col("ts"), F.col("tz")).alias("ts"))


@query("""WITH r AS (SELECT o_orderpriority AS site, min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders GROUP BY 1),
n AS (SELECT *, CAST(floor(((year(hi) - year(lo)) * 12 + month(hi) - month(lo)) / 6) AS INT) AS n FROM r),
c AS (SELECT site, lo, hi, unnest(generate_series(0, n)) AS chunk FROM n)
SELECT site, CAST(chunk AS BIGINT) AS chunk, lo + to_months(CAST(chunk * 6 AS INT)) AS chunk_start,
  least(lo + to_months(CAST((chunk + 1) * 6 AS INT)) - INTERVAL 1 DAY, hi) AS chunk_end FROM c""")
def fetch_chunks(spark, sf_dir):
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("site")).agg(
        F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    out = align.month_chunks(o, "lo", "hi", 6)
    return out.select("site", F.col("chunk").cast("bigint").alias("chunk"), "chunk_start", "chunk_end")


@query("""WITH r AS (SELECT user_id AS site, date_trunc('day', min(ts))::TIMESTAMP AS lo, date_trunc('day', max(ts))::TIMESTAMP AS hi
  FROM events GROUP BY 1),
c AS (SELECT site, hi, unnest(generate_series(lo, hi, INTERVAL 8 DAY)) AS chunk_start FROM r)
SELECT site, chunk_start, least(chunk_start + INTERVAL 7 DAY, hi) AS chunk_end FROM c""")
def sensor_fetch_chunks(spark, sf_dir):
    day = lambda c: F.date_trunc("DAY", c).cast("timestamp_ntz")
    r = by_user(spark, sf_dir).groupBy("site").agg(day(F.min("ts")).alias("lo"), day(F.max("ts")).alias("hi"))
    return align.day_chunks(r, "lo", "hi", 7).select("site", "chunk_start", "chunk_end")


# ---- windows -------------------------------------------------------------------------------

@query(f"""WITH {HOURLY_USER_SQL}
SELECT site, ts, R6(value) AS value, {', '.join(f"R6(lag(value, {k}) OVER w) AS value_lag{k}" for k in (1, 3, 6, 24))},
  {', '.join(f"R6(avg(value) OVER (PARTITION BY site ORDER BY ts ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)) AS value_roll{n}" for n in (3, 6))}
FROM h WINDOW w AS (PARTITION BY site ORDER BY ts)""")
def lag_roll_features(spark, sf_dir):
    """Lags and rolling means over rows of a sparse series."""
    out = windows.lags_and_rolling(hourly_by_user(spark, sf_dir), SITE, "ts", "value", (1, 3, 6, 24), (3, 6))
    return round_columns(out, [c for c in out.columns if c.startswith("value")])


@query(f"""WITH {HOURLY_TYPE_SQL}, {SPINE_SQL}
SELECT site, ts, {', '.join(f"R6(lag(value, {k}) OVER w) AS value_lag{k}" for k in (6, 12, 24))},
  {', '.join(f"R6(avg(value) OVER (PARTITION BY site ORDER BY ts ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)) AS value_roll{n}" for n in (6, 12))}
FROM g WINDOW w AS (PARTITION BY site ORDER BY ts)""")
def lag_roll_by_time(spark, sf_dir):
    """Lags and rolling means by hours: the series is made regular first."""
    regular = align.regular_calendar(hourly_by_type(spark, sf_dir), SITE, "ts")
    out = windows.lags_and_rolling(regular, SITE, "ts", "value", (6, 12, 24), (6, 12), by="time")
    return round_columns(out.drop("value"), [c for c in out.columns if c.startswith("value_")])


@query(f"""WITH {HOURLY_USER_SQL}, {SPINE_SQL}
SELECT site, ts, R6(nowcast) AS nowcast, {index_sql('nowcast', 'PM2.5')} AS aqi
FROM {nowcast_sql('g', 'value')}""")
def nowcast(spark, sf_dir):
    """NowCast on a series with gaps: a gap in the last 12 hours gives no value."""
    stages = windows.nowcast_stages("value", name="nowcast")
    out = blocks.with_trailing_frames(gapless_by_user(spark, sf_dir), SITE, t.hour_index(F.col("ts")), stages)
    return out.select("site", "ts", r6("nowcast").alias("nowcast"), aqi.sub_index("nowcast", "PM2.5").alias("aqi"))


@query(f"""SELECT event_id, {index_sql('value', 'PM2.5')} AS pm, {index_sql('value', 'NO2')} AS no2, {index_sql('value', 'O3')} AS o3,
  greatest({index_sql('value', 'PM2.5')}, {index_sql('value', 'NO2')}) AS overall FROM events""")
def index_from_concentration(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    out = ev.select("event_id", *[aqi.sub_index("value", p).alias(n) for n, p in (("pm", "PM2.5"), ("no2", "NO2"), ("o3", "O3"))])
    return out.withColumn("overall", aqi.overall_index(["pm", "no2"]))


@query("SELECT user_id AS sensor, max(ts) AS next_start FROM events GROUP BY 1")
def restart_points(spark, sf_dir):
    return setops.restart_points(by_user(spark, sf_dir).withColumnRenamed("site", "sensor"), "sensor", "ts")


# ---- set operations ------------------------------------------------------------------------

@query("""SELECT user_id AS site, ts, value, NULL::DOUBLE AS amount FROM events
UNION ALL SELECT o_custkey AS site, o_orderdate AS ts, NULL::DOUBLE AS value, o_totalprice AS amount FROM orders""")
def union_missing_columns(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("site"), F.col("o_orderdate").alias("ts"), F.col("o_totalprice").alias("amount"))
    return setops.union_all([by_user(spark, sf_dir), o])


@query("""WITH old AS (SELECT user_id AS site, date_trunc('hour', ts) AS ts, min(value) AS value FROM events WHERE event_type = 'view' GROUP BY 1, 2),
new AS (SELECT user_id AS site, date_trunc('hour', ts) AS ts, max(value) AS value FROM events GROUP BY 1, 2)
SELECT site, ts, value FROM old UNION ALL SELECT site, ts, value FROM new ANTI JOIN old USING (site, ts)""")
def precedence_union(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    key = [F.col("user_id").alias("site"), t.hour_floor(F.col("ts")).alias("ts")]
    old = ev.where(F.col("event_type") == "view").groupBy(*key).agg(F.min("value").alias("value"))
    new = ev.groupBy(*key).agg(F.max("value").alias("value"))
    return setops.precedence_union([old, new], ["site", "ts"])


@query("""SELECT site, ts, event_id, value FROM (
  SELECT user_id AS site, date_trunc('hour', ts) AS ts, event_id, value,
    row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY event_id) AS rn FROM events) WHERE rn = 1""")
def dedup_first(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("site"), t.hour_floor(F.col("ts")).alias("ts"), "event_id", "value")
    return setops.keep_first(ev, ["site", "ts"], ["event_id"])


@query("""WITH b AS (SELECT max(ts) - INTERVAL 10 DAY AS border FROM events),
v1 AS (SELECT event_id, ts, value AS amount, 1 AS version FROM events, b WHERE ts <= border),
v2 AS (SELECT event_id, ts, value * 2 AS amount, 2 AS version FROM events, b WHERE ts >= border)
SELECT event_id, ts, amount, version FROM v1 UNION ALL SELECT * FROM v2 ANTI JOIN v1 USING (event_id, ts)""")
def version_hand_over(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    at = ev.agg((F.max("ts") - F.make_dt_interval(F.lit(10))).alias("at")).scalar()
    v1 = ev.select("event_id", "ts", F.col("value").alias("amount"), F.lit(1).alias("version"))
    v2 = ev.select("event_id", "ts", (F.col("value") * 2).alias("amount"), F.lit(2).alias("version"))
    return setops.hand_over(v1, v2, ["event_id", "ts"], "ts", at)


@query("""SELECT event_id, ts, value FROM events ORDER BY ts, event_id LIMIT 100""")
def head_sample(spark, sf_dir):
    return setops.head_sample(table(spark, sf_dir, "events").select("event_id", "ts", "value"), ["ts", "event_id"], 100)


@query(f"""WITH {PAIRS_SQL}, c AS (SELECT site, max(ts) - INTERVAL 5 DAY AS cut FROM pairs GROUP BY site)
SELECT pairs.site, ts, R6(value) AS value, R6(model) AS model
FROM pairs JOIN c ON c.site = pairs.site WHERE ts < cut
UNION ALL
SELECT pairs.site, ts, R6(value * 2) AS value, R6(model) AS model
FROM pairs JOIN c ON c.site = pairs.site WHERE ts >= cut""")
def incremental_append(spark, sf_dir):
    """Cached rows win, rows after the cache come from the new fetch."""
    pairs = hourly_pairs(spark, sf_dir)
    cut = pairs.groupBy("site").agg((F.max("ts") - F.make_dt_interval(F.lit(5))).alias("cut"))
    cached = pairs.join(cut, "site").where(F.col("ts") < F.col("cut")).drop("cut")
    new = pairs.withColumn("value", F.col("value") * 2)
    return round_columns(setops.incremental_append(cached, new, ["site", "ts"]), ["value", "model"])
