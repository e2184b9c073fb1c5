"""The given tables in the roles the operators expect, and the same roles as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators import align
from ..session import use_utc
from .registry import OFF_HALF

ZONES = ["UTC", "America/New_York", "Europe/Berlin", "Asia/Tokyo", "Asia/Kolkata"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def r6(c: Column | str, digits: int = 6) -> Column:
    """Sums differ in the last digits between engines, so results are compared rounded."""
    c = F.col(c) if isinstance(c, str) else c
    return F.bround(c.cast("double") + OFF_HALF / 10 ** digits, digits)


def round_columns(df: DataFrame, columns, digits: int = 6) -> DataFrame:
    return df.withColumns({c: r6(c, digits) for c in columns})


def json_k(df: DataFrame) -> Column:
    return F.get_json_object("props", "$.k").cast("double")


def by_type(spark, sf_dir) -> DataFrame:
    """Dense observations: site = event type."""
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("site"), "ts", "value")


def by_user(spark, sf_dir) -> DataFrame:
    """Sparse observations: site = user."""
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("site"), "ts", "value")


def hourly_by_type(spark, sf_dir) -> DataFrame:
    return align.hourly_mean(by_type(spark, sf_dir), ["site"], "ts", ["value"])


def hourly_by_user(spark, sf_dir) -> DataFrame:
    return align.hourly_mean(by_user(spark, sf_dir), ["site"], "ts", ["value"])


def gapless_by_user(spark, sf_dir) -> DataFrame:
    return align.hourly_mean_gapless(by_user(spark, sf_dir), ["site"], "ts", ["value"])


def hourly_pairs(spark, sf_dir) -> DataFrame:
    """Observed value and model value per event type and hour."""
    ev = table(spark, sf_dir, "events")
    ev = ev.select(F.col("event_type").alias("site"), "ts", "value", json_k(ev).alias("model"))
    return align.hourly_mean(ev, ["site"], "ts", ["value", "model"])


def daily_user(spark, sf_dir, views: bool) -> DataFrame:
    """Daily means per user of view events (model role) or of all other events (observations)."""
    ev = table(spark, sf_dir, "events")
    ev = ev.where(F.col("event_type") == "view" if views else F.col("event_type") != "view")
    name = "model" if views else "value"
    return ev.groupBy(F.col("user_id").alias("site"), F.date_trunc("DAY", "ts").cast("timestamp_ntz").alias("ts")).agg(
        F.avg("value").alias(name))


def sites(spark, sf_dir) -> DataFrame:
    """Site dimension: one row per supplier, coordinates derived from the key."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    key = F.col("s_suppkey")
    zones = F.array(*[F.lit(z) for z in ZONES])
    return s.join(n, s["s_nationkey"] == n["n_nationkey"]).select(
        key.alias("site"), F.col("s_name").alias("name"), F.col("n_name").alias("country"),
        ((key * 37) % 180 - 90).cast("double").alias("lat"),
        ((key * 73) % 360 - 180).cast("double").alias("lon"),
        F.get(zones, (key % 5).cast("int")).alias("tz"), F.col("s_acctbal").alias("balance"))


SITES_SQL = """sites AS (
  SELECT s_suppkey AS site, s_name AS name, n_name AS country,
         CAST((s_suppkey * 37) % 180 - 90 AS DOUBLE) AS lat,
         CAST((s_suppkey * 73) % 360 - 180 AS DOUBLE) AS lon,
         ['UTC','America/New_York','Europe/Berlin','Asia/Tokyo','Asia/Kolkata'][CAST(s_suppkey % 5 AS INT) + 1] AS tz,
         s_acctbal AS balance
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""

HOURLY_TYPE_SQL = """h AS (
  SELECT event_type AS site, date_trunc('hour', ts) AS ts, avg(value) AS value FROM events GROUP BY 1, 2)"""

HOURLY_USER_SQL = """h AS (
  SELECT user_id AS site, date_trunc('hour', ts) AS ts, avg(value) AS value FROM events GROUP BY 1, 2)"""

PAIRS_SQL = """pairs AS (
  SELECT event_type AS site, date_trunc('hour', ts) AS ts, avg(value) AS value,
         avg(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS model
  FROM events GROUP BY 1, 2)"""

SPINE_SQL = """spine AS (
  SELECT site, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts
  FROM (SELECT site, min(ts) AS lo, max(ts) AS hi FROM h GROUP BY site)),
g AS (SELECT spine.site, spine.ts, h.value FROM spine LEFT JOIN h ON h.site = spine.site AND h.ts = spine.ts)"""

DAILY_OBS_SQL = """obs AS (
  SELECT user_id AS site, date_trunc('day', ts)::TIMESTAMP AS ts, avg(value) AS value
  FROM events WHERE event_type <> 'view' GROUP BY 1, 2)"""

DAILY_MODEL_SQL = """model AS (
  SELECT user_id AS site, date_trunc('day', ts)::TIMESTAMP AS ts, avg(value) AS model
  FROM events WHERE event_type = 'view' GROUP BY 1, 2)"""


def index_sql(value: str, pollutant: str) -> str:
    """CASE expression of one pollutant's index, from the same fixed breakpoints."""
    from ..fixed_values import INDEX_BREAKPOINTS
    seg = INDEX_BREAKPOINTS[pollutant]
    parts = [f"WHEN {value} > CAST({seg[-1][1]} AS DOUBLE) THEN 500.0",
             f"WHEN {value} < CAST({seg[0][0]} AS DOUBLE) THEN 0.0"]
    for cl, ch, il, ih in seg:
        slope = (ih - il) / (ch - cl)
        parts.append(f"WHEN {value} BETWEEN CAST({cl} AS DOUBLE) AND CAST({ch} AS DOUBLE) THEN "
                     f"round_even(CAST({slope!r} AS DOUBLE) * ({value} - CAST({cl} AS DOUBLE)) + {il}, 0)")
    return "CAST(CASE " + " ".join(parts) + " END AS DOUBLE)"


def nowcast_sql(source: str, value: str, hours: int = 12) -> str:
    """Subquery adding ``nowcast`` to ``source`` (columns site, ts, ``value``)."""
    return f"""(
  SELECT * EXCLUDE (a, n_all, n_have, mx, mn, w),
    CASE WHEN n_have < n_all THEN NULL WHEN mx = 0 THEN 0.0 ELSE
      list_sum(list_transform(a, lambda x, i: pow(w, len(a) - i) * x))
      / list_sum(list_transform(a, lambda x, i: pow(w, len(a) - i))) END AS nowcast
  FROM (SELECT *, greatest(0.5, 1 - (mx - mn) / nullif(mx, 0)) AS w FROM (
    SELECT *, list({value}) OVER f AS a, count(*) OVER f AS n_all, count({value}) OVER f AS n_have,
           max({value}) OVER f AS mx, min({value}) OVER f AS mn
    FROM {source}
    WINDOW f AS (PARTITION BY site ORDER BY ts ROWS BETWEEN {hours - 1} PRECEDING AND CURRENT ROW))))"""
