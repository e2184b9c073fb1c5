"""Join, nearest-neighbour and snapshot queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import times as t
from ..operators import aggregates, asof, clean, joins, nearest
from ..session import scratch_path
from ..sinks import grid_store
from .data import (
    DAILY_MODEL_SQL, DAILY_OBS_SQL, HOURLY_TYPE_SQL, HOURLY_USER_SQL, PAIRS_SQL, SITES_SQL, by_user, daily_user,
    hourly_by_type, hourly_by_user, hourly_pairs, json_k, r6, round_columns, sites, table,
)
from .registry import query

SITE = ["site"]
KEY = ["site", "ts"]


@query(f"""WITH {DAILY_OBS_SQL}, {DAILY_MODEL_SQL}
SELECT model.site, model.ts, R6(model) AS model, R6(value) AS value FROM model JOIN obs ON obs.site = model.site AND obs.ts = model.ts""")
def training_rows(spark, sf_dir):
    out = joins.model_with_observations(daily_user(spark, sf_dir, True), daily_user(spark, sf_dir, False), KEY, "value")
    return round_columns(out, ["model", "value"])


@query(f"""WITH {DAILY_OBS_SQL}, {DAILY_MODEL_SQL}
SELECT model.site, model.ts, R6(model) AS model, R6(value) AS value FROM model LEFT JOIN obs ON obs.site = model.site AND obs.ts = model.ts""")
def predictions_with_observations(spark, sf_dir):
    out = joins.attach_observations(daily_user(spark, sf_dir, True), daily_user(spark, sf_dir, False), KEY)
    return round_columns(out, ["model", "value"])


@query(f"""WITH {DAILY_OBS_SQL}, {DAILY_MODEL_SQL},
spend AS (SELECT o_custkey AS site, CAST(o_orderdate AS TIMESTAMP) AS ts, sum(o_totalprice) AS spend FROM orders GROUP BY 1, 2)
SELECT coalesce(a.site, spend.site) AS site, coalesce(a.ts, spend.ts) AS ts, R6(model) AS model, R6(value) AS value, R2(spend) AS spend
FROM (SELECT coalesce(model.site, obs.site) AS site, coalesce(model.ts, obs.ts) AS ts, model, value
      FROM model FULL JOIN obs ON obs.site = model.site AND obs.ts = model.ts) a
FULL JOIN spend ON spend.site = a.site AND spend.ts = a.ts""")
def outer_merge(spark, sf_dir):
    spend = table(spark, sf_dir, "orders").groupBy(
        F.col("o_custkey").alias("site"), F.col("o_orderdate").alias("ts")).agg(F.sum("o_totalprice").alias("spend"))
    out = joins.merge_frames([daily_user(spark, sf_dir, True), daily_user(spark, sf_dir, False), spend], KEY)
    return out.select(*KEY, r6("model").alias("model"), r6("value").alias("value"), r6("spend", 2).alias("spend"))


@query(f"""WITH {DAILY_OBS_SQL}, {DAILY_MODEL_SQL},
m AS (SELECT coalesce(model.site, obs.site) AS site, coalesce(model.ts, obs.ts) AS ts, model, value
      FROM model FULL JOIN obs ON obs.site = model.site AND obs.ts = model.ts),
b AS (SELECT site, min(ts) AS first FROM m GROUP BY 1),
r AS (SELECT m.site, first + to_days(CAST(date_diff('day', first, ts) // 2 * 2 AS INT)) AS ts, avg(model) AS model, avg(value) AS value
      FROM m JOIN b ON b.site = m.site GROUP BY 1, 2),
s AS (SELECT site, unnest(generate_series(min(ts), max(ts), INTERVAL 2 DAY)) AS ts FROM r GROUP BY site)
SELECT s.site, CAST(s.ts AS TIMESTAMP) AS ts, R6(model) AS model, R6(value) AS value FROM s LEFT JOIN r ON r.site = s.site AND r.ts = s.ts""")
def outer_merge_2d(spark, sf_dir):
    frames = [daily_user(spark, sf_dir, True), daily_user(spark, sf_dir, False)]
    return round_columns(joins.merge_and_resample(frames, SITE, "ts", ["model", "value"], 2 * 86400), ["model", "value"])


@query(f"""WITH {DAILY_OBS_SQL}, {DAILY_MODEL_SQL}
SELECT coalesce(l.site, r.site) AS site, coalesce(l.ts, r.ts) AS ts, R6(l.value) AS value, R6(extra) AS extra
FROM (SELECT site, ts, model AS value FROM model) l FULL JOIN (SELECT site, ts, value, value * 2 AS extra FROM obs) r
  ON l.site = r.site AND l.ts = r.ts""")
def side_by_side(spark, sf_dir):
    left = daily_user(spark, sf_dir, True).withColumnRenamed("model", "value")
    right = daily_user(spark, sf_dir, False).withColumn("extra", F.col("value") * 2)
    return round_columns(joins.side_by_side(left, right, KEY), ["value", "extra"])


@query(f"""WITH {DAILY_OBS_SQL}, {DAILY_MODEL_SQL}
SELECT coalesce(model.site, obs.site) AS site, coalesce(model.ts, obs.ts) AS ts, R6(coalesce(model, value)) AS value
FROM model FULL JOIN obs ON obs.site = model.site AND obs.ts = model.ts""")
def resolve_clash(spark, sf_dir):
    both = joins.merge_frames([daily_user(spark, sf_dir, True).withColumnRenamed("model", "value_x"),
                               daily_user(spark, sf_dir, False).withColumnRenamed("value", "value_y")], KEY)
    return round_columns(joins.resolve_clash(both, "value", "value_x", "value_y"), ["value"])


@query("""SELECT c_custkey, c_name, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AS known
FROM customer""")
def known_and_unknown(spark, sf_dir):
    """Semi and anti join against the eligible keys."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    known = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey")).distinct()
    return joins.keep_known(c, known, ["c_custkey"]).withColumn("known", F.lit(True)).unionByName(
        joins.drop_known(c, known, ["c_custkey"]).withColumn("known", F.lit(False)))


@query("""SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 'no2' WHEN 'R' THEN 'pm25' ELSE 'default' END AS pollutant,
  CASE l_returnflag WHEN 'A' THEN 'mol/mol' WHEN 'R' THEN 'μg/m³' ELSE 'ppb' END AS unit FROM lineitem""")
def lookup(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    meta = {"A": fv.LAYER_META["NO2"], "R": fv.LAYER_META["PM25_RH35"]}
    return joins.lookup(li, "l_returnflag", meta, ["pollutant", "unit"], fv.LAYER_UNKNOWN).drop("l_returnflag")


@query(f"""WITH {SITES_SQL},
cells AS (SELECT site, least(greatest(CAST(floor((lat + 0.1 + 90) / 0.25 + 0.5) AS INT), 0), 720) AS r,
                 least(greatest(CAST(floor((lon + 0.1 + 180) / 0.25 + 0.5) AS INT), 0), 1439) AS c FROM sites),
grid AS (SELECT l_shipdate AS ts, CAST((l_suppkey * 37) % 180 - 90 AS DOUBLE) AS lat,
                CAST((l_suppkey * 73) % 360 - 180 AS DOUBLE) AS lon, l_extendedprice AS value, l_orderkey, l_linenumber FROM lineitem)
SELECT site, ts, lat, lon, value, l_orderkey, l_linenumber FROM grid JOIN cells
ON r = CAST(floor((lat + 90) / 0.25 + 0.5) AS INT) AND c = CAST(floor((lon + 180) / 0.25 + 0.5) AS INT)""")
def nearest_cell(spark, sf_dir):
    """Series of the grid cell nearest to each site (site coordinates are off the cell centres)."""
    key = F.col("l_suppkey")
    grid = table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("ts"), ((key * 37) % 180 - 90).cast("double").alias("lat"),
        ((key * 73) % 360 - 180).cast("double").alias("lon"), F.col("l_extendedprice").alias("value"),
        "l_orderkey", "l_linenumber")
    pts = sites(spark, sf_dir).select("site", (F.col("lat") + 0.1).alias("lat"), (F.col("lon") + 0.1).alias("lon"))
    return nearest.nearest_cell_series(pts, grid)


_PLACES = """places AS (SELECT s_suppkey AS site, r_name AS region, CAST((s_suppkey * 7919) % 17989 AS DOUBLE) / 100 - 90 AS lat,
  CAST((s_suppkey * 104729) % 35993 AS DOUBLE) / 100 - 180 AS lon FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
cells AS (SELECT site, region, CAST(floor((lat + 90) / 0.25 + 0.5) AS INT) AS r, least(CAST(floor((lon + 180) / 0.25 + 0.5) AS INT), 1439) AS c FROM places)"""


@query(f"""WITH {_PLACES},
grid AS (SELECT l_shipdate AS ts, r, c, l_extendedprice AS value, l_orderkey, l_linenumber FROM lineitem JOIN cells ON site = l_suppkey)
SELECT site, ts, r * 0.25::DOUBLE - 90 AS lat, c * 0.25::DOUBLE - 180 AS lon, value, l_orderkey, l_linenumber
FROM grid JOIN cells USING (r, c) WHERE region = 'EUROPE'""")
def stored_grid_cells(spark, sf_dir):
    """Series of the cells nearest to the sites of one region, from a grid of all that is stored by place. No two sites share coordinates by rule."""
    k = F.col("l_suppkey")
    def place(key):
        return (((key * 7919) % 17989).cast("double") / 100 - 90).alias("lat"), (((key * 104729) % 35993).cast("double") / 100 - 180).alias("lon")
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").alias("ts"), *place(k), F.col("l_extendedprice").alias("value"), "l_orderkey", "l_linenumber")
    grid = rows.withColumns({"lat": nearest.cell_row(F.col("lat")) * fv.GRID_STEP + fv.GRID_SOUTH, "lon": nearest.cell_col(F.col("lon")) * fv.GRID_STEP + fv.GRID_WEST})
    path = scratch_path(spark, "grid")
    grid_store.write_grid(grid, path, "ts")
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region").where("r_name = 'EUROPE'"), F.col("n_regionkey") == F.col("r_regionkey"))
    suppliers = table(spark, sf_dir, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left_semi")
    pts = suppliers.select(F.col("s_suppkey").alias("site"), *place(F.col("s_suppkey")))
    return nearest.nearest_cell_series(pts, grid_store.read_grid(spark, path, grid.schema))


_CUSTOMER_POINTS = """pts AS (SELECT c_custkey AS customer, CAST((c_custkey * 53) % 1800 AS DOUBLE) / 10 - 90 AS lat,
  CAST((c_custkey * 91) % 3600 AS DOUBLE) / 10 - 180 AS lon, c_name AS name FROM customer)"""


def _customer_points(spark, sf_dir):
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.alias("customer"), (((k * 53) % 1800).cast("double") / 10 - 90).alias("lat"),
        (((k * 91) % 3600).cast("double") / 10 - 180).alias("lon"), F.col("c_name").alias("name"))


@query(f"""WITH {SITES_SQL}, {_CUSTOMER_POINTS}
SELECT customer, station, R6(d) AS distance FROM (
  SELECT customer, site AS station, sqrt(pow(pts.lat - sites.lat, 2) + pow(pts.lon - sites.lon, 2)) AS d,
    row_number() OVER (PARTITION BY customer ORDER BY sqrt(pow(pts.lat - sites.lat, 2) + pow(pts.lon - sites.lon, 2)), site) AS rn
  FROM pts, sites) WHERE rn = 1""")
def nearest_station(spark, sf_dir):
    stations = sites(spark, sf_dir).select(F.col("site").alias("station"), "lat", "lon")
    out = nearest.nearest_station(_customer_points(spark, sf_dir), stations, "customer", "station")
    return round_columns(out, ["distance"])


@query(f"""WITH {SITES_SQL}, {_CUSTOMER_POINTS},
st AS (SELECT site AS station, country AS station_name, lat, lon FROM sites),
q AS (SELECT customer, lat, lon, CASE WHEN customer % 4 = 0 THEN 'UNITED' WHEN customer % 4 = 1 THEN lower(substr(name, 10))
  WHEN customer % 4 = 2 THEN 'ia' ELSE 'Nation_' || CAST(customer % 25 AS VARCHAR) END AS asked FROM pts),
m AS (SELECT customer, station, CASE WHEN lower(station_name) = lower(trim(asked)) THEN 1
    WHEN lower(CAST(station AS VARCHAR)) = lower(trim(asked)) THEN 2
    WHEN contains(lower(station_name), lower(trim(asked))) OR contains(lower(CAST(station AS VARCHAR)), lower(trim(asked))) THEN 3
    ELSE 4 END AS r, sqrt(pow(q.lat - st.lat, 2) + pow(q.lon - st.lon, 2)) AS d FROM q, st),
b AS (SELECT *, min(r) OVER (PARTITION BY customer) AS best, row_number() OVER (PARTITION BY customer ORDER BY d, station) AS rn FROM m)
SELECT customer, station, r AS match_rank FROM b WHERE r = best AND (r < 4 OR rn = 1)""")
def match_stations(spark, sf_dir):
    """Exact name, exact id, part of a name, nearest: the first rule that finds a station."""
    st = sites(spark, sf_dir).select(F.col("site").alias("station"), F.col("country").alias("station_name"), "lat", "lon")
    kind = F.col("customer") % 4
    asked = F.when(kind == 0, "UNITED").when(kind == 1, F.lower(F.substring("name", 10, 100))).when(kind == 2, "ia") \
        .otherwise(F.concat(F.lit("Nation_"), (F.col("customer") % 25).cast("string")))
    q = _customer_points(spark, sf_dir).withColumn("asked", asked)
    return nearest.match_stations(q, st, "customer", "asked", "station", "station_name")


@query("""WITH q AS (SELECT DISTINCT lower(trim(split_part(p_name, ' ', 1))) AS asked FROM part UNION SELECT DISTINCT lower(substr(p_type, 1, 2)) FROM part),
l AS (SELECT DISTINCT 1 AS kind, lower(p_type) AS label FROM part UNION SELECT DISTINCT 2, lower(p_brand) FROM part
  UNION SELECT DISTINCT 1, lower(split_part(p_name, ' ', 1)) FROM part),
m AS (SELECT *, CASE WHEN label = asked THEN kind WHEN contains(label, asked) THEN 3 END AS match_rank FROM q, l WHERE asked <> '' AND contains(label, asked))
SELECT asked, kind, label, match_rank FROM m QUALIFY match_rank = min(match_rank) OVER (PARTITION BY asked)""")
def match_names(spark, sf_dir):
    """Distinct names against distinct labels, whatever the number of rows that have them."""
    part = table(spark, sf_dir, "part")
    first = F.lower(F.trim(F.split_part("p_name", F.lit(" "), F.lit(1))))
    asked = part.select(first.alias("asked")).unionByName(part.select(F.lower(F.substring("p_type", 1, 2)).alias("asked")))
    labels = part.select(F.inline(F.array(
        F.struct(F.lit(1).alias("kind"), F.lower("p_type").alias("label")), F.struct(F.lit(2).alias("kind"), F.lower("p_brand").alias("label")),
        F.struct(F.lit(1).alias("kind"), F.lower(F.split_part("p_name", F.lit(" "), F.lit(1))).alias("label")))))
    return nearest.match_names(asked, labels, "asked", "kind", "label")


@query(f"""WITH {SITES_SQL}, k AS (SELECT site, lat, lon, 2 * 6371.0088 * asin(sqrt(least(1.0,
  pow(sin((radians(lat) - radians(10)) / 2), 2) + cos(radians(10)) * cos(radians(lat)) * pow(sin((radians(lon) - radians(20)) / 2), 2)))) AS km FROM sites)
SELECT site, lat, lon, R6(km) AS distance_km FROM k WHERE km <= 6000""")
def within_radius(spark, sf_dir):
    out = nearest.within_radius(sites(spark, sf_dir).select("site", "lat", "lon"), 10.0, 20.0, 6000.0)
    return round_columns(out, ["distance_km"])


@query("""WITH s AS (SELECT p_brand AS name, list(DISTINCT p_type) AS sources FROM part GROUP BY 1),
i AS (SELECT p_partkey AS pos, p_brand AS name, string_split(p_name, ' ') || [p_type] AS sources, p_size FROM part)
SELECT name, CAST(pos AS BIGINT) AS index_pos, p_size AS index_p_size FROM (
  SELECT s.name, pos, p_size, row_number() OVER (PARTITION BY s.name ORDER BY pos) AS rn
  FROM s JOIN i ON i.name = s.name AND list_has_any(s.sources, i.sources)) WHERE rn = 1""")
def first_overlapping_index(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    docs = p.groupBy(F.col("p_brand").alias("name")).agg(F.array_sort(F.collect_set("p_type")).alias("sources"))
    index = p.select(F.col("p_partkey").alias("pos"), F.col("p_brand").alias("name"),
                     F.array_append(F.split("p_name", " "), F.col("p_type")).alias("sources"), "p_size")
    return joins.first_overlapping(docs, index, "name", "sources", "pos").select("name", "index_pos", "index_p_size")


@query("""SELECT CAST(t AS DOUBLE) AS threshold, count(value) AS nsites FROM generate_series(0, 50) g(t) LEFT JOIN events ON value > t GROUP BY 1""")
def threshold_counts(spark, sf_dir):
    return joins.sites_by_threshold(table(spark, sf_dir, "events"), "value", 50)


@query(f"""WITH {SITES_SQL}, o AS (SELECT min(date_trunc('hour', ts)) AS start FROM events)
SELECT site, CAST(h AS BIGINT) AS "offset", start + to_hours(CAST(h AS INT)) AS target FROM sites, o, generate_series(0, 95) g(h)""")
def site_hours(spark, sf_dir):
    start = table(spark, sf_dir, "events").agg(t.hour_floor(F.min("ts")).alias("s")).scalar()
    out = joins.hours_of_sites(sites(spark, sf_dir).select("site"), start, 96)
    return out.withColumn("offset", F.col("offset").cast("bigint"))


_TARGETS_SQL = """o AS (SELECT min(date_trunc('hour', ts)) + INTERVAL 240 HOUR AS start FROM events),
u AS (SELECT DISTINCT user_id AS site FROM events),
targets AS (SELECT site, start + to_hours(CAST(h AS INT)) AS target FROM u, o, generate_series(0, 95) g(h))"""


def _targets(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    start = ev.agg((t.hour_floor(F.min("ts")) + t.hours(240)).alias("s")).scalar()
    return joins.hours_of_sites(ev.select(F.col("user_id").alias("site")).distinct(), start, 96).drop("offset")


@query(f"""WITH {_TARGETS_SQL}
SELECT site, target, event_id, ts, value FROM (
  SELECT targets.site, target, event_id, ts, value, row_number() OVER (PARTITION BY targets.site, target
    ORDER BY abs(epoch_us(ts) - epoch_us(target)), event_id) AS rn
  FROM targets JOIN events ON user_id = targets.site) WHERE rn = 1""")
def snapshot_nearest(spark, sf_dir):
    """For 96 hours and every site the forecast row closest in time, first listed on ties."""
    series = table(spark, sf_dir, "events").select(F.col("user_id").alias("site"), "event_id", "ts", "value")
    return asof.nearest_in_time(_targets(spark, sf_dir), series, SITE, "target", "ts", "event_id")


@query(f"""WITH {_TARGETS_SQL}, {HOURLY_USER_SQL}
SELECT site, target, ts, R6(value) AS value FROM (
  SELECT targets.site, target, h.ts, value, row_number() OVER (PARTITION BY targets.site, target
    ORDER BY abs(epoch_us(h.ts) - epoch_us(target)), h.ts) AS rn
  FROM targets JOIN h ON h.site = targets.site) WHERE rn = 1""")
def snapshot_earlier_on_ties(spark, sf_dir):
    out = asof.nearest_in_time(_targets(spark, sf_dir), hourly_by_user(spark, sf_dir), SITE, "target", "ts", prefer="earlier")
    return round_columns(out, ["value"])


@query("""WITH l AS (SELECT user_id AS key, 'k.' || event_type AS path, CAST(max(event_id) AS VARCHAR) AS value FROM events GROUP BY 1, 2),
r AS (SELECT user_id AS key, 'k.' || event_type AS path, CAST(min(event_id) AS VARCHAR) AS value FROM events
      WHERE event_type IN ('view', 'error') GROUP BY 1, 2
      UNION ALL SELECT o_custkey, 'k.orders', CAST(count(*) AS VARCHAR) FROM orders GROUP BY 1)
SELECT coalesce(l.key, r.key) AS key, coalesce(l.path, r.path) AS path, coalesce(r.value, l.value) AS value
FROM l FULL JOIN r ON l.key = r.key AND l.path = r.path""")
def merge_documents(spark, sf_dir):
    """Recursive overlay of two sets of JSON documents, one per key, read as leaf paths."""
    ev = table(spark, sf_dir, "events").withColumnRenamed("user_id", "key")

    def docs(rows):
        pairs = F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "value"))))
        return rows.groupBy("key").agg(F.to_json(F.struct(pairs.alias("k"))).alias("doc"))
    left = docs(ev.groupBy("key", F.col("event_type").alias("name")).agg(F.max("event_id").alias("value")))
    few = ev.where(F.col("event_type").isin("view", "error")).groupBy("key", F.col("event_type").alias("name")).agg(
        F.min("event_id").alias("value"))
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.count("*").alias("value"))
    right = docs(few.unionByName(orders.withColumn("name", F.lit("orders"))))
    return joins.merge_documents(left, right, "key", "doc").drop("kind")


@query(r"""WITH e AS (SELECT * FROM events),
l AS (SELECT event_id, unnest([{'p': 'a.b.c.d.e.f.g.h.x', 'v': CAST(event_id AS VARCHAR)}, {'p': 'o.x', 'v': event_type}, {'p': 'p\.q', 'v': '1'}, {'p': 'p.q', 'v': '2'},
  {'p': 's', 'v': '{"looks":"like"}'}, {'p': 'n', 'v': '5'}], recursive := true) FROM e),
r AS (SELECT event_id, unnest([{'p': 'a.b.c.d.e.f.g.h.y', 'v': event_type}, {'p': 'p.q', 'v': '3'}, {'p': 'n', 'v': '{}'}], recursive := true) FROM e WHERE event_id % 2 = 0)
SELECT coalesce(l.event_id, r.event_id) AS key, coalesce(l.p, r.p) AS path, coalesce(r.v, l.v) AS value FROM l FULL JOIN r ON l.event_id = r.event_id AND l.p = r.p""")
def merge_nested_documents(spark, sf_dir):
    """Overlay with nine levels, empty objects, names with dots and strings that look like JSON; every other document has a right side."""
    ev = table(spark, sf_dir, "events").select(F.col("event_id").alias("key"), "event_type")

    def deep(name, value):
        return F.concat(F.lit('"a":{"b":{"c":{"d":{"e":{"f":{"g":{"h":{"' + name + '":'), value, F.lit("}}}}}}}}"))
    kind = F.concat(F.lit('"'), "event_type", F.lit('"'))
    left = F.concat(F.lit("{"), deep("x", F.col("key")), F.lit(',"o":{"x":'), kind, F.lit(r'},"p.q":1,"p":{"q":2},"s":"{\"looks\":\"like\"}","n":5}'))
    right = F.concat(F.lit("{"), deep("y", kind), F.lit(',"o":{},"p":{"q":3},"n":{}}'))
    out = joins.merge_documents(ev.select("key", left.alias("doc")), ev.where("key % 2 = 0").select("key", right.alias("doc")), "key", "doc")
    return out.drop("kind")


@query(f"""WITH {PAIRS_SQL},
iv AS (SELECT site, ts, value, value - 20 AS lower, value + 30 AS upper, model AS mid FROM pairs),
x AS (SELECT iv.site, iv.ts, value, lower, mid, upper, model * 2 AS prediction, model AS raw FROM iv JOIN pairs USING (site, ts, value))
SELECT site, date_trunc('day', ts)::TIMESTAMP AS ts, R6(avg(value)) AS value, R6(avg(upper)) AS upper, R6(avg(lower)) AS lower,
  R6(avg(mid)) AS mid, R6(avg(prediction)) AS prediction, R6(avg(raw)) AS raw FROM x GROUP BY 1, 2""")
def intervals_with_model(spark, sf_dir):
    p = hourly_pairs(spark, sf_dir)
    iv = p.select("site", "ts", "value", (F.col("value") - 20).alias("lower"), (F.col("value") + 30).alias("upper"),
                  F.col("model").alias("mid"))
    preds = p.select("site", "ts", (F.col("model") * 2).alias("prediction"))
    raw = p.select("site", "ts", F.col("model").alias("raw"))
    cols = ["value", "upper", "lower", "mid"]
    out = joins.intervals_with_model(iv, preds, raw, SITE, "ts", cols, ["prediction"], ["raw"])
    return round_columns(out, [*cols, "prediction", "raw"])


@query(f"""WITH {HOURLY_TYPE_SQL}, {PAIRS_SQL},
v AS (SELECT site, ts, CASE WHEN hour(ts) BETWEEN 6 AND 18 THEN value END AS ref FROM h),
m AS (SELECT coalesce(p.site, v.site) AS site, coalesce(p.ts, v.ts) AS ts, model, ref FROM pairs p FULL JOIN v ON p.site = v.site AND p.ts = v.ts),
d AS (SELECT site, date_trunc('day', ts)::TIMESTAMP AS ts, avg(model) AS model, avg(ref) AS ref FROM m GROUP BY 1, 2),
b AS (SELECT site, min(ts) AS first FROM d GROUP BY 1)
SELECT d.site, first + to_days(CAST(date_diff('day', first, ts) // 5 * 5 AS INT)) AS ts, R6(avg(model)) AS model, R6(avg(ref)) AS ref
FROM d JOIN b ON b.site = d.site GROUP BY 1, 2""")
def validation_comparison(spark, sf_dir):
    """Model against an independent daytime sensor, daily and then five-day means."""
    from ..operators.evaluate import compare_with_validation
    main = hourly_pairs(spark, sf_dir).select("site", "ts", "model")
    ref = hourly_by_type(spark, sf_dir).select("site", "ts", F.when(F.hour("ts").between(6, 18), F.col("value")).alias("ref"))
    return round_columns(compare_with_validation(main, ref, SITE, "ts", ["model"], ["ref"]), ["model", "ref"])
