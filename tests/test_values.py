import math
import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stationflow.functions import aqi, names, units
from stationflow.operators import aggregates, asof, blocks, clean, evaluate, features, folds, joins, models, nearest, outliers, ranks
from stationflow.plans import series
from stationflow.sinks import grid_store


@pytest.mark.parametrize("conc,want", [
    (0.0, 0), (12.0, 50), (12.05, None), (12.1, 51), (35.4, 100), (500.4, 500), (501.0, 500), (-1.0, 0), (None, None), (float("nan"), None)])
def test_index_edges(spark, conc, want):
    df = spark.createDataFrame([(conc,)], "c DOUBLE")
    assert df.select(aqi.sub_index("c", "PM2.5").alias("x")).first().x == want


def test_index_truncated(spark):
    df = spark.createDataFrame([(12.05,), (54.5,)], "c DOUBLE")
    assert [r.x for r in df.select(aqi.sub_index("c", "PM2.5", truncate=True).alias("x")).collect()][0] == 50
    assert df.where("c > 50").select(aqi.sub_index("c", "NO2", truncate=True).alias("x")).first().x == 51


def test_overall_index(spark):
    df = spark.createDataFrame([(1.0, None), (None, None)], "a DOUBLE, b DOUBLE")
    assert [r.o for r in df.select(aqi.overall_index(["a", "b"]).alias("o")).collect()] == [1.0, None]


def test_units(spark):
    df = spark.createDataFrame([(1.88, "µg/m³", "no2"), (2.0, "ppm", "o3"), (5.0, "µg/m³", "co"), (7.0, "µg/m³", "pm25"), (3.0, "ppb", "no2")],
                               "v DOUBLE, u STRING, s STRING")
    got = [r.p for r in df.select(units.to_ppb(F.col("v"), F.col("u"), F.col("s")).alias("p")).collect()]
    assert got == [pytest.approx(1.0), 2000.0, None, 7.0, 3.0]


@pytest.mark.parametrize("size,want", [(0, "0.00 B"), (1023, "1023.00 B"), (1536, "1.50 KB"), (1024 ** 5, "1.00 PB"), (5 * 1024 ** 3, "5.00 GB")])
def test_size_label(spark, size, want):
    assert spark.range(1).select(names.size_label(F.lit(size)).alias("x")).first().x == want


def test_coordinate_keys(spark):
    row = spark.range(1).select(names.coordinate_key(F.lit(-3.25)).alias("k")).withColumn("back", names.coordinate_from_key(F.col("k"))).first()
    assert row.k == "m3_250000" and row.back == -3.25


def test_quantiles_with_a_hot_group_match_numpy(spark):
    rng = np.random.default_rng(1)
    hot = np.round(rng.lognormal(2, 2, 4000), 2)
    rows = [("hot", float(v)) for v in hot] + [("neg", float(v)) for v in rng.normal(-5, 3, 101)] + [("one", 4.0)] + [("ties", 2.0)] * 50
    df = spark.createDataFrame(rows, "k STRING, v DOUBLE")
    got = {r.k: r for r in ranks.quantiles(df, ["k"], "v", {"a": 0.15, "m": 0.5, "b": 0.85, "x": 1.0}).collect()}
    for key in ("hot", "neg", "one", "ties"):
        values = np.array([v for k, v in rows if k == key])
        np.testing.assert_allclose([got[key].a, got[key].m, got[key].b, got[key].x], np.quantile(values, [0.15, 0.5, 0.85, 1.0]))
    assert got["hot"].n == 4000


def test_ranks_match_pandas(spark):
    rng = np.random.default_rng(2)
    values = rng.integers(-20, 20, 500).astype(float)
    df = spark.createDataFrame([(float(v),) for v in values], "v DOUBLE")
    vc = ranks.value_counts(df, [], "v").select("v", ranks.average_rank().alias("r"), ranks.percent_rank().alias("p")).toPandas().set_index("v")
    s = pd.Series(values)
    want = s.rank().groupby(s).first()
    np.testing.assert_allclose(vc["r"].sort_index(), want)
    np.testing.assert_allclose(vc["p"].sort_index(), ((s.rank(method="min") - 1) / (len(s) - 1)).groupby(s).first())


def test_evaluation_matches_numpy(spark):
    rng = np.random.default_rng(5)
    a = rng.random(300) * 50 + 1
    p = a + rng.normal(0, 8, 300)
    times = pd.date_range("2024-01-01", periods=300, freq="h")
    df = spark.createDataFrame([("s", t.to_pydatetime(), float(x), float(y)) for t, x, y in zip(times, a, p)], "site STRING, ts TIMESTAMP_NTZ, a DOUBLE, p DOUBLE")
    got = {r.Statistic: r.Value for r in evaluate.evaluate(df, ["site"], "ts", "a", "p").collect()}
    e = a - p
    want = {
        "Mean Absolute Error": np.abs(e).mean(), "Root Mean Squared Error": math.sqrt((e ** 2).mean()),
        "Mean Absolute Percentage Error": np.abs(e / a).mean() * 100, "Percentage Within Threshold": (np.abs(e) <= 0.1 * a.max()).mean() * 100,
        "Pearson Correlation": np.corrcoef(a, p)[0, 1], "Spearman Correlation": pd.Series(a).rank().corr(pd.Series(p).rank()),
        "R-squared": 1 - (e ** 2).sum() / ((a - a.mean()) ** 2).sum(), "Autocorrelation of Residuals": np.corrcoef(e[:-1], e[1:])[0, 1],
        "Standard Deviation of Residuals": e.std(), "Mean Bias": e.mean()}
    for name, value in want.items():
        assert got[name] == pytest.approx(value), name
    assert len(got) == 13


def test_nearest_station_matches_brute_force(spark):
    rng = np.random.default_rng(7)
    near = np.column_stack([rng.normal(40, 0.01, 150), rng.normal(-70, 0.01, 150)])  # one crowded city
    far = np.column_stack([rng.uniform(-90, 90, 40), rng.uniform(-180, 180, 40)])
    st = np.vstack([near, far])
    pts = np.vstack([near[:60] + 0.001, rng.uniform(-90, 90, (60, 2)) * [1, 2]])
    stations = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(st)], "station INT, lat DOUBLE, lon DOUBLE")
    sites = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(pts)], "site INT, lat DOUBLE, lon DOUBLE")
    got = {r.site: (r.station, r.distance) for r in nearest.nearest_station(sites, stations, "site", "station").collect()}
    assert len(got) == len(pts)
    for i, (a, b) in enumerate(pts):
        d = np.hypot(st[:, 0] - a, st[:, 1] - b)
        assert got[i][0] == int(d.argmin()) and got[i][1] == pytest.approx(d.min())


def test_remote_points_look_at_few_stations_of_a_crowded_city(spark):
    rng = np.random.default_rng(11)
    st = np.vstack([rng.uniform(0, 0.2, (6000, 2)) + [40, -70], np.round(rng.uniform(0, 2e-5, (40, 2)), 7) + [40.1, -69.9]])
    remote = np.vstack([rng.uniform(-90, 90, (40, 2)) * [1, 2], [[40.1, 150.0], [-80.0, -69.9], [41.0, -69.0], [600.0, 700.0]]])
    stations = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(st)] + [(-1, float(st[0][0]), float(st[0][1])), (-2, None, 1.0), (-3, float("nan"), 1.0)],
                                     "station INT, lat DOUBLE, lon DOUBLE")
    places = stations.where("lat IS NOT NULL AND NOT isnan(lat)").groupBy(F.col("lat").alias("_sa"), F.col("lon").alias("_so")).agg(F.min("station").alias("station"))
    points = spark.createDataFrame([(float(a), float(b)) for a, b in remote], "_la DOUBLE, _lo DOUBLE")
    seen = [r["_seen"] for r in nearest.search_tree(points, places, nearest.station_tree(places, "station"), "station").collect()]
    assert len(seen) == len(remote) and max(seen) < 1500 and np.median(seen) < 900
    sites = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(np.vstack([remote, st[:1], st[6000:6020]]))] + [(900, None, 0.0), (901, float("nan"), 0.0)],
                                  "site INT, lat DOUBLE, lon DOUBLE")
    got = {r.site: r for r in nearest.nearest_station(sites, stations, "site", "station").collect()}
    assert set(got) == set(range(len(remote) + 21)) and got[len(remote)].station == -1
    for i, (a, b) in enumerate(remote):
        d = np.hypot(st[:, 0] - a, st[:, 1] - b)
        assert got[i].distance == pytest.approx(d.min(), rel=1e-14)
    assert nearest.nearest_station(sites, stations.where("false"), "site", "station").count() == 0


def test_equally_near_stations_give_the_smaller_id(spark):
    ring = [(9, 1.0, 0.0), (4, 0.0, 1.0), (7, -1.0, 0.0), (5, 0.0, -1.0)] + [(100 + i, 50.0 + i * 1e-3, 50.0) for i in range(400)]
    stations = spark.createDataFrame(ring, "station INT, lat DOUBLE, lon DOUBLE")
    sites = spark.createDataFrame([(1, 0.0, 0.0), (2, -0.0, 0.0)], "site INT, lat DOUBLE, lon DOUBLE")
    assert {(r.site, r.station, r.distance) for r in nearest.nearest_station(sites, stations, "site", "station").collect()} == {(1, 4, 1.0), (2, 4, 1.0)}


def test_station_matching_cascade(spark):
    stations = spark.createDataFrame([("S1", "Quito", 0.0, -78.0), ("S2", "Quito Norte", 0.2, -78.0), ("q7", "Lima", -12.0, -77.0)],
                                     "station STRING, label STRING, lat DOUBLE, lon DOUBLE")
    sites = spark.createDataFrame([(1, "quito", 0.0, 0.0), (2, "Q7", 0.0, 0.0), (3, "nort", 0.0, 0.0), (4, "Oslo", -11.0, -77.0), (5, None, 0.1, -78.0), (6, "ui", 9.0, 9.0)],
                                  "site INT, asked STRING, lat DOUBLE, lon DOUBLE")
    got = sorted((r.site, r.station, r.match_rank) for r in nearest.match_stations(sites, stations, "site", "asked", "station", "label").collect())
    assert got == [(1, "S1", 1), (2, "q7", 2), (3, "S2", 3), (4, "q7", 4), (5, "S1", 4), (6, "S1", 3), (6, "S2", 3)]


def test_nearest_cell_ties_and_edges(spark):
    df = spark.createDataFrame([(0.125, 0.125), (-90.0, 179.99), (90.0, -180.0)], "lat DOUBLE, lon DOUBLE")
    got = [(r.a, r.b) for r in df.select(nearest.cell_row(F.col("lat")).alias("a"), nearest.cell_col(F.col("lon")).alias("b")).collect()]
    assert got == [(361, 721), (0, 1439), (720, 0)]


def test_stored_grid_is_read_near_sites_only(spark, tmp_path):
    rows = spark.range(64 * 128 * 3).select(
        (F.floor(F.col("id") / 384) * 2.75 - 88).cast("double").alias("lat"), (F.floor(F.col("id") / 3) % 128 * 2.75 - 180).cast("double").alias("lon"),
        F.timestamp_add("HOUR", (F.col("id") % 3).cast("int"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("ts"), F.col("id").cast("double").alias("no2"))
    path = str(tmp_path / "grid")
    grid_store.write_grid(rows, path, "ts")
    stored = grid_store.read_grid(spark, path, rows.schema)
    assert stored.count() == rows.count()
    sites = spark.createDataFrame([("a", -88.0, -180.0), ("b", -88.1, -179.95), ("c", 85.25, 169.25), ("edge", 90.0, 180.0), ("none", None, 1.0)], "site STRING, lat DOUBLE, lon DOUBLE")
    got, want = nearest.nearest_cell_series(sites, stored), nearest.nearest_cell_series(sites, rows)
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 9
    plan = got._jdf.queryExecution().executedPlan()
    scan = plan.toString()
    assert "PartitionFilters" in scan and "GreaterThanOrEqual(_cell" in scan
    cells = sites.where("lat IS NOT NULL").withColumns({"r": nearest.cell_row(F.col("lat")), "c": nearest.cell_col(F.col("lon"))})
    near = nearest._only_near(stored, cells.select(nearest.cell_block(F.col("r"), F.col("c")).alias("_block"), nearest.cell_code(F.col("r"), F.col("c")).alias("_cell")))
    assert len({f.split("_block=")[1].split("/")[0] for f in near.inputFiles()}) <= 1035 and near.select("_block").distinct().count() <= 3
    model = [series.read_model([g], sites, "site", "ts") for g in (stored, rows)]
    assert sorted(map(tuple, model[0].collect())) == sorted(map(tuple, model[1].collect()))


def test_codes_of_cells_are_unique_and_ranges_bounded(spark):
    every = spark.range(721 * 1440).select((F.col("id") / 1440).cast("int").alias("r"), (F.col("id") % 1440).cast("int").alias("c"))
    coded = every.select(nearest.cell_block(F.col("r"), F.col("c")).alias("b"), nearest.cell_code(F.col("r"), F.col("c")).alias("k"))
    out = coded.agg(F.count_distinct("k").alias("n"), F.count_distinct("b").alias("blocks"), F.max(F.abs(F.shiftright("k", 10) - F.col("b"))).alias("off")).first()
    assert tuple(out) == (721 * 1440, 23 * 45, 0)
    joined = nearest._ranges([(i * 100, i * 100 + (i % 7)) for i in range(300)])
    assert len(joined) == nearest.MOST_RANGES and joined[0][0] == 0 and joined[-1][1] == 299 * 100 + 299 % 7
    assert nearest._ranges([]) == [] and nearest._ranges([(5, 9)]) == [(5, 9)]


def test_nearest_in_time_ties(spark):
    series = spark.sql("SELECT 'a' AS site, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS ts, 1 AS pos UNION ALL SELECT 'a', TIMESTAMP_NTZ'2024-01-01 02:00:00', 0")
    target = spark.sql("SELECT 'a' AS site, TIMESTAMP_NTZ'2024-01-01 01:00:00' AS target UNION ALL SELECT 'b', TIMESTAMP_NTZ'2024-01-01 01:00:00'")
    by_pos = asof.nearest_in_time(target, series, ["site"], "target", "ts", "pos").collect()
    early = asof.nearest_in_time(target, series, ["site"], "target", "ts", prefer="earlier").collect()
    assert [r.pos for r in by_pos] == [0] and [r.pos for r in early] == [1]


def test_document_overlay(spark):
    left = spark.createDataFrame([(1, '{"a":{"x":1,"y":2},"b":3,"d":{"q":1}}')], "key INT, doc STRING")
    right = spark.createDataFrame([(1, '{"a":{"y":9,"z":4},"b":{"k":5},"d":7}')], "key INT, doc STRING")
    got = {r.path: r.value for r in joins.merge_documents(left, right, "key", "doc").collect()}
    assert got == {"a.x": "1", "a.y": "9", "a.z": "4", "b.k": "5", "d": "7"}


def test_overlay_rules(spark):
    def merged(left, right):
        a, b = (spark.createDataFrame([(1, d)], "key INT, doc STRING") for d in (left, right))
        return {r.path: (r.kind, r.value) for r in joins.merge_documents(a, b, "key", "doc").collect()}

    deep = '{"a":' * 40 + '{"%s":1}' + "}" * 40
    assert set(merged(deep % "x", deep % "y")) == {"a." * 40 + "x", "a." * 40 + "y"}
    assert merged('{"a":{"x":1}}', '{"a":{}}') == {"a.x": ("number", "1")}
    assert merged('{"a":{}}', '{"a":{"x":1.50}}') == {"a.x": ("number", "1.50")}
    assert merged('{"a":{}}', '{"a":{}}') == {"a": ("object", "{}")}
    assert merged('{"a":5}', '{"a":{}}') == {"a": ("object", "{}")}
    assert merged('{"a":{"x":1}}', '{"a":null}') == {"a": ("null", None)}
    assert merged('{"a.b":1,"a":{"b":2}}', '{"a":{"b":3}}') == {"a\\.b": ("number", "1"), "a.b": ("number", "3")}
    assert merged('{"a":"{\\"x\\":1}","":4}', None) == {"a": ("string", '{"x":1}'), "": ("number", "4")}
    assert merged(None, None) == {"": ("object", "{}")} and merged("not json", '{"a":[1,{"b":"c"}]}') == {"a": ("array", '[1,{"b":"c"}]')}


def test_thresholds(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,), (3.2,), (99.0,), (None,)], "value DOUBLE")
    got = [r.nsites for r in joins.sites_by_threshold(df, "value", 4).orderBy("threshold").collect()]
    assert got == [4, 2, 2, 2, 1]


def test_outliers_keep_small_sites(spark):
    rows = [("big", float(i)) for i in range(100)] + [("big", 1e6)] + [("small", 1.0), ("small", 1e9)]
    df = spark.createDataFrame(rows, "site STRING, value DOUBLE")
    kept = outliers.drop_most_isolated(df, ["site"], "value", 0.01)
    assert kept.where("site = 'small'").count() == 2 and kept.agg(F.max(F.when(F.col("site") == "big", F.col("value")))).first()[0] < 1e6


def test_publish_rules(spark):
    df = spark.createDataFrame([(-1.0, None, 1.005), (2.345, -3.0, None)], "no2 DOUBLE, localised DOUBLE, value DOUBLE")
    got = clean.publish_ready(df, ["no2", "localised", "value"], {"localised": "corrected", "value": "sensor"}).collect()
    assert got[0].no2 == 0.0 and got[0].corrected == 0.1 and got[1].corrected == 0.1 and got[1].sensor is None


def test_bias_ratio(spark):
    df = spark.createDataFrame([(10.0, 5.0), (1.0, 0.0), (None, 2.0), (1000.0, 1.0)], "v DOUBLE, m DOUBLE")
    assert [r.x for r in df.select(features.bias_ratio(F.col("v"), F.col("m")).alias("x")).collect()] == [2.0, None, None, 20.0]


def test_site_regression_recovers_coefficients(spark):
    rng = np.random.default_rng(11)
    x = rng.random((400, 2))
    rows = [("a" if i % 3 else "b", float(u), float(v), float(1 + 2 * u - 3 * v) if i % 3 else float(5 - u)) for i, (u, v) in enumerate(x)]
    df = spark.createDataFrame(rows, "site STRING, u DOUBLE, v DOUBLE, y DOUBLE")
    got = {r.site: r.coef for r in models.fit_sites(df, ["site"], ["u", "v"], "y", ridge=0.0).collect()}
    np.testing.assert_allclose(got["a"], [1, 2, -3], atol=1e-9)
    np.testing.assert_allclose(got["b"], [5, -1, 0], atol=1e-9)


def test_expanding_folds(spark):
    df = spark.range(10).select(F.lit("a").alias("site"), F.timestamp_seconds(F.col("id") * 3600).cast("timestamp_ntz").alias("ts"))
    got = [r.fold for r in folds.expanding_folds(df, ["site"], "ts", rows_per_fold=5).orderBy("ts").collect()]
    assert got == [0, 0, 0, 0, 1, 1, 1, 2, 2, 2]


def test_run_log_lists_every_site(spark):
    sites = spark.createDataFrame([("a",), ("b",)], "site STRING")
    facts = spark.createDataFrame([("a", 5)], "site STRING, n INT")
    got = {r.site: (r.status, r.n_rows) for r in aggregates.run_log(sites, facts, ["site"], [("no_obs", F.col("n").isNull())], "n").collect()}
    assert got == {"a": ("ok", 5), "b": ("no_obs", 0)}


def test_flatten_and_drop_empty(spark):
    df = spark.sql("SELECT named_struct('b', named_struct('c', 1, 'd', named_struct('e', 2))) AS a, CAST(NULL AS DOUBLE) AS n")
    flat = clean.flatten_paths(df)
    assert flat.columns == ["a_b_c", "a_b_d", "n"]
    assert clean.drop_empty_features(flat, ["n"]).columns == ["a_b_c", "a_b_d"]


def test_values_close_together_are_ranked_in_many_blocks(spark):
    df = spark.range(60_000).select((F.lit(100_000) + F.pmod(F.col("id") * 7919, F.lit(60_000)) / 30).alias("v"), F.lit("a").alias("k"))
    counts, _ = ranks._counted(df, ["k"], "v", None)
    assert counts.groupBy("_blk").count().agg(F.max("count")).first()[0] <= 2 * ranks.BLOCK_VALUES
    got = ranks.value_counts(df, ["k"], "v").orderBy("v").select("n_upto", "n_all").collect()
    assert [r["n_upto"] for r in got] == list(range(1, 60_001)) and got[0]["n_all"] == 60_000


def _crowded(spark, n, micros):
    """``n`` rows of one site in its first hour, second or millisecond, and one row an hour for other sites."""
    at = F.timestamp_micros(F.col("id") * micros).cast("timestamp_ntz")
    crowd = spark.range(n).select(F.lit("a").alias("site"), at.alias("ts"), F.col("id").alias("pos"))
    rest = spark.range(n // 10).select(F.lit("b").alias("site"), F.timestamp_seconds(F.col("id") * 3600).cast("timestamp_ntz").alias("ts"), F.col("id").alias("pos"))
    return crowd.unionByName(rest)


@pytest.mark.parametrize("micros", [37_000_000, 60_000, 70, 1])
def test_blocks_stay_small_where_rows_crowd(spark, micros):
    rows, limit = _crowded(spark, 20_000, micros), 500
    cut = blocks.equal_blocks(rows, ["site"], "ts", limit)
    sizes = cut.groupBy("site", "_blk").agg(F.count("*").alias("n"), F.min("ts").alias("lo"), F.max("ts").alias("hi")).collect()
    assert max(r["n"] for r in sizes) <= 2 * limit and len(sizes) < 4 * 22_000 / limit
    for site in "ab":  # blocks follow each other in time
        mine = sorted((r for r in sizes if r["site"] == site), key=lambda r: r["_blk"])
        assert all(x["hi"] < y["lo"] for x, y in zip(mine, mine[1:]))


@pytest.mark.parametrize("micros", [37_000_000, 70])
def test_nearest_in_a_crowded_series(spark, micros):
    rows = _crowded(spark, 20_000, micros)
    targets = spark.range(200).select(F.lit("a").alias("site"), F.timestamp_micros(F.col("id") * 99 * micros + micros // 3).cast("timestamp_ntz").alias("target"), "id")
    targets = targets.unionByName(targets.where("id = 7")).unionByName(spark.createDataFrame([(None, None, 900), ("none", None, 901)], "site STRING, target TIMESTAMP_NTZ, id BIGINT"))
    got = asof.nearest_in_time(targets, rows, ["site"], "target", "ts", "pos", limit=300).collect()
    assert sorted((r["id"], r["pos"]) for r in got) == sorted([(i, i * 99) for i in range(200)] + [(7, 693)])


def test_names_match_labels_as_by_brute_force(spark):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choices("abc ", k=n)).strip()
    names = [word(rng.randint(0, 5)) for _ in range(60)] * 3 + [None, "zzz", "x" * 300]
    labels = [(rng.randint(1, 2), word(rng.randint(0, 12))) for _ in range(40)] * 2 + [(1, None), (2, "x" * 400), (1, "abc"), (2, "abc")]
    got = nearest.match_names(spark.createDataFrame([(n,) for n in names], "q string"), spark.createDataFrame(labels, "k int, label string"), "q", "k", "label")
    want = set()
    for q in {n for n in names if n}:
        hits = {(q, k, label, k if label == q else 3) for k, label in labels if label is not None and q in label}
        want |= {h for h in hits if h[3] == min(h[3] for h in hits)}
    rows = [tuple(r) for r in got.select("q", "k", "label", "match_rank").collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want
    assert nearest.match_names(spark.createDataFrame([], "q string"), spark.createDataFrame(labels, "k int, label string"), "q", "k", "label").count() == 0


def test_late_nowcast_hours_are_settled(spark, tmp_path):
    from stationflow.streaming import feeds
    from stationflow.functions import nowcast_state
    hour = lambda h: datetime(2024, 1, 1) + timedelta(hours=h)
    # batch 0: hours 20 to 35; batch 1: hour 10 comes too late, twice, and hour 25 is repeated; another site has no late hour
    rows = [("a", hour(h), float(h), None, False, 0) for h in range(20, 36)] + [("a", hour(10), 5.0, None, True, 1), ("a", hour(25), 99.0, None, True, 1),
            ("a", hour(10), 7.0, None, True, 2), ("b", hour(3), 4.0, 1.0, False, 0), ("b", hour(3), 4.0, 2.5, False, 1), ("b", hour(4), 4.0, None, False, 1)]
    path = str(tmp_path / "nowcast")
    spark.createDataFrame(rows, nowcast_state.OUTPUT + ", batch INT").write.partitionBy("batch").parquet(path)
    got = {(r["site"], r["ts"].replace(tzinfo=None)): (r["value"], r["nowcast"]) for r in feeds.settled_nowcast(spark, path).collect()}
    assert len(got) == 19 and got["b", hour(3)] == (4.0, 2.5) and got["b", hour(4)] == (4.0, None)
    assert got["a", hour(10)] == (5.0, 5.0) and got["a", hour(25)][0] == 25.0
    # hours whose window reaches into the gap have none any more
    assert [h for h in range(20, 36) if got["a", hour(h)][1] is not None] == [31, 32, 33, 34, 35]
    values = np.array([5.0] + [np.nan] * 9 + [float(h) for h in range(20, 36)])
    assert got["a", hour(35)][1] == pytest.approx(nowcast_state.weighted_means(values, 0)[-1])
