"""Plans and forms that keep a query within its memory as tables grow, each beside its result."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stationflow.catalog import QUERIES
from stationflow.operators import joins

EVENTS = "event_id LONG, ts TIMESTAMP_NTZ, user_id LONG, event_type STRING, value DOUBLE, props STRING"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_overlay_sends_no_leaves_to_the_driver(spark):
    left = spark.range(20).select(F.col("id").alias("key"), F.lit('{"a":{"b":{"c":1}},"d":2}').alias("doc"))
    right = spark.range(0, 20, 2).select(F.col("id").alias("key"), F.lit('{"a":{"b":{"c":3}}}').alias("doc"))
    out = joins.merge_documents(left, right, "key", "doc")
    assert "Broadcast" not in plan(out)
    assert out.where("path = 'a.b.c' AND value = '3'").count() == 10 and out.count() == 40


def test_overlay_of_several_documents_and_missing_keys(spark):
    left = spark.createDataFrame([(1, '{"a":{"x":1}}'), (1, '{"a":{"x":2}}'), (None, '{"a":1}'), (2, None)], "key INT, doc STRING")
    right = spark.createDataFrame([(1, '{"a":{"y":3}}'), (None, '{"a":2}')], "key INT, doc STRING")
    got = sorted((r.key or 0, r.path, r.value) for r in joins.merge_documents(left, right, "key", "doc").collect())
    assert got == [(0, "a", "1"), (0, "a", "2"), (1, "a.x", "1"), (1, "a.x", "2"), (1, "a.y", "3"), (2, "", "{}")]


def test_sensor_chain_leaves_zeros_out(spark, tmp_path):
    rows = [(i, datetime(2024, 1, 1, 0, i), 2, "view", v, None) for i, v in enumerate([0.0, 4.0, 8.0, -1.0])]
    spark.createDataFrame(rows, EVENTS).write.parquet(str(tmp_path / "events.parquet"))
    assert [r.value for r in QUERIES["sensor_chain"](spark, str(tmp_path)).collect()] == [pytest.approx(6.0, abs=1e-5)]


def test_nearest_in_time_broadcasts_nothing(spark):
    from stationflow.operators import asof
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    series = spark.range(40).select((F.col("id") % 4).alias("site"), (start + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("ts"), "id")
    targets = joins.hours_of_sites(spark.range(4).withColumnRenamed("id", "site"), start, 8).drop("offset")
    out = asof.nearest_in_time(targets, series, ["site"], "target", "ts", "id")
    assert "Broadcast" not in plan(out) and out.count() == 32


def test_documents_as_lines(spark, tmp_path):
    from stationflow.sinks import writers
    from stationflow.sources import readers
    docs = spark.range(300).select(F.concat(F.lit('a"b/'), F.col("id")).alias("site"), F.lit('{"location":"x","forecasts":[{"time":"2024-01-01 00:00:00","no2":NaN},{"no2":2}]}').alias("document"))
    writers.document_lines(docs.coalesce(2), str(tmp_path / "d"), "site")
    assert len(list((tmp_path / "d").glob("part*"))) <= 2
    rows = readers.document_rows(readers.forecast_documents(spark, str(tmp_path / "d"), {"no2": "DOUBLE"}, lines=True)).collect()
    assert len(rows) == 600 and {r.site for r in rows} == {f'a"b/{i}' for i in range(300)} and {r.no2 for r in rows} == {None, 2.0}


def test_snapshot_hours_have_few_files(spark, tmp_path):
    from stationflow.sinks import writers
    rows = spark.range(0, 2000, 1, 40).select(F.timestamp_millis(F.col("id") % 2 * 3_600_000).cast("timestamp_ntz").alias("hour"), "id")
    writers.snapshot_rows(rows, str(tmp_path / "s"), "hour")
    assert len(list((tmp_path / "s").glob("*/part*"))) <= 2 * writers.HOUR_FILES and spark.read.json(str(tmp_path / "s")).count() == 2000


def test_stations_of_a_common_name_are_dealt_in_parts(spark, monkeypatch):
    from stationflow.operators import nearest
    monkeypatch.setattr(nearest, "PART_ROWS", 3)
    stations = spark.createDataFrame([(i, "north" if i < 5 else "south port", 0.0, float(i)) for i in range(8)], "station INT, label STRING, lat DOUBLE, lon DOUBLE")
    asked = [(i, "North ", 0.0, 0.0) for i in range(9)] + [(9, "port", 0.0, 0.0), (10, "?", 0.0, 6.2), (10, "?", 0.0, 6.2), (11, "north", 0.0, 0.0), (11, "7", 0.0, 0.0),
                                                           (12, "sou", 0.0, 0.0), (12, "port", 0.0, 0.0)]
    sites = spark.createDataFrame(asked, "site INT, asked STRING, lat DOUBLE, lon DOUBLE")
    dealt = nearest._named(spark.createDataFrame([(i, "n") for i in range(9)], "site INT, _q STRING"),
                           spark.createDataFrame([("n", i, 1) for i in range(5)], "_q STRING, station INT, match_rank INT"), "site", "station")
    assert dealt.distinct().count() == dealt.count() == 45
    got = sorted(nearest.match_stations(sites, stations, "site", "asked", "station", "label").collect())
    want = [(s, i, 1) for s in [*range(9), 11] for i in range(5)] + [(s, i, 3) for s in (9, 12) for i in (5, 6, 7)] + [(10, 6, 4)]
    assert [tuple(r) for r in got] == sorted(want)


def test_sites_of_a_cell_share_one_series(spark):
    from stationflow.plans import series
    at = F.lit("2024-01-01").cast("timestamp_ntz").alias("ts")
    grid = spark.range(2).select(at, F.lit(10.0).alias("lat"), (F.col("id") * 5.0).alias("lon"), (F.col("id") + 1.0).alias("no2"),
                                 F.lit(0.5).alias("aod550_sala"), F.lit(1.0).alias("aod550_salc"))
    later = grid.withColumn("no2", F.col("no2") * 10)
    # site 3 has two places, whose rows of one time are one row; site 4 has none
    sites = spark.createDataFrame([(0, 10.1, 0.1), (1, 10.0, 0.0), (2, 10.0, 5.0), (3, 10.0, 0.0), (3, 10.0, 5.0), (4, None, 1.0)], "site INT, lat DOUBLE, lon DOUBLE")
    out = series.read_model([grid, later], sites, "site", "ts")
    assert sorted((r.site, round(r.no2 / 1e9)) for r in out.collect()) == [(0, 1), (1, 1), (2, 2), (3, 1)]
    # no row of a site is aggregated: the last step is the join with the sites
    tail = plan(out).split("HashAggregate")[0].split("SortAggregate")[0]
    assert "Join" in tail


def test_missing_steps_are_made_as_rows_stream_by(spark):
    from stationflow.operators import align
    day = F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 86400).cast("timestamp_ntz")
    rows = spark.range(0, 10, 3).select(F.lit("a").alias("site"), day.alias("ts"), F.col("id").cast("double").alias("value"))
    rows = rows.unionByName(spark.range(1).select(F.lit("b").alias("site"), F.lit(None).cast("timestamp_ntz").alias("ts"), F.lit(1.0).alias("value")))
    for out, n in ((align.resample_mean(rows, ["site"], "ts", ["value"], 3 * 3600), 73), (align.resample_mean(rows, ["site"], "ts", ["value"], 5 * 86400), 2),
                   (align.hourly_mean_gapless(rows, ["site"], "ts", ["value"], pad_hours=2), 219), (align.regular_calendar(rows, ["site"], "ts", 1800, 3600), 435)):
        text = plan(out)
        # rows are read once, and no step enters an aggregation, join or exchange after it was made
        assert text.count("Range (") == 1 and "Join" not in text
        assert text.index("Generate") < min([text.find(x) for x in ("HashAggregate", "Exchange", "Sort") if x in text])
        assert out.count() == n and out.where("site = 'b'").count() == 0
        assert out.selectExpr("sum(value)").first()[0] in (18.0, 1.5 + 7.5)


def test_merged_series_is_not_aggregated_after_its_steps_are_made(spark):
    from stationflow.plans import series
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 7200).cast("timestamp_ntz")
    model = spark.range(3).select(F.lit("a").alias("site"), at.alias("ts"), F.col("id").cast("double").alias("model"))
    obs = spark.range(0, 3, 2).select(F.lit("a").alias("site"), at.alias("ts"), F.col("id").cast("double").alias("value"))
    out = series.merge_series(model, obs, ["site"], "ts")
    text = plan(out)
    assert text.index("Generate") < min(text.find(x) for x in ("HashAggregate", "Exchange", "Sort") if x in text)
    assert [(r.ts.hour, r.model, r.value) for r in out.orderBy("ts").collect()] == [(0, 0, 0), (1, None, None), (2, 1, 1), (3, None, None), (4, 2, 2)]


def test_tasks_of_a_merged_series_follow_its_rows(spark, monkeypatch):
    import re
    from stationflow.operators import align, blocks
    from stationflow.plans import series
    monkeypatch.setattr(blocks, "TASK_POINTS", 1)
    hour = lambda h: datetime(2024, 1, 1, h)
    model = spark.createDataFrame([("a", hour(0), 5.0), ("a", hour(0), 3.0), ("a", hour(2), 7.0), ("b", hour(1), None), (None, hour(1), 9.0), ("a", None, 9.0)],
                                  "site STRING, ts TIMESTAMP_NTZ, model DOUBLE")
    obs = spark.createDataFrame([("a", hour(1), 1.0), ("a", hour(2), None), ("a", hour(2), 8.0), ("a", hour(4), 4.0), (None, hour(1), 9.0)], "site STRING, ts TIMESTAMP_NTZ, value DOUBLE")
    out = series.merge_series(model, obs, ["site"], "ts")
    # 8 rows of 2 values that have a site and a time: 16 tasks, whatever the session's number, and no join of one side with the other
    text = plan(out)
    assert set(re.findall(r"hashpartitioning\(site#\d+, (\w+)#\d+L, (\d+)\), REPARTITION_BY_NUM", text)) == {("_blk", "16"), ("_s", "16")}
    assert "FullOuter" not in text
    assert [(r.site, r.ts.hour, r.model, r.value) for r in out.orderBy("site", "ts").collect()] == [
        ("a", 0, 3, None), ("a", 1, 5, 1), ("a", 2, 7, 2), ("a", 3, None, None), ("a", 4, None, 4), ("b", 1, None, None)]
    assert [(r.ts.hour, r.model, r.value) for r in series.merge_series(model, obs, ["site"], "ts", interpolate=False).where("site = 'a'").orderBy("ts").collect()] == [
        (0, 3, None), (1, None, 1), (2, 7, None), (3, None, None), (4, None, 4)]
    means = align.hourly_mean(model, ["site"], "ts", ["model"], tasks=7)
    assert means.count() == 5 and plan(means).count("Exchange") == 1 and ", 7), REPARTITION_BY_NUM" in plan(means)


def test_instrument_lines_are_taken_apart_once(spark, tmp_path):
    from stationflow.sources import readers
    head = ["Full location name: Station 1", "Location latitude [deg]: 1", "Location longitude [deg]: -10", "-" * 87]
    line = " ".join(["20240101T000000.0Z", *["0"] * 12, "1000", "300", *["0"] * 40, "1e-9", *["0"] * 13])
    (tmp_path / "a.txt").write_text("\n".join([*head, line, line.replace("1e-9", "-9e99")]) + "\n")
    out = readers.instrument_text(spark, str(tmp_path), "no2")
    assert plan(out).count("split(") == 1
    assert [(r.time, r.lat, r.lon, r.location) for r in out.collect()] == [(datetime(2024, 1, 1), 1, -10, "Station 1")]


def test_equal_phrases_are_added_up_whatever_they_are_ordered_by():
    import numpy as np
    from stationflow.llm import phrases
    drawn = np.random.default_rng(5)
    for n in (2, 3, 4):
        codes = drawn.integers(1, 6, (n, 5000))
        high = np.zeros(5000, dtype=np.int64)
        for c in codes[:-1]:
            high = high << 21 | c
        key = phrases.order_key(n, high, codes[-1])
        # one number for a phrase, another for any other: one pass finds each phrase once
        assert len(np.unique(key)) == len(set(map(tuple, codes.T.tolist())))
        counter = phrases.Counter("en", 1, 2, np.zeros((3, 1 << 16), dtype=np.uint8), 16)
        counter.codes([f"w{i}" for i in range(1, 6)])
        counter.gathered[n] = [(high, codes[-1], np.ones(5000, dtype=np.int64), np.ones(5000, dtype=np.int64))]
        counter.merge(n)
        out = counter.phrases(n)
        want = {}
        for row in codes.T.tolist():
            name = " ".join(f"w{i}" for i in row)
            want[name] = want.get(name, 0) + 1
        assert out.num_rows == len(want) and dict(zip(out["phrase"].to_pylist(), out["c"].to_pylist())) == want
