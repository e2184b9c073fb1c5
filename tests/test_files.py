import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stationflow.sinks import merge, publish, writers
from stationflow.sources import readers
from stationflow.streaming import feeds


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_observation_csv(spark, tmp_path):
    path = put(tmp_path / "Quito_2024.csv", "Time,NO2\n01/02/2024 03:04:05,1.88\n01/02/2024 04:00:00,-1\n01/02/2024 05:00:00,\n01/02/2024 06:00:00,NaN\n")
    rows = readers.observation_csv(spark, path, "Time", "MM/dd/yyyy HH:mm:ss", "NO2", "no2", "ugm3", lat=1.0, lon=2.0).collect()
    assert len(rows) == 1 and rows[0].value == pytest.approx(1.0) and rows[0].location == "Quito" and rows[0].time.hour == 3


def instrument_line(time, conc, quality="0"):
    cols = ["0"] * 60
    cols[0], cols[13], cols[14], cols[52], cols[55] = time, "1013.25", "298", quality, conc
    return " ".join(cols)


def test_instrument_text(spark, tmp_path):
    head = "Full location name: Some Place\nLocation latitude [deg]: -12.5\nLocation longitude [deg]: 7\n" + "-" * 87 + "\n"
    body = "\n".join([instrument_line("20240102T030405.5Z", "1e-8"), instrument_line("20240102T040000Z", "-9e99"), instrument_line("20240102T050000.0Z", "1")])
    rows = readers.instrument_text(spark, put(tmp_path / "a.txt", head + body), "no2").collect()
    assert len(rows) == 1
    assert rows[0].location == "Some Place" and rows[0].lat == -12.5
    assert rows[0].value == pytest.approx(1e-8 * 24.45e9 / (0.0821 * 298) / 40)
    with pytest.raises(ValueError):
        readers.instrument_text(spark, str(tmp_path / "a.txt"), "co")


def test_documents_with_bare_nan(spark, tmp_path):
    put(tmp_path / "Lima.json", '{"location": "Lima", "timezone": "America/Lima", "forecasts": [{"time": "2024-01-01 00:00:00", "no2": NaN},\n {"time": "2024-01-01 01:00:00", "no2": 2.5}]}')
    docs = readers.forecast_documents(spark, str(tmp_path), {"no2": "DOUBLE"})
    rows = readers.document_rows(docs).orderBy("position").collect()
    assert [r.no2 for r in rows] == [None, 2.5] and rows[0].site == "Lima"


def test_registry_and_index(spark, tmp_path):
    registry = {"S1": {"location_name": "Lima", "lat": 1.0, "lon": 2.0, "observation_source": "x", "obs_options": {"no2": {"file": "f.csv", "unit": "ppb"}}}}
    sites = readers.site_options(readers.site_registry(spark, put(tmp_path / "r.json", json.dumps(registry, indent=2))), "no2").collect()
    assert sites[0].site_id == "S1" and sites[0].obs_options_no2_file == "f.csv"
    index = [{"location_name": "Lima", "species": "no2", "sources": ["a"]}, {"location_name": "Oslo", "species": "o3", "sources": []}]
    rows = readers.site_index(spark, put(tmp_path / "i.json", json.dumps(index))).orderBy("position").collect()
    assert [r.location_name for r in rows] == ["Lima", "Oslo"]


def test_names_in_paths(spark, tmp_path):
    put(tmp_path / "loc_12_500000_m3_250000_v1.csv", "time,no2\n2024-01-01 00:10:00,1\n")
    put(tmp_path / "loc_12_500000_m3_250000_v2.csv", "time,no2\n2024-01-01 00:00:00,5\n2024-01-01 01:00:00,6\n")
    rows = readers.cached_series(spark, str(tmp_path)).orderBy("time").collect()
    assert [(r.lat, r.lon, r.version, r.no2) for r in rows] == [(12.5, -3.25, 1, 1.0), (12.5, -3.25, 2, 6.0)]
    put(tmp_path / "obs" / "Old_Town_no2.csv", "time,val,latitude,longitude\n2024-01-01 00:10:00,4,1,2\n")
    row = readers.observation_cache(spark, str(tmp_path / "obs"), "no2").first()
    assert row.site == "Old_Town" and row.value == 4.0 and row.lat == 1.0


def test_inventory_and_listing(spark, tmp_path):
    put(tmp_path / "a" / "x.csv", "1\n")
    put(tmp_path / "y.txt", "see 3MAIN12.json and 9.json, AB7c.json\n")
    assert [r.name for r in readers.inventory(spark, str(tmp_path), ".csv").collect()] == ["x.csv"]
    assert sorted(r.file for r in readers.monitor_files(spark, str(tmp_path / "y.txt")).collect()) == ["3MAIN12.json", "AB7c.json"]
    assert readers.by_extension(spark, str(tmp_path / "y.txt")).columns == ["value"]


def test_site_document(spark):
    rows = spark.sql("""SELECT 's' AS site, TIMESTAMP_NTZ'2024-01-01 01:00:00' AS time, 1.256D AS no2, 'UTC' AS timezone
      UNION ALL SELECT 's', TIMESTAMP_NTZ'2024-01-01 00:00:00', CAST(NULL AS DOUBLE), 'UTC'""")
    head = spark.sql("SELECT 's' AS site, 'Lima' AS location, 1D AS lat, 2D AS lon, 'no2' AS species, 'model' AS sources")
    scores = spark.sql("SELECT 's' AS site, 0.5D AS r2, CAST(NULL AS DOUBLE) AS rmse, 2D AS mae")
    doc = json.loads(writers.site_documents(rows, head, scores, "site", F.lit("2024-02-01 05:30:00").cast("timestamp_ntz")).first().document)
    assert doc["latest_update"] == "2024-02-01 05:00:00" and doc["sources"] == ["model"]
    assert [f["no2"] for f in doc["forecasts"]] == [None, 1.26] and doc["metrics"]["total_observation"] == 2
    assert doc["metrics"]["performance"]["metrics"] == [{"name": "r2", "value": "0.5"}, {"name": "rmse", "value": "N/A"}, {"name": "mae", "value": "2.0"}]


def test_snapshot_documents_in_parts(spark):
    snaps = spark.range(20).select(F.lit("2024-01-01 05:00:00").cast("timestamp_ntz").alias("forecast_hour"), F.col("id").alias("location_name"))
    docs = writers.snapshot_documents(snaps, "forecast_hour", "location_name", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), parts=3).collect()
    assert {d.file for d in docs} == {"2024-01-01_05.json"} and sum(len(json.loads(d.document)["sites"]) for d in docs) == 20


def test_publication_by_manifest(spark, tmp_path):
    root = str(tmp_path / "out")
    rows = lambda *r: spark.createDataFrame(r, "v long, kind string, day string")
    first = rows((1, "a b", "d1"), (2, "x:+y", "d1"), (3, "a b", "d2"), (4, None, "d2"))
    read = lambda g=None: sorted((r["v"], r["kind"], r["day"]) for r in publish.read_published(spark, root, first.schema, g).collect())
    with pytest.raises(FileNotFoundError):
        read()
    assert publish.publish(first, root, ["kind", "day"]) == 1
    whole = [(1, "a b", "d1"), (2, "x:+y", "d1"), (3, "a b", "d2"), (4, None, "d2")]
    assert read() == whole
    # a publication that died: files staged, the manifest cut off
    rows((9, "a b", "d1")).write.partitionBy("kind", "day").parquet(f"{root}/data/generation=2")
    assert read() == whole
    cut = publish.manifest(spark, root).limit(1).selectExpr("*", "5L AS entries")
    cut.write.parquet(f"{root}/manifest/generation=2")
    assert read() == whole
    # the next one takes its place; a partition is replaced whole, also the one with a null value
    assert publish.publish(rows((5, "a b", "d1"), (6, "a b", "d1"), (7, None, "d2")), root, ["kind", "day"]) == 2
    second = [(2, "x:+y", "d1"), (3, "a b", "d2"), (5, "a b", "d1"), (6, "a b", "d1"), (7, None, "d2")]
    assert read() == second and read(1) == whole
    assert publish.publish(first.limit(0), root, ["kind", "day"], expired=F.col("day") == "d2") == 3
    assert read() == [r for r in second if r[2] == "d1"] and read(2) == second
    names = [r["folder"] for r in publish.manifest(spark, root).collect()]
    assert names == sorted(names) and publish.damaged(spark, root, first.schema, ["kind", "day"]).count() == 0
    # only what no kept manifest lists goes; a second run finds nothing
    gone = publish.discard(spark, root, keep=2)
    assert len(gone) == 2 and all(f.startswith("generation=1/") for f in gone) and read() == [r for r in second if r[2] == "d1"] and read(2) == second
    assert publish.discard(spark, root, keep=2) == []
    rows((8, "a b", "d1")).drop("kind", "day").write.mode("append").parquet(f"{root}/data/generation=2/kind=a b/day=d1")
    assert [r["folder"] for r in publish.damaged(spark, root, first.schema, ["kind", "day"]).collect()] == ["generation=2/kind=a b/day=d1"]
    publish.publish(first.limit(0), root, ["kind", "day"], expired=F.lit(True))
    assert read() == []


def test_merged_ingest_survives_repeats_and_a_killed_batch(spark, tmp_path, monkeypatch):
    schema = "sensor INT, ts TIMESTAMP_NTZ, value DOUBLE"
    day = lambda d, h=0: datetime(2024, 1, d, h)
    parts = [[(1, day(5), 1.0), (2, day(5), 2.0), (1, day(6), 3.0), (None, day(6), 4.0)],
             [(1, day(5), 100.0), (1, day(2), 5.0), (1, day(2), 4.5), (3, None, 6.0)],  # a repeat that loses, a late day, two at once, no time
             [(2, day(6), 7.0), (3, None, 60.0), (None, day(6), 40.0)]]
    want = {(1, day(5), 1.0), (2, day(5), 2.0), (1, day(6), 3.0), (None, day(6), 4.0), (1, day(2), 4.5), (3, None, 6.0), (2, day(6), 7.0)}
    landed, root, checkpoint = (str(tmp_path / n) for n in ("landed", "merged", "checkpoint"))
    spark.createDataFrame([], schema).write.parquet(landed)
    stream = feeds.file_stream(spark, landed, schema)
    rows = lambda wanted=None: merge.read_days(spark, root, stream.schema, wanted)

    def trigger(at=checkpoint):
        run = feeds.merge_readings(stream, root, at, ["sensor"], "ts")
        run.awaitTermination()

    whole, calls = publish._folders, []

    def dies(*args):
        calls.append(1)
        raise RuntimeError("killed before the manifest")

    for i, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(landed)
        if i == 1:
            before = set(map(tuple, rows().collect()))
            monkeypatch.setattr(publish, "_folders", dies)
            with pytest.raises(Exception, match="killed"):
                trigger()
            assert calls and set(map(tuple, rows().collect())) == before  # readers see nothing of it
            monkeypatch.setattr(publish, "_folders", whole)
        trigger()
    got = [tuple(r) for r in rows().collect()]
    assert len(got) == len(want) and set(got) == want
    trigger(str(tmp_path / "another"))  # the checkpoint is lost: all files come again as one batch
    got = [tuple(r) for r in rows().collect()]
    assert len(got) == len(want) and set(got) == want
    one = rows(F.col(merge.DAY) == F.lit("2024-01-05").cast("date"))
    assert {r.value for r in one.collect()} == {1.0, 2.0} and all("_day=2024-01-05" in f for f in one.inputFiles())
    assert merge.merge_rows(spark.createDataFrame([], schema), root, ["sensor"], "ts") is None
