"""Streaming queries, run to the end of the available input and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sinks import merge
from ..streaming import feeds
from .data import HOURLY_TYPE_SQL, SPINE_SQL, hourly_by_type, nowcast_sql, r6, round_columns, table
from .registry import query


def _stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    return feeds.file_stream(spark, sf_dir, schema, "events.parquet")


def _finish(run, spark):
    run.awaitTermination()
    if run.exception() is not None:
        raise run.exception()


@query("""SELECT event_type AS site, date_trunc('hour', ts) AS start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS "end", R6(avg(value)) AS value, count(value) AS n
FROM events GROUP BY 1, 2""")
def stream_hourly(spark, sf_dir):
    """Tumbling hourly mean per site; changed windows are written per batch and read as their last version."""
    src = _stream(spark, sf_dir).withColumnRenamed("event_type", "site")
    path = scratch_path(spark, "hourly")
    means = feeds.windowed_mean(src, ["site"], "ts", "value", "1 hour", delay="2 days")
    _finish(feeds.run_to_table(means, path, scratch_path(spark, "checkpoint"), ["site"]), spark)
    return round_columns(feeds.latest_windows(spark, path, ["site"]), ["value"])


@query("""WITH s AS (SELECT event_type AS site, date_trunc('hour', ts) - to_hours(CAST(i AS INT)) AS start, value FROM events, generate_series(0, 2) g(i))
SELECT site, start, start + INTERVAL 3 HOUR AS "end", R6(avg(value)) AS value, count(value) AS n FROM s GROUP BY 1, 2""")
def stream_rolling(spark, sf_dir):
    """Sliding three-hour mean per site, every hour."""
    src = _stream(spark, sf_dir).withColumnRenamed("event_type", "site")
    path = scratch_path(spark, "rolling")
    means = feeds.windowed_mean(src, ["site"], "ts", "value", "3 hours", "1 hour", delay="2 days")
    _finish(feeds.run_to_table(means, path, scratch_path(spark, "checkpoint"), ["site"]), spark)
    return round_columns(feeds.latest_windows(spark, path, ["site"]), ["value"])


@query("""SELECT user_id AS sensor, ts, R6(min(value)) AS value FROM events GROUP BY 1, 2""")
def stream_ingest(spark, sf_dir):
    """Sensor ingest over three triggers: the newest rows first, late ones after, and repeats with other values, which lose."""
    rows = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("sensor"), "ts").agg(F.min("value").alias("value"))
    first = F.col("ts") >= F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    second = F.col("ts") >= F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    repeats = rows.where(first).withColumn("value", F.col("value") + 1000)
    landed, path, checkpoint = (scratch_path(spark, n) for n in ("landed", "ingest", "checkpoint"))
    for part in (rows.where(first), rows.where(~first & second), rows.where(~second).unionByName(repeats)):
        part.write.mode("append").parquet(landed)
        src = feeds.file_stream(spark, landed, "sensor BIGINT, ts TIMESTAMP_NTZ, value DOUBLE")
        _finish(feeds.append_readings(src, path, checkpoint, "ts"), spark)
    return round_columns(feeds.read_readings(spark, path, "sensor", "ts").select("sensor", "ts", "value"), ["value"])


READING = "sensor BIGINT, ts TIMESTAMP_NTZ, value DOUBLE"


def _arrivals(spark, sf_dir):
    """Readings as they come: the newest first, then the middle, then the oldest with repeats that have other values."""
    rows = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("sensor"), "ts").agg(F.min("value").alias("value"))
    first = F.col("ts") >= F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    second = F.col("ts") >= F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    return [rows.where(first), rows.where(~first & second), rows.where(~second).unionByName(rows.where(first).withColumn("value", F.col("value") + 1000))]


@query("""SELECT user_id AS sensor, ts, R6(min(value)) AS value FROM events GROUP BY 1, 2""")
def stream_merge(spark, sf_dir):
    """Ingest merged as it is written: late rows, repeats that lose, and a checkpoint that is lost, so that everything comes again."""
    landed, root, checkpoint = (scratch_path(spark, n) for n in ("landed", "merged", "checkpoint"))
    for part in _arrivals(spark, sf_dir):
        part.write.mode("append").parquet(landed)
        source = feeds.file_stream(spark, landed, READING)
        _finish(feeds.merge_readings(source, root, checkpoint, ["sensor"], "ts"), spark)
    _finish(feeds.merge_readings(source, root, scratch_path(spark, "checkpoint"), ["sensor"], "ts"), spark)
    return round_columns(merge.read_days(spark, root, source.schema), ["value"])


@query("""SELECT user_id AS sensor, ts, R6(min(value)) AS value FROM events WHERE ts >= TIMESTAMP '2024-01-09' AND ts < TIMESTAMP '2024-01-12' GROUP BY 1, 2""")
def merged_days(spark, sf_dir):
    """Three days of a table that was merged in batch; only their folders are opened."""
    root = scratch_path(spark, "merged")
    parts = _arrivals(spark, sf_dir)
    for part in parts:
        merge.merge_rows(part, root, ["sensor"], "ts")
    days = F.col(merge.DAY).between(F.lit("2024-01-09").cast("date"), F.lit("2024-01-11").cast("date"))
    return round_columns(merge.read_days(spark, root, parts[0].schema, days), ["value"])


def _nowcast_of(spark, parts):
    """NowCast table after one trigger for each of ``parts``, settled."""
    key, store = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = spark.conf.get(key)
    landed, path, checkpoint = (scratch_path(spark, n) for n in ("hourly-input", "nowcast", "checkpoint"))
    spark.conf.set(key, store)
    try:
        for part in parts:
            part.write.mode("append").parquet(landed)
            src = feeds.file_stream(spark, landed, "site STRING, ts TIMESTAMP, value DOUBLE")
            _finish(feeds.append_to_table(feeds.streaming_nowcast(src), path, checkpoint), spark)
    finally:
        spark.conf.set(key, before)
    return feeds.settled_nowcast(spark, path)


@query(f"""WITH {HOURLY_TYPE_SQL}, {SPINE_SQL}
SELECT site, ts, R6(nowcast) AS nowcast FROM {nowcast_sql('g', 'value')} WHERE value IS NOT NULL""")
def stream_nowcast(spark, sf_dir):
    """NowCast with bounded state per site over a stream of hourly means whose triggers come in the wrong order."""
    rows = hourly_by_type(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    third = F.pmod(F.floor(F.unix_timestamp("ts") / F.lit(86400 * 4)), F.lit(3))
    return _nowcast_of(spark, [rows.where(third == part) for part in (2, 0, 1)]).select("site", "ts", r6("nowcast").alias("nowcast"))


@query(f"""WITH {HOURLY_TYPE_SQL.replace('h AS', 'landed AS', 1)},
h AS (SELECT site, CASE WHEN ts >= TIMESTAMP '2024-01-21' THEN ts + INTERVAL 120 DAY ELSE ts END AS ts, value FROM landed), {SPINE_SQL}
SELECT site, ts, R6(value) AS value, R6(nowcast) AS nowcast FROM {nowcast_sql('g', 'value')} WHERE value IS NOT NULL""")
def stream_nowcast_late(spark, sf_dir):
    """NowCast where a third of the hours comes over 100 days behind the newest: before the site's first hour, between its hours, and as
    repeats with other values, which lose. One site gets no late hour."""
    rows = hourly_by_type(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    newest, middle = F.col("ts") >= F.lit("2024-01-21").cast("timestamp"), F.col("ts") >= F.lit("2024-01-11").cast("timestamp")
    shifted = rows.where(newest).withColumn("ts", F.col("ts") + F.expr("INTERVAL 120 DAYS"))
    kept = (F.hour("ts") % 2 == 0) | (F.col("site") == "view")
    first = rows.where(~newest & ((middle & kept) | (F.col("site") == "view")))
    repeats = first.where("site <> 'view'").withColumn("value", F.col("value") + 1000)
    late = rows.where(~newest & (F.col("site") != "view"))
    return _nowcast_of(spark, [shifted.unionByName(first), late.where(~middle), late.where(middle & ~kept).unionByName(repeats)]).select(
        "site", "ts", r6("value").alias("value"), r6("nowcast").alias("nowcast"))
