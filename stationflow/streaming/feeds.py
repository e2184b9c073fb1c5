"""Structured Streaming versions of the incremental feeds.

Event times are cast to TIMESTAMP (watermarks need it); the session zone is UTC. Checkpoints and outputs
live below the caller's path, normally the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions import nowcast_state, times as t
from ..operators import align, blocks, windows
from ..session import cut_lineage
from ..sinks import merge


def file_stream(spark: SparkSession, folder: str, schema: StructType | str, file_glob: str | None = None,
                files_per_trigger: int | None = None) -> DataFrame:
    """Parquet folder as a stream."""
    reader = spark.readStream.schema(schema)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def event_time(df: DataFrame, ts: str, delay: str) -> DataFrame:
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def append_readings(stream: DataFrame, path: str, checkpoint: str, ts: str):
    """Run an ingest: each batch replaces its own folder, so a repeated batch changes nothing.

    Every row is kept, however late; :func:`read_readings` settles repeats of a sensor and time.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        day = batch.withColumns({ts: F.col(ts).cast(t.NTZ), "day": F.to_date(ts), "batch": F.lit(batch_id)})
        day.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "day").parquet(path)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_readings(spark: SparkSession, path: str, sensor: str, ts: str) -> DataFrame:
    """Ingested readings, one per sensor and time: the earliest batch wins."""
    from ..operators.setops import keep_first
    return keep_first(spark.read.parquet(path), [sensor, ts], ["batch"]).drop("batch", "day")


def merge_readings(stream: DataFrame, root: str, checkpoint: str, keys: list[str], ts: str, keep: int = 2):
    """Run an ingest that merges each batch into the days it touches (:func:`merge.merge_rows`), read by :func:`merge.read_days`.

    A batch that is run again, after a failure or with a lost checkpoint, changes nothing.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        merge.merge_rows(batch.withColumn(ts, F.col(ts).cast(t.NTZ)), root, keys, ts, keep)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_mean(stream: DataFrame, keys: list[str], ts: str, value: str, size: str, slide: str | None = None,
                  delay: str = "1 hour") -> DataFrame:
    """Mean per key and time window (tumbling, or sliding with ``slide``)."""
    win = F.window(ts, size, slide) if slide else F.window(ts, size)
    return event_time(stream, ts, delay).groupBy(*keys, win).agg(F.avg(value).alias(value), F.count(value).alias("n"))


def run_to_table(result: DataFrame, path: str, checkpoint: str, keys: list[str], mode: str = "update"):
    """Run a windowed stream to its end; every batch writes the windows it changed to its own folder."""
    def write(batch: DataFrame, batch_id: int) -> None:
        flat = batch.withColumns({"start": F.col("window.start").cast(t.NTZ), "end": F.col("window.end").cast(t.NTZ)})
        flat.drop("window").withColumn("batch", F.lit(batch_id)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)
    return result.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start()


def latest_windows(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Current state of a window table: the last written version of every window."""
    df = spark.read.parquet(path)
    rest = [c for c in df.columns if c not in (*keys, "start", "batch")]
    newest = df.groupBy(*keys, "start").agg(F.max_by(F.struct(*rest), "batch").alias("_r"))
    return newest.select(*keys, "start", "_r.*")


# ---- NowCast with state --------------------------------------------------------------------

def streaming_nowcast(hourly: DataFrame) -> DataFrame:
    """NowCast over a stream of hourly rows ``site, ts, value`` that may come in any order.

    Needs the RocksDB state store. A site keeps ``nowcast_state.KEPT`` hours of state, whatever its history. A late hour within
    them sends out anew all hours whose window holds it. One behind them is sent on marked ``late``; :func:`settled_nowcast` reads
    the last version of each hour and settles the late ones.
    """
    return hourly.groupBy("site").transformWithStateInPandas(
        statefulProcessor=nowcast_state.NowCastProcessor(), outputStructType=nowcast_state.OUTPUT, outputMode="Append",
        timeMode="None")


def append_to_table(result: DataFrame, path: str, checkpoint: str):
    """Run an append stream to its end into Parquet; every batch has its own folder."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)
    return result.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def settled_nowcast(spark: SparkSession, path: str) -> DataFrame:
    """``site, ts, value, nowcast`` of a table of :func:`streaming_nowcast`, one row per site and hour that has a value.

    The earliest batch's value of an hour wins. Sites with an hour that came too late for the state are computed again from
    their landed rows, in blocks of time; the rows of all others are those the stream wrote last.
    """
    written = spark.read.schema(nowcast_state.OUTPUT + ", batch INT").parquet(path)
    rows = written.groupBy("site", F.col("ts").cast(t.NTZ).alias("ts")).agg(
        F.min_by("value", "batch").alias("value"), F.min_by("late", "batch").alias("late"),
        F.max_by(F.struct("nowcast"), F.when(~F.col("late"), F.col("batch"))).alias("_last"))
    rows = cut_lineage(rows, "nowcast-rows")
    reopened = rows.where("late").select("site").distinct()
    series = align.regular_calendar(rows.join(reopened, "site", "left_semi").select("site", "ts", "value"), ["site"], "ts")
    again = blocks.with_trailing_frames(series, ["site"], t.hour_index(F.col("ts")), windows.nowcast_stages("value", name="nowcast"))
    return rows.join(reopened, "site", "left_anti").select("site", "ts", "value", "_last.nowcast").unionByName(
        again.where("value IS NOT NULL").select("site", "ts", "value", "nowcast"))
