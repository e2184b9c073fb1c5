"""Time series tables that are merged when they are written: one row per key and time, one published folder per day.

A reading that comes again changes nothing and a late one reaches its own day, so readers need no deduplication and open only the days they ask for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, StructField, StructType

from ..operators.setops import keep_first, precedence_union
from ..session import cut_lineage
from . import publish

DAY = "_day"


def table_schema(rows: StructType) -> StructType:
    """Columns of the table for rows of this schema."""
    return StructType([*rows.fields, StructField(DAY, DateType())])


def merge_rows(new: DataFrame, root: str, keys: Sequence[str], ts: str, keep: int = 2) -> int | None:
    """Merge ``new`` into the table at ``root``; returns the published generation, None if ``new`` has no row.

    Only the days that ``new`` touches are read and written. A row that the table has stays as it is; of several new rows of a key and time the
    first by the remaining columns is taken. So merging the same rows twice, after a run that died at any point too, gives the same table. Rows with a null time
    have a folder of their own, null keys count as one key. ``keep`` generations stay on disk for readers still at work. One writer at a time.
    """
    spark, at = new.sparkSession, [*keys, ts]
    batch = cut_lineage(keep_first(new, at, []).withColumn(DAY, F.to_date(ts)), "batch")
    if batch.isEmpty():
        return None
    old = publish.read_partitions(spark, root, batch.schema, batch.select(DAY).distinct())
    merged = precedence_union([old, batch], at)
    # a day becomes as many files as its size asks for
    number = publish.publish(merged.hint("rebalance", F.col(DAY)), root, [DAY])
    publish.discard(spark, root, keep)
    return number


def read_days(spark: SparkSession, root: str, rows: StructType, wanted: Column | None = None) -> DataFrame:
    """Rows of the table; ``wanted``, a condition on the date column :data:`DAY`, picks the days that are opened."""
    schema = table_schema(rows)
    if wanted is None:
        return publish.read_published(spark, root, schema).drop(DAY)
    days = publish.manifest(spark, root).where(wanted).select(DAY)
    return publish.read_partitions(spark, root, schema, days).drop(DAY)
