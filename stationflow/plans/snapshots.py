"""Hourly cross-site snapshots from site forecast documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fv
from ..functions import times as t
from ..operators import asof, joins
from ..sources.readers import document_rows


def _with_time(rows: DataFrame, column: str) -> DataFrame:
    return rows.withColumn("_at", F.col(column).try_cast(t.NTZ))


def hourly_snapshots(documents: DataFrame, index: DataFrame | None, start: Column, default_source: str,
                     hours: int = 96) -> DataFrame:
    """For each hour and site the forecast row closest in time, all its fields kept.

    Species and sources come from the first index entry of the same name that shares a
    source with the document, else from the document.
    """
    head = documents.select("site", "timezone", "species", "sources", "observation_source")
    if index is not None:
        entries = index.select(F.col("location_name").alias("site"), F.col("sources"), "species", "position")
        head = joins.first_overlapping(head, entries, "site", "sources", "position")
        head = head.withColumns({
            "species": F.when(F.col("index_position").isNotNull(), F.col("index_species")).otherwise(F.col("species")),
            "sources": F.when(F.col("index_position").isNotNull(), F.col("index_sources")).otherwise(F.col("sources")),
        }).drop("index_position", "index_species", "index_sources")
    first = F.date_trunc("HOUR", start).cast(t.NTZ)
    targets = joins.hours_of_sites(head.select("site"), first, hours).drop("offset")
    near = asof.nearest_in_time(targets, _with_time(document_rows(documents), "time"), ["site"], "target", "_at", "position")
    out = near.drop("_at", "position").join(head, "site").withColumnRenamed("target", "forecast_hour")
    return _defaults(out, default_source)


def local_snapshots(documents: DataFrame, start: Column, default_source: str, hours: int = 96,
                    fields: Sequence[str] = tuple(fv.SNAPSHOT_FIELDS)) -> DataFrame:
    """Reduced snapshot rows matched on local time; the earlier row wins a tie."""
    head = documents.select("site", F.coalesce("timezone", F.lit("UTC")).alias("timezone"), "species", "observation_source")
    first = F.date_trunc("HOUR", start).cast(t.NTZ)
    targets = joins.hours_of_sites(head, first, hours).select(
        "site", F.col("target").alias("forecast_hour"), t.hour_floor(t.to_local(F.col("target"), F.col("timezone"))).alias("target"))
    rows = document_rows(documents)
    rows = _with_time(rows.select("site", "position", "local_time", *[
        F.col(c) if c in rows.columns else F.lit(None).cast("double").alias(c) for c in fields]), "local_time")
    near = asof.nearest_in_time(targets, rows, ["site"], "target", "_at", prefer="earlier")
    out = near.drop("_at", "position", "target").join(head, "site")
    return _defaults(out, default_source)


def _defaults(out: DataFrame, default_source: str) -> DataFrame:
    return out.withColumns({
        "species": F.coalesce("species", F.lit(fv.DEFAULT_SPECIES)),
        "observation_source": F.coalesce("observation_source", F.lit(default_source)),
        "timezone": F.coalesce("timezone", F.lit("UTC")),
    }).withColumnRenamed("site", "location_name")
