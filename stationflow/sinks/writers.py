"""Writers and the tables they publish."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fv
from ..functions import names, times as t
from ..operators import clean
from ..operators.joins import lookup

CACHE_DAYS = {1: 30, 2: 5}


def settled_rows(df: DataFrame, ts: str, version: str, now: Column) -> DataFrame:
    """Rows old enough to be cached: 30 days for version 1, 5 days for later ones."""
    days = F.when(F.col(version) == 1, CACHE_DAYS[1]).otherwise(CACHE_DAYS[2])
    return df.where(F.col(ts) <= now - F.make_dt_interval(days))


def series_cache(df: DataFrame, path: str, site: Sequence[str], ts: str, version: str, now: Column,
                 buckets: int = 64) -> None:
    """Write settled rows as Parquet by version and site bucket; touched buckets are replaced.

    Sites are hashed into a fixed number of folders instead of one folder each, and a bucket is
    spread over its months while writing, so neither many small sites nor one huge one hurts.
    """
    rows = settled_rows(df, ts, version, now).withColumn(
        "bucket", F.pmod(F.xxhash64(*site), F.lit(buckets)).cast("int"))
    rows = rows.repartition(version, "bucket", F.date_trunc("MONTH", ts)).sortWithinPartitions(version, "bucket", *site, ts)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(version, "bucket").parquet(path)


def pool(df: DataFrame, path: str, keep: Sequence[str] = ("time", "_site", "value", "bias_ratio")) -> None:
    """Write training rows: the key columns plus all numeric ones, doubles as floats."""
    numeric = [c for c in clean.numeric_columns(df) if c not in keep]
    wide = [f.name for f in df.schema.fields if f.dataType.simpleString() == "double"]
    cols = [c for c in [*keep, *numeric] if c in df.columns]
    df.select(*[F.col(c).cast("float").alias(c) if c in wide else F.col(c) for c in cols]).write.mode("overwrite").parquet(path)


def frame(df: DataFrame, path: str, file_format: str) -> None:
    """Write a table as csv (with header), parquet or json."""
    writer = df.write.mode("overwrite").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    if file_format == "csv":
        writer.option("header", True).csv(path)
    elif file_format == "parquet":
        writer.parquet(path)
    elif file_format == "json":
        writer.json(path)
    else:
        raise ValueError(f"unsupported format {file_format!r}")


JSON_OPTIONS = {"ignoreNullFields": "false"}


def site_documents(rows: DataFrame, sites: DataFrame, metrics: DataFrame | None, site: str, updated: Column,
                   fields: Sequence[str] = fv.FORECAST_FIELDS, ts: str = "time") -> DataFrame:
    """One JSON document per site: header, metrics and the forecast rows in time order.

    ``sites`` brings ``location, lat, lon, species, sources``. The rows of a site are its
    published window, at most one per hour of a year, so a document has a bounded size.
    """
    def text(c):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    kinds = dict(rows.dtypes)
    cols = [clean.rounded(F.col(c)).alias(c) if kinds[c] in ("double", "float") else F.col(c)
            for c in fields if c in kinds]
    times = [text(ts).alias("time"), *([text("local_time").alias("local_time")] if "local_time" in kinds else [])]
    zone = F.min_by("timezone", ts) if "timezone" in kinds else F.lit(None).cast("string")
    docs = rows.groupBy(site).agg(
        F.array_sort(F.collect_list(F.struct(F.col(ts).alias("_t"), F.struct(*cols, *times).alias("row")))).alias("_rows"),
        F.count(F.lit(1)).alias("total"), text(F.min(ts)).alias("start"), text(F.max(ts)).alias("end"), zone.alias("timezone"))
    docs = docs.join(sites, site, "left")
    if metrics is not None:
        docs = docs.join(metrics.select(site, "r2", "rmse", "mae"), site, "left")
        scores = [(m, F.col(m)) for m in ("r2", "rmse", "mae")]
    else:
        scores = [(m, F.lit(None).cast("double")) for m in ("r2", "rmse", "mae")]
    na = F.lit("N/A")
    doc = F.struct(
        F.coalesce("location", na).alias("location"), F.col("lat"), F.col("lon"), F.col("species"),
        F.coalesce("timezone", na).alias("timezone"), F.lit("200").alias("message"), F.lit("200").alias("status"),
        F.date_format(updated, "yyyy-MM-dd HH:00:00").alias("latest_update"),
        names.sources_array(F.col("sources"), dict(sites.dtypes)["sources"]).alias("sources"),
        F.struct(na.alias("validation_score"), F.col("total").alias("total_observation"),
                 F.struct(clean.metric_list(scores).alias("metrics")).alias("performance"),
                 F.coalesce("start", na).alias("start_date"), F.coalesce("end", na).alias("end_date")).alias("metrics"),
        F.transform("_rows", lambda r: r["row"]).alias("forecasts"))
    return docs.select(site, F.to_json(doc, JSON_OPTIONS).alias("document"))


def documents(docs: DataFrame, path: str, site: str) -> None:
    """Write one text file folder per site, as ``<path>/<site>=.../part``.

    The driver keeps track of every folder; :func:`document_lines` is the form for more than some thousands of sites.
    """
    docs.write.mode("overwrite").partitionBy(site).text(path)


def document_lines(docs: DataFrame, path: str, site: str) -> None:
    """Write the documents one a line, each with its ``site`` as first field, into as many files as there are tasks."""
    head = F.to_json(F.struct(F.col(site).cast("string").alias("site")))
    line = F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(","), F.substring("document", F.lit(2), F.length("document") - 1))
    docs.select(line.alias("value")).write.mode("overwrite").text(path)


HOUR_FILES = 8


def snapshot_rows(snapshots: DataFrame, path: str, hour: str) -> None:
    """Write snapshots as one JSON line per site below ``<hour>=yyyy-MM-dd_HH``.

    However many sites an hour has, its folder is written by several tasks, at most ``HOUR_FILES``, whatever the number of partitions.
    """
    named = snapshots.withColumn(hour, names.hour_file(F.col(hour)))
    deal = F.pmod(F.xxhash64(*[c for c in snapshots.columns if c != hour]), F.lit(HOUR_FILES))
    named.repartition(hour, deal).write.mode("overwrite").partitionBy(hour).option("ignoreNullFields", False).json(path)


def snapshot_documents(snapshots: DataFrame, hour: str, site: str, generated: Column, parts: int = 1) -> DataFrame:
    """One JSON document per hour (and part) with the list of its sites.

    ``parts`` cuts an hour into that many documents by site, for site counts that do not fit one document.
    """
    rest = [c for c in snapshots.columns if c != hour]
    part = F.pmod(F.xxhash64(site), F.lit(parts)).cast("int").alias("part")
    docs = snapshots.groupBy(hour, part).agg(F.array_sort(F.collect_list(F.struct(site, *[c for c in rest if c != site]))).alias("sites"))
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    doc = F.struct(F.date_format(generated, iso).alias("generated_at"), F.date_format(hour, iso).alias("forecast_hour"), "sites")
    return docs.select(F.concat(names.hour_file(F.col(hour)), F.lit(".json")).alias("file"), "part",
                       F.to_json(doc, JSON_OPTIONS).alias("document"))


def product_table(df: DataFrame, species: str, unit: str, ts: str = "time", location: str = "location",
                  localised: str = "localised") -> DataFrame:
    """Data-product rows: ISO time, constant columns, corrected and uncorrected model value."""
    raw = "pm25_rh35_gcc" if species == "pm25" else species
    return df.select(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ISO8601"),
        F.replace(F.col(location), F.lit(" "), F.lit("_")).alias("location"), "lat", "lon",
        F.lit(species).alias("parameter"), F.lit(unit).alias("unit"),
        F.col(localised).alias("localized_model_value"), F.col(raw).alias("uncorrected_model_value"))


def product_metadata(df: DataFrame, site: Sequence[str], species: str, products: dict[str, tuple[str, str]],
                     default_species: str = fv.DEFAULT_SPECIES, ts: str = "time") -> DataFrame:
    """Per site: time range, years, extents and the product's identifier and short name.

    ``products`` maps a species to (identifier, short name); unknown species use the default's.
    """
    identifier, short = products.get(species, products[default_species])
    out = df.groupBy(*site).agg(F.min(ts).alias("_a"), F.max(ts).alias("_b"), F.min("lat").alias("south"), F.max("lat").alias("north"),
                                F.min("lon").alias("west"), F.max("lon").alias("east"))
    return out.select(
        *site, F.date_format("_a", "yyyy-MM-dd").alias("begin_date"), F.date_format("_a", "HH:mm:ss").alias("begin_time"),
        F.date_format("_b", "yyyy-MM-dd").alias("end_date"), F.date_format("_b", "HH:mm:ss").alias("end_time"),
        F.year("_a").alias("min_year"), F.year("_b").alias("max_year"), "south", "north", "west", "east",
        F.lit(identifier).alias("identifier"), F.lit(short).alias("short_name"))


def layer_manifest(files: DataFrame, prefix: str, label: str, folder: str) -> DataFrame:
    """Map layers described by their file names ``<prefix>_<VAR>[_test]_<yyyyMMdd>_<HH>z.tif``.

    ``files`` has a column ``name``. Other tif files are listed with default values.
    """
    tif = files.where(F.lower("name").rlike(r"\.tiff?$"))
    test = rf"^{prefix}_([A-Za-z0-9_]+?)_test_(\d{{8}})_(\d{{2}})z\.tiff?$"
    daily = rf"^{prefix}_([A-Za-z0-9_]+?)_(\d{{8}})_(\d{{2}})z\.tiff?$"
    is_test = F.col("name").rlike(test)

    def part(n):
        return F.when(is_test, F.regexp_extract("name", test, n)).when(
            F.col("name").rlike(daily), F.regexp_extract("name", daily, n))
    out = tif.withColumns({"_var": part(1), "_d": part(2), "test": is_test})
    out = lookup(out, "_var", fv.LAYER_META, ["pollutant", "unit"], fv.LAYER_UNKNOWN)
    known = F.col("_var").isNotNull()
    day = F.when(known, F.concat_ws("-", F.substring("_d", 1, 4), F.substring("_d", 5, 2), F.substring("_d", 7, 2)))
    title = F.concat(F.lit(label + " "), F.replace(F.col("_var"), F.lit("_"), F.lit(" ")), F.lit(" "), day,
                     F.when(F.col("test"), " [test]").otherwise(""))
    return out.select(
        F.col("name").alias("file"), F.concat(F.lit(folder), "name").alias("path"),
        F.when(known, title).otherwise(F.col("name")).alias("name"),
        F.when(known, F.col("pollutant")).otherwise("default").alias("pollutant"), F.lit("geotiff").alias("type"),
        F.when(known, F.col("unit")).otherwise("").alias("unit"), day.alias("date"), "test")


def expired(files: DataFrame, cutoff: Column) -> DataFrame:
    """Files last modified before ``cutoff``: the ones a clean-up has to remove."""
    return files.where(F.col("modified") < cutoff)


def metrics(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
