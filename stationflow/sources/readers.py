"""Readers for landed files. Every reader is a lazy plan over a path, folder or glob."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .. import fixed_values as fv, schemas
from ..functions import names, times as t, units
from ..operators import clean, outliers, setops

FILE = "_metadata.file_path"
START = "_metadata.file_block_start"


def _path() -> Column:
    return names.url_decode_path(F.col(FILE))


def csv_by_header(spark: SparkSession, path: str) -> list[DataFrame]:
    """CSV files as one table of text columns per distinct header.

    Spark applies one file's header to all files by position. Here every file's first line is found first (one
    combining pass over the lines), and the files of each header are read together. Only headers and file names reach the driver, as
    in any file listing. Files without a line are left out.
    """
    lines = spark.read.text(path).select("value", _path().alias("file"), F.col(START).alias("start"), F.monotonically_increasing_id().alias("line"))
    first = lines.groupBy("file").agg(F.min_by("value", F.struct("start", "line")).alias("header"))
    out = []
    for row in first.groupBy("header").agg(F.array_sort(F.collect_list("file")).alias("files")).orderBy("header").collect():
        names_of = [c.strip() for c in next(csv.reader([row["header"].removeprefix("\ufeff")]))]
        schema = T.StructType([T.StructField(c, T.StringType()) for c in names_of])
        files = [re.sub(r"([*?\[\]{}\\])", r"\\\1", f) for f in row["files"]]
        out.append(spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(files))
    return out


def _stacked(parts: list[DataFrame], spark: SparkSession, empty: str) -> DataFrame:
    """Tables of different columns in one; ``empty`` is the schema where there is none."""
    if not parts:
        return spark.createDataFrame([], empty)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def observation_csv(spark: SparkSession, path: str, time_col: str, time_format: str, value_col: str,
                    species: str, unit: str | None = None, lat_col: str | None = None, lon_col: str | None = None,
                    lat: float | None = None, lon: float | None = None, value_name: str = "value",
                    k_sigma: float | None = None, z_limit: float = 3.0, start=None, end=None) -> DataFrame:
    """Observation CSV files with caller-named columns as ``time, <value>, lat, lon, location``.

    Keeps non-negative values, converts mass units to ppb (except for pm25). ``k_sigma`` turns on the
    k-sigma and z-score filters per location and, after them, the time range.
    """
    wanted = [c for c in (time_col, value_col, lat_col, lon_col) if c]
    parts = [clean.ensure_columns(p, wanted, "string").select(*[F.col(f"`{c}`") for c in wanted], _path().alias("_file")) for p in csv_by_header(spark, path)]
    raw = _stacked(parts, spark, ", ".join(f"`{c}` STRING" for c in [*wanted, "_file"]))
    value = F.col(value_col).try_cast("double")
    target = "ugm3" if species == "pm25" else "ppbv"
    location = F.element_at(F.split(names.file_name(F.col("_file")), "_"), 1)
    out = raw.where((value >= 0) & ~F.isnan(value)).select(
        F.try_to_timestamp(F.col(time_col), F.lit(time_format)).cast(t.NTZ).alias("time"),
        units.convert(value, species, unit, target).alias(value_name),
        (F.col(lat_col).try_cast("double") if lat_col else F.lit(lat).cast("double")).alias("lat"),
        (F.col(lon_col).try_cast("double") if lon_col else F.lit(lon).cast("double")).alias("lon"),
        location.alias("location"))
    if k_sigma:
        out = outliers.within_sigma(out, ["location"], value_name, k_sigma)
        out = outliers.below_zscore(out, ["location"], value_name, z_limit)
        if start is not None and end is not None:
            out = clean.time_range(out, "time", start, end)
    return out


HEADER_PATTERNS = {
    "location": (r"Full location name:\s*(.+)", "string"),
    "lat": (r"Location latitude \[deg\]:\s*([-\d.]+)", "double"),
    "lon": (r"Location longitude \[deg\]:\s*([-\d.]+)", "double"),
}
DATA_LINE = r"^\s*\d{8}T\d{6}"


def instrument_text(spark: SparkSession, path: str, species: str) -> DataFrame:
    """Instrument text files as ``time, lat, lon, value, location`` with the quality rules applied.

    Lines are read independently: header lines give one row per file, data lines are the ones
    that start with a time stamp, so files of any number and size split over tasks.
    """
    # the path is only compared, so it stays as it is
    lines = spark.read.option("encoding", "ISO-8859-1").text(path).select("value", F.col(FILE).alias("_file"))
    found = [F.max(F.when(F.col("value").rlike(p), F.trim(F.regexp_extract("value", p, 1)))).cast(kind).alias(n)
             for n, (p, kind) in HEADER_PATTERNS.items()]
    header = lines.where(~F.col("value").rlike(DATA_LINE)).groupBy("_file").agg(*found)
    # the columns of a line come out of a generator, so that no filter is moved before it and a line is taken apart once
    rows = lines.where(F.col("value").rlike(DATA_LINE)).select("_file", F.explode(F.array(F.split(F.trim("value"), r"\s+"))).alias("_c"))

    def number(position: int) -> Column:
        return F.get("_c", F.lit(position)).try_cast("double")
    # seconds carry a fraction of any length, so the text is cut into an ISO time first
    text = F.regexp_replace(F.get("_c", F.lit(fv.INSTRUMENT_TIME)),
                            r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2}(?:\.\d+)?)Z?$", "$1-$2-$3T$4:$5:$6")
    when = text.try_cast(t.NTZ).alias("time")
    if species.lower() == "no2":
        at = fv.NO2_POSITIONS
        conc = number(at["conc"])
        ppb = units.mole_density_to_ppb(conc, number(at["temperature"]), number(at["pressure"])) / fv.INSTRUMENT_NO2_DIVISOR
        data = clean.no2_quality(rows.select("_file", when, conc.alias("_conc"), ppb.alias("value")), "_conc", "value")
    elif species.lower() == "o3":
        at = fv.O3_POSITIONS
        data = clean.o3_quality(rows.select("_file", when, number(at["conc"]).alias("value"), number(at["flag"]).cast("int").alias("_flag"),
                                            number(at["aod"]).alias("_aod")), "value", "_flag", "_aod")
    else:
        raise ValueError(f"unsupported species {species!r}: choose 'no2' or 'o3'")
    return data.join(header, "_file").select("time", "lat", "lon", "value", "location")


def sensor_pages(spark: SparkSession, path: str, k_sigma: float = 0.0, grade: str | None = None,
                 location: str = "sensor", multi_line: bool = True) -> DataFrame:
    """Landed sensor API pages as ``time, value, unit, parameter, local_time, location``.

    ``grade`` keeps one sensor type only; ``multi_line=False`` reads one page per line.
    """
    page = spark.read.schema(schemas.SENSOR_PAGE).option("multiLine", multi_line).json(path)
    rows = page.select(F.inline("results"))
    if grade:
        rows = clean.equals(rows, "sensorType", grade)
    rows = clean.valid_value(rows, "value")
    out = rows.select(
        F.try_to_timestamp("period.datetimeFrom.utc", F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")).cast(t.NTZ).alias("time"), "value",
        F.col("parameter.units").alias("unit"), F.col("parameter.name").alias("parameter"),
        F.col("period.datetimeFrom.local").alias("local_time"), F.lit(location).alias("location"))
    return outliers.within_sigma(out, [], "value", k_sigma) if k_sigma > 0 else out


def slots_to_rows(df: DataFrame, keep: Sequence[str], base: str = "UTC_DATE") -> DataFrame:
    """Eight three-hour slot columns to rows ``time, pm25_conc_cnn, pm25_aqi``, plus ``keep``."""
    day = F.coalesce(F.col(base).try_cast(t.NTZ), F.try_to_timestamp(F.col(base), F.lit("yyyyMMdd")).cast(t.NTZ))
    slots = F.array(*[
        F.struct((day + t.hours(hour)).alias("time"),
                 F.col(f"`{fv.SLOT_CONC_COLUMN.format(label)}`").cast("double").alias("pm25_conc_cnn"),
                 F.col(f"`{fv.SLOT_INDEX_COLUMN.format(label)}`").cast("double").alias("pm25_aqi"))
        for hour, label in fv.FORECAST_SLOTS])
    return df.where(day.isNotNull()).select(*keep, F.inline(slots))


def station_geojson(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Station forecast features as one row per feature and three-hour slot."""
    raw = spark.read.schema(schemas.STATION_GEOJSON).option("multiLine", multi_line).json(path)
    flat = raw.select(F.inline("features")).select(
        "properties.*", F.get("geometry.coordinates", F.lit(1)).alias("lat"),
        F.get("geometry.coordinates", F.lit(0)).alias("lon"))
    flat = flat.withColumnRenamed("DAILY_AQI", "daily_aqi")
    return slots_to_rows(flat, ["daily_aqi", "Station", "Site_Name", "lat", "lon"])


def station_wide_csv(spark: SparkSession, path: str) -> DataFrame:
    """Station forecasts as a wide CSV (one column per slot), to rows."""
    raw = _stacked(csv_by_header(spark, path), spark, "UTC_DATE STRING")
    slots = [c.format(label) for _, label in fv.FORECAST_SLOTS for c in (fv.SLOT_CONC_COLUMN, fv.SLOT_INDEX_COLUMN)]
    return slots_to_rows(clean.ensure_columns(raw, slots, "string"), [c for c in ("Station", "Site_Name") if c in raw.columns])


def site_registry(spark: SparkSession, path: str, code: str | None = None, multi_line: bool = True) -> DataFrame:
    """Registry file (one object keyed by site code) as one row per site.

    ``multi_line=False`` reads a registry that is split into one object per line.
    """
    text = spark.read.text(path, wholetext=multi_line)
    entry = F.explode(F.from_json("value", schemas.SITE_REGISTRY)).alias("site_id", "_s")
    out = text.select(entry).select("site_id", "_s.*")
    return clean.equals(out, "site_id", code) if code else out


def site_options(registry: DataFrame, species: str) -> DataFrame:
    """Registry rows with the observation options of one species as plain columns."""
    return registry.withColumn("_o", F.col("obs_options")[species]).select(
        "site_id", "location_name", "lat", "lon", "observation_source",
        *[F.col(f"_o.{c}").alias(f"obs_options_{species}_{c}") for c in ("time_col", "val_col", "file", "time_parser", "unit")])


def forecast_documents(spark: SparkSession, path: str, fields: dict[str, str], lines: bool = False) -> DataFrame:
    """Site forecast documents, one row per file, with the file stem as ``site``; ``lines`` reads one a line, with its own ``site``.

    Bare ``NaN`` tokens are read as NaN and become NULL when the rows are unpacked.
    """
    if lines:
        return spark.read.schema(f"{schemas.document(fields)}, site STRING").json(path)
    raw = spark.read.schema(schemas.document(fields)).option("multiLine", True).json(path)
    # a folder written as site=<code>/ brings the column itself
    site = F.col("site").cast("string") if "site" in raw.columns else names.file_stem(_path())
    return raw.withColumn("site", site)


def document_rows(documents: DataFrame) -> DataFrame:
    """One row per forecast of each document, ``position`` being its place in the list."""
    rows = documents.select("site", F.posexplode("forecasts").alias("position", "_f"))
    return clean.nan_to_null(rows.select("site", "position", "_f.*"))


def site_index(spark: SparkSession, path: str) -> DataFrame:
    """Site index (an array of entries) with the place of each entry as ``position``."""
    text = spark.read.text(path, wholetext=True)
    entries = F.from_json("value", f"ARRAY<STRUCT<location_name: STRING, species: STRING, sources: ARRAY<STRING>>>")
    return text.select(F.posexplode(entries).alias("position", "_e")).select("position", "_e.*")


def pool(spark: SparkSession, path: str) -> DataFrame:
    """Pooled training rows."""
    return spark.read.parquet(path)


SERIES_FILE = r"loc_(m?[0-9]+_[0-9]+)_(m?[0-9]+_[0-9]+)_v([0-9]+)\.csv"


def cached_series(spark: SparkSession, folder: str, time_col: str = "time") -> DataFrame:
    """Cached model series, coordinates and version taken from each file name; version 1 wins an hour.

    The versions' own column names become the common ones, file by file.
    """
    def part(n: int) -> Column:
        return F.regexp_extract(_path(), SERIES_FILE, n)

    tables = []
    for raw in csv_by_header(spark, f"{folder}/loc_*_v*.csv"):
        values = [F.col(f"`{c}`").try_cast("double").alias(c) for c in raw.columns if c not in {time_col, "lat", "lon", "version"}]
        tables.append(clean.harmonise_names(raw.select(
            names.coordinate_from_key(part(1)).alias("lat"), names.coordinate_from_key(part(2)).alias("lon"),
            part(3).cast("int").alias("version"), t.hour_floor(F.col(time_col).try_cast(t.NTZ)).alias("time"), *values)))
    out = _stacked(tables, spark, "lat DOUBLE, lon DOUBLE, version INT, time TIMESTAMP_NTZ")
    return setops.keep_first(out, ["lat", "lon", "time"], ["version"])


def observation_cache(spark: SparkSession, folder: str, species: str) -> DataFrame:
    """Observation cache files ``<site>_<species>.csv`` with the site taken from the file name."""
    site = F.regexp_extract(_path(), rf"([^/]+)_{species.lower()}\.csv", 1)

    def number(c: str | None) -> Column:
        return F.col(c).try_cast("double") if c else F.lit(None).cast("double")

    def one_header(raw: DataFrame) -> DataFrame:
        value = first_column(raw.columns, ["value", species, species.lower(), "concentration", "val", "obs"])
        lat = first_column(raw.columns, ["lat", "latitude", "Latitude"])
        lon = first_column(raw.columns, ["lon", "longitude", "Longitude"])
        return raw.select(site.alias("site"), t.hour_floor(F.col("time").try_cast(t.NTZ)).alias("time"),
                          F.nanvl(number(value), F.lit(None).cast("double")).alias("value"),
                          number(lat).alias("lat"), number(lon).alias("lon"))

    return _stacked([one_header(raw) for raw in csv_by_header(spark, f"{folder}/*_{species.lower()}.csv")], spark,
                    "site STRING, time TIMESTAMP_NTZ, value DOUBLE, lat DOUBLE, lon DOUBLE")


def first_column(columns: Sequence[str], candidates: Sequence[str]) -> str | None:
    """First candidate that exists; decided from the schema, no data is read."""
    return next((c for c in candidates if c in columns), None)


def by_extension(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Read a file or glob with the reader its extension asks for; unknown ones as bytes.

    A ``json`` file is one document or one array of them; ``jsonl`` and ``ndjson`` have a document a line.
    """
    ext = path.rstrip("/*").rsplit(".", 1)[-1].lower()
    reader = spark.read.schema(schema) if schema else spark.read
    if ext == "csv":
        return reader.option("header", True).csv(path)
    if ext in ("json", "geojson"):
        return reader.option("multiLine", True).json(path)
    if ext in ("jsonl", "ndjson"):
        return reader.json(path)
    if ext == "parquet":
        return reader.parquet(path)
    if ext in ("txt", "log", "md", "yaml", "yml"):
        return spark.read.text(path)
    return spark.read.format("binaryFile").load(path)


def inventory(spark: SparkSession, folder: str, suffix: str | None = None) -> DataFrame:
    """Files below a folder as ``path, name, modified, length``; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    files = reader.load(folder).select("path", "modificationTime", "length")
    return files.select("path", names.file_name(F.col("path")).alias("name"),
                        F.col("modificationTime").alias("modified"), "length")


def monitor_files(spark: SparkSession, path: str) -> DataFrame:
    """File names of monitor documents mentioned in listing texts."""
    lines = spark.read.text(path)
    return lines.select(F.explode(F.regexp_extract_all("value", F.lit(fv.MONITOR_FILE_PATTERN), F.lit(0))).alias("file"))


def monitor_catalogue(documents: DataFrame, eligible: DataFrame, source: str) -> DataFrame:
    """Monitor documents of eligible places, with their parameters as a map to file names.

    ``eligible`` has one column ``name`` of normalised place names.
    """
    named = documents.withColumn("name", names.normalize_name(F.col("siteName")))
    kept = named.join(eligible.select("name").distinct(), "name", "left_semi")

    def parameter(m: Column) -> Column:
        low = F.lower(m["parameterName"])
        return F.when(low.contains("pm2.5"), "pm25").otherwise(low)
    file = F.concat("siteName", F.lit(".json"))
    keys = F.array_distinct(F.transform("monitors", parameter))
    entries = F.transform(keys, lambda k: F.struct(k, F.struct(file.alias("forecasts"), file.alias("historical"))))
    two = F.size("coordinates") == 2
    return kept.select(
        F.col("stationID").alias("station_id"), F.col("siteName").alias("location_name"),
        F.when(two, F.get("coordinates", F.lit(0))).alias("lat"), F.when(two, F.get("coordinates", F.lit(1))).alias("lon"),
        F.lit("na").alias("status"), F.lit(source).alias("observation_source"),
        F.map_from_entries(entries).alias("precomputed_forecasts"))


def locations(spark: SparkSession, path: str, parameter: str) -> DataFrame:
    """Location catalogue pages: locations with a sensor of ``parameter`` and the ids of those sensors."""
    from ..operators.aggregates import matching_sensors
    page = spark.read.schema(schemas.LOCATIONS).option("multiLine", True).json(path)
    rows = page.select(F.inline("results")).select(
        F.col("id").alias("location_id"), "name", F.col("provider.name").alias("provider"),
        F.col("coordinates.latitude").alias("lat"), F.col("coordinates.longitude").alias("lon"), "sensors")
    return matching_sensors(rows, "sensors", parameter).drop("sensors")
