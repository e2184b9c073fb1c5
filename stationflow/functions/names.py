"""Names, keys, labels and path parsing."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


def normalize_name(name: Column) -> Column:
    """Spaces and dashes become underscores."""
    return F.translate(name, " -", "__")


def safe_name(name: Column) -> Column:
    """Trimmed, with every character outside words and dashes replaced."""
    return F.regexp_replace(F.trim(name), r"[^\w\-]", "_")


def clean_column(name: str) -> str:
    """Feature column name without characters outside words."""
    return re.sub(r"[^\w]", "_", str(name))


def coordinate_key(value: Column) -> Column:
    """Six decimals, ``.`` as ``_`` and ``-`` as ``m``, as used in cache file names."""
    return F.translate(F.format_string("%.6f", value), ".-", "_m")


def coordinate_from_key(key: Column) -> Column:
    return F.translate(key, "_m", ".-").cast("double")


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def file_stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"\.[^.]*$", "")


def url_decode_path(path: Column) -> Column:
    """``input_file_name`` percent-encodes blanks; give the plain path back."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def site_from_url(url: Column, skip: tuple[str, ...]) -> Column:
    """First path segment that does not start with one of ``skip``; else a short digest."""
    segments = F.filter(F.split(F.try_parse_url(url, F.lit("PATH")), "/"), lambda s: s != "")
    wanted = F.filter(segments, lambda s: ~_starts_any(s, skip))
    name = F.regexp_replace(F.get(wanted, F.lit(0)), r"[^\w\-]", "_")
    return F.coalesce(name, F.substring(F.md5(url), 1, 10))


def _starts_any(s: Column, prefixes: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | s.startswith(p)
    return out


def hour_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:00:00")


def hour_file(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd_HH")


def grid_file_name(prefix: str, collection: str, init_date: str, init_hour: str, valid: Column) -> Column:
    """Name of the hourly grid file valid at ``valid`` for one model start."""
    return F.concat(
        F.lit(f"{prefix}.{collection}.{init_date}_{init_hour}z+"),
        F.date_format(valid, "yyyyMMdd_HH"), F.lit("30z.R0.nc4"),
    )


def grid_file_url(base: str, prefix: str, collection: str, init_date: str, init_hour: str,
                  valid: Column) -> Column:
    folder = f"{base}/Y{init_date[:4]}/M{init_date[4:6]}/D{init_date[6:8]}/"
    return F.concat(F.lit(folder), grid_file_name(prefix, collection, init_date, init_hour, valid))


def size_label(size: Column) -> Column:
    """Bytes as ``n.nn B|KB|MB|GB|TB|PB`` in steps of 1024."""
    value = size.cast("double")
    units = ["B", "KB", "MB", "GB", "TB"]
    out = None
    for i, unit in enumerate(units):
        scaled = value / float(1024 ** i)
        label = F.concat(F.format_string("%.2f", F.bround(scaled, 2)), F.lit(" " + unit))
        out = F.when(scaled < 1024.0, label) if out is None else out.when(scaled < 1024.0, label)
    top = value / float(1024 ** len(units))
    return out.otherwise(F.concat(F.format_string("%.2f", F.bround(top, 2)), F.lit(" PB")))


def sources_array(value: Column, data_type: str) -> Column:
    """Missing, single string or array, always as an array of strings."""
    if data_type == "string":
        return F.when(value.isNull(), F.array().cast("array<string>")).otherwise(F.array(value))
    return F.coalesce(value, F.array().cast("array<string>"))
