"""Joins between sites, observations, model series and lookups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import documents
from .align import resample_mean


def model_with_observations(model: DataFrame, obs: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Training rows: model hours that have an observation."""
    return model.join(obs.where(F.col(value).isNotNull()), list(keys), "inner")


def attach_observations(predictions: DataFrame, obs: DataFrame, keys: Sequence[str]) -> DataFrame:
    return predictions.join(obs, list(keys), "left")


def merge_frames(frames: Sequence[DataFrame], keys: Sequence[str], how: str = "full") -> DataFrame:
    """Fold of joins on ``keys``; other columns have to differ between frames."""
    return reduce(lambda a, b: a.join(b, list(keys), how), frames)


def merge_and_resample(frames: Sequence[DataFrame], site: Sequence[str], ts: str, values: Sequence[str],
                       seconds: int) -> DataFrame:
    return resample_mean(merge_frames(frames, [*site, ts]), site, ts, values, seconds)


def side_by_side(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Outer join of two stores; on a column clash the left column stays as it is."""
    extra = [c for c in right.columns if c not in left.columns]
    return left.join(right.select(*keys, *extra), list(keys), "full")


def resolve_clash(df: DataFrame, name: str, left: str, right: str) -> DataFrame:
    """``name`` = left value, else right value."""
    return df.withColumn(name, F.coalesce(left, right)).drop(*{left, right} - {name})


def keep_known(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(known, list(keys), "left_semi")


def drop_known(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(known, list(keys), "left_anti")


def lookup(df: DataFrame, column: str, table: dict[str, tuple], names: Sequence[str],
           default: tuple | None = None) -> DataFrame:
    """Attach the values a fixed table holds for ``column``.

    The table is a literal of this program (a handful of entries), so it becomes a map
    constant in the projection rather than a join.
    """
    default = default or (None,) * len(names)
    cols = {}
    for i, name in enumerate(names):
        entries = [F.lit(x) for k, v in table.items() for x in (k, v[i])]
        cols[name] = F.coalesce(F.create_map(*entries)[F.col(column)], F.lit(default[i]))
    return df.withColumns(cols)


def first_overlapping(df: DataFrame, index: DataFrame, name: str, sources: str, position: str,
                      prefix: str = "index_") -> DataFrame:
    """Attach the first index entry of the same name whose sources share an element.

    ``index`` has ``name``, ``sources`` and ``position`` (its order). Rows without a match stay.
    """
    rest = [c for c in index.columns if c != name]
    entry = F.struct(position, *[c for c in rest if c != position])
    pairs = df.select(name, sources).distinct().join(
        index.select(name, F.col(sources).alias("_src"), entry.alias("_entry")), name
    ).where(F.arrays_overlap(sources, "_src"))
    first = pairs.groupBy(name, sources).agg(F.min("_entry").alias("_entry"))
    out = df.join(first, [name, sources], "left")
    return out.withColumns({f"{prefix}{c}": F.col(f"_entry.{c}") for c in rest}).drop("_entry")


def sites_by_threshold(df: DataFrame, value: str, maximum: int = 50) -> DataFrame:
    """Rows with value > t for t = 0..maximum.

    Each value is counted once at the highest threshold it exceeds; the counts are then added
    up from the top, so no row is compared with every threshold.
    """
    top = F.least(F.ceil(F.col(value)) - 1, F.lit(maximum)).cast("int")
    hit = df.where(F.col(value) > 0).groupBy(top.alias("threshold")).agg(F.count(F.lit(1)).alias("_n"))
    steps = df.sparkSession.range(maximum + 1).select(F.col("id").cast("int").alias("threshold"))
    # maximum + 1 rows: the unpartitioned window below has a fixed size
    above = Window.orderBy(F.col("threshold").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return steps.join(hit, "threshold", "left").select(
        F.col("threshold").cast("double").alias("threshold"),
        F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("nsites"))


def hours_of_sites(sites: DataFrame, start: Column, hours: int) -> DataFrame:
    """One row per site and hour; ``offset`` counts the hours from ``start``."""
    return sites.withColumn("offset", F.explode(F.sequence(F.lit(0), F.lit(hours - 1)))).withColumn(
        "target", start + F.make_dt_interval(F.lit(0), F.col("offset")))


def json_paths(df: DataFrame, key: str, doc: str) -> DataFrame:
    """JSON documents as rows ``(key, steps, kind, value)``, one per leaf, however deep.

    ``steps`` are the names on the way, ``kind`` tells a string from the number or object it may look like. Empty
    objects are leaves of kind ``object``; arrays stay JSON text.
    """
    take_apart = F.pandas_udf(documents.leaves_of, documents.LEAVES)
    return df.select(key, F.explode(take_apart(F.col(doc).cast("string"))).alias("_l")).select(key, "_l.steps", "_l.kind", "_l.value")


def path_text(steps: Column) -> Column:
    """Steps joined by dots; dots and backslashes within a step get a backslash, so different steps never look alike."""
    return F.array_join(F.transform(steps, lambda s: F.regexp_replace(s, r"([.\\])", r"\\$1")), ".")


def merge_documents(left: DataFrame, right: DataFrame, key: str, doc: str) -> DataFrame:
    """Recursive overlay of two sets of JSON documents, as leaf rows ``(key, path, kind, value)``.

    Objects on both sides are merged; anywhere else the right side decides. An empty object on the right
    therefore replaces a plain value, but nothing of an object. Documents without a key keep their own leaves.
    The documents of a key (one a side, as a rule) meet in one row, so nothing but documents is shuffled, and once.
    """
    sides = [df.select(key, F.coalesce(F.col(doc).cast("string"), F.lit("{}")).alias("_doc")) for df in (left, right)]
    both = sides[0].withColumn("_left", F.lit(True)).unionByName(sides[1].withColumn("_left", F.lit(False))).where(F.col(key).isNotNull())
    paired = both.groupBy(key).agg(F.collect_list(F.when(F.col("_left"), F.col("_doc"))).alias("_l"), F.collect_list(F.when(~F.col("_left"), F.col("_doc"))).alias("_r"))
    overlay = F.pandas_udf(documents.overlays_of, documents.LEAVES)
    merged = paired.select(key, F.explode(overlay("_l", "_r")).alias("_m")).select(key, "_m.steps", "_m.kind", "_m.value")
    for df in sides:
        merged = merged.unionByName(json_paths(df.where(F.col(key).isNull()), key, "_doc"))
    return merged.select(key, path_text(F.col("steps")).alias("path"), "kind", "value")


def intervals_with_model(intervals: DataFrame, predictions: DataFrame, model: DataFrame,
                         site: Sequence[str], ts: str, interval_cols: Sequence[str],
                         prediction_cols: Sequence[str], model_cols: Sequence[str]) -> DataFrame:
    """Hourly intervals joined with hourly predictions and model values, as daily means."""
    from ..functions.times import hour_floor
    hourly = resample_mean(intervals, site, ts, interval_cols, 3600)
    model = model.select(*site, hour_floor(F.col(ts)).alias(ts), *model_cols)
    both = predictions.join(model, [*site, ts], "inner")
    both = resample_mean(both, site, ts, [*prediction_cols, *model_cols], 3600)
    merged = hourly.join(both, [*site, ts], "inner")
    return resample_mean(merged, site, ts, [*interval_cols, *prediction_cols, *model_cols], 86400)
