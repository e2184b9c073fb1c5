"""Partitioned tables published by manifest: readers open what the newest complete manifest lists, never a half-written set.

Below the root, ``data/generation=<g>/<partition folders>`` holds the files of each publication and ``manifest/generation=<g>`` the list of
all folders that belong to it, sorted by name, with row counts and checksums. The manifest is written last. Each of its rows carries the number of
rows it has, so one that was cut off is told from a whole one. A publication that died leaves no complete manifest; the next one
takes its number and overwrites it. One publisher at a time; readers need no lock.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..session import cut_lineage


def _files(spark: SparkSession, path: str):
    """Hadoop file system and path, so that any shared store works."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _generations(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete generations, oldest first."""
    fs, path = _files(spark, f"{root}/manifest")
    if not fs.exists(path):
        return []
    rows = spark.read.schema("entries BIGINT, generation INT").parquet(f"{root}/manifest").groupBy("generation").agg(
        F.count("*").alias("n"), F.max("entries").alias("entries"))
    return sorted(r["generation"] for r in rows.where("n = entries").collect())


def _folders(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Row count and checksum of every folder of staged rows, whatever order the rows have."""
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    folder = F.regexp_extract(path, r"(generation=\d+(?:/[^/]+){%d})/[^/]+$" % len(by), 1)
    values = [c for c in columns if c not in by]
    return df.select(*by, folder.alias("folder"), F.xxhash64(*values).alias("_h")).groupBy(*by, "folder").agg(
        F.count("*").alias("n_rows"), F.bit_xor("_h").alias("checksum"))


def _read(spark: SparkSession, root: str, schema: StructType, folders: Sequence[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{root}/data").parquet(*[f"{root}/data/{f}" for f in folders])


def manifest(spark: SparkSession, root: str, generation: int | None = None) -> DataFrame:
    """Folders of a generation, by default of the newest complete one: partition values, folder, row count, checksum."""
    complete = _generations(spark, root)
    wanted = generation if generation is not None else (complete[-1] if complete else None)
    if wanted not in complete:
        raise FileNotFoundError(f"no complete manifest of generation {wanted} below {root}")
    return spark.read.parquet(f"{root}/manifest/generation={wanted}").where("folder IS NOT NULL").drop("entries")


def publish(df: DataFrame, root: str, by: Sequence[str], expired: Column | None = None) -> int:
    """Publish ``df`` as the next generation and return its number.

    Partitions that ``df`` has replace those of the generation before, all others stay as they are. Partitions whose values meet
    ``expired`` are no longer listed; :func:`discard` removes their files. An empty ``df`` only applies ``expired``.
    """
    spark = df.sparkSession
    complete = _generations(spark, root)
    number = complete[-1] + 1 if complete else 1
    staged = f"{root}/data/generation={number}"
    df.write.mode("overwrite").partitionBy(*by).parquet(staged)
    entries = _folders(spark.read.schema(df.schema).parquet(staged), by, df.columns)
    if complete:
        same = [F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in by]
        old = manifest(spark, root)
        entries = cut_lineage(entries, "entries")
        entries = entries.unionByName(old.alias("o").join(entries.alias("n"), same, "left_anti").select(entries.columns))
    if expired is not None:
        entries = entries.where(~F.coalesce(expired, F.lit(False)))
    entries = cut_lineage(entries, "entries")
    # one row without a folder, so that an empty list is a complete one too
    last = spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in entries.schema])
    listed = entries.unionByName(last).withColumn("entries", F.lit(entries.count() + 1).cast("bigint"))
    listed.orderBy("folder").write.mode("overwrite").parquet(f"{root}/manifest/generation={number}")
    return number


def read_published(spark: SparkSession, root: str, schema: StructType, generation: int | None = None) -> DataFrame:
    """Rows of a generation, by default of the newest complete one. Only the listed folders are opened."""
    folders = [r["folder"] for r in manifest(spark, root, generation).select("folder").collect()]
    return _read(spark, root, schema, folders).select(schema.names)


def read_partitions(spark: SparkSession, root: str, schema: StructType, partitions: DataFrame) -> DataFrame:
    """Rows of the newest complete generation in the partitions whose values ``partitions`` lists, null being a value too; none if nothing is published."""
    if not _generations(spark, root):
        return spark.createDataFrame([], schema)
    same = [F.col(f"m.{c}").eqNullSafe(F.col(f"p.{c}")) for c in partitions.columns]
    listed = manifest(spark, root).alias("m").join(partitions.alias("p"), same, "left_semi")
    return _read(spark, root, schema, [r["folder"] for r in listed.select("folder").collect()]).select(schema.names)


def damaged(spark: SparkSession, root: str, schema: StructType, by: Sequence[str]) -> DataFrame:
    """Listed folders of the newest generation whose rows are not those that were published."""
    listed = manifest(spark, root)
    rows = _read(spark, root, schema, [r["folder"] for r in listed.select("folder").collect()])
    found = _folders(rows, by, schema.names)
    return listed.join(found.select("folder", "n_rows", "checksum"), ["folder", "n_rows", "checksum"], "left_anti")


def discard(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove manifests older than the newest ``keep`` and the folders that only they list; returns those folders.

    Folders go before the manifests that list them, so a run that dies is made up for by the next one. ``keep`` has to cover the readers
    that are still at work.
    """
    complete = _generations(spark, root)
    if keep < 1 or len(complete) <= keep:
        return []
    listed = {g: manifest(spark, root, g).select("folder") for g in complete}
    gone, kept = None, None
    for g, folders in listed.items():
        if g in complete[-keep:]:
            kept = folders if kept is None else kept.unionByName(folders)
        else:
            gone = folders if gone is None else gone.unionByName(folders)
    removed = sorted(r["folder"] for r in gone.distinct().join(kept, "folder", "left_anti").collect())
    for path in [f"data/{f}" for f in removed] + [f"manifest/generation={g}" for g in complete[:-keep]]:
        fs, p = _files(spark, f"{root}/{path}")
        fs.delete(p, True)
    return removed
