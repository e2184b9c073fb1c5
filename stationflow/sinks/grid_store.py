"""Gridded series stored by place: blocks of 32 by 32 cells as folders, within them cells along a space-filling curve, then time.

A table written here is read by :func:`nearest.nearest_cell_series` (and so by ``plans.series.read_model``) only where sites lie.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..operators.nearest import BLOCK, CELL, cell_block, cell_code, cell_col, cell_row


def write_grid(grid: DataFrame, path: str, ts: str, lat: str = "lat", lon: str = "lon", mode: str = "append") -> None:
    """Append grid rows. Files cover ranges of cells and times cut by the number of rows, so a crowded cell has several.

    Rows without a coordinate belong to no cell and are not stored.
    """
    placed = grid.where(f"`{lat}` IS NOT NULL AND `{lon}` IS NOT NULL").withColumns({"_r": cell_row(F.col(lat)), "_c": cell_col(F.col(lon))})
    coded = placed.withColumns({BLOCK: cell_block(F.col("_r"), F.col("_c")), CELL: cell_code(F.col("_r"), F.col("_c"))}).drop("_r", "_c")
    coded.repartitionByRange(CELL, ts).sortWithinPartitions(BLOCK, CELL, ts).write.mode(mode).partitionBy(BLOCK).parquet(path)


def read_grid(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The stored grid with its cell columns; ``schema`` is that of the rows as they were written."""
    return spark.read.schema(StructType([*schema.fields, StructField(CELL, LongType()), StructField(BLOCK, IntegerType())])).parquet(path)
