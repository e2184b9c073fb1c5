"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

ASCII_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def per_batch(df: DataFrame, fn: Callable[[dict[str, list]], dict], schema: str, rows: int = 512) -> DataFrame:
    """Apply ``fn`` to the columns of slices of at most ``rows`` rows, as Python lists, inside the tasks.

    Only slices are turned into Python objects and results, so memory is bounded by the input split plus one slice.
    Strings arrive as ``str``; columns cast to binary arrive as ``bytes``.
    """
    target = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                out = fn({name: column.to_pylist() for name, column in zip(part.schema.names, part.columns)})
                yield pa.RecordBatch.from_arrays([as_arrow(out[f.name], f.type) for f in target], schema=target)

    return df.mapInArrow(run, schema)


def as_arrow(values, kind) -> pa.Array:
    return values if isinstance(values, pa.Array) else pa.array(values, type=kind)


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, *ASCII_LOWER)


def fold_of(doc_id: Column) -> Column:
    """Remainder of the id's CRC-32 by five; rows with remainder 0 are held out. A null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5, F.lit(-1))


def hashed_sample(df: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """At most ``limit`` rows, picked by a hash of ``keys``, so a rerun picks the same ones."""
    return df.orderBy(F.xxhash64(*keys), *keys).limit(limit)


class KeyIndex:
    """Values of 64-bit keys, looked up for whole arrays: one slot table, and chains where keys share a slot."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, bits: int = 19):
        self.keys, self.values, self.shift = keys.astype(np.uint64), values.astype(np.int64), np.uint64(64 - bits)
        slots = self._slot(self.keys)
        order = np.argsort(slots, kind="stable")
        self.keys, self.values, slots = self.keys[order], self.values[order], slots[order]
        self.first = np.full(1 << bits, -1, dtype=np.int32)
        self.first[slots[::-1]] = np.arange(len(slots), dtype=np.int32)[::-1]
        self.chained = np.append(slots[1:] == slots[:-1], False)

    def _slot(self, keys):
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray, missing: int) -> np.ndarray:
        keys = keys.astype(np.uint64)
        out, at = np.full(len(keys), missing, dtype=np.int64), self.first[self._slot(keys)]
        live = np.flatnonzero(at >= 0)
        at = at[live]
        while len(live):
            hit = self.keys[at] == keys[live]
            out[live[hit]] = self.values[at[hit]]
            on = ~hit & self.chained[at]
            live, at = live[on], at[on] + 1
        return out
