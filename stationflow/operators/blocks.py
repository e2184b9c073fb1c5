"""Ordered computations that split a hot site over many tasks.

A plain ``Window.partitionBy(site)`` puts every row of a site into one task. The three
building blocks here cut each site into blocks instead and give the same result:

* :func:`with_trailing_frames` - lags and rolling frames of bounded depth. The last
  ``depth`` rows of a block are also sent to the next block, so a frame never leaves its block.
* :func:`row_index` - consecutive row numbers per site, from per-block counts and offsets.
* :func:`with_neighbours` - previous and next non-null point, however far away. Blocks are
  summarised to their first and last point; only the summaries are ordered per site.

Only block summaries (one row per site and block) are ever grouped by site alone. They are joined by merging, never broadcast: planned from
compressed files, they look far smaller than they are.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from ..functions.times import epoch_micros, epoch_seconds
from ..session import cut_lineage

BLOCK_ROWS = 4096
BLOCK_SECONDS = 120 * 86400
#: Points (rows times values) that a task of :func:`task_number` gets, about.
TASK_POINTS = 500_000

Stage = tuple[int, Callable[[WindowSpec], dict[str, Column]]]


def with_trailing_frames(df: DataFrame, keys: Sequence[str], index: Column | str,
                         stages: Sequence[Stage], block: int = BLOCK_ROWS) -> DataFrame:
    """Add columns computed from the current and up to ``depth`` preceding rows.

    ``index`` numbers the rows of a key consecutively (``hour_index`` on a regular hourly
    series, ``row_index`` otherwise). Stages run in order on the same blocks; each is
    ``(depth, window -> {column: expression})`` and may read columns of earlier stages. The
    overlap is the sum of the depths, so a later stage finds earlier ones complete.
    """
    depth = sum(d for d, _ in stages)
    if depth >= block:
        raise ValueError("block must be longer than the summed depth of the stages")
    idx = F.col(index) if isinstance(index, str) else index
    df = df.withColumn("_idx", idx.cast("bigint"))
    own = F.floor(F.col("_idx") / block)
    near_end = F.pmod(F.col("_idx"), F.lit(block)) >= block - depth
    df = df.withColumn("_blk", F.explode(F.when(near_end, F.array(own, own + 1)).otherwise(F.array(own))))
    w = Window.partitionBy(*keys, "_blk").orderBy("_idx")
    for _, build in stages:
        df = df.withColumns(build(w))
    return df.where(F.col("_blk") == F.floor(F.col("_idx") / block)).drop("_blk", "_idx")


def task_number(df: DataFrame, values: int = 1) -> int:
    """As many tasks as the rows of a table need, so that the memory of one does not grow with it. ``df`` should be read from files, which know their counts.

    The session's partitions do not follow the rows: they are of a fixed number, and merged by compressed bytes, of which series need few.
    """
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() * values // TASK_POINTS))


def _time_block(ts: str, seconds: int) -> Column:
    return F.floor(epoch_seconds(F.col(ts)) / seconds).cast("bigint")


def row_index(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "row_index",
              seconds: int = BLOCK_SECONDS) -> DataFrame:
    """Number rows 1..n per key in ``order`` (first entry a time, the rest break ties)."""
    df = df.withColumn("_blk", _time_block(order[0], seconds))
    counts = df.groupBy(*keys, "_blk").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_blk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    w = Window.partitionBy(*keys, "_blk").orderBy(*order)
    ranked = df.withColumn("_rn", F.row_number().over(w))
    return (
        ranked.join(offsets.hint("merge"), [*keys, "_blk"])
        .withColumn(name, (F.col("_rn") + F.col("_off")).cast("bigint"))
        .drop("_blk", "_rn", "_off")
    )


#: Widths of the cells that equal-count blocks are cut from: hour, second, millisecond and microsecond.
CELL_MICROS = (3_600_000_000, 1_000_000, 1_000, 1)


def _splitters(cells: DataFrame, parent: Sequence[str], cell: str, limit: int) -> DataFrame:
    """``_start``: the first cell of each one's block. Cells are cumulated in order; a cell above ``limit`` rows is a block of its own."""
    w = Window.partitionBy(*parent).orderBy(cell)
    before = F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = cells.withColumns({"_step": F.floor(F.coalesce(before, F.lit(0)) / limit), "_heavy": F.col("_n") > limit})
    begins = F.coalesce(F.lag("_step").over(w) != F.col("_step"), F.lit(True)) | F.col("_heavy") | F.coalesce(F.lag("_heavy").over(w), F.lit(False))
    marked = marked.withColumn("_begins", begins)
    first = F.last(F.when(F.col("_begins"), F.col(cell)), ignorenulls=True)
    return marked.withColumn("_start", first.over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_step", "_begins", "_n")


def equal_blocks(df: DataFrame, keys: Sequence[str], ts: str, limit: int = BLOCK_ROWS) -> DataFrame:
    """Add ``_blk``, an ordered block of at most about 2 * ``limit`` rows of a key, however its rows crowd in time.

    Hours of a key are cumulated to blocks of equal count. An hour above ``limit`` rows is cut again from the counts of its own
    seconds, a second from its milliseconds, those from their microseconds, so a block holds more only if one microsecond does. ``df`` should be a
    written table; only counts of cells are ordered, at most one key's hours or one cell's 3,600 parts at a time.
    """
    names = [f"_c{i}" for i in range(len(CELL_MICROS))]
    micros = epoch_micros(F.col(ts))
    out = df.withColumns({c: F.floor(micros / width).cast("bigint") for c, width in zip(names, CELL_MICROS)})
    parent, rows, starts = list(keys), out, []
    for i, cell in enumerate(names):
        found = _splitters(rows.groupBy(*parent, cell).agg(F.count(F.lit(1)).alias("_n")), parent, cell, limit)
        found = cut_lineage(found.withColumnRenamed("_start", f"_start{i}"), "splitters")
        parent = [*parent, cell]
        out = out.join(found.drop("_heavy").hint("merge"), parent, "left")
        starts.append(F.coalesce(F.col(f"_start{i}"), F.lit(0)).alias(f"b{i}"))
        heavy = found.where("_heavy").select(*parent)
        if cell == names[-1] or heavy.isEmpty():
            break
        rows = rows.join(heavy.hint("merge"), parent, "left_semi")
    return out.withColumn("_blk", F.struct(*starts)).drop(*names, *[f"_start{i}" for i in range(len(starts))])


def with_neighbours(df: DataFrame, keys: Sequence[str], ts: str, values: Sequence[str],
                    seconds: int = BLOCK_SECONDS, limit: int | None = None,
                    settle: Callable[[DataFrame, list[str]], DataFrame] | None = None, tasks: int | None = None) -> DataFrame:
    """Add ``_prev_<v>`` and ``_next_<v>``: the closest non-null point at or before / after.

    Each is a struct ``(rn, t, v)`` with the row number per key, the time and the value.
    ``_rn`` is the row number of the current row. Times are unique per key, or ``settle`` makes one row, with the ``values``, of the rows of a
    time; it is given the columns to group by. Blocks cover ``seconds`` each, which bounds
    them for hourly series; with ``limit`` they hold equal counts of rows instead. ``tasks``, if given, is the number of tasks they are dealt to.
    """
    df = equal_blocks(df, keys, ts, limit) if limit else df.withColumn("_blk", _time_block(ts, seconds))
    if tasks:
        df = df.repartition(tasks, *keys, "_blk")
    if settle:
        df = settle(df, [*keys, "_blk", ts])
    w = Window.partitionBy(*keys, "_blk").orderBy(ts)
    back = Window.partitionBy(*keys, "_blk").orderBy(F.col(ts).desc())
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    downto = back.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def point(v: str) -> Column:
        return F.when(F.col(v).isNotNull(),
                      F.struct(F.col("_rn").alias("rn"), F.col(ts).alias("t"), F.col(v).alias("v")))

    numbered = df.withColumn("_rn", F.row_number().over(w).cast("bigint"))
    ordered = numbered.withColumns({f"_prev_{v}": F.last(point(v), ignorenulls=True).over(upto) for v in values})
    ordered = ordered.withColumns({f"_next_{v}": F.last(point(v), ignorenulls=True).over(downto) for v in values})

    # Block summaries: row count and the outermost points.
    def known(v: str) -> Column:
        return F.when(F.col(v).isNotNull(), F.col(ts))
    summary = numbered.groupBy(*keys, "_blk").agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.max_by(point(v), known(v)).alias(f"_last_{v}") for v in values],
        *[F.min_by(point(v), known(v)).alias(f"_first_{v}") for v in values],
    )
    sb = Window.partitionBy(*keys).orderBy("_blk")
    before = sb.rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*keys).orderBy(F.col("_blk").desc()).rowsBetween(Window.unboundedPreceding, -1)

    def shifted(p: str) -> Column:
        c = F.col(p)
        return F.when(c.isNotNull(), F.struct((c["rn"] + F.col("_off")).alias("rn"),
                                              c["t"].alias("t"), c["v"].alias("v")))

    summary = summary.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    summary = summary.select(
        *keys, "_blk", "_off",
        *[F.last(shifted(f"_last_{v}"), ignorenulls=True).over(before).alias(f"_in_prev_{v}") for v in values],
        *[F.last(shifted(f"_first_{v}"), ignorenulls=True).over(after).alias(f"_in_next_{v}") for v in values],
    )
    out = ordered.join(summary.hint("merge"), [*keys, "_blk"])
    out = out.withColumns({
        **{f"_prev_{v}": F.coalesce(shifted(f"_prev_{v}"), F.col(f"_in_prev_{v}")) for v in values},
        **{f"_next_{v}": F.coalesce(shifted(f"_next_{v}"), F.col(f"_in_next_{v}")) for v in values},
        "_rn": F.col("_rn") + F.col("_off"),
    })
    return out.drop("_blk", "_off", *[f"_in_prev_{v}" for v in values], *[f"_in_next_{v}" for v in values])


def drop_neighbours(df: DataFrame, values: Sequence[str]) -> DataFrame:
    return df.drop("_rn", *[f"_prev_{v}" for v in values], *[f"_next_{v}" for v in values])
