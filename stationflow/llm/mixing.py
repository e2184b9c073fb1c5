"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in hashed order, ``repeats`` times over. A document's virtual finish time is the number of its source's words
up to and with it, divided by the source's weight. All documents of all rounds are range-sorted by finish time and cut off at the total budget. A source
that runs dry leaves its share to the others by weight, which is the rule that gives the targets too.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .prefix import running
from .shards import BLOCK_ROWS, hashed

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[int], repeats: int, budget: int | None = None) -> DataFrame:
    """(source, source_size, rank, weight, target) from the written table (source, source_size): shares of ``budget`` (None: all words) by weight.

    Weights go round over the sources by code point, null last. A target stops at ``repeats`` times its source's size; sources stop in
    the order in which they run dry, and the rest is shared anew by weight.
    """
    common = math.lcm(*weights)
    ranked = running(sizes.withColumn("none", F.col("source").isNull()), ["none", "source"], {"rank": F.lit(1)}, name="ranked-sources").drop("none")
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    ranked = ranked.withColumn("weight", F.get(cycle, ((F.col("rank") - 1) % len(weights)).cast("int")).cast("bigint"))
    ranked = cut_lineage(ranked.withColumn("dry", F.col("source_size") * repeats * F.expr(f"{common} div weight")), "weighted-sources")
    all_of = ranked.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    total = (all_of["size"] or 0) if budget is None else budget
    queue = running(ranked, ["dry", "rank"], {"stopped": F.col("source_size") * repeats, "heavy": F.col("weight")}, name="dry-sources")
    wide = "decimal(38,0)"
    left = F.lit(total).cast(wide) - (F.col("stopped") - F.col("source_size") * repeats)
    sharing = F.lit(all_of["weight"] or 0).cast(wide) - F.col("heavy") + F.col("weight")
    queue = cut_lineage(queue.withColumn("stops", F.col("weight") * left > F.col("source_size") * repeats * sharing), "stopping-sources")
    kept = queue.agg(F.sum(F.when(F.col("stops"), F.col("source_size") * repeats)).alias("size"), F.sum(F.when(~F.col("stops"), F.col("weight"))).alias("weight")).first()
    shared = (F.col("weight") * (total - (kept["size"] or 0))).cast("double") / F.lit(float(kept["weight"] or 1))
    target = F.when(F.col("stops"), (F.col("source_size") * repeats).cast("double")).otherwise(shared)
    return queue.select("source", "source_size", "rank", "weight", target.alias("target"))


def one_by_one(counted: DataFrame, keys: Sequence[str], copies: str = "m") -> DataFrame:
    """Rows of counted equal rows, numbered ``k`` from 0; a row of very many copies is written out by many tasks."""
    few = counted.where(F.col(copies) <= BLOCK_ROWS).withColumn("k", F.explode(F.sequence(F.lit(0), F.col(copies) - 1)))
    many = counted.where(F.col(copies) > BLOCK_ROWS).withColumn("part", F.explode(F.sequence(F.lit(0), F.floor((F.col(copies) - 1) / BLOCK_ROWS))))
    many = many.repartition(*keys, "part").withColumn(
        "k", F.explode(F.sequence(F.col("part") * BLOCK_ROWS, F.least(F.col(copies), (F.col("part") + 1) * BLOCK_ROWS) - 1)))
    return few.unionByName(many.drop("part")).drop(copies)


def mix(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), repeats: int = 3, budget: int | None = None, text: str = "text",
        doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """(doc_id, size, source, source_size, target, taken) of every row: ``taken`` words of it go into the mix, whole documents up to ``repeats`` times.

    Weights are whole numbers; ``budget`` is in words, None stands for all there are. A source's taken words come within its largest document (and its
    part of the last document cut off) of the target. The order within a source is a hash of id, size and copy number, so reruns agree; a
    null id is a key like any other, rows equal in id, source and size are told apart by their number only, which no output column shows.
    Null and wordless texts have size 0 and take nothing; a null source is a source. An empty table gives an empty mix.
    Only ids, sources and sizes are shuffled; a source of any size is cut into parts by order, equal rows are counted first.
    """
    slim = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"), word_count(F.col(f"`{text}`")).alias("size"))
    counted = cut_lineage(slim.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("m")), "sized")
    sizes = cut_lineage(counted.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size")), "source-sizes")
    sources = cut_lineage(source_targets(sizes, weights, repeats, budget), "sources")
    total = sources.agg(F.sum("source_size").alias("size")).first()["size"] or 0 if budget is None else budget
    rows = one_by_one(counted, ["doc_id", "source", "size"])
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "size", "k")
    rows = rows.withColumn("h", hashed(key, F.lit("mix"))).withColumnRenamed("source", "of")
    rows = rows.join(sources, F.col("of").eqNullSafe(F.col("source"))).drop("of")
    served = running(cut_lineage(rows, "queued"), ["h", "doc_id", "size", "k"], {"upto": F.col("size")}, ["rank"], "served")
    per_word = F.expr(f"{math.lcm(*weights)} div weight")
    served = cut_lineage(served.withColumn("per_word", per_word), "served")

    def place(e: Column) -> Column:
        finish = (e * F.col("source_size") + F.col("upto")) * F.col("per_word")
        return F.struct(finish.alias("finish"), "rank", "h", "doc_id", "size", "k", e.cast("int").alias("e"))

    rounds = served.select(F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("e"), *served.columns).where("size > 0").select(place(F.col("e")).alias("at"))
    line = running(cut_lineage(rounds.select("at", F.col("at.size").alias("size")), "rounds"), ["at"], {"total": F.col("size")}, name="line")
    end = line.where(F.col("total") <= total).agg(F.max("at").alias("end"))
    served = served.withColumn("end", end.scalar())
    taken = sum((F.coalesce(place(F.lit(e)) <= F.col("end"), F.lit(False)).cast("bigint") for e in range(repeats)), F.lit(0))
    return served.select("doc_id", "size", "source", "source_size", "target", (F.col("size") * taken).cast("bigint").alias("taken"))
