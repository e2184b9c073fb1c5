"""Parameter search of site trees by staged errors and successive halving.

Drawn combinations that differ in the number of trees only are beginnings of one fit, so a fit per (depth, step) gives the errors of all of
them. Candidates are compared on a small share of a site's rows first; the better half of them goes on to twice the rows, the last round has all rows.
"""

from __future__ import annotations

import itertools
import math
import random
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..functions import boosting
from ..session import cut_lineage
from . import folds, models

#: Rows a site needs in the first round; smaller sites join in a later round, with all candidates.
FIRST_ROWS = 2_000
#: Rows of a site that one task holds; larger sites are fitted by distributed trees.
TASK_ROWS = 500_000
PARAMETERS = ["maxDepth", "maxIter", "stepSize"]


def draw_combinations(space: dict[str, Sequence], draws: int, seed: int = 42) -> list[dict]:
    """``draws`` different random combinations of the values in ``space``; all of them, if there are fewer."""
    names = sorted(space)
    every = list(itertools.product(*[space[n] for n in names]))
    return [dict(zip(names, c)) for c in random.Random(seed).sample(every, min(draws, len(every)))]


def staged_errors(rows: DataFrame, candidates: DataFrame, site: str, features: Sequence[str], target: str, trees: dict[tuple[int, float], list[int]],
                  n_folds: int, seed: int) -> DataFrame:
    """(site, maxDepth, stepSize, maxIter, mse) of every candidate (site, maxDepth, stepSize) on ``rows`` with their ``fold``.

    One task holds the rows of one site for one candidate.
    """
    features, kind = list(features), dict(rows.dtypes)[site]

    def errors(key, part):
        depth, step = int(key[1]), float(key[2])
        asked = trees[depth, step]
        part = part.sort_values([*features, target, "fold"])
        x, y, fold = part[features].to_numpy("float64"), part[target].to_numpy("float64"), part["fold"].to_numpy()
        squares = dict.fromkeys(asked, 0.0)
        tested = 0
        for k in range(n_folds):
            held = fold == k
            if held.any() and not held.all():
                tested += int(held.sum())
                for t, s in boosting.staged_squares(x, y, held, asked, depth, step, seed).items():
                    squares[t] += s
        return pd.DataFrame([(key[0], depth, step, t, s / tested if tested else None) for t, s in squares.items()], columns=[site, "maxDepth", "stepSize", "maxIter", "mse"])

    both = rows.join(candidates.select(site, "maxDepth", "stepSize"), site).select(site, "maxDepth", "stepSize", *features, target, "fold")
    return both.groupBy(site, "maxDepth", "stepSize").applyInPandas(errors, f"`{site}` {kind}, maxDepth INT, stepSize DOUBLE, maxIter INT, mse DOUBLE")


def distributed_errors(rows: DataFrame, site: str, large: list, features: Sequence[str], target: str, trees: dict[tuple[int, float], list[int]],
                       n_folds: int, seed: int) -> DataFrame:
    """The same table for sites too large for a task: every fold of every candidate is a distributed fit whose errors are read off tree by tree."""
    found = []
    for name, (depth, step) in itertools.product(large, trees):
        mine = rows.where(F.col(site) == name)
        squares, tested = dict.fromkeys(trees[depth, step], 0.0), 0
        for k in range(n_folds):
            fitted = models.fit_trees(mine.where(F.col("fold") != k), features, target, seed=seed, maxIter=max(squares), maxDepth=depth, stepSize=step, subsamplingRate=0.8)
            held = fitted.stages[0].transform(mine.where(F.col("fold") == k))
            n, staged = held.count(), fitted.stages[1].evaluateEachIteration(held, "squared")
            tested += n
            squares = {t: s + n * staged[t - 1] for t, s in squares.items()}
        found += [(name, depth, step, t, s / tested) for t, s in squares.items()]
    return rows.sparkSession.createDataFrame(found, f"`{site}` {dict(rows.dtypes)[site]}, maxDepth INT, stepSize DOUBLE, maxIter INT, mse DOUBLE")


def halving_search(df: DataFrame, site: str, keys: Sequence[str], features: Sequence[str], target: str, space: dict[str, Sequence], draws: int = 10,
                   n_folds: int = 3, seed: int = 42, first_rows: int = FIRST_ROWS, task_rows: int = TASK_ROWS) -> DataFrame:
    """(site, maxDepth, maxIter, stepSize, share, n_rows, mse, best) of every drawn combination and site.

    ``space`` has maxDepth, maxIter and stepSize. ``share`` is the part of the site's rows the combination was last compared on, ``mse`` its
    cross-validated error there; ``best`` marks the lowest among those compared on all rows (of equals the fewest trees, then the lowest depth and step).
    Rows with a missing value do not take part; a row's fold and round come from a hash of its ``keys``. Sites too small to be cut into
    folds get no error.
    """
    drawn = draw_combinations(space, draws, seed)
    trees: dict[tuple[int, float], list[int]] = {}
    for c in drawn:
        trees.setdefault((int(c["maxDepth"]), float(c["stepSize"])), []).append(int(c["maxIter"]))
    rounds = max(1, math.ceil(math.log2(len(trees))))
    cols = [F.col(c).cast("double").alias(c) for c in dict.fromkeys([*features, target])]
    rows = folds.shuffled_folds(df, list(keys), n_folds, seed).withColumn("_h", folds._hash_share(list(keys), seed + 1))
    rows = cut_lineage(rows.select(site, *cols, "fold", "_h").na.drop(), "search-rows")
    sizes = cut_lineage(rows.groupBy(site).agg(F.count(F.lit(1)).alias("n_rows")), "search-sizes")
    spark = df.sparkSession
    classes = spark.createDataFrame(list(trees), "maxDepth INT, stepSize DOUBLE")  # at most ``draws`` rows
    large = [r[site] for r in sizes.where(F.col("n_rows") > task_rows).select(site).collect()]
    small = sizes.where(F.col("n_rows") <= task_rows)
    alive = small.select(site, "n_rows").join(F.broadcast(classes))
    done, order = [], Window.partitionBy(site).orderBy("mse", "maxDepth", "stepSize")
    for r in range(rounds):
        share = 0.5 ** (rounds - 1 - r)
        now = alive if share == 1 else alive.where(F.col("n_rows") * share >= first_rows)
        part = rows.where(F.col("_h") < share)
        errors = cut_lineage(staged_errors(part, now, site, features, target, trees, n_folds, seed).withColumn("share", F.lit(share)), "search-errors")
        done.append(errors)
        if share < 1:
            ranked = errors.groupBy(site, "maxDepth", "stepSize").agg(F.min("mse").alias("mse"))
            ranked = ranked.withColumns({"_r": F.row_number().over(order), "_n": F.count(F.lit(1)).over(Window.partitionBy(site))})
            out = ranked.where(F.col("_r") > F.ceil(F.col("_n") / 2)).select(site, "maxDepth", "stepSize")
            alive = cut_lineage(alive.join(out, [site, "maxDepth", "stepSize"], "left_anti"), "search-alive")
    if large:
        done.append(distributed_errors(rows, site, large, features, target, trees, n_folds, seed).withColumn("share", F.lit(1.0)))
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    latest = every.groupBy(site, "maxDepth", "maxIter", "stepSize").agg(F.max_by("mse", "share").alias("mse"), F.max("share").alias("share"))
    place = F.row_number().over(Window.partitionBy(site).orderBy(F.col("share").desc(), "mse", "maxIter", "maxDepth", "stepSize"))
    return latest.join(sizes, site).withColumn("best", (place == 1) & F.col("mse").isNotNull())
