"""Searches, transfers, grouped folds and quantile regressions against plain numpy."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationflow.functions import boosting
from stationflow.operators import folds, models, tuning

SPACE = {"maxDepth": [1, 3], "maxIter": [4, 12], "stepSize": [0.05, 0.5]}


def plain_tree(codes, rest, depth, min_rows):
    """Prediction per row of a tree grown by trying every split of every node."""
    def value(at):
        return float(rest[at].mean()) if len(at) else 0.0

    def split(at, left):
        if not left:
            return {i: value(at) for i in at}
        best = None
        for f in range(codes.shape[1]):
            for b in range(boosting.BINS):
                low, high = [i for i in at if codes[i, f] <= b], [i for i in at if codes[i, f] > b]
                if len(low) >= min_rows and len(high) >= min_rows:
                    gain = rest[low].sum() ** 2 / len(low) + rest[high].sum() ** 2 / len(high) - rest[at].sum() ** 2 / len(at)
                    if gain > 1e-12 and (best is None or gain > best[0] + 1e-9):
                        best = gain, low, high
        if best is None:
            return split(at, left - 1)
        return {**split(best[1], left - 1), **split(best[2], left - 1)}

    found = split(list(range(len(codes))), depth)
    return np.array([found[i] for i in range(len(codes))])


def test_trees_are_those_of_every_split_tried():
    rng = np.random.default_rng(1)
    x, every = rng.normal(size=(70, 3)).round(1), np.ones(70, bool)
    y = np.where(x[:, 0] > 0.2, 3.0, x[:, 1]) + rng.normal(size=70) * 0.1
    codes = boosting.bin_codes(x, boosting.bin_edges(x))
    for depth in (1, 2, 3):
        feature, border, values = boosting.grow(codes, y, every, depth, 5)
        assert np.allclose(values[boosting.leaf_of(codes, feature, border, depth)], plain_tree(codes, y, depth, 5))


def test_errors_of_fewer_trees_are_read_off_one_fit():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 2))
    y, held = x[:, 0] ** 2 + x[:, 1], rng.random(300) < 0.3
    staged = boosting.staged_squares(x, y, held, [3, 10, 30], 3, 0.2)
    assert staged == {t: boosting.staged_squares(x, y, held, [t], 3, 0.2)[t] for t in (3, 10, 30)}
    assert staged[10] < staged[3] < ((y[held] - y[~held].mean()) ** 2).sum()


@pytest.fixture(scope="module")
def searched(spark):
    rng = np.random.default_rng(3)
    rows = [(site, i, float(a), float(b), float((a > 0) * 4 * sign + b + rng.normal() * 0.2))
            for site, n, sign in (("big", 600, 1), ("small", 90, -1)) for i, (a, b) in enumerate(rng.normal(size=(n, 2)))]
    rows += [("big", 9000, None, 1.0, 1.0), ("single", 1, 0.5, 0.5, 1.0)]
    return spark.createDataFrame(rows, "site STRING, i INT, a DOUBLE, b DOUBLE, y DOUBLE")


def plain_search(df, draws, site):
    frame = folds.shuffled_folds(df.where(F.col("site") == site), ["site", "i"], 3).dropna().toPandas().sort_values(["a", "b", "y", "fold"])
    x, y, fold = frame[["a", "b"]].to_numpy(), frame["y"].to_numpy(), frame["fold"].to_numpy()
    return {(c["maxDepth"], c["maxIter"], c["stepSize"]): sum(
        boosting.staged_squares(x, y, fold == k, [c["maxIter"]], c["maxDepth"], c["stepSize"])[c["maxIter"]] for k in range(3)) / len(y) for c in draws}


def test_halving_finds_the_winner_of_the_whole_search(spark, searched):
    found = tuning.halving_search(searched, "site", ["site", "i"], ["a", "b"], "y", SPACE, draws=8, first_rows=60).collect()
    assert len(found) == 3 * 8
    shares = {s: {r["share"] for r in found if r["site"] == s} for s in ("big", "small")}
    assert min(shares["big"]) < 1 and shares["small"] == {0.5, 1.0} or shares["small"] == {1.0}
    for site in ("big", "small"):
        want = plain_search(searched, tuning.draw_combinations(SPACE, 8), site)
        mine = [r for r in found if r["site"] == site]
        for r in mine:
            if r["share"] == 1:
                assert r["mse"] == pytest.approx(want[r["maxDepth"], r["maxIter"], r["stepSize"]])
        [best] = [r for r in mine if r["best"]]
        assert best["mse"] == pytest.approx(min(want.values()))
    assert not any(r["best"] or r["mse"] is not None for r in found if r["site"] == "single")


def test_large_sites_are_searched_by_distributed_trees(spark, searched):
    space = {"maxDepth": [1, 2], "maxIter": [1, 2], "stepSize": [0.3]}
    found = tuning.halving_search(searched, "site", ["site", "i"], ["a", "b"], "y", space, draws=4, task_rows=300).where("site = 'big'").collect()
    assert len(found) == 4 and all(r["share"] == 1 and r["mse"] > 0 for r in found)
    assert {r["maxIter"]: r["mse"] for r in found if r["maxDepth"] == 1}[2] < {r["maxIter"]: r["mse"] for r in found if r["maxDepth"] == 1}[1]


def ridge_of(x, y, w, ridge):
    mean, spread = (w @ x) / w.sum(), np.sqrt((w @ (x - (w @ x) / w.sum()) ** 2) / w.sum())
    z, my = (x - mean) / spread, (w @ y) / w.sum()
    beta = np.linalg.solve((z * w[:, None]).T @ z / w.sum() + ridge * np.eye(x.shape[1]), (z * w[:, None]).T @ (y - my) / w.sum()) / spread
    return np.r_[my - beta @ mean, beta]


def test_transfer_shrinks_towards_the_old_period(spark):
    rng = np.random.default_rng(4)
    rows, want = [], {}
    for site, n_old, n_new in (("both", 150, 60), ("few old", 30, 80), ("few new", 120, 10), ("only old", 110, 0)):
        x = rng.normal(size=(n_old + n_new, 2))
        new = np.arange(n_old + n_new) >= n_old
        y = np.where(new, x[:, 0] * 3 + 1, x[:, 0] - x[:, 1]) + rng.normal(size=len(new)) * 0.1
        rows += [(site, int(t), float(a), float(b), float(v)) for t, (a, b), v in zip(new, x, y)]
        base = np.ones(len(new)) if n_old < 100 else (~new).astype(float)
        want[site] = n_old, n_new, n_new >= 50, ridge_of(x, y, base * 0.1 + new if n_new >= 50 else base, 1e-3)
    df = spark.createDataFrame(rows, "site STRING, t INT, a DOUBLE, b DOUBLE, y DOUBLE")
    got = models.transfer_sites(df, ["site"], "t", F.lit(1), ["a", "b"], "y").collect()
    for r in got:
        n_old, n_new, tuned, coef = want[r["site"]]
        assert (r["n_old"], r["n_new"], r["tuned"]) == (n_old, n_new, tuned) and r["coef"] == pytest.approx(coef, abs=1e-9)
    assert len(got) == len(want)


def test_sites_are_packed_into_even_folds(spark):
    rng = np.random.default_rng(5)
    sizes = {f"s{i}": int(n) for i, n in enumerate(rng.pareto(1.5, 60) * 20 + 1)} | {None: 7}
    df = spark.createDataFrame([(s, i) for s, n in sizes.items() for i in range(n)], "site STRING, i INT")
    got = folds.grouped_folds(df, "site", 4).groupBy("site", "fold").count().collect()
    known = {s: n for s, n in sizes.items() if s is not None}
    assert {r["site"]: r["count"] for r in got} == known and len(got) == len(known)
    rows = [sum(r["count"] for r in got if r["fold"] == k) for k in range(4)]
    assert max(rows) - min(rows) <= max(known.values())
    few = folds.grouped_folds(df.where("site in ('s1', 's2')"), "site", 4).select("site", "fold").distinct().collect()
    assert len({r["fold"] for r in few}) == 2 or len(few) == 2


def pinball(y, guess, tau):
    return np.where(y >= guess, tau * (y - guess), (1 - tau) * (guess - y)).sum()


def test_quantile_regressions_reach_the_least_pinball_loss(spark):
    rng = np.random.default_rng(6)
    rows = []
    for site in ("a", "b"):
        x = rng.random(60) * 10
        rows += [(site, float(v), float(2 * v + rng.normal() * (v if site == "a" else 3))) for v in x]
    rows += [("a", None, 1.0), ("flat", 1.0, 2.0), ("flat", 1.0, 2.0)]
    df = spark.createDataFrame(rows, "site STRING, x DOUBLE, y DOUBLE")
    names = {"lower": 0.15, "mid": 0.5, "upper": 0.85}
    fitted = models.pinball_sites(df, ["site"], ["x"], "y", list(names.values()))
    for r in fitted.where("site <> 'flat'").collect():
        x, y = np.array([(a, b) for s, a, b in rows if s == r["site"] and a is not None]).T
        # a best line goes through two of the points
        lines = [((y[j] - y[i]) / (x[j] - x[i]), i) for i, j in itertools.combinations(range(len(x)), 2)]
        least = min(pinball(y, y[i] + slope * (x - x[i]), r["tau"]) for slope, i in lines)
        assert pinball(y, r["coef"][0] + r["coef"][1] * x, r["tau"]) <= least * 1.01
    out = models.quantile_predictions(df, fitted, ["site"], ["x"], names).where("x IS NOT NULL").collect()
    assert all(r["lower"] <= r["mid"] <= r["upper"] for r in out)
    assert all(math.isclose(r["mid"], 2.0, abs_tol=1e-6) for r in out if r["site"] == "flat")
