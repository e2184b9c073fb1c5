"""A cross-section of the registered queries against their SQL (all of them: ``python check.py``)."""

import os

import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"
SAMPLE = ["flagship_aqi", "interpolate_limit12", "precedence_union", "snapshot_nearest", "grid_daily_mean", "site_ratio",
          "threshold_counts", "site_regression"]
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the given tables")


@pytest.mark.parametrize("name", SAMPLE)
def test_query_agrees_with_sql(spark, name):
    state, n, _, info = check.compare(spark, check.connect(SF_DIR), name, queries()[name], oracle_sql()[name], SF_DIR)
    assert state == "ok" and n > 0, info


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


def test_sql_belongs_to_queries():
    assert set(oracle_sql()) <= set(queries()) and len(queries()) > 100


def test_tree_queries_ask_for_full_sizes(spark, monkeypatch):
    """The fits themselves are replaced by small ones here."""
    from stationflow.functions import boosting
    from stationflow.operators import models, tuning
    asked, whole = [], models.tree_pipeline

    def small(features, target, prediction="prediction", seed=42, **params):
        asked.append(params)
        return whole(features, target, prediction, seed, maxIter=1, maxDepth=2)

    monkeypatch.setattr(models, "tree_pipeline", small)
    fits = {}
    for name in ("pooled_trees", "pooled_from_file", "champion_selection", "feature_importance"):
        asked.clear()
        assert queries()[name](spark, SF_DIR).count() > 0
        fits[name] = list(asked)
    one = models.POOLED_TREES
    assert fits == {"pooled_trees": [one] * 4, "pooled_from_file": [one] * 4, "champion_selection": [one], "feature_importance": [one]}
    from stationflow.catalog.modelling import SEARCH_SPACE
    drawn = tuning.draw_combinations(SEARCH_SPACE, 10)
    assert len(drawn) == 10 and max(c["maxIter"] for c in drawn) == 500 and boosting.BINS == 32


def test_trainers_go_over_the_events_once(spark, monkeypatch):
    from stationflow.catalog import modelling
    from stationflow.plans import pooled
    taken = []
    monkeypatch.setattr(pooled, "train_from_pool", lambda pool: (None, taken.append(pool), None))
    modelling.pooled_from_file(spark, SF_DIR)
    for df in (*modelling._model_and_obs(spark, SF_DIR), *taken):
        assert df.count() > 0 and not any("events.parquet" in f for f in df.inputFiles())
    assert len(taken) == 1
