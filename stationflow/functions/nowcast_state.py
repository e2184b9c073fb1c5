"""Stateful NowCast of one site. Travels with the task (pickled by value)."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUTPUT = "site STRING, ts TIMESTAMP, value DOUBLE, nowcast DOUBLE, late BOOLEAN"
STATE = "start BIGINT, begun BOOLEAN, vals ARRAY<DOUBLE>"
HOURS = 12
#: Hours of a site kept as state: late ones are taken up as long as their whole window is among them.
KEPT = 60 * 24
HOUR_NS = 3_600_000_000_000


def weighted_means(values: np.ndarray, first: int) -> np.ndarray:
    """NowCast at every place from ``first`` on, over up to ``HOURS`` values; NaN where one is missing, 0 where all are 0."""
    padded = np.concatenate([np.full(HOURS - 1, np.nan), values])
    windows = np.lib.stride_tricks.sliding_window_view(padded, HOURS)[first:]
    # places before the series' first hour are no missing values
    real = np.arange(HOURS) >= HOURS - 1 - np.arange(first, first + len(windows))[:, None]
    missing = (np.isnan(windows) & real).any(axis=1)
    top = np.where(real, np.nan_to_num(windows), -np.inf).max(axis=1)
    low = np.where(real, np.nan_to_num(windows), np.inf).min(axis=1)
    share = np.maximum(0.5, 1 - (top - low) / np.where(top == 0, 1, top))
    weights = np.where(real, share[:, None] ** np.arange(HOURS - 1, -1, -1), 0)
    means = (weights * np.nan_to_num(windows)).sum(axis=1) / weights.sum(axis=1)
    return np.where(missing, np.nan, np.where(top == 0, 0.0, means))


class NowCastProcessor(StatefulProcessor):
    """Keeps the last hours of a site as a gapless row of values; an absent hour counts as a missing value.

    Of one hour that comes twice, the first value stays. Hours too old for the state are sent on as they are, marked ``late`` and
    without a NowCast, for a batch pass to settle.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState("hours", STATE)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True).dropna(subset=["ts"])
        hours = pd.to_datetime(new["ts"]).dt.tz_localize(None).astype("datetime64[ns]").astype("int64").to_numpy() // HOUR_NS
        start, begun, old = None, False, np.zeros(0)
        if self._state.exists():
            start, begun, old = self._state.get()
            old = np.array([np.nan if v is None else v for v in old], dtype="float64")
        # hours whose window would reach beyond the state cannot be settled any more
        usable = hours >= (start + HOURS - 1 if begun else np.iinfo("int64").min)
        values = pd.to_numeric(new["value"]).to_numpy(dtype="float64")
        old_hours, first = np.unique(hours[~usable & ~np.isnan(values)], return_index=True)
        if len(old_hours):
            yield pd.DataFrame({"site": key[0], "ts": pd.to_datetime(old_hours * HOUR_NS), "value": values[~usable & ~np.isnan(values)][first],
                                "nowcast": None, "late": True})
        hours, values = hours[usable], values[usable]
        if len(hours):
            low = int(hours.min()) if start is None else min(start, int(hours.min()))
            high = int(hours.max()) if start is None else max(start + len(old) - 1, int(hours.max()))
            line = np.full(high - low + 1, np.nan)
            if start is not None:
                line[start - low:start - low + len(old)] = old
            order = np.lexsort((-np.arange(len(hours)), ~np.isnan(values)))  # the first value of several is written last
            fresh = np.full(len(line), np.nan)
            fresh[hours[order] - low] = values[order]
            line = np.where(np.isnan(line), fresh, line)
            touched = np.zeros(len(line) + HOURS, dtype=bool)
            for k in range(HOURS):
                touched[hours - low + k] = True
            # an earlier first hour gives later windows more values
            if start is not None and low < start:
                touched[start - low:start - low + HOURS] = True
            at = np.flatnonzero(touched[:len(line)] & ~np.isnan(line))
            means = weighted_means(line, 0)[at]
            yield pd.DataFrame({"site": key[0], "ts": pd.to_datetime((at + low) * HOUR_NS), "value": line[at],
                                "nowcast": [None if np.isnan(m) else float(m) for m in means], "late": False})
            drop = max(0, len(line) - KEPT)
            self._state.update((low + drop, bool(begun or drop), [None if np.isnan(v) else float(v) for v in line[drop:]]))

    def close(self) -> None:
        pass


cloudpickle.register_pickle_by_value(sys.modules[__name__])
