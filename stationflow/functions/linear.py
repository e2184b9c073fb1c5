"""Numpy helpers of the site regressions, used inside Arrow tasks.

The module imports nothing but numpy and pandas and travels with the task (pickled by value), so
workers need neither the package nor its imports.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark import cloudpickle

PRODUCTS_AT_ONCE = 2_000_000


def sum_products(batch: pd.DataFrame, keys: list[str], names: list[str], weight: str | None = None) -> pd.DataFrame:
    """One row per key of a batch: its keys and the flattened product matrix of its complete rows, each times its weight if there is one."""
    batch = batch[batch[names].notna().all(axis=1)]
    if batch.empty:
        return batch[keys].assign(part=pd.Series([], dtype=object))
    code = batch.groupby(keys, sort=False, dropna=False).ngroup().to_numpy()
    order = np.argsort(code, kind="stable")
    x = np.column_stack([np.ones(len(batch)), batch[names].to_numpy(dtype="float64")])[order]
    if weight:
        x *= np.sqrt(batch[weight].to_numpy(dtype="float64"))[order][:, None]
    starts = np.flatnonzero(np.r_[True, np.diff(code[order]) != 0])
    products = np.einsum("ni,nj->nij", x, x).reshape(len(x), -1)
    out = batch[keys].iloc[order[starts]].reset_index(drop=True)
    out["part"] = list(np.add.reduceat(products, starts, axis=0))
    return out


def solve_ridge(flat: np.ndarray, n_features: int, ridge: float) -> np.ndarray:
    """Coefficients (intercept first) of one ridge regression per row of product sums.

    Features are standardised within the sums, a feature without variance gets coefficient 0.
    """
    size = n_features + 2
    full = flat.reshape(len(flat), size, size)
    n = full[:, 0, 0]
    mean = full[:, 0, 1:] / n[:, None]
    cov = full[:, 1:, 1:] / n[:, None, None] - mean[:, :, None] * mean[:, None, :]
    var = np.einsum("kii->ki", cov)[:, :-1]
    scale = np.sqrt(np.clip(var, 0.0, None))
    flatline = scale <= 1e-9 * (1.0 + np.abs(mean[:, :-1]))
    safe = np.where(flatline, 1.0, scale)
    a = cov[:, :-1, :-1] / (safe[:, :, None] * safe[:, None, :])
    b = np.where(flatline, 0.0, cov[:, :-1, -1] / safe)
    a[flatline[:, :, None] | flatline[:, None, :]] = 0.0
    a += np.eye(n_features) * (ridge + flatline[:, :, None])
    beta = np.linalg.solve(a, b[:, :, None])[:, :, 0] / safe
    intercept = mean[:, -1] - (beta * mean[:, :-1]).sum(axis=1)
    return np.concatenate([intercept[:, None], beta], axis=1)


def batch_reducer(keys: list[str], names: list[str], weight: str | None = None) -> Callable:
    """Function for ``mapInPandas`` that reduces every batch to one matrix per key."""
    step = max(1, PRODUCTS_AT_ONCE // (len(names) + 1) ** 2)

    def reduce_batches(batches):
        for batch in batches:
            for start in range(0, len(batch), step):
                yield sum_products(batch.iloc[start:start + step], keys, names, weight)
    return reduce_batches


def ridge_solver(n_features: int, ridge: float) -> Callable:
    """Series function that solves one ridge regression per array of product sums."""
    def solve(flat: pd.Series) -> pd.Series:
        if flat.empty:
            return pd.Series([], dtype=object)
        return pd.Series(list(solve_ridge(np.stack(flat.to_numpy()), n_features, ridge)))
    return solve


cloudpickle.register_pickle_by_value(sys.modules[__name__])
