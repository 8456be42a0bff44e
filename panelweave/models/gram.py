"""Linear and ridge regression over expanding time folds, from Gram matrices of time blocks.

For z = (1, x_1..x_p, y) the matrix sum(z z') over a set of rows holds all that
least squares needs: the normal equations of a fit on a set, and the squared
error and total square of predictions on another set. So the rows are read in
one aggregate that sums z z' per period; fold k trains on the blocks before k
and tests on block k, and both are sums of these small matrices. Every setting
of every fold is then a (p+1) x (p+1) solve on the driver, whatever the number
of rows.

Folds are those of `encode.time_folds`: under the order (period, within), the
last `n_splits` blocks hold `n // (n_splits + 1)` rows each. A period in which
a cut falls is read a second time, alone, and its rows are numbered by a range
sort, so the blocks are exact without a window over a period. At most
`n_splits` periods are read twice.

Settings: `fit_intercept` and `reg` (lambda), minimising
`mean((y - b0 - x'b)^2) + reg * |b|^2`; the intercept is not penalised. A
singular system takes the least-norm solution. Rows with a missing or NaN
feature or label are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.operators.ordering import with_row_index

# fixed values: the searched settings of the linear family
RIDGE_GRID = [{"fit_intercept": fit, "reg": reg} for fit in (True, False) for reg in (0.0, 0.1, 1.0)]


def _products(columns: Sequence[str]) -> list:
    z = [F.lit(1.0)] + [F.col(c).cast("double") for c in columns]
    return [F.sum(z[i] * z[j]).alias(f"_g{i}_{j}") for i in range(len(z)) for j in range(i, len(z))]


def _matrix(row, size: int) -> np.ndarray:
    g = np.zeros((size, size))
    for i in range(size):
        for j in range(i, size):
            g[i, j] = g[j, i] = row[f"_g{i}_{j}"] or 0.0
    return g


def solve(train: np.ndarray, fit_intercept: bool, reg: float) -> np.ndarray:
    """Coefficients (b0, b_1..b_p) from the Gram matrix of (1, x, y) on the training rows."""
    n, p = train[0, 0], train.shape[0] - 2
    if n == 0:
        return np.zeros(p + 1)
    xx, xy = train[: p + 1, : p + 1], train[: p + 1, p + 1]
    keep = np.arange(p + 1) if fit_intercept else np.arange(1, p + 1)
    a = xx[np.ix_(keep, keep)] + n * reg * np.diag([0.0 if (i == 0) else 1.0 for i in keep])
    b = np.linalg.lstsq(a, xy[keep], rcond=None)[0]
    out = np.zeros(p + 1)
    out[keep] = b
    return out


def r2(test: np.ndarray, coef: np.ndarray) -> float:
    """R2 of the coefficients on the rows of a Gram matrix."""
    p = test.shape[0] - 2
    n, sy, yy = test[0, 0], test[0, p + 1], test[p + 1, p + 1]
    xx, xy = test[: p + 1, : p + 1], test[: p + 1, p + 1]
    sse = yy - 2 * coef @ xy + coef @ xx @ coef
    sst = yy - sy * sy / n if n else 0.0
    return float(1 - sse / sst) if sst > 0 else float("nan")


def block_grams(
    df: DataFrame, features: Sequence[str], label: str, period: str, within: str, n_splits: int
) -> tuple[list[np.ndarray], int]:
    """Gram matrices of blocks 0..n_splits and the number of rows of a test block."""
    columns = [*features, label]
    valid = F.lit(True)
    for c in columns:
        valid = valid & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    rows = df.select(period, within, *columns).filter(valid)
    size = len(columns) + 1
    per_period = sorted(rows.groupBy(period).agg(*_products(columns)).collect(), key=lambda r: r[period])
    grams = {r[period]: _matrix(r, size) for r in per_period}
    n = int(sum(g[0, 0] for g in grams.values()))
    step = n // (n_splits + 1)
    if step == 0:
        raise ValueError(f"{n} rows cannot be cut into {n_splits} folds")
    cuts = [n - n_splits * step + k * step for k in range(n_splits)]
    blocks = [np.zeros((size, size)) for _ in range(n_splits + 1)]
    below, split = 0, []
    for r in per_period:
        count = int(grams[r[period]][0, 0])
        first = sum(below >= c for c in cuts)
        last = sum(below + count - 1 >= c for c in cuts)
        if first == last:
            blocks[first] += grams[r[period]]
        else:
            split.append((r[period], below))
        below += count
    if split:
        keys = [k for k, _ in split]
        cut_rows = with_row_index(rows.filter(F.col(period).isin(keys)), [period, within], "_at")
        offset, start = 0, F.lit(None)
        for key, before in split:
            start = F.when(F.col(period) == key, F.lit(before - offset)).otherwise(start)
            offset += int(grams[key][0, 0])
        position = start + F.col("_at")
        block = sum(((position >= c).cast("int") for c in cuts), F.lit(0))
        for r in cut_rows.groupBy(block.alias("_block")).agg(*_products(columns)).collect():
            blocks[r["_block"]] += _matrix(r, size)
    return blocks, step


def gram_search(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    period: str,
    within: str,
    n_splits: int = 3,
    grid: Sequence[dict] = RIDGE_GRID,
) -> list[dict]:
    """R2 of every setting on every fold, its mean, and the best setting (first of equal means).

    Returns one dict per (setting, fold): setting (place in the grid),
    fit_intercept, reg, fold, n_train, n_test, r2, mean_r2, best.
    """
    blocks, step = block_grams(df, features, label, period, within, n_splits)
    trains = np.cumsum(np.stack(blocks), axis=0)
    out, means = [], []
    for s, params in enumerate(grid):
        scores = []
        for k in range(1, n_splits + 1):
            coef = solve(trains[k - 1], params["fit_intercept"], params["reg"])
            scores.append(r2(blocks[k], coef))
            out.append({"setting": s, **params, "fold": k, "n_train": int(trains[k - 1][0, 0]), "n_test": step, "r2": scores[-1]})
        means.append(float(np.mean(scores)))
    best = int(np.nanargmax(means)) if not np.all(np.isnan(means)) else 0
    for row in out:
        row["mean_r2"] = means[row["setting"]]
        row["best"] = row["setting"] == best
    return out
