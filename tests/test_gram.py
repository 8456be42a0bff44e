"""Search from Gram matrices against least squares on the rows of each fold."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelweave.models import gram
from panelweave.operators.encode import time_folds


def brute(rows, features, fit_intercept, reg, train, test):
    x = np.array([[r[c] for c in features] for r in rows], float)
    y = np.array([r["y"] for r in rows], float)
    xt, yt = x[train], y[train]
    if fit_intercept:
        mx, my = xt.mean(0), yt.mean()
        cov = (xt - mx).T @ (xt - mx) / len(yt) + reg * np.eye(x.shape[1])
        b = np.linalg.solve(cov, (xt - mx).T @ (yt - my) / len(yt))
        b0 = my - mx @ b
    else:
        b = np.linalg.solve(xt.T @ xt / len(yt) + reg * np.eye(x.shape[1]), xt.T @ yt / len(yt))
        b0 = 0.0
    pred = b0 + x[test] @ b
    return 1 - ((y[test] - pred) ** 2).sum() / ((y[test] - y[test].mean()) ** 2).sum()


@pytest.mark.parametrize("periods", [7, 40])
def test_gram_search_equals_least_squares_per_fold(spark, periods):
    rng = np.random.default_rng(periods)
    data = []
    for i in range(503):
        a, b, c = rng.normal(size=3)
        missing = i % 97 == 0
        data.append((int(rng.integers(0, periods)), i, float(a), None if missing else float(b), float(c), float(2 * a - b + 0.5 * c + rng.normal())))
    df = spark.createDataFrame(data, "day int, user_id int, a double, b double, c double, y double").repartition(3)
    features = ["a", "b", "c"]
    found = gram.gram_search(df, features, "y", "day", "user_id", 3)
    kept = df.dropna()
    folded = sorted(time_folds(kept, ["day", "user_id"], 3, "fold").collect(), key=lambda r: (r.day, r.user_id))
    fold = np.array([r.fold for r in folded])
    for row in found:
        k = row["fold"]
        want = brute(folded, features, row["fit_intercept"], row["reg"], fold < k, fold == k)
        assert row["r2"] == pytest.approx(want, abs=1e-9)
        assert row["n_train"] == (fold < k).sum() and row["n_test"] == (fold == k).sum()
    means = {r["setting"]: r["mean_r2"] for r in found}
    assert [r["setting"] for r in found if r["best"]][0] == max(means, key=lambda s: (means[s], -s))


def test_singular_features_take_the_least_norm_solution(spark):
    rows = [(d, u, 1.0, float(u), float(u) * 2 + 1) for d in range(6) for u in range(10)]
    df = spark.createDataFrame(rows, "day int, user_id int, k double, x double, y double")
    found = gram.gram_search(df, ["k", "x"], "y", "day", "user_id", 2)
    assert all(r["r2"] == pytest.approx(1.0) for r in found if r["fit_intercept"] and r["reg"] == 0.0)


def test_too_few_rows(spark):
    df = spark.createDataFrame([(1, 1, 1.0, 1.0)], "day int, user_id int, x double, y double")
    with pytest.raises(ValueError):
        gram.gram_search(df, ["x"], "y", "day", "user_id", 3)
