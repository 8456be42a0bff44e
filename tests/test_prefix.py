"""A boosted ensemble cut to its first trees predicts as a fit of that many iterations."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler

from panelweave.models.fit import boosted_prefix, tree_model


def test_prefix_equals_a_shorter_fit(spark):
    rng = np.random.default_rng(2)
    rows = [(float(a), float(b), float(a * 2 - b + rng.normal() * 0.1)) for a, b in rng.normal(size=(300, 2))]
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(
        spark.createDataFrame(rows, "a double, b double, y double")
    )
    long = tree_model("y", n_estimators=6, max_depth=3).fit(df)
    short = tree_model("y", n_estimators=3, max_depth=3).fit(df)
    cut = boosted_prefix(long, 3)
    assert cut.getNumTrees == 3
    got = [r.prediction for r in cut.transform(df).select("prediction").collect()]
    want = [r.prediction for r in short.transform(df).select("prediction").collect()]
    assert got == pytest.approx(want, abs=1e-9)
    assert boosted_prefix(long, 6).transform(df).first().prediction == pytest.approx(long.transform(df).first().prediction)
    with pytest.raises(ValueError):
        boosted_prefix(long, 7)


def test_shared_fits_group_by_all_but_the_number_of_trees():
    from panelweave.models.fit import expand_grid, linear_model, shared_fits

    grid = expand_grid({"n_estimators": [100, 500], "max_depth": [3, 5], "learning_rate": [0.05, 0.1], "gamma": [0.0, 0.1]})
    tasks = [("tree", tree_model, p) for p in grid] + [("linear", linear_model, {"fit_intercept": True})]
    units = shared_fits(tasks)
    assert len(grid) == 16 and len(units) == 9  # 16 tree settings cost 8 fits
    assert all(u[1].get("n_estimators", 500) == 500 for u in units)
    assert sorted(i for u in units for i, _ in u[2]) == list(range(len(tasks)))
    assert [u[2] for u in shared_fits(tasks[-1:] * 2)] == [[(0, None)], [(1, None)]]


def test_shared_search_scores_equal_separate_fits(spark):
    from panelweave.models import PanelFeatures
    from panelweave.models.fit import search

    rng = np.random.default_rng(4)
    rows = [(t, float(a), float(b), float(a - b + rng.normal() * 0.3)) for t, (a, b) in enumerate(rng.normal(size=(240, 2)))]
    df = spark.createDataFrame(rows, "t int, a double, b double, y double")
    stage = PanelFeatures(numericCols=["a", "b"])
    build = lambda label, **p: tree_model(label, max_depth=2, **p)
    together = search(df, stage, build, [{"n_estimators": 2}, {"n_estimators": 4}], "y", ["t"], 2)
    alone = search(df, stage, build, [{"n_estimators": 2}], "y", ["t"], 2)
    assert together.scores[0][2] == pytest.approx(alone.scores[0][2], abs=1e-9)
