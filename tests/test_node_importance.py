"""Split importance from saved node rows equals Spark's own importances."""

import uuid

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler

from panelweave.lineage import scratch_folder
from panelweave.models.fit import tree_model
from panelweave.operators.explain import node_importance


def test_node_rows_give_sparks_importances_folded_by_column(spark):
    rng = np.random.default_rng(9)
    rows = []
    for a, b, c in rng.normal(size=(400, 3)):
        kind = int(rng.integers(0, 3))
        rows.append((float(a), float(b), float(kind == 1), float(kind == 2), float(3 * a - b + 2 * (kind == 2) + 0.1 * c)))
    names = ["a", "b", "kind=x", "kind=y"]
    df = VectorAssembler(inputCols=["a", "b", "k1", "k2"], outputCol="features").transform(
        spark.createDataFrame(rows, "a double, b double, k1 double, k2 double, y double")
    )
    model = tree_model("y", n_estimators=5, max_depth=3).fit(df)
    path = f"{scratch_folder(spark)}/{uuid.uuid4().hex}"
    model.write().save(path)
    got = {r.feature: r.importance for r in node_importance(spark, path, names).collect()}
    own = model.featureImportances.toArray()
    assert got["a"] == pytest.approx(own[0]) and got["b"] == pytest.approx(own[1])
    assert got["kind"] == pytest.approx(own[2] + own[3])
    assert sum(got.values()) == pytest.approx(1.0)
