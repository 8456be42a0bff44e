import math
import random

from conftest import rows
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

import pytest

from panelweave import models, sources
from panelweave.models.fit import stop_iteration
from panelweave.operators import encode, explain, metrics


def test_labels_sort_numbers_as_numbers(spark):
    train = spark.createDataFrame([(10, "b"), (2, "a"), (2, None)], "id int, c string")
    score = spark.createDataFrame([(2, "zz"), (10, "b"), (7, "a")], "id int, c string")
    ids, texts = encode.fit_labels(train, "id", "ic"), encode.fit_labels(train, "c", "cc")
    got = encode.apply_labels(encode.apply_labels(score, ids, "id", "ic"), texts, "c", "cc", -1)
    assert rows(got, "id", "ic", "cc") == [(2, 0, -1), (7, None, 0), (10, 1, 1)]


def test_scale_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(v, 5.0) for v in (1.0, 2.0, 4.0, 10.0)], "x double, k double")
    stats = encode.fit_scale(df, ["x", "k"])
    assert stats["x"] == pytest.approx((4.25, math.sqrt(12.1875)))
    assert rows(encode.apply_scale(df, stats), "k") == [(0.0,)] * 4
    assert encode.fit_medians(df, ["x"]) == {"x": 3.0}


def test_indicators_drop_the_first_and_ignore_unknown(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",)], "c string")
    cats = encode.fit_categories(train, ["c"])
    score = spark.createDataFrame([("a",), ("c",), ("zz",), (None,)], "c string")
    got = score.withColumns(encode.one_hot_columns(cats))
    assert rows(got, "c", "c_b", "c_c") == [
        (None, 0.0, 0.0), ("a", 0.0, 0.0), ("c", 0.0, 1.0), ("zz", 0.0, 0.0),
    ]


def test_metrics(spark):
    data = [(1.0, 2.0), (2.0, 2.0), (2.0, 3.0), (5.0, 3.0), (4.0, 9.0)]
    got = metrics.evaluate(spark.createDataFrame(data, "y double, p double"), "y", "p").first()
    ys, ps = [d[0] for d in data], [d[1] for d in data]
    n = len(data)
    mse = sum((y - p) ** 2 for y, p in data) / n
    mean = sum(ys) / n
    assert got["mae"] == pytest.approx(sum(abs(y - p) for y, p in data) / n)
    assert (got["mse"], got["rmse"]) == pytest.approx((mse, math.sqrt(mse)))
    assert got["r2"] == pytest.approx(1 - mse * n / sum((y - mean) ** 2 for y in ys))

    def ranks(v):
        return [sum(u < x for u in v) + (sum(u == x for u in v) + 1) / 2 for x in v]

    a, b = ranks(ys), ranks(ps)
    cov = sum((x - 3) * (z - 3) for x, z in zip(a, b))
    den = math.sqrt(sum((x - 3) ** 2 for x in a) * sum((z - 3) ** 2 for z in b))
    assert got["spearman"] == pytest.approx(cov / den)


def test_metrics_of_constant_predictions(spark):
    df = spark.createDataFrame([(1.0, 1.0, 3.0), (2.0, 2.0, 3.0)], "y double, same double, k double")
    assert metrics.metrics_r2(df, "y", "same").first()["r2"] == 1.0
    assert metrics.metrics_spearman(df, "y", "k").first()["spearman"] is None
    assert metrics.metrics_r2(df, "k", "k").first()["r2"] == 1.0


def line(spark, n=400):
    rng = random.Random(4)
    data = []
    for i in range(n):
        x, z, c = rng.uniform(-5, 5), rng.uniform(0, 1), rng.choice("abc")
        data.append((i, x if rng.random() > 0.05 else None, z, c, 0.0))
    df = spark.createDataFrame(data, "t int, x double, z double, c string, k double")
    y = F.coalesce("x", F.lit(0.0)) * 2 - F.col("z") * 3 + F.when(F.col("c") == "b", 4).otherwise(1)
    return df.withColumn("y", y)


def stage():
    return models.PanelFeatures(numericCols=["x", "z", "k"], textCols=["c"])


def test_pipeline_roundtrip(spark, tmp_path):
    df = line(spark)
    model = Pipeline(stages=[stage(), models.linear_model("y")]).fit(df)
    assert model.stages[0].feature_names() == ["x", "z", "k", "c=b", "c=c"]
    sources.save_model(model, str(tmp_path), "lr")
    again = sources.load_model(str(tmp_path), "lr")
    keep = ["t", "y"]
    a = rows(models.batch_score(model, df, keep), "t", "prediction")
    assert a == rows(models.batch_score(again, df, keep), "t", "prediction")
    known = models.batch_score(model, df.filter("x is not null"), keep)
    assert metrics.metrics_r2(known, "y", "prediction").first()["r2"] > 0.99


def test_search_prefers_the_better_setting(spark):
    grid = models.expand_grid({"fit_intercept": [False, True]})
    found = models.search(line(spark, 120), stage(), models.linear_model, grid, "y", ["t"])
    assert found.params == {"fit_intercept": True} and found.score > 0.9
    assert len(found.scores) == 2 and len(found.scores[0][2]) == 3


def test_patience_rule():
    assert stop_iteration([5, 4, 3, 3.5, 3.2, 2.0], patience=2) == (2, 4)
    assert stop_iteration([5, 4, 3, 3.5, 3.2, 2.0], patience=3) == (5, 5)
    assert stop_iteration([1.0], patience=1) == (0, 0)


def test_early_stopping_keeps_the_best_iteration(spark):
    model, history = models.fit_with_patience(
        line(spark, 150), stage(), "y", ["t"], patience=2, n_estimators=6, max_depth=2
    )
    losses = [r["validation_loss"] for r in history.orderBy("iteration").collect()]
    assert model.stages[-1].getNumTrees == losses.index(min(losses)) + 1


def test_permutation_does_not_depend_on_partitions(spark):
    df = spark.range(500).selectExpr("id", "id * 1.5D as a")
    one, many = (rows(explain.permute(df.repartition(n), ["id"], ["a"], 3), "id", "perm_a") for n in (1, 8))
    assert one == many


def test_permutation_is_a_bijection_and_finds_the_feature(spark):
    df = spark.range(600).selectExpr("id", "rand(1) as a", "rand(2) as b")
    df = df.withColumn("y", F.col("a") * 4).withColumn("p", F.col("a") * 4 + F.col("b") * 0)
    both = explain.permute(df, ["id"], ["a", "b"], 3)
    assert sorted(r["a"] for r in both.collect()) == sorted(r["perm_a"] for r in both.collect())
    assert both.filter("a <> perm_a").count() > 550
    linear = explain.permutation_importance_linear(df, {"a": 4.0, "b": 0.0}, "y", "p", ["id"], 3)

    def score(rows_):
        return rows_.withColumn("prediction", F.col("a") * 4)

    anymodel = explain.permutation_importance(df, score, ["a", "b"], "y", ["id"], 3)
    x = {r["feature"]: r["importance"] for r in linear.collect()}
    z = {r["feature"]: r["importance"] for r in anymodel.collect()}
    assert x["a"] > 1 and x["b"] == pytest.approx(0)
    assert z == pytest.approx(x)


def test_attribution_adds_up(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 3.0, 1.0)], "id int, a double, b double")
    cells = explain.linear_attribution(df, {"a": 2.0, "b": -1.0}, ["id"])
    total = cells.groupBy("id").agg(F.sum("attribution").alias("s"))
    assert rows(total, "id", "s") == [(1, -4.0), (2, 4.0)]
    assert rows(explain.attribution_ranking(cells), "feature", "importance") == [("a", 2.0), ("b", 2.0)]


def test_twenty_thousand_categories(spark):
    df = spark.range(20_000).selectExpr("'c' || id AS c", "id % 7 * 1.0D AS x", "id % 3 * 1.0D AS y")
    assert len(encode.fit_categories(df, ["c"])["c"]) == 20_000
    small = spark.range(600).selectExpr("'c' || id AS c", "id % 2 * 1.0D AS x")
    model = models.PanelFeatures(numericCols=["x"], textCols=["c"]).fit(small)
    vectors = [r["features"] for r in model.transform(small.limit(3)).collect()]
    assert all(v.size == 600 for v in vectors) and len(model.feature_names()) == 600
    unknown = model.transform(small.limit(1).selectExpr("'other' AS c", "x")).first()["features"]
    assert max(unknown[1:]) < 0
