"""Regressors and their selection by expanding-window validation."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import SparkContext, StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.lineage import ensure_checkpoint_dir
from panelweave.operators.encode import ordered_split, time_folds
from panelweave.operators.metrics import r2_column

FOLDS_AT_ONCE = 3
# fixed values: searched settings of the two regressors
LINEAR_GRID = {"fit_intercept": [True, False]}
TREE_GRID = {
    "n_estimators": [100, 500],
    "max_depth": [3, 5],
    "learning_rate": [0.05, 0.1],
    "gamma": [0.0, 0.1],
}


def linear_model(label: str, fit_intercept: bool = True) -> LinearRegression:
    """Ordinary least squares."""
    return LinearRegression(
        labelCol=label, fitIntercept=fit_intercept, regParam=0.0, solver="auto"
    )


def tree_model(
    label: str,
    n_estimators: int = 100,
    max_depth: int = 3,
    learning_rate: float = 0.1,
    gamma: float = 0.0,
    seed: int = 7,
) -> GBTRegressor:
    """Boosted trees. `gamma` is the least gain of a split, on Spark's own scale."""
    return GBTRegressor(
        labelCol=label,
        maxIter=n_estimators,
        maxDepth=max_depth,
        stepSize=learning_rate,
        minInfoGain=gamma,
        seed=seed,
    )


def expand_grid(grid: Mapping[str, Sequence]) -> list[dict]:
    """All combinations, the last setting varying fastest."""
    return [dict(zip(grid, values)) for values in product(*grid.values())]


@dataclass
class Fitted:
    """Result of a search: `scores` holds (params, mean R2, R2 per fold)."""

    model: PipelineModel | None
    params: dict
    score: float
    scores: list[tuple[dict, float, list[float]]] = field(default_factory=list)


def search(
    df: DataFrame,
    features: Estimator,
    build: Callable[..., Estimator],
    grid: Sequence[dict],
    label: str,
    order: Sequence[str | Column],
    n_splits: int = 3,
    parallelism: int = 4,
) -> Fitted:
    """Best setting by mean R2 over expanding time folds, refitted on all rows."""
    families = {"model": (build, grid)}
    return search_families(df, features, families, label, order, n_splits, parallelism)["model"]


def shared_fits(tasks: Sequence[tuple]) -> list[tuple]:
    """Fits that serve several settings: (build, params, [(task, trees or None)]).

    Settings of a kind that differ only in `n_estimators` share the fit with the
    most trees; each is scored on the first trees of that ensemble, which is
    the ensemble a fit of its own would give (`boosted_prefix`). A model that
    is not a boosted ensemble is fitted for each setting.
    """
    groups: dict = {}
    for i, (name, build, params) in enumerate(tasks):
        rest = tuple(sorted((k, repr(v)) for k, v in params.items() if k != "n_estimators"))
        key = (name, rest) if "n_estimators" in params else (name, i)
        groups.setdefault(key, []).append(i)
    units = []
    for members in groups.values():
        _, build, params = tasks[members[0]]
        if "n_estimators" in params:
            most = max(tasks[i][2]["n_estimators"] for i in members)
            units.append((build, {**params, "n_estimators": most}, [(i, tasks[i][2]["n_estimators"]) for i in members]))
        else:
            units.append((build, params, [(members[0], None)]))
    return units


def search_families(
    df: DataFrame,
    features: Estimator,
    families: Mapping[str, tuple[Callable[..., Estimator], Sequence[dict]]],
    label: str,
    order: Sequence[str | Column],
    n_splits: int = 3,
    parallelism: int = 4,
) -> dict[str, Fitted]:
    """`search` for several kinds of models over the same folds.

    The preprocessing depends neither on the kind nor on the searched settings:
    it is fitted once per fold on the fold's training rows, and the prepared
    rows are kept while all settings are fitted on them. `FOLDS_AT_ONCE` folds are
    worked on together, so as many are kept at a time. Boosted settings that
    differ only in their number of trees share one fit (`shared_fits`). Within
    a kind the first of equal scores wins.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    tasks = [
        (name, build, params) for name, (build, grid) in families.items() for params in grid
    ]

    def on_pool(fn: Callable, items: Sequence, size: int = parallelism) -> list:
        with ThreadPool(max(1, min(size, len(items)))) as pool:
            return pool.map(inheritable_thread_target(spark)(fn), items, chunksize=1)

    units = shared_fits(tasks)
    folded = time_folds(df, order, n_splits, "_fold")

    def fold(k: int) -> list[float]:
        seen = folded.filter(F.col("_fold") <= k)
        stage = features.fit(seen.filter(F.col("_fold") < k))
        prepared = (
            stage.transform(seen)
            .select(label, stage.getOutputCol(), "_fold")
            .persist(StorageLevel.MEMORY_AND_DISK)
        )
        train, test = prepared.filter(F.col("_fold") < k), prepared.filter(F.col("_fold") == k)

        def score(unit: tuple) -> list[tuple[int, float]]:
            build, params, members = unit
            model = build(label, **params).fit(train)
            shared = isinstance(model, GBTRegressionModel)
            out = []
            for i, trees in members:
                if trees is None or trees == params.get("n_estimators"):
                    fitted = model
                elif shared:
                    fitted = boosted_prefix(model, trees)
                else:
                    fitted = build(label, **{**params, "n_estimators": trees}).fit(train)
                scored = fitted.transform(test)
                out.append((i, scored.agg(r2_column(label, "prediction").alias("r2")).first()["r2"]))
            return out

        values: list = [None] * len(tasks)
        for found in on_pool(score, units):
            for i, value in found:
                values[i] = value
        prepared.unpersist()
        return values

    per_fold = on_pool(fold, range(1, n_splits + 1), FOLDS_AT_ONCE)

    best: dict[str, Fitted] = {}
    for i, (name, _, params) in enumerate(tasks):
        values = [fold[i] for fold in per_fold]
        mean = sum(values) / n_splits
        if name not in best:
            best[name] = Fitted(None, params, mean)
        best[name].scores.append((params, mean, values))
        if mean > best[name].score:
            best[name].params, best[name].score = params, mean

    stage = features.fit(df)
    prepared = (
        stage.transform(df)
        .select(label, stage.getOutputCol())
        .persist(StorageLevel.MEMORY_AND_DISK)
    )

    def refit(name: str) -> PipelineModel:
        model = families[name][0](label, **best[name].params).fit(prepared)
        return PipelineModel([stage, model])

    for name, model in zip(families, on_pool(refit, list(families))):
        best[name].model = model
    prepared.unpersist()
    return best


def stop_iteration(losses: Sequence[float], patience: int) -> tuple[int, int]:
    """(best, last) 0-based iterations when training stops after `patience`
    iterations without a lower loss."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            return best, i
    return best, len(losses) - 1


def boosted_prefix(model: GBTRegressionModel, k: int) -> GBTRegressionModel:
    """The first k trees of a fitted ensemble with their weights.

    Boosting is sequential and seeded, so this is the model a fit of k
    iterations gives, without fitting again.
    """
    java = model._java_obj
    if not 1 <= k <= java.getNumTrees():
        raise ValueError(f"{k} trees of {java.getNumTrees()}")
    context = SparkContext._active_spark_context
    gateway, jvm = context._gateway, context._jvm
    regression = jvm.org.apache.spark.ml.regression
    trees, weights = java.trees(), java.treeWeights()
    kept = gateway.new_array(regression.DecisionTreeRegressionModel, k)
    kept_weights = gateway.new_array(gateway.jvm.double, k)
    for i in range(k):
        kept[i] = trees[i]
        kept_weights[i] = weights[i]
    cut = GBTRegressionModel(regression.GBTRegressionModel(java.uid(), kept, kept_weights, java.numFeatures()))
    return cut.setFeaturesCol(model.getFeaturesCol()).setPredictionCol(model.getPredictionCol())


def fit_with_patience(
    df: DataFrame,
    features: Estimator | None,
    label: str,
    order: Sequence[str | Column],
    holdout: float = 0.2,
    patience: int = 10,
    **settings,
) -> tuple[PipelineModel, DataFrame]:
    """Boosted trees stopped on the loss of the last part of the rows.

    Returns the model of the best iteration and the table (iteration,
    train_loss, validation_loss) up to the stop. Boosting is sequential and
    seeded, so the first iterations of a long run are the short run: the
    model is cut from the one fit (`boosted_prefix`). Without `features` the
    rows already have a feature vector.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    split = ordered_split(df, order, 1.0 - holdout, "_in_train")
    stages = [features.fit(split.filter("_in_train"))] if features is not None else []
    prepared = (
        PipelineModel(stages)
        .transform(split)
        .select(label, "features", "_in_train")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    train, held = prepared.filter("_in_train"), prepared.filter("NOT _in_train")
    model = tree_model(label, **settings).fit(train)
    train_loss = model.evaluateEachIteration(train, "squared")
    held_loss = model.evaluateEachIteration(held, "squared")
    best, last = stop_iteration(held_loss, patience)
    if best + 1 < len(held_loss):
        model = boosted_prefix(model, best + 1)
    prepared.unpersist()
    rows = [(i + 1, float(train_loss[i]), float(held_loss[i])) for i in range(last + 1)]
    # one row per boosting iteration
    history = spark.createDataFrame(
        rows, "iteration int, train_loss double, validation_loss double"
    )
    return PipelineModel([*stages, model]), history
