"""What a fitted model relies on."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelweave.operators.ordering import with_row_index

def permute(
    df: DataFrame, key: Sequence[str], columns: Sequence[str], seed: int, prefix: str = "perm_"
) -> DataFrame:
    """Add shuffled copies of `columns`: each row gets the values of another row.

    The rows are put in the random but reproducible order of
    `md5(key parts joined by '|' | seed)` and every row takes the values of its
    successor, the last one those of the first. The order is one range sort over
    the whole table at every size; the successor is found by its position, so no
    task holds more than its range. Whole sequences move together when a column
    is an array.
    """
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed)))
    hashed = df.withColumn("_h", F.md5(text.cast("binary")))
    placed = with_row_index(hashed, ["_h", *key], "_at").drop("_h")
    total = placed.agg(F.count(F.lit(1)).alias("_n"))  # one row
    following = placed.join(F.broadcast(total)).select(
        F.pmod(F.col("_at") - 1, F.col("_n")).alias("_at"),
        *[F.col(c).alias(f"{prefix}{c}") for c in columns],
    )
    return placed.join(following, "_at").select(*df.columns, *[f"{prefix}{c}" for c in columns])


def permutation_importance_linear(
    df: DataFrame, coefficients: Mapping[str, float], y: str, p: str, key: Sequence[str], seed: int
) -> DataFrame:
    """Increase of the squared error when one feature is shuffled, linear model.

    A linear prediction changes by coefficient * (shuffled - own value), so all
    features are measured in one aggregate over one shuffled copy.
    """
    features = list(coefficients)
    both = permute(df, key, features, seed)
    base = F.col(y) - F.col(p)
    measured = both.agg(
        F.avg(base * base).alias("_base"),
        *[
            F.avg(
                F.pow(base - F.lit(b) * (F.col(f"perm_{f}") - F.col(f)), F.lit(2))
            ).alias(f"_e_{i}")
            for i, (f, b) in enumerate(coefficients.items())
        ],
    )
    cells = F.array(
        *[
            F.struct(F.lit(f).alias("feature"), (F.col(f"_e_{i}") - F.col("_base")).alias("importance"))
            for i, f in enumerate(features)
        ]
    )
    return measured.select(F.explode(cells).alias("_c")).select("_c.*")


def permutation_importance(
    df: DataFrame, score, features: Sequence[str], y: str, key: Sequence[str], seed: int
) -> DataFrame:
    """Increase of the squared error when one feature is shuffled, any model.

    `score` maps a DataFrame with the feature columns to one that also has a
    `prediction` column. Every row is scored once per feature, with the feature
    name as a column, in one distributed pass: no loop over features.
    """
    both = permute(df, key, features, seed)
    versions = F.explode(
        F.array(F.lit(None).cast("string"), *[F.lit(f) for f in features])
    ).alias("_shuffled")
    long = both.select("*", versions)
    long = long.withColumns(
        {
            f: F.when(F.col("_shuffled") == f, F.col(f"perm_{f}")).otherwise(F.col(f))
            for f in features
        }
    )
    err = F.col(y) - F.col("prediction")
    errors = score(long).groupBy("_shuffled").agg(F.avg(err * err).alias("_mse"))
    # one row per feature
    base = errors.filter(F.col("_shuffled").isNull()).select(F.col("_mse").alias("_base"))
    return (
        errors.filter(F.col("_shuffled").isNotNull())
        .join(F.broadcast(base))
        .select(
            F.col("_shuffled").alias("feature"),
            (F.col("_mse") - F.col("_base")).alias("importance"),
        )
    )


def linear_attribution(
    df: DataFrame, coefficients: Mapping[str, float], keys: Sequence[str]
) -> DataFrame:
    """Additive attribution `coefficient * (x - mean(x))`, long: key, feature, value."""
    from panelweave.operators.encode import fit_scale

    means = {f: m for f, (m, _) in fit_scale(df, list(coefficients)).items()}
    cells = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(f).alias("feature"),
                    (F.lit(b) * (F.col(f) - F.lit(means[f]))).alias("attribution"),
                )
                for f, b in coefficients.items()
            ]
        )
    )
    return df.select(*keys, cells.alias("_c")).select(*keys, "_c.*")


def attribution_ranking(attributions: DataFrame) -> DataFrame:
    """Mean absolute attribution per feature."""
    return attributions.groupBy("feature").agg(F.avg(F.abs("attribution")).alias("importance"))


def split_importance(spark, names: Sequence[str], importances: Sequence[float]) -> DataFrame:
    """Split importance of a fitted tree model as a table (one row per feature)."""
    rows = [(n, float(v)) for n, v in zip(names, importances)]
    return spark.createDataFrame(rows, "feature string, importance double")


def node_importance(spark, model_path: str, names: Sequence[str]) -> DataFrame:
    """Split importance of a saved tree ensemble, from its node rows; one row per source column.

    Every split node adds its gain times the rows that reached it (the first
    impurity statistic) to its feature; the sums are normalised to 1, the rule
    of Spark's boosted trees, which do not normalise tree by tree. Features
    named `column=value` (indicators) are summed into their column. Columns
    that no split uses get 0. Reads `model_path/data`, written by
    `model.write().save(model_path)` of an ensemble (rows of treeID, nodeData).
    """
    nodes = spark.read.parquet(f"{model_path}/data").select("nodeData.*")
    gains = (
        nodes.filter(F.col("leftChild") >= 0)
        .groupBy(F.col("split.featureIndex").alias("index"))
        .agg(F.sum(F.col("gain") * F.col("impurityStats")[0]).alias("gain"))
    )
    features = spark.createDataFrame(list(enumerate(names)), "index int, feature string")
    sources = features.withColumn("feature", F.split("feature", "=", 2)[0])
    # one row per feature of the model: bounded by its width
    summed = F.broadcast(sources).join(gains, "index", "left").groupBy("feature").agg(
        F.coalesce(F.sum("gain"), F.lit(0.0)).alias("gain")
    )
    total = summed.agg(F.sum("gain").alias("total"))
    return summed.crossJoin(total).select(
        "feature", F.when(F.col("total") > 0, F.col("gain") / F.col("total")).otherwise(F.lit(0.0)).alias("importance")
    )


def top_k(df: DataFrame, score: str, k: int, ties: Sequence[str | Column] = ()) -> DataFrame:
    """The k rows with the largest score."""
    return df.orderBy(F.col(score).desc(), *ties).limit(k)
