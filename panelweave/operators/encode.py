"""Encoders with fitted state, and time-ordered splits.

Fit on the training rows, apply to training and scoring rows alike.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.operators.ordering import exact_medians, value_counts_below, with_row_index


def target_means(
    df: DataFrame, keys: Sequence[str], target: str, name: str
) -> DataFrame:
    """Mean target per key: the table to join back."""
    return df.groupBy(*keys).agg(F.avg(target).alias(name))


def target_encode(df: DataFrame, keys: Sequence[str], target: str, name: str) -> DataFrame:
    """Mean target of the row's key. Use lagged versions only as features.

    A grouped mean joined back, not a window: partial means are combined before
    the shuffle, so a hot key does not pull its rows together.
    """
    return df.join(target_means(df, keys, target, name), list(keys), "left")


# -- ordinal codes ------------------------------------------------------------


def fit_labels(df: DataFrame, column: str, code: str = "code") -> DataFrame:
    """Table (value, 0-based code) over the sorted distinct values.

    Values keep their type, so numeric ids sort as numbers.
    """
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    return with_row_index(values, [column], code)


def apply_labels(
    df: DataFrame, labels: DataFrame, column: str, code: str = "code", unseen: int | None = None
) -> DataFrame:
    """Add the code; values that were not fitted get `unseen`."""
    out = df.join(labels, [column], "left")
    return out if unseen is None else out.fillna({code: unseen})


# -- scaling ------------------------------------------------------------------


def fit_scale(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per column, in one pass."""
    row = df.agg(
        *[F.avg(c).alias(f"m_{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(columns)],
    ).first()
    return {c: (row[f"m_{i}"], row[f"s_{i}"]) for i, c in enumerate(columns)}


def apply_scale(
    df: DataFrame, stats: Mapping[str, tuple[float, float]], suffix: str = ""
) -> DataFrame:
    """(x - mean) / deviation; a constant column becomes 0."""
    return df.withColumns(
        {
            f"{c}{suffix}": (F.col(c) - F.lit(mean)) / F.lit(std if std else 1.0)
            for c, (mean, std) in stats.items()
        }
    )


# -- imputation ---------------------------------------------------------------


def fit_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact medians."""
    return exact_medians(df, columns)


def apply_medians(df: DataFrame, medians: Mapping[str, float | None]) -> DataFrame:
    """Replace missing numbers by the fitted median."""
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in medians.items()}
    )


# -- indicator columns --------------------------------------------------------


def fit_categories(df: DataFrame, columns: Sequence[str]) -> dict[str, list]:
    """Sorted distinct known values per column, all columns in one pass.

    The lists are the encoder's fitted state, so they are gathered whole. Distinct
    values are collected inside each task before they meet.
    """
    if not columns:
        return {}
    row = df.agg(
        *[F.sort_array(F.collect_set(c)).alias(f"_{i}") for i, c in enumerate(columns)]
    ).first()
    return {c: list(row[f"_{i}"]) for i, c in enumerate(columns)}


def one_hot_columns(categories: Mapping[str, Sequence]) -> dict[str, Column]:
    """0/1 columns for every category but the first; unknown values give zeros."""
    return {
        f"{c}_{v}": F.coalesce((F.col(c) == F.lit(v)), F.lit(False)).cast("double")
        for c, values in categories.items()
        for v in list(values)[1:]
    }


def apply_one_hot(df: DataFrame, categories: Mapping[str, Sequence]) -> DataFrame:
    """Add the indicator columns and drop the encoded ones."""
    return df.withColumns(one_hot_columns(categories)).drop(*categories)


# -- splits -------------------------------------------------------------------


def time_split(
    df: DataFrame, column: str, train_before, test_after
) -> tuple[DataFrame, DataFrame]:
    """Rows before the first cutoff, and rows after the second."""
    return df.filter(F.col(column) < train_before), df.filter(F.col(column) > test_after)


def ordered_split(
    df: DataFrame, order: Sequence[str], fraction: float = 0.8, name: str = "in_train"
) -> DataFrame:
    """Flag the first `floor(fraction * n)` rows under a total order."""
    n = df.count()
    return _blocks(df, order, [int(n * fraction)], "_block").withColumn(name, F.col("_block") == 0).drop("_block")


def _blocks(df: DataFrame, order: Sequence[str], cuts: Sequence[int], name: str) -> DataFrame:
    """Number of the cuts at or below the position of each row under a total order.

    Rows are counted by the first column of the order (a period). The position of
    nearly every row lies between the same cuts as its whole period; only the rows
    of periods that hold a cut, at most one for each cut, are put in order.
    """
    lead = F.struct(F.col(order[0]).isNotNull(), F.col(order[0])).alias("_lead")
    keyed = df.withColumn("_lead", lead)
    periods = value_counts_below(keyed.select("_lead"), [], "_lead")
    number = lambda at: sum(((at >= c).cast("int") for c in cuts), F.lit(0))
    periods = periods.select(
        "_lead", "below", number(F.col("below")).alias("_first"), number(F.col("below") + F.col("n") - 1).alias("_last")
    )
    placed = keyed.join(periods, "_lead")
    whole = placed.filter("_first = _last").withColumn(name, F.col("_first"))
    split = with_row_index(placed.filter("_first <> _last"), order, "_at")
    # earlier split periods are whole in the index: take them off
    starts = split.groupBy("_lead").agg(F.min("_at").alias("_begin"))
    split = split.join(starts, "_lead").withColumn(name, number(F.col("below") + F.col("_at") - F.col("_begin")))
    return whole.select(*df.columns, name).unionByName(split.select(*df.columns, name))


def time_folds(
    df: DataFrame, order: Sequence[str], n_splits: int = 3, name: str = "fold"
) -> DataFrame:
    """Blocks for expanding-window validation.

    Fold k (1..n_splits) tests on block k and trains on all blocks before it.
    Each test block has `n // (n_splits + 1)` rows; the rest is block 0.
    """
    n = df.count()
    size = n // (n_splits + 1)
    if size == 0:
        raise ValueError(f"{n} rows cannot be cut into {n_splits} folds")
    start = n - n_splits * size
    return _blocks(df, order, [start + k * size for k in range(n_splits)], name)
