"""Reshaping, completion, set operations and dedupe."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unpivot(
    df: DataFrame,
    ids: Sequence[str],
    values: Sequence[str],
    name_column: str = "variable",
    value_column: str = "value",
) -> DataFrame:
    """One row per id row and value column."""
    return df.unpivot(list(ids), list(values), name_column, value_column)


def distinct_keys(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct combinations of the given columns."""
    return df.select(*columns).distinct()


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key under a total order.

    Spark pushes the `row_number() = 1` limit before the shuffle, so each map
    task sends at most one row per key and a hot key stays harmless.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def union_all(*parts: DataFrame) -> DataFrame:
    """All rows of all parts, columns matched by name."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def union_distinct(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Set of the values found in any of several columns.

    The columns are read in one pass (array + explode), not one scan each.
    """
    values = F.explode(F.array(*[F.col(c) for c in columns]))
    return df.select(values.alias(name)).distinct()


def two_sided(
    games: DataFrame,
    perspectives: Sequence[Mapping[str, str | Column]],
    keep: Sequence[str],
) -> DataFrame:
    """One row per perspective of a pair fact.

    `perspectives` maps output names to the source column (or expression) of
    each side, for example home and away; `keep` is carried on every row.
    """
    sides = F.explode(
        F.array(
            *[
                F.struct(
                    *[
                        (F.col(s) if isinstance(s, str) else s).alias(name)
                        for name, s in side.items()
                    ]
                )
                for side in perspectives
            ]
        )
    )
    return games.select(*keep, sides.alias("_side")).select(*keep, "_side.*")


def dense_spine(
    facts: DataFrame,
    groups: Sequence[str],
    period: str,
    n_periods: int | Column,
    marker: str = "active",
    spine: DataFrame | None = None,
) -> DataFrame:
    """Every period 1..n for every group that occurs, facts joined where known.

    `facts` must be unique on (groups, period). `marker` tells the rows that
    had a fact. `n_periods` may depend on a group column (season length).
    `spine` gives the groups, with attributes of theirs, where they are not
    just those of the facts: what is joined there is joined before the periods.
    """
    length = F.lit(n_periods) if isinstance(n_periods, int) else n_periods
    spine = facts.select(*groups).distinct() if spine is None else spine
    kind = facts.schema[period].dataType
    periods = F.sequence(F.lit(1).cast(kind), F.greatest(length, F.lit(1)).cast(kind), F.lit(1).cast(kind))
    # a length below 1 has no periods: a sequence would count down
    spine = spine.filter(length >= 1).withColumn(period, F.explode(periods))
    known = facts.withColumn(marker, F.lit(True))
    joined = spine.join(known, [*groups, period], "left")
    return joined.withColumn(marker, F.coalesce(F.col(marker), F.lit(False)))


def calendar_grid(
    entities: DataFrame,
    season: str,
    seasons: Sequence[int] | DataFrame,
    period: str,
    n_periods: Column | int,
) -> DataFrame:
    """Every entity in every period of the given seasons.

    seasons  numbers, or a table of distinct seasons in the column `season`; it is
             gathered to one array row (years are few) that every entity expands,
             so the work is spread by entity.
    """
    length = F.lit(n_periods) if isinstance(n_periods, int) else n_periods
    if isinstance(seasons, DataFrame):
        listed = seasons.agg(F.sort_array(F.collect_set(season)).alias("_seasons"))
        grid = entities.join(F.broadcast(listed)).withColumn(season, F.explode("_seasons")).drop("_seasons")
    else:
        grid = entities.withColumn(season, F.explode(F.array(*[F.lit(int(s)) for s in seasons])))
    return grid.withColumn(period, F.explode(F.sequence(F.lit(1), length)))


def calendar_fill(
    grid: DataFrame,
    facts: DataFrame,
    on: Sequence[str],
    columns: Mapping[str, str],
) -> DataFrame:
    """Complete a calendar: grid rows without a fact get placeholders.

    `columns` maps fact columns to the placeholder of a missing fact, for
    example ``{"opponent_team": "BYE"}``.
    """
    marked = facts.select(*on, *columns, F.lit(True).alias("_known"))
    filled = grid.join(marked, list(on), "left")
    return filled.withColumns(
        {
            c: F.when(F.col("_known"), F.col(c)).otherwise(F.lit(fill))
            for c, fill in columns.items()
        }
    ).drop("_known")
