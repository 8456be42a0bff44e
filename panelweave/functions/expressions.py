"""Column expressions and row-level transformations.

Everything here stays inside whole-stage code generation: no shuffle, no UDF.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def filter_rows(
    df: DataFrame,
    equal: Mapping[str, object] | None = None,
    isin: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """Conjunction of equality and membership tests."""
    tests = [F.col(c) == v for c, v in (equal or {}).items()]
    tests += [F.col(c).isin(list(vs)) for c, vs in (isin or {}).items()]
    return df.filter(reduce(and_, tests)) if tests else df


def not_equal_keep_null(c: str | Column, value) -> Column:
    """`c <> value`, true for a missing `c`."""
    return ~_col(c).eqNullSafe(F.lit(value))


def not_in_list(c: str | Column, values: Sequence) -> Column:
    """`c NOT IN values`, true for a missing `c`."""
    return F.coalesce(~_col(c).isin(list(values)), F.lit(True))


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns; an unknown name is an error (Spark's own drop ignores it)."""
    unknown = [n for n in names if n not in df.columns]
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    return df.drop(*names)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns old -> new."""
    return df.withColumnsRenamed(dict(names))


def drop_missing(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a missing value in any column, or in any of `subset`."""
    return df.dropna("any", subset=list(subset) if subset else None)


def fill_defaults(
    df: DataFrame, special: Mapping[str, object] | None = None, numeric: float | None = 0, keep: Sequence[str] = ()
) -> DataFrame:
    """Per-column constants first, then `numeric` for the other numeric columns but those to `keep`.

    Text stays NULL: a number cannot stand for missing text in a typed column,
    and presence is tested with `isNotNull`.
    """
    special = dict(special or {})
    fills = {}
    for field in df.schema.fields:
        if field.name in keep:
            continue
        if field.name in special:
            fill = special[field.name]
        elif numeric is not None and isinstance(field.dataType, NUMERIC_TYPES):
            fill = numeric
        else:
            continue
        value = F.col(field.name)
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            value = F.when(~F.isnan(value), value)  # NaN is a missing number
        fills[field.name] = F.coalesce(value, F.lit(fill).cast(field.dataType))
    return df.withColumns(fills) if fills else df


def coerce_number(c: str | Column, kind: str = "double") -> Column:
    """Cast that gives NULL for text that is not a number."""
    return _col(c).try_cast(kind)


def replace_literals(c: str | Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Literal substring replacements, applied in the given order."""
    return reduce(lambda acc, p: F.replace(acc, F.lit(p[0]), F.lit(p[1])), pairs, _col(c))


def period_key(season: str | Column, week: str | Column, *parts: str | Column) -> Column:
    """Text key `season_WW_part_part`; NULL as soon as one piece is missing.

    The week is padded to two digits and never cut.
    """
    week = _col(week).cast("string")
    padded = F.when(F.length(week) < 2, F.concat(F.lit("0"), week)).otherwise(week)
    pieces = [_col(season).cast("string"), padded, *[_col(p) for p in parts]]
    joined = [pieces[0]]
    for piece in pieces[1:]:
        joined += [F.lit("_"), piece]
    return F.concat(*joined)


def row_sum(*cols: str | Column) -> Column:
    """Sum across columns; missing if one of them is missing."""
    return reduce(add, [_col(c) for c in cols])


def weighted_sum(weights: Mapping[str, float]) -> Column:
    """Sum of column times weight."""
    return reduce(add, [F.col(c) * F.lit(w) for c, w in weights.items()])


def time_index(season: str | Column, week: str | Column) -> Column:
    """`season * 100 + week`, an integer that orders periods across seasons."""
    return _col(season) * F.lit(100) + _col(week)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it fails or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def present(c: str | Column) -> Column:
    """Boolean presence marker."""
    return _col(c).isNotNull()


def pick(condition: Column, yes: str | Column, no: str | Column) -> Column:
    """`yes` where the condition holds, else `no` (also when unknown)."""
    return F.when(condition, _col(yes)).otherwise(_col(no))


def season_length(
    season: str | Column, base: int = 17, changes: Sequence[tuple[int, int]] = ((2021, 18),)
) -> Column:
    """Number of periods of a season: `base`, replaced from given seasons on."""
    rule = F.lit(base)
    for since, length in sorted(changes):
        rule = F.when(_col(season) >= since, F.lit(length)).otherwise(rule)
    return rule


def min_streak(df: DataFrame, streak: str = "streak", more_than: int = 3) -> DataFrame:
    """Rows whose streak is longer than `more_than`.

    The streak counts the current row, so the test also asks that the entity is
    active in the period itself.
    """
    return df.filter(F.col(streak) > more_than)


def drop_placeholder(df: DataFrame, name: str) -> DataFrame:
    """Drop rows that exist only to complete the calendar (no entity name)."""
    return df.filter(F.col(name).isNotNull())


def columns_by_type(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """Names of the numeric (int, bigint, float, double) and the text columns."""
    fields = [f for f in df.schema.fields if f.name not in set(exclude)]
    numeric = [f.name for f in fields if isinstance(f.dataType, NUMERIC_TYPES)]
    text = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    return numeric, text
