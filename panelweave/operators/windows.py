"""Lagged features over a series: rows of one entity in time order.

All features of one battery share one window partitioning, so they cost one
shuffle by entity. A panel is unique on (entity, period): an entity holds at
most as many rows as there are periods, whatever the number of source rows,
because sources are summed to that key (with map-side combining) before.

Unless stated otherwise the current row is excluded, so that a feature of a
period never uses the period itself.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _number(c: str | Column) -> Column:
    """The value, NaN as missing."""
    c = _col(c)
    return F.when(~F.isnan(c), c)


def series(entity: Sequence[str], order: Sequence[str]) -> WindowSpec:
    """Window of an entity's rows in time order."""
    return Window.partitionBy(*entity).orderBy(*order)


def masked(c: str | Column, active: str | Column) -> Column:
    """The value where the entity was active, else missing."""
    return F.when(_col(active), _col(c))


def lag_value(c: str | Column, w: WindowSpec, by: int = 1) -> Column:
    """Value `by` rows earlier (rows, not periods)."""
    return F.lag(_col(c), by).over(w)


def rolling(c: str | Column, w: WindowSpec, n: int, how: str) -> Column:
    """min, max, mean or sum of the previous `n` rows, all of which must be known."""
    c = _number(c)
    frame = w.rowsBetween(-n, -1)
    function = {"min": F.min, "max": F.max, "mean": F.avg, "sum": F.sum}[how]
    return F.when(F.count(c).over(frame) == n, function(c).over(frame))


def rolling_count_over(c: str | Column, w: WindowSpec, n: int, threshold: float) -> Column:
    """How many of the previous `n` rows, all known, lie above `threshold`."""
    c = _number(c)
    frame = w.rowsBetween(-n, -1)
    return F.when(
        F.count(c).over(frame) == n, F.count(F.when(c > threshold, 1)).over(frame)
    )


def add_streak(
    df: DataFrame, entity: Sequence[str], order: Sequence[str], active: str, name: str = "streak"
) -> DataFrame:
    """Length of the run of active rows that ends in the current row, else 0.

    Row number minus the row number of the latest inactive row; both use the
    same window.
    """
    w = series(entity, order)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    position = F.row_number().over(w)
    placed = df.withColumn("_pos", position)
    miss = F.when(~F.coalesce(F.col(active), F.lit(False)), F.col("_pos"))
    latest = F.coalesce(F.max(miss).over(running), F.lit(0))
    return placed.withColumn(name, F.col("_pos") - latest).drop("_pos")


def ewm_reach(span: int) -> int:
    """Number of rows after which a weight is below e^-40 of the newest one."""
    alpha = 2.0 / (span + 1.0)
    return math.ceil(40.0 / -math.log(1.0 - alpha))


def add_ewm(
    df: DataFrame,
    entity: Sequence[str],
    order: Sequence[str],
    columns: Mapping[str, str | Column],
    span: int,
    min_periods: int,
    complete: str | Column | None = None,
) -> DataFrame:
    """Exponentially weighted means of all rows before the current one.

    columns      output name -> value; missing values and NaN carry no weight
    span         decay alpha = 2 / (span + 1), weights (1-alpha)^(row distance)
    min_periods  known values needed before the current row
    complete     condition under which *all* columns are known; give it when
                 they share one mask, the weights are then summed only once

    Gaps count as distance and the last mean is carried through them.

    A plain running sum of x * (1-alpha)^-row overflows after about a thousand
    rows. The rows are therefore cut into blocks of B rows, B the reach of the
    weights, and the powers are taken relative to the start of the block:

        mean at row p = (r^m * S(p) + r^(m+B) * T) / (same with x = 1)

    with m the row inside the block, S the running sum of the block and T the
    total of the block before. Earlier blocks weigh below e^-40. Every sum is a
    running or per-block aggregate: linear, without collecting lists.
    """
    placed = _place(df, entity, order, span)
    columns = {name: _number(c) for name, c in columns.items()}
    return _ewm(placed, entity, columns, span, min_periods, complete).drop(*_PLACE)


_PLACE = ("_row", "_block", "_m", "_g")


def _place(df: DataFrame, entity: Sequence[str], order: Sequence[str], span: int) -> DataFrame:
    """Row number, block, row inside the block and growth factor of the block."""
    r = 1.0 - 2.0 / (span + 1.0)
    size = ewm_reach(span)
    placed = df.withColumn("_row", F.row_number().over(series(entity, order)) - 1)
    within = (F.col("_row") % size).cast("double")
    return placed.withColumns(
        {
            "_block": F.floor(F.col("_row") / size).cast("int"),
            "_m": within,
            "_g": F.pow(F.lit(r), -within),
        }
    )


def _placed_series(entity: Sequence[str]) -> WindowSpec:
    """Time order as (block, row): the sort the block sums need anyway."""
    return Window.partitionBy(*entity).orderBy("_block", "_row")


def _ewm(
    placed: DataFrame,
    entity: Sequence[str],
    columns: Mapping[str, str | Column],
    span: int,
    min_periods: int,
    complete: str | Column | None,
) -> DataFrame:
    r = 1.0 - 2.0 / (span + 1.0)
    size = ewm_reach(span)
    inside = (
        Window.partitionBy(*entity, "_block")
        .orderBy("_row")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before = Window.partitionBy(*entity).orderBy("_block").rangeBetween(-1, -1)
    earlier = _placed_series(entity).rowsBetween(Window.unboundedPreceding, -1)

    def decayed(v: Column) -> Column:
        here = F.coalesce(F.sum(v).over(inside), F.lit(0.0))
        there = F.coalesce(F.sum(v).over(before), F.lit(0.0))
        return F.pow(F.lit(r), F.col("_m")) * (here + F.lit(r**size) * there)

    names = list(columns)
    values = {f"_v_{n}": _col(c).cast("double") for n, c in columns.items()}
    placed = placed.withColumns(values)
    shared = complete is not None
    if shared:
        placed = placed.withColumn("_ok", F.coalesce(_col(complete), F.lit(False)))
    known = {n: F.col("_ok") if shared else F.col(f"_v_{n}").isNotNull() for n in names}

    sums = {f"_n_{n}": decayed(F.when(known[n], F.col(f"_v_{n}") * F.col("_g"))) for n in names}
    weights = {n: "_d" if shared else f"_d_{n}" for n in names}
    for n, d in weights.items():
        sums[d] = decayed(F.when(known[n], F.col("_g")))
    placed = placed.withColumns(sums)

    def mean(n: str) -> Column:
        return (F.col(f"_n_{n}") / F.col(weights[n])).alias(n)

    if shared:
        # one carried struct and one count for all columns
        carried = {"_all": F.last(F.when(F.col("_ok"), F.struct(*[mean(n) for n in names])), True)}
        seen = {"_seen": F.count(F.when(F.col("_ok"), 1))}
        result = {n: (F.col(f"_all.{n}"), F.col("_seen")) for n in names}
    else:
        carried = {f"_a_{n}": F.last(F.when(known[n], mean(n)), True) for n in names}
        seen = {f"_s_{n}": F.count(F.when(known[n], 1)) for n in names}
        result = {n: (F.col(f"_a_{n}"), F.col(f"_s_{n}")) for n in names}
    placed = placed.withColumns({n: c.over(earlier) for n, c in {**carried, **seen}.items()})
    placed = placed.withColumns(
        {n: F.when(count >= min_periods, value) for n, (value, count) in result.items()}
    )
    return placed.drop("_ok", *values, *sums, *carried, *seen)


def feature_battery(
    df: DataFrame,
    entity: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    n: int,
    suffix: str,
    active: str | None = None,
    hows: Sequence[str] = ("max", "min"),
    extra: Mapping[str, Callable[[WindowSpec], Column]] | None = None,
) -> DataFrame:
    """`ewm_`, `max_` and `min_` of every column over the previous n rows.

    With `active` given, inactive rows are masked first and the columns must be
    known on active rows. `extra` maps further names to functions of the window.
    One shuffle by entity and two sorts for everything; the previous n values
    are read once per column and shared by min and max.
    """
    shown = {c: masked(c, active) if active else F.col(c) for c in columns}
    placed = _place(df, entity, order, span=n)
    out = _ewm(
        placed, entity, {f"ewm_{c}_{suffix}": v for c, v in shown.items()}, n, n, active
    )
    w = _placed_series(entity)
    steps = range(1, n + 1)
    previous = {f"_p{k}_{c}": F.lag(v, k).over(w) for c, v in shown.items() for k in steps}
    out = out.withColumns({**previous, **{name: f(w) for name, f in (extra or {}).items()}})
    pick = {"min": F.least, "max": F.greatest}
    frames = {}
    for c in columns:
        cells = [F.col(f"_p{k}_{c}") for k in steps]
        known = reduce(and_, [cell.isNotNull() for cell in cells])
        for how in hows:
            frames[f"{how}_{c}_{suffix}"] = F.when(known, pick[how](*cells))
    return out.withColumns(frames).drop(*previous, *_PLACE)


def sequence_windows(
    df: DataFrame,
    entity: Sequence[str],
    order: Sequence[str],
    features: Sequence[str],
    length: int,
    layout: str,
    name: str = "sequence",
) -> DataFrame:
    """Fixed-length feature sequences, one per row that has enough history.

    layout  "next"     the `length` rows before the current one; its own target
                       is what the sequence predicts
            "current"  `length` - 1 rows of history and the current row
            "history"  only the `length` - 1 rows before the current one

    Sequences never cross an entity. `name` becomes array<array<double>>.
    """
    first, last, size = {
        "next": (-length, -1, length),
        "current": (-(length - 1), 0, length),
        "history": (-(length - 1), -1, length - 1),
    }[layout]
    row = F.array(*[F.col(f).cast("double") for f in features])
    frame = series(entity, order).rowsBetween(first, last)
    return df.withColumn(name, F.collect_list(row).over(frame)).filter(F.size(name) == size)
