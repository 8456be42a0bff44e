"""Order statistics over whole tables and over groups of any size.

A window without a partition (or with one hot partition) would sort in a single
task. Here the rows are range-partitioned by the order instead, each partition
numbers its own rows, and only one small row per partition is combined:

* the sort spreads a hot group over many partitions, because the range is taken
  over (group, value);
* the tables of partition offsets have at most one row per shuffle partition
  (plus one per group before the filter), which is why they may be broadcast.

Partition numbers must not change between the two uses of the sorted rows, so
the sorted rows are written once (`lineage.durable`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelweave.lineage import durable

_PART = "_part"
_IN_PART = (1 << 33) - 1  # monotonically_increasing_id keeps the row in its low 33 bits


def with_row_index(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """Add the 0-based position of each row under a total order."""
    placed = durable(
        df.sort(*order).select(
            "*",
            F.spark_partition_id().alias(_PART),
            F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PART)).alias("_pos"),
        )
    )
    sizes = placed.groupBy(_PART).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        _PART, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    return (
        placed.join(F.broadcast(offsets), _PART)
        .withColumn(name, F.col("_offset") + F.col("_pos"))
        .drop(_PART, "_pos", "_offset")
    )


def _carries(placed: DataFrame, group: Sequence[str], rows: Column) -> DataFrame:
    """Rows of a group that lie in earlier partitions, per partition.

    Only the first group of a partition can have begun in an earlier one, so
    at most one row per partition is left.
    """
    pieces = placed.groupBy(_PART, *group).agg(rows.alias("_rows"))
    earlier = (
        Window.partitionBy(*group).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    )
    return pieces.select(
        F.col(_PART).alias("_cpart"),
        *[F.col(g).alias(f"_c_{g}") for g in group],
        F.sum("_rows").over(earlier).alias("_carry"),
    ).filter(F.col("_carry") > 0)


def _add_carry(
    placed: DataFrame, local: DataFrame, group: Sequence[str], rows: Column, name: str
) -> DataFrame:
    same = [F.col(_PART) == F.col("_cpart")]
    same += [F.col(g).eqNullSafe(F.col(f"_c_{g}")) for g in group]
    joined = local.join(F.broadcast(_carries(placed, group, rows)), same, "left")
    total = F.col("_local") + F.coalesce(F.col("_carry"), F.lit(0))
    return joined.withColumn(name, total).drop(
        _PART, "_local", "_carry", "_cpart", *[f"_c_{g}" for g in group]
    )


def value_counts_below(
    df: DataFrame, group: Sequence[str], value: str, weight: str | None = None
) -> DataFrame:
    """Distinct values per group with `n` (rows) and `below` (rows with a smaller value).

    weight  column with the number of rows that a row stands for (default 1)

    Rows with a missing value are left out. Ties collapse in the map-side part
    of the count, so a value that holds a third of all rows is one row here.
    """
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*group, value)
        .agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("n"))
    )
    placed = durable(
        counts.sort(*group, value).select("*", F.spark_partition_id().alias(_PART))
    )
    inside = (
        Window.partitionBy(_PART, *group)
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = placed.withColumn("_local", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return _add_carry(placed, local, group, F.sum("n"), "below")


def rank_in_group(
    df: DataFrame, group: Sequence[str], by: str, name: str, method: str = "min"
) -> DataFrame:
    """Ascending rank of `by` inside the group.

    method  "min": ties share the lowest rank; "average": ties share their mean
    A missing value gets a missing rank. Groups may be of any size.
    """
    table = value_counts_below(df, group, by)
    rank = F.col("below") + 1
    if method == "average":
        rank = F.col("below") + (F.col("n") + 1) / 2.0
    elif method != "min":
        raise ValueError(method)
    table = table.select(*group, by, rank.alias(name))
    return _lookup(df, table, [*group, by])


def position_in_group(
    df: DataFrame, group: Sequence[str], order: Sequence[str | Column], name: str
) -> DataFrame:
    """1-based position inside the group under the total order `order`."""
    placed = durable(
        df.sort(*group, *order).select("*", F.spark_partition_id().alias(_PART))
    )
    inside = Window.partitionBy(_PART, *group).orderBy(*order)
    local = placed.withColumn("_local", F.row_number().over(inside))
    return _add_carry(placed, local, group, F.count(F.lit(1)), name)


def _lookup(df: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join that also matches missing group keys."""
    renamed = table.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return df.join(renamed, same, "left").drop(*[f"_k_{k}" for k in keys])


_EVERYTHING = (float("-inf"), float("inf"))


def exact_medians(df: DataFrame, columns: Sequence[str], margin: float = 0.01) -> dict:
    """Exact median of each column (mean of the two middle values), missing and NaN skipped.

    1. one pass: row counts and an approximate bracket around the middle;
    2. one pass: rows below the bracket and inside it;
    3. the middle values are read off the ordered counts of the values inside.

    Only the values inside the brackets are shuffled. A bracket that misses the
    middle (approximation error) is opened fully, so the result stays exact.
    """
    medians: dict[str, float | None] = {c: None for c in columns}
    first = df.agg(
        *[F.count(_known(c)).alias(f"n_{i}") for i, c in enumerate(columns)],
        *[
            F.percentile_approx(
                _known(c), [0.5 - margin, 0.5 + margin], F.lit(1000)
            ).alias(f"q_{i}")
            for i, c in enumerate(columns)
        ],
    ).first()
    sizes = {c: first[f"n_{i}"] for i, c in enumerate(columns) if first[f"n_{i}"]}
    if not sizes:
        return medians
    brackets = {c: tuple(first[f"q_{i}"]) for i, c in enumerate(columns) if c in sizes}
    chosen = {
        c: (brackets[c], below)
        if below <= (sizes[c] - 1) // 2 and sizes[c] // 2 < below + inside
        else (_EVERYTHING, 0)
        for c, (below, inside) in _count_inside(df, brackets).items()
    }
    target = F.lit(False)
    for c, (_, before) in chosen.items():
        lo, hi = (sizes[c] - 1) // 2 - before, sizes[c] // 2 - before
        target |= (
            (F.col("col") == c) & (F.col("below") <= hi) & (F.col("below") + F.col("n") > lo)
        )
    placed = value_counts_below(_cells(df, chosen), ["col"], "v")
    return medians | _mean_of_ends(placed.filter(target))


def _known(c: str) -> Column:
    """The value as a double, NaN as missing."""
    v = F.col(c).cast("double")
    return F.when(~F.isnan(v), v)


def _cells(df: DataFrame, chosen: dict) -> DataFrame:
    """Long table (col, v) of the known values inside each column's bracket."""
    cells = []
    for c, ((lo, hi), _) in chosen.items():
        v = _known(c)
        cells.append(F.when(v.between(F.lit(lo), F.lit(hi)), F.struct(F.lit(c).alias("col"), v.alias("v"))))
    # only the cells inside a bracket leave the row
    return df.select(F.explode(F.array_compact(F.array(*cells))).alias("_cell")).select("_cell.*")


def _mean_of_ends(middle: DataFrame) -> dict[str, float]:
    """Mean of the smallest and largest row per column: one or two rows each."""
    found: dict[str, list] = {}
    for row in middle.collect():
        found.setdefault(row["col"], []).append(row["v"])
    return {c: (min(vs) + max(vs)) / 2.0 for c, vs in found.items()}


def _count_inside(df: DataFrame, brackets: dict) -> dict[str, tuple[int, int]]:
    """Rows below each bracket, and rows inside it."""
    row = df.agg(
        *[
            F.count(F.when(_known(c) < lo, 1)).alias(f"b_{i}")
            for i, (c, (lo, _)) in enumerate(brackets.items())
        ],
        *[
            F.count(F.when(_known(c).between(lo, hi), 1)).alias(f"i_{i}")
            for i, (c, (lo, hi)) in enumerate(brackets.items())
        ],
    ).first()
    return {c: (row[f"b_{i}"], row[f"i_{i}"]) for i, c in enumerate(brackets)}
