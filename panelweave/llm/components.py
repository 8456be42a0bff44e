"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.lineage import durable


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (
        both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .filter("u != v").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root of every node of the edges (u, v), two longs; root is the least node of the component.

    Each round points nodes at the least node nearby, with groupings that combine
    before their shuffle; a node of any degree is one row for each edge, never a
    list. Rounds are written to the checkpoint folder, and their number is
    logarithmic in the size of a component. Self-loops and missing ends are
    ignored; an empty table has no components.
    """
    state = edges.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v"))
    state = durable(state.filter("u != v").distinct())
    seen = None
    while True:
        mark = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        state = durable(_small_star(_large_star(state)))
    roots = state.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
