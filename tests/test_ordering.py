import random
import statistics

from conftest import plan, rows
from pyspark.sql import functions as F

import pytest

from panelweave.operators import encode, ordering


def hot_values(n=6000, seed=1):
    """A third of the rows in one group, a third of those with one value."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        g = "hot" if i % 3 == 0 else f"g{rng.randrange(40)}"
        v = 7.0 if g == "hot" and i % 9 == 0 else float(rng.randrange(500))
        out.append((g, i, v if rng.random() > 0.02 else None))
    return out


def frame(spark):
    return spark.createDataFrame(hot_values(), "g string, id int, v double").repartition(8)


@pytest.mark.parametrize("method", ["min", "average"])
def test_rank_of_hot_groups(spark, method):
    data = hot_values()
    expected = {}
    groups = {}
    for g, i, v in data:
        groups.setdefault(g, []).append(v)
    for g, i, v in data:
        if v is None:
            expected[i] = None
            continue
        below = sum(1 for u in groups[g] if u is not None and u < v)
        ties = sum(1 for u in groups[g] if u == v)
        expected[i] = below + (1 if method == "min" else (ties + 1) / 2)
    got = ordering.rank_in_group(frame(spark), ["g"], "v", "r", method)
    assert {r["id"]: r["r"] for r in got.collect()} == expected


def test_position_of_hot_groups(spark):
    got = ordering.position_in_group(frame(spark), ["g"], [F.desc("v"), F.col("id")], "p")
    found = {}
    for r in got.collect():
        found.setdefault(r["g"], []).append((r["p"], r["v"], r["id"]))
    assert sum(map(len, found.values())) == 6000
    for members in found.values():
        members.sort()
        assert [m[0] for m in members] == list(range(1, len(members) + 1))
        keys = [(v is None, -(v or 0), i) for _, v, i in members]
        assert keys == sorted(keys)


def test_row_index_is_the_global_order(spark):
    data = sorted((v is not None, v or 0, i) for _, i, v in hot_values())
    got = ordering.with_row_index(frame(spark), ["v", "id"], "idx")
    found = {r["id"]: r["idx"] for r in got.collect()}
    assert [found[i] for _, _, i in data] == list(range(len(data)))


def test_no_window_over_detail_rows_in_one_task(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 as g", "rand(1) as v")
    text = plan(ordering.with_row_index(df, ["v"], "idx"))
    # the only single-partition exchange is over the sizes, after an aggregate
    assert text.count("SinglePartition") == 1
    assert "SinglePartition" not in plan(ordering.value_counts_below(df, ["g"], "v"))


def test_exact_medians(spark):
    rng = random.Random(2)
    data = [
        (rng.gauss(0, 5), rng.randrange(4) if rng.random() > 0.1 else None, 3.0, None)
        for _ in range(4001)
    ]
    df = spark.createDataFrame(data, "a double, b int, c double, d double").repartition(5)
    got = ordering.exact_medians(df, ["a", "b", "c", "d"])
    assert got["a"] == statistics.median(r[0] for r in data)
    assert got["b"] == statistics.median(r[1] for r in data if r[1] is not None)
    assert got["c"] == 3.0 and got["d"] is None


def test_nan_is_no_value_of_a_median(spark):
    data = [(float(i) if i % 5 else float("nan"),) for i in range(1001)] + [(None,)] * 7
    df = spark.createDataFrame(data, "x double").repartition(3)
    want = statistics.median(r[0] for r in data if r[0] is not None and r[0] == r[0])
    assert ordering.exact_medians(df, ["x"]) == {"x": want}


def test_weighted_value_counts(spark):
    df = spark.createDataFrame([(1.0, 3), (2.0, 1), (2.0, 4), (None, 9)], "v double, w int")
    got = rows(ordering.value_counts_below(df, [], "v", "w"), "v", "n", "below")
    assert got == [(1.0, 3, 0), (2.0, 5, 3)]


def test_bracket_that_misses_is_opened(spark, monkeypatch):
    df = spark.createDataFrame([(float(i),) for i in [1, 2, 4, 10]], "x double")
    monkeypatch.setattr(ordering, "_count_inside", lambda df, b: {"x": (3, 1)})
    assert ordering.exact_medians(df, ["x"]) == {"x": 3.0}


def test_folds_and_split(spark):
    df = spark.createDataFrame([(i // 3, 100 - i) for i in range(11)], "t int, id int")
    folds = rows(encode.time_folds(df, ["t", "id"]), "t", "id", "fold")
    # n = 11: three test blocks of 2 rows, the first 5 rows are block 0
    assert [f for _, _, f in folds] == [0] * 5 + [1, 1, 2, 2, 3, 3]
    split = rows(encode.ordered_split(df, ["t", "id"]), "t", "id", "in_train")
    assert [s for _, _, s in split] == [True] * 8 + [False] * 3
    with pytest.raises(ValueError):
        encode.time_folds(df.limit(3), ["t", "id"])


@pytest.mark.parametrize("n_periods", [1, 3, 50])
def test_blocks_follow_the_whole_order(spark, n_periods):
    rng = random.Random(n_periods)
    data = [(rng.randrange(n_periods) if i else None, i, rng.random()) for i in range(203)]
    df = spark.createDataFrame(data, "t int, id int, v double").repartition(4)
    order = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    size = len(data) // 4
    start = len(data) - 3 * size
    want = {r[1]: 0 if i < start else (i - start) // size + 1 for i, r in enumerate(order)}
    assert {r["id"]: r["fold"] for r in encode.time_folds(df, ["t", "id"]).collect()} == want
    first = {r[1] for r in order[: int(0.8 * len(data))]}
    assert {r["id"] for r in encode.ordered_split(df, ["t", "id"]).filter("in_train").collect()} == first


def test_scratch_tables_go_with_their_scope(spark):
    from pathlib import Path

    from panelweave.lineage import durable, scratch

    with scratch(spark):
        kept = durable(spark.range(5))
        files = [Path(f.removeprefix("file:")) for f in kept.inputFiles()]
        assert kept.count() == 5 and all(f.exists() for f in files)
    assert not any(f.exists() for f in files)
