import random

from conftest import plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import pytest

from panelweave.operators import windows

SERIES = (["g"], ["t"])


def slow_ewm(values, span, min_periods):
    """Weighted mean of the known values before each row, by definition."""
    keep = 1 - 2 / (span + 1)
    out = []
    for i in range(len(values)):
        known = [(j, v) for j, v in enumerate(values[:i]) if v is not None]
        if len(known) < min_periods:
            out.append(None)
            continue
        last = known[-1][0]
        weights = [keep ** (last - j) for j, _ in known]
        out.append(sum(w * v for w, (_, v) in zip(weights, known)) / sum(weights))
    return out


def slow_roll(values, n, how):
    out = []
    for i in range(len(values)):
        part = values[max(0, i - n):i]
        out.append(how(part) if len(part) == n and None not in part else None)
    return out


def slow_streak(active):
    out, run = [], 0
    for a in active:
        run = run + 1 if a else 0
        out.append(run)
    return out


def frame(spark, groups, parts=None):
    data = [(g, t, v, v is not None) for g, vs in enumerate(groups) for t, v in enumerate(vs)]
    random.Random(3).shuffle(data)
    df = spark.createDataFrame(data, "g int, t int, x double, active boolean")
    return df.repartition(parts) if parts else df


def check(spark, groups, span, parts=None):
    df = frame(spark, groups, parts)
    df = windows.add_streak(df, *SERIES, active="active")
    shared = windows.feature_battery(df, *SERIES, ["x"], span, "l", active="active")
    got = windows.add_ewm(shared, *SERIES, {"own": "x"}, span=span, min_periods=span)
    found = {(r["g"], r["t"]): r for r in got.collect()}
    assert len(found) == sum(map(len, groups))
    for g, vs in enumerate(groups):
        expected = zip(
            slow_ewm(vs, span, span), slow_roll(vs, span, min), slow_roll(vs, span, max),
            slow_streak([v is not None for v in vs]),
        )
        for t, (ewm, low, high, streak) in enumerate(expected):
            r = found[(g, t)]
            assert (r["min_x_l"], r["max_x_l"], r["streak"]) == (low, high, streak)
            for value in (r["ewm_x_l"], r["own"]):
                assert (value is None) == (ewm is None)
                assert ewm is None or value == pytest.approx(ewm, rel=1e-11, abs=1e-11)


values = st.one_of(st.none(), st.floats(-1000, 1000).map(lambda v: round(v, 3)))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(values, max_size=40), min_size=1, max_size=4), st.sampled_from([3, 5]))
def test_random_gaps(spark, groups, span):
    check(spark, groups, span)


@pytest.mark.parametrize("parts", [1, 7])
@pytest.mark.parametrize("span", [3, 5])
def test_long_series_and_long_gaps(spark, span, parts):
    rng = random.Random(5)
    long = [rng.uniform(-9, 9) if rng.random() < 0.6 else None for _ in range(700)]
    gap = [1.0, 2.0, 4.0, 8.0, 16.0, *[None] * 250, 3.0, *[None] * 130]
    late = [None] * 140 + [5.0, 1.0, 2.0, 7.0, 4.0, 4.0]
    check(spark, [long, gap, late, [None] * 9, [1.0]], span, parts)


def test_mask_counts_as_missing(spark):
    df = spark.createDataFrame(
        [(1, t, float(t), t != 2) for t in range(1, 7)], "g int, t int, x double, a boolean"
    )
    w = windows.series(*SERIES)
    got = df.select(
        "t",
        windows.rolling(windows.masked("x", "a"), w, 3, "min").alias("m"),
        windows.rolling_count_over(windows.masked("x", "a"), w, 3, 3).alias("n"),
    )
    assert rows(got, "t", "m", "n") == [
        (1, None, None), (2, None, None), (3, None, None), (4, None, None), (5, None, None), (6, 3.0, 2),
    ]


def test_no_feature_uses_its_own_row(spark):
    base = [[1.0, 2.0, None, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0, 10.0]]
    changed = [[*base[0][:6], 700.0, *base[0][7:]]]

    def features(groups):
        out = windows.feature_battery(frame(spark, groups), *SERIES, ["x"], 3, "l", active="active")
        return {r["t"]: (r["ewm_x_l"], r["min_x_l"], r["max_x_l"]) for r in out.collect()}

    a, b = features(base), features(changed)
    assert all(a[t] == b[t] for t in range(7))
    assert a[7] != b[7]


def test_battery_is_one_shuffle(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(50).selectExpr(
        "id % 5 as g", "id as t", "rand() as x", "rand() as y", "true as active"
    ).write.parquet(path)
    df = spark.read.parquet(path)
    got = windows.feature_battery(
        df, *SERIES, ["x", "y"], 3, "l", active="active",
        extra={"n": lambda w: windows.rolling_count_over("x", w, 3, 0.5)},
    )
    text = plan(got)
    assert text.count("Exchange hashpartitioning") == 1 and "SinglePartition" not in text
    assert text.count("+- Sort ") + text.count("*(1) Sort") <= 3


def test_sequences_stay_inside_an_entity(spark):
    groups = [[1.0, 2.0, 3.0, 4.0], [5.0, 6.0, 7.0], [8.0]]
    df = frame(spark, groups)
    following = windows.sequence_windows(df, *SERIES, ["x"], 3, "next")
    assert [(r["g"], r["t"], r["sequence"]) for r in following.collect()] == [
        (0, 3, [[1.0], [2.0], [3.0]])
    ]
    current = windows.sequence_windows(df, *SERIES, ["x"], 3, "current")
    assert rows(current, "g", "t") == [(0, 2), (0, 3), (1, 2)]
    history = windows.sequence_windows(df, *SERIES, ["x"], 3, "history")
    assert rows(history, "g", "t") == [(0, 2), (0, 3), (1, 2)]
