from conftest import plan, rows
from pyspark.sql import functions as F

import pytest

from panelweave import functions as fx
from panelweave.operators import joins, reshape


def test_null_keys_match_nothing(spark):
    left = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    right = spark.createDataFrame([("a", 10), (None, 20)], "k string, w int")
    assert rows(joins.left_join(left, right, ["k"]), "v", "w") == [(1, 10), (2, None)]
    assert rows(joins.inner_join(left, right, ["k"]), "v", "w") == [(1, 10)]


def test_clashing_columns_need_a_decision(spark):
    left = spark.createDataFrame([(1, "x")], "k int, o string")
    right = spark.createDataFrame([(1, "y")], "k int, o string")
    with pytest.raises(ValueError):
        joins.left_join(left, right, ["k"])
    assert rows(joins.left_join(left, right, ["k"], replace=True), "o") == [("y",)]


def test_orientation(spark):
    detail = spark.createDataFrame(
        [(1, "A", "B"), (1, "B", "A"), (1, "C", "C"), (2, "A", "B")], "week int, t string, o string"
    )
    games = spark.createDataFrame(
        [(1, "B", "A", 7.0), (1, "C", "C", 1.0), (1, "D", "E", 2.0)],
        "week int, home string, away string, hs double",
    )
    got = joins.orient_join(detail, games, ["week"], ("t", "o"), ("home", "away"))
    assert rows(got, "t", "o", "home", "hs") == [
        ("A", "B", "B", 7.0),
        ("B", "A", "B", 7.0),
        ("C", "C", "C", 1.0),
    ]


def test_prior_period(spark):
    left = spark.createDataFrame([(1, 2021), (1, 2020)], "p int, season int")
    right = spark.createDataFrame([(1, 2020, 0.5)], "p int, season int, dom double")
    got = joins.prior_period_join(left, right, "season", ["p"], ["dom"])
    assert rows(got, "season", "dom") == [(2020, None), (2021, 0.5)]


def test_stacked_lookups_equal_separate_joins(spark):
    a = spark.createDataFrame([(1, 1, "x"), (2, 1, "y")], "p int, w int, s string")
    b = spark.createDataFrame([(1, 1, 3.0), (None, 1, 9.0)], "p int, w int, r double")
    got = joins.stack_lookups(["p", "w"], [(a, ["s"]), (b, ["r"])])
    assert rows(got, "p", "w", "s", "r") == [(1, 1, "x", 3.0), (2, 1, "y", None)]


def test_dense_spine_by_season_length(spark):
    facts = spark.createDataFrame(
        [(1, 2020, 3, 5.0), (1, 2021, 18, 6.0)], "p int, season int, week int, x double"
    )
    got = reshape.dense_spine(facts, ["p", "season"], "week", fx.season_length("season"))
    assert got.count() == 17 + 18
    assert rows(got.filter("active"), "season", "week", "x") == [(2020, 3, 5.0), (2021, 18, 6.0)]


def test_calendar_placeholders(spark):
    teams = spark.createDataFrame([("A",), ("B",)], "team string")
    facts = spark.createDataFrame([("A", 2021, 1, "B"), ("B", 2021, 1, "A")],
                                  "team string, season int, week int, o string")
    grid = reshape.calendar_grid(teams, "season", [2020, 2021], "week", fx.season_length("season"))
    got = reshape.calendar_fill(grid, facts, ["team", "season", "week"], {"o": "BYE"})
    assert got.count() == 2 * (17 + 18)
    assert got.filter("o <> 'BYE'").count() == 2
    assert joins.anti_members(grid, facts, ["team", "season", "week"]).count() == 68


def test_keep_first_orders_ties_and_limits_before_the_shuffle(spark):
    # played depth 2 beats an unplayed filler of depth 1; then depth, then team
    df = spark.createDataFrame(
        [(1, True, 2, "B"), (1, False, 1, "A"), (2, False, 1, "B"), (2, False, 1, "A")],
        "p int, played boolean, depth int, team string",
    )
    got = reshape.keep_first(df, ["p"], [F.desc("played"), F.asc("depth"), F.asc("team")])
    assert rows(got, "p", "team") == [(1, "B"), (2, "A")]
    text = plan(got)
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_union_distinct_reads_once(spark, tmp_path):
    path = str(tmp_path / "g")
    spark.createDataFrame([("A", "B"), ("C", "A")], "h string, a string").write.parquet(path)
    got = reshape.union_distinct(spark.read.parquet(path), ["h", "a"], "team")
    assert rows(got, "team") == [("A",), ("B",), ("C",)]
    assert plan(got).count("FileScan") == 1
