from conftest import rows
from pyspark.sql import functions as F

import pytest

from panelweave import functions as fx
from panelweave import sources


def test_nan_becomes_null(spark, tmp_path):
    df = spark.createDataFrame([(1, float("nan")), (2, None), (3, 5.0)], "t int, x double")
    path = str(tmp_path / "t")
    df.write.parquet(path)
    got = sources.read_periods(spark, path, "t", 1, 3)
    assert rows(got, "t", "x") == [(1, None), (2, None), (3, 5.0)]
    # NULL is skipped by max and comparisons, NaN would not be
    assert got.agg(F.max("x")).first()[0] == 5.0


def test_period_range_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("cast(id as int) season", "id x", "id y").write.parquet(path)
    got = sources.read_periods(spark, path, "season", 10, 12, columns=["season", "x"])
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(season,10)" in text and "LessThanOrEqual(season,12)" in text
    assert "ReadSchema: struct<season:int,x:bigint>" in text
    assert got.count() == 3


def test_missing_opponent_is_kept(spark):
    df = spark.createDataFrame([("A", "BYE"), ("B", None), ("C", "A")], "team string, o string")
    assert rows(df.filter(fx.not_equal_keep_null("o", "BYE")), "team") == [("B",), ("C",)]
    assert rows(df.filter(fx.not_in_list("o", ["A"])), "team") == [("A",), ("B",)]


def test_typed_fill_keeps_text_missing(spark):
    df = spark.createDataFrame(
        [(None, None, None, None)], "depth int, ovr double, x double, name string"
    )
    got = fx.fill_defaults(df, {"depth": 1, "ovr": 260})
    assert rows(got, "depth", "ovr", "x", "name") == [(1, 260.0, 0.0, None)]
    assert fx.drop_placeholder(got, "name").count() == 0


def test_coerced_text_and_key(spark):
    df = spark.createDataFrame([("12", 2021, 3), ("n/a", 2020, 12)], "r string, s int, w int")
    got = df.select(
        fx.coerce_number("r").alias("r"),
        fx.period_key("s", "w", F.lit("LV"), F.lit("KC")).alias("k"),
        fx.time_index("s", "w").alias("t"),
        fx.season_length("s").alias("n"),
    )
    assert rows(got, "r", "k", "t", "n") == [
        (None, "2020_12_LV_KC", 202012, 17),
        (12.0, "2021_03_LV_KC", 202103, 18),
    ]


def test_replacements_run_in_order(spark):
    df = spark.createDataFrame([("2019_01_OAK_STL",), ("2019_01_SD_KC",)], "g string")
    pairs = [("OAK", "LV"), ("STL", "LA"), ("SD", "LAC")]
    got = df.select(fx.replace_literals("g", pairs).alias("g"))
    assert rows(got, "g") == [("2019_01_LAC_KC",), ("2019_01_LV_LA",)]


def test_unknown_column_is_an_error(spark):
    with pytest.raises(ValueError):
        fx.drop_columns(spark.range(1), "nope")


def test_flag_of_unknown_is_zero(spark):
    df = spark.createDataFrame([("A", "A"), (None, "A"), ("B", "A")], "h string, t string")
    got = df.select(fx.flag(F.col("h") == F.col("t")).alias("f"))
    assert rows(got, "f") == [(0,), (0,), (1,)]


def test_columns_by_type(spark):
    df = spark.createDataFrame(
        [(1, 2, 3.0, "a", True)], "i int, l bigint, d double, s string, b boolean"
    )
    assert fx.columns_by_type(df, exclude=["l"]) == (["i", "d"], ["s"])


def test_ranking_file(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_bytes("name;season;pos;rank\nJosé Núñez;2021;WR;3\nB;2021;QB;x\n".encode("latin-1"))
    got = sources.read_rankings(spark, str(path)).withColumn("rank", fx.coerce_number("rank"))
    assert rows(got, "name", "season", "rank") == [("B", 2021, None), ("José Núñez", 2021, 3.0)]


def test_predictions_are_computed_once(spark, tmp_path):
    calls = []

    def compute():
        calls.append(1)
        return spark.range(3)

    for _ in range(2):
        got = sources.cached_predictions(spark, str(tmp_path), "lr", "individual", compute)
        assert got.count() == 3
    assert len(calls) == 1


def test_another_version_is_another_table(spark, tmp_path):
    def table(n):
        return lambda: spark.range(n).withColumnRenamed("id", "x")

    for version, n, want in (("a", 2, 2), ("b", 3, 3), ("a", 9, 2)):
        got = sources.cached_predictions(spark, str(tmp_path), "lr", "individual", table(n), version)
        assert got.count() == want
