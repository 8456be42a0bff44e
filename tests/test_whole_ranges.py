"""No query is tied to the periods of today's tables; NaN is a missing number."""

import datetime as dt
import math

from pyspark.sql import functions as F

from conftest import SMALL, rows
from panelweave import functions as fx
from panelweave.operators import metrics, reshape, windows
from queries import league, relational, roles


def folder_with(spark, tmp_path, name, extra):
    """The small tables with further rows in one of them."""
    for other in ("customer", "nation", "orders", "events", "lineitem"):
        df = spark.read.parquet(f"{SMALL}/{other}.parquet")
        df = df.unionByName(extra(df)) if other == name else df
        df.write.parquet(f"{tmp_path}/{other}.parquet")
    return str(tmp_path)


def test_thirty_first_day_and_next_month(spark, tmp_path):
    def late(df):
        return df.limit(2).withColumn("ts", F.lit(dt.datetime(2024, 2, 3, 12)).cast("timestamp_ntz"))

    folder = folder_with(spark, tmp_path, "events", late)
    days = roles.ud(spark, folder)
    assert days.agg(F.max("day")).first()[0] == 34
    assert days.agg(F.sum("n_events")).first()[0] == spark.read.parquet(f"{folder}/events.parquet").count()


def test_year_outside_the_old_range(spark, tmp_path):
    def early(df):
        return df.limit(3).withColumn("o_orderdate", F.lit(dt.datetime(1990, 12, 31)).cast("timestamp_ntz"))

    folder = folder_with(spark, tmp_path, "orders", early)
    filled = relational.calendar_fill(spark, folder)
    assert filled.agg(F.sum("n_orders")).first()[0] == spark.read.parquet(f"{folder}/orders.parquet").count()
    weeks = league.player_weeks(spark, folder)
    games = league.schedule(spark, folder, weeks.join(league.players(spark, folder), "custkey"))
    found = weeks.select("season", "week").distinct().join(games.select("season", "week").distinct(), ["season", "week"], "left_anti")
    assert found.count() == 0


def test_length_below_one_has_no_periods(spark):
    facts = spark.createDataFrame([("a", 0, 1.0), ("b", 2, 2.0)], "g string, period int, x double")
    facts = facts.withColumn("n", F.when(F.col("g") == "a", 0).otherwise(3))
    got = rows(reshape.dense_spine(facts, ["g", "n"], "period", F.col("n")), "g", "period")
    assert got == [("b", 1), ("b", 2), ("b", 3)]


def test_nan_is_missing(spark):
    data = [("a", t, math.nan if t == 2 else float(t)) for t in range(1, 9)]
    series = spark.createDataFrame(data, "g string, t int, x double")
    nulls = series.withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    for df in (series, nulls):
        out = windows.add_ewm(df, ["g"], ["t"], {"e": "x"}, 3, 2)
        w = windows.series(["g"], ["t"])
        out = out.withColumn("r", windows.rolling("x", w, 3, "max")).orderBy("t")
        got = [(r["e"], r["r"]) for r in out.collect()]
        expected = got if df is series else expected  # noqa: F821
        assert got == expected and not any(v is not None and math.isnan(v) for r in got for v in r)
    assert fx.fill_defaults(series).filter("x = 0").count() == 1
    pairs = series.select(F.col("x").alias("y"), (F.col("x") + 1).alias("p"))
    got = metrics.evaluate(pairs, "y", "p").first()
    assert (got["mae"], got["spearman"]) == (1.0, 1.0)
