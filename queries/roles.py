"""The given tables in the roles of a panel, as DataFrames and as SQL CTEs.

ud     user x day: events summed per day, completed to all days from the first
       to the last of the table; day 1 is the first day
nm     nation x month: order value of a nation's customers
flow   goods flow: month, seller nation, buyer nation, revenue, quantity
pred   ud rows with the lagged 3-day mean as a prediction of the day

Money is summed in whole cents, so sums do not depend on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.operators import reshape, windows
from queries.registry import table

USER_DAY = (["user_id"], ["day"])


def cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


def money(c: str) -> Column:
    return F.sum(cents(c)).cast("double") / F.lit(100.0)


def sql_money(c: str) -> str:
    return f"cast(sum(cast(round({c} * 100) AS BIGINT)) AS DOUBLE) / 100.0::DOUBLE"


def numbered_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with `day` (1 on the first day of the table) and `last_day`."""
    events = table(spark, folder, "events")
    date = F.to_date("ts")
    span = events.agg(F.min(date).alias("_first"), F.max(date).alias("_last"))
    # one row with the bounds of the table
    return events.join(F.broadcast(span)).select(
        "*",
        (F.date_diff(date, F.col("_first")) + 1).alias("day"),
        (F.date_diff(F.col("_last"), F.col("_first")) + 1).alias("last_day"),
    ).drop("_first", "_last")


def event_days(spark: SparkSession, folder: str) -> DataFrame:
    return (
        numbered_events(spark, folder)
        .groupBy("user_id", "day", "last_day")
        .agg(money("value").alias("x"), F.count(F.lit(1)).alias("n_events"))
    )


def ud(spark: SparkSession, folder: str) -> DataFrame:
    """user_id, day, x (missing on inactive days), n_events, active."""
    days = event_days(spark, folder)
    return reshape.dense_spine(days, ["user_id", "last_day"], "day", F.col("last_day")).drop("last_day")


UD = f"""
span AS (SELECT min(cast(ts AS DATE)) AS first, max(cast(ts AS DATE)) AS last FROM events),
numbered AS (
  SELECT *, cast(date_diff('day', first, cast(ts AS DATE)) + 1 AS INTEGER) AS day FROM events, span),
ev AS (
  SELECT user_id, day, {sql_money('value')} AS x, count(*) AS n_events
  FROM numbered GROUP BY 1, 2),
ud AS (
  SELECT s.user_id, s.day, e.x, e.n_events, e.user_id IS NOT NULL AS active
  FROM (SELECT user_id, cast(d AS INTEGER) AS day
        FROM (SELECT DISTINCT user_id FROM events),
             (SELECT unnest(range(1, date_diff('day', first, last) + 2)) AS d FROM span)) s
  LEFT JOIN ev e ON e.user_id = s.user_id AND e.day = s.day)"""


def first_kind(spark: SparkSession, folder: str) -> DataFrame:
    """Type of the first event per user and day."""
    events = numbered_events(spark, folder).select("user_id", "day", "ts", "event_id", "event_type")
    first = reshape.keep_first(events, ["user_id", "day"], [F.col("ts"), F.col("event_id")])
    return first.select("user_id", "day", F.col("event_type").alias("kind"))


def ud_kind(spark: SparkSession, folder: str) -> DataFrame:
    return ud(spark, folder).join(first_kind(spark, folder), ["user_id", "day"], "left")


UD_KIND = f"""{UD},
first_kind AS (
  SELECT user_id, day, event_type AS kind FROM numbered
  QUALIFY row_number() OVER (PARTITION BY user_id, day ORDER BY ts, event_id) = 1),
udk AS (
  SELECT u.*, k.kind FROM ud u
  LEFT JOIN first_kind k ON k.user_id = u.user_id AND k.day = u.day)"""


def month_index(c: str) -> Column:
    return (F.year(c) * 100 + F.month(c)).cast("int")


def sql_month_index(c: str) -> str:
    return f"cast(year({c}) * 100 + month({c}) AS INTEGER)"


def customer_months(spark: SparkSession, folder: str) -> DataFrame:
    """Order value in cents per customer and month."""
    return (
        table(spark, folder, "orders")
        .groupBy("o_custkey", month_index("o_orderdate").alias("time_index"))
        .agg(F.sum(cents("o_totalprice")).alias("cents"))
    )


def nm(spark: SparkSession, folder: str) -> DataFrame:
    """nation, time_index, total. Orders are summed per customer before the join."""
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    months = customer_months(spark, folder)
    by_nation = (
        months.join(customer, months.o_custkey == customer.c_custkey)
        .groupBy("c_nationkey", "time_index")
        .agg((F.sum("cents").cast("double") / 100.0).alias("total"))
    )
    return by_nation.join(nation, by_nation.c_nationkey == nation.n_nationkey).select(
        F.col("n_name").alias("nation"), "time_index", "total"
    )


NM = f"""
nm AS (
  SELECT n_name AS nation, {sql_month_index('o_orderdate')} AS time_index,
         {sql_money('o_totalprice')} AS total
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)"""


def flow(spark: SparkSession, folder: str) -> DataFrame:
    """time_index, seller, buyer, revenue, quantity.

    Lines are summed per (order, month, seller) before the join with orders, so
    an order with very many lines is a few rows when it is shuffled.
    """
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    lines = (
        table(spark, folder, "lineitem")
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(
            "l_orderkey",
            month_index("l_shipdate").alias("time_index"),
            F.col("s_nationkey").alias("seller"),
        )
        .agg(
            F.sum(cents("l_extendedprice")).alias("cents"),
            F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
        )
    )
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("time_index", "seller", F.col("c_nationkey").alias("buyer"))
        .agg(
            (F.sum("cents").cast("double") / 100.0).alias("revenue"),
            F.sum("quantity").alias("quantity"),
        )
    )


FLOW = f"""
flow AS (
  SELECT {sql_month_index('l_shipdate')} AS time_index, s_nationkey AS seller,
         c_nationkey AS buyer, {sql_money('l_extendedprice')} AS revenue,
         cast(sum(cast(l_quantity AS BIGINT)) AS BIGINT) AS quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
  GROUP BY 1, 2, 3)"""


def pred(spark: SparkSession, folder: str) -> DataFrame:
    """user_id, day, y, p (previous 3-day mean), l1 (previous day); all known."""
    w = windows.series(*USER_DAY)
    return (
        ud(spark, folder)
        .select(
            "user_id",
            "day",
            F.col("x").alias("y"),
            windows.rolling("x", w, 3, "mean").alias("p"),
            windows.lag_value("x", w).alias("l1"),
        )
        .dropna()
    )


PRED = f"""{UD},
lagged AS (
  SELECT user_id, day, x AS y, lag(x) OVER w AS l1, lag(x, 2) OVER w AS l2,
         lag(x, 3) OVER w AS l3 FROM ud WINDOW w AS (PARTITION BY user_id ORDER BY day)),
pred AS (
  SELECT user_id, day, y, (l3 + l2 + l1) / 3.0::DOUBLE AS p, l1 FROM lagged
  WHERE y IS NOT NULL AND l1 IS NOT NULL AND l2 IS NOT NULL AND l3 IS NOT NULL)"""


def doc_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with their labels, where they have any."""
    documents = table(spark, folder, "documents").select("doc_id", "lang", "source")
    return documents.join(table(spark, folder, "labels"), ["doc_id"], "left")


DOC_LABELS = """
doc_labels AS (
  SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""
