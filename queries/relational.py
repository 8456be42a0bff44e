"""Joins, reshaping, set operations, dedupe and grouped means."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelweave import functions as fx
from panelweave.operators import encode, joins, metrics, reshape, windows
from queries import roles
from queries.registry import query, table

@query(
    "join_inner_dim",
    """SELECT o_orderkey, c_name, n_name FROM orders JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey""",
)
def join_inner_dim(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("key"))
    customer = table(spark, folder, "customer").withColumnRenamed("c_custkey", "key")
    nation = table(spark, folder, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    panel = joins.inner_join(orders, customer, ["key"], ["c_name", "c_nationkey"])
    panel = joins.inner_join(panel, nation, ["c_nationkey"], ["n_name"])
    return panel.select("o_orderkey", "c_name", "n_name")


def customer_years(spark, folder):
    return (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("custkey"), F.year("o_orderdate").alias("season"))
        .agg(roles.money("o_totalprice").alias("total"))
    )


CUSTOMER_YEARS = f"""
customer_years AS (
  SELECT o_custkey AS custkey, cast(year(o_orderdate) AS INTEGER) AS season,
         {roles.sql_money('o_totalprice')} AS total FROM orders GROUP BY 1, 2)"""


@query(
    "join_left_multikey",
    f"""WITH {CUSTOMER_YEARS},
    urgent AS (SELECT o_custkey AS custkey, cast(year(o_orderdate) AS INTEGER) AS season,
                 min(o_orderkey) AS urgent_order FROM orders
               WHERE o_orderpriority = '1-URGENT' GROUP BY 1, 2)
    SELECT c.custkey, c.season, c.total, u.urgent_order FROM customer_years c
    LEFT JOIN urgent u ON u.custkey = c.custkey AND u.season = c.season""",
)
def join_left_multikey(spark, folder):
    urgent = fx.filter_rows(
        table(spark, folder, "orders"), equal={"o_orderpriority": "1-URGENT"}
    ).select(
        F.col("o_custkey").alias("custkey"),
        F.year("o_orderdate").alias("season"),
        F.col("o_orderkey").alias("urgent_order"),
    )
    return joins.left_join(
        customer_years(spark, folder),
        urgent,
        ["custkey", "season"],
        first_by=[F.col("urgent_order")],
    )


@query(
    "enrich_chain",
    """SELECT o_orderkey, c_name, c_mktsegment, n_name, r_name FROM orders
       LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
       LEFT JOIN region ON r_regionkey = n_regionkey""",
)
def enrich_chain(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("c_custkey")
    )
    nation = fx.rename(table(spark, folder, "nation"), {"n_nationkey": "c_nationkey"})
    region = fx.rename(table(spark, folder, "region"), {"r_regionkey": "n_regionkey"})
    customer = table(spark, folder, "customer")
    return joins.enrich_chain(
        orders,
        [
            (customer, ["c_custkey"], ["c_name", "c_mktsegment", "c_nationkey"]),
            (nation, ["c_nationkey"], ["n_name", "n_regionkey"]),
            (region, ["n_regionkey"], ["r_name"]),
        ],
    ).select("o_orderkey", "c_name", "c_mktsegment", "n_name", "r_name")


def games(flow):
    """One game per month and unordered nation pair; odd sums swap the home side."""
    low, high = F.least("seller", "buyer"), F.greatest("seller", "buyer")
    swap = (low + high + F.col("time_index")) % 2 == 1
    return flow.select(
        "time_index",
        fx.pick(swap, high, low).alias("home"),
        fx.pick(swap, low, high).alias("away"),
    ).distinct()


GAMES = """
games AS (
  SELECT DISTINCT time_index,
    CASE WHEN (seller + buyer + time_index) % 2 = 1 THEN greatest(seller, buyer)
         ELSE least(seller, buyer) END AS home,
    CASE WHEN (seller + buyer + time_index) % 2 = 1 THEN least(seller, buyer)
         ELSE greatest(seller, buyer) END AS away FROM flow)"""


@query(
    "join_orientation",
    f"""WITH {roles.FLOW}, {GAMES}
    SELECT f.time_index, f.seller, f.buyer, f.revenue, g.home, g.away,
           cast(f.seller = g.home AS INTEGER) AS at_home
    FROM flow f JOIN games g ON g.time_index = f.time_index
     AND ((g.home = f.seller AND g.away = f.buyer) OR (g.home = f.buyer AND g.away = f.seller))""",
)
def join_orientation(spark, folder):
    flow = roles.flow(spark, folder)
    oriented = joins.orient_join(
        flow, games(flow), ["time_index"], ("seller", "buyer"), ("home", "away")
    )
    at_home = fx.flag(F.col("seller") == F.col("home")).alias("at_home")
    return oriented.select("time_index", "seller", "buyer", "revenue", "home", "away", at_home)


@query(
    "two_sided",
    f"""WITH {roles.FLOW}
    SELECT time_index, seller AS team, buyer AS opponent, revenue AS scored FROM flow
    UNION ALL SELECT time_index, buyer, seller, cast(quantity AS DOUBLE) FROM flow""",
)
def two_sided(spark, folder):
    quantity = F.col("quantity").cast("double")
    return reshape.two_sided(
        roles.flow(spark, folder),
        [
            {"team": "seller", "opponent": "buyer", "scored": "revenue"},
            {"team": "buyer", "opponent": "seller", "scored": quantity},
        ],
        ["time_index"],
    )


@query(
    "feature_join_back",
    f"""WITH {roles.NM},
    lagged AS (SELECT nation, time_index,
        CASE WHEN count(total) OVER w = 3 THEN max(total) OVER w END AS max_total_l3m FROM nm
        WINDOW w AS (PARTITION BY nation ORDER BY time_index ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING))
    SELECT o_orderkey, l.nation, l.time_index, l.max_total_l3m FROM orders
    JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
    JOIN lagged l ON l.nation = n_name AND l.time_index = {roles.sql_month_index('o_orderdate')}""",
)
def feature_join_back(spark, folder):
    w = windows.series(["nation"], ["time_index"])
    features = roles.nm(spark, folder).select(
        "nation", "time_index", windows.rolling("total", w, 3, "max").alias("max_total_l3m")
    )
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("c_custkey"),
        roles.month_index("o_orderdate").alias("time_index"),
    )
    nation = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation")
    )
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    detail = orders.join(customer, "c_custkey").join(nation, "c_nationkey")
    return joins.join_back(detail, features, ["nation", "time_index"]).select(
        "o_orderkey", "nation", "time_index", "max_total_l3m"
    )


@query(
    "join_prior_period",
    f"""WITH {CUSTOMER_YEARS}
    SELECT c.custkey, c.season, c.total, p.total AS prior_total FROM customer_years c
    LEFT JOIN customer_years p ON p.custkey = c.custkey AND p.season + 1 = c.season""",
)
def join_prior_period(spark, folder):
    years = customer_years(spark, folder)
    prior = years.withColumnRenamed("total", "prior_total")
    return joins.prior_period_join(years, prior, "season", ["custkey"], ["prior_total"])


def customer_calendar(spark, folder):
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("custkey"))
    seasons = table(spark, folder, "orders").select(F.year("o_orderdate").alias("season")).distinct()
    return reshape.calendar_grid(customers, "season", seasons, "month", 12)


CALENDAR = f"""
calendar AS (
  SELECT c_custkey AS custkey, cast(s AS INTEGER) AS season, cast(m AS INTEGER) AS month
  FROM customer, (SELECT DISTINCT year(o_orderdate) AS s FROM orders), range(1, 13) b(m)),
booked AS (
  SELECT o_custkey AS custkey, cast(year(o_orderdate) AS INTEGER) AS season,
         cast(month(o_orderdate) AS INTEGER) AS month, max(o_orderpriority) AS priority,
         count(*) AS n_orders FROM orders GROUP BY 1, 2, 3)"""


def booked_months(spark, folder):
    return (
        table(spark, folder, "orders")
        .groupBy(
            F.col("o_custkey").alias("custkey"),
            F.year("o_orderdate").alias("season"),
            F.month("o_orderdate").alias("month"),
        )
        .agg(F.max("o_orderpriority").alias("priority"), F.count(F.lit(1)).alias("n_orders"))
    )


@query(
    "calendar_anti",
    f"WITH {CALENDAR} SELECT * FROM calendar ANTI JOIN booked USING (custkey, season, month)",
)
def calendar_anti(spark, folder):
    return joins.anti_members(
        customer_calendar(spark, folder),
        booked_months(spark, folder),
        ["custkey", "season", "month"],
    )


@query(
    "calendar_fill",
    f"""WITH {CALENDAR}
    SELECT custkey, season, month, coalesce(priority, 'BYE') AS priority,
           coalesce(n_orders, 0) AS n_orders
    FROM calendar LEFT JOIN booked USING (custkey, season, month)""",
)
def calendar_fill(spark, folder):
    return reshape.calendar_fill(
        customer_calendar(spark, folder),
        booked_months(spark, folder),
        ["custkey", "season", "month"],
        {"priority": "BYE", "n_orders": 0},
    )


@query(
    "unpivot",
    f"""WITH {roles.FLOW}
    SELECT time_index, seller, buyer, 'revenue' AS measure, revenue AS amount FROM flow
    UNION ALL SELECT time_index, seller, buyer, 'quantity', cast(quantity AS DOUBLE) FROM flow""",
)
def unpivot(spark, folder):
    flow = roles.flow(spark, folder).withColumn("quantity", F.col("quantity").cast("double"))
    return reshape.unpivot(
        flow, ["time_index", "seller", "buyer"], ["revenue", "quantity"], "measure", "amount"
    )


@query(
    "distinct_keys",
    "SELECT DISTINCT o_custkey, cast(year(o_orderdate) AS INTEGER) AS season FROM orders",
)
def distinct_keys(spark, folder):
    orders = table(spark, folder, "orders").withColumn("season", F.year("o_orderdate"))
    return reshape.distinct_keys(orders, "o_custkey", "season")


@query("dense_spine", f"WITH {roles.UD} SELECT user_id, day, n_events, active FROM ud")
def dense_spine(spark, folder):
    return roles.ud(spark, folder).select("user_id", "day", "n_events", "active")


@query(
    "dedupe_keep_first",
    f"""WITH {roles.UD} SELECT user_id, day, event_id, event_type, value FROM numbered
       QUALIFY row_number() OVER (PARTITION BY user_id, day ORDER BY ts, event_id) = 1""",
)
def dedupe_keep_first(spark, folder):
    events = roles.numbered_events(spark, folder)
    first = reshape.keep_first(events, ["user_id", "day"], [F.col("ts"), F.col("event_id")])
    return first.select("user_id", "day", "event_id", "event_type", "value")


@query(
    "union_distinct",
    f"WITH {roles.FLOW} SELECT seller AS team FROM flow UNION SELECT buyer FROM flow",
)
def union_distinct(spark, folder):
    return reshape.union_distinct(roles.flow(spark, folder), ["seller", "buyer"], "team")


@query(
    "union_all",
    """SELECT 'customer' AS kind, c_custkey AS key, c_nationkey AS nationkey, c_acctbal AS balance
       FROM customer UNION ALL
       SELECT 'supplier', s_suppkey, s_nationkey, s_acctbal FROM supplier""",
)
def union_all(spark, folder):
    parts = [
        table(spark, folder, kind).select(
            F.lit(kind).alias("kind"),
            F.col(key).alias("key"),
            F.col(f"{kind[0]}_nationkey").alias("nationkey"),
            F.col(f"{kind[0]}_acctbal").alias("balance"),
        )
        for kind, key in (("customer", "c_custkey"), ("supplier", "s_suppkey"))
    ]
    return reshape.union_all(*parts)


@query(
    "target_encode",
    f"""WITH {roles.UD_KIND},
    means AS (SELECT kind, day, avg(x) AS kind_mean FROM udk WHERE active GROUP BY 1, 2)
    SELECT u.user_id, u.day, u.kind, round(m.kind_mean, 6) AS kind_encoded
    FROM udk u JOIN means m ON m.kind = u.kind AND m.day = u.day WHERE u.active""",
)
def target_encode(spark, folder):
    played = roles.ud_kind(spark, folder).filter("active")
    coded = encode.target_encode(played, ["kind", "day"], "x", "kind_mean")
    return coded.select(
        "user_id", "day", "kind", F.round("kind_mean", 6).alias("kind_encoded")
    )


@query(
    "menu_values",
    """SELECT DISTINCT 'o_orderstatus' AS menu, o_orderstatus AS choice FROM orders
       UNION ALL SELECT DISTINCT 'o_orderpriority', o_orderpriority FROM orders
       UNION ALL SELECT DISTINCT 'season', cast(year(o_orderdate) AS VARCHAR) FROM orders""",
)
def menu_values(spark, folder):
    from panelweave.plans import report

    orders = table(spark, folder, "orders").withColumn("season", F.year("o_orderdate"))
    return report.menu_values(orders, ["o_orderstatus", "o_orderpriority", "season"])


@query(
    "global_range",
    f"""WITH {roles.NM}, {roles.PRED}
    SELECT min(y) AS min_y, max(y) AS max_y, round(min(p), 6) AS min_p, round(max(p), 6) AS max_p
    FROM pred""",
)
def global_range(spark, folder):
    ranges = metrics.global_range(roles.pred(spark, folder), "y", "p")
    return ranges.select(
        "min_y", "max_y", F.round("min_p", 6).alias("min_p"), F.round("max_p", 6).alias("max_p")
    )
