"""Lagged windows, streaks, ranks and sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelweave import functions as fx
from panelweave.operators import ordering, windows
from queries import roles
from queries.registry import query, table

NATION_MONTH = (["nation"], ["time_index"])


def sql_roll(c: str, n: int, how: str, part: str, order: str) -> str:
    w = (
        f"(PARTITION BY {part} ORDER BY {order} "
        f"ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    )
    return f"CASE WHEN count({c}) OVER {w} = {n} THEN {how}({c}) OVER {w} END"


def sql_roll_nm(n: int, how: str) -> str:
    return sql_roll("total", n, how, "nation", "time_index")


def sql_roll_ud(c: str, n: int, how: str) -> str:
    return sql_roll(c, n, how, "user_id", "day")


def sql_ewm(c: str, span: int, name: str) -> str:
    """EWM as a self-join CTE `name`(user_id, day, value)."""
    keep = 1 - 2 / (span + 1)
    weight = f"pow({keep!r}::DOUBLE, a.day - b.day - 1)"
    return f"""{name} AS (
      SELECT a.user_id, a.day, CASE WHEN count(b.{c}) >= {span}
        THEN sum(b.{c} * {weight}) / sum({weight}) END AS value
      FROM masked a LEFT JOIN masked b
        ON b.user_id = a.user_id AND b.day < a.day AND b.{c} IS NOT NULL
      GROUP BY 1, 2)"""


@query(
    "lag_value",
    f"""WITH {roles.NM} SELECT nation, time_index,
        lag(total) OVER (PARTITION BY nation ORDER BY time_index) AS prior_total FROM nm""",
)
def lag_value(spark, folder):
    w = windows.series(*NATION_MONTH)
    return roles.nm(spark, folder).select(
        "nation", "time_index", windows.lag_value("total", w).alias("prior_total")
    )


@query(
    "rolling_min_max",
    f"""WITH {roles.NM} SELECT nation, time_index, {sql_roll_nm(3, 'min')} AS min_l3,
        {sql_roll_nm(3, 'max')} AS max_l3, {sql_roll_nm(5, 'min')} AS min_l5,
        {sql_roll_nm(5, 'max')} AS max_l5 FROM nm""",
)
def rolling_min_max(spark, folder):
    w = windows.series(*NATION_MONTH)
    return roles.nm(spark, folder).select(
        "nation",
        "time_index",
        *[
            windows.rolling("total", w, n, how).alias(f"{how}_l{n}")
            for n in (3, 5)
            for how in ("min", "max")
        ],
    )


@query(
    "rolling_mean",
    f"""WITH {roles.NM} SELECT nation, time_index, round({sql_roll_nm(5, 'avg')}, 3) AS mean_l5
        FROM nm""",
)
def rolling_mean(spark, folder):
    w = windows.series(*NATION_MONTH)
    mean = windows.rolling("total", w, 5, "mean")
    return roles.nm(spark, folder).select(
        "nation", "time_index", F.round(mean, 3).alias("mean_l5")
    )


@query(
    "rolling_count_over",
    f"""WITH {roles.UD} SELECT user_id, day,
        {sql_roll_ud('x', 3, 'sum').replace('sum(x)', 'count(CASE WHEN x > 20 THEN 1 END)')}
        AS days_over_20_l3 FROM ud""",
)
def rolling_count_over(spark, folder):
    w = windows.series(*roles.USER_DAY)
    over = windows.rolling_count_over("x", w, 3, 20)
    return roles.ud(spark, folder).select("user_id", "day", over.alias("days_over_20_l3"))


@query(
    "masked_rolling",
    f"""WITH {roles.UD}, filled AS (SELECT user_id, day, active, coalesce(x, 0) AS x0 FROM ud),
    masked AS (SELECT *, CASE WHEN active THEN x0 END AS m FROM filled)
    SELECT user_id, day, {sql_roll_ud('m', 3, 'min')} AS masked_min_l3,
           {sql_roll_ud('x0', 3, 'min')} AS plain_min_l3 FROM masked""",
)
def masked_rolling(spark, folder):
    w = windows.series(*roles.USER_DAY)
    filled = roles.ud(spark, folder).fillna({"x": 0.0})
    return filled.select(
        "user_id",
        "day",
        windows.rolling(windows.masked("x", "active"), w, 3, "min").alias("masked_min_l3"),
        windows.rolling("x", w, 3, "min").alias("plain_min_l3"),
    )


@query(
    "ewm_mean",
    f"""WITH {roles.UD}, masked AS (SELECT * FROM ud), {sql_ewm('x', 3, 'e3')}, {sql_ewm('x', 5, 'e5')}
    SELECT e3.user_id, e3.day, round(e3.value, 6) AS ewm_l3, round(e5.value, 6) AS ewm_l5
    FROM e3 JOIN e5 ON e5.user_id = e3.user_id AND e5.day = e3.day""",
)
def ewm_mean(spark, folder):
    out = roles.ud(spark, folder)
    for span in (3, 5):
        out = windows.add_ewm(
            out, *roles.USER_DAY, {f"ewm_l{span}": "x"}, span=span, min_periods=span
        )
    return out.select(
        "user_id", "day", F.round("ewm_l3", 6).alias("ewm_l3"), F.round("ewm_l5", 6).alias("ewm_l5")
    )


@query(
    "streak",
    f"""WITH {roles.UD},
    placed AS (SELECT user_id, day, active,
        sum(CASE WHEN active THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY day) AS island
      FROM ud)
    SELECT user_id, day, active, cast(sum(CASE WHEN active THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id, island ORDER BY day) AS BIGINT) AS streak FROM placed""",
)
def streak(spark, folder):
    out = windows.add_streak(roles.ud(spark, folder), *roles.USER_DAY, active="active")
    return out.select("user_id", "day", "active", F.col("streak").cast("bigint").alias("streak"))


@query(
    "rank_in_group",
    """SELECT p_partkey, p_brand, p_type,
       rank() OVER (PARTITION BY p_brand, p_type ORDER BY p_retailprice) AS price_rank,
       p_type || rank() OVER (PARTITION BY p_brand, p_type ORDER BY p_retailprice) AS role
       FROM part""",
)
def rank_in_group(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_brand", "p_type", "p_retailprice")
    ranked = ordering.rank_in_group(part, ["p_brand", "p_type"], "p_retailprice", "price_rank")
    role = F.concat("p_type", F.col("price_rank").cast("string")).alias("role")
    return ranked.select("p_partkey", "p_brand", "p_type", "price_rank", role)


@query(
    "position_in_group",
    """SELECT c_custkey, c_nationkey, c_mktsegment, row_number() OVER
       (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS place
       FROM customer""",
)
def position_in_group(spark, folder):
    customer = table(spark, folder, "customer")
    return ordering.position_in_group(
        customer,
        ["c_nationkey", "c_mktsegment"],
        [F.col("c_acctbal").desc(), F.col("c_custkey")],
        "place",
    ).select("c_custkey", "c_nationkey", "c_mktsegment", "place")


def exploded(rows, extra=()):
    step = F.posexplode("sequence").alias("step", "row")
    return rows.select("user_id", "day", *extra, step).select(
        "user_id",
        "day",
        *extra,
        "step",
        F.col("row")[0].alias("x"),
        F.col("row")[1].alias("n_events"),
    )


def sequence_rows(spark, folder, layout, length):
    filled = roles.ud(spark, folder).fillna({"x": 0.0, "n_events": 0})
    return windows.sequence_windows(
        filled, *roles.USER_DAY, ["x", "n_events"], length, layout
    )


def sql_sequence(first: int, last: int, extra: str = "") -> str:
    """Rows first..last relative to the current day (days are dense)."""
    return f"""WITH {roles.UD}
    SELECT a.user_id, a.day, {extra} cast(b.day - a.day + {first} AS INTEGER) AS step,
           coalesce(b.x, 0) AS x, cast(coalesce(b.n_events, 0) AS DOUBLE) AS n_events
    FROM ud a JOIN ud b ON b.user_id = a.user_id
     AND b.day BETWEEN a.day - {first} AND a.day - {last} WHERE a.day > {first}"""


@query("history_window", sql_sequence(5, 1))
def history_window(spark, folder):
    return exploded(sequence_rows(spark, folder, "history", 6))


@query("sequence_next", sql_sequence(4, 1, "coalesce(a.x, 0) AS target,"))
def sequence_next(spark, folder):
    rows = sequence_rows(spark, folder, "next", 4).withColumnRenamed("x", "target")
    return exploded(rows, ["target"])


@query("sequence_current", sql_sequence(5, 0))
def sequence_current(spark, folder):
    return exploded(sequence_rows(spark, folder, "current", 6))


@query(
    "feature_battery",
    f"""WITH {roles.UD},
    masked AS (SELECT user_id, day, active, x, cast(n_events AS DOUBLE) AS n,
                 cast(x / n_events AS DOUBLE) AS mean_value FROM ud),
    {sql_ewm('x', 3, 'e_x')}, {sql_ewm('n', 3, 'e_n')}, {sql_ewm('mean_value', 3, 'e_m')}
    SELECT m.user_id, m.day, round(e_x.value, 6) AS ewm_x_l3, round(e_n.value, 6) AS ewm_n_l3,
      round(e_m.value, 6) AS ewm_mean_value_l3,
      {sql_roll_ud('m.x', 3, 'max').replace('user_id', 'm.user_id').replace('day ', 'm.day ')} AS max_x_l3,
      {sql_roll_ud('m.x', 3, 'min').replace('user_id', 'm.user_id').replace('day ', 'm.day ')} AS min_x_l3,
      {sql_roll_ud('m.n', 3, 'max').replace('user_id', 'm.user_id').replace('day ', 'm.day ')} AS max_n_l3,
      {sql_roll_ud('m.n', 3, 'min').replace('user_id', 'm.user_id').replace('day ', 'm.day ')} AS min_n_l3,
      round({sql_roll_ud('m.mean_value', 3, 'max').replace('user_id', 'm.user_id').replace('day ', 'm.day ')}, 6) AS max_mean_value_l3,
      round({sql_roll_ud('m.mean_value', 3, 'min').replace('user_id', 'm.user_id').replace('day ', 'm.day ')}, 6) AS min_mean_value_l3
    FROM masked m JOIN e_x USING (user_id, day) JOIN e_n USING (user_id, day)
    JOIN e_m USING (user_id, day)""",
)
def feature_battery(spark, folder):
    out = battery(roles.ud(spark, folder))
    rounded = ["ewm_x_l3", "ewm_n_l3", "ewm_mean_value_l3", "max_mean_value_l3", "min_mean_value_l3"]
    plain = ["max_x_l3", "min_x_l3", "max_n_l3", "min_n_l3"]
    return out.select("user_id", "day", *plain, *[F.round(c, 6).alias(c) for c in rounded])


def battery(ud):
    measured = ud.select(
        "user_id",
        "day",
        "active",
        "x",
        F.col("n_events").cast("double").alias("n"),
        (F.col("x") / F.col("n_events")).alias("mean_value"),
    )
    return windows.feature_battery(
        measured, *roles.USER_DAY, ["x", "n", "mean_value"], 3, "l3", active="active"
    )


@query(
    "flagship",
    f"""WITH {roles.UD}, masked AS (SELECT * FROM ud), {sql_ewm('x', 3, 'e3')},
    placed AS (SELECT user_id, day, x, active,
        {sql_roll_ud('x', 3, 'min')} AS min_x_l3, {sql_roll_ud('x', 3, 'max')} AS max_x_l3,
        {sql_roll_ud('x', 3, 'sum').replace('sum(x)', 'count(CASE WHEN x > 20 THEN 1 END)')} AS days_over_20_l3,
        row_number() OVER (PARTITION BY user_id ORDER BY day)
          - coalesce(max(CASE WHEN NOT active THEN day END)
              OVER (PARTITION BY user_id ORDER BY day), 0) AS streak FROM ud)
    SELECT p.user_id, p.day, p.x, cast(p.streak AS BIGINT) AS streak, p.min_x_l3, p.max_x_l3,
           p.days_over_20_l3, round(e3.value, 6) AS ewm_x_l3
    FROM placed p JOIN e3 ON e3.user_id = p.user_id AND e3.day = p.day WHERE p.streak > 3""",
)
def flagship(spark, folder):
    """Spine, mask, streak, lagged features and the streak filter in one plan."""
    rows = windows.add_streak(roles.ud(spark, folder), *roles.USER_DAY, active="active")
    rows = windows.feature_battery(
        rows,
        *roles.USER_DAY,
        ["x"],
        3,
        "l3",
        active="active",
        extra={"days_over_20_l3": lambda w: windows.rolling_count_over("x", w, 3, 20)},
    )
    return fx.min_streak(rows, "streak", 3).select(
        "user_id",
        "day",
        "x",
        F.col("streak").cast("bigint").alias("streak"),
        "min_x_l3",
        "max_x_l3",
        "days_over_20_l3",
        F.round("ewm_x_l3", 6).alias("ewm_x_l3"),
    )
