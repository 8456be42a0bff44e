"""Scans, projections, filters and expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelweave import functions as fx
from panelweave import sources
from panelweave.operators import windows
from queries import roles
from queries.registry import query, table

PRIORITY_FIXES = [("NOT SPECIFIED", "NONE"), ("-", " "), ("4 NONE", "9 NONE")]


@query(
    "scan_period_range",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
       WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31'""",
)
def scan_period_range(spark, folder):
    return sources.read_periods(
        spark,
        f"{folder}/orders.parquet",
        "o_orderdate",
        "1996-01-01",
        "1998-12-31",
        columns=["o_orderkey", "o_custkey", "o_totalprice"],
    )


@query(
    "filter_isin",
    """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
       WHERE o_orderstatus = 'O' AND o_orderpriority IN ('1-URGENT', '2-HIGH')""",
)
def filter_isin(spark, folder):
    kept = fx.filter_rows(
        table(spark, folder, "orders"),
        equal={"o_orderstatus": "O"},
        isin={"o_orderpriority": ["1-URGENT", "2-HIGH"]},
    )
    return kept.select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query(
    "drop_rename",
    "SELECT o_orderkey, o_custkey AS entity_id, o_totalprice AS amount, o_orderdate FROM orders",
)
def drop_rename(spark, folder):
    kept = fx.drop_columns(table(spark, folder, "orders"), "o_orderstatus", "o_orderpriority")
    return fx.rename(kept, {"o_custkey": "entity_id", "o_totalprice": "amount"})


@query(
    "filter_not_equal_keep_null",
    f"WITH {roles.DOC_LABELS} SELECT doc_id, quality FROM doc_labels WHERE quality IS DISTINCT FROM 1",
)
def filter_not_equal_keep_null(spark, folder):
    docs = roles.doc_labels(spark, folder)
    return docs.filter(fx.not_equal_keep_null("quality", 1)).select("doc_id", "quality")


@query(
    "filter_not_in",
    """SELECT o_orderkey, o_orderpriority FROM orders
       WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW')""",
)
def filter_not_in(spark, folder):
    orders = table(spark, folder, "orders")
    return orders.filter(fx.not_in_list("o_orderpriority", ["1-URGENT", "5-LOW"])).select(
        "o_orderkey", "o_orderpriority"
    )


@query(
    "dropna_subset",
    f"""WITH {roles.DOC_LABELS} SELECT doc_id, lang, quality, toxic FROM doc_labels
        WHERE quality IS NOT NULL AND toxic IS NOT NULL""",
)
def dropna_subset(spark, folder):
    docs = fx.drop_missing(roles.doc_labels(spark, folder), ["quality", "toxic"])
    return docs.select("doc_id", "lang", "quality", "toxic")


@query(
    "fill_defaults",
    f"""WITH {roles.DOC_LABELS} SELECT doc_id, coalesce(quality, 260) AS quality,
        coalesce(toxic, 0) AS toxic, lang FROM doc_labels""",
)
def fill_defaults(spark, folder):
    docs = roles.doc_labels(spark, folder).select("doc_id", "quality", "toxic", "lang")
    return fx.fill_defaults(docs, {"quality": 260})


@query(
    "coerce_cast",
    """SELECT p_partkey, try_cast(replace(p_brand, 'Brand#', '') AS INTEGER) AS brand_no,
       try_cast(p_brand AS DOUBLE) AS brand_value, cast(p_size AS VARCHAR) AS size_text
       FROM part""",
)
def coerce_cast(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey",
        fx.coerce_number(fx.replace_literals("p_brand", [("Brand#", "")]), "int").alias("brand_no"),
        fx.coerce_number("p_brand").alias("brand_value"),
        F.col("p_size").cast("string").alias("size_text"),
    )


@query(
    "string_replace_chain",
    """SELECT o_orderkey, replace(replace(replace(o_orderpriority, 'NOT SPECIFIED', 'NONE'),
       '-', ' '), '4 NONE', '9 NONE') AS priority FROM orders""",
)
def string_replace_chain(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", fx.replace_literals("o_orderpriority", PRIORITY_FIXES).alias("priority")
    )


@query(
    "composite_key",
    """SELECT o_orderkey, year(o_orderdate) || '_' || lpad(cast(month(o_orderdate) AS VARCHAR), 2, '0')
       || '_' || o_orderstatus || '_' || o_orderpriority AS period_key FROM orders""",
)
def composite_key(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        fx.period_key(
            F.year("o_orderdate"), F.month("o_orderdate"), "o_orderstatus", "o_orderpriority"
        ).alias("period_key"),
    )


@query(
    "row_sums",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       round(l_quantity + l_extendedprice + l_tax, 4) AS volume_total,
       round(l_discount + l_tax, 4) AS rate_total FROM lineitem""",
)
def row_sums(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.round(fx.row_sum("l_quantity", "l_extendedprice", "l_tax"), 4).alias("volume_total"),
        F.round(fx.row_sum("l_discount", "l_tax"), 4).alias("rate_total"),
    )


@query(
    "weighted_score",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       round(l_quantity * 6 + l_discount * 2 + l_tax * 4, 4) AS score FROM lineitem""",
)
def weighted_score(spark, folder):
    weights = {"l_quantity": 6, "l_discount": 2, "l_tax": 4}
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.round(fx.weighted_sum(weights), 4).alias("score"),
    )


@query(
    "time_index",
    f"SELECT o_orderkey, {roles.sql_month_index('o_orderdate')} AS time_index FROM orders",
)
def time_index(spark, folder):
    index = fx.time_index(F.year("o_orderdate"), F.month("o_orderdate")).cast("int")
    return table(spark, folder, "orders").select("o_orderkey", index.alias("time_index"))


@query(
    "flags",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       cast(l_returnflag = 'R' AS INTEGER) AS returned,
       cast(l_returnflag = l_linestatus AS INTEGER) AS same_code FROM lineitem""",
)
def flags(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        fx.flag(F.col("l_returnflag") == "R").alias("returned"),
        fx.flag(F.col("l_returnflag") == F.col("l_linestatus")).alias("same_code"),
    )


@query(
    "conditional_pick",
    f"""WITH {roles.FLOW} SELECT time_index, seller, buyer,
        CASE WHEN seller < buyer THEN revenue ELSE cast(quantity AS DOUBLE) END AS picked,
        CASE WHEN time_index >= 199701 THEN 18 ELSE 17 END AS n_periods FROM flow""",
)
def conditional_pick(spark, folder):
    return roles.flow(spark, folder).select(
        "time_index",
        "seller",
        "buyer",
        fx.pick(
            F.col("seller") < F.col("buyer"), "revenue", F.col("quantity").cast("double")
        ).alias("picked"),
        fx.season_length("time_index", 17, [(199701, 18)]).alias("n_periods"),
    )


@query(
    "min_streak",
    f"""WITH {roles.UD},
    placed AS (SELECT *, row_number() OVER w AS pos,
                 max(CASE WHEN NOT active THEN day END) OVER w AS miss FROM ud
               WINDOW w AS (PARTITION BY user_id ORDER BY day))
    SELECT user_id, day, cast(pos - coalesce(miss, 0) AS BIGINT) AS streak FROM placed
    WHERE pos - coalesce(miss, 0) > 3""",
)
def min_streak(spark, folder):
    rows = windows.add_streak(roles.ud(spark, folder), *roles.USER_DAY, active="active")
    return fx.min_streak(rows, "streak", 3).select(
        "user_id", "day", F.col("streak").cast("bigint").alias("streak")
    )


@query(
    "drop_placeholder",
    f"WITH {roles.UD_KIND} SELECT user_id, day, kind, x FROM udk WHERE kind IS NOT NULL",
)
def drop_placeholder(spark, folder):
    rows = fx.drop_placeholder(roles.ud_kind(spark, folder), "kind")
    return rows.select("user_id", "day", "kind", "x")


@query(
    "select_by_type",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       l_discount, l_tax FROM lineitem""",
)
def select_by_type(spark, folder):
    lineitem = table(spark, folder, "lineitem")
    numeric, _ = fx.columns_by_type(lineitem)
    return lineitem.select(*numeric)
