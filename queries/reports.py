"""Published predictions and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelweave.plans import report
from queries import roles
from queries.registry import query, table


def published_rows(spark, folder):
    """Predictions of user-days with the customer's name, segment and nation."""
    customer = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("player_display_name"),
        F.col("c_mktsegment").alias("position"),
        F.col("c_nationkey").alias("n_nationkey"),
        F.when(F.col("c_acctbal") >= 4500, 1).otherwise(2).alias("depth_team"),
        F.when(F.col("c_custkey") % 5 > 0, "ACT").otherwise("INA").alias("status"),
    )
    nation = table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("recent_team"))
    return (
        roles.pred(spark, folder)
        .join(customer, "user_id")
        .join(nation, "n_nationkey")
        .select(
            F.lit(2024).alias("season"),
            F.col("day").alias("week"),
            "player_display_name",
            "position",
            "recent_team",
            F.col("position").alias("opponent_team"),
            "depth_team",
            "status",
            F.round("p", 6).alias("predicted_fantasy_points"),
            F.col("y").alias("fantasy_points"),
        )
    )


PUBLISHED = f"""{roles.PRED},
published AS (
  SELECT 2024 AS season, day AS week, c_name AS player_display_name, c_mktsegment AS position,
    n_name AS recent_team, c_mktsegment AS opponent_team,
    round(p, 6) AS predicted_fantasy_points, y AS fantasy_points
  FROM pred JOIN customer ON c_custkey = user_id JOIN nation ON n_nationkey = c_nationkey
  WHERE c_acctbal >= 4500 AND c_custkey % 5 > 0)"""


@query("publish_output", f"WITH {PUBLISHED} SELECT * FROM published")
def publish_output(spark, folder):
    return report.publish_individual(published_rows(spark, folder))


SHOWN = """season AS "Season", week AS "Week", player_display_name AS "Player Name",
  position AS "Position", recent_team AS "Recent Team", opponent_team AS "Opponent Team",
  predicted_fantasy_points AS "Predicted Fantasy Points", fantasy_points AS "Actual Fantasy Points\""""


@query(
    "report_filtered",
    f"""WITH {PUBLISHED} SELECT {SHOWN} FROM published
    WHERE week IN (10, 11, 12) AND position IN ('BUILDING', 'MACHINERY')""",
)
def report_filtered(spark, folder):
    published = report.publish_individual(published_rows(spark, folder))
    return report.report(
        published, {"season": [], "week": [10, 11, 12], "position": ["BUILDING", "MACHINERY"]}
    )


@query(
    "report_sorted",
    f"""WITH {PUBLISHED} SELECT {SHOWN} FROM published
    ORDER BY season DESC, week DESC, predicted_fantasy_points DESC""",
)
def report_sorted(spark, folder):
    return report.report(report.publish_individual(published_rows(spark, folder)))
