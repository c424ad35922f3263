"""The ad-hoc question set as SQL over the wide table `race_data`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lapwise.sources.scan import run_sql

ROW_CAP = 20

# {season} and {driver} are filled in by the caller.
QUESTIONS = {
    "most_wins_in_season": """
        SELECT driver_id, CAST(sum(target_winner) AS BIGINT) AS wins FROM race_data WHERE season = {season}
        GROUP BY driver_id ORDER BY wins DESC, driver_id""",
    "mean_finish_of_driver": """
        SELECT driver_id, round(avg(target_position), 6) AS avg_finish FROM race_data WHERE driver_id = {driver}
        GROUP BY driver_id""",
    "team_with_most_podiums": """
        SELECT constructor_id, CAST(sum(target_podium) AS BIGINT) AS podiums FROM race_data
        GROUP BY constructor_id ORDER BY podiums DESC, constructor_id LIMIT 1""",
    "pole_without_win": """
        SELECT season, round, driver_id, target_position FROM race_data WHERE grid = 1 AND target_winner = 0
        ORDER BY season, round""",
    "mean_pole_gap_per_team": """
        SELECT constructor_id, round(avg(quali_gap_to_pole), 6) AS avg_gap FROM race_data WHERE season = {season}
        GROUP BY constructor_id ORDER BY avg_gap, constructor_id""",
    "most_places_gained": """
        SELECT season, round, driver_id, grid - target_position AS gained FROM race_data
        WHERE target_position IS NOT NULL ORDER BY gained DESC, season, round, driver_id""",
    "wins_per_team": """
        SELECT constructor_id, CAST(sum(target_winner) AS BIGINT) AS wins FROM race_data
        GROUP BY constructor_id ORDER BY wins DESC, constructor_id""",
    "top_five_by_rating": """
        SELECT driver_id, round(max(rating), 6) AS rating FROM race_data
        GROUP BY driver_id ORDER BY rating DESC, driver_id LIMIT 5""",
}


def store_race_data(race_data: DataFrame, path: str) -> DataFrame:
    """Write the wide table with one folder per season and read it back.

    Rows of a season are gathered so that it has few files; a large season is
    split into several. A question that names a season, also by a subquery,
    then reads that season's files only.
    """
    race_data.hint("rebalance", "season").write.mode("overwrite").partitionBy("season").parquet(path)
    return stored_race_data(race_data.sparkSession, path)


def stored_race_data(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def ask(race_data: DataFrame, name: str, **values) -> DataFrame:
    """Answer one question; at most ROW_CAP rows, as on the ad-hoc page."""
    text = QUESTIONS[name].format(**values)
    return run_sql(race_data.sparkSession, {"race_data": race_data}, text, ROW_CAP)
