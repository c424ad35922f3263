"""Report aggregates: season tables, result cards, error tables, briefings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwise.functions.scalars import numeric_columns
from lapwise.operators.groups import latest_period, quantiles, row_at_max, top_rows
from lapwise.operators.ordered import HotGroups
from lapwise.operators.quality import health_status

RACE = ("season", "round")


def driver_season_stats(gold: DataFrame, by: Sequence[str] = ("driver_id",)) -> DataFrame:
    return gold.groupBy(*by).agg(
        F.avg("target_position").alias("avg_finish"),
        F.min("target_position").alias("best_finish"),
        F.avg("grid").alias("avg_grid"),
        F.count(F.lit(1)).alias("races"),
        F.sum("target_podium").alias("podiums"),
        F.sum("target_winner").alias("wins"),
    )


def standings_after_latest(gold: DataFrame, n: int = 10) -> DataFrame:
    """Top drivers by points in the latest race's table."""
    last = latest_period(gold, RACE)
    table = last.groupBy("driver_id").agg(F.max("season_cumulative_points").alias("points"))
    return top_rows(table, [F.col("points").desc(), F.col("driver_id")], n)


def constructor_standings(gold: DataFrame, points: str = "points") -> DataFrame:
    """Points per team and season; the number of entries where points are not known."""
    total = F.sum(points) if points in gold.columns else F.count(F.lit(1)).cast("double")
    return gold.groupBy("season", "constructor_id").agg(total.alias("points"))


def places_gained(gold: DataFrame) -> DataFrame:
    return gold.groupBy("driver_id").agg(F.avg(F.col("grid") - F.col("target_position")).alias("avg_gained"))


def extreme_rows(gold: DataFrame, score: Column, outputs: Sequence[str], tie: str, by: Sequence[str] = ()) -> DataFrame:
    """The rows with the greatest and the smallest score."""
    high = row_at_max(gold, by, score, outputs, tie).withColumn("extreme", F.lit("max"))
    low = row_at_max(gold, by, -score, outputs, tie).withColumn("extreme", F.lit("min"))
    return high.unionByName(low)


def worst_groups(scored: DataFrame, by: str, n: int = 3) -> DataFrame:
    """The groups with the largest mean absolute error."""
    errors = scored.groupBy(F.col(by).cast("string").alias("name")).agg(F.avg("abs_error").alias("mean_abs_error"))
    return top_rows(errors, [F.col("mean_abs_error").desc(), F.col("name")], n)


def distribution(df: DataFrame, by: Sequence[str], value: str, hot: HotGroups | None = None) -> DataFrame:
    """Five-number summary per group."""
    return quantiles(df, by, value, {"low": 0.0, "q1": 0.25, "mid": 0.5, "q3": 0.75, "high": 1.0}, hot)


def roster(gold: DataFrame) -> DataFrame:
    """Distinct drivers per team and season, counted."""
    return gold.groupBy("season", "constructor_id").agg(F.countDistinct("driver_id").alias("drivers"))


def headcount(gold: DataFrame) -> DataFrame:
    return gold.agg(
        F.countDistinct("driver_id").alias("drivers"),
        F.countDistinct("constructor_id").alias("teams"),
        F.countDistinct("season").alias("seasons"),
    )


def quick_stats(result: DataFrame) -> DataFrame:
    """Min, max and mean of the last numeric column of a result."""
    last = numeric_columns(result)[-1]
    return result.agg(
        F.min(last).cast("double").alias("min_value"),
        F.max(last).cast("double").alias("max_value"),
        F.avg(last).cast("double").alias("mean_value"),
    ).withColumn("column_name", F.lit(last))


def result_cards(gold: DataFrame) -> DataFrame:
    """Per race: winner with team and grid, second, third, number of finishers.

    Conditional maxima instead of a sorted list, so a race never has to fit into one buffer.
    """
    at = lambda place, c: F.max(F.when(F.col("target_position") == place, F.col(c)))
    return gold.groupBy(*RACE).agg(
        at(1, "driver_id").alias("winner"), at(1, "constructor_id").alias("winner_team"), at(1, "grid").alias("winner_grid"),
        at(2, "driver_id").alias("second"), at(3, "driver_id").alias("third"),
        F.count("target_position").alias("finishers"),
    )


def briefing_line(latest: Column, status: Column, rows: Column, accepted: Column, mae: Column, retrain: Column) -> Column:
    return F.format_string(
        "%s | data %s, %d rows | %d features accepted | MAE %.3f | retrain %s", latest, status, rows, accepted, mae, retrain
    )


def latest_summary(gold: DataFrame, rules: DataFrame, features: DataFrame, metrics: DataFrame, n: int = 10) -> DataFrame:
    """One JSON document about the latest race: top finishers with grid, health, accepted features, metrics."""
    last = latest_period(gold, RACE).filter(F.col("target_position").isNotNull())
    top = top_rows(last, [F.col("target_position"), F.col("driver_id")], n)
    # n rows, a fixed rule list, a fixed candidate list and a metrics table: all sides have one row.
    top = top.agg(
        F.max("season").alias("season"), F.max("round").alias("round"),
        F.to_json(F.array_sort(F.collect_list(F.struct("target_position", "driver_id", "grid")))).alias("top"),
    ).withColumn("k", F.lit(1))
    health = health_status(rules).withColumn("k", F.lit(1))
    found = features.agg(F.count(F.when(F.col("accepted"), 1)).alias("accepted_features")).withColumn("k", F.lit(1))
    return top.join(health, "k").join(found, "k").join(metrics.withColumn("k", F.lit(1)), "k").drop("k")
