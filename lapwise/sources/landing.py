"""Nested landing JSON and session samples, flattened to bronze rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapwise.functions.scalars import full_name, seconds_of_intervals
from lapwise.operators.groups import left_enrich
from lapwise.operators.ordered import HotGroups


def read_pages(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All pages of one endpoint; reading the folder is the union of the pages."""
    return spark.read.schema(schema).json(path)


def page_totals(pages: DataFrame, items: Column) -> DataFrame:
    """Compare the items received with the total that the pages announce."""
    return pages.agg(
        F.sum(F.greatest(F.coalesce(F.size(items), F.lit(0)), F.lit(0))).cast("long").alias("received"),
        F.max(F.col("MRData.total").try_cast("long")).alias("announced"),
    ).withColumn("complete", F.col("received") == F.col("announced"))


def _races(pages: DataFrame) -> DataFrame:
    return pages.select(F.explode_outer("MRData.RaceTable.Races").alias("race"))


def _whole(text: Column) -> Column:
    """Digits only, else null."""
    return F.when(text.rlike(r"^\d+$"), text.try_cast("int"))


def flatten_results(pages: DataFrame) -> DataFrame:
    rows = _races(pages).select("race", F.explode_outer("race.Results").alias("r"))
    return rows.select(
        F.col("race.season").try_cast("int").alias("season"),
        F.col("race.round").try_cast("int").alias("round"),
        F.col("race.raceName").alias("race_name"),
        F.col("race.Circuit.circuitId").alias("circuit_id"),
        F.col("race.Circuit.circuitName").alias("circuit_name"),
        F.to_date("race.date").alias("race_date"),
        F.col("r.Driver.driverId").alias("driver_id"),
        F.coalesce("r.Driver.code", F.lit("")).alias("driver_code"),
        full_name(F.col("r.Driver.givenName"), F.col("r.Driver.familyName")).alias("driver_name"),
        F.col("r.Constructor.constructorId").alias("constructor_id"),
        F.col("r.Constructor.name").alias("constructor_name"),
        F.col("r.grid").try_cast("int").alias("grid"),
        _whole(F.col("r.position")).alias("position"),
        F.col("r.points").try_cast("double").alias("points"),
        F.col("r.status").alias("status"),
        F.col("r.laps").try_cast("int").alias("laps_completed"),
        F.col("r.Time.millis").try_cast("long").alias("time_millis"),
        F.col("r.FastestLap.rank").alias("fastest_lap_rank"),
        F.col("r.FastestLap.Time.time").alias("fastest_lap_time"),
        F.col("r.FastestLap.AverageSpeed.speed").alias("avg_speed_kph"),
        F.current_timestamp().alias("_ingested_at"),
    )


def flatten_qualifying(pages: DataFrame) -> DataFrame:
    rows = _races(pages).select("race", F.explode_outer("race.QualifyingResults").alias("r"))
    return rows.select(
        F.col("race.season").try_cast("int").alias("season"),
        F.col("race.round").try_cast("int").alias("round"),
        F.col("race.raceName").alias("race_name"),
        F.col("race.Circuit.circuitId").alias("circuit_id"),
        F.col("r.Driver.driverId").alias("driver_id"),
        full_name(F.col("r.Driver.givenName"), F.col("r.Driver.familyName")).alias("driver_name"),
        F.col("r.Constructor.constructorId").alias("constructor_id"),
        F.col("r.position").try_cast("int").alias("position"),
        F.col("r.Q1").alias("q1"),
        F.col("r.Q2").alias("q2"),
        F.col("r.Q3").alias("q3"),
        F.current_timestamp().alias("_ingested_at"),
    )


def flatten_pit_stops(pages: DataFrame) -> DataFrame:
    """Only the first race of a page counts; pages without one give no rows."""
    rows = pages.select(F.get("MRData.RaceTable.Races", F.lit(0)).alias("race"))
    rows = rows.select("race", F.explode("race.PitStops").alias("s"))
    return rows.select(
        F.col("race.season").try_cast("int").alias("season"),
        F.col("race.round").try_cast("int").alias("round"),
        F.col("race.raceName").alias("race_name"),
        F.col("s.driverId").alias("driver_id"),
        F.col("s.stop").try_cast("int").alias("stop_number"),
        F.col("s.lap").try_cast("int").alias("lap"),
        F.col("s.time").alias("time_of_day"),
        F.col("s.duration").alias("duration"),
        F.current_timestamp().alias("_ingested_at"),
    )


def flatten_standings(pages: DataFrame) -> DataFrame:
    """The first standings list of a page and the first team of a driver count."""
    rows = pages.select(F.get("MRData.StandingsTable.StandingsLists", F.lit(0)).alias("list"))
    rows = rows.select("list.season", F.explode("list.DriverStandings").alias("s"))
    team = F.get("s.Constructors", F.lit(0))
    return rows.select(
        F.col("season").try_cast("int").alias("season"),
        F.col("s.Driver.driverId").alias("driver_id"),
        full_name(F.col("s.Driver.givenName"), F.col("s.Driver.familyName")).alias("driver_name"),
        team["constructorId"].alias("constructor_id"),
        team["name"].alias("constructor_name"),
        F.col("s.position").try_cast("int").alias("position"),
        F.col("s.points").try_cast("double").alias("points"),
        F.col("s.wins").try_cast("int").alias("wins"),
        F.current_timestamp().alias("_ingested_at"),
    )


def land_session(df: DataFrame, season: int, round_: int, session_type: str, event_name: str) -> DataFrame:
    """Session laps or weather samples with their metadata; interval columns become seconds."""
    return seconds_of_intervals(df).select(
        "*",
        F.lit(season).alias("season"),
        F.lit(round_).alias("round"),
        F.lit(session_type).alias("session_type"),
        F.lit(event_name).alias("event_name"),
        F.current_timestamp().alias("_ingested_at"),
    )


def tag_telemetry(
    samples: DataFrame, laps: DataFrame, keys: Sequence[str], drivers: Sequence | None = None,
    hot: HotGroups | None = None,
) -> DataFrame:
    """Samples with the compound (`UNKNOWN` if missing) and tyre age of their lap; optionally some drivers only."""
    if drivers is not None:
        samples = samples.filter(F.col("Driver").isin(list(drivers)))
    tags = laps.select(*keys, "Compound", "TyreLife")
    return left_enrich(samples, tags, keys, {"Compound": "UNKNOWN"}, hot)
