"""Bronze to silver: type, dedup, parse, flag, join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwise import schemas
from lapwise.functions import scalars as S
from lapwise.operators.groups import dedup_latest, group_stats, left_enrich
from lapwise.operators.ordered import BOUNDED, HotGroups
from lapwise.session import shared_dir
from lapwise.sources.sinks import write_bucketed

# Rows of a bucket of the stored tables, on average.
ROWS_PER_BUCKET = 1_000_000

RACE = ("season", "round")
ENTRY = (*RACE, "driver_id")
QUALI_COLUMNS = ("best_quali_seconds", "q1_seconds", "q2_seconds", "q3_seconds")


def race_results(bronze: DataFrame) -> DataFrame:
    df = bronze.select(*S.typed(schemas.RACE_RESULTS, bronze.columns))
    df = dedup_latest(df, ENTRY, "_ingested_at")
    return df.select(
        "*",
        S.parse_clock(F.col("fastest_lap_time")).alias("fastest_lap_seconds"),
        S.positions_gained(F.col("grid"), F.col("position")).alias("position_gained"),
        S.is_finished(F.col("status")).alias("finished"),
        (~S.is_finished(F.col("status"))).alias("dnf"),
    ).drop("_ingested_at")


def qualifying(bronze: DataFrame) -> DataFrame:
    df = bronze.select(*S.typed(schemas.QUALIFYING, bronze.columns))
    df = dedup_latest(df, ENTRY, "_ingested_at")
    df = df.select("*", *[S.parse_clock(F.col(q)).alias(f"{q}_seconds") for q in ("q1", "q2", "q3")])
    best = S.best_of("q1_seconds", "q2_seconds", "q3_seconds")
    return df.select("*", best.alias("best_quali_seconds")).drop("_ingested_at")


def pit_stops(bronze: DataFrame, strict: bool = False) -> DataFrame:
    """`strict` nulls durations written as `m:ss.SSS`, as plain numeric coercion would."""
    df = bronze.select(*S.typed(schemas.PIT_STOPS, bronze.columns))
    df = dedup_latest(df, [*ENTRY, "stop_number"], "_ingested_at")
    text = F.col("duration")
    df = df.withColumn("duration_seconds", text.try_cast("double") if strict else S.stop_seconds(text))
    return df.select(
        "*",
        S.exceeds(F.col("duration_seconds"), S.SLOW_STOP_SECONDS).alias("is_slow_stop"),
        S.exceeds(F.col("duration_seconds"), S.PROBLEM_STOP_SECONDS).alias("is_problem_stop"),
    ).drop("_ingested_at")


def lap_delta(laps: DataFrame, race: Sequence[str], lap: str, seconds: str, hot: HotGroups | None = None) -> DataFrame:
    """Seconds behind the fastest car on the same lap number."""
    df = group_stats(laps, [*race, lap], {"__best": F.min(seconds)}, hot)
    return df.withColumn("delta_to_leader_seconds", F.col(seconds) - F.col("__best")).drop("__best")


def laps(bronze: DataFrame, hot: HotGroups | None = None) -> DataFrame:
    df = S.underscored(bronze)
    df = df.select(*S.typed(schemas.LAPS, df.columns))
    df = dedup_latest(df, [*RACE, "Driver", "LapNumber"], "_ingested_at")
    df = df.select("*", S.encode(F.col("Compound")).alias("compound_encoded"))
    return lap_delta(df, RACE, "LapNumber", "LapTime_seconds", hot).drop("_ingested_at")


def stop_summary(stops: DataFrame, keys: Sequence[str] = ENTRY, number: str = "stop_number",
                 seconds: str = "duration_seconds", slow: str = "is_slow_stop") -> DataFrame:
    """One row per entry: stops made, mean and total duration, any slow stop."""
    return stops.groupBy(*keys).agg(
        F.max(number).alias("num_pit_stops"),
        F.avg(seconds).alias("avg_pit_duration"),
        F.sum(seconds).alias("total_pit_time"),
        F.bool_or(slow).cast("int").alias("had_slow_stop"),
    )


def race_master(results: DataFrame, quali: DataFrame, stops: DataFrame) -> DataFrame:
    """Results with qualifying times and the stop summary; all three are unique per entry."""
    df = left_enrich(results, quali.select(*ENTRY, *QUALI_COLUMNS), ENTRY, hot=BOUNDED)
    return left_enrich(df, stop_summary(stops), ENTRY, {"num_pit_stops": 0}, hot=BOUNDED)


def store_bucketed(results: DataFrame, quali: DataFrame, stops: DataFrame, buckets: int | None = None) -> list[DataFrame]:
    """The three tables written by entry into the shared folder, each bucketed alike, so that `race_master` needs no exchange.

    Without `buckets` their number follows from the rows of the largest table.
    """
    tables = {"results": results, "qualifying": quali, "stops": stops}
    if buckets is None:
        buckets = max(1, -(-max(t.count() for t in tables.values()) // ROWS_PER_BUCKET))
    out = []
    for name, table in tables.items():
        path = shared_dir(results.sparkSession, name)
        out.append(write_bucketed(table, f"{name}_{path[-32:]}", path, ENTRY, buckets))
    return out


def weather_features(samples: DataFrame, keys: Sequence[str] = RACE) -> DataFrame:
    """Per-race weather; sample columns are found by name fragments since sources name them differently."""
    track = S.find_column(samples, "track", "temp")
    air = S.find_column(samples, "air", "temp")
    humidity = S.find_column(samples, "humid")
    rain = S.find_column(samples, "rain")
    wanted = []
    if track:
        t = F.col(track).try_cast("double")
        wanted += [F.avg(t).alias("avg_track_temp"), F.max(t).alias("max_track_temp"), F.min(t).alias("min_track_temp")]
    if air:
        wanted.append(F.avg(F.col(air).try_cast("double")).alias("avg_air_temp"))
    if humidity:
        h = F.col(humidity).try_cast("double")
        wanted += [F.max(h).alias("max_humidity"), F.avg(h).alias("avg_humidity")]
    if rain:
        wanted.append(F.max(F.col(rain).try_cast("double")).alias("__rain"))
    df = samples.groupBy(*keys).agg(*wanted) if wanted else samples.select(*keys).distinct()
    made = []
    if track:
        made += [
            (F.col("max_track_temp") - F.col("min_track_temp")).alias("temp_variation"),
            S.flag(F.col("avg_track_temp") > S.HOT_TRACK).alias("is_hot_race"),
            S.flag(F.col("avg_track_temp") < S.COLD_TRACK).alias("is_cold_race"),
        ]
    if rain:
        made.append(S.flag(F.col("__rain") > 0).alias("had_rain"))
    return df.select("*", *made).drop("__rain")
