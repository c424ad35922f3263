"""The generic test tables seen as contests, laps, stops, standings and weather.

Each view exists twice: as a DataFrame for the queries and as a SQL common
table expression for the checks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapwise.functions.scalars import best_of
from lapwise.operators import form
from lapwise.operators.ordered import BOUNDED, HotGroups, hot_groups, hot_row_limit, with_position, with_rank

RACE = ["season", "round"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(column: str):
    """Cents as exact decimals, so that sums do not depend on the order of rows."""
    return F.col(column).cast("decimal(18,2)")


def cents(column: str):
    """A whole number of cents as a double: sums of these are exact in any order of rows."""
    return F.round(F.col(column) * 100)


# Results of the size check per (session, folder, limit, name); the tables do not change.
_CHECKED: dict[tuple, HotGroups] = {}


def checked(df: DataFrame, sf_dir: str, name: str, by: Sequence[str]) -> HotGroups:
    spark = df.sparkSession
    key = (spark.sparkContext.applicationId, sf_dir, hot_row_limit(spark), name, tuple(by))
    if key not in _CHECKED:
        _CHECKED[key] = hot_groups(df, by)
    return _CHECKED[key]


def calendar_columns(day):
    """Season is the ISO year and week, round the ISO weekday."""
    season = F.extract(F.lit("YEAROFWEEK"), day) * 100 + F.weekofyear(day)
    return [season.cast("int").alias("season"), (F.weekday(day) + 1).cast("int").alias("round")]


DAILY_SQL = """
daily AS (
  SELECT CAST(isoyear(CAST(ts AS DATE)) * 100 + week(CAST(ts AS DATE)) AS INTEGER) AS season,
         CAST(isodow(CAST(ts AS DATE)) AS INTEGER) AS round,
         CAST(ts AS DATE) AS race_date, user_id AS driver_id, user_id % 10 AS constructor_id,
         CAST(isodow(CAST(ts AS DATE)) AS INTEGER) AS circuit_id,
         sum(round(value * 100)) AS points,
         min(ts) AS first_ts, bool_or(event_type = 'error') AS dnf,
         min(CASE WHEN event_type = 'view' THEN round(value * 100) END) AS q1_seconds,
         min(CASE WHEN event_type = 'click' THEN round(value * 100) END) AS q2_seconds,
         min(CASE WHEN event_type = 'purchase' THEN round(value * 100) END) AS q3_seconds,
         count(*) FILTER (WHERE event_type = 'click') AS num_pit_stops
  FROM events GROUP BY ALL)"""

CONTEST_SQL = (
    DAILY_SQL
    + """,
placed AS (
  SELECT *, least(q1_seconds, q2_seconds, q3_seconds) AS best_quali_seconds,
         row_number() OVER (PARTITION BY season, round ORDER BY points DESC, driver_id) AS classified,
         row_number() OVER (PARTITION BY season, round ORDER BY first_ts, driver_id) AS grid
  FROM daily),
contest AS (SELECT *, CASE WHEN NOT dnf THEN classified END AS position FROM placed)"""
)


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    day = F.to_date("ts").alias("race_date")
    kind = F.col("event_type")
    rows = events.groupBy(day, F.col("user_id").alias("driver_id")).agg(
        F.sum(cents("value")).alias("points"),
        F.min("ts").alias("first_ts"),
        F.bool_or(kind == "error").alias("dnf"),
        F.min(F.when(kind == "view", cents("value"))).alias("q1_seconds"),
        F.min(F.when(kind == "click", cents("value"))).alias("q2_seconds"),
        F.min(F.when(kind == "purchase", cents("value"))).alias("q3_seconds"),
        F.count(F.when(kind == "click", 1)).alias("num_pit_stops"),
    )
    race = calendar_columns(F.col("race_date"))
    return rows.select(
        *race, "race_date", "driver_id", (F.col("driver_id") % 10).alias("constructor_id"), race[1].alias("circuit_id"),
        "points", "first_ts", "dnf", "q1_seconds", "q2_seconds", "q3_seconds", "num_pit_stops",
    )


def races_of(spark: SparkSession, sf_dir: str) -> HotGroups:
    """Which races of the contest have too many entries for one task."""
    return checked(daily(spark, sf_dir).select(*RACE), sf_dir, "daily", RACE)


def contest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per race (a day) and driver (a user); a driver with an error event has no finish."""
    hot = races_of(spark, sf_dir)
    df = daily(spark, sf_dir)
    df = with_position(df, RACE, [F.col("points").desc(), "driver_id"], "classified", hot)
    df = with_position(df, RACE, ["first_ts", "driver_id"], "grid", hot)
    return df.select(
        "*",
        best_of("q1_seconds", "q2_seconds", "q3_seconds").alias("best_quali_seconds"),
        F.when(~F.col("dnf"), F.col("classified")).alias("position"),
    )


# ---- laps -------------------------------------------------------------------

# Event types as tyre compounds; errors stay unknown.
EVENT_COMPOUNDS = {"view": "SOFT", "click": "MEDIUM", "purchase": "HARD", "signup": "INTERMEDIATE"}

COMPOUND_CASE = (
    "CASE event_type " + " ".join(f"WHEN '{e}' THEN '{c}'" for e, c in EVENT_COMPOUNDS.items()) + " ELSE 'TEST' END"
)


def laps_sql(grain: str = "day") -> str:
    """Laps of a driver in a race; the race is a day or a week."""
    day = "CAST(ts AS DATE)"
    if grain == "day":
        season, round_ = f"isoyear({day}) * 100 + week({day})", f"isodow({day})"
    else:
        season, round_ = f"isoyear({day})", f"week({day})"
    return f"""
laps0 AS (
  SELECT CAST({season} AS INTEGER) AS season, CAST({round_} AS INTEGER) AS round, user_id AS "Driver",
         {COMPOUND_CASE} AS "Compound", round(value * 100) AS "LapTime_seconds", ts, event_id
  FROM events),
laps1 AS (
  SELECT *, row_number() OVER (PARTITION BY season, round, "Driver" ORDER BY ts, event_id) AS "LapNumber" FROM laps0),
laps2 AS (
  SELECT *, CASE WHEN lag("Compound") OVER w IS NOT DISTINCT FROM "Compound" AND "LapNumber" > 1 THEN 0 ELSE 1 END AS chg
  FROM laps1 WINDOW w AS (PARTITION BY season, round, "Driver" ORDER BY "LapNumber")),
laps3 AS (
  SELECT *, sum(chg) OVER (PARTITION BY season, round, "Driver" ORDER BY "LapNumber") AS "Stint" FROM laps2),
laps AS (
  SELECT *, row_number() OVER (PARTITION BY season, round, "Driver", "Stint" ORDER BY "LapNumber") AS "TyreLife"
  FROM laps3)"""


def lap_rows(spark: SparkSession, sf_dir: str, grain: str = "day") -> DataFrame:
    """Laps without their number: event by event."""
    day = F.to_date("ts")
    if grain == "day":
        race = calendar_columns(day)
    else:
        race = [F.extract(F.lit("YEAROFWEEK"), day).cast("int").alias("season"), F.weekofyear(day).alias("round")]
    compound = F.coalesce(*[F.when(F.col("event_type") == e, F.lit(c)) for e, c in EVENT_COMPOUNDS.items()], F.lit("TEST"))
    return table(spark, sf_dir, "events").select(
        *race, F.col("user_id").alias("Driver"), compound.alias("Compound"), cents("value").alias("LapTime_seconds"), "ts",
        "event_id",
    )


ENTRY = ["season", "round", "Driver"]


def entries_of(spark: SparkSession, sf_dir: str, grain: str = "day") -> HotGroups:
    """Which driver-race entries have too many laps for one task."""
    return checked(lap_rows(spark, sf_dir, grain).select(*ENTRY), sf_dir, f"laps-{grain}", ENTRY)


def lap_races_of(spark: SparkSession, sf_dir: str, grain: str = "day") -> HotGroups:
    return checked(lap_rows(spark, sf_dir, grain).select(*RACE), sf_dir, f"laps-{grain}", RACE)


def numbered_laps(spark: SparkSession, sf_dir: str, grain: str = "day") -> DataFrame:
    hot = entries_of(spark, sf_dir, grain)
    df = with_position(lap_rows(spark, sf_dir, grain), ENTRY, ["ts", "event_id"], "LapNumber", hot)
    return df.drop("ts", "event_id")


def laps(spark: SparkSession, sf_dir: str, grain: str = "day") -> DataFrame:
    """Numbered laps with stints (runs of one compound) and tyre age."""
    df = numbered_laps(spark, sf_dir, grain)
    hot = entries_of(spark, sf_dir, grain)
    return form.running_islands(df, ENTRY, ["LapNumber"], "Compound", "Stint", "TyreLife", hot, "LapNumber")


# ---- stops, standings, weather ------------------------------------------------

STOPS_SQL = """
stops AS (
  SELECT l_orderkey AS entry_id, l_linenumber AS stop_number, max(l_quantity) AS duration_seconds
  FROM lineitem GROUP BY 1, 2)"""


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stop per order line; of lines that share a number the longest counts."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("entry_id"), F.col("l_linenumber").alias("stop_number"))
        .agg(F.max("l_quantity").alias("duration_seconds"))
    )


STANDINGS_SQL = """
totals AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS season, o_custkey AS driver_id,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS points,
         CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS INTEGER) AS wins
  FROM orders GROUP BY 1, 2),
standings AS (SELECT *, CAST(rank() OVER (PARTITION BY season ORDER BY points DESC) AS INTEGER) AS position FROM totals)"""


def standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Season standings of customers by order value."""
    totals = table(spark, sf_dir, "orders").groupBy(
        F.year("o_orderdate").alias("season"), F.col("o_custkey").alias("driver_id")
    ).agg(
        F.sum(money("o_totalprice")).cast("double").alias("points"),
        F.count(F.when(F.col("o_orderstatus") == "F", 1)).cast("int").alias("wins"),
    )
    hot = checked(totals.select("season"), sf_dir, "totals", ["season"])
    df = with_rank(totals, ["season"], "points", "position", hot=hot)
    return df.withColumn("position", F.col("position").cast("int"))


WEATHER_SQL = """
samples AS (
  SELECT CAST(isoyear(CAST(ts AS DATE)) * 100 + week(CAST(ts AS DATE)) AS INTEGER) AS season,
         CAST(isodow(CAST(ts AS DATE)) AS INTEGER) AS round,
         floor(value) AS track_temp, floor(value) / 2 AS air_temp, CAST(json_extract(props, '$.k') AS DOUBLE) AS humidity,
         CASE WHEN event_type = 'error' THEN value ELSE 0 END AS rainfall
  FROM events)"""


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather samples under source-specific column names."""
    return table(spark, sf_dir, "events").select(
        *calendar_columns(F.to_date("ts")),
        F.floor("value").cast("double").alias("TrackTemp"),
        (F.floor("value").cast("double") / 2).alias("AirTemp"),
        F.get_json_object("props", "$.k").try_cast("double").alias("Humidity"),
        F.when(F.col("event_type") == "error", F.col("value")).otherwise(F.lit(0.0)).alias("Rainfall"),
    )
