"""Join lap, tyre, weather and prior-season features onto the gold table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwise.functions.scalars import flag, ratio
from lapwise.operators import form
from lapwise.operators.groups import calendar_join, first_shared_key, group_stats, left_enrich, median, prior_period
from lapwise.operators.ordered import BOUNDED, HotGroups, with_rank
from lapwise.operators.rating import against_field
from lapwise.operators.regression import stint_slope
from lapwise.plans import gold

RACE = ("season", "round")

# The clean-lap limit, the reliability limit, and the prior-season defaults.
CLEAN_LIMIT = 1.15
RELIABLE_FIT = 0.3
PRIOR_DEFAULTS = {"prev_season_position": 20, "prev_season_points": 0.0, "prev_season_wins": 0}
STINT_COMPOUNDS = ("SOFT", "MEDIUM", "HARD")


def clean_laps(laps: DataFrame, seconds: str = "LapTime_seconds", hot: HotGroups | None = None) -> DataFrame:
    """Laps with a positive time below the limit times the race median."""
    timed = laps.filter(F.col(seconds).isNotNull() & (F.col(seconds) > 0))
    middle = median(timed, RACE, seconds, "__median", hot)
    out = calendar_join(timed, middle, RACE)
    return out.filter(F.col(seconds) < CLEAN_LIMIT * F.col("__median")).drop("__median")


def tire_degradation(
    laps: DataFrame, seconds: str = "LapTime_seconds", age: str = "TyreLife", driver: str = "Driver"
) -> DataFrame:
    """Slope and fit of lap time on tyre age per stint, with the stint's most frequent compound."""
    group = "Stint" if "Stint" in laps.columns else "Compound"
    slopes = stint_slope(laps, [*RACE, driver, group], age, seconds, "tire_deg_slope", "tire_deg_r2")
    if group == "Compound":
        return slopes
    # Most laps first, then the alphabetically first compound.
    counts = laps.groupBy(*RACE, driver, group, "Compound").agg(F.count(F.lit(1)).alias("__n"))
    main = counts.groupBy(*RACE, driver, group).agg(
        F.min_by("Compound", F.struct((-F.col("__n")).alias("n"), F.col("Compound").alias("c"))).alias("Compound")
    )
    return left_enrich(slopes, main, [*RACE, driver, group], hot=BOUNDED)


def reliable(deg: DataFrame) -> DataFrame:
    return deg.filter(F.col("tire_deg_slope").isNotNull() & (F.col("tire_deg_r2") > RELIABLE_FIT))


def tire_features(deg: DataFrame, driver: str = "Driver") -> DataFrame:
    """Per driver and race over reliable stints: mean, max, min, count and mean per compound, in one pass."""
    slope = F.col("tire_deg_slope")
    out = reliable(deg).groupBy(*RACE, driver).agg(
        F.avg(slope).alias("avg_tire_deg_slope"),
        F.max(slope).alias("max_tire_deg_slope"),
        F.min(slope).alias("min_tire_deg_slope"),
        F.count(slope).alias("stint_count_tire"),
        *[F.avg(F.when(F.col("Compound") == c, slope)).alias(f"{c.lower()}_deg_slope") for c in STINT_COMPOUNDS],
    )
    return form.rolling_mean(out, [driver], RACE, {"driver_avg_deg_5": F.col("avg_tire_deg_slope")}, 5, BOUNDED)


def lap_features(
    laps: DataFrame, seconds: str = "LapTime_seconds", driver: str = "Driver", hot: HotGroups | None = None,
    by_driver: HotGroups | None = None,
) -> DataFrame:
    """Per driver and race: pace on clean laps, consistency, stints, and their form.

    `hot` describes the races, `by_driver` the drivers within a race.
    """
    entry = [*RACE, driver]
    clean = clean_laps(laps, seconds, hot)
    out = clean.groupBy(*entry).agg(
        F.avg(seconds).alias("avg_lap_time"),
        F.stddev_samp(seconds).alias("lap_consistency"),
        F.min(seconds).alias("best_lap_time"),
        F.max("LapNumber").alias("laps_completed_actual"),
        F.max("TyreLife").alias("max_tyre_life"),
    )
    out = pace(out)
    out = left_enrich(out, stint_counts(laps, driver, by_driver), entry, hot=BOUNDED)
    return form.rolling_mean(out, [driver], RACE, {"driver_consistency_5": F.col("lap_consistency")}, 5, BOUNDED)


def pace(entries: DataFrame) -> DataFrame:
    """Mean lap against the field mean, and best lap in per cent over the race best."""
    field = {"__mean": F.avg("avg_lap_time"), "__best": F.min("best_lap_time")}
    df = group_stats(entries, RACE, field, calendar=True)
    return df.select(
        "*",
        (F.col("avg_lap_time") - F.col("__mean")).alias("pace_vs_field"),
        ratio((F.col("best_lap_time") - F.col("__best")) * 100, F.col("__best")).alias("best_lap_pct"),
    ).drop("__mean", "__best")


def stint_counts(
    laps: DataFrame, driver: str = "Driver", hot: HotGroups | None = None, position: str | None = None
) -> DataFrame:
    """Number of compound changes in lap order, the first lap included."""
    entry = [*RACE, driver]
    runs = form.running_islands(laps, entry, ["LapNumber"], "Compound", "__stint", "__age", hot, position)
    return runs.groupBy(*entry).agg(F.max("__stint").alias("num_stints"))


def prior_season(gold: DataFrame, standings: DataFrame, key: str = "driver_id", hot: HotGroups | None = None) -> DataFrame:
    """Last season's final standing of the driver, with defaults and champion / top-3 / top-5 flags."""
    df = prior_period(
        gold, standings, key, "season",
        {"position": "prev_season_position", "points": "prev_season_points", "wins": "prev_season_wins"},
        PRIOR_DEFAULTS, hot,
    )
    p = F.col("prev_season_position")
    return df.select(
        "*",
        flag(p == 1).alias("is_prev_champion"),
        flag(p <= 3).alias("is_prev_top3"),
        flag(p <= 5).alias("is_prev_top5"),
    )


def merge_by_code(gold: DataFrame, extra: DataFrame, driver: str = "Driver", candidates: Sequence[str] = ("driver_code", "driver_id")) -> DataFrame:
    """Join lap-source features, whose drivers are named by code or id, whichever gold has."""
    extra = extra.withColumnsRenamed({driver: next(c for c in candidates if c in gold.columns)})
    key = first_shared_key(gold, extra, candidates)
    return left_enrich(gold, extra, [*RACE, key], hot=BOUNDED)


def coverage(df: DataFrame, column: str) -> DataFrame:
    """Share of rows that a join filled, in per cent."""
    return df.agg((F.avg(F.col(column).isNotNull().cast("int")) * 100).alias("coverage_pct"))


def season_table(master: DataFrame, hot: HotGroups | None = None) -> DataFrame:
    """Final standings per season from race points: points, wins, competition rank."""
    totals = master.groupBy("season", "driver_id").agg(
        F.sum("points").alias("points"), F.sum(flag(F.col("position") == 1)).alias("wins")
    )
    totals = totals.withColumn("points", F.round("points", 6))
    return with_rank(totals, ["season"], "points", "position", hot=hot)


def complete_features(
    master: DataFrame, weather: DataFrame, ratings: DataFrame, lap_table: DataFrame, tire_table: DataFrame, standings: DataFrame,
    races: HotGroups | None = None,
) -> DataFrame:
    """The wide table: base features, then weather, advanced features, prior season, tyres and laps.

    `master` is unique per race and driver, and so are all tables joined to it.
    """
    # All driver windows first: they share one shuffle.
    df = gold.season_points(gold.circuit_history(gold.rolling_form(master)))
    df = gold.ewm_form(gold.streaks(gold.targets(df)))
    # Statistics come from the master table, so the plan grows by a scan per step and does not double.
    df = gold.championship(df, races, gold.season_points(master))
    df = gold.constructor_form(df, hot=races, source=master)
    df = gold.quali_vs_teammate(df, races, master)
    df = gold.field_context(df, master)
    df = gold.season_phase(df, master)
    df = gold.circuit_risk(df, source=master)
    df = calendar_join(df, weather, RACE)
    df = gold.interactions(against_field(df, ratings, RACE, "driver_id", master))
    df = prior_season(df, standings, hot=BOUNDED)
    df = merge_by_code(df, tire_table)
    return merge_by_code(df, lap_table).drop(*gold.LEAKY)


def added_columns(before: DataFrame, after: DataFrame) -> list[str]:
    """Columns that a step added."""
    return [c for c in after.columns if c not in set(before.columns)]
