"""Silver to gold: features known before the race, targets, and the in-race extras."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapwise.functions.scalars import flag, ratio
from lapwise.operators import form
from lapwise.operators.groups import calendar_join, group_stats, left_enrich
from lapwise.operators.ordered import BOUNDED, HotGroups, expanding, rolling, with_rank

RACE = ("season", "round")
ORDER = ("season", "round")

# Defaults for missing history.
DEFAULT_RATING = 1500.0
DEFAULT_CHAOS = 5.0
DEFAULT_DNF_RATE = 0.1
DEFAULT_TRACK_TEMP = 30.0
MISSING_FINISH = 20

# Columns that are known only after the race.
LEAKY = ("had_slow_stop", "total_pit_time", "avg_pit_duration", "points", "status", "laps_completed", "time_millis", "fastest_lap_rank", "fastest_lap_time", "avg_speed_kph",
         "fastest_lap_seconds", "position_gained", "finished", "dnf")

# Columns that describe the race itself; a model that predicts it must not read them.
IN_RACE = ("num_pit_stops", "pit_strategy_aggressive", "pit_stops_vs_field", "avg_lap_time", "lap_consistency", "best_lap_time",
           "laps_completed_actual", "max_tyre_life", "pace_vs_field", "best_lap_pct", "num_stints",
           "soft_deg_slope", "medium_deg_slope", "hard_deg_slope", "avg_tire_deg_slope", "max_tire_deg_slope", "min_tire_deg_slope", "stint_count_tire", "position", "classified")

TARGETS = ("target_position", "target_podium", "target_points_finish", "target_winner")

# One row per driver and race, so the race calendar bounds every group that
# holds the driver (or a part of it). Such windows need no check.
PER_DRIVER = BOUNDED


def rolling_form(df: DataFrame) -> DataFrame:
    """Previous five races: mean finish, points, retirement rate, places gained; spread of places gained."""
    gained = F.col("grid") - F.coalesce("position", "grid")
    spread = F.col("grid") - F.coalesce(F.col("position"), F.lit(MISSING_FINISH))
    means = {
        "rolling_avg_position_5": F.col("position"),
        "rolling_avg_points_5": F.col("points"),
        "rolling_dnf_rate_5": F.col("dnf").cast("int"),
        "rolling_positions_gained_5": gained,
    }
    outputs = {out: (lambda w, v=v: F.avg(v).over(w)) for out, v in means.items()}
    outputs["rolling_consistency"] = lambda w: F.stddev_samp(spread).over(w)
    return rolling(df, ["driver_id"], ORDER, outputs, -5, -1, PER_DRIVER)


def constructor_form(
    df: DataFrame, mode: str = "race", hot: HotGroups | None = None, source: DataFrame | None = None
) -> DataFrame:
    """Mean points per entrant over the team's previous ten races; `hot` may describe the races or the teams."""
    return form.team_form(
        df, "constructor_id", ORDER, "points", "constructor_rolling_points", 10, mode, "driver_id", hot, source)


def field_context(df: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """Against the field of the race: gap to the best qualifying time (s, %), stops against the mean, many stops."""
    field = {"__pole": F.min("best_quali_seconds"), "__stops": F.avg("num_pit_stops")}
    df = group_stats(df, RACE, field, calendar=True, source=source)
    gap = F.col("best_quali_seconds") - F.col("__pole")
    return df.select(
        "*",
        gap.alias("quali_gap_to_pole"),
        ratio(gap * 100, F.col("__pole")).alias("quali_gap_pct"),
        flag(F.col("num_pit_stops") >= 3).alias("pit_strategy_aggressive"),
        (F.col("num_pit_stops") - F.col("__stops")).alias("pit_stops_vs_field"),
    ).drop("__pole", "__stops")


def circuit_history(df: DataFrame) -> DataFrame:
    """Earlier visits of the driver to this circuit: mean finish, visits, wins, podiums."""
    df = expanding(
        df, ["driver_id", "circuit_id"], ORDER,
        {
            "circuit_avg_position": ("avg", F.col("position")),
            "circuit_races_count": ("count", F.lit(1)),
            "driver_circuit_wins": ("sum", flag(F.col("position") == 1)),
            "driver_circuit_podiums": ("sum", flag(F.col("position") <= 3)),
        },
        hot=PER_DRIVER,
    )
    return df.fillna(0, ["driver_circuit_wins", "driver_circuit_podiums"])


def season_points(df: DataFrame) -> DataFrame:
    """Points of this season before the race; 0 at the first race."""
    df = expanding(df, ["driver_id", "season"], ["round"], {"season_cumulative_points": ("sum", F.col("points"))},
                   hot=PER_DRIVER)
    return df.fillna(0.0, ["season_cumulative_points"])


def targets(df: DataFrame) -> DataFrame:
    """A missing finish leaves the position null and clears the flags."""
    p = F.col("position")
    return df.select(
        "*",
        p.alias("target_position"),
        flag(p <= 3).alias("target_podium"),
        flag(p <= 10).alias("target_points_finish"),
        flag(p == 1).alias("target_winner"),
    )


def race_features(master: DataFrame, hot: HotGroups | None = None, team_mode: str = "race") -> DataFrame:
    """The base gold table. `hot` describes the groups of one race."""
    df = rolling_form(master)
    df = circuit_history(df).drop("driver_circuit_wins", "driver_circuit_podiums")
    df = season_points(df)
    df = constructor_form(df, team_mode, hot, master)
    df = field_context(df, master)
    return targets(df).drop(*LEAKY)


# ---- advanced features ----------------------------------------------------


def streaks(df: DataFrame) -> DataFrame:
    """Consecutive wins, podiums and points finishes before the race."""
    return form.streaks_before(
        df, ["driver_id"], ORDER,
        {"win_streak": "target_winner", "podium_streak": "target_podium", "points_streak": "target_points_finish"},
        PER_DRIVER,
    )


def ewm_form(df: DataFrame) -> DataFrame:
    """Exponentially weighted finish and points-finish rate over all earlier races."""
    return form.ewm_before(
        df, ["driver_id"], ORDER,
        {"ewm_position_5": F.col("target_position"), "ewm_points_5": F.col("target_points_finish")}, hot=PER_DRIVER,
    )


def quali_vs_teammate(df: DataFrame, hot: HotGroups | None = None, source: DataFrame | None = None) -> DataFrame:
    """Gap to the team's mean qualifying time, which includes the driver."""
    df = group_stats(df, [*RACE, "constructor_id"], {"__mean": F.avg("best_quali_seconds")}, hot, source=source)
    return df.withColumn("quali_vs_teammate", F.col("best_quali_seconds") - F.col("__mean")).drop("__mean")


def season_phase(df: DataFrame, schedule: DataFrame | None = None) -> DataFrame:
    """Progress through the season; with a schedule its last round counts, else the last round seen."""
    rounds = (schedule if schedule is not None else df).groupBy("season").agg(F.max("round").alias("__last"))
    df = calendar_join(df, rounds, ["season"])
    progress = F.col("round") / F.col("__last")
    return df.select(
        "*",
        progress.alias("season_progress"),
        flag(F.col("round") <= 3).alias("is_season_start"),
        flag(progress > 0.8).alias("is_season_end"),
    ).drop("__last")


def championship(df: DataFrame, hot: HotGroups | None = None, source: DataFrame | None = None) -> DataFrame:
    """Points behind the leader and competition rank, both before the race."""
    df = group_stats(df, RACE, {"__top": F.max("season_cumulative_points")}, calendar=True, source=source)
    df = df.withColumn("points_gap_to_leader", F.col("__top") - F.col("season_cumulative_points")).drop("__top")
    return with_rank(df, RACE, "season_cumulative_points", "championship_position", hot=hot)


MOMENTS = ("__d", "__n", "__m", "__v", "__c")


def race_moments(df: DataFrame) -> DataFrame:
    """One row per circuit and race: retirements, entries, and mean, squared deviations and number of finishes."""
    p = F.col("position").cast("double")
    return df.groupBy("circuit_id", *RACE).agg(
        F.sum(flag(F.col("dnf"))).alias("__d"), F.count(F.lit(1)).alias("__n"),
        F.avg(p).alias("__m"), (F.var_pop(p) * F.count(p)).alias("__v"), F.count(p).alias("__c"),
    )


def _around_centre(races: DataFrame) -> DataFrame:
    """Adds sums and squares of the finishes around the circuit's centre, which can be added up."""
    # One row per race, so the calendar bounds the window.
    centre = F.avg("__m").over(Window.partitionBy("circuit_id"))
    races = races.withColumn("__centre", centre).withColumn("__s", F.col("__c") * (F.col("__m") - F.col("__centre")))
    return races.withColumn("__q", F.col("__v") + F.col("__s") * (F.col("__m") - F.col("__centre")))


_SUMS = ("__d", "__n", "__s", "__q", "__c")


def moments_before(races: DataFrame) -> DataFrame:
    """The sums over the circuit's earlier races, as t__d, t__n ..., per race."""
    sums = {f"t{c}": ("sum", F.col(c)) for c in _SUMS}
    return expanding(_around_centre(races), ["circuit_id"], ORDER, sums, hot=BOUNDED).select("circuit_id", *RACE, *sums)


def circuit_moments(races: DataFrame) -> DataFrame:
    """The sums over all races of a circuit, its centre and its last race."""
    return _around_centre(races).groupBy("circuit_id").agg(
        *[F.sum(c).alias(f"t{c}") for c in _SUMS], F.first("__centre").alias("centre"),
        F.max(F.struct(*RACE)).alias("last"),
    )


def spread_of(stats: DataFrame) -> DataFrame:
    """Retirement rate and finish spread of summed moments."""
    n, s, q = F.col("t__c"), F.col("t__s"), F.col("t__q")
    variance = F.greatest(ratio(q - ratio(s * s, n), n - 1), F.lit(0.0))
    return stats.select(
        *[c for c in stats.columns if c in ("circuit_id", *RACE)],
        ratio(F.col("t__d"), F.col("t__n")).alias("circuit_dnf_rate"),
        F.when(n > 1, F.sqrt(variance)).alias("circuit_chaos_index"),
    )


def circuit_risk(df: DataFrame, full_history: bool = False, source: DataFrame | None = None) -> DataFrame:
    """Retirement rate and finish spread of the circuit.

    Only earlier races count unless `full_history`, which uses all races and so looks ahead.
    Race-level moments come first; a circuit then has one row per race. The
    moments are merged around the circuit's centre, which changes no spread but
    keeps its digits where values are large.
    """
    races = race_moments(df if source is None else source)
    stats = circuit_moments(races) if full_history else moments_before(races)
    stats, by = spread_of(stats), ["circuit_id"] if full_history else ["circuit_id", *RACE]
    # A circuit is used at most once per race, so this table has calendar size.
    out = calendar_join(df, stats, by)
    return out.fillna({"circuit_dnf_rate": DEFAULT_DNF_RATE, "circuit_chaos_index": DEFAULT_CHAOS})


def interactions(df: DataFrame) -> DataFrame:
    """Team form times rain and track temperature, and grid scaled by rating."""
    points = F.col("constructor_rolling_points")
    rain = F.coalesce(F.col("had_rain"), F.lit(0))
    temp = F.coalesce(F.col("avg_track_temp"), F.lit(DEFAULT_TRACK_TEMP))
    rating = F.coalesce(F.col("driver_elo"), F.lit(DEFAULT_RATING))
    return df.select(
        "*",
        (points * rain).alias("constructor_rain_interaction"),
        (points * temp).alias("constructor_temp_interaction"),
        (F.col("grid") * (F.lit(2000.0) - rating) / 500).alias("grid_elo_interaction"),
    )


def dominance(df: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """Team form relative to the field of the race."""
    df = group_stats(df, RACE, {"__mean": F.avg("constructor_rolling_points")}, calendar=True, source=source)
    return df.withColumn("constructor_dominance", ratio(F.col("constructor_rolling_points"), F.col("__mean"))).drop("__mean")


def pre_race_columns(columns: Sequence[str]) -> list[str]:
    """Columns that are known before the start."""
    return [c for c in columns if c not in IN_RACE and c not in TARGETS and c not in LEAKY]
