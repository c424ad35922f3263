"""Gold features over the contest view."""

from pyspark.sql import functions as F

from lapwise import bindings as B
from lapwise.functions.scalars import rounded
from lapwise.operators import form
from lapwise.operators.ordered import BOUNDED, null_safe_join, with_rank
from lapwise.plans import gold
from lapwise.plans.carried import refresh_gold
from lapwise.queries.registry import SQL, query
from lapwise.session import materialised, shared_dir

KEY = ["season", "round", "driver_id"]
K = "season, round, driver_id"
W = "(PARTITION BY driver_id ORDER BY season, round ROWS BETWEEN {0} AND {1})"
LAST5 = W.format("5 PRECEDING", "1 PRECEDING")
NOW5 = W.format("4 PRECEDING", "CURRENT ROW")


def _sql(body, *ctes):
    return "WITH " + ",".join([B.CONTEST_SQL, *ctes]) + body


TARGETS_SQL = """
gold AS (
  SELECT *, position AS target_position, CASE WHEN position <= 3 THEN 1 ELSE 0 END AS target_podium,
         CASE WHEN position <= 10 THEN 1 ELSE 0 END AS target_points_finish,
         CASE WHEN position = 1 THEN 1 ELSE 0 END AS target_winner
  FROM contest)"""

TEAM_SQL = """
team_races AS (
  SELECT constructor_id, season, round, sum(points) AS s, count(points) AS c FROM contest GROUP BY ALL),
team_form AS (
  SELECT constructor_id, season, round,
         sum(s) OVER (PARTITION BY constructor_id ORDER BY season, round ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) /
         sum(c) OVER (PARTITION BY constructor_id ORDER BY season, round ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)
           AS constructor_rolling_points
  FROM team_races)"""

CUM_SQL = """
cum AS (
  SELECT *, coalesce(sum(points) OVER (PARTITION BY driver_id, season ORDER BY round
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS season_cumulative_points FROM contest)"""


def _features(df, *names):
    return rounded(df.select(*KEY, *names))


@query(
    "rolling_form",
    _sql(f"""
SELECT {K}, round(avg(position) OVER {LAST5}, 6) AS rolling_avg_position_5,
       round(avg(points) OVER {LAST5}, 6) AS rolling_avg_points_5,
       round(avg(CAST(dnf AS INTEGER)) OVER {LAST5}, 6) AS rolling_dnf_rate_5,
       round(avg(grid - coalesce(position, grid)) OVER {LAST5}, 6) AS rolling_positions_gained_5,
       round(stddev_samp(grid - coalesce(position, 20)) OVER {LAST5}, 6) AS rolling_consistency
FROM contest"""),
)
def rolling_form(spark, sf_dir):
    df = gold.rolling_form(B.contest(spark, sf_dir))
    return _features(df, "rolling_avg_position_5", "rolling_avg_points_5", "rolling_dnf_rate_5",
                     "rolling_positions_gained_5", "rolling_consistency")


@query(
    "constructor_form",
    _sql(f"""
SELECT {K}, round(constructor_rolling_points, 6) AS constructor_rolling_points
FROM contest LEFT JOIN team_form USING (constructor_id, season, round)""", TEAM_SQL),
)
def constructor_form(spark, sf_dir):
    df = gold.constructor_form(B.contest(spark, sf_dir), hot=B.races_of(spark, sf_dir))
    return _features(df, "constructor_rolling_points")


@query(
    "constructor_form_by_rows",
    _sql(f"""
SELECT {K}, round(avg(points) OVER (PARTITION BY constructor_id ORDER BY season, round, driver_id
       ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING), 6) AS constructor_rolling_points
FROM contest"""),
)
def constructor_form_by_rows(spark, sf_dir):
    df = B.contest(spark, sf_dir)
    hot = B.checked(B.daily(spark, sf_dir).select("constructor_id"), sf_dir, "daily", ["constructor_id"])
    return _features(gold.constructor_form(df, "rows", hot), "constructor_rolling_points")


@query(
    "quali_gap_to_pole",
    _sql(f"""
SELECT {K}, round(best_quali_seconds - pole, 6) AS quali_gap_to_pole,
       round((best_quali_seconds - pole) * 100 / nullif(pole, 0), 6) AS quali_gap_pct
FROM (SELECT *, min(best_quali_seconds) OVER (PARTITION BY season, round) AS pole FROM contest)"""),
)
def quali_gap_to_pole(spark, sf_dir):
    return _features(gold.field_context(B.contest(spark, sf_dir)), "quali_gap_to_pole", "quali_gap_pct")


@query(
    "pit_stops_vs_field",
    _sql(f"""
SELECT {K}, CAST(num_pit_stops >= 3 AS INTEGER) AS pit_strategy_aggressive,
       round(num_pit_stops - avg(num_pit_stops) OVER (PARTITION BY season, round), 6) AS pit_stops_vs_field
FROM contest"""),
)
def pit_stops_vs_field(spark, sf_dir):
    return _features(gold.field_context(B.contest(spark, sf_dir)), "pit_strategy_aggressive", "pit_stops_vs_field")


VENUE = "(PARTITION BY driver_id, circuit_id ORDER BY season, round ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


@query(
    "circuit_history",
    _sql(f"""
SELECT {K}, round(avg(position) OVER {VENUE}, 6) AS circuit_avg_position,
       count(*) OVER {VENUE} AS circuit_races_count,
       CAST(coalesce(sum(CASE WHEN position = 1 THEN 1 ELSE 0 END) OVER {VENUE}, 0) AS BIGINT) AS driver_circuit_wins,
       CAST(coalesce(sum(CASE WHEN position <= 3 THEN 1 ELSE 0 END) OVER {VENUE}, 0) AS BIGINT) AS driver_circuit_podiums
FROM contest"""),
)
def circuit_history(spark, sf_dir):
    df = gold.circuit_history(B.contest(spark, sf_dir))
    return _features(df, "circuit_avg_position", "circuit_races_count", "driver_circuit_wins", "driver_circuit_podiums")


@query(
    "season_points_before",
    _sql(f"SELECT {K}, round(season_cumulative_points, 6) AS season_cumulative_points FROM cum", CUM_SQL),
)
def season_points_before(spark, sf_dir):
    return _features(gold.season_points(B.contest(spark, sf_dir)), "season_cumulative_points")


@query(
    "finish_targets",
    _sql(f"SELECT {K}, target_position, target_podium, target_points_finish, target_winner FROM gold", TARGETS_SQL),
)
def finish_targets(spark, sf_dir):
    return _features(gold.targets(B.contest(spark, sf_dir)), *gold.TARGETS)


def _streak_sql(flag, out):
    return f"""rn - 1 - coalesce(max(CASE WHEN {flag} = 0 THEN rn END) OVER (PARTITION BY driver_id ORDER BY rn
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS {out}"""


@query(
    "streaks_before",
    _sql(f"""
SELECT {K}, {_streak_sql('target_winner', 'win_streak')}, {_streak_sql('target_podium', 'podium_streak')},
       {_streak_sql('target_points_finish', 'points_streak')}
FROM (SELECT *, row_number() OVER (PARTITION BY driver_id ORDER BY season, round) AS rn FROM gold)""", TARGETS_SQL),
)
def streaks_before(spark, sf_dir):
    df = gold.streaks(gold.targets(B.contest(spark, sf_dir)))
    return _features(df, "win_streak", "podium_streak", "points_streak")


def _ewm_sql(value, out):
    return f"""round((SELECT sum(p.{value} * pow(1.5, p.rn)) / sum(CASE WHEN p.{value} IS NOT NULL THEN pow(1.5, p.rn) END)
       FROM g p WHERE p.driver_id = g.driver_id AND p.rn < g.rn), 6) AS {out}"""


EWM_ROWS = """
g AS (SELECT *, row_number() OVER (PARTITION BY driver_id ORDER BY season, round) AS rn FROM gold)"""


@query(
    "ewm_form",
    _sql(f"""
SELECT {K}, {_ewm_sql('target_position', 'ewm_position_5')}, {_ewm_sql('target_points_finish', 'ewm_points_5')}
FROM g""", TARGETS_SQL, EWM_ROWS),
)
def ewm_form(spark, sf_dir):
    df = gold.ewm_form(gold.targets(B.contest(spark, sf_dir)))
    return _features(df, "ewm_position_5", "ewm_points_5")


@query(
    "ewm_event_value",
    """
WITH e AS (SELECT event_id, user_id, CASE WHEN event_type <> 'error' THEN value END AS v,
                  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
SELECT event_id, user_id, round(sum(v * pow(1.5, rn)) OVER w / sum(CASE WHEN v IS NOT NULL THEN pow(1.5, rn) END) OVER w, 6)
       AS ewm_value
FROM e WINDOW w AS (PARTITION BY user_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
)
def ewm_event_value(spark, sf_dir):
    # Users have unbounded histories, so this takes the blocked form.
    events = B.table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    hot = B.checked(events.select("user_id"), sf_dir, "events", ["user_id"])
    value = F.when(F.col("event_type") != "error", F.col("value"))
    df = form.ewm_before(events, ["user_id"], ["ts", "event_id"], {"ewm_value": value}, hot=hot)
    return rounded(df.select("event_id", "user_id", "ewm_value"))


@query(
    "quali_vs_teammate",
    _sql(f"""
SELECT {K}, round(best_quali_seconds - avg(best_quali_seconds) OVER (PARTITION BY season, round, constructor_id), 6)
       AS quali_vs_teammate FROM contest"""),
)
def quali_vs_teammate(spark, sf_dir):
    return _features(gold.quali_vs_teammate(B.contest(spark, sf_dir), B.races_of(spark, sf_dir)), "quali_vs_teammate")


@query(
    "season_phase",
    _sql(f"""
SELECT {K}, round(progress, 6) AS season_progress, CAST(round <= 3 AS INTEGER) AS is_season_start,
       CAST(progress > 0.8 AS INTEGER) AS is_season_end
FROM (SELECT *, round / max(round) OVER (PARTITION BY season) AS progress FROM contest)"""),
)
def season_phase(spark, sf_dir):
    return _features(gold.season_phase(B.contest(spark, sf_dir)), "season_progress", "is_season_start", "is_season_end")


@query(
    "championship",
    _sql(f"""
SELECT {K}, round(max(season_cumulative_points) OVER (PARTITION BY season, round) - season_cumulative_points, 6)
         AS points_gap_to_leader,
       rank() OVER (PARTITION BY season, round ORDER BY season_cumulative_points DESC NULLS LAST) AS championship_position
FROM (SELECT * REPLACE (round(season_cumulative_points, 4) AS season_cumulative_points) FROM cum)""", CUM_SQL),
)
def championship(spark, sf_dir):
    df = gold.season_points(B.contest(spark, sf_dir))
    # Sums of cents; rounding removes the noise that would break ties differently.
    df = df.withColumn("season_cumulative_points", F.round("season_cumulative_points", 4))
    return _features(gold.championship(df, B.races_of(spark, sf_dir)), "points_gap_to_leader", "championship_position")


RISK_SQL = """
venue_races AS (
  SELECT circuit_id, season, round, sum(CAST(dnf AS INTEGER)) AS d, count(*) AS n, sum(position) AS s,
         sum(position * position) AS q, count(position) AS c FROM contest GROUP BY ALL),
venue AS (
  SELECT circuit_id, season, round, sum(d) OVER w AS d, sum(n) OVER w AS n, sum(s) OVER w AS s, sum(q) OVER w AS q,
         sum(c) OVER w AS c
  FROM venue_races WINDOW w AS (PARTITION BY circuit_id ORDER BY season, round
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


@query(
    "circuit_risk_before",
    _sql(f"""
SELECT {K}, round(coalesce(v.d / v.n, 0.1), 6) AS circuit_dnf_rate,
       round(coalesce(CASE WHEN v.c > 1 THEN sqrt((v.q - CAST(v.s AS DOUBLE) * v.s / v.c) / (v.c - 1)) END, 5.0), 6)
         AS circuit_chaos_index
FROM contest LEFT JOIN venue v USING (circuit_id, season, round)""", RISK_SQL),
)
def circuit_risk_before(spark, sf_dir):
    return _features(gold.circuit_risk(B.contest(spark, sf_dir)), "circuit_dnf_rate", "circuit_chaos_index")


@query(
    "circuit_risk_all_races",
    _sql(f"""
SELECT {K}, round(avg(CAST(dnf AS INTEGER)) OVER (PARTITION BY circuit_id), 6) AS circuit_dnf_rate,
       round(stddev_samp(position) OVER (PARTITION BY circuit_id), 6) AS circuit_chaos_index
FROM contest"""),
)
def circuit_risk_all_races(spark, sf_dir):
    df = gold.circuit_risk(B.contest(spark, sf_dir), full_history=True)
    return _features(df, "circuit_dnf_rate", "circuit_chaos_index")


@query(
    "team_dominance",
    _sql(f"""
SELECT {K}, round(constructor_rolling_points / nullif(avg(constructor_rolling_points) OVER (PARTITION BY season, round), 0), 6)
       AS constructor_dominance
FROM contest LEFT JOIN team_form USING (constructor_id, season, round)""", TEAM_SQL),
)
def team_dominance(spark, sf_dir):
    df = gold.constructor_form(B.contest(spark, sf_dir), hot=B.races_of(spark, sf_dir))
    return _features(gold.dominance(df), "constructor_dominance")


@query(
    "quali_trend_slope",
    _sql(f"""
SELECT {K}, round(CASE WHEN count(best_quali_seconds) OVER w >= 2 THEN regr_slope(best_quali_seconds, rn) OVER w END, 6)
       AS quali_trend
FROM (SELECT *, row_number() OVER (PARTITION BY driver_id ORDER BY season, round) AS rn FROM contest)
WINDOW w AS (PARTITION BY driver_id ORDER BY rn ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"""),
)
def quali_trend_slope(spark, sf_dir):
    df = form.rolling_slope(B.contest(spark, sf_dir), ["driver_id"], gold.ORDER, "best_quali_seconds", "quali_trend",
                            hot=BOUNDED)
    return _features(df, "quali_trend")


@query("grid_spread", _sql(f"SELECT {K}, round(stddev_samp(grid) OVER {NOW5}, 6) AS grid_spread FROM contest"))
def grid_spread(spark, sf_dir):
    df = form.rolling(B.contest(spark, sf_dir), ["driver_id"], gold.ORDER,
                      {"grid_spread": lambda w: F.stddev_samp("grid").over(w)}, -4, 0, BOUNDED)
    return _features(df, "grid_spread")


@query(
    "points_acceleration",
    _sql(f"""
SELECT {K}, round(c - 2 * lag(c, 1) OVER w + lag(c, 2) OVER w, 6) AS points_acceleration
FROM (SELECT *, season_cumulative_points AS c FROM cum)
WINDOW w AS (PARTITION BY driver_id, season ORDER BY round)""", CUM_SQL),
)
def points_acceleration(spark, sf_dir):
    df = gold.season_points(B.contest(spark, sf_dir))
    df = form.second_difference(df, ["driver_id", "season"], ["round"], "season_cumulative_points",
                                "points_acceleration", BOUNDED)
    return _features(df, "points_acceleration")


@query(
    "home_advantage",
    _sql(f"""
SELECT {K}, round(avg(position) OVER {LAST5} - avg(position) OVER {VENUE}, 6) AS home_advantage FROM contest"""),
)
def home_advantage(spark, sf_dir):
    df = gold.circuit_history(gold.rolling_form(B.contest(spark, sf_dir)))
    return _features(
        df.withColumn("home_advantage", F.col("rolling_avg_position_5") - F.col("circuit_avg_position")), "home_advantage"
    )


@query(
    "average_rank_of_ties",
    _sql(f"""
SELECT {K}, CAST(floor(r + (t - 1) / 2.0) AS BIGINT) AS stop_rank
FROM (SELECT *, rank() OVER (PARTITION BY season, round ORDER BY num_pit_stops) AS r,
             count(*) OVER (PARTITION BY season, round, num_pit_stops) AS t FROM contest)"""),
)
def average_rank_of_ties(spark, sf_dir):
    df = with_rank(B.contest(spark, sf_dir), B.RACE, "num_pit_stops", "stop_rank", False, "average",
                   B.races_of(spark, sf_dir))
    return _features(df, "stop_rank")


GOLD_SQL = f"""
gold_table AS (
  SELECT {K}, constructor_id, circuit_id, CAST(race_date AS VARCHAR) AS race_date, grid, position, best_quali_seconds, q1_seconds, q2_seconds, q3_seconds,
         num_pit_stops,
         round(avg(position) OVER {LAST5}, 6) AS rolling_avg_position_5,
         round(avg(points) OVER {LAST5}, 6) AS rolling_avg_points_5,
         round(avg(CAST(dnf AS INTEGER)) OVER {LAST5}, 6) AS rolling_dnf_rate_5,
         round(avg(grid - coalesce(position, grid)) OVER {LAST5}, 6) AS rolling_positions_gained_5,
         round(constructor_rolling_points, 6) AS constructor_rolling_points,
         round(stddev_samp(grid - coalesce(position, 20)) OVER {LAST5}, 6) AS rolling_consistency,
         round(best_quali_seconds - min(best_quali_seconds) OVER r, 6) AS quali_gap_to_pole,
         round((best_quali_seconds - min(best_quali_seconds) OVER r) * 100 / nullif(min(best_quali_seconds) OVER r, 0), 6)
           AS quali_gap_pct,
         CAST(num_pit_stops >= 3 AS INTEGER) AS pit_strategy_aggressive,
         round(num_pit_stops - avg(num_pit_stops) OVER r, 6) AS pit_stops_vs_field,
         round(avg(position) OVER {VENUE}, 6) AS circuit_avg_position,
         count(*) OVER {VENUE} AS circuit_races_count,
         round(coalesce(sum(points) OVER (PARTITION BY driver_id, season ORDER BY round
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 6) AS season_cumulative_points,
         position AS target_position, CASE WHEN position <= 3 THEN 1 ELSE 0 END AS target_podium,
         CASE WHEN position <= 10 THEN 1 ELSE 0 END AS target_points_finish,
         CASE WHEN position = 1 THEN 1 ELSE 0 END AS target_winner
  FROM contest LEFT JOIN team_form USING (constructor_id, season, round)
  WINDOW r AS (PARTITION BY season, round))"""


@query("race_features", _sql(" SELECT * FROM gold_table", TEAM_SQL, GOLD_SQL))
def race_features(spark, sf_dir):
    df = gold.race_features(B.contest(spark, sf_dir), B.races_of(spark, sf_dir))
    return rounded(df.drop("first_ts", "classified").withColumn("race_date", F.col("race_date").cast("string")))


@query("race_features_with_stops", _sql(" SELECT * FROM gold_table", TEAM_SQL, GOLD_SQL))
def race_features_with_stops(spark, sf_dir):
    """The master carries what is known after the race, stop times among them; none of it may reach the gold table."""
    stops = B.lap_rows(spark, sf_dir).filter(F.col("Compound") == "MEDIUM").groupBy(*B.RACE, F.col("Driver").alias("driver_id")).agg(
        F.max(F.col("LapTime_seconds") > 500).cast("int").alias("had_slow_stop"), F.sum("LapTime_seconds").alias("total_pit_time"),
        F.avg("LapTime_seconds").alias("avg_pit_duration"))
    master = null_safe_join(B.contest(spark, sf_dir), stops, KEY).withColumns(
        {"status": F.lit("Finished"), "laps_completed": F.lit(1), "finished": ~F.col("dnf"), "position_gained": F.col("grid") - F.col("position")})
    df = gold.race_features(master, B.races_of(spark, sf_dir))
    return rounded(df.drop("first_ts", "classified").withColumn("race_date", F.col("race_date").cast("string")))


def _side_by_side(*names):
    tables = [f"({SQL[name]})" for name in names]
    return "SELECT * FROM " + tables[0] + "".join(f" JOIN {t} USING (season, round, driver_id)" for t in tables[1:])


@query(
    "gold_refreshed",
    "SELECT * EXCLUDE (visit_place, visit_count) FROM ("
    + _side_by_side("race_features", "streaks_before", "ewm_form", "circuit_risk_before", "quali_vs_teammate", "championship",
                    "team_dominance")
    + f""") JOIN (SELECT {K}, circuit_avg_position AS visit_place, circuit_races_count AS visit_count, driver_circuit_wins,
          driver_circuit_podiums FROM ({SQL['circuit_history']})) USING (season, round, driver_id)""",
)
def gold_refreshed(spark, sf_dir):
    """All rounds but the last three at once, then one after the other; each call is given its own rounds only."""
    master = materialised(B.contest(spark, sf_dir), "master")
    # Three rows of the calendar.
    last = master.select(*B.RACE).distinct().orderBy(*[F.col(c).desc() for c in B.RACE]).limit(3).collect()
    at = F.struct(*B.RACE)
    this = lambda r: F.struct(*[F.lit(r[c]).cast("int").alias(c) for c in B.RACE])
    store = shared_dir(spark, "gold")
    parts = [at < this(last[-1])] if last else [F.lit(True)]
    for part in [*parts, *[at == this(r) for r in reversed(last)]]:
        refresh_gold(master.filter(part), store)
    df = refresh_gold(master.limit(0), store)
    return rounded(df.drop("first_ts", "classified").withColumn("race_date", F.col("race_date").cast("string")))
