"""Reports, health checks, feature tests, run history, ratings and the ad-hoc questions."""

from pyspark.sql import functions as F

from lapwise import bindings as B
from lapwise.functions.scalars import flag, rounded
from lapwise.learn import evaluate
from lapwise.operators import quality
from lapwise.operators.form import rolling_slope, second_difference
from lapwise.operators.groups import calendar_join, latest_period, row_at_max, top_k, top_rows
from lapwise.operators.ordered import BOUNDED, rolling, with_rank
from lapwise.operators.rating import against_field, elo, refresh_ratings
from lapwise.operators.regression import correlations
from lapwise.plans import gold, history, integrate, questions, reports, silver
from lapwise.queries.form_queries import CUM_SQL, GOLD_SQL, LAST5, NOW5, RISK_SQL, TARGETS_SQL, TEAM_SQL, VENUE
from lapwise.queries.registry import query
from lapwise.queries.silver_queries import CLEAN_SQL, DEG_SQL, LAP_FEATURES_SQL, TIRE_SQL, WEATHER_FEATURES_SQL
from lapwise.session import materialised, shared_dir

KEY = ["season", "round", "driver_id"]
K = "season, round, driver_id"


def _with(*ctes):
    return "WITH " + ",".join([B.CONTEST_SQL, *ctes])


def _targets(spark, sf_dir):
    return gold.targets(B.contest(spark, sf_dir))


# ---- season and race reports ---------------------------------------------------


@query(
    "driver_season_stats",
    _with(TARGETS_SQL) + """
SELECT season, driver_id, round(avg(target_position), 6) AS avg_finish, min(target_position) AS best_finish,
       round(avg(grid), 6) AS avg_grid, count(*) AS races, CAST(sum(target_podium) AS BIGINT) AS podiums,
       CAST(sum(target_winner) AS BIGINT) AS wins FROM gold GROUP BY season, driver_id""",
)
def driver_season_stats(spark, sf_dir):
    return rounded(reports.driver_season_stats(_targets(spark, sf_dir), ["season", "driver_id"]))


@query(
    "standings_after_latest_race",
    _with(CUM_SQL) + """
SELECT driver_id, round(max(season_cumulative_points), 6) AS points FROM cum
WHERE (season, round) = (SELECT (season, round) FROM cum ORDER BY season DESC, round DESC LIMIT 1)
GROUP BY driver_id ORDER BY points DESC, driver_id LIMIT 10""",
)
def standings_after_latest_race(spark, sf_dir):
    df = gold.season_points(B.contest(spark, sf_dir))
    df = df.withColumn("season_cumulative_points", F.round("season_cumulative_points", 6))
    return reports.standings_after_latest(df)


@query(
    "constructor_standings",
    _with() + "SELECT season, constructor_id, round(sum(points), 6) AS points FROM contest GROUP BY season, constructor_id",
)
def constructor_standings(spark, sf_dir):
    return rounded(reports.constructor_standings(B.contest(spark, sf_dir)))


@query(
    "constructor_entry_counts",
    _with() + "SELECT season, constructor_id, CAST(count(*) AS DOUBLE) AS points FROM contest GROUP BY season, constructor_id",
)
def constructor_entry_counts(spark, sf_dir):
    return reports.constructor_standings(B.contest(spark, sf_dir).drop("points"))


@query(
    "average_places_gained",
    _with() + "SELECT driver_id, round(avg(grid - position), 6) AS avg_gained FROM contest GROUP BY driver_id",
)
def average_places_gained(spark, sf_dir):
    return rounded(reports.places_gained(_targets(spark, sf_dir)))


@query(
    "biggest_gain_and_loss",
    _with() + """
(SELECT season, round, driver_id, grid - position AS gained, 'max' AS extreme FROM contest WHERE position IS NOT NULL
 ORDER BY gained DESC, driver_id, season, round LIMIT 1)
UNION ALL
(SELECT season, round, driver_id, grid - position AS gained, 'min' AS extreme FROM contest WHERE position IS NOT NULL
 ORDER BY gained, driver_id, season, round LIMIT 1)""",
)
def biggest_gain_and_loss(spark, sf_dir):
    df = B.contest(spark, sf_dir).withColumn("gained", F.col("grid") - F.col("position"))
    df = df.withColumn("__tie", F.struct("driver_id", "season", "round"))
    return reports.extreme_rows(df, F.col("gained"), [*KEY, "gained"], "__tie")


@query(
    "best_driver_per_team",
    _with() + """
SELECT constructor_id, driver_id, points FROM (
  SELECT constructor_id, driver_id, points, row_number() OVER (PARTITION BY constructor_id ORDER BY points DESC, driver_id) AS rn
  FROM (SELECT constructor_id, driver_id, round(sum(points), 4) AS points FROM contest GROUP BY 1, 2)) WHERE rn = 1""",
)
def best_driver_per_team(spark, sf_dir):
    totals = B.daily(spark, sf_dir).groupBy("constructor_id", "driver_id").agg(F.round(F.sum("points"), 4).alias("points"))
    return row_at_max(totals, ["constructor_id"], F.col("points"), ["driver_id", "points"], "driver_id")


@query(
    "team_rosters",
    _with() + "SELECT season, constructor_id, count(DISTINCT driver_id) AS drivers FROM contest GROUP BY 1, 2",
)
def team_rosters(spark, sf_dir):
    return reports.roster(B.daily(spark, sf_dir))


@query(
    "headcount",
    _with() + """
SELECT count(DISTINCT driver_id) AS drivers, count(DISTINCT constructor_id) AS teams, count(DISTINCT season) AS seasons
FROM contest""",
)
def headcount(spark, sf_dir):
    return reports.headcount(B.daily(spark, sf_dir))


@query(
    "race_result_cards",
    _with() + """
SELECT season, round, max(CASE WHEN position = 1 THEN driver_id END) AS winner,
       max(CASE WHEN position = 1 THEN constructor_id END) AS winner_team, max(CASE WHEN position = 1 THEN grid END) AS winner_grid,
       max(CASE WHEN position = 2 THEN driver_id END) AS second, max(CASE WHEN position = 3 THEN driver_id END) AS third,
       count(position) AS finishers FROM contest GROUP BY season, round""",
)
def race_result_cards(spark, sf_dir):
    return reports.result_cards(_targets(spark, sf_dir))


@query(
    "latest_race_rows",
    _with() + """
SELECT season, round, driver_id, grid, points FROM contest
WHERE (season, round) = (SELECT (season, round) FROM contest ORDER BY season DESC, round DESC LIMIT 1)""",
)
def latest_race_rows(spark, sf_dir):
    return latest_period(B.contest(spark, sf_dir), B.RACE).select(*KEY, "grid", "points")


@query(
    "top_three_per_race",
    _with() + "SELECT season, round, driver_id, classified AS place FROM contest WHERE classified <= 3",
)
def top_three_per_race(spark, sf_dir):
    best = top_k(B.daily(spark, sf_dir), B.RACE, [F.col("points").desc(), F.col("driver_id")], 3)
    return best.select(*KEY, F.col("place").cast("long").alias("place"))


@query(
    "largest_and_smallest_orders",
    """
(SELECT 'largest' AS side, o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10)
UNION ALL
(SELECT 'smallest' AS side, o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 10)""",
)
def largest_and_smallest_orders(spark, sf_dir):
    orders = B.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    high = top_rows(orders, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 10).withColumn("side", F.lit("largest"))
    low = top_rows(orders, [F.col("o_totalprice"), F.col("o_orderkey")], 10).withColumn("side", F.lit("smallest"))
    return high.unionByName(low)


@query(
    "quick_stats_of_result",
    """
SELECT min(n) AS min_value, max(n) AS max_value, round(avg(n), 6) AS mean_value, 'n' AS column_name
FROM (SELECT o_custkey, CAST(count(*) AS DOUBLE) AS n FROM orders GROUP BY 1)""",
)
def quick_stats_of_result(spark, sf_dir):
    result = B.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return rounded(reports.quick_stats(result))


# ---- a deterministic score stands in for a model ---------------------------------

SCORED_SQL = f"""
scored AS (
  SELECT *, CASE WHEN position <= 3 THEN 1 ELSE 0 END AS target_podium, CASE WHEN position = 1 THEN 1 ELSE 0 END AS target_winner,
         round(coalesce(avg(position) OVER {LAST5}, 10), 6) AS prediction FROM contest)"""


def scored(spark, sf_dir):
    df = gold.rolling_form(_targets(spark, sf_dir))
    return df.withColumn("prediction", F.round(F.coalesce("rolling_avg_position_5", F.lit(10.0)), 6))


@query(
    "regression_metrics",
    _with(SCORED_SQL) + """
SELECT season, count(*) AS rows, round(avg(abs(position - prediction)), 6) AS mae,
       round(sqrt(avg((position - prediction) * (position - prediction))), 6) AS rmse,
       round(1 - sum((position - prediction) * (position - prediction)) / (var_pop(position) * count(*)), 6) AS r2,
       round(avg(CAST(abs(position - prediction) <= 2 AS INTEGER)), 6) AS within_two
FROM scored WHERE position IS NOT NULL GROUP BY season""",
)
def regression_metrics(spark, sf_dir):
    return rounded(evaluate.regression_metrics(scored(spark, sf_dir), "target_position", "prediction", ["season"]))


@query(
    "classification_metrics",
    _with(SCORED_SQL) + """
SELECT *, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
       round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1
FROM (SELECT season, count(*) FILTER (WHERE t = 1 AND p = 1) AS tp, count(*) FILTER (WHERE t = 0 AND p = 1) AS fp,
             count(*) FILTER (WHERE t = 1 AND p = 0) AS fn, count(*) FILTER (WHERE t = 0 AND p = 0) AS tn
      FROM (SELECT season, target_podium AS t, CASE WHEN prediction <= 20 THEN 1 ELSE 0 END AS p FROM scored) GROUP BY season)""",
)
def classification_metrics(spark, sf_dir):
    df = scored(spark, sf_dir).withColumn("podium_call", flag(F.col("prediction") <= 20))
    return rounded(evaluate.classification_metrics(df, "target_podium", "podium_call", ["season"]))


HITS_SQL = """
ranked AS (SELECT *, row_number() OVER (PARTITION BY season, round ORDER BY prediction, driver_id) AS place FROM scored),
hits AS (SELECT season, round, max(CASE WHEN place = 1 AND target_winner = 1 THEN 1 ELSE 0 END) AS top1_hit,
                max(CASE WHEN place <= 3 AND target_winner = 1 THEN 1 ELSE 0 END) AS topk_hit FROM ranked GROUP BY 1, 2)"""


@query("race_hits", _with(SCORED_SQL, HITS_SQL) + " SELECT season, round, top1_hit, topk_hit FROM hits")
def race_hits(spark, sf_dir):
    df = scored(spark, sf_dir).withColumn("score", -F.col("prediction"))
    return evaluate.race_hits(df, "score", "target_winner", "driver_id")


@query(
    "rank_metrics",
    _with(SCORED_SQL, HITS_SQL) + """
SELECT count(*) AS races, round(avg(top1_hit), 6) AS top1_rate, round(avg(topk_hit), 6) AS topk_rate FROM hits""",
)
def rank_metrics(spark, sf_dir):
    df = scored(spark, sf_dir).withColumn("score", -F.col("prediction"))
    return rounded(evaluate.rank_metrics(df, "score", "target_winner", "driver_id"))


@query(
    "race_reports",
    _with(SCORED_SQL) + """
, known AS (SELECT *, row_number() OVER (PARTITION BY season, round ORDER BY prediction, driver_id) AS pr,
                   row_number() OVER (PARTITION BY season, round ORDER BY position, driver_id) AS ar
            FROM scored WHERE position IS NOT NULL)
SELECT season, round, count(*) AS drivers, max(CASE WHEN pr = 1 THEN driver_id END) AS predicted_winner,
       max(CASE WHEN ar = 1 THEN driver_id END) AS actual_winner,
       bool_or(pr = 1 AND ar = 1) AS correct, bool_or(pr <= 3 AND ar = 1) AS in_top3
FROM known GROUP BY season, round""",
)
def race_reports(spark, sf_dir):
    return evaluate.race_report(scored(spark, sf_dir), "prediction", "target_position", "driver_id")


@query(
    "driver_errors",
    _with(SCORED_SQL) + f"""
SELECT {K}, predicted_rank, position AS target_position, predicted_rank - position AS error
FROM (SELECT *, CAST(floor(rank() OVER (PARTITION BY season, round ORDER BY prediction)
                + (count(*) OVER (PARTITION BY season, round, prediction) - 1) / 2.0) AS BIGINT) AS predicted_rank FROM scored)""",
)
def driver_errors(spark, sf_dir):
    df = evaluate.driver_errors(scored(spark, sf_dir), "prediction", "target_position", B.races_of(spark, sf_dir))
    return df.select(*KEY, "predicted_rank", "target_position", "error")


@query(
    "worst_circuits_and_drivers",
    _with(SCORED_SQL) + """
(SELECT CAST(circuit_id AS VARCHAR) AS name, round(avg(abs(position - prediction)), 6) AS mean_abs_error, 'circuit' AS kind
 FROM scored WHERE position IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3)
UNION ALL
(SELECT CAST(driver_id AS VARCHAR) AS name, round(avg(abs(position - prediction)), 6) AS mean_abs_error, 'driver' AS kind
 FROM scored WHERE position IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3)""",
)
def worst_circuits_and_drivers(spark, sf_dir):
    df = scored(spark, sf_dir).filter(F.col("target_position").isNotNull())
    df = df.withColumn("abs_error", F.abs(F.col("target_position") - F.col("prediction")))
    circuits = reports.worst_groups(df, "circuit_id").withColumn("kind", F.lit("circuit"))
    drivers = reports.worst_groups(df, "driver_id").withColumn("kind", F.lit("driver"))
    return rounded(circuits.unionByName(drivers))


@query(
    "prediction_list",
    _with(SCORED_SQL) + """
, r AS (SELECT *, 1 / (1 + prediction) AS score FROM scored
        WHERE (season, round) IN (SELECT DISTINCT (season, round) FROM scored ORDER BY 1 LIMIT 10)),
p AS (SELECT *, row_number() OVER (PARTITION BY season, round ORDER BY score DESC, driver_id) AS place FROM r)
SELECT season, round,
       string_agg(driver_id || ' (' || printf('%.1f', score * 100) || '%)', ', ' ORDER BY place) FILTER (WHERE place <= 3) AS predicted,
       min(CASE WHEN target_winner = 1 THEN CAST(driver_id AS VARCHAR) END) AS winner, bool_or(place = 1 AND target_winner = 1) AS hit
FROM p GROUP BY season, round""",
)
def prediction_list(spark, sf_dir):
    df = scored(spark, sf_dir).withColumn("score", 1 / (1 + F.col("prediction")))
    return evaluate.prediction_list(df, "score", "target_winner", "driver_id")


@query(
    "retrain_decision",
    _with(SCORED_SQL) + """
SELECT season, round(mae, 6) AS mae, round(f1, 6) AS f1, mae > 4 OR f1 < 0.5 AS retrain FROM (
  SELECT season, avg(abs(position - prediction)) AS mae,
         coalesce(2.0 * count(*) FILTER (WHERE target_podium = 1 AND prediction <= 20) / nullif(
           2 * count(*) FILTER (WHERE target_podium = 1 AND prediction <= 20)
           + count(*) FILTER (WHERE target_podium = 0 AND prediction <= 20)
           + count(*) FILTER (WHERE target_podium = 1 AND prediction > 20), 0), 0) AS f1
  FROM scored GROUP BY season)""",
)
def retrain_decision(spark, sf_dir):
    df = scored(spark, sf_dir).withColumn("podium_call", flag(F.col("prediction") <= 20))
    errors = evaluate.regression_metrics(df, "target_position", "prediction", ["season"]).select("season", "mae")
    calls = evaluate.classification_metrics(df, "target_podium", "podium_call", ["season"]).select("season", "f1")
    out = calendar_join(errors, calls, ["season"])
    return rounded(out.withColumn("retrain", evaluate.retrain_gate(F.col("mae"), F.col("f1"))))


@query(
    "evaluation_report",
    _with(SCORED_SQL) + """
, test AS (SELECT *, abs(position - prediction) AS err, CASE WHEN prediction <= 20 THEN 1 ELSE 0 END AS call
           FROM scored WHERE season = (SELECT max(season) FROM scored)),
m AS (SELECT avg(err) AS mae, CAST(count(err) AS DOUBLE) AS pos_rows, CAST(count(*) AS DOUBLE) AS pod_rows,
             coalesce(2.0 * sum(target_podium * call) / nullif(sum(target_podium) + sum(call), 0), 0) AS f1 FROM test),
worst AS (
  SELECT 'worst_circuits' AS section, CAST(circuit_id AS VARCHAR) AS name, avg(err) AS value FROM test WHERE err IS NOT NULL GROUP BY 2
  UNION ALL
  SELECT 'worst_drivers', CAST(driver_id AS VARCHAR), avg(err) FROM test WHERE err IS NOT NULL GROUP BY 2)
SELECT 'position' AS section, 1 AS place, 'mae' AS name, round(mae, 6) AS value FROM m
UNION ALL SELECT 'position', 2, 'rows', pos_rows FROM m
UNION ALL SELECT 'podium', 1, 'f1', round(f1, 6) FROM m
UNION ALL SELECT 'podium', 2, 'rows', pod_rows FROM m
UNION ALL SELECT 'retrain', 1, 'mae_too_large', CAST(mae > 4 AS INTEGER) FROM m
UNION ALL SELECT 'retrain', 2, 'f1_too_small', CAST(f1 < 0.5 AS INTEGER) FROM m
UNION ALL SELECT 'retrain', 3, 'retrain', CAST(mae > 4 OR f1 < 0.5 AS INTEGER) FROM m
UNION ALL (SELECT section, CAST(row_number() OVER (PARTITION BY section ORDER BY value DESC, name) AS INTEGER) AS place, name,
                  round(value, 6) FROM worst QUALIFY place <= 3)""",
)
def evaluation_report(spark, sf_dir):
    """Over the latest season, as the test period."""
    df = scored(spark, sf_dir).withColumn("podium_call", flag(F.col("prediction") <= 20))
    test = materialised(latest_period(df, ["season"]), "test-season")
    return rounded(evaluate.evaluation_report(test, "target_position", "target_podium", "podium_call", "prediction"))


# ---- health, hypotheses, briefing ------------------------------------------------

CURRENT_SEASON = 202406

HEALTH_SQL = f"""
h AS (
  SELECT count(*) AS n, max(season) AS latest, max(grid) AS g, 100.0 * count(target_position) / count(*) AS tp,
         100.0 * count(target_podium) / count(*) AS tq FROM gold),
nulls AS (
  SELECT column_name, round(100.0 - 100.0 * c / n, 1) AS pct
  FROM (UNPIVOT (SELECT count(COLUMNS(*)) FROM gold) ON COLUMNS(*) INTO NAME column_name VALUE c), (SELECT count(*) AS n FROM gold)),
rules AS (
  SELECT 'row_count' AS rule, CAST(n AS DOUBLE) AS observed, CAST(2500 AS DOUBLE) AS threshold, n >= 2500 AS passed FROM h
  UNION ALL SELECT 'latest_season', latest, {CURRENT_SEASON - 1}, latest >= {CURRENT_SEASON - 1} FROM h
  UNION ALL SELECT 'grid_max', g, 25, g <= 25 FROM h
  UNION ALL SELECT 'target_position_coverage', tp, 80, tp >= 80 FROM h
  UNION ALL SELECT 'target_podium_coverage', tq, 80, tq >= 80 FROM h
  UNION ALL SELECT column_name || '_nulls', pct, 50, pct <= 50 FROM nulls)"""


def _rules(spark, sf_dir):
    df = _targets(spark, sf_dir)
    return quality.health_rules(df, ["target_position", "target_podium"], CURRENT_SEASON)


@query(
    "health_report",
    _with(TARGETS_SQL, HEALTH_SQL) + " SELECT rule, round(observed, 6) AS observed, threshold, passed FROM rules",
)
def health_report(spark, sf_dir):
    return rounded(_rules(spark, sf_dir))


@query(
    "health_status",
    _with(TARGETS_SQL, HEALTH_SQL) + """
SELECT CASE WHEN count(*) FILTER (WHERE NOT passed) = 0 THEN 'HEALTHY' ELSE 'ISSUES_FOUND' END AS status,
       count(*) FILTER (WHERE NOT passed) AS issues_count,
       coalesce(string_agg(rule, ',' ORDER BY rule) FILTER (WHERE NOT passed), '') AS issues FROM rules""",
)
def health_status(spark, sf_dir):
    return quality.health_status(_rules(spark, sf_dir))


@query(
    "table_profile",
    _with(TARGETS_SQL) + """
SELECT count(*) AS total_rows, max(season) AS latest_season, min(grid) AS grid_min, max(grid) AS grid_max,
       round(100.0 * count(target_position) / count(*), 1) AS target_position_valid_pct,
       round(100.0 * count(target_winner) / count(*), 1) AS target_winner_valid_pct FROM gold""",
)
def table_profile(spark, sf_dir):
    return quality.profile(_targets(spark, sf_dir), ["target_position", "target_winner"])


CANDIDATES = ["constructor_dominance", "quali_trend", "home_advantage", "grid_spread", "points_acceleration"]

CANDIDATE_SQL = f"""
rows0 AS (
  SELECT c.*, t.constructor_rolling_points, cum.season_cumulative_points AS cp,
         row_number() OVER (PARTITION BY driver_id ORDER BY season, round) AS rn
  FROM contest c LEFT JOIN team_form t USING (constructor_id, season, round) JOIN cum USING (season, round, driver_id)),
cand AS (
  SELECT position AS y,
         constructor_rolling_points / nullif(avg(constructor_rolling_points) OVER (PARTITION BY season, round), 0) AS constructor_dominance,
         CASE WHEN count(best_quali_seconds) OVER {NOW5} >= 2 THEN regr_slope(best_quali_seconds, rn) OVER {NOW5} END AS quali_trend,
         avg(position) OVER {LAST5} - avg(position) OVER {VENUE} AS home_advantage,
         stddev_samp(grid) OVER {NOW5} AS grid_spread,
         cp - 2 * lag(cp, 1) OVER s + lag(cp, 2) OVER s AS points_acceleration
  FROM rows0 WINDOW s AS (PARTITION BY driver_id, season ORDER BY round))"""


def _hypotheses(spark, sf_dir):
    df = gold.season_points(gold.circuit_history(gold.rolling_form(_targets(spark, sf_dir))))
    df = rolling_slope(df, ["driver_id"], gold.ORDER, "best_quali_seconds", "quali_trend", hot=BOUNDED)
    df = rolling(df, ["driver_id"], gold.ORDER, {"grid_spread": lambda w: F.stddev_samp("grid").over(w)}, -4, 0, BOUNDED)
    df = second_difference(df, ["driver_id", "season"], ["round"], "season_cumulative_points", "points_acceleration", BOUNDED)
    base, races = B.contest(spark, sf_dir), B.races_of(spark, sf_dir)
    df = gold.dominance(gold.constructor_form(df, hot=races, source=base), gold.constructor_form(base, hot=races))
    df = df.withColumn("home_advantage", F.col("rolling_avg_position_5") - F.col("circuit_avg_position"))
    found = correlations(df, {c: c for c in CANDIDATES}, "target_position")
    return quality.accepted_features(found, ["constructor_dominance"])


@query(
    "feature_hypotheses",
    _with(TEAM_SQL, CUM_SQL, CANDIDATE_SQL) + " UNION ALL ".join(
        f"""
SELECT '{c}' AS feature, regr_count(y, {c}) AS pairs, round(CASE WHEN regr_count(y, {c}) > 100 THEN corr({c}, y) END, 6) AS correlation,
       coalesce(abs(CASE WHEN regr_count(y, {c}) > 100 THEN corr({c}, y) END) > {0.1 if c == 'constructor_dominance' else 0.05}, false)
         AS accepted FROM cand""".replace("regr_count(", "CAST(regr_count(").replace(") AS pairs", ") AS BIGINT) AS pairs").replace(
            ") > 100", ") AS BIGINT) > 100")
        for c in CANDIDATES
    ),
)
def feature_hypotheses(spark, sf_dir):
    return rounded(_hypotheses(spark, sf_dir))


@query(
    "latest_race_summary",
    _with(TARGETS_SQL, HEALTH_SQL, TEAM_SQL, CUM_SQL, CANDIDATE_SQL) + """
, last AS (SELECT * FROM contest WHERE (season, round) = (SELECT (season, round) FROM contest ORDER BY season DESC, round DESC LIMIT 1)
           AND position IS NOT NULL ORDER BY position, driver_id LIMIT 10)
SELECT max(season) AS season, max(round) AS round,
       '[' || string_agg('{"target_position":' || position || ',"driver_id":' || driver_id || ',"grid":' || grid || '}', ','
                  ORDER BY position, driver_id, grid) || ']' AS top,
       (SELECT CASE WHEN count(*) FILTER (WHERE NOT passed) = 0 THEN 'HEALTHY' ELSE 'ISSUES_FOUND' END FROM rules) AS status,
       (SELECT count(*) FILTER (WHERE NOT passed) FROM rules) AS issues_count,
       (SELECT string_agg(rule, ',' ORDER BY rule) FILTER (WHERE NOT passed) FROM rules) AS issues,
       (SELECT CAST(abs(corr(constructor_dominance, y)) > 0.1 AS BIGINT) + CAST(abs(corr(quali_trend, y)) > 0.05 AS BIGINT)
             + CAST(abs(corr(home_advantage, y)) > 0.05 AS BIGINT) + CAST(abs(corr(grid_spread, y)) > 0.05 AS BIGINT)
             + CAST(abs(corr(points_acceleration, y)) > 0.05 AS BIGINT) FROM cand) AS accepted_features,
       (SELECT round(avg(abs(grid - position)), 6) FROM contest) AS mae
FROM last""",
)
def latest_race_summary(spark, sf_dir):
    df = _targets(spark, sf_dir)
    metrics = evaluate.regression_metrics(df, "target_position", "grid").select("mae")
    return rounded(reports.latest_summary(df, _rules(spark, sf_dir), _hypotheses(spark, sf_dir), metrics))


# ---- run history: one run per day of events ---------------------------------------

RUNS_SQL = """
runs AS (
  SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id, CAST(ts AS DATE) AS run_date, count(*) AS row_count,
         CAST(count(DISTINCT event_type) AS INTEGER) AS proposed,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mae,
         max(value) > 400 AS retrain, 'T' || (max(user_id) % 3) AS worst,
         CASE WHEN count(*) % 3 = 0 THEN 'ISSUES_FOUND' ELSE 'HEALTHY' END AS status, CAST(count(*) % 4 AS INTEGER) AS accepted
  FROM events GROUP BY 1, 2)"""


def run_records(spark, sf_dir):
    """Run records in the declared schema, derived from one aggregate per day."""
    days = B.table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("run_date")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("event_type").alias("kinds"),
        F.sum(B.money("value")).cast("double").alias("total"), F.max("value").alias("top"), F.max("user_id").alias("user"),
    )
    feature = lambda i: F.struct(F.concat(F.lit("f"), i.cast("string")).alias("name"), F.lit(0.1).alias("correlation"))
    count = F.col("n") % 4
    accepted = F.transform(F.when(count > 0, F.sequence(F.lit(1).cast("long"), count)).otherwise(F.array().cast("array<bigint>")), feature)
    return days.select(
        F.col("run_date").cast("string").alias("run_id"), F.col("run_date").cast("timestamp").alias("ts"), "run_date",
        F.struct(
            F.when(F.col("n") % 3 == 0, "ISSUES_FOUND").otherwise("HEALTHY").alias("status"),
            F.col("n").alias("row_count"), F.create_map(F.lit("grid"), F.lit(0.0)).alias("null_rates"),
        ).alias("health"),
        F.col("kinds").cast("int").alias("features_proposed"),
        accepted.alias("features_accepted"),
        F.array().cast("array<struct<name:string,correlation:double>>").alias("features_rejected"),
        (F.col("total") / F.col("n")).alias("model_mae"),
        F.array(F.concat(F.lit("T"), (F.col("user") % 3).cast("string"))).alias("worst_circuits"),
        (F.col("top") > 400).alias("retrain_triggered"),
        F.lit("").alias("briefing_preview"),
    )


@query(
    "run_history_recent",
    f"""WITH {RUNS_SQL}
SELECT run_id AS date, status AS data_health, round(mae, 6) AS model_mae, accepted AS features_found,
       CASE WHEN retrain THEN 'Yes' ELSE 'No' END AS retrain, worst AS worst_circuit
FROM runs ORDER BY run_id DESC LIMIT 20""",
)
def run_history_recent(spark, sf_dir):
    return rounded(history.display(history.recent(run_records(spark, sf_dir))))


@query(
    "run_history_retained",
    f"""WITH {RUNS_SQL} SELECT run_id, round(mae, 6) AS model_mae FROM runs ORDER BY run_id DESC LIMIT 20""",
)
def run_history_retained(spark, sf_dir):
    """Runs appended one half after the other, of which the last 20 are kept."""
    records = materialised(run_records(spark, sf_dir), "records")
    half, path = F.pmod(F.xxhash64("run_id"), F.lit(2)), shared_dir(spark, "runs")
    for part in (0, 1):
        history.append_run(records.filter(half == part), path)
    kept = history.recent(spark.read.schema(records.schema).parquet(path))
    return rounded(kept.select("run_id", "model_mae"))


@query(
    "added_columns",
    _with(TARGETS_SQL) + """
SELECT column_name, filled FROM (SELECT count(target_position) AS target_position, count(target_podium) AS target_podium,
  count(target_points_finish) AS target_points_finish, count(target_winner) AS target_winner FROM gold)
UNPIVOT (filled FOR column_name IN (COLUMNS(*)))""",
)
def added_columns(spark, sf_dir):
    """The columns that the target step adds, with their filled rows."""
    before = B.contest(spark, sf_dir)
    after = gold.targets(before)
    names = integrate.added_columns(before, after)
    wide = after.agg(*[F.count(c).alias(c) for c in names])
    return wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled")) for c in names])))


@query(
    "run_history_trend",
    f"""WITH {RUNS_SQL}, last5 AS (SELECT * FROM runs ORDER BY run_id DESC LIMIT 5)
SELECT count(*) AS runs, round(arg_min(mae, run_id), 6) AS first_mae, round(arg_max(mae, run_id), 6) AS last_mae,
       CAST(sum(accepted) AS BIGINT) AS accepted, CAST(sum(proposed) AS BIGINT) AS proposed,
       count(*) FILTER (WHERE status <> 'HEALTHY') AS unhealthy, count(*) FILTER (WHERE retrain) AS retrained,
       CASE WHEN arg_max(mae, run_id) < arg_min(mae, run_id) THEN 'improving'
            WHEN arg_max(mae, run_id) > arg_min(mae, run_id) THEN 'degrading' ELSE 'stable' END AS mae_trend
FROM last5""",
)
def run_history_trend(spark, sf_dir):
    return rounded(history.trend(run_records(spark, sf_dir)))


@query(
    "recurring_weak_circuits",
    f"""WITH {RUNS_SQL}, last5 AS (SELECT * FROM runs ORDER BY run_id DESC LIMIT 5)
SELECT worst AS circuit, count(*) AS times FROM last5 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3""",
)
def recurring_weak_circuits(spark, sf_dir):
    return history.recurring_circuits(run_records(spark, sf_dir))


@query(
    "step_success_rate",
    """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id, count(*) AS steps,
       count(*) FILTER (WHERE event_type NOT IN ('error', 'view')) AS succeeded,
       round(avg(CASE WHEN event_type NOT IN ('error', 'view') THEN 1 ELSE 0 END), 6) AS success_rate
FROM events GROUP BY 1""",
)
def step_success_rate(spark, sf_dir):
    kind = F.col("event_type")
    status = F.when(kind == "error", "failed").when(kind == "view", "skipped").when(kind == "click", "triggered").otherwise("ok")
    steps = B.table(spark, sf_dir, "events").select(F.to_date("ts").cast("string").alias("run_id"), status.alias("status"))
    return rounded(history.step_log(steps))


METRIC_SQL = """
metrics AS (
  SELECT o_orderstatus AS task, split_part(o_orderpriority, '-', 2) AS model, CAST(year(o_orderdate) AS VARCHAR) AS run_id,
         CAST(min(CAST(substr(o_orderpriority, 1, 1) AS INTEGER)) AS INTEGER) AS tried,
         round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*), 4) AS value
  FROM orders GROUP BY 1, 2, 3)"""


def _metrics(spark, sf_dir, *by):
    orders = B.table(spark, sf_dir, "orders")
    named = orders.select(
        F.col("o_orderstatus").alias("task"), F.split("o_orderpriority", "-")[1].alias("model"),
        F.year("o_orderdate").cast("string").alias("run_id"), F.substring("o_orderpriority", 1, 1).cast("int").alias("tried"),
        "o_totalprice",
    )
    return named.groupBy(*by).agg(
        F.min("tried").alias("tried"),
        F.round(F.sum(B.money("o_totalprice")).cast("double") / F.count(F.lit(1)), 4).alias("value"),
    )


@query(
    "best_model_per_task",
    f"""WITH {METRIC_SQL}, m AS (SELECT * FROM metrics WHERE run_id = '1996')
SELECT task, model, value FROM (SELECT *, row_number() OVER (PARTITION BY task ORDER BY value, tried) AS rn FROM m) WHERE rn = 1""",
)
def best_model_per_task(spark, sf_dir):
    df = _metrics(spark, sf_dir, "task", "model", "run_id").filter("run_id = '1996'")
    return history.best_model(df, higher_is_better=False)


@query(
    "old_and_new_metrics",
    f"""WITH {METRIC_SQL}
SELECT task, model AS metric, a.value AS old_value, b.value AS new_value, round(b.value - a.value, 4) AS change
FROM (SELECT * FROM metrics WHERE run_id = '1995') a FULL JOIN (SELECT * FROM metrics WHERE run_id = '2000') b USING (task, model)""",
)
def old_and_new_metrics(spark, sf_dir):
    df = _metrics(spark, sf_dir, "task", "model", "run_id").withColumnRenamed("model", "metric")
    return rounded(history.compare_runs(df, "1995", "2000"), 4)


@query(
    "model_comparison_table",
    f"""WITH {METRIC_SQL}
SELECT task, model, max(CASE WHEN run_id = '1995' THEN value END) AS "1995", max(CASE WHEN run_id = '1996' THEN value END) AS "1996"
FROM metrics GROUP BY task, model""",
)
def model_comparison_table(spark, sf_dir):
    df = _metrics(spark, sf_dir, "task", "model", "run_id").withColumnRenamed("run_id", "metric")
    return history.comparison_table(df, ["1995", "1996"])


# ---- rating -------------------------------------------------------------------

ELO_SQL = """
steps AS (SELECT season, round, row_number() OVER (ORDER BY season, round) AS step FROM (SELECT DISTINCT season, round FROM contest)),
entries AS (SELECT step, season, round, driver_id, position FROM contest JOIN steps USING (season, round)),
r AS (
  SELECT CAST(1 AS BIGINT) AS step, driver_id, CAST(1500 AS DOUBLE) AS rating FROM (SELECT DISTINCT driver_id FROM contest)
  UNION ALL
  SELECT r.step + 1, r.driver_id, r.rating + coalesce(d.delta, 0)
  FROM r LEFT JOIN (
    SELECT a.step, a.driver_id, 32 * avg(CASE WHEN a.position < b.position THEN 1.0 ELSE 0.0 END
             - 1 / (1 + pow(10.0, (rb.rating - ra.rating) / 400))) AS delta
    FROM entries a JOIN entries b ON a.step = b.step AND a.driver_id <> b.driver_id
      JOIN r ra ON ra.step = a.step AND ra.driver_id = a.driver_id
      JOIN r rb ON rb.step = b.step AND rb.driver_id = b.driver_id
    WHERE a.position IS NOT NULL AND b.position IS NOT NULL GROUP BY 1, 2) d
  ON d.step = r.step AND d.driver_id = r.driver_id
  WHERE r.step <= (SELECT max(step) FROM steps)),
elo AS (SELECT season, round, driver_id, rating FROM entries JOIN r USING (step, driver_id))"""


def ratings(spark, sf_dir, mode, contests=None):
    df = (B.contest(spark, sf_dir) if contests is None else contests).withColumn("universe", F.lit("all"))
    return elo(df, ["universe"], B.RACE, "driver_id", "position", mode=mode).drop("universe")


# The last season of the first refresh.
LAST_RATED = 202402

# A universe is an event type: each of its days is a contest of the users by what they scored.
RATED_SQL = """
scores AS (
  SELECT event_type AS universe, CAST(isoyear(CAST(ts AS DATE)) * 100 + week(CAST(ts AS DATE)) AS INTEGER) AS season,
         CAST(isodow(CAST(ts AS DATE)) AS INTEGER) AS round, user_id AS driver_id, sum(round(value * 100)) AS score
  FROM events GROUP BY ALL),
rated AS (SELECT *, rank() OVER (PARTITION BY universe, season, round ORDER BY score DESC NULLS LAST) AS position FROM scores),
people AS (
  SELECT universe, driver_id, row_number() OVER (PARTITION BY universe ORDER BY driver_id) AS i
  FROM (SELECT DISTINCT universe, driver_id FROM rated)),
fields AS (
  SELECT universe, season, round, list(i ORDER BY position, driver_id) AS who, list(position ORDER BY position, driver_id) AS places,
         row_number() OVER (PARTITION BY universe ORDER BY season, round) AS step
  FROM rated JOIN people USING (universe, driver_id) GROUP BY universe, season, round),
starts AS (SELECT universe, list(CAST(1500 AS DOUBLE)) AS r FROM people GROUP BY universe)"""


def _moved(rating, now):
    """SQL of a list of ratings in which the entrant at place j has moved; `now` are the ratings opponents are read from."""
    return f"""list_transform({rating}, lambda x, k: CASE WHEN k = f.who[c.j] AND len(f.who) > 1 THEN
      x + 32 * (len(list_filter(f.places, lambda p: p > f.places[c.j])) + 0.5
                - list_sum(list_transform(f.who, lambda o: 1 / (1 + pow(10.0, ({now}[o] - {now}[f.who[c.j]]) / 400))))) / (len(f.who) - 1)
      ELSE x END)"""


def rating_sql(mode):
    """One step per entrant; `held` are the ratings before the contest."""
    opponents = "c.r" if mode == "sequential" else "c.held"
    moved = _moved("c.r", opponents)
    return "WITH RECURSIVE " + RATED_SQL + f""",
c AS (
  SELECT universe, CAST(1 AS BIGINT) AS step, CAST(1 AS BIGINT) AS j, r, r AS held FROM starts
  UNION ALL
  SELECT universe, CASE WHEN last THEN step + 1 ELSE step END, CASE WHEN last THEN 1 ELSE j + 1 END, r,
         CASE WHEN last THEN r ELSE held END
  FROM (SELECT c.universe, c.step, c.j, c.j = len(f.who) AS last, c.held, {moved} AS r
        FROM c JOIN fields f ON f.universe = c.universe AND f.step = c.step))
SELECT universe, season, round, driver_id, round(c.held[i], 6) AS rating
FROM rated JOIN people USING (universe, driver_id) JOIN fields USING (universe, season, round)
  JOIN c ON c.universe = rated.universe AND c.step = fields.step AND c.j = 1"""


def rated_contests(spark, sf_dir):
    day = F.to_date("ts")
    scores = B.table(spark, sf_dir, "events").groupBy(
        F.col("event_type").alias("universe"), *B.calendar_columns(day), F.col("user_id").alias("driver_id")
    ).agg(F.sum(B.cents("value")).alias("score"))
    return with_rank(scores, ["universe", *B.RACE], "score", "position")


def universe_ratings(spark, sf_dir, mode):
    return elo(rated_contests(spark, sf_dir), ["universe"], B.RACE, "driver_id", "position", mode=mode)


@query("rating_simultaneous", rating_sql("simultaneous"))
def rating_simultaneous(spark, sf_dir):
    return rounded(universe_ratings(spark, sf_dir, "simultaneous"))


@query("rating_sequential", rating_sql("sequential"))
def rating_sequential(spark, sf_dir):
    return rounded(universe_ratings(spark, sf_dir, "sequential"))


@query("rating_refreshed", rating_sql("simultaneous"))
def rating_refreshed(spark, sf_dir):
    """The first seasons, then the whole table, of which only the new contests are folded."""
    contests = materialised(rated_contests(spark, sf_dir), "contests")
    store = shared_dir(spark, "ratings")
    for part in (contests.filter(F.col("season") <= LAST_RATED), contests):
        history = refresh_ratings(part, store, ["universe"], B.RACE, "driver_id", "position", mode="simultaneous")
    return rounded(history)


@query(
    "rating_against_field",
    "WITH RECURSIVE " + B.CONTEST_SQL + "," + ELO_SQL + f"""
SELECT {K}, round(rating, 6) AS driver_elo, round(rating - avg(rating) OVER (PARTITION BY season, round), 6) AS elo_vs_field FROM elo""",
)
def rating_against_field(spark, sf_dir):
    df = against_field(B.contest(spark, sf_dir), ratings(spark, sf_dir, "simultaneous"), B.RACE, "driver_id")
    return rounded(df.select(*KEY, "driver_elo", "elo_vs_field"))


# ---- ad-hoc questions -----------------------------------------------------------

RACE_DATA_SQL = "race_data AS (SELECT g.*, e.rating FROM gold_table g JOIN elo e USING (season, round, driver_id))"


def race_data(spark, sf_dir, with_rating):
    df = gold.field_context(_targets(spark, sf_dir))
    if with_rating:
        df = against_field(df, ratings(spark, sf_dir, "simultaneous"), B.RACE, "driver_id").withColumnRenamed("driver_elo", "rating")
    return df


SEASON = "(SELECT max(season) FROM race_data)"
DRIVER = "(SELECT min(driver_id) FROM race_data)"


def _register(name):
    text = questions.QUESTIONS[name].format(season=SEASON, driver=DRIVER)
    sql = (
        "WITH RECURSIVE " + ",".join([B.CONTEST_SQL, ELO_SQL, TEAM_SQL, GOLD_SQL, RACE_DATA_SQL])
        + f" SELECT * FROM ({text}) LIMIT {questions.ROW_CAP}"
    )

    @query(f"ask_{name}", sql)
    def answer(spark, sf_dir):
        data = race_data(spark, sf_dir, name == "top_five_by_rating")
        return questions.ask(data, name, season=SEASON, driver=DRIVER)


for _name in questions.QUESTIONS:
    _register(_name)

# Questions that name a season: what they ask about, and the answer.
SEASON_QUESTIONS = {"most_wins_in_season": ("driver_id", "wins"), "mean_pole_gap_per_team": ("constructor_id", "avg_gap")}


@query(
    "ask_stored_season",
    "WITH " + ",".join([B.CONTEST_SQL, TEAM_SQL, GOLD_SQL, "race_data AS (SELECT * FROM gold_table)"])
    + " UNION ALL ".join(
        f" SELECT '{name}' AS question, CAST({who} AS VARCHAR) AS asked, CAST({what} AS DOUBLE) AS answer FROM (SELECT * FROM ("
        + questions.QUESTIONS[name].format(season=SEASON) + f") LIMIT {questions.ROW_CAP})"
        for name, (who, what) in SEASON_QUESTIONS.items()
    ),
)
def ask_stored_season(spark, sf_dir):
    """The wide table is stored by season once; both questions read the latest season's files."""
    data = questions.store_race_data(race_data(spark, sf_dir, False), shared_dir(spark, "race-data"))
    answers = [
        questions.ask(data, name, season=SEASON).select(
            F.lit(name).alias("question"), F.col(who).cast("string").alias("asked"), F.col(what).cast("double").alias("answer"))
        for name, (who, what) in SEASON_QUESTIONS.items()
    ]
    return answers[0].unionByName(answers[1])


# ---- the wide table ---------------------------------------------------------------

COMPLETE_SQL = (
    "WITH RECURSIVE " + ",".join([
        B.CONTEST_SQL, ELO_SQL, TEAM_SQL, CUM_SQL, TARGETS_SQL, RISK_SQL, B.WEATHER_SQL, WEATHER_FEATURES_SQL, B.laps_sql("day"),
        CLEAN_SQL, LAP_FEATURES_SQL, DEG_SQL, TIRE_SQL,
    ]) + f""",
season_totals AS (
  SELECT season, driver_id, round(sum(points), 6) AS points, CAST(sum(CASE WHEN position = 1 THEN 1 ELSE 0 END) AS BIGINT) AS wins
  FROM contest GROUP BY 1, 2),
season_table AS (SELECT *, rank() OVER (PARTITION BY season ORDER BY points DESC) AS position FROM season_totals),
laps_by_entry AS (
  SELECT season, round, "Driver" AS driver_id, avg_lap_time, lap_consistency, num_stints,
         avg_lap_time - avg(avg_lap_time) OVER (PARTITION BY season, round) AS pace_vs_field
  FROM per_entry LEFT JOIN stint_count USING (season, round, "Driver")),
tire_by_entry AS (SELECT *, "Driver" AS driver_id FROM tire)
SELECT season, round, g.driver_id, g.target_position,
       round(t.constructor_rolling_points, 6) AS constructor_rolling_points,
       round(cum.season_cumulative_points, 6) AS season_cumulative_points,
       round(coalesce(v.d / v.n, 0.1), 6) AS circuit_dnf_rate,
       round(w.avg_track_temp, 6) AS avg_track_temp, CAST(w.rain > 0 AS INTEGER) AS had_rain,
       round(elo.rating, 6) AS driver_elo,
       coalesce(p.position, 20) AS prev_season_position, coalesce(p.wins, 0) AS prev_season_wins,
       CASE WHEN p.position <= 3 THEN 1 ELSE 0 END AS is_prev_top3,
       round(l.avg_lap_time, 6) AS avg_lap_time, round(l.lap_consistency, 6) AS lap_consistency, l.num_stints,
       round(l.pace_vs_field, 6) AS pace_vs_field, round(x.avg_tire_deg_slope, 6) AS avg_tire_deg_slope, x.stint_count_tire
FROM gold g LEFT JOIN team_form t USING (constructor_id, season, round) JOIN cum USING (season, round, driver_id)
LEFT JOIN venue v ON v.circuit_id = g.circuit_id AND v.season = g.season AND v.round = g.round
LEFT JOIN weather w USING (season, round) JOIN elo USING (season, round, driver_id)
LEFT JOIN season_table p ON p.season + 1 = g.season AND p.driver_id = g.driver_id
LEFT JOIN laps_by_entry l USING (season, round, driver_id) LEFT JOIN tire_by_entry x USING (season, round, driver_id)"""
)


def complete_table(spark, sf_dir):
    # Silver tables are written once; the gold steps scan them.
    master = materialised(B.contest(spark, sf_dir), "master")
    lap_rows = materialised(B.laps(spark, sf_dir), "laps")
    lap_table = integrate.lap_features(lap_rows, hot=B.lap_races_of(spark, sf_dir), by_driver=B.entries_of(spark, sf_dir))
    tires = integrate.tire_features(integrate.tire_degradation(lap_rows))
    seasons = B.checked(B.daily(spark, sf_dir).select("season", "driver_id").distinct(), sf_dir, "entrants", ["season"])
    return integrate.complete_features(
        master, silver.weather_features(B.samples(spark, sf_dir)), ratings(spark, sf_dir, "simultaneous", master), lap_table, tires,
        integrate.season_table(master, seasons), B.races_of(spark, sf_dir))


@query("complete_features", COMPLETE_SQL)
def complete_features(spark, sf_dir):
    df = complete_table(spark, sf_dir)
    return rounded(df.select(
        *KEY, "target_position", "constructor_rolling_points", "season_cumulative_points", "circuit_dnf_rate", "avg_track_temp",
        "had_rain", "driver_elo", "prev_season_position", "prev_season_wins", "is_prev_top3", "avg_lap_time", "lap_consistency",
        "num_stints", "pace_vs_field", "avg_tire_deg_slope", "stint_count_tire"))


@query(
    "briefing",
    _with(TARGETS_SQL, HEALTH_SQL) + """
SELECT 'season ' || max(season) || ' | data ' || (SELECT CASE WHEN count(*) FILTER (WHERE NOT passed) = 0 THEN 'HEALTHY'
         ELSE 'ISSUES_FOUND' END FROM rules) || ', ' || count(*) || ' rows | 0 features accepted | MAE '
       || printf('%.3f', round(avg(abs(grid - position)), 3)) || ' | retrain '
       || CASE WHEN avg(abs(grid - position)) > 4 THEN 'true' ELSE 'false' END AS briefing FROM gold""",
)
def briefing(spark, sf_dir):
    df = _targets(spark, sf_dir)
    # Three one-row tables.
    table = quality.profile(df, []).withColumn("k", F.lit(1))
    health = quality.health_status(_rules(spark, sf_dir)).withColumn("k", F.lit(1))
    errors = evaluate.regression_metrics(df, "target_position", "grid").withColumn("k", F.lit(1))
    one = table.join(health, "k").join(errors, "k")
    line = reports.briefing_line(
        F.concat(F.lit("season "), F.col("latest_season").cast("string")), F.col("status"), F.col("total_rows"), F.lit(0),
        F.round("mae", 3), evaluate.retrain_gate(F.col("mae"), F.lit(None).cast("double")).cast("string"))
    return one.select(line.alias("briefing"))
