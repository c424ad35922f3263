"""Cleaning, stops, laps, stints, weather and integration."""

from pyspark.sql import functions as F

from lapwise import bindings as B
from lapwise.functions import scalars as S
from lapwise.operators.groups import calendar_join, dedup_latest, group_stats, left_enrich, median
from lapwise.operators.ordered import BOUNDED
from lapwise.operators.quality import fill_rate, null_percent, quality_report
from lapwise.plans import gold, integrate, silver
from lapwise.plans.reports import distribution
from lapwise.queries.registry import query
from lapwise.session import shared_dir
from lapwise.sources import sinks

EK = 'season, round, "Driver"'

LINE_COLUMNS = ("l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus").split()


@query(
    "dedup_keep_latest",
    "SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS VARCHAR) AS shipped, " + ", ".join(LINE_COLUMNS) + """
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC,
""" + ", ".join(f"{c} DESC" for c in LINE_COLUMNS) + ") AS rn FROM lineitem) WHERE rn = 1",
)
def dedup_keep_latest(spark, sf_dir):
    lines = B.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", *LINE_COLUMNS)
    df = dedup_latest(lines, ["l_orderkey", "l_linenumber"], "l_shipdate")
    return df.select("l_orderkey", "l_linenumber",
                     F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("shipped"), *LINE_COLUMNS)


ORDER_COLUMNS = ('o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate', 'o_orderpriority')
ORDER_NULLS = " + ".join(f"count(*) - count({c})" for c in ORDER_COLUMNS)


@query(
    "dedup_quality_report",
    f"""
WITH o AS (SELECT * REPLACE (nullif(o_orderstatus, 'F') AS o_orderstatus) FROM orders),
d AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
SELECT 'orders' AS table_name, (SELECT count(*) FROM d) AS rows, {len(ORDER_COLUMNS)} AS columns,
       (SELECT {ORDER_NULLS} FROM o) AS nulls_before, (SELECT {ORDER_NULLS} FROM d) AS nulls_after,
       (SELECT count(*) FROM o) - (SELECT count(*) FROM d) AS duplicates_removed""",
)
def dedup_quality_report(spark, sf_dir):
    # All columns; one status counts as missing. Of a customer's orders the latest stays.
    orders = B.table(spark, sf_dir, "orders").withColumn("o_orderstatus", F.expr("nullif(o_orderstatus, 'F')"))
    return quality_report("orders", orders, dedup_latest(orders, ["o_custkey"], "o_orderdate"))


# Clock texts in good and bad forms, made from every event.
CLOCK_SQL = """
clocks AS (
  SELECT event_id, event_type, value,
         CASE event_type WHEN 'view' THEN CAST(floor(value / 60) AS BIGINT) || ':' || CAST(CAST(floor(value) AS BIGINT) % 60 AS VARCHAR) || '.25'
                         WHEN 'click' THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || '.5'
                         WHEN 'purchase' THEN '1:02:' || CAST(CAST(floor(value) AS BIGINT) % 60 AS VARCHAR)
                         WHEN 'signup' THEN 'x:1' END AS clock
  FROM events)"""


def _clocks(spark, sf_dir, *columns):
    whole = F.floor("value").cast("string")
    rest = (F.floor("value") % 60).cast("string")
    kind = F.col("event_type")
    clock = (
        F.when(kind == "view", F.concat(F.floor(F.col("value") / 60).cast("string"), F.lit(":"), rest, F.lit(".25")))
        .when(kind == "click", F.concat(whole, F.lit(".5")))
        .when(kind == "purchase", F.concat(F.lit("1:02:"), rest))
        .when(kind == "signup", F.lit("x:1"))
    )
    return B.table(spark, sf_dir, "events").select("event_id", "event_type", "value", *columns, clock.alias("clock"))


PARSED = """CASE WHEN len(string_split(clock, ':')) = 2
            THEN TRY_CAST(string_split(clock, ':')[1] AS DOUBLE) * 60 + TRY_CAST(string_split(clock, ':')[2] AS DOUBLE) END"""


@query("parse_clock", f"WITH {CLOCK_SQL} SELECT event_id, round({PARSED}, 6) AS seconds FROM clocks")
def parse_clock(spark, sf_dir):
    return S.rounded(_clocks(spark, sf_dir).select("event_id", S.parse_clock(F.col("clock")).alias("seconds")))


@query(
    "stop_durations",
    f"""WITH {CLOCK_SQL}
SELECT event_id, round(s, 6) AS duration_seconds, round(strict, 6) AS strict_seconds,
       coalesce(s > 5, false) AS is_slow_stop, coalesce(s > 15, false) AS is_problem_stop
FROM (SELECT event_id, TRY_CAST(clock AS DOUBLE) AS strict, coalesce(TRY_CAST(clock AS DOUBLE), {PARSED}) AS s FROM clocks)""",
)
def stop_durations(spark, sf_dir):
    df = _clocks(spark, sf_dir).select(
        "event_id", S.stop_seconds(F.col("clock")).alias("duration_seconds"),
        F.col("clock").try_cast("double").alias("strict_seconds"),
    )
    return S.rounded(
        df.select(
            "*",
            S.exceeds(F.col("duration_seconds"), S.SLOW_STOP_SECONDS).alias("is_slow_stop"),
            S.exceeds(F.col("duration_seconds"), S.PROBLEM_STOP_SECONDS).alias("is_problem_stop"),
        )
    )


@query(
    "type_enforcement",
    """
SELECT o_orderkey, TRY_CAST(o_orderstatus AS INTEGER) AS status_number,
       TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority,
       CAST(TRY_CAST(substr(CAST(o_orderdate AS VARCHAR), 1, 10) AS DATE) AS VARCHAR) AS order_day,
       CAST(TRY_CAST(o_orderpriority AS DATE) AS VARCHAR) AS bad_day
FROM orders""",
)
def type_enforcement(spark, sf_dir):
    return B.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_orderstatus").try_cast("int").alias("status_number"),
        F.substring("o_orderpriority", 1, 1).try_cast("int").alias("priority"),
        F.date_format("o_orderdate", "yyyy-MM-dd").try_cast("date").cast("string").alias("order_day"),
        F.col("o_orderpriority").try_cast("date").cast("string").alias("bad_day"),
    )


@query(
    "finish_status",
    """
SELECT event_id, s AS status, coalesce(regexp_matches(lower(s), 'finished|\\+'), false) AS finished,
       NOT coalesce(regexp_matches(lower(s), 'finished|\\+'), false) AS dnf
FROM (SELECT event_id, CASE event_type WHEN 'view' THEN 'Finished' WHEN 'click' THEN '+1 Lap' WHEN 'error' THEN 'Engine'
             WHEN 'purchase' THEN 'FINISHED' END AS s FROM events)""",
)
def finish_status(spark, sf_dir):
    kind = F.col("event_type")
    status = F.when(kind == "view", "Finished").when(kind == "click", "+1 Lap").when(kind == "error", "Engine").when(
        kind == "purchase", "FINISHED")
    df = B.table(spark, sf_dir, "events").select("event_id", status.alias("status"))
    return df.select("*", S.is_finished(F.col("status")).alias("finished"), (~S.is_finished(F.col("status"))).alias("dnf"))


@query(
    "best_of_three",
    "WITH " + B.DAILY_SQL + """
SELECT season, round, driver_id, least(q1_seconds, q2_seconds, q3_seconds) AS best_quali_seconds FROM daily""",
)
def best_of_three(spark, sf_dir):
    return B.daily(spark, sf_dir).select(
        "season", "round", "driver_id", S.best_of("q1_seconds", "q2_seconds", "q3_seconds").alias("best_quali_seconds")
    )


@query(
    "places_and_labels",
    "WITH " + B.CONTEST_SQL + """
SELECT season, round, driver_id, grid - coalesce(position, grid) AS position_gained,
       least(greatest(classified, 1), 20) AS clipped,
       round(CASE WHEN num_pit_stops <> 0 THEN points / num_pit_stops END, 6) AS points_per_stop,
       'R' || round || ' — ' || 'day ' || circuit_id || ' (' || count(*) OVER (PARTITION BY season, round) || ' drivers)' AS label
FROM contest""",
)
def places_and_labels(spark, sf_dir):
    df = group_stats(B.contest(spark, sf_dir), B.RACE, {"__n": F.count(F.lit(1))}, calendar=True)
    race = F.concat(F.lit("day "), F.col("circuit_id").cast("string"))
    return S.rounded(
        df.select(
            "season", "round", "driver_id",
            S.positions_gained(F.col("grid"), F.col("position")).alias("position_gained"),
            S.clip(F.col("classified"), 1, 20).alias("clipped"),
            S.ratio(F.col("points"), F.col("num_pit_stops")).alias("points_per_stop"),
            S.race_label(F.col("round"), race, F.col("__n")).alias("label"),
        )
    )


@query(
    "compound_codes",
    "WITH " + B.laps_sql("day") + f"""
SELECT {EK}, "LapNumber",
       CASE "Compound" WHEN 'SOFT' THEN 0 WHEN 'MEDIUM' THEN 1 WHEN 'HARD' THEN 2 WHEN 'INTERMEDIATE' THEN 3
                       WHEN 'WET' THEN 4 ELSE -1 END AS compound_encoded FROM laps1""",
)
def compound_codes(spark, sf_dir):
    df = B.numbered_laps(spark, sf_dir)
    return df.select(*B.ENTRY, "LapNumber", S.encode(F.col("Compound")).alias("compound_encoded"))


@query(
    "stop_summary",
    "WITH " + B.STOPS_SQL + """
SELECT entry_id, max(stop_number) AS num_pit_stops, round(avg(duration_seconds), 6) AS avg_pit_duration,
       round(sum(duration_seconds), 6) AS total_pit_time, CAST(bool_or(duration_seconds > 5) AS INTEGER) AS had_slow_stop
FROM stops GROUP BY entry_id""",
)
def stop_summary(spark, sf_dir):
    stops = B.stops(spark, sf_dir)
    stops = stops.withColumn("is_slow_stop", S.exceeds(F.col("duration_seconds"), S.SLOW_STOP_SECONDS))
    return S.rounded(silver.stop_summary(stops, ["entry_id"]))


MASTER_SQL = """
summary AS (
  SELECT entry_id, max(stop_number) AS num_pit_stops, avg(duration_seconds) AS avg_pit_duration,
         sum(duration_seconds) AS total_pit_time FROM stops GROUP BY entry_id)"""


@query(
    "race_master_join",
    f"WITH {B.STOPS_SQL}, {MASTER_SQL}" + """
SELECT o_orderkey, o_custkey, c_mktsegment, n_name, coalesce(num_pit_stops, 0) AS num_pit_stops,
       round(avg_pit_duration, 6) AS avg_pit_duration, round(total_pit_time, 6) AS total_pit_time
FROM orders LEFT JOIN summary ON entry_id = o_orderkey LEFT JOIN customer ON c_custkey = o_custkey
LEFT JOIN nation ON n_nationkey = c_nationkey""",
)
def race_master_join(spark, sf_dir):
    orders = B.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    stops = B.stops(spark, sf_dir)
    stops = stops.withColumn("is_slow_stop", S.exceeds(F.col("duration_seconds"), S.SLOW_STOP_SECONDS))
    summary = silver.stop_summary(stops, ["entry_id"]).withColumnRenamed("entry_id", "o_orderkey").drop("had_slow_stop")
    customers = B.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_mktsegment", F.col("c_nationkey").alias("n_nationkey"))
    nations = B.table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # Order keys are unique; customers may be hot, so that join checks them. There are 25 nations.
    df = left_enrich(orders, summary, ["o_orderkey"], {"num_pit_stops": 0}, BOUNDED)
    hot = B.checked(orders.select("o_custkey"), sf_dir, "orders", ["o_custkey"])
    df = left_enrich(df, customers, ["o_custkey"], hot=hot)
    df = left_enrich(df, nations, ["n_nationkey"], hot=BOUNDED)
    return S.rounded(df.drop("n_nationkey"))


WEATHER_FEATURES_SQL = """
weather AS (
  SELECT season, round, avg(track_temp) AS avg_track_temp, max(track_temp) AS max_track_temp,
         min(track_temp) AS min_track_temp, avg(air_temp) AS avg_air_temp, max(humidity) AS max_humidity,
         avg(humidity) AS avg_humidity, max(rainfall) AS rain FROM samples GROUP BY season, round)"""


@query(
    "weather_features",
    f"WITH {B.WEATHER_SQL}, {WEATHER_FEATURES_SQL}" + """
SELECT season, round, round(avg_track_temp, 6) AS avg_track_temp, max_track_temp, min_track_temp,
       round(avg_air_temp, 6) AS avg_air_temp, max_humidity, round(avg_humidity, 6) AS avg_humidity,
       round(max_track_temp - min_track_temp, 6) AS temp_variation, CAST(avg_track_temp > 40 AS INTEGER) AS is_hot_race,
       CAST(avg_track_temp < 25 AS INTEGER) AS is_cold_race, CAST(rain > 0 AS INTEGER) AS had_rain
FROM weather""",
)
def weather_features(spark, sf_dir):
    return S.rounded(silver.weather_features(B.samples(spark, sf_dir)))


@query(
    "weather_merge",
    f"WITH {B.CONTEST_SQL}, {B.WEATHER_SQL}, {WEATHER_FEATURES_SQL}" + """
SELECT season, round, driver_id, round(avg_track_temp, 6) AS avg_track_temp, CAST(rain > 0 AS INTEGER) AS had_rain,
       max_humidity FROM contest LEFT JOIN weather USING (season, round)""",
)
def weather_merge(spark, sf_dir):
    weather = silver.weather_features(B.samples(spark, sf_dir))
    # Weather has one row per race of the calendar.
    df = calendar_join(B.contest(spark, sf_dir), weather, B.RACE)
    return S.rounded(df.select("season", "round", "driver_id", "avg_track_temp", "had_rain", "max_humidity"))


@query(
    "rain_share_and_coverage",
    f"WITH {B.DAILY_SQL}, {B.WEATHER_SQL}, {WEATHER_FEATURES_SQL}" + """
SELECT round((SELECT avg(CAST(rain > 0 AS INTEGER)) FROM weather), 6) AS rain_share,
       round(100.0 * avg(CASE WHEN w.season IS NOT NULL THEN 1 ELSE 0 END), 6) AS coverage_pct
FROM daily LEFT JOIN (SELECT * FROM weather WHERE round <= 5) w USING (season, round)""",
)
def rain_share_and_coverage(spark, sf_dir):
    weather = silver.weather_features(B.samples(spark, sf_dir))
    rain = weather.agg(F.avg("had_rain").alias("rain_share")).withColumn("k", F.lit(1))
    joined = calendar_join(B.daily(spark, sf_dir).select(*B.RACE), weather.filter("round <= 5"), B.RACE)
    covered = integrate.coverage(joined, "avg_track_temp").withColumn("k", F.lit(1))
    return S.rounded(rain.join(covered, "k").drop("k"))


@query(
    "lap_delta_to_leader",
    "WITH " + B.laps_sql("day") + f"""
SELECT {EK}, "LapNumber", round("LapTime_seconds" - min("LapTime_seconds") OVER (PARTITION BY season, round, "LapNumber"), 6)
       AS delta_to_leader_seconds FROM laps1""",
)
def lap_delta_to_leader(spark, sf_dir):
    df = B.numbered_laps(spark, sf_dir)
    # A lap number of a race holds at most one lap per driver; races are checked.
    df = silver.lap_delta(df, B.RACE, "LapNumber", "LapTime_seconds", B.lap_races_of(spark, sf_dir))
    return S.rounded(df.select(*B.ENTRY, "LapNumber", "delta_to_leader_seconds"))


@query(
    "race_median_lap",
    "WITH " + B.laps_sql("day") + """
SELECT season, round, round(median("LapTime_seconds"), 6) AS median_lap FROM laps0 GROUP BY 1, 2""",
)
def race_median_lap(spark, sf_dir):
    rows = B.lap_rows(spark, sf_dir)
    return S.rounded(median(rows, B.RACE, "LapTime_seconds", "median_lap", B.lap_races_of(spark, sf_dir)))


CLEAN_SQL = """
medians AS (
  SELECT season, round, median("LapTime_seconds") AS med FROM laps WHERE "LapTime_seconds" > 0 GROUP BY 1, 2),
clean AS (
  SELECT laps.* FROM laps JOIN medians USING (season, round)
  WHERE "LapTime_seconds" > 0 AND "LapTime_seconds" < 1.15 * med)"""


@query(
    "clean_laps",
    f"""WITH {B.laps_sql("day")}, {CLEAN_SQL}
SELECT {EK}, "LapNumber", "LapTime_seconds" FROM clean""",
)
def clean_laps(spark, sf_dir):
    df = integrate.clean_laps(B.numbered_laps(spark, sf_dir), hot=B.lap_races_of(spark, sf_dir))
    return df.select(*B.ENTRY, "LapNumber", "LapTime_seconds")


LAP_FEATURES_SQL = """
per_entry AS (
  SELECT season, round, "Driver", avg("LapTime_seconds") AS avg_lap_time, stddev_samp("LapTime_seconds") AS lap_consistency,
         min("LapTime_seconds") AS best_lap_time, max("LapNumber") AS laps_completed_actual, max("TyreLife") AS max_tyre_life
  FROM clean GROUP BY 1, 2, 3),
stint_count AS (SELECT season, round, "Driver", CAST(max("Stint") AS BIGINT) AS num_stints FROM laps GROUP BY 1, 2, 3)"""


@query(
    "lap_features",
    f"""WITH {B.laps_sql("day")}, {CLEAN_SQL}, {LAP_FEATURES_SQL}
SELECT {EK}, round(avg_lap_time, 6) AS avg_lap_time, round(lap_consistency, 6) AS lap_consistency, best_lap_time,
       laps_completed_actual, max_tyre_life,
       round(avg_lap_time - avg(avg_lap_time) OVER (PARTITION BY season, round), 6) AS pace_vs_field,
       round((best_lap_time - min(best_lap_time) OVER (PARTITION BY season, round)) * 100 /
             nullif(min(best_lap_time) OVER (PARTITION BY season, round), 0), 6) AS best_lap_pct,
       num_stints,
       round(avg(lap_consistency) OVER (PARTITION BY "Driver" ORDER BY season, round
             ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), 6) AS driver_consistency_5
FROM per_entry LEFT JOIN stint_count USING (season, round, "Driver")""",
)
def lap_features(spark, sf_dir):
    df = integrate.lap_features(B.laps(spark, sf_dir), hot=B.lap_races_of(spark, sf_dir), by_driver=B.entries_of(spark, sf_dir))
    return S.rounded(df)


@query(
    "stint_counts",
    f"""WITH {B.laps_sql("week")}
SELECT {EK}, CAST(max("Stint") AS BIGINT) AS num_stints FROM laps GROUP BY ALL""",
)
def stint_counts(spark, sf_dir):
    laps = B.numbered_laps(spark, sf_dir, "week")
    return integrate.stint_counts(laps, hot=B.entries_of(spark, sf_dir, "week"), position="LapNumber")


@query(
    "stints_and_tyre_age",
    f"""WITH {B.laps_sql("week")}
SELECT {EK}, "LapNumber", "Compound", CAST("Stint" AS BIGINT) AS "Stint", "TyreLife" FROM laps""",
)
def stints_and_tyre_age(spark, sf_dir):
    return B.laps(spark, sf_dir, "week").select(*B.ENTRY, "LapNumber", "Compound", "Stint", "TyreLife")


DEG_SQL = """
deg0 AS (
  SELECT season, round, "Driver", "Stint", min("Compound") AS "Compound", count(*) AS n, var_pop("LapTime_seconds") AS vy,
         regr_slope("LapTime_seconds", "TyreLife") AS slope, regr_r2("LapTime_seconds", "TyreLife") AS r2
  FROM laps GROUP BY 1, 2, 3, 4),
deg AS (
  SELECT *, CASE WHEN n >= 3 THEN CASE WHEN vy = 0 THEN 0 ELSE slope END END AS tire_deg_slope,
         CASE WHEN n >= 3 THEN CASE WHEN vy = 0 THEN 0 ELSE r2 END END AS tire_deg_r2 FROM deg0)"""


@query(
    "tire_degradation",
    f"""WITH {B.laps_sql("week")}, {DEG_SQL}
SELECT {EK}, CAST("Stint" AS BIGINT) AS "Stint", "Compound", round(tire_deg_slope, 6) AS tire_deg_slope,
       round(tire_deg_r2, 6) AS tire_deg_r2 FROM deg""",
)
def tire_degradation(spark, sf_dir):
    return S.rounded(integrate.tire_degradation(B.laps(spark, sf_dir, "week")))


TIRE_SQL = """
reliable AS (SELECT * FROM deg WHERE tire_deg_slope IS NOT NULL AND tire_deg_r2 > 0.3),
tire AS (
  SELECT season, round, "Driver", avg(tire_deg_slope) AS avg_tire_deg_slope, max(tire_deg_slope) AS max_tire_deg_slope,
         min(tire_deg_slope) AS min_tire_deg_slope, count(*) AS stint_count_tire,
         avg(CASE WHEN "Compound" = 'SOFT' THEN tire_deg_slope END) AS soft_deg_slope,
         avg(CASE WHEN "Compound" = 'MEDIUM' THEN tire_deg_slope END) AS medium_deg_slope,
         avg(CASE WHEN "Compound" = 'HARD' THEN tire_deg_slope END) AS hard_deg_slope
  FROM reliable GROUP BY 1, 2, 3)"""


@query(
    "tire_features",
    f"""WITH {B.laps_sql("week")}, {DEG_SQL}, {TIRE_SQL}
SELECT {EK}, round(avg_tire_deg_slope, 6) AS avg_tire_deg_slope, round(max_tire_deg_slope, 6) AS max_tire_deg_slope,
       round(min_tire_deg_slope, 6) AS min_tire_deg_slope, stint_count_tire, round(soft_deg_slope, 6) AS soft_deg_slope,
       round(medium_deg_slope, 6) AS medium_deg_slope, round(hard_deg_slope, 6) AS hard_deg_slope,
       round(avg(avg_tire_deg_slope) OVER (PARTITION BY "Driver" ORDER BY season, round
             ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), 6) AS driver_avg_deg_5
FROM tire""",
)
def tire_features(spark, sf_dir):
    return S.rounded(integrate.tire_features(integrate.tire_degradation(B.laps(spark, sf_dir, "week"))))


@query(
    "slope_distribution",
    f"""WITH {B.laps_sql("week")}, {DEG_SQL}, {TIRE_SQL}
SELECT "Compound", round(min(tire_deg_slope), 6) AS low, round(quantile_cont(tire_deg_slope, 0.25), 6) AS q1,
       round(quantile_cont(tire_deg_slope, 0.5), 6) AS mid, round(quantile_cont(tire_deg_slope, 0.75), 6) AS q3,
       round(max(tire_deg_slope), 6) AS high FROM reliable GROUP BY 1""",
)
def slope_distribution(spark, sf_dir):
    deg = integrate.reliable(integrate.tire_degradation(B.laps(spark, sf_dir, "week")))
    return S.rounded(distribution(deg, ["Compound"], "tire_deg_slope"))


@query(
    "laps_onto_results",
    f"""WITH {B.CONTEST_SQL}, {B.laps_sql("day")}, {CLEAN_SQL}, {LAP_FEATURES_SQL}
SELECT season, round, driver_id, round(avg_lap_time, 6) AS avg_lap_time, laps_completed_actual, num_stints
FROM contest LEFT JOIN (SELECT *, "Driver" AS driver_id FROM per_entry LEFT JOIN stint_count USING (season, round, "Driver"))
  USING (season, round, driver_id)""",
)
def laps_onto_results(spark, sf_dir):
    feats = integrate.lap_features(B.laps(spark, sf_dir), hot=B.lap_races_of(spark, sf_dir), by_driver=B.entries_of(spark, sf_dir))
    df = integrate.merge_by_code(B.contest(spark, sf_dir), feats)
    return S.rounded(df.select("season", "round", "driver_id", "avg_lap_time", "laps_completed_actual", "num_stints"))


@query(
    "prior_season_standing",
    f"""WITH {B.STANDINGS_SQL}
SELECT s.season, s.driver_id, coalesce(p.position, 20) AS prev_season_position,
       coalesce(p.points, 0) AS prev_season_points, coalesce(p.wins, 0) AS prev_season_wins,
       CASE WHEN p.position = 1 THEN 1 ELSE 0 END AS is_prev_champion,
       CASE WHEN p.position <= 3 THEN 1 ELSE 0 END AS is_prev_top3, CASE WHEN p.position <= 5 THEN 1 ELSE 0 END AS is_prev_top5
FROM standings s LEFT JOIN standings p ON p.season + 1 = s.season AND p.driver_id = s.driver_id""",
)
def prior_season_standing(spark, sf_dir):
    table = B.standings(spark, sf_dir)
    # Standings are unique per driver and season.
    return integrate.prior_season(table.select("season", "driver_id"), table, hot=BOUNDED)


@query(
    "null_and_fill_report",
    "WITH " + B.CONTEST_SQL + """
SELECT column_name, round(100.0 - 100.0 * c / n, 1) AS null_pct, round(100.0 * c / n, 1) AS fill_pct
FROM (UNPIVOT (SELECT count(COLUMNS(*)) FROM contest) ON COLUMNS(*) INTO NAME column_name VALUE c), (SELECT count(*) AS n FROM contest)""",
)
def null_and_fill_report(spark, sf_dir):
    df = B.contest(spark, sf_dir)
    return null_percent(df).join(fill_rate(df), "column_name")


@query(
    "sparse_columns",
    "WITH " + B.CONTEST_SQL + """
SELECT column_name, round(100.0 - 100.0 * c / n, 1) AS null_pct
FROM (UNPIVOT (SELECT count(COLUMNS(*)) FROM contest) ON COLUMNS(*) INTO NAME column_name VALUE c), (SELECT count(*) AS n FROM contest)
WHERE round(100.0 - 100.0 * c / n, 1) > 50""",
)
def sparse_columns(spark, sf_dir):
    return null_percent(B.contest(spark, sf_dir), above=50.0)


@query(
    "sparsely_filled_columns",
    "WITH " + B.CONTEST_SQL + """
SELECT column_name, round(100.0 * c / n, 1) AS fill_pct
FROM (UNPIVOT (SELECT count(COLUMNS(*)) FROM contest) ON COLUMNS(*) INTO NAME column_name VALUE c), (SELECT count(*) AS n FROM contest)
WHERE round(100.0 * c / n, 1) < 50""",
)
def sparsely_filled_columns(spark, sf_dir):
    return fill_rate(B.contest(spark, sf_dir), below=50.0)


@query(
    "interactions",
    f"""WITH {B.CONTEST_SQL}, {B.WEATHER_SQL}, {WEATHER_FEATURES_SQL}
SELECT season, round, driver_id, round(points * coalesce(CAST(rain > 0 AS INTEGER), 0), 6) AS constructor_rain_interaction,
       round(points * coalesce(avg_track_temp, 30), 6) AS constructor_temp_interaction,
       round(grid * (2000.0 - 1500.0) / 500, 6) AS grid_elo_interaction
FROM contest LEFT JOIN weather USING (season, round)""",
)
def interactions(spark, sf_dir):
    df = calendar_join(B.contest(spark, sf_dir), silver.weather_features(B.samples(spark, sf_dir)), B.RACE)
    df = df.withColumn("constructor_rolling_points", F.col("points")).withColumn("driver_elo", F.lit(None).cast("double"))
    return S.rounded(gold.interactions(df).select(
        "season", "round", "driver_id", "constructor_rain_interaction", "constructor_temp_interaction", "grid_elo_interaction"))


# ---- the silver tables from untyped bronze rows: every event is one delivery of its day's entry ------

DELIVERY_SQL = f"""
delivery AS (
  SELECT CAST(isoyear(CAST(ts AS DATE)) * 100 + week(CAST(ts AS DATE)) AS INTEGER) AS season,
         CAST(isodow(CAST(ts AS DATE)) AS INTEGER) AS round, CAST(user_id AS VARCHAR) AS driver_id, ts, event_id, e.event_type,
         e.value, clock, CAST(hour(ts) AS INTEGER) AS hour
  FROM events e JOIN clocks USING (event_id)),
silver_results AS (
  SELECT season, round, driver_id, CAST(floor(value) AS INTEGER) AS grid,
         CASE WHEN event_type <> 'error' THEN CAST(floor(value / 2) AS INTEGER) END AS position, value AS points,
         CASE event_type WHEN 'error' THEN 'Engine' WHEN 'view' THEN 'Finished' ELSE '+1 Lap' END AS status,
         {PARSED} AS fastest_lap_seconds
  FROM (SELECT *, row_number() OVER (PARTITION BY season, round, driver_id ORDER BY ts DESC, event_id DESC) AS rn FROM delivery)
  WHERE rn = 1),
silver_quali AS (
  SELECT season, round, driver_id, {PARSED} AS q1_seconds, CAST(CASE WHEN value > 50 THEN 90.5 END AS DOUBLE) AS q2_seconds
  FROM (SELECT *, row_number() OVER (PARTITION BY season, round, driver_id ORDER BY ts DESC, event_id DESC) AS rn FROM delivery)
  WHERE rn = 1),
silver_stops AS (
  SELECT season, round, driver_id, hour AS stop_number, coalesce(TRY_CAST(clock AS DOUBLE), {PARSED}) AS duration_seconds
  FROM (SELECT *, row_number() OVER (PARTITION BY season, round, driver_id, hour ORDER BY ts DESC, event_id DESC) AS rn FROM delivery)
  WHERE rn = 1)"""


def _deliveries(spark, sf_dir):
    """Bronze columns as drifting text."""
    return _clocks(spark, sf_dir, "ts", "user_id").select(
        *[c.cast("string").alias(n) for c, n in zip(B.calendar_columns(F.to_date("ts")), B.RACE)],
        F.col("user_id").cast("string").alias("driver_id"), F.col("ts").cast("string").alias("_ingested_at"),
        "event_type", "value", "clock", F.hour("ts").cast("string").alias("stop_number"),
    )


def _bronze_results(spark, sf_dir):
    kind = F.col("event_type")
    return _deliveries(spark, sf_dir).select(
        *silver.ENTRY, F.floor("value").cast("string").alias("grid"),
        F.when(kind == "error", "R").otherwise(F.floor(F.col("value") / 2).cast("string")).alias("position"),
        F.col("value").cast("string").alias("points"),
        F.when(kind == "error", "Engine").when(kind == "view", "Finished").otherwise("+1 Lap").alias("status"),
        F.col("clock").alias("fastest_lap_time"), "_ingested_at",
    )


def _bronze_quali(spark, sf_dir):
    return _deliveries(spark, sf_dir).select(
        *silver.ENTRY, F.col("clock").alias("q1"), F.when(F.col("value") > 50, "1:30.5").alias("q2"), "_ingested_at")


def _bronze_stops(spark, sf_dir):
    return _deliveries(spark, sf_dir).select(*silver.ENTRY, "stop_number", F.col("clock").alias("duration"), "_ingested_at")


@query(
    "silver_race_results",
    f"""WITH {CLOCK_SQL}, {DELIVERY_SQL}
SELECT season, round, driver_id, grid, position, points, status, round(fastest_lap_seconds, 6) AS fastest_lap_seconds,
       grid - coalesce(position, grid) AS position_gained, status <> 'Engine' AS finished, status = 'Engine' AS dnf
FROM silver_results""",
)
def silver_race_results(spark, sf_dir):
    df = silver.race_results(_bronze_results(spark, sf_dir))
    return S.rounded(df.select(*silver.ENTRY, "grid", "position", "points", "status", "fastest_lap_seconds", "position_gained",
                               "finished", "dnf"))


@query(
    "silver_qualifying",
    f"""WITH {CLOCK_SQL}, {DELIVERY_SQL}
SELECT season, round, driver_id, round(q1_seconds, 6) AS q1_seconds, q2_seconds, CAST(NULL AS DOUBLE) AS q3_seconds,
       round(least(q1_seconds, q2_seconds), 6) AS best_quali_seconds FROM silver_quali""",
)
def silver_qualifying(spark, sf_dir):
    df = silver.qualifying(_bronze_quali(spark, sf_dir))
    return S.rounded(df.select(*silver.ENTRY, "q1_seconds", "q2_seconds", "q3_seconds", "best_quali_seconds"))


@query(
    "silver_pit_stops",
    f"""WITH {CLOCK_SQL}, {DELIVERY_SQL}
SELECT season, round, driver_id, stop_number, round(duration_seconds, 6) AS duration_seconds,
       coalesce(duration_seconds > 5, false) AS is_slow_stop, coalesce(duration_seconds > 15, false) AS is_problem_stop
FROM silver_stops""",
)
def silver_pit_stops(spark, sf_dir):
    df = silver.pit_stops(_bronze_stops(spark, sf_dir))
    return S.rounded(df.select(*silver.ENTRY, "stop_number", "duration_seconds", "is_slow_stop", "is_problem_stop"))


MASTER_SQL = f"""WITH {CLOCK_SQL}, {DELIVERY_SQL},
stop_agg AS (
  SELECT season, round, driver_id, max(stop_number) AS num_pit_stops, avg(duration_seconds) AS avg_pit_duration,
         sum(duration_seconds) AS total_pit_time, CAST(bool_or(coalesce(duration_seconds > 5, false)) AS INTEGER) AS had_slow_stop
  FROM silver_stops GROUP BY 1, 2, 3)
SELECT season, round, driver_id, grid, position, points, round(least(q1_seconds, q2_seconds), 6) AS best_quali_seconds,
       coalesce(num_pit_stops, 0) AS num_pit_stops, round(avg_pit_duration, 6) AS avg_pit_duration,
       round(total_pit_time, 6) AS total_pit_time, had_slow_stop
FROM silver_results LEFT JOIN silver_quali USING (season, round, driver_id) LEFT JOIN stop_agg USING (season, round, driver_id)"""


def _silver_tables(spark, sf_dir):
    return [silver.race_results(_bronze_results(spark, sf_dir)), silver.qualifying(_bronze_quali(spark, sf_dir)),
            silver.pit_stops(_bronze_stops(spark, sf_dir))]


def _master(tables):
    return S.rounded(silver.race_master(*tables).select(
        *silver.ENTRY, "grid", "position", "points", "best_quali_seconds", "num_pit_stops", "avg_pit_duration", "total_pit_time", "had_slow_stop"))


@query("silver_race_master", MASTER_SQL)
def silver_race_master(spark, sf_dir):
    return _master(_silver_tables(spark, sf_dir))


@query("silver_race_master_bucketed", MASTER_SQL)
def silver_race_master_bucketed(spark, sf_dir):
    """The same from stored tables that are bucketed alike: no exchange above their scans."""
    return _master(silver.store_bucketed(*_silver_tables(spark, sf_dir)))


@query(
    "observed_write_report",
    """
SELECT column_name, n AS rows, n - c AS nulls, round(100.0 * (n - c) / n, 1) AS null_pct, round(100.0 - 100.0 * (n - c) / n, 1) AS fill_pct
FROM (UNPIVOT (SELECT count(COLUMNS(*)) FROM (SELECT * REPLACE (nullif(event_type, 'error') AS event_type, CASE WHEN value >= 20 THEN value END AS value) FROM events))
      ON COLUMNS(*) INTO NAME column_name VALUE c), (SELECT count(*) AS n FROM events)""",
)
def observed_write_report(spark, sf_dir):
    events = B.table(spark, sf_dir, "events")
    events = events.withColumn("event_type", F.expr("nullif(event_type, 'error')")).withColumn("value", F.expr("CASE WHEN value >= 20 THEN value END"))
    return sinks.write_observed(events, shared_dir(spark, "events"))


@query(
    "silver_laps",
    "WITH " + B.laps_sql("day") + f"""
SELECT season, round, CAST("Driver" AS VARCHAR) AS "Driver", CAST("LapNumber" AS DOUBLE) AS "LapNumber", "Compound",
       CASE "Compound" WHEN 'SOFT' THEN 0 WHEN 'MEDIUM' THEN 1 WHEN 'HARD' THEN 2 WHEN 'INTERMEDIATE' THEN 3 ELSE -1 END
         AS compound_encoded,
       round("LapTime_seconds" - min("LapTime_seconds") OVER (PARTITION BY season, round, "LapNumber"), 6) AS delta_to_leader_seconds
FROM laps1""",
)
def silver_laps(spark, sf_dir):
    numbered = B.numbered_laps(spark, sf_dir)
    # Untyped rows, delivered twice.
    bronze = numbered.select(*[F.col(c).cast("string").alias(c) for c in numbered.columns]).withColumn("_ingested_at", F.lit("2024-02-01 00:00:00"))
    again = bronze.withColumn("_ingested_at", F.lit("2024-01-31 00:00:00"))
    df = silver.laps(bronze.unionByName(again), B.lap_races_of(spark, sf_dir))
    return S.rounded(df.select(*B.ENTRY, "LapNumber", "Compound", "compound_encoded", "delta_to_leader_seconds"))


@query(
    "finite_values",
    """
SELECT event_id, CASE WHEN value > 0 AND event_type <> 'error' THEN round(ln(value), 6) END AS finite_log,
       event_type IN ('view', 'click') AS member FROM events WHERE event_type IN ('view', 'click', 'error', 'purchase', 'signup')""",
)
def finite_values(spark, sf_dir):
    kind = F.col("event_type")
    # Errors give NaN, a zero gives minus infinity.
    value = F.when(kind == "error", F.lit(float("nan"))).when(F.col("value") > 0, F.ln(F.when(F.col("value") > 0, F.col("value")))).otherwise(
        F.lit(float("-inf")))
    kinds = ["view", "click", "error", "purchase", "signup"]
    df = B.table(spark, sf_dir, "events").filter(kind.isin(kinds))
    return S.rounded(df.select("event_id", S.finite(value).alias("finite_log"), kind.isin("view", "click").alias("member")))
