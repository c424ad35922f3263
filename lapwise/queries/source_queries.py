"""Scans, landing pages, sinks and streams. Files go to the session's shared folder."""

from pyspark.sql import functions as F

from lapwise import bindings as B
from lapwise import schemas
from lapwise.functions import scalars as S
from lapwise.operators.ordered import BOUNDED, with_position
from lapwise.plans import gold
from lapwise.queries.form_queries import TARGETS_SQL
from lapwise.queries.registry import query
from lapwise.session import shared_dir
from lapwise.sources import landing, scan, sinks
from lapwise.streaming import live

LINE_SCHEMA = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string"
)


@query(
    "scan_by_pattern",
    """
SELECT l_returnflag, l_linestatus, count(*) AS lines, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
FROM lineitem WHERE l_quantity < 24 GROUP BY 1, 2""",
)
def scan_by_pattern(spark, sf_dir):
    lines = scan.read_glob(spark, f"{sf_dir}/lineite*.parquet", LINE_SCHEMA)
    return lines.filter("l_quantity < 24").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(B.money("l_quantity")).cast("double").alias("quantity"))


@query(
    "scan_without_match",
    "SELECT l_orderkey, l_linenumber FROM lineitem",
)
def scan_without_match(spark, sf_dir):
    nothing = scan.read_glob(spark, f"{sf_dir}/no_such_table_*.parquet", "l_orderkey bigint, l_linenumber int")
    real = scan.read_glob(spark, f"{sf_dir}/lineitem*.parquet", LINE_SCHEMA)
    return scan.union_by_name([nothing, real.select("l_orderkey", "l_linenumber")])


@query(
    "scan_drifting_schemas",
    """
SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN o_orderstatus = 'P' THEN 'late' END AS note FROM orders""",
)
def scan_drifting_schemas(spark, sf_dir):
    orders = B.table(spark, sf_dir, "orders")
    folder = shared_dir(spark, "drift")
    plain = orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_totalprice")
    texts = orders.filter("o_orderstatus = 'O'").select(*[F.col(c).cast("string") for c in ("o_totalprice", "o_orderkey", "o_custkey")])
    extra = orders.filter("o_orderstatus = 'P'").select("o_orderkey", F.col("o_custkey").cast("int"), "o_totalprice", F.lit("late").alias("note"))
    for name, part in (("a", plain), ("b", texts), ("c", extra)):
        part.write.parquet(f"{folder}/{name}")
    return scan.read_drifting(spark, folder, "o_orderkey bigint, o_custkey bigint, o_totalprice double, note string")


@query(
    "first_existing_table",
    "SELECT n_nationkey, n_name FROM nation",
)
def first_existing_table(spark, sf_dir):
    B.table(spark, sf_dir, "nation").createOrReplaceTempView("nation_base")
    return scan.first_table(spark, ["nation_complete", "nation_advanced", "nation_base"]).select("n_nationkey", "n_name")


@query(
    "sql_over_view",
    """
SELECT o_orderpriority, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' GROUP BY o_orderpriority ORDER BY o_orderpriority LIMIT 20""",
)
def sql_over_view(spark, sf_dir):
    text = """
        SELECT o_orderpriority, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
        FROM race_data WHERE o_orderdate >= TIMESTAMP '1996-01-01' GROUP BY o_orderpriority ORDER BY o_orderpriority"""
    return scan.run_sql(spark, {"race_data": B.table(spark, sf_dir, "orders")}, text, 20)


# ---- landing JSON -------------------------------------------------------------


def _pages(spark, sf_dir, name, data):
    """Write one JSON page per event and read the folder back with the declared schema."""
    events = B.table(spark, sf_dir, "events")
    folder = shared_dir(spark, name)
    events.select(data.alias("MRData")).write.json(folder)
    return folder


def _text(column):
    return F.col(column).cast("string")


def _race(**lists):
    parts = [F.lit("2024").alias("season"), (F.col("event_id") % 20).cast("string").alias("round"), F.lit("Race").alias("raceName"),
             F.date_format("ts", "yyyy-MM-dd").alias("date"),
             F.struct(F.col("event_type").alias("circuitId"), F.upper("event_type").alias("circuitName")).alias("Circuit")]
    return F.struct(*parts, *[v.alias(k) for k, v in lists.items()])


def _driver(shift=0, code=True):
    number = (F.col("user_id") + shift).cast("string")
    fields = [F.concat(F.lit("d"), number).alias("driverId"), F.lit("Given").alias("givenName"), number.alias("familyName")]
    if code:
        fields.append(F.concat(F.lit("C"), number).alias("code"))
    return F.struct(*fields)


@query(
    "flatten_results_pages",
    """
SELECT CAST(2024 AS INTEGER) AS season, CAST(event_id % 20 AS INTEGER) AS round, event_type AS circuit_id,
       upper(event_type) AS circuit_name, CAST(CAST(ts AS DATE) AS VARCHAR) AS race_date, 'd' || user_id AS driver_id,
       'C' || user_id AS driver_code, 'Given ' || user_id AS driver_name, 't' || (user_id % 10) AS constructor_id,
       CAST(user_id % 20 AS INTEGER) AS grid, CAST(event_id % 20 AS INTEGER) AS position, value AS points,
       CAST(event_id * 7 AS BIGINT) AS time_millis, '1:23.456' AS fastest_lap_time FROM events
UNION ALL
SELECT 2024, CAST(event_id % 20 AS INTEGER), event_type, upper(event_type), CAST(CAST(ts AS DATE) AS VARCHAR), 'd' || (user_id + 1), '',
       'Given ' || (user_id + 1), 't' || (user_id % 10), CAST(user_id % 20 AS INTEGER), NULL, value, NULL, NULL FROM events""",
)
def flatten_results_pages(spark, sf_dir):
    team = F.struct(F.concat(F.lit("t"), (F.col("user_id") % 10).cast("string")).alias("constructorId"), F.lit("Team").alias("name"))
    grid = (F.col("user_id") % 20).cast("string").alias("grid")
    nothing = F.lit(None).cast("string")

    def entry(driver, position, millis, lap):
        return F.struct(
            driver.alias("Driver"), team.alias("Constructor"), grid, position.alias("position"), _text("value").alias("points"),
            F.lit("Finished").alias("status"), F.lit("50").alias("laps"),
            F.when(millis.isNotNull(), F.struct(millis.alias("millis"))).alias("Time"),
            F.when(lap.isNotNull(), F.struct(F.lit("1").alias("rank"), F.struct(lap.alias("time")).alias("Time"))).alias("FastestLap"),
        )

    first = entry(_driver(), (F.col("event_id") % 20).cast("string"), (F.col("event_id") * 7).cast("string"), F.lit("1:23.456"))
    second = entry(
        F.struct(*[_driver(1)[c].alias(c) for c in ("driverId", "givenName", "familyName")], nothing.alias("code")),
        F.lit("R"), nothing, nothing)
    page = F.struct(F.lit("2").alias("total"), F.struct(F.array(_race(Results=F.array(first, second))).alias("Races")).alias("RaceTable"))
    pages = landing.read_pages(spark, _pages(spark, sf_dir, "results", page), schemas.RESULT_PAGE)
    df = landing.flatten_results(pages)
    return df.select("season", "round", "circuit_id", "circuit_name", F.col("race_date").cast("string").alias("race_date"), "driver_id",
                     "driver_code", "driver_name", "constructor_id", "grid", "position", "points", "time_millis", "fastest_lap_time")


@query(
    "flatten_qualifying_pages",
    """
SELECT CAST(2024 AS INTEGER) AS season, CAST(event_id % 20 AS INTEGER) AS round, 'd' || user_id AS driver_id,
       'Given ' || user_id AS driver_name, 't' || (user_id % 10) AS constructor_id, CAST(user_id % 20 AS INTEGER) AS position,
       '1:20.5' AS q1, CASE WHEN event_type <> 'error' THEN '1:19.5' END AS q2, CAST(NULL AS VARCHAR) AS q3,
       80.5 AS q1_seconds, CASE WHEN event_type <> 'error' THEN 79.5 ELSE 80.5 END AS best_seconds FROM events""".replace(
        "80.5 AS q1_seconds", "CAST(80.5 AS DOUBLE) AS q1_seconds").replace(
        "CASE WHEN event_type <> 'error' THEN 79.5 ELSE 80.5 END", "CAST(CASE WHEN event_type <> 'error' THEN 79.5 ELSE 80.5 END AS DOUBLE)"),
)
def flatten_qualifying_pages(spark, sf_dir):
    team = F.struct(F.concat(F.lit("t"), (F.col("user_id") % 10).cast("string")).alias("constructorId"), F.lit("Team").alias("name"))
    row = F.struct(_driver().alias("Driver"), team.alias("Constructor"), (F.col("user_id") % 20).cast("string").alias("position"),
                   F.lit("1:20.5").alias("Q1"), F.when(F.col("event_type") != "error", "1:19.5").alias("Q2"))
    page = F.struct(F.lit("1").alias("total"), F.struct(F.array(_race(QualifyingResults=F.array(row))).alias("Races")).alias("RaceTable"))
    pages = landing.read_pages(spark, _pages(spark, sf_dir, "qualifying", page), schemas.QUALIFYING_PAGE)
    df = landing.flatten_qualifying(pages)
    times = [S.parse_clock(F.col(q)).alias(f"{q}_seconds") for q in ("q1", "q2", "q3")]
    df = df.select("*", *times)
    return df.select("season", "round", "driver_id", "driver_name", "constructor_id", "position", "q1", "q2", "q3", "q1_seconds",
                     S.best_of("q1_seconds", "q2_seconds", "q3_seconds").alias("best_seconds"))


@query(
    "flatten_pit_stop_pages",
    """
SELECT CAST(2024 AS INTEGER) AS season, CAST(event_id % 20 AS INTEGER) AS round, 'd' || user_id AS driver_id,
       CAST(s AS INTEGER) AS stop_number, CAST(s * 10 AS INTEGER) AS lap, CASE s WHEN 1 THEN '23.5' ELSE '1:02.5' END AS duration
FROM events, (VALUES (1), (2)) v(s) WHERE event_type <> 'error'""",
)
def flatten_pit_stop_pages(spark, sf_dir):
    def stop(number, duration):
        return F.struct(F.concat(F.lit("d"), _text("user_id")).alias("driverId"), F.lit(str(number)).alias("stop"),
                        F.lit(str(number * 10)).alias("lap"), F.lit("14:00:00").alias("time"), F.lit(duration).alias("duration"))

    race = _race(PitStops=F.array(stop(1, "23.5"), stop(2, "1:02.5")))
    # Error events become pages without a race; a second race on a page is ignored.
    races = F.when(F.col("event_type") != "error", F.array(race, race))
    page = F.struct(F.lit("2").alias("total"), F.struct(races.alias("Races")).alias("RaceTable"))
    pages = landing.read_pages(spark, _pages(spark, sf_dir, "stops", page), schemas.PIT_STOP_PAGE)
    return landing.flatten_pit_stops(pages).select("season", "round", "driver_id", "stop_number", "lap", "duration")


@query(
    "flatten_standings_pages",
    """
SELECT CAST(2024 AS INTEGER) AS season, 'd' || user_id AS driver_id, 't' || (user_id % 10) AS constructor_id,
       CAST(event_id % 20 AS INTEGER) AS position, value AS points, CAST(user_id % 3 AS INTEGER) AS wins FROM events""",
)
def flatten_standings_pages(spark, sf_dir):
    def team(shift):
        return F.struct(F.concat(F.lit("t"), ((F.col("user_id") + shift) % 10).cast("string")).alias("constructorId"), F.lit("Team").alias("name"))

    row = F.struct((F.col("event_id") % 20).cast("string").alias("position"), _text("value").alias("points"),
                   (F.col("user_id") % 3).cast("string").alias("wins"), _driver().alias("Driver"),
                   F.array(team(0), team(1)).alias("Constructors"))
    lists = F.array(F.struct(F.lit("2024").alias("season"), F.array(row).alias("DriverStandings")),
                    F.struct(F.lit("1999").alias("season"), F.array(row).alias("DriverStandings")))
    page = F.struct(F.lit("1").alias("total"), F.struct(lists.alias("StandingsLists")).alias("StandingsTable"))
    pages = landing.read_pages(spark, _pages(spark, sf_dir, "standings", page), schemas.STANDINGS_PAGE)
    return landing.flatten_standings(pages).select("season", "driver_id", "constructor_id", "position", "points", "wins")


@query(
    "page_totals",
    "SELECT count(*) AS received, count(*) AS announced, true AS complete FROM events",
)
def page_totals(spark, sf_dir):
    # Every page announces the size of the whole result.
    total = B.table(spark, sf_dir, "events").agg(F.count(F.lit(1))).first()[0]
    row = F.struct(_driver().alias("Driver"), F.lit("1").alias("position"))
    page = F.struct(F.lit(str(total)).alias("total"), F.struct(F.array(_race(QualifyingResults=F.array(row))).alias("Races")).alias("RaceTable"))
    pages = landing.read_pages(spark, _pages(spark, sf_dir, "pages", page), schemas.QUALIFYING_PAGE)
    return landing.page_totals(pages, F.get("MRData.RaceTable.Races", F.lit(0))["QualifyingResults"])


@query(
    "properties_from_json",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""",
)
def properties_from_json(spark, sf_dir):
    events = B.table(spark, sf_dir, "events")
    return events.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query(
    "conversation_pages",
    """
SELECT conv_id, turn, role, length(text) AS n_chars FROM conversations""",
)
def conversation_pages(spark, sf_dir):
    turns = B.table(spark, sf_dir, "conversations")
    folder = shared_dir(spark, "conversations")
    page = F.struct("conv_id", F.array(F.struct("turn", "role", "text")).alias("turns"))
    turns.select(page.alias("page")).write.json(folder)
    pages = spark.read.schema("page struct<conv_id:bigint,turns:array<struct<turn:bigint,role:string,text:string>>>").json(folder)
    rows = pages.select("page.conv_id", F.explode_outer("page.turns").alias("t"))
    return rows.select("conv_id", "t.turn", "t.role", F.length("t.text").cast("bigint").alias("n_chars"))


# ---- session samples ------------------------------------------------------------


@query(
    "land_session_laps",
    """
SELECT event_id, CAST(2024 AS INTEGER) AS season, CAST(7 AS INTEGER) AS round, 'R' AS session_type, 'Grand event' AS event_name,
       round(CAST(date_diff('microsecond', CAST(CAST(ts AS DATE) AS TIMESTAMP), ts) AS DOUBLE) / 1000000, 6) AS since_midnight_seconds,
       true AS stamped FROM events""",
)
def land_session_laps(spark, sf_dir):
    since = (F.col("ts").cast("timestamp_ntz") - F.date_trunc("day", "ts").cast("timestamp_ntz")).alias("since_midnight")
    events = B.table(spark, sf_dir, "events").select("event_id", since)
    df = landing.land_session(events, 2024, 7, "R", "Grand event")
    return S.rounded(df.withColumn("stamped", F.col("_ingested_at").isNotNull()).drop("_ingested_at"))


@query(
    "land_session_weather",
    """
SELECT event_id, value AS track_temp, CAST(2024 AS INTEGER) AS season, CAST(7 AS INTEGER) AS round, 'R' AS session_type,
       'Grand event' AS event_name,
       round(CAST(date_diff('microsecond', CAST(CAST(ts AS DATE) AS TIMESTAMP), ts) AS DOUBLE) / 1000000, 6) AS time_seconds
FROM events WHERE event_type = 'view'""",
)
def land_session_weather(spark, sf_dir):
    since = (F.col("ts").cast("timestamp_ntz") - F.date_trunc("day", "ts").cast("timestamp_ntz")).alias("time")
    samples = B.table(spark, sf_dir, "events").filter("event_type = 'view'").select("event_id", F.col("value").alias("track_temp"), since)
    return S.rounded(landing.land_session(samples, 2024, 7, "R", "Grand event").drop("_ingested_at"))


@query(
    "nanoseconds_to_seconds",
    "SELECT event_id, round(value, 6) AS lap_seconds FROM events",
)
def nanoseconds_to_seconds(spark, sf_dir):
    nanos = F.round(F.col("value") * 1000000000).cast("bigint").alias("lap")
    return S.rounded(S.seconds_of_nanos(B.table(spark, sf_dir, "events").select("event_id", nanos), ["lap"]))


@query(
    "tag_telemetry",
    "WITH " + B.laps_sql("week") + """
, tags AS (SELECT season, round, "Driver", "LapNumber", "Compound", "TyreLife" FROM laps WHERE "Compound" <> 'TEST'),
samples AS (SELECT season, round, "Driver", "LapNumber", event_id, "LapTime_seconds" AS speed FROM laps)
SELECT season, round, "Driver", "LapNumber", event_id, speed, coalesce("Compound", 'UNKNOWN') AS "Compound", "TyreLife"
FROM samples LEFT JOIN tags USING (season, round, "Driver", "LapNumber")""",
)
def tag_telemetry(spark, sf_dir):
    hot = B.entries_of(spark, sf_dir, "week")
    samples = with_position(B.lap_rows(spark, sf_dir, "week"), B.ENTRY, ["ts", "event_id"], "LapNumber", hot)
    samples = samples.select(*B.ENTRY, "LapNumber", "event_id", F.col("LapTime_seconds").alias("speed"))
    tags = B.laps(spark, sf_dir, "week").filter("Compound <> 'TEST'")
    # One sample per lap here, so the join keys are unique on both sides.
    return landing.tag_telemetry(samples, tags, [*B.ENTRY, "LapNumber"], hot=BOUNDED)


@query(
    "renamed_columns",
    """SELECT n_nationkey AS "nation_key", n_name AS "nation_name" FROM nation""",
)
def renamed_columns(spark, sf_dir):
    nation = B.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation key"), F.col("n_name").alias("nation name"))
    return S.underscored(nation)


# ---- sinks --------------------------------------------------------------------


@query(
    "partitioned_table_round_trip",
    "WITH " + B.CONTEST_SQL + "," + TARGETS_SQL + """
SELECT season, count(*) AS entries, CAST(sum(target_winner) AS BIGINT) AS winners, round(sum(points), 4) AS points
FROM gold WHERE season >= 202402 GROUP BY season""",
)
def partitioned_table_round_trip(spark, sf_dir):
    df = gold.targets(B.contest(spark, sf_dir)).select("season", "round", "driver_id", "points", "target_winner")
    folder = shared_dir(spark, "gold")
    sinks.write_table(df, folder)
    back = scan.read_table(spark, folder).filter("season >= 202402")
    return S.rounded(back.groupBy("season").agg(
        F.count(F.lit(1)).alias("entries"), F.sum("target_winner").alias("winners"), F.sum("points").alias("points")), 4)


@query(
    "csv_report_round_trip",
    """
SELECT event_type AS feature, round(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE), 2) AS importance FROM events GROUP BY 1""",
)
def csv_report_round_trip(spark, sf_dir):
    totals = B.table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("feature")).agg(
        F.sum(B.money("value")).cast("double").alias("importance"))
    folder = shared_dir(spark, "importances")
    sinks.write_ranked_csv(totals, folder, "importance")
    back = spark.read.option("header", "true").schema("feature string, importance double").csv(folder)
    return S.rounded(back, 2)


@query(
    "newest_json_report",
    """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS orders FROM orders GROUP BY 1""",
)
def newest_json_report(spark, sf_dir):
    folder = shared_dir(spark, "reports")
    orders = B.table(spark, sf_dir, "orders")
    old = orders.filter("o_orderstatus = 'F'").groupBy(F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("orders"))
    new = orders.groupBy(F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("orders"))
    sinks.write_json(old, f"{folder}/report_20240101")
    sinks.write_json(new, f"{folder}/report_20240201")
    pages = spark.read.schema("year int, orders bigint").option("recursiveFileLookup", "true").json(folder)
    # Reports are folders; the folder name carries the time.
    return scan.newest_file(pages, r"/(report_\d+)/")


CATALOG_NOTES = {"points": "points of the race", "position": "finishing place, null if not finished"}


@query(
    "feature_catalog",
    """
SELECT 'contest' AS table_name, (SELECT count(DISTINCT (CAST(ts AS DATE), user_id)) FROM events) AS rows, * FROM (VALUES
  ('season', 'int', 'feature', ''), ('round', 'int', 'feature', ''), ('driver_id', 'bigint', 'feature', ''),
  ('points', 'double', 'feature', 'points of the race'), ('position', 'bigint', 'target', 'finishing place, null if not finished'))
  v(feature, type, role, description)""",
)
def feature_catalog(spark, sf_dir):
    df = B.contest(spark, sf_dir).select("season", "round", "driver_id", "points", "position")
    return sinks.feature_catalog(sinks.described(df, CATALOG_NOTES), "contest", ["position"])


@query(
    "refresh_one_season",
    """
SELECT CAST(year(o_orderdate) AS INTEGER) AS season, count(*) AS orders,
       CAST(sum(CASE WHEN year(o_orderdate) = 1999 THEN 1 ELSE 0 END) AS BIGINT) AS refreshed
FROM orders GROUP BY 1""",
)
def refresh_one_season(spark, sf_dir):
    orders = B.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("season"), F.lit(0).alias("refreshed"))
    folder = shared_dir(spark, "seasons")
    # The stored 1999 season is incomplete; the refresh brings all of it.
    sinks.write_table(orders.filter("season <> 1999 OR o_orderstatus = 'F'"), folder)
    sinks.refresh_partitions(orders.filter("season = 1999").withColumn("refreshed", F.lit(1)), folder)
    table = scan.read_table(spark, folder)
    return table.groupBy("season").agg(F.count(F.lit(1)).alias("orders"), F.sum("refreshed").alias("refreshed"))


@query(
    "completed_rounds",
    """
SELECT o_orderkey, CAST(month(o_orderdate) - 1 AS INTEGER) AS round FROM orders
WHERE o_orderdate < TIMESTAMP '1999-01-01' AND o_orderpriority <> '5-LOW' AND month(o_orderdate) <> 1""",
)
def completed_rounds(spark, sf_dir):
    schedule = B.table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.month("o_orderdate") - 1).cast("int").alias("round"), F.col("o_orderdate").alias("EventDate"),
        F.when(F.col("o_orderpriority") == "5-LOW", "testing").otherwise("conventional").alias("EventFormat"))
    done = sinks.completed_rounds(schedule, F.lit("1999-01-01").cast("timestamp"))
    return done.select("o_orderkey", "round")


# ---- streams ------------------------------------------------------------------

EVENT_SCHEMA = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def _events_stream(spark, sf_dir):
    return live.read_landing(spark, f"{sf_dir}/event[s].parquet", EVENT_SCHEMA)


@query(
    "stream_landing_to_bronze",
    """
SELECT CAST(isoyear(CAST(ts AS DATE)) * 100 + week(CAST(ts AS DATE)) AS INTEGER) AS season, count(*) AS events,
       count(DISTINCT event_id) AS ids, true AS stamped FROM events GROUP BY 1""",
)
def stream_landing_to_bronze(spark, sf_dir):
    stream = _events_stream(spark, sf_dir)
    stream = stream.select(B.calendar_columns(F.to_date("ts"))[0], "event_id", "ts", "user_id", "value")
    target = shared_dir(spark, "bronze")
    live.land_bronze(stream, target, f"{target}-state").awaitTermination()
    back = spark.read.parquet(target)
    return back.groupBy("season").agg(
        F.count(F.lit(1)).alias("events"), F.countDistinct("event_id").alias("ids"), F.bool_and(F.col("_ingested_at").isNotNull()).alias("stamped"))


@query(
    "stream_season_refresh",
    """
SELECT CAST(isoyear(CAST(ts AS DATE)) * 100 + week(CAST(ts AS DATE)) AS INTEGER) AS season, count(*) AS events FROM events GROUP BY 1""",
)
def stream_season_refresh(spark, sf_dir):
    stream = _events_stream(spark, sf_dir).select(B.calendar_columns(F.to_date("ts"))[0], "event_id", "user_id", "value")
    target = shared_dir(spark, "seasons")
    live.refresh_on_arrival(stream, target, f"{target}-state")
    return spark.read.parquet(target).groupBy("season").agg(F.count(F.lit(1)).alias("events"))


@query("stream_dedup_on_arrival", "SELECT event_id, user_id, value FROM events")
def stream_dedup_on_arrival(spark, sf_dir):
    # Every event arrives twice.
    twice = _events_stream(spark, sf_dir).union(_events_stream(spark, sf_dir))
    once = live.dedup_on_arrival(twice.select("event_id", "ts", "user_id", "value"), ["event_id"], "ts", "60 days")
    return live.run_to_table(once, "dedup").drop("ts")


@query(
    "stream_latest_on_arrival",
    """
SELECT user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC, value DESC) = 1""",
)
def stream_latest_on_arrival(spark, sf_dir):
    """The latest event per user and type; events arrive in four batches, out of order."""
    folder = shared_dir(spark, "arrivals")
    events = B.table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    for part in range(4):
        # One file, which is read and filtered by as many tasks as the table has parts.
        events.filter(F.pmod("event_id", F.lit(4)) == part).repartition(1).write.mode("append").parquet(folder)
    stream = live.read_landing(spark, folder, "event_id bigint, ts timestamp, user_id bigint, event_type string, value double", 1)
    latest = live.latest_to_table(stream, ["user_id", "event_type"], "ts", "60 days", "latest")
    return latest.select("user_id", "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"), "event_id", "value")


@query(
    "stream_hourly_weather",
    """
SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M') AS hour, count(*) AS samples, max(value) AS max_track_temp,
       min(value) AS min_track_temp, round(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*), 6) AS avg_track_temp
FROM events GROUP BY time_bucket(INTERVAL 1 HOUR, ts)""",
)
def stream_hourly_weather(spark, sf_dir):
    stream = _events_stream(spark, sf_dir).select("ts", "value")
    hourly = live.windowed(
        stream, "ts", "1 hour", "2 hours",
        [F.count(F.lit(1)).alias("samples"), F.max("value").alias("max_track_temp"), F.min("value").alias("min_track_temp"),
         F.sum(B.money("value")).alias("total")],
    )
    table = live.windows_to_table(hourly, "weather")
    return S.rounded(table.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("hour"), "samples", "max_track_temp", "min_track_temp",
        (F.col("total").cast("double") / F.col("samples")).alias("avg_track_temp")))
