"""Small frames for the decisions on ambiguous semantics, and properties of the features."""

import pandas as pd
import pytest
from table_rows import SF, rows_of
from pyspark.sql import functions as F

from lapwise import bindings as B
from lapwise.functions import scalars as S
from lapwise.operators import form, groups, ordered, quality
from lapwise.operators.regression import correlations, stint_slope
from lapwise.plans import gold, integrate, silver


def one(spark, rows, ddl, *columns):
    return [tuple(r) if len(r) > 1 else r[0] for r in spark.createDataFrame(rows, ddl).select(*columns).collect()]


def test_clock(spark):
    rows = [("1:23.456",), ("59.1",), ("1:02:03.4",), ("x:1",), (None,)]
    assert one(spark, rows, "t string", S.parse_clock(F.col("t"))) == [83.456, None, None, None, None]
    assert one(spark, rows, "t string", S.stop_seconds(F.col("t"))) == [83.456, 59.1, None, None, None]


def test_status(spark):
    rows = [("Finished",), ("+1 Lap",), ("Engine",), (None,)]
    assert one(spark, rows, "s string", S.is_finished(F.col("s"))) == [True, True, False, False]


def test_compounds(spark):
    rows = [("SOFT",), ("WET",), ("??",), (None,)]
    assert one(spark, rows, "c string", S.encode(F.col("c"))) == [0, 4, -1, -1]


def test_best_of_three(spark):
    rows = [(None, 80.0, 79.5), (None, None, None)]
    assert one(spark, rows, "a double, b double, c double", S.best_of("a", "b", "c")) == [79.5, None]


def test_flags_of_null(spark):
    rows = [(None,), (2,)]
    assert one(spark, rows, "p int", S.flag(F.col("p") <= 3), S.exceeds(F.col("p"), 1)) == [(0, False), (1, True)]
    assert one(spark, rows, "p int", S.clip(F.col("p"), 3, 20)) == [None, 3]


def series(spark, values):
    return spark.createDataFrame([("d", i, v) for i, v in enumerate(values)], "k string, t int, x double")


def column(df, name):
    return [r[name] for r in df.orderBy("t").collect()]


def test_rolling_and_spread(spark):
    d = series(spark, [1.0, 3.0, None, 10.0, 2.0])
    d = form.rolling_mean(d, ["k"], ["t"], {"m": F.col("x")})
    d = form.rolling_spread(d, ["k"], ["t"], F.col("x"), "s")
    assert column(d, "m") == [None, 1.0, 2.0, 2.0, pytest.approx(14 / 3)]
    assert column(d, "s") == [None, None, pytest.approx(1.41421356), pytest.approx(1.41421356), pytest.approx(4.72581563)]


def test_ewm(spark):
    d = form.ewm_before(series(spark, [1.0, 3.0, None, 10.0, 2.0]), ["k"], ["t"], {"e": F.col("x")})
    assert column(d, "e") == [None, 1.0, pytest.approx(2.2), pytest.approx(2.2), pytest.approx(6.68085106)]


def test_streak(spark):
    d = form.streaks_before(series(spark, [1.0, 1.0, 0.0, 1.0]), ["k"], ["t"], {"s": "x"})
    assert column(d, "s") == [0, 1, 2, 0]


def test_ranks(spark):
    d = series(spark, [3.0, 3.0, 1.0])
    assert column(ordered.with_rank(d, ["k"], "x", "r"), "r") == [1, 1, 3]
    assert column(ordered.with_rank(d, ["k"], "x", "r", descending=False, method="average"), "r") == [2, 2, 1]


def test_slope_edges(spark):
    rows = [("flat", 1.0, 2.0), ("flat", 2.0, 2.0), ("flat", 3.0, 2.0), ("same_x", 1.0, 1.0), ("same_x", 1.0, 2.0),
            ("same_x", 1.0, 3.0), ("two", 1.0, 1.0), ("two", 2.0, 2.0), ("nan", 1.0, float("nan")), ("nan", 2.0, 3.0),
            ("nan", 3.0, 5.0), ("line", 1.0, 1.0), ("line", 2.0, 3.0), ("line", 3.0, 5.0), ("line", 4.0, float("inf"))]
    d = stint_slope(spark.createDataFrame(rows, "k string, x double, y double"), ["k"], "x", "y", "s", "r")
    got = {r["k"]: (r["s"], r["r"]) for r in d.collect()}
    assert got == {"flat": (0.0, 0.0), "same_x": (None, None), "two": (None, None), "nan": (None, None), "line": (2.0, 1.0)}


def test_dedup_keeps_latest_and_is_idempotent(spark):
    rows = [(1, "2024-01-01", "a"), (1, "2024-01-02", "b"), (1, None, "c"), (2, "2024-01-01", "x"), (2, "2024-01-01", "y")]
    d = spark.createDataFrame(rows, "k int, at string, v string")
    once = groups.dedup_latest(d, ["k"], "at")
    assert [r["v"] for r in once.orderBy("k").collect()] == ["b", "y"]
    assert rows_of(groups.dedup_latest(once, ["k"], "at")) == rows_of(once)


def test_enrichment_replaces_columns(spark):
    left = spark.createDataFrame([(1, 5), (2, 6)], "k int, w int")
    dim = spark.createDataFrame([(1, 9)], "k int, w int")
    once = groups.left_enrich(left, dim, ["k"], {"w": 0})
    assert rows_of(once) == [(1, 9), (2, 0)]
    assert rows_of(groups.left_enrich(once, dim, ["k"], {"w": 0})) == rows_of(once)


def test_keys_by_available_column(spark):
    a, b = spark.createDataFrame([("x",)], "driver_id string"), spark.createDataFrame([("x",)], "driver_id string")
    assert groups.first_shared_key(a, b, ["driver_code", "driver_id"]) == "driver_id"
    with pytest.raises(ValueError):
        groups.first_shared_key(a, b, ["driver_code"])


def test_columns_found_by_fragment(spark):
    d = spark.createDataFrame([(1, 2)], "TrackTemp int, Humidity int")
    assert (S.find_column(d, "track", "temp"), S.find_column(d, "rain")) == ("TrackTemp", None)
    out = silver.weather_features(d.withColumn("season", F.lit(1)).withColumn("round", F.lit(1)))
    assert "had_rain" not in out.columns and out.first()["is_cold_race"] == 1


def test_intervals(spark):
    d = spark.sql("SELECT interval '1' hour + interval '1.5' second AS lap, interval '2' day AS gap, 3 AS b")
    assert tuple(S.seconds_of_intervals(d).first()) == (3601.5, 172800.0, 3)


def test_correlation_needs_pairs(spark):
    d = spark.createDataFrame([(float(i), float(2 * i), None if i % 2 else 1.0) for i in range(150)], "x double, y double, z double")
    got = {r["feature"]: r for r in correlations(d, {"a": "x", "b": "z"}, "y").collect()}
    assert got["a"]["correlation"] == pytest.approx(1.0)
    assert got["b"]["correlation"] is None and got["b"]["pairs"] == 75
    assert [r["accepted"] for r in quality.accepted_features(correlations(d, {"a": "x", "b": "z"}, "y"), []).collect()] == [True, False]


def bronze_results(spark):
    base = ("GP", "c1", "Circuit", "2024-03-01")
    rows = [
        ("2024", "1", *base, "d1", "AAA", "A A", "t1", "T", "3", "1", "25", "Finished", "50", "1:20.5", "2024-03-02 10:00:00"),
        ("2024", "1", *base, "d1", "AAA", "A A", "t1", "T", "2", "1", "25", "Finished", "50", "1:20.5", "2024-03-03 10:00:00"),
        ("2024", "1", *base, "d2", "BBB", "B B", "t1", "T", "x", None, "0", "Engine", "12", "bad", "2024-03-02 10:00:00"),
    ]
    names = ("season round race_name circuit_id circuit_name race_date driver_id driver_code driver_name constructor_id "
             "constructor_name grid position points status laps_completed fastest_lap_time _ingested_at").split()
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))


def test_silver_tables(spark):
    results = silver.race_results(bronze_results(spark))
    got = {r["driver_id"]: r for r in results.collect()}
    assert (got["d1"]["grid"], got["d1"]["position_gained"], got["d1"]["fastest_lap_seconds"], got["d1"]["dnf"]) == (2, 1, 80.5, False)
    assert (got["d2"]["grid"], got["d2"]["position"], got["d2"]["dnf"], got["d2"]["time_millis"]) == (None, None, True, None)
    quali = silver.qualifying(spark.createDataFrame(
        [(2024, 1, "d1", "1:20.0", "1:19.0", None)], "season int, round int, driver_id string, q1 string, q2 string, q3 string"))
    stops = silver.pit_stops(spark.createDataFrame(
        [(2024, 1, "d1", 1, "2.5"), (2024, 1, "d1", 2, "1:02.5")],
        "season int, round int, driver_id string, stop_number int, duration string"))
    assert [r["is_problem_stop"] for r in stops.orderBy("stop_number").collect()] == [False, True]
    master = {r["driver_id"]: r for r in silver.race_master(results, quali, stops).collect()}
    assert len(master) == 2
    assert (master["d1"]["best_quali_seconds"], master["d1"]["num_pit_stops"], master["d1"]["total_pit_time"], master["d1"]["had_slow_stop"]) == (79.0, 2, 65.0, 1)
    assert (master["d2"]["num_pit_stops"], master["d2"]["total_pit_time"]) == (0, None)


def test_strict_stop_durations(spark):
    d = spark.createDataFrame([(2024, 1, "d1", 1, "1:02.5")], "season int, round int, driver_id string, stop_number int, duration string")
    row = silver.pit_stops(d, strict=True).first()
    assert (row["duration_seconds"], row["is_slow_stop"]) == (None, False)


def test_silver_laps(spark):
    rows = [(2024, 1, "a", 1.0, "SOFT", "90.5"), (2024, 1, "b", 1.0, "OTHER", "91.0"), (2024, 1, "b", 2.0, None, None)]
    d = spark.createDataFrame(rows, "season int, round int, Driver string, LapNumber double, Compound string, LapTime_seconds string")
    got = {(r["Driver"], r["LapNumber"]): (r["compound_encoded"], r["delta_to_leader_seconds"]) for r in silver.laps(d).collect()}
    assert got == {("a", 1.0): (0, 0.0), ("b", 1.0): (-1, 0.5), ("b", 2.0): (-1, None)}


def test_stint_counts_treat_nulls_as_equal(spark):
    rows = [(1, 1, "a", i, c) for i, c in enumerate(["SOFT", "SOFT", None, None, "SOFT"], 1)]
    d = spark.createDataFrame(rows, "season int, round int, Driver string, LapNumber int, Compound string")
    assert integrate.stint_counts(d.orderBy(F.desc("LapNumber"))).first()["num_stints"] == 3


def entries(spark):
    return B.contest(spark, SF)


def test_first_race_and_first_visit(spark):
    d = gold.season_points(gold.circuit_history(entries(spark)))
    first = d.orderBy("driver_id", "season", "round").groupBy("driver_id").agg(
        F.min_by(F.struct("circuit_races_count", "season_cumulative_points", "circuit_avg_position"), F.struct("season", "round")).alias("f"))
    assert {tuple(r["f"]) for r in first.collect()} == {(0, 0.0, None)}


def test_features_do_not_leak(spark):
    """Changing the last race changes no feature of that race that claims to be known before."""
    d = entries(spark)
    last = d.agg(F.max(F.struct("season", "round"))).first()[0]
    is_last = (F.col("season") == last["season"]) & (F.col("round") == last["round"])
    changed = d.withColumn("position", F.when(is_last, F.lit(99).cast("long")).otherwise(F.col("position"))).withColumn(
        "points", F.when(is_last, F.lit(-1.0)).otherwise(F.col("points")))
    names = ["rolling_avg_position_5", "rolling_avg_points_5", "constructor_rolling_points", "rolling_consistency",
             "circuit_avg_position", "season_cumulative_points", "win_streak", "ewm_position_5", "circuit_chaos_index"]

    def features(x):
        x = gold.constructor_form(gold.season_points(gold.circuit_history(gold.rolling_form(gold.targets(x)))), hot=ordered.BOUNDED)
        x = gold.circuit_risk(gold.ewm_form(gold.streaks(x)))
        return rows_of(x.filter(is_last).select("driver_id", *names))

    assert features(d) == features(changed)


def test_left_joins_keep_rows(spark):
    d = entries(spark)
    n = d.count()
    assert gold.race_features(d).count() == n
    assert integrate.merge_by_code(d, integrate.tire_features(integrate.tire_degradation(B.laps(spark, SF)))).count() == n


def test_ewm_and_streaks_against_pandas(spark):
    d = gold.ewm_form(gold.streaks(gold.targets(entries(spark))))
    p = d.select("driver_id", "season", "round", "target_position", "target_podium", "ewm_position_5", "podium_streak").toPandas()
    p = p.sort_values(["driver_id", "season", "round"])
    want = p.groupby("driver_id")["target_position"].transform(lambda s: s.astype(float).ewm(span=5).mean().shift(1))
    pd.testing.assert_series_equal(p["ewm_position_5"], want, check_names=False, rtol=1e-9)
    for _, g in p.groupby("driver_id"):
        run = 0
        for flag, streak in zip(g["target_podium"], g["podium_streak"]):
            assert streak == run
            run = run + 1 if flag else 0


def test_season_progress_with_schedule(spark):
    d = spark.createDataFrame([(2024, 2), (2024, 4)], "season int, round int")
    schedule = spark.createDataFrame([(2024, r) for r in range(1, 9)], "season int, round int")
    assert [r["season_progress"] for r in gold.season_phase(d, schedule).orderBy("round").collect()] == [0.25, 0.5]
    assert [r["season_progress"] for r in gold.season_phase(d).orderBy("round").collect()] == [0.5, 1.0]


def test_pre_race_columns():
    assert gold.pre_race_columns(["grid", "pace_vs_field", "target_winner", "points"]) == ["grid"]


def test_spread_of_large_values_keeps_its_digits(spark):
    rows = [(2024, r, "c", 1e9 + 7 * r + d, False) for r in range(1, 9) for d in (0.0, 0.5, 1.25)]
    df = spark.createDataFrame(rows, "season int, round int, circuit_id string, position double, dnf boolean")
    for full in (False, True):
        got = {r["round"]: r["circuit_chaos_index"] for r in gold.circuit_risk(df, full).collect()}
        for race in range(2, 9):
            seen = [x[3] for x in rows if full or x[1] < race]
            assert got[race] == pytest.approx(pd.Series(seen).std(), abs=1e-9)
