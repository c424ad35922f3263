"""Scans, landing pages, sinks and run history on small files."""

import os
import warnings

import pytest
from table_rows import rows_of
from pyspark.sql import functions as F

from lapwise import schemas
from lapwise.plans import history, questions
from lapwise.session import materialised, shared_dir, shared_root
from lapwise.sources import landing, scan, sinks


def test_pattern_without_files(spark):
    df = scan.read_glob(spark, "/root/testdata/sf0.001/absent_*.parquet", "a int")
    assert (df.columns, df.count()) == (["a"], 0)


def test_drift(spark):
    folder = shared_dir(spark, "drift")
    spark.createDataFrame([(1, 2.5)], "a int, b double").write.parquet(f"{folder}/x")
    spark.createDataFrame([("7", "bad", "extra")], "a string, b string, z string").write.parquet(f"{folder}/y")
    spark.createDataFrame([("note",)], "c string").write.parquet(f"{folder}/z")
    spark.createDataFrame([("junk",)], "v string").write.text(f"{folder}/t")
    [path] = [r[0] for r in spark.read.format("binaryFile").load(f"{folder}/t").select("path").collect()]
    with open(f"{folder}/broken.parquet", "wb") as file:
        file.write(b"not parquet")
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        df = scan.read_drifting(spark, folder, "a int, b double, c string", skip_unreadable=True)
    with pytest.raises(ValueError, match="broken.parquet"):
        scan.read_drifting(spark, folder, "a int")
    assert any("broken.parquet" in str(w.message) for w in seen) and path
    assert rows_of(df) == sorted([(1, 2.5, None), (7, None, None), (None, None, "note")], key=repr)


def test_damaged_pages_fail_the_read(spark):
    folder = shared_dir(spark, "drift")
    spark.range(200_000).selectExpr("id AS a", "uuid() AS b").coalesce(1).write.parquet(folder)
    [path] = [r[0].removeprefix("file:") for r in spark.read.format("binaryFile").load(folder).select("path").collect()]
    with open(path, "r+b") as file:
        file.seek(500_000)
        file.write(b"\xff" * 200_000)
    os.remove(os.path.join(os.path.dirname(path), "." + os.path.basename(path) + ".crc"))
    with pytest.raises(Exception):  # noqa: B017
        scan.read_drifting(spark, folder, "a bigint, b string").agg(F.sum("a"), F.max("b")).collect()


def test_drift_without_files(spark):
    folder = shared_dir(spark, "drift")
    spark.createDataFrame([("junk",)], "v string").write.text(folder)
    assert scan.read_drifting(spark, folder, "a int").count() == 0


def test_first_table(spark):
    spark.range(3).createOrReplaceTempView("base_table")
    assert scan.first_table(spark, ["better_table", "base_table"]).count() == 3
    with pytest.raises(LookupError):
        scan.first_table(spark, ["better_table"])


def test_pushdown_and_pruning(spark):
    df = scan.read_table(spark, "/root/testdata/sf0.001/lineitem.parquet").filter("l_quantity < 5").select("l_orderkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(l_quantity,5.0)" in plan and "l_extendedprice" not in plan


def test_result_page_edges(spark):
    folder = shared_dir(spark, "pages")
    page = (
        '{"MRData":{"total":"2","RaceTable":{"Races":[{"season":"2024","round":"1","raceName":"GP","date":"2024-03-02",'
        '"Circuit":{"circuitId":"c","circuitName":"C"},"Results":[{"position":"1","points":"25","grid":"1",'
        '"Driver":{"driverId":"d","givenName":"A","familyName":"B"},"Constructor":{"constructorId":"t","name":"T"},'
        '"status":"Finished","laps":"57"},{"position":"R","Driver":{"driverId":"e","code":"EEE","givenName":"E","familyName":"F"},'
        '"Time":{"millis":"5400000"}}]}]}}}'
    )
    empty = '{"MRData":{"total":"2","RaceTable":{"Races":[]}}}'
    spark.createDataFrame([(page,), (empty,)], "value string").write.text(folder)
    pages = landing.read_pages(spark, folder, schemas.RESULT_PAGE)
    df = landing.flatten_results(pages).filter("driver_id IS NOT NULL")
    got = rows_of(df.select("driver_id", "driver_code", "driver_name", "position", "time_millis", "laps_completed"))
    assert got == [("", "d", "A B", 57, 1, None), ("EEE", "e", "E F", None, None, 5400000)]
    items = F.get("MRData.RaceTable.Races", F.lit(0))["Results"]
    assert tuple(landing.page_totals(pages, items).first()) == (2, 2, True)


def test_refresh_keeps_other_seasons(spark):
    folder = shared_dir(spark, "seasons")
    old = spark.createDataFrame([(1, 2023), (2, 2024)], "v int, season int")
    sinks.write_table(old, folder)
    sinks.refresh_partitions(spark.createDataFrame([(9, 2024), (8, 2024)], "v int, season int"), folder)
    assert rows_of(spark.read.parquet(folder)) == [(2023, 1), (2024, 8), (2024, 9)]


def test_csv_is_sorted(spark):
    folder = shared_dir(spark, "csv")
    sinks.write_ranked_csv(spark.createDataFrame([("a", 0.1), ("b", 0.7)], "f string, i double"), folder, "i")
    assert [r["f"] for r in spark.read.option("header", True).csv(folder).collect()] == ["b", "a"]


def test_newest_file(spark):
    folder = shared_dir(spark, "json")
    for name in ("r_1", "r_2"):
        spark.createDataFrame([(name,)], "v string").coalesce(1).write.mode("append").json(folder)
    df = spark.read.schema("v string").json(folder)
    assert scan.newest_file(df).count() == 1


def test_shared_folder_is_read_from_the_session(spark):
    root = shared_root(spark)
    assert spark.conf.get("spark.checkpoint.dir") == root
    df = materialised(spark.range(5).toDF("a"), "t")
    assert df.count() == 5 and shared_root(spark) == root


def test_history(spark):
    path = shared_dir(spark, "runs")
    rows = [
        (f"r{i}", f"2024-01-{i:02d} 00:00:00", f"2024-01-{i:02d}", "HEALTHY" if i != 25 else "ISSUES", 5, ["x"] * (i % 2), None if i == 21 else 30.0 - i,
         ["monza", "spa"] if i % 2 else ["spa"], i == 23)
        for i in range(1, 26)
    ]
    raw = spark.createDataFrame(
        rows, "run_id string, ts string, run_date string, status string, features_proposed int, names array<string>, model_mae double, "
              "worst_circuits array<string>, retrain_triggered boolean")
    df = raw.select(
        "run_id", F.to_timestamp("ts").alias("ts"), F.to_date("run_date").alias("run_date"),
        F.struct("status", F.lit(1).cast("bigint").alias("row_count"), F.create_map(F.lit("a"), F.lit(0.0)).alias("null_rates")).alias("health"),
        "features_proposed", F.transform("names", lambda n: F.struct(n.alias("name"), F.lit(0.2).alias("correlation"))).alias("features_accepted"),
        F.array().cast("array<struct<name:string,correlation:double>>").alias("features_rejected"), "model_mae", "worst_circuits",
        "retrain_triggered", F.lit("").alias("briefing_preview"))
    history.append_run(df.filter("run_id <> 'r25'"), path)
    history.append_run(df.filter("run_id = 'r25'"), path)
    runs = spark.read.schema(schemas.RUN_RECORD).parquet(path)
    assert runs.count() == 25 and history.recent(runs).count() == 20
    t = history.trend(runs).first()
    assert (t["runs"], t["first_mae"], t["last_mae"], t["mae_trend"]) == (5, 8.0, 5.0, "improving")
    assert (t["accepted"], t["proposed"], t["unhealthy"], t["retrained"]) == (3, 25, 1, 1)
    assert [tuple(r) for r in history.recurring_circuits(runs).collect()] == [("spa", 5), ("monza", 3)]
    shown = history.display(history.recent(runs, 1)).first()
    assert (shown["data_health"], shown["retrain"], shown["worst_circuit"]) == ("ISSUES", "No", "monza")


def test_best_model_first_wins_ties(spark):
    m = spark.createDataFrame([("t", "b", 1, 0.5), ("t", "a", 0, 0.5), ("t", "c", 2, 0.4)], "task string, model string, tried int, value double")
    assert tuple(history.best_model(m, True).first()) == ("t", "a", 0.5)
    assert tuple(history.best_model(m, False).first()) == ("t", "c", 0.4)


def test_answers_are_capped(spark):
    d = spark.range(50).select(F.col("id").alias("driver_id"), F.lit(1).alias("target_winner"), F.lit(2024).alias("season"))
    assert questions.ask(d, "most_wins_in_season", season=2024).count() == questions.ROW_CAP


def test_bucketed_tables_join_without_an_exchange(spark):
    from lapwise.plans import silver

    results = spark.range(500).selectExpr("cast(2020 + id % 5 as int) AS season", "cast(id % 10 as int) AS round", "cast(id AS string) AS driver_id",
                                          "cast(id % 20 as int) AS grid")
    quali = results.filter("grid < 15").selectExpr("season", "round", "driver_id", *[f"1.0D * grid AS {c}" for c in silver.QUALI_COLUMNS])
    stops = results.filter("grid > 3").selectExpr("season", "round", "driver_id", "1 AS stop_number", "2.0D AS duration_seconds", "false AS is_slow_stop")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = silver.race_master(*silver.store_bucketed(results, quali, stops, 3))
        plan = stored._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert rows_of(stored) == rows_of(silver.race_master(results, quali, stops))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_write_reports_on_every_column(spark):
    path = shared_dir(spark, "observed")
    df = spark.createDataFrame([(1, None, "a"), (2, None, None), (3, 4.0, "c")], "id int, v double, t string")
    got = {r["column_name"]: (r["rows"], r["nulls"], r["null_pct"], r["fill_pct"]) for r in sinks.write_observed(df, path).collect()}
    assert got == {"id": (3, 0, 0.0, 100.0), "v": (3, 2, 66.7, 33.3), "t": (3, 1, 33.3, 66.7)}
    assert spark.read.parquet(path).count() == 3
    empty = sinks.write_observed(df.limit(0), shared_dir(spark, "observed")).collect()
    assert [(r["rows"], r["nulls"], r["null_pct"]) for r in empty] == [(0, 0, None)] * 3
