"""Streams over folders that grow between runs."""

import pytest
from pyspark.sql import functions as F
from table_rows import rows_of

from lapwise.operators.groups import dedup_latest
from lapwise.session import shared_dir
from lapwise.streaming import live

SCHEMA = "id bigint, season int, ts timestamp"


def batch(spark, folder, ids, season):
    d = spark.createDataFrame([(i, season) for i in ids], "id bigint, season int")
    d.withColumn("ts", F.timestamp_seconds(F.col("id") * 60)).write.mode("append").parquet(folder)


def test_bronze_grows_once_per_file(spark):
    src, out = shared_dir(spark, "src"), shared_dir(spark, "bronze")
    batch(spark, src, range(3), 2023)
    live.land_bronze(live.read_landing(spark, src, SCHEMA), out, f"{out}-state").awaitTermination()
    live.land_bronze(live.read_landing(spark, src, SCHEMA), out, f"{out}-state").awaitTermination()
    assert spark.read.parquet(out).count() == 3
    batch(spark, src, range(3, 5), 2024)
    live.land_bronze(live.read_landing(spark, src, SCHEMA, 1), out, f"{out}-state").awaitTermination()
    assert rows_of(spark.read.parquet(out).select("id", "season")) == [(0, 2023), (1, 2023), (2, 2023), (3, 2024), (4, 2024)]


def test_refresh_replaces_only_arriving_seasons(spark):
    src, out = shared_dir(spark, "src"), shared_dir(spark, "gold")
    batch(spark, src, [1, 2], 2023)
    batch(spark, src, [3], 2024)
    live.refresh_on_arrival(live.read_landing(spark, src, SCHEMA), out, f"{out}-state")
    batch(spark, src, [9], 2024)
    live.refresh_on_arrival(live.read_landing(spark, src, SCHEMA), out, f"{out}-state")
    assert rows_of(spark.read.schema(SCHEMA).parquet(out).select("id", "season")) == [(1, 2023), (2, 2023), (9, 2024)]


def test_a_season_may_span_batches(spark):
    src, out = shared_dir(spark, "src"), shared_dir(spark, "gold")
    for ids in ([1, 2], [3, 4], [5]):
        batch(spark, src, ids, 2024)
    live.refresh_on_arrival(live.read_landing(spark, src, SCHEMA, files_per_trigger=1), out, f"{out}-state")
    live.refresh_on_arrival(live.read_landing(spark, src, SCHEMA, files_per_trigger=1), out, f"{out}-state")
    assert sorted(r["id"] for r in spark.read.schema(SCHEMA).parquet(out).collect()) == [1, 2, 3, 4, 5]


def test_last_windows_are_in_the_table(spark):
    src = shared_dir(spark, "src")
    for ids in ([1, 2], [70, 300], [301]):
        batch(spark, src, ids, 2024)
    stream = live.read_landing(spark, src, SCHEMA, files_per_trigger=1)
    out = live.windows_to_table(live.windowed(stream, "ts", "1 hour", "30 days", [F.count(F.lit(1)).alias("n")]), "win")
    assert sorted(r["n"] for r in out.collect()) == [1, 2, 2]


def test_dedup_across_batches(spark):
    src = shared_dir(spark, "src")
    batch(spark, src, [1, 2], 2024)
    batch(spark, src, [2, 3], 2024)
    stream = live.read_landing(spark, src, SCHEMA, files_per_trigger=1)
    out = live.run_to_table(live.dedup_on_arrival(stream, ["id"], "ts", "1 hour"), "dedup")
    assert rows_of(out.select("id")) == [(1,), (2,), (3,)]


def test_late_rows_are_left_out_of_closed_windows(spark):
    src = shared_dir(spark, "src")
    batch(spark, src, [1, 2, 300], 2024)
    stream = live.read_landing(spark, src, SCHEMA)
    out = live.run_to_table(live.windowed(stream, "ts", "1 hour", "1 hour", [F.count(F.lit(1)).alias("n")]), "win")
    assert [r["n"] for r in out.collect()] == [2]


EVENTS = "k string, ts timestamp, a bigint, b string"


def events(spark, folder, rows):
    d = spark.createDataFrame(rows, "k string, minute int, a bigint, b string").coalesce(1)
    d.select("k", F.timestamp_seconds(F.col("minute") * 60).alias("ts"), "a", "b").write.mode("append").parquet(folder)


def test_latest_on_arrival_is_the_batch_dedup(spark):
    src = shared_dir(spark, "src")
    events(spark, src, [("x", 5, 1, "p"), ("y", 9, 1, None), ("x", 5, 2, None), (None, 3, 7, "n"), ("z", None, 1, "q")])
    events(spark, src, [("x", 4, 9, "z"), ("y", 9, 1, "a"), ("w", 1, None, None), ("v", 2, (1 << 60) + 1, "")])
    events(spark, src, [("x", 6, 0, "r"), ("w", 1, 0, None), ("y", 8, 5, "b")])
    stream = live.read_landing(spark, src, EVENTS, files_per_trigger=1)
    got = live.latest_to_table(stream, ["k"], "ts", "30 days", "latest")
    want = dedup_latest(spark.read.schema(EVENTS).parquet(src).filter("ts IS NOT NULL"), ["k"], "ts")
    assert rows_of(got) == rows_of(want) and got.count() == 5


def test_rows_are_sent_on_when_the_watermark_has_passed(spark):
    src = shared_dir(spark, "src")
    for rows in ([("x", 1, 1, "p"), ("y", 2, 1, "p")], [("y", 3, 2, "q"), ("far", 500, 1, "p")], [("far", 501, 2, "p")], [("x", 2, 9, "late")]):
        events(spark, src, rows)
    stream = live.read_landing(spark, src, EVENTS, files_per_trigger=1)
    with pytest.warns(UserWarning, match="1 rows came behind the watermark"):
        got = live.latest_to_table(stream, ["k"], "ts", "10 minutes", "latest")
    # The late row is not in the table: x was settled before it came.
    assert sorted((r["k"], r["a"]) for r in got.collect()) == [("far", 2), ("x", 1), ("y", 2)]


def test_keys_share_state_values(spark, monkeypatch):
    """Thousands of keys cost a few state values and timers; each key still has its own latest row."""
    src = shared_dir(spark, "src")
    schema = "k double, n decimal(9,2), d date, ts timestamp, v double, kind string"
    for part in range(3):
        d = spark.range(300).select(
            F.when(F.col("id") % 50 == 7, F.lit(float("nan"))).when(F.col("id") % 50 == 8, F.lit(None)).otherwise(F.col("id") % 50).cast("double").alias("k"),
            (F.col("id") % 3).cast("decimal(9,2)").alias("n"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 2).cast("int")).alias("d"),
            F.timestamp_seconds(F.pmod(F.col("id") * 37 + part * 11, F.lit(101)) * 60 + 60).alias("ts"), (F.col("id") + part * 0.5).alias("v"),
            F.concat(F.lit("t"), (F.col("id") % 4).cast("string")).alias("kind"))
        d.coalesce(1).write.mode("append").parquet(src)
    monkeypatch.setattr(live, "KEY_PARTS", 3)
    seen, plain = [], live.materialised
    monkeypatch.setattr(live, "materialised", lambda df, label: seen.append(df) or plain(df, label))
    stream = live.read_landing(spark, src, schema, files_per_trigger=1)
    got = live.latest_to_table(stream, ["k", "n", "d"], "ts", "30 days", "latest")
    want = dedup_latest(spark.read.schema(schema).parquet(src), ["k", "n", "d"], "ts")
    shown = lambda df: sorted(map(str, df.collect()))
    assert shown(got) == shown(want) and got.count() > 100
    # One value for each part, from which all held rows come.
    assert seen[0].count() == got.count()


def test_rows_of_a_part_are_sent_on_at_their_own_times(spark, monkeypatch):
    src, out = shared_dir(spark, "src"), shared_dir(spark, "sent")
    for rows in ([("x", 1, 1, "p"), ("y", 20, 1, "p"), ("z", 40, 1, "p")], [("far", 35, 1, "p")], [("far", 36, 2, "p")], [("x", 37, 3, "again")]):
        events(spark, src, rows)
    monkeypatch.setattr(live, "KEY_PARTS", 1)
    provider = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        latest = live.keep_latest_on_arrival(live.read_landing(spark, src, EVENTS, files_per_trigger=1), ["k"], "ts", "10 minutes")
        latest.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-state").trigger(availableNow=True).start().awaitTermination()
        held = spark.read.format("statestore").option("path", f"{out}-state").option("stateVarName", "latest").load()
        assert held.count() == 1
    finally:
        spark.conf.unset(provider)
    # The watermark ends at 30 minutes.
    assert sorted((r["k"], r["a"]) for r in spark.read.schema(EVENTS).parquet(out).collect()) == [("x", 1), ("y", 1)]
