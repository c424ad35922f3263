"""Incremental ingestion with Structured Streaming."""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from lapwise.operators.groups import dedup_latest
from lapwise.session import materialised, shared_dir
from lapwise.sources.scan import read_glob


def read_landing(spark: SparkSession, path: str, schema: str, files_per_trigger: int | None = None) -> DataFrame:
    """New Parquet files of a folder or pattern as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def land_bronze(stream: DataFrame, target: str, checkpoint: str, partition: Sequence[str] = ("season",)) -> StreamingQuery:
    """Append everything that is available to the bronze table and stop.

    The file sink commits each batch atomically, so a batch that runs again
    after a failure adds nothing twice.
    """
    stamped = stream.withColumn("_ingested_at", F.current_timestamp())
    return (
        stamped.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
        .partitionBy(*partition).trigger(availableNow=True).start()
    )


def refresh_on_arrival(stream: DataFrame, target: str, checkpoint: str, partition: str = "season") -> None:
    """Replace the seasons that newly arrived files bring, by all their rows; other seasons stay.

    Batches are first collected below the checkpoint, so a season may span any
    number of them. Then one job replaces the partitions and notes the last
    batch it covered. Repeating a batch or the whole call gives the same table.
    """
    spark = stream.sparkSession
    arrived, applied = f"{checkpoint}-arrived", f"{checkpoint}-applied"

    def collect(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{arrived}/__batch={number}")

    query = stream.writeStream.foreachBatch(collect).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query.start().awaitTermination()
    done = read_glob(spark, applied, "batch bigint").agg(F.max("batch")).first()[0]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema)
    rows = read_glob(spark, arrived, f"{fields}, __batch bigint")
    rows = rows.filter(F.col("__batch") > (-1 if done is None else done))
    last = rows.agg(F.max("__batch")).first()[0]
    if last is None:
        return
    rows = rows.drop("__batch")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(target)
    spark.createDataFrame([(last,)], "batch bigint").write.mode("append").parquet(applied)


def dedup_on_arrival(stream: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """Drop repeats of a key within the watermark. The first arrival stays, while the batch form keeps the latest."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


# Parts that the keys of `keep_latest_on_arrival` are spread over; fixed, as state of earlier runs is found by them.
KEY_PARTS = 2048


class KeepLatest(StatefulProcessor):
    """Per key the latest row that has arrived, held until the watermark passes its time; then it is sent on.

    Rows compare by time, then by their other columns, nulls first, like the
    batch form. A later row takes the place of the one that is held, and its
    time. Keys come in parts: a part's rows are one state value and its earliest
    time is one timer, so a batch costs a few calls to the state store for each
    part, not for each key. The first field of a held row is the time, in microseconds.
    """

    def __init__(self, value: T.StructType, columns: Sequence[str], keys: Sequence[str]):
        self.value, self.columns, self.keys = value, list(columns), list(keys)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.latest = handle.getValueState("latest", T.StructType([T.StructField("rows", T.ArrayType(self.value))]))
        self.at = [self.value.names.index(c) for c in self.keys]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        held = self._held()
        best = {self._key(row): row for row in held}
        place = [self.columns.index(c) for c in self.value.names]
        for row in rows:
            # By position: names that begin with an underscore do not arrive as they were.
            row = tuple(row[i] for i in place)
            name = self._key(row)
            if name not in best or _order(row) > _order(best[name]):
                best[name] = row
        self._hold(held, list(best.values()))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        held, mark = self._held(), timerValues.getCurrentWatermarkInMs()
        # The timer itself is gone.
        self._hold([], [row for row in held if _due(row) > mark])
        for row in held:
            if _due(row) <= mark:
                at = dict(zip(self.value.names, row))
                yield Row(**{c: at[c] for c in self.columns})

    def close(self) -> None:
        pass

    def _held(self) -> list[tuple]:
        held = self.latest.get()
        return [] if held is None else [tuple(row) for row in held[0]]

    def _hold(self, before: list[tuple], rows: list[tuple]) -> None:
        """Put `rows` in the place of those before, and the timer where the first of them is due."""
        old, new = (min(map(_due, part), default=None) for part in (before, rows))
        if old is not None and old != new:
            self.handle.deleteTimer(old)
        if new is not None and old != new:
            self.handle.registerTimer(new)
        if rows:
            self.latest.update((rows,))
        else:
            self.latest.clear()

    def _key(self, row: tuple) -> tuple:
        return tuple(_name(row[i]) for i in self.at)


def _due(row: tuple) -> int:
    """The timer of a row: past its own time, so that the watermark has passed it."""
    return row[0] // 1000 + 1


def _name(value: object) -> object:
    """A key's value such that equal ones, two NaN among them, are equal in Python and can be looked up."""
    if isinstance(value, (list, tuple, bytearray)):
        return tuple(map(_name, value))
    return value if value == value else "NaN"


def _order(row: tuple) -> tuple:
    return tuple((False,) if v is None else (True, v) for v in row)


def keep_latest_on_arrival(stream: DataFrame, keys: Sequence[str], time: str, delay: str, parts: int | None = None) -> DataFrame:
    """The latest row of each key, sent on once the watermark has passed it; rows behind the watermark are dropped.

    A key that comes again after that starts anew, so state holds only the keys
    of the last `delay`. Keys are spread over `parts` (`KEY_PARTS`) by hash, and a part is read
    and written as a whole. Rows without a time are left out. Needs the RocksDB state store (see `latest_to_table`).
    """
    times = [f.name for f in stream.schema if isinstance(f.dataType, T.TimestampType)]
    inside = T.StructType([T.StructField(f.name, T.LongType() if f.name in times else f.dataType) for f in stream.schema])
    others = [c for c in stream.columns if c != time]
    # Keys last: what orders the rows of a key comes first.
    value = T.StructType([inside[c] for c in [time, *[c for c in others if c not in keys], *[c for c in others if c in keys]]])
    # Times pass through the state as microseconds, whole and free of zones; the watermark column goes along.
    rows = stream.filter(F.col(time).isNotNull()).withColumn("__event", F.col(time)).withWatermark("__event", delay)
    rows = rows.select(
        *[F.unix_micros(c).alias(c) if c in times else c for c in stream.columns], "__event",
        F.pmod(F.xxhash64(*keys), F.lit(parts or KEY_PARTS)).cast("int").alias("__keys"))
    processor = KeepLatest(value, stream.columns, keys)
    latest = rows.groupBy("__keys").transformWithState(processor, inside, "Append", "EventTime")
    return latest.select(*[F.timestamp_micros(c).alias(c) if c in times else c for c in stream.columns])


def latest_to_table(stream: DataFrame, keys: Sequence[str], time: str, delay: str, label: str) -> DataFrame:
    """The latest row of each key over all available data: what the stream has sent on, and what it still holds.

    The rows held at the end are read from the state of the last batch. A key
    sent on more than once keeps its latest row. Late rows are reported.
    """
    spark = stream.sparkSession
    target = shared_dir(spark, label)
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider, None)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        latest = keep_latest_on_arrival(stream, keys, time, delay)
        query = (
            latest.writeStream.format("parquet").outputMode("append").option("path", target)
            .option("checkpointLocation", f"{target}-state").trigger(availableNow=True).start()
        )
        query.awaitTermination()
        _report_late(query, label)
        held = spark.read.format("statestore").option("path", f"{target}-state").option("stateVarName", "latest").load()
        held = held.select(F.inline("value.rows")).select(*stream.columns)
        held = held.select(*[F.timestamp_micros(f.name).alias(f.name) if isinstance(f.dataType, T.TimestampType) else f.name for f in stream.schema])
        held = materialised(held, label)
    finally:
        if before is None:
            spark.conf.unset(provider)
        else:
            spark.conf.set(provider, before)
    sent = spark.read.schema(stream.schema).parquet(target)
    return dedup_latest(sent.union(held), keys, time)


def windowed(stream: DataFrame, time: str, width: str, delay: str, aggregates: Sequence[Column]) -> DataFrame:
    """Event-time windows; with append output a window appears once the watermark has passed it."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, width).alias("w")).agg(*aggregates).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "*"
    ).drop("w")


def run_to_table(stream: DataFrame, label: str, mode: str = "append") -> DataFrame:
    """Run a stream over all available data into a table in the shared folder and read it back.

    Rows that came behind the watermark are counted and reported as a warning.
    """
    spark = stream.sparkSession
    target = shared_dir(spark, label)
    query = (
        stream.writeStream.format("parquet").outputMode(mode).option("path", target)
        .option("checkpointLocation", f"{target}-state").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    _report_late(query, label)
    return spark.read.schema(stream.schema).parquet(target)


def late_rows(query: StreamingQuery) -> int:
    """Rows that the stateful operators of a finished run dropped behind the watermark."""
    return sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)


def _report_late(query: StreamingQuery, label: str) -> None:
    late = late_rows(query)
    if late:
        warnings.warn(f"{label}: {late} rows came behind the watermark and were dropped", stacklevel=3)


def windows_to_table(stream: DataFrame, label: str, keys: Sequence[str] = ("window_start", "window_end")) -> DataFrame:
    """Run windowed aggregates over all available data to the end, the last windows included.

    Append output would hold back windows that the watermark has not passed.
    Updates are written per batch instead, and the last one of each window is
    the result.
    """
    spark = stream.sparkSession
    target = shared_dir(spark, label)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/__batch={number}")

    query = (
        stream.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", f"{target}-state")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    _report_late(query, label)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema)
    rows = read_glob(spark, target, f"{fields}, __batch bigint")
    rest = [c for c in stream.columns if c not in keys]
    last = rows.groupBy(*keys).agg(F.max(F.struct("__batch", *rest)).alias("__last"))
    return last.select(*[F.col(c) if c in keys else F.col(f"__last.{c}").alias(c) for c in stream.columns])
