"""Table, report and catalog sinks, and the incremental refresh."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, partition: Sequence[str] = ("season",)) -> None:
    """Snappy Parquet, replaced as a whole, one folder per partition value."""
    df.write.mode("overwrite").option("compression", "snappy").partitionBy(*partition).parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """A Parquet table at `path`, bucketed and sorted by `keys`, one file per bucket.

    Tables with the same keys and number of buckets join and aggregate on these
    keys without an exchange.
    """
    dealt = df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("compression", "snappy")
    dealt.option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return df.sparkSession.table(table)


def write_observed(df: DataFrame, path: str) -> DataFrame:
    """Write `df` as Parquet and report on every column, from counts taken while writing: no other pass over the data.

    (column_name, rows, nulls, null_pct, fill_pct), the shares in per cent with
    one digit; they are null for an empty table. The counts are a few numbers
    per column.
    """
    spark = df.sparkSession
    seen = Observation()
    nulls = [F.sum(F.col(c).isNull().cast("long")).alias(f"nulls_{k}") for k, c in enumerate(df.columns)]
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *nulls).write.mode("overwrite").parquet(path)
    found = seen.get
    rows = [(c, found["rows"], found[f"nulls_{k}"] or 0) for k, c in enumerate(df.columns)]
    share = F.lit(100.0) * F.col("nulls") / F.nullif(F.col("rows"), F.lit(0))
    report = spark.createDataFrame(rows, "column_name string, rows bigint, nulls bigint")
    return report.select("*", F.round(share, 1).alias("null_pct"), F.round(100.0 - share, 1).alias("fill_pct"))


def write_ranked_csv(df: DataFrame, path: str, by: str) -> None:
    """A small report as one CSV file, highest `by` first."""
    df.orderBy(F.col(by).desc(), *[c for c in df.columns if c != by]).coalesce(1).write.mode("overwrite").option(
        "header", "true"
    ).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def refresh_partitions(df: DataFrame, path: str, partition: str = "season") -> None:
    """Replace only the partitions that `df` holds; others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def completed_rounds(schedule: DataFrame, run_date: Column) -> DataFrame:
    """Rounds that are over: testing sessions and round 0 excluded."""
    return schedule.filter(
        (F.col("EventDate") < run_date) & (F.col("EventFormat") != "testing") & (F.col("round") != 0)
    )


def feature_catalog(
    df: DataFrame, table: str, targets: Sequence[str], descriptions: Mapping[str, str] | None = None
) -> DataFrame:
    """One row per column: table, rows, name, type, role, description (also read from column metadata)."""
    notes = dict(descriptions or {})
    entries = [
        F.struct(
            F.lit(f.name).alias("feature"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.lit("target" if f.name in targets else "feature").alias("role"),
            F.lit(notes.get(f.name, f.metadata.get("description", ""))).alias("description"),
        )
        for f in df.schema
    ]
    rows = df.agg(F.count(F.lit(1)).alias("rows"))
    return rows.select(F.lit(table).alias("table_name"), "rows", F.inline(F.array(*entries)))


def described(df: DataFrame, descriptions: Mapping[str, str]) -> DataFrame:
    """Store column descriptions in the schema."""
    return df.select(
        *[F.col(c).alias(c, metadata={"description": descriptions[c]}) if c in descriptions else F.col(c) for c in df.columns]
    )
