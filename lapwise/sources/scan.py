"""Parquet scans: whole tables, file patterns, drifting schemas, and preference lists."""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapwise.functions.scalars import typed


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """One Parquet table; columns and filters reach the scan."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def read_glob(spark: SparkSession, pattern: str, schema: str) -> DataFrame:
    """All files that match a pattern in one scan; an empty frame if there are none."""
    try:
        return spark.read.schema(schema).parquet(pattern)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error.getCondition() or error):
            raise
        return spark.createDataFrame([], schema)


def _footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyarrow import fs

    for batch in batches:
        shapes = []
        for path in batch["path"]:
            try:
                system, name = fs.FileSystem.from_uri(path)
                with system.open_input_file(name) as file:
                    shapes.append(str(pq.read_schema(file).remove_metadata()))
            except pa.ArrowInvalid:
                # Not Parquet. Other errors, such as those of the network, fail the task and are tried again.
                shapes.append(None)
        yield pd.DataFrame({"path": batch["path"], "shape": shapes})


def read_drifting(spark: SparkSession, folder: str, schema: str, skip_unreadable: bool = False) -> DataFrame:
    """Files whose column sets and types drift, brought to one declared schema.

    Tasks read the footers; then there is one scan per distinct footer schema,
    never one per file. A file without a Parquet footer is an error, or left out
    with a warning if `skip_unreadable`; damage below the footer always fails
    the read, so rows are never lost in silence. Values that do not fit the
    declared type, and absent columns, become null.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    shapes = files.load(folder).select("path").mapInPandas(_footers, "path string, shape string")
    # One short row per file, which Spark's own file index also holds on the driver.
    groups: dict[str | None, list[str]] = {}
    for row in shapes.collect():
        groups.setdefault(row.shape, []).append(row.path)
    unreadable = groups.pop(None, [])
    if unreadable and not skip_unreadable:
        raise ValueError(f"{len(unreadable)} files are not Parquet, first: {unreadable[0]}")
    for path in unreadable:
        warnings.warn(f"skipped unreadable file {path}", stacklevel=2)
    out = None
    for _, paths in sorted(groups.items()):
        scan = spark.read.option("ignoreCorruptFiles", "false").parquet(*paths)
        part = scan.select(*typed(schema, scan.columns))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return spark.createDataFrame([], schema) if out is None else out


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union; columns missing on one side become null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def first_table(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """The first table or view of a preference list that exists."""
    for name in names:
        if spark.catalog.tableExists(name):
            return spark.table(name)
    raise LookupError(f"none of {list(names)} exists")


def newest_file(df: DataFrame, pattern: str | None = None) -> DataFrame:
    """Rows of the newest file of a scan, where file names sort by time.

    For reports that are folders, `pattern` has a group for the part of the
    path that carries the time.
    """
    name = F.regexp_extract("_metadata.file_path", pattern, 1) if pattern else F.col("_metadata.file_name")
    named = df.withColumn("__file", name)
    last = named.agg(F.max("__file").alias("__file"))
    # A one-row side.
    return named.join(F.broadcast(last), "__file", "left_semi").drop("__file")


def run_sql(spark: SparkSession, views: Mapping[str, DataFrame], text: str, cap: int | None = None) -> DataFrame:
    """Register views and run SQL text on them, with the row cap of the ad-hoc page if given."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    out = spark.sql(text)
    return out.limit(cap) if cap else out
