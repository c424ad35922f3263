"""Helpers shared by the operators: word rules, stable uniform numbers, positions and kept rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lapwise.session import materialised

# A word is a run of characters other than space and U+0009 to U+000D.
SPACES = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ascii_lower(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def uniform(*parts: Column) -> Column:
    """A number inside (0, 1) that depends on the parts alone: 52 bits of their MD5."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    bits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")
    return (bits + F.lit(0.5)) / F.lit(float(2**52))


def global_positions(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """`df` with 0-based positions in the given order, from a range-partitioned sort.

    The sorted rows are written, which fixes the range boundaries. The table of
    offsets has one row per range partition, which bounds the broadcast.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = materialised(placed.withColumn("__id", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("__id", 33)
    counts = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return (
        placed.withColumn("__part", part)
        .join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__before") + F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("__id", "__part", "__before")
    )


def slices(batches: Iterator[pa.RecordBatch], column: int, limit: int = 32 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of `column` come to about `limit` bytes at most, or one row."""
    for batch in batches:
        start, size = 0, 0
        for i, n in enumerate(pa.compute.binary_length(batch.column(column)).to_pylist()):
            if size and size + (n or 0) > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n or 0
        if start < batch.num_rows:
            yield batch.slice(start)
