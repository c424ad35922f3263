"""Ordered operators that stay correct and parallel when one group is huge.

A Spark window puts a whole group into one task. That is right while groups
are small, so every operator here first looks for groups with more rows than
`spark.lapwise.hotGroupRows`. Rows of ordinary groups use a plain window. Rows
of hot groups get an exact position from a range-partitioned sort and are then
cut into fixed-size blocks by that position:

* bounded frames read a few rows copied over from the block before,
* running aggregates add the totals of all earlier blocks.

Both give the same values as the plain window. A caller that can prove a
bound on its groups (for example one row per calendar period) passes
`hot=BOUNDED` and pays for no check.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapwise.session import materialised

HOT_ROWS_CONF = "spark.lapwise.hotGroupRows"
HOT_ROWS_DEFAULT = 2_000_000
# Above this many hot groups none of them dominates, and all rows take the hot way.
MAX_LISTED_GROUPS = 10_000
# Range partitions sort with spilling, so this bounds only the number of shuffle blocks.
MAX_RANGE_PARTS = 20_000

POS, BLOCK, HOME, N = "__pos", "__block", "__home", "__n"


@dataclass(frozen=True)
class HotGroups:
    """Which groups are too large for one task."""

    by: tuple[str, ...] = ()
    rows: tuple = ()
    schema: T.StructType | None = None
    everything: bool = False
    limit: int = HOT_ROWS_DEFAULT
    # Rows of all hot groups, listed or not, and of the largest one.
    total: int = field(default=0)
    largest: int = field(default=0)

    @property
    def none(self) -> bool:
        return not self.rows and not self.everything

    def keys(self, spark: SparkSession) -> DataFrame:
        """The hot keys and their row counts; at most MAX_LISTED_GROUPS rows."""
        return spark.createDataFrame(list(self.rows), self.schema)


BOUNDED = HotGroups()


def hot_row_limit(spark: SparkSession) -> int:
    return int(spark.conf.get(HOT_ROWS_CONF, str(HOT_ROWS_DEFAULT)))


def hot_groups(df: DataFrame, by: Sequence[str], size: Column | None = None, limit: int | None = None) -> HotGroups:
    """Find groups above the row limit: one partial aggregation over the key columns.

    `size` is another aggregate to compare with `limit`.
    """
    limit = hot_row_limit(df.sparkSession) if limit is None else limit
    size = F.count(F.lit(1)) if size is None else size
    sizes = df.groupBy(*by).agg(size.cast("long").alias(N)).filter(F.col(N) > limit)
    found = sizes.limit(MAX_LISTED_GROUPS + 1).collect()
    everything = len(found) > MAX_LISTED_GROUPS
    total, largest = sum(r[N] for r in found), max((r[N] for r in found), default=0)
    if everything:
        total, largest = sizes.agg(F.sum(N), F.max(N)).first()
    return HotGroups(
        by=tuple(by),
        rows=tuple(tuple(r) for r in found[:MAX_LISTED_GROUPS]),
        schema=sizes.schema,
        everything=everything,
        limit=limit,
        total=total,
        largest=largest,
    )


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join on `on`, treating null keys as equal, and keep the left key columns."""
    names = {c: f"__right_{c}" for c in on}
    right = right.withColumnsRenamed(names)
    match = reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[names[c]]) for c in on])
    return left.join(right, match, how).drop(*names.values())


def split_hot(df: DataFrame, by: Sequence[str], hot: HotGroups) -> tuple[DataFrame | None, DataFrame | None]:
    """(rows of ordinary groups, rows of hot groups); None stands for no rows."""
    if hot.none:
        return df, None
    if hot.everything:
        return None, df
    # `by` may be finer than the checked key: a hot coarse group covers its parts.
    on = list(hot.by)
    if not set(on) <= set(by):
        raise ValueError(f"groups were checked on {on}, which {list(by)} does not refine")
    keys = F.broadcast(hot.keys(df.sparkSession).select(*on))
    return null_safe_join(df, keys, on, "left_anti"), null_safe_join(df, keys, on, "left_semi")


def _either(cold: DataFrame | None, hot: DataFrame | None) -> DataFrame:
    parts = [p for p in (cold, hot) if p is not None]
    return reduce(DataFrame.unionByName, parts)


def _names(by: Sequence[str]) -> list[Column]:
    return [F.col(c) for c in by]


def _sort(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def _range_positions(df: DataFrame, by: Sequence[str], order: Sequence, name: str, hot: HotGroups) -> DataFrame:
    """Exact 1-based position in each group from one global range sort.

    The sorted rows are numbered per partition and written, which fixes the
    partition boundaries. What is left is a small table: where each group
    starts in each partition, and how many of its rows lie in earlier ones.
    """
    spark = df.sparkSession
    wanted = min(-(-hot.total // max(hot.limit, 1)), MAX_RANGE_PARTS)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted)
    keys = [*_names(by), *_sort(order)]
    placed = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    placed = materialised(placed.withColumn("__id", F.monotonically_increasing_id()), "ordered")
    # The upper bits of the id are the partition, the lower ones the row in it.
    placed = placed.withColumn("__part", F.shiftright("__id", 33))
    runs = placed.groupBy(*by, "__part").agg(F.count(F.lit(1)).alias(N), F.min("__id").alias("__first"))
    # One row per group and partition, so at most `parts` rows per group.
    earlier = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum(N).over(earlier), F.lit(0)) + 1 - F.col("__first")
    runs = runs.select(*by, "__part", shift.alias("__shift"))
    # Listed hot groups are few, so all runs together are about as many as the partitions.
    runs = runs if hot.everything else F.broadcast(runs)
    return (
        null_safe_join(placed, runs, [*by, "__part"])
        .withColumn(name, F.col("__id") + F.col("__shift"))
        .drop("__id", "__part", "__shift")
    )


def with_position(
    df: DataFrame, by: Sequence[str], order: Sequence[str | Column], name: str, hot: HotGroups | None = None
) -> DataFrame:
    """Add the exact 1-based position (long) of each row in its group. `order` must be total."""
    hot = hot_groups(df, by) if hot is None else hot
    cold, big = split_hot(df, by, hot)
    if cold is not None:
        w = Window.partitionBy(*by).orderBy(*_sort(order))
        cold = cold.withColumn(name, F.row_number().over(w).cast("long"))
    if big is not None:
        big = _range_positions(big, by, order, name, hot)
    return _either(cold, big)


def _positioned(df, by, order, hot, position):
    """Rows with POS, taken from a dense position column when there is one."""
    if position:
        return df.withColumn(POS, F.col(position).cast("long"))
    return _range_positions(df, by, order, POS, hot)


def _block_rows(hot: HotGroups, least: int) -> int:
    return max(hot.limit // 2, least, 2)


def rolling(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str | Column],
    outputs: Mapping[str, Callable[[WindowSpec], Column]],
    start: int,
    end: int = -1,
    hot: HotGroups | None = None,
    position: str | None = None,
) -> DataFrame:
    """Add columns over the bounded frame `rowsBetween(start, end)`, `start <= end <= 0`.

    Each output is a function of the framed window, e.g. `lambda w: F.avg("x").over(w)`.
    """
    hot = hot_groups(df, by) if hot is None else hot
    cold, big = split_hot(df, by, hot)

    def add(frame: DataFrame, w: WindowSpec) -> DataFrame:
        w = w.rowsBetween(start, end)
        return frame.select("*", *[make(w).alias(out) for out, make in outputs.items()])

    if cold is not None:
        cold = add(cold, Window.partitionBy(*by).orderBy(*_sort(order)))
    if big is not None:
        reach = -start
        size = _block_rows(hot, reach + 1)
        big = _positioned(big, by, order, hot, position)
        big = big.withColumn(HOME, F.floor((F.col(POS) - 1) / size))
        # The last `reach` rows of a block are also read by the next block.
        tail = F.pmod(F.col(POS) - 1, F.lit(size)) >= size - reach
        homes = F.when(tail, F.array(F.col(HOME), F.col(HOME) + 1)).otherwise(F.array(F.col(HOME)))
        big = big.withColumn(BLOCK, F.explode(homes))
        big = add(big, Window.partitionBy(*by, BLOCK).orderBy(POS))
        big = big.filter(F.col(BLOCK) == F.col(HOME)).drop(POS, HOME, BLOCK)
    return _either(cold, big)


_MERGE: dict[str, Callable[[Column, Column], Column]] = {
    "sum": lambda a, b: F.coalesce(a + b, a, b),
    "count": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)),
    "max": lambda a, b: F.greatest(a, b),
    "min": lambda a, b: F.least(a, b),
}
_AGG = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}


def expanding(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str | Column],
    outputs: Mapping[str, tuple[str, Column]],
    through_current: bool = False,
    hot: HotGroups | None = None,
    position: str | None = None,
) -> DataFrame:
    """Add running aggregates over all earlier rows of the group.

    `outputs` maps a name to ("sum" | "count" | "max" | "min" | "avg", value).
    The current row is excluded unless `through_current`. Without earlier rows
    counts are 0 and the others null.
    """
    hot = hot_groups(df, by) if hot is None else hot
    cold, big = split_hot(df, by, hot)
    end = 0 if through_current else -1
    steps: dict[str, tuple[str, Column]] = {}
    for out, (kind, value) in outputs.items():
        if kind == "avg":
            steps[f"{out}__sum"] = ("sum", value)
            steps[f"{out}__count"] = ("count", value)
        else:
            steps[out] = (kind, value)

    def finish(frame: DataFrame) -> DataFrame:
        keep = [c for c in df.columns]
        made = [
            F.expr(f"try_divide(`{out}__sum`, `{out}__count`)").alias(out) if kind == "avg" else F.col(out)
            for out, (kind, _) in outputs.items()
        ]
        return frame.select(*keep, *made)

    if cold is not None:
        w = Window.partitionBy(*by).orderBy(*_sort(order)).rowsBetween(Window.unboundedPreceding, end)
        cold = finish(cold.select("*", *[_AGG[k](v).over(w).alias(out) for out, (k, v) in steps.items()]))
    if big is not None:
        size = _block_rows(hot, 1)
        big = _positioned(big, by, order, hot, position)
        big = big.withColumn(BLOCK, F.floor((F.col(POS) - 1) / size))
        totals = big.groupBy(*by, BLOCK).agg(*[_AGG[k](v).alias(out) for out, (k, v) in steps.items()])
        # Block totals: group rows / block rows, which the block size keeps small.
        earlier = Window.partitionBy(*by).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
        fold = {"count": F.sum, "sum": F.sum, "max": F.max, "min": F.min}
        carry = totals.select(
            *by, BLOCK, *[fold[k](F.col(out)).over(earlier).alias(f"__c_{out}") for out, (k, _) in steps.items()]
        )
        w = Window.partitionBy(*by, BLOCK).orderBy(POS).rowsBetween(Window.unboundedPreceding, end)
        big = big.select("*", *[_AGG[k](v).over(w).alias(out) for out, (k, v) in steps.items()])
        big = null_safe_join(big, carry, [*by, BLOCK])
        for out, (kind, _) in steps.items():
            big = big.withColumn(out, _MERGE[kind](F.col(out), F.col(f"__c_{out}")))
        big = finish(big)
    return _either(cold, big)


def with_rank(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    name: str,
    descending: bool = True,
    method: str = "min",
    hot: HotGroups | None = None,
) -> DataFrame:
    """Competition rank (`method="min"`) or truncated mean rank of ties (`"average"`); nulls rank last."""
    hot = hot_groups(df, by) if hot is None else hot
    cold, big = split_hot(df, by, hot)
    by_value = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()

    def rank(first: Column, ties: Column) -> Column:
        if method == "min":
            return first.cast("long")
        return F.floor(first + (ties - 1) / 2).cast("long")

    if cold is not None:
        first = F.rank().over(Window.partitionBy(*by).orderBy(by_value))
        ties = F.count(F.lit(1)).over(Window.partitionBy(*by, value))
        cold = cold.withColumn(name, rank(first, ties))
    if big is not None:
        # Rank distinct values instead of rows; equal values are counted first.
        values = big.groupBy(*by, value).agg(F.count(F.lit(1)).alias(N))
        values = expanding(values, by, [by_value], {"__ahead": ("sum", F.col(N))})
        values = values.withColumn(name, rank(F.coalesce(F.col("__ahead"), F.lit(0)) + 1, F.col(N)))
        big = null_safe_join(big, values.select(*by, value, name), [*by, value])
    return _either(cold, big)
