"""Grouped operators: keyed dedup, joins, statistics as row attributes, quantiles, top-k."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapwise.operators.ordered import (
    HotGroups,
    hot_groups,
    null_safe_join,
    split_hot,
)
from lapwise.session import materialised


def dedup_latest(df: DataFrame, keys: Sequence[str], order_col: str | None = None) -> DataFrame:
    """Keep one row per key: the latest by `order_col`, ties settled by all other columns.

    A struct maximum combines map-side, so many copies of one key never meet
    in one task.
    """
    rest = [c for c in df.columns if c not in keys and c != order_col]
    fields = ([order_col] if order_col else []) + rest
    best = df.groupBy(*keys).agg(F.max(F.struct(*fields)).alias("__row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])


def _join(fact: DataFrame, dim: DataFrame, on: Sequence[str], how: str, null_safe: bool) -> DataFrame:
    if null_safe:
        return null_safe_join(fact, dim, on, how)
    extra = [c for c in dim.columns if c not in on]
    return fact.join(dim, list(on), how).select(*fact.columns, *extra)


def spread_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    hot: HotGroups | None = None,
    how: str = "left",
    null_safe: bool = False,
) -> DataFrame:
    """Join `dim` (unique on `on`) to `fact`, salting the fact keys that are too large for one task.

    Hot keys get one copy of their dimension row per slice; other keys get one.
    A check on coarser keys serves as proof that nothing is hot.
    """
    if hot is not None and not set(hot.by) <= set(on):
        raise ValueError(f"groups were checked on {list(hot.by)}, which {list(on)} does not refine")
    if hot is None or (not hot.none and set(hot.by) != set(on)):
        hot = hot_groups(fact, on)
    if hot.none:
        # No group dominates: a plain join, broadcast by Spark if the measured size allows.
        return _join(fact, dim, on, how, null_safe)
    if hot.everything:
        # Too many hot keys to list: every key gets as many slices as the largest needs.
        slices = -(-hot.largest // max(hot.limit, 1))
        rest = [c for c in fact.columns if c not in on]
        columns = fact.columns
        fact = fact.withColumn("__salt", (F.pmod(F.xxhash64(*rest), F.lit(slices)) if rest else F.lit(0)).cast("int"))
        dim = dim.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
        out = _join(fact, dim, [*on, "__salt"], how, null_safe)
        return out.select(*columns, *[c for c in out.columns if c not in columns and c != "__salt"])
    # At most MAX_LISTED_GROUPS keys, so this side is always small.
    keys = hot.keys(fact.sparkSession)
    slices = keys.select(*hot.by, F.ceil(F.col("__n") / hot.limit).cast("int").alias("__slices"))
    # The slice follows from the row itself, so a task that runs again makes the same choice.
    rest = [c for c in fact.columns if c not in on]
    fact_salt = F.pmod(F.xxhash64(*rest), F.coalesce("__slices", F.lit(1))) if rest else F.lit(0)
    columns = fact.columns
    fact = null_safe_join(fact, F.broadcast(slices), hot.by).withColumn("__salt", fact_salt.cast("int")).drop("__slices")
    copies = F.sequence(F.lit(0), F.coalesce("__slices", F.lit(1)) - 1)
    dim = null_safe_join(dim, F.broadcast(slices), hot.by).withColumn("__salt", F.explode(copies)).drop("__slices")
    out = _join(fact, dim, [*on, "__salt"], how, null_safe)
    return out.select(*columns, *[c for c in out.columns if c not in columns and c != "__salt"])


def left_enrich(
    df: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    defaults: Mapping[str, object] | None = None,
    hot: HotGroups | None = None,
) -> DataFrame:
    """Left-join the columns of `dim`; columns that `df` already has are replaced, so re-runs are safe."""
    clash = [c for c in dim.columns if c in df.columns and c not in on]
    out = spread_join(df.drop(*clash), dim, on, hot)
    return out.fillna(dict(defaults)) if defaults else out


def first_shared_key(left: DataFrame, right: DataFrame, candidates: Sequence[str]) -> str:
    """The first candidate column that both sides have."""
    for name in candidates:
        if name in left.columns and name in right.columns:
            return name
    raise ValueError(f"none of {list(candidates)} is in both tables")


def calendar_join(fact: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join a table with one row per race or season; Spark broadcasts it if its measured size allows."""
    return null_safe_join(fact, dim, on, how)


def group_stats(
    df: DataFrame,
    by: Sequence[str],
    outputs: Mapping[str, Column],
    hot: HotGroups | None = None,
    calendar: bool = False,
    source: DataFrame | None = None,
) -> DataFrame:
    """Attach unordered group aggregates to every row.

    Aggregate-and-join instead of an unordered window: the aggregation combines
    map-side and the rows are not shuffled when the result is small. With
    `calendar` the groups are races or seasons. `source` is a frame with the
    same rows but less lineage, from which the aggregates can be taken: a chain
    of such steps on `df` itself would double the plan each time.
    """
    stats = (df if source is None else source).groupBy(*by).agg(*[value.alias(out) for out, value in outputs.items()])
    return calendar_join(df, stats, by) if calendar else spread_join(df, stats, by, hot, null_safe=True)


# Rows of a bracket that one task may sort.
SORTED_ROWS = 100_000
# Cells a sketch cuts a bracket into.
CELLS = 64


def select_positions(df: DataFrame, by: Sequence[str], value: str, targets: DataFrame, hot: HotGroups) -> DataFrame:
    """(by, __k, __value): the `__k`-th smallest value of each group, for `targets` (by, __k), without sorting the groups.

    Every round sketches the values between a target's bounds (Spark's mergeable
    quantile summary), counts exactly how many lie below, at and between the
    sketched values, and moves the bounds to the two that enclose the target.
    A bracket shrinks to about a 64th in each round; one with few rows is
    sorted. A sketched value is a value of the table, so a target that meets
    one, as many ties do, is found at once. Values must not be null.
    """
    finish = min(SORTED_ROWS, hot.limit)
    bracket = [*by, "__lo", "__hi"]
    kind = df.schema[value].dataType
    # Bounds are open, and null where there is none. Both tables have a few rows for each hot group.
    open_ = targets.select(*by, "__k", *[F.lit(None).cast(kind).alias(c) for c in ("__lo", "__hi")], F.lit(0).cast("long").alias("__below"))
    open_ = materialised(open_, "targets")
    rows, done = df.select(*by, F.col(value).alias("__v")), []
    while True:
        brackets = open_.select(*bracket).distinct()
        if not hot.everything:
            # At most 10,000 listed groups, each with a few targets.
            brackets = F.broadcast(brackets)
        inside = null_safe_join(rows, brackets, by, "inner").filter(
            (F.col("__lo").isNull() | (F.col("__v") > F.col("__lo"))) & (F.col("__hi").isNull() | (F.col("__v") < F.col("__hi"))))
        # Brackets of a round are equal or disjoint, so the next round reads these rows only.
        inside = materialised(inside, "bracket")
        rows = inside.select(*by, "__v")
        grid = F.percentile_approx("__v", [i / CELLS for i in range(CELLS + 1)], F.lit(10_000))
        sketch = materialised(inside.groupBy(*bracket).agg(F.count(F.lit(1)).alias("__m"), F.array_distinct(grid).alias("__g")), "sketch")

        small = null_safe_join(inside, sketch.filter(F.col("__m") <= finish).select(*bracket), bracket, "left_semi")
        sorted_ = small.groupBy(*bracket).agg(F.sort_array(F.collect_list("__v")).alias("__all"))
        ended = null_safe_join(open_, sorted_, bracket, "inner")
        place = (F.col("__k") - F.col("__below")).cast("int")
        done.append(ended.select(*by, "__k", F.element_at("__all", place).alias("__value")))
        wide = sketch.filter(F.col("__m") > finish)
        if wide.isEmpty():
            break

        # Cell 2i - 1 holds the rows at the i-th sketched value, cell 2i those between it and the next.
        counted = null_safe_join(inside, wide, bracket, "inner")
        reached = F.size(F.filter("__g", lambda g: g <= F.col("__v")))
        tie = (reached > 0) & F.get("__g", reached - 1).eqNullSafe(F.col("__v"))
        cell = (2 * reached - tie.cast("int")).alias("__cell")
        cells = counted.groupBy(*bracket, cell).agg(F.count(F.lit(1)).alias("__c"))
        # At most 131 cells in a bracket.
        before = Window.partitionBy(*bracket).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
        cells = cells.withColumn("__ahead", F.coalesce(F.sum("__c").over(before), F.lit(0)))
        cells = null_safe_join(cells, wide, bracket, "inner")
        local = F.col("__k") - F.col("__below")
        hit = null_safe_join(open_, cells, bracket, "inner").filter(
            (local > F.col("__ahead")) & (local <= F.col("__ahead") + F.col("__c")))
        i = F.floor((F.col("__cell") + 1) / 2).cast("int")
        exact = F.col("__cell") % 2 == 1
        hit = materialised(hit.select(
            *by, "__k", F.when(exact, F.get("__g", i - 1)).alias("__value"), exact.alias("__exact"),
            F.coalesce(F.get("__g", i - 1), "__lo").alias("__lo"), F.coalesce(F.get("__g", i), "__hi").alias("__hi"),
            (F.col("__below") + F.col("__ahead")).alias("__below"),
        ), "targets")
        done.append(hit.filter("__exact").select(*by, "__k", "__value"))
        open_ = hit.filter("NOT __exact").select(*bracket[:-2], "__k", "__lo", "__hi", "__below")
        if open_.isEmpty():
            break
    return reduce(DataFrame.unionByName, done)


def quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    points: Mapping[str, float],
    hot: HotGroups | None = None,
) -> DataFrame:
    """Exact interpolated quantiles of `value` per group, one column per entry of `points`.

    Ordinary groups use the built-in function, hot ones `select_positions`.
    """
    df = df.select(*by, value).filter(F.col(value).isNotNull())
    hot = hot_groups(df, by) if hot is None else hot
    cold, big = split_hot(df, by, hot)
    parts = []
    if cold is not None:
        parts.append(cold.groupBy(*by).agg(*[F.percentile(value, F.lit(p)).alias(c) for c, p in points.items()]))
    if big is not None:
        sizes = big.groupBy(*by).agg(F.count(F.lit(1)).alias("__size"))
        at = {c: (F.col("__size") - 1) * F.lit(p) + 1 for c, p in points.items()}
        wanted = F.array_distinct(F.array(*[f(x) for x in at.values() for f in (F.floor, F.ceil)]))
        targets = sizes.select(*by, F.explode(wanted).alias("__k"))
        found = select_positions(big, by, value, targets, hot)
        found = found.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("__k", "__value"))).alias("__found"))
        placed = null_safe_join(sizes, found, by, "inner")
        picks = []
        for c, x in at.items():
            low, high = F.col("__found")[F.floor(x)].cast("double"), F.col("__found")[F.ceil(x)].cast("double")
            picks.append((low + (high - low) * (x - F.floor(x))).alias(c))
        parts.append(placed.select(*by, *picks))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def median(df: DataFrame, by: Sequence[str], value: str, name: str, hot: HotGroups | None = None) -> DataFrame:
    """Exact median of `value` per group."""
    return quantiles(df, by, value, {name: 0.5}, hot)


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, name: str = "place") -> DataFrame:
    """The first `k` rows per group. Spark limits each group before the shuffle."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)


def top_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first `n` rows of the whole table."""
    return df.orderBy(*order).limit(n)


def row_at_max(df: DataFrame, by: Sequence[str], score: Column, outputs: Sequence[str], tie: str) -> DataFrame:
    """The `outputs` of the row with the greatest score per group; the smaller `tie` wins, null scores never."""
    order = F.when(score.isNotNull(), F.struct((-score).alias("s"), F.col(tie).alias("t")))
    best = F.min_by(F.struct(*outputs), order)
    best = best.alias("__best")
    grouped = df.groupBy(*by).agg(best) if by else df.agg(best)
    return grouped.select(*by, "__best.*")


def latest_period(df: DataFrame, period: Sequence[str]) -> DataFrame:
    """Rows of the latest period, e.g. the last (season, round)."""
    last = df.agg(F.max(F.struct(*period)).alias("__last"))
    # A one-row aggregate, so the broadcast has a fixed size.
    return df.join(F.broadcast(last.select("__last.*")), list(period), "left_semi")


def prior_period(
    df: DataFrame, history: DataFrame, key: str, period: str, columns: Mapping[str, str], defaults: Mapping[str, object],
    hot: HotGroups | None = None,
) -> DataFrame:
    """Attach last period's values of `history` (one row per key and period) under new names."""
    shifted = history.select(
        key, (F.col(period) + 1).cast(history.schema[period].dataType).alias(period),
        *[F.col(old).alias(new) for old, new in columns.items()],
    )
    return left_enrich(df, shifted, [key, period], defaults, hot)
