"""Leak-aware form features: every value describes the time before the row, unless named otherwise."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapwise.functions.scalars import flag, ratio
from lapwise.operators.groups import left_enrich
from lapwise.operators.ordered import (
    BOUNDED,
    POS,
    HotGroups,
    expanding,
    hot_groups,
    null_safe_join,
    rolling,
    with_position,
)



def rolling_mean(
    df: DataFrame, by: Sequence[str], order: Sequence[str], values: Mapping[str, Column], n: int = 5,
    hot: HotGroups | None = None,
) -> DataFrame:
    """Means over the previous `n` rows; all outputs share one window."""
    outputs = {out: (lambda w, v=v: F.avg(v).over(w)) for out, v in values.items()}
    return rolling(df, by, order, outputs, -n, -1, hot)


def rolling_spread(
    df: DataFrame, by: Sequence[str], order: Sequence[str], value: Column, name: str, n: int = 5,
    hot: HotGroups | None = None,
) -> DataFrame:
    """Sample deviation over the previous `n` rows; null with fewer than two values."""
    return rolling(df, by, order, {name: lambda w: F.stddev_samp(value).over(w)}, -n, -1, hot)


def team_form(
    df: DataFrame, team: str, order: Sequence[str], value: str, name: str, n: int = 10, mode: str = "race",
    tie: str | None = None, hot: HotGroups | None = None, source: DataFrame | None = None,
) -> DataFrame:
    """Mean `value` per entrant of a team; `source` may hold the same rows with less lineage.

    "race": over the team's previous `n` races, so nothing leaks within a race.
    "rows": over the previous `n` rows in (order, tie), where an earlier
    team-mate of the same race counts; kept for comparison only.
    """
    if mode == "rows":
        return rolling_mean(df, [team], [*order, tie], {name: F.col(value)}, n, hot)
    races = form_over_races(team_races(df if source is None else source, team, order, value), team, order, name, n)
    return left_enrich(df, races, [team, *order], hot=hot)


def team_races(df: DataFrame, team: str, order: Sequence[str], value: str) -> DataFrame:
    """(team, order, __sum, __count): the sum and number of values of each team's races."""
    return df.groupBy(team, *order).agg(F.sum(value).alias("__sum"), F.count(value).alias("__count"))


def form_over_races(races: DataFrame, team: str, order: Sequence[str], name: str, n: int = 10) -> DataFrame:
    """Mean per entrant over the previous `n` rows of `team_races`."""
    # One row per team and race, so the calendar bounds each team's group.
    races = rolling(
        races, [team], order,
        {
            name: lambda w: ratio(F.sum("__sum").over(w), F.sum("__count").over(w)),
        },
        -n, -1, BOUNDED,
    )
    return races.select(team, *order, name)


def streaks_before(
    df: DataFrame, by: Sequence[str], order: Sequence[str], flags: Mapping[str, str], hot: HotGroups | None = None
) -> DataFrame:
    """Length of the run of set flags that ends at the previous row.

    The run starts after the last row whose flag is not set, so a running
    maximum of positions gives its length.
    """
    hot = hot_groups(df, by) if hot is None else hot
    keep = df.columns
    df = with_position(df, by, order, POS, hot)
    last_break = {f"__b_{out}": ("max", F.when(flag(F.col(f) == 1) == 0, F.col(POS))) for out, f in flags.items()}
    df = expanding(df.withColumn("__at", F.col(POS)), by, order, last_break, hot=hot, position="__at")
    return df.select(
        *keep,
        *[(F.col("__at") - 1 - F.coalesce(f"__b_{out}", F.lit(0))).cast("long").alias(out) for out in flags],
    )


def _ewm_block(grow: float) -> int:
    """Rows per block: weights stay far from overflow in one, and a value a block away weighs less than a double can tell."""
    return max(2, int(200 / math.log(grow)))


def _ewm_sums(v: Column, weight: Column) -> tuple[Column, Column]:
    return F.sum(v * weight), F.sum(F.when(v.isNotNull(), weight))


def _ewm_end(v: Column, grow: float, block: int, sums: tuple[Column, Column], last: Column) -> Column:
    """(at, t, w) of a block as seen from its last value; null without one."""
    unit = F.pow(F.lit(grow), last)
    place = (F.col("__eb") * block + last).alias("at")
    return F.when(last.isNotNull(), F.struct(place, (sums[0] / unit).alias("t"), (sums[1] / unit).alias("w")))


def _ewm_add(own: Column, before: Column, grow: float) -> Column:
    """A block's end with that of the block with values before it."""
    aged = F.pow(F.lit(grow), before["at"] - own["at"])
    both = F.struct(
        own["at"].alias("at"), (own["t"] + F.coalesce(before["t"] * aged, F.lit(0.0))).alias("t"),
        (own["w"] + F.coalesce(before["w"] * aged, F.lit(0.0))).alias("w"),
    )
    return F.when(own.isNotNull(), both)


def ewm_before(
    df: DataFrame, by: Sequence[str], order: Sequence[str], values: Mapping[str, Column], span: int = 5,
    hot: HotGroups | None = None,
) -> DataFrame:
    """Exponentially weighted mean of earlier rows; a gap ages the weights but adds no value.

    Weights grow by 1/(1-alpha) per row, so rows are summed in blocks whose
    length follows from the span. Earlier rows enter through the last two
    blocks that hold a value: a value before those is more than a block away
    from the last one and weighs less than a double can tell. Without hot
    groups everything is a window over the group; with them, block ends are
    joined. A span of 1 is the last value.
    """
    hot = hot_groups(df, by) if hot is None else hot
    keep = df.columns
    if span <= 1:
        df = with_position(df, by, order, "__at", hot)
        last = {f"__l_{out}": ("max", F.when(v.isNotNull(), F.struct(F.col("__at"), v.cast("double").alias("v")))) for out, v in values.items()}
        df = expanding(df, by, order, last, hot=hot, position="__at")
        return df.select(*keep, *[F.col(f"__l_{out}")["v"].alias(out) for out in values])
    grow = (span + 1) / (span - 1)
    block = _ewm_block(grow)
    df = with_position(df, by, order, "__at", hot)
    df = df.withColumn("__eb", F.floor((F.col("__at") - 1) / block))
    offset = F.pmod(F.col("__at") - 1, F.lit(block)).cast("double")
    weight = F.pow(F.lit(grow), offset)

    # Every block holds at most `block` rows.
    whole = Window.partitionBy(*by, "__eb")
    w = whole.orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    local = []
    for out, v in values.items():
        top, bottom = _ewm_sums(v, weight)
        local += [top.over(w).alias(f"__t_{out}"), bottom.over(w).alias(f"__w_{out}")]
    rows = df.select("*", *local)
    last = {out: F.max(F.when(v.isNotNull(), offset)) for out, v in values.items()}
    if hot.none:
        # Only a block's last row carries its end, so the largest earlier one is that of the last block with values.
        ends = {
            out: _ewm_end(v, grow, block, tuple(c.over(whole) for c in _ewm_sums(v, weight)), last[out].over(whole))
            for out, v in values.items()
        }
        full = F.pmod(F.col("__at"), F.lit(block)) == 0
        earlier = Window.partitionBy(*by).orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.select("*", *[F.when(full, e).alias(f"__e_{out}") for out, e in ends.items()])
        rows = rows.select("*", *[F.max(f"__e_{out}").over(earlier).alias(f"__p_{out}") for out in values])
        for out in values:
            rows = rows.withColumn(f"__e_{out}", _ewm_add(F.col(f"__e_{out}"), F.col(f"__p_{out}"), grow))
        rows = rows.select("*", *[F.max(f"__e_{out}").over(earlier).alias(f"__c_{out}") for out in values])
    else:
        ends = [
            _ewm_end(v, grow, block, _ewm_sums(v, weight), last[out]).alias(f"__e_{out}") for out, v in values.items()
        ]
        blocks = df.groupBy(*by, "__eb").agg(*ends)
        blocks = expanding(blocks, by, ["__eb"], {f"__p_{out}": ("max", F.col(f"__e_{out}")) for out in values}, hot=hot)
        for out in values:
            blocks = blocks.withColumn(f"__e_{out}", _ewm_add(F.col(f"__e_{out}"), F.col(f"__p_{out}"), grow))
        blocks = expanding(blocks, by, ["__eb"], {f"__c_{out}": ("max", F.col(f"__e_{out}")) for out in values}, hot=hot)
        rows = null_safe_join(rows, blocks.select(*by, "__eb", *[f"__c_{out}" for out in values]), [*by, "__eb"])
    made = []
    for out in values:
        c = F.col(f"__c_{out}")
        # Rows between that value and this block; beyond a block's length only the mean itself matters.
        scale = F.pow(F.lit(grow), -F.least(F.col("__eb") * block - c["at"], F.lit(float(block))))
        top = F.coalesce(f"__t_{out}", F.lit(0.0)) + F.coalesce(c["t"] * scale, F.lit(0.0))
        bottom = F.coalesce(f"__w_{out}", F.lit(0.0)) + F.coalesce(c["w"] * scale, F.lit(0.0))
        made.append(ratio(top, bottom).alias(out))
    return rows.select(*keep, *made)


def rolling_slope(
    df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, name: str, n: int = 5, least: int = 2,
    hot: HotGroups | None = None,
) -> DataFrame:
    """Least-squares slope of `value` over the current and previous `n - 1` rows; null below `least` values.

    Row numbers are the x axis; inside a frame only their differences count.
    """
    hot = hot_groups(df, by) if hot is None else hot
    keep = df.columns
    df = with_position(df, by, order, "__at", hot)

    def slope(w):
        x = F.col("__at").cast("double")
        return F.when(F.count(value).over(w) >= least, F.regr_slope(F.col(value), x).over(w))

    df = rolling(df, by, order, {name: slope}, -(n - 1), 0, hot, position="__at")
    return df.select(*keep, name)


def second_difference(
    df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, name: str, hot: HotGroups | None = None
) -> DataFrame:
    """x(t) - 2 x(t-1) + x(t-2) within the group; null without two earlier rows."""
    def difference(w):
        back = lambda n: F.first(value).over(w.rowsBetween(-n, -n))
        return F.col(value) - 2 * back(1) + back(2)

    return rolling(df, by, order, {name: difference}, -2, 0, hot)


def running_islands(
    df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, island: str, age: str,
    hot: HotGroups | None = None, position: str | None = None,
) -> DataFrame:
    """Number the runs of equal `value` (nulls equal each other) and the rows inside each run, from 1."""
    hot = hot_groups(df, by) if hot is None else hot
    keep = df.columns
    if position:
        df = df.withColumn("__at", F.col(position).cast("long"))
    else:
        df = with_position(df, by, order, "__at", hot)
    previous = lambda w: F.first(value).over(w)
    df = rolling(df, by, order, {"__prev": previous}, -1, -1, hot, position="__at")
    starts = (F.col("__at") == 1) | ~F.col("__prev").eqNullSafe(F.col(value))
    df = df.withColumn("__start", starts)
    df = expanding(
        df, by, order,
        {"__island": ("sum", F.col("__start").cast("int")), "__from": ("max", F.when(F.col("__start"), F.col("__at")))},
        through_current=True, hot=hot, position="__at",
    )
    return df.select(
        *keep,
        F.col("__island").cast("long").alias(island),
        (F.col("__at") - F.col("__from") + 1).cast("long").alias(age),
    )
