"""Data-quality reports: nulls, duplicates, health rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The limits of the health rules.
MAX_NULL_PCT = 50.0
MIN_ROWS = 2500
MIN_TARGET_PCT = 80.0
MAX_GRID = 25
MAX_AGE_SEASONS = 1


def _per_column(df: DataFrame, make, columns: Sequence[str] | None, out: str) -> DataFrame:
    """One aggregate pass, then one row per column."""
    names = list(columns or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("__rows"), *[make(c).alias(c) for c in names])
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias(out)) for c in names]
    return wide.select(F.inline(F.array(*entries)))


def null_percent(df: DataFrame, columns: Sequence[str] | None = None, above: float | None = None) -> DataFrame:
    """Null share per column in per cent, one digit; optionally only columns above a limit."""
    out = _per_column(df, lambda c: F.round(F.avg(F.col(c).isNull().cast("int")) * 100, 1), columns, "null_pct")
    return out.filter(F.col("null_pct") > above) if above is not None else out


def fill_rate(df: DataFrame, columns: Sequence[str] | None = None, below: float | None = None) -> DataFrame:
    """Non-null share per column in per cent, one digit; optionally only columns below a limit."""
    out = _per_column(df, lambda c: F.round(F.avg(F.col(c).isNotNull().cast("int")) * 100, 1), columns, "fill_pct")
    return out.filter(F.col("fill_pct") < below) if below is not None else out


def _totals(df: DataFrame, prefix: str) -> DataFrame:
    nulls = sum((F.sum(F.col(c).isNull().cast("int")) for c in df.columns[1:]), F.sum(F.col(df.columns[0]).isNull().cast("int")))
    return df.agg(F.count(F.lit(1)).alias(f"{prefix}rows"), F.coalesce(nulls, F.lit(0)).cast("long").alias(f"{prefix}nulls"))


def quality_report(table: str, before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows, columns, nulls before and after cleaning, and duplicates removed."""
    # Two one-row aggregates, joined on a constant.
    b = _totals(before, "b_").withColumn("k", F.lit(1))
    a = _totals(after, "a_").withColumn("k", F.lit(1))
    return b.join(a, "k").select(
        F.lit(table).alias("table_name"),
        F.col("a_rows").alias("rows"),
        F.lit(len(after.columns)).alias("columns"),
        F.col("b_nulls").alias("nulls_before"),
        F.col("a_nulls").alias("nulls_after"),
        (F.col("b_rows") - F.col("a_rows")).alias("duplicates_removed"),
    )


def profile(df: DataFrame, targets: Sequence[str], season: str = "season", grid: str = "grid") -> DataFrame:
    """Row count, latest season, grid range and target completeness in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.max(season).alias("latest_season"),
        F.min(grid).alias("grid_min"),
        F.max(grid).alias("grid_max"),
        *[F.round(F.avg(F.col(t).isNotNull().cast("int")) * 100, 1).alias(f"{t}_valid_pct") for t in targets],
    )


def health_rules(df: DataFrame, targets: Sequence[str], current_season: int, season: str = "season", grid: str = "grid") -> DataFrame:
    """All health rules from one aggregate pass: rule, observed value, limit, passed."""
    aggs: list[Column] = [
        F.count(F.lit(1)).cast("double").alias("rows"),
        F.max(season).cast("double").alias("latest"),
        F.max(grid).cast("double").alias("grid"),
        *[(F.avg(F.col(t).isNotNull().cast("int")) * 100).alias(f"t_{t}") for t in targets],
        *[F.round(F.avg(F.col(c).isNull().cast("int")) * 100, 1).alias(f"n_{c}") for c in df.columns],
    ]
    wide = df.agg(*aggs)

    def rule(name: str, observed: Column, limit: float, passed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("rule"), observed.cast("double").alias("observed"), F.lit(float(limit)).alias("threshold"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
        )

    oldest = current_season - MAX_AGE_SEASONS
    rules = [
        rule("row_count", F.col("rows"), MIN_ROWS, F.col("rows") >= MIN_ROWS),
        rule("latest_season", F.col("latest"), oldest, F.col("latest") >= oldest),
        rule("grid_max", F.col("grid"), MAX_GRID, F.col("grid") <= MAX_GRID),
        *[rule(f"{t}_coverage", F.col(f"t_{t}"), MIN_TARGET_PCT, F.col(f"t_{t}") >= MIN_TARGET_PCT) for t in targets],
        *[rule(f"{c}_nulls", F.col(f"n_{c}"), MAX_NULL_PCT, F.col(f"n_{c}") <= MAX_NULL_PCT) for c in df.columns],
    ]
    return wide.select(F.inline(F.array(*rules)))


def health_status(rules: DataFrame) -> DataFrame:
    """One row: status, number of issues, and the failed rules in name order."""
    failed = F.col("passed") == F.lit(False)
    # Rules are a fixed list, so the array is short.
    return rules.agg(
        F.count(F.when(failed, 1)).alias("issues_count"),
        F.concat_ws(",", F.sort_array(F.collect_list(F.when(failed, F.col("rule"))))).alias("issues"),
    ).select(
        F.when(F.col("issues_count") == 0, "HEALTHY").otherwise("ISSUES_FOUND").alias("status"), "issues_count", "issues"
    )


def accepted_features(correlations: DataFrame, strong: Sequence[str], strong_limit: float = 0.1, limit: float = 0.05) -> DataFrame:
    """Accept a feature when |r| passes its limit; a missing correlation is a rejection."""
    bar = F.when(F.col("feature").isin(list(strong)), F.lit(strong_limit)).otherwise(F.lit(limit))
    return correlations.select("*", F.coalesce(F.abs("correlation") > bar, F.lit(False)).alias("accepted"))
