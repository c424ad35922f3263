"""Per-group least squares and correlation, as plain aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwise.functions.scalars import finite, ratio


def stint_slope(df: DataFrame, by: Sequence[str], x: str, y: str, slope: str, fit: str, least: int = 3) -> DataFrame:
    """OLS slope and R² of `y` on `x` per group.

    Needs `least` finite pairs and a varying `x`, else null; a constant `y` fits nothing, so R² is 0.
    """
    fx, fy = finite(F.col(x).cast("double")), finite(F.col(y).cast("double"))
    pair = fx.isNotNull() & fy.isNotNull()
    sums = df.select(*by, F.when(pair, fx).alias("__x"), F.when(pair, fy).alias("__y")).groupBy(*by).agg(
        F.count("__x").alias("__n"),
        F.var_pop("__x").alias("__vx"),
        F.var_pop("__y").alias("__vy"),
        F.regr_slope("__y", "__x").alias("__slope"),
        F.regr_r2("__y", "__x").alias("__r2"),
    )
    usable = (F.col("__n") >= least) & (F.col("__vx") > 0)
    return sums.select(
        *by,
        F.when(usable & (F.col("__vy") == 0), F.lit(0.0)).when(usable, F.col("__slope")).alias(slope),
        F.when(usable & (F.col("__vy") == 0), F.lit(0.0)).when(usable, F.col("__r2")).alias(fit),
    )


def correlations(df: DataFrame, candidates: Mapping[str, str], target: str, least: int = 100) -> DataFrame:
    """Pearson correlation of each candidate with the target over rows where both are present.

    One pass over the data; one output row per candidate. Below `least` rows the correlation is null.
    """
    y = F.col(target).cast("double")
    aggs: list[Column] = []
    for name, column in candidates.items():
        x = finite(F.col(column).cast("double"))
        both = x.isNotNull() & y.isNotNull()
        x, y_ = F.when(both, x), F.when(both, y)
        aggs += [
            F.count(x).alias(f"n_{name}"),
            # A constant side has no correlation; the built-in fails on it.
            ratio(F.covar_pop(x, y_), F.stddev_pop(x) * F.stddev_pop(y_)).alias(f"r_{name}"),
        ]
    wide = df.agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("feature"),
                F.col(f"n_{name}").alias("pairs"),
                F.when(F.col(f"n_{name}") > least, finite(F.col(f"r_{name}"))).alias("correlation"),
            )
            for name in candidates
        ]
    )
    return wide.select(F.inline(rows))
