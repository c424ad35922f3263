"""Run history: append, keep the recent runs, trends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEEP_RUNS = 20
TREND_RUNS = 5


def append_run(record: DataFrame, path: str) -> None:
    record.write.mode("append").parquet(path)


def recent(runs: DataFrame, n: int = KEEP_RUNS) -> DataFrame:
    """The last `n` runs by time."""
    return runs.orderBy(F.col("ts").desc(), F.col("run_id").desc()).limit(n)


def trend(runs: DataFrame, n: int = TREND_RUNS) -> DataFrame:
    """First against last error of the last `n` runs, feature counts, unhealthy runs, retrainings."""
    at = F.struct("ts", "run_id")
    known = F.when(F.col("model_mae").isNotNull(), at)
    out = recent(runs, n).agg(
        F.count(F.lit(1)).alias("runs"),
        F.min_by("model_mae", known).alias("first_mae"),
        F.max_by("model_mae", known).alias("last_mae"),
        F.count("model_mae").alias("maes"),
        F.coalesce(F.sum(F.size("features_accepted")), F.lit(0)).cast("long").alias("accepted"),
        F.coalesce(F.sum("features_proposed"), F.lit(0)).cast("long").alias("proposed"),
        F.count(F.when(~F.coalesce(F.col("health.status") == "HEALTHY", F.lit(False)), 1)).alias("unhealthy"),
        F.count(F.when(F.col("retrain_triggered"), 1)).alias("retrained"),
    )
    direction = (
        F.when(F.col("maes") < 2, F.lit(None))
        .when(F.col("last_mae") < F.col("first_mae"), "improving")
        .when(F.col("last_mae") > F.col("first_mae"), "degrading")
        .otherwise("stable")
    )
    return out.select("*", direction.alias("mae_trend")).drop("maes")


def recurring_circuits(runs: DataFrame, n: int = 3, window: int = TREND_RUNS) -> DataFrame:
    """The circuits that recent runs listed most often as weak."""
    named = recent(runs, window).select(F.explode("worst_circuits").alias("circuit"))
    return named.groupBy("circuit").agg(F.count(F.lit(1)).alias("times")).orderBy(F.col("times").desc(), "circuit").limit(n)


def display(runs: DataFrame) -> DataFrame:
    """The history as shown to readers."""
    return runs.select(
        F.col("run_date").cast("string").alias("date"),
        F.coalesce("health.status", F.lit("N/A")).alias("data_health"),
        "model_mae",
        F.greatest(F.size("features_accepted"), F.lit(0)).alias("features_found"),
        F.when(F.coalesce("retrain_triggered", F.lit(False)), "Yes").otherwise("No").alias("retrain"),
        F.coalesce(F.get("worst_circuits", F.lit(0)), F.lit("N/A")).alias("worst_circuit"),
    )


def step_log(steps: DataFrame) -> DataFrame:
    """Success rate per run: steps that ended ok or triggered a retraining, over all steps."""
    good = F.col("status").isin("ok", "triggered")
    return steps.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("steps"),
        F.count(F.when(good, 1)).alias("succeeded"),
        F.avg(good.cast("int")).alias("success_rate"),
    )


def compare_runs(metrics: DataFrame, old: str, new: str) -> DataFrame:
    """Metric values of two runs side by side."""
    a = metrics.filter(F.col("run_id") == old).select("task", "metric", F.col("value").alias("old_value"))
    b = metrics.filter(F.col("run_id") == new).select("task", "metric", F.col("value").alias("new_value"))
    return a.join(b, ["task", "metric"], "full").withColumn("change", F.col("new_value") - F.col("old_value"))


def best_model(metrics: DataFrame, higher_is_better: bool) -> DataFrame:
    """Per task the best model; among equals the first tried wins."""
    score = -F.col("value") if higher_is_better else F.col("value")
    order = F.struct(score.alias("s"), F.col("tried").alias("t"))
    return metrics.groupBy("task").agg(F.min_by("model", order).alias("model"), F.min_by("value", order).alias("value"))


def comparison_table(metrics: DataFrame, names: list[str]) -> DataFrame:
    """Task and model against metric."""
    return metrics.groupBy("task", "model").pivot("metric", names).agg(F.first("value"))


