"""Metrics as DataFrames: regression, classification, rank within race, reports per race and driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwise.functions.scalars import ratio
from lapwise.operators.groups import calendar_join, row_at_max, top_k, top_rows
from lapwise.operators.ordered import HotGroups, with_rank
from lapwise.plans.reports import worst_groups

RACE = ("season", "round")

# Limits that trigger a retraining, and the error that still counts as close.
MAX_MAE = 4.0
MIN_F1 = 0.5
CLOSE = 2


def regression_metrics(scored: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE, R² and the share of predictions within two places."""
    pairs = scored.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    y, e = F.col(label).cast("double"), F.col(label).cast("double") - F.col(prediction)
    total = F.var_pop(y) * F.count(F.lit(1))
    return pairs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (1 - ratio(F.sum(e * e), total)).alias("r2"),
        F.avg((F.abs(e) <= CLOSE).cast("int")).alias("within_two"),
    )


def classification_metrics(scored: DataFrame, label: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Confusion matrix, accuracy, precision, recall and F1; empty denominators give 0."""
    y, p = F.col(label) == 1, F.col(predicted) == 1
    known = scored.filter(F.col(label).isNotNull() & F.col(predicted).isNotNull())
    out = known.groupBy(*by).agg(
        F.count(F.when(y & p, 1)).alias("tp"), F.count(F.when(~y & p, 1)).alias("fp"),
        F.count(F.when(y & ~p, 1)).alias("fn"), F.count(F.when(~y & ~p, 1)).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return out.select(
        "*",
        zero(ratio(tp + tn, tp + fp + fn + tn)).alias("accuracy"),
        zero(ratio(tp, tp + fp)).alias("precision"),
        zero(ratio(tp, tp + fn)).alias("recall"),
        zero(ratio(2 * tp, 2 * tp + fp + fn)).alias("f1"),
    )


def race_hits(scored: DataFrame, score: str, truth: str, tie: str, race: Sequence[str] = RACE, k: int = 3) -> DataFrame:
    """Per race: does the best-scored entrant win, and is the winner among the best `k`?"""
    best = top_k(scored, race, [F.col(score).desc_nulls_last(), F.col(tie)], k)
    return best.groupBy(*race).agg(
        F.max(F.when((F.col("place") == 1) & (F.col(truth) == 1), 1).otherwise(0)).alias("top1_hit"),
        F.max(F.when(F.col(truth) == 1, 1).otherwise(0)).alias("topk_hit"),
    )


def rank_metrics(scored: DataFrame, score: str, truth: str, tie: str, race: Sequence[str] = RACE, k: int = 3) -> DataFrame:
    """Hit rates over all races; a race without a winner counts as a miss."""
    hits = race_hits(scored, score, truth, tie, race, k)
    return hits.agg(
        F.count(F.lit(1)).alias("races"), F.avg("top1_hit").alias("top1_rate"), F.avg("topk_hit").alias("topk_rate")
    )


class WinnerHitRate(Evaluator):
    """Top-1 hit rate per race, for model selection."""

    @keyword_only
    def __init__(self, truth: str = "target_winner", tie: str = "driver_id"):
        super().__init__()
        self.truth, self.tie = truth, tie

    def _evaluate(self, dataset: DataFrame) -> float:
        scored = with_probability(dataset)
        row = rank_metrics(scored, "probability_1", self.truth, self.tie).first()
        return float(row["top1_rate"] or 0.0)

    def isLargerBetter(self) -> bool:
        return True


def with_probability(scored: DataFrame, name: str = "probability_1") -> DataFrame:
    """The probability of class 1 as a plain column."""
    return scored.withColumn(name, vector_to_array("probability")[1])


def race_report(scored: DataFrame, prediction: str, label: str, name: str) -> DataFrame:
    """Per race: predicted and actual winner, whether they agree, whether the winner was in the predicted top 3."""
    known = scored.filter(F.col(label).isNotNull())
    predicted = row_at_max(known, RACE, -F.col(prediction), [F.col(name).alias("predicted_winner")], name)
    actual = row_at_max(known, RACE, -F.col(label).cast("double"), [F.col(name).alias("actual_winner")], name)
    best = top_k(known, RACE, [F.col(prediction).asc_nulls_last(), F.col(name)], 3)
    # Three rows per race and one per race: calendar size.
    out = calendar_join(known.groupBy(*RACE).agg(F.count(F.lit(1)).alias("drivers")), predicted, RACE)
    out = calendar_join(out, actual, RACE)
    placed = calendar_join(best.select(*RACE, F.col(name).alias("__n")), actual, RACE)
    inside = placed.groupBy(*RACE).agg(F.bool_or(F.col("__n") == F.col("actual_winner")).alias("in_top3"))
    out = calendar_join(out, inside, RACE)
    return out.withColumn("correct", F.col("predicted_winner") == F.col("actual_winner"))


def driver_errors(scored: DataFrame, prediction: str, label: str, hot: HotGroups | None = None) -> DataFrame:
    """Predicted rank (mean rank of ties, truncated), actual place and error per entrant."""
    out = with_rank(scored, RACE, prediction, "predicted_rank", descending=False, method="average", hot=hot)
    return out.withColumn("error", F.col("predicted_rank") - F.col(label))


def prediction_list(scored: DataFrame, score: str, truth: str, name: str, races: int = 10) -> DataFrame:
    """The first races: three best-scored names with their score, the winner, and a hit mark."""
    first = top_rows(scored.select(*RACE).distinct(), [F.col(c) for c in RACE], races)
    # `races` rows.
    rows = scored.join(F.broadcast(first), list(RACE), "left_semi")
    best = top_k(rows, RACE, [F.col(score).desc_nulls_last(), F.col(name)], 3)
    # At most three rows per race.
    texts = best.groupBy(*RACE).agg(
        F.array_sort(F.collect_list(F.struct("place", F.col(name).cast("string").alias("n"), F.col(score).alias("s"), F.col(truth).alias("t")))).alias("p")
    )
    line = F.transform("p", lambda x: F.format_string("%s (%.1f%%)", x["n"], x["s"] * 100))
    winners = rows.filter(F.col(truth) == 1).groupBy(*RACE).agg(F.min(F.col(name).cast("string")).alias("winner"))
    out = calendar_join(texts, winners, RACE)
    return out.select(
        *RACE, F.concat_ws(", ", line).alias("predicted"), "winner",
        F.coalesce(F.get("p", F.lit(0))["t"] == 1, F.lit(False)).alias("hit"),
    )


def retrain_gate(mae: Column, f1: Column) -> Column:
    """True when the errors ask for a new training."""
    return F.coalesce(mae > MAX_MAE, F.lit(False)) | F.coalesce(f1 < MIN_F1, F.lit(False))


def evaluation_report(scored: DataFrame, position: str, podium: str, call: str, prediction: str, n: int = 3) -> DataFrame:
    """Model evaluation and failure analysis as one table (section, place, name, value).

    Errors of the position, F1 of the podium calls, the circuits and drivers
    with the largest mean error, and each reason to train again with the
    decision (1 or 0). Rows without the label of a part do not count there;
    without any, its values are null and its lists empty. `scored` is read by
    every part, so pass a stored table.
    """
    errors = regression_metrics(scored, position, prediction).select("mae", F.col("rows").alias("position_rows"))
    calls = classification_metrics(scored, podium, call).select(
        F.when(F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn") > 0, F.col("f1")).alias("f1"),
        (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("podium_rows"),
    )
    mae, f1 = F.col("mae"), F.col("f1")
    lines = [
        ("position", 1, "mae", mae), ("position", 2, "rows", F.col("position_rows")),
        ("podium", 1, "f1", f1), ("podium", 2, "rows", F.col("podium_rows")),
        ("retrain", 1, "mae_too_large", retrain_gate(mae, F.lit(None).cast("double"))),
        ("retrain", 2, "f1_too_small", retrain_gate(F.lit(None).cast("double"), f1)),
        ("retrain", 3, "retrain", retrain_gate(mae, f1)),
    ]
    line = [F.struct(F.lit(s).alias("section"), F.lit(i).alias("place"), F.lit(m).alias("name"), v.cast("double").alias("value"))
            for s, i, m, v in lines]
    # Both aggregates have one row.
    out = errors.withColumn("k", F.lit(1)).join(calls.withColumn("k", F.lit(1)), "k").select(F.explode(F.array(*line)).alias("l")).select("l.*")
    off = F.abs(F.col(position) - F.col(prediction))
    known = scored.filter(off.isNotNull()).withColumn("abs_error", off)
    for section, by in (("worst_circuits", "circuit_id"), ("worst_drivers", "driver_id")):
        worst = worst_groups(known, by, n).agg(F.array_sort(F.collect_list(F.struct((-F.col("mean_abs_error")).alias("e"), "name"))).alias("all"))
        worst = worst.select(F.posexplode("all").alias("at", "w"))
        out = out.unionByName(worst.select(
            F.lit(section).alias("section"), (F.col("at") + 1).alias("place"), F.col("w.name").alias("name"), (-F.col("w.e")).alias("value")))
    return out


def long_metrics(wide: DataFrame, task: str, model: str, tried: int, names: Sequence[str]) -> DataFrame:
    """One row per metric."""
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in names])
    return wide.select(
        F.lit(task).alias("task"), F.lit(model).alias("model"), F.lit(tried).alias("tried"), F.inline(rows)
    )
