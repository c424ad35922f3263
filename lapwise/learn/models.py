"""Tree ensembles: train, validate over time, search, compare, store and score."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapwise.functions.scalars import clip
from lapwise.learn.evaluate import RACE, race_hits, regression_metrics
from lapwise.learn.features import (
    MAX_LABELS,
    FeatureSet,
    coded,
    fit_preparation,
    label_codes,
    labelled,
    season_folds,
    shaped,
    time_split,
    wide_categoricals,
)
from lapwise.learn.trees import TreeModel, TreeSettings, binned, fit_ensembles
from lapwise.session import materialised

# Folds that are fitted at the same time.
FOLDS_AT_ONCE = 5

# Hyper-parameters of the compared models of the first task.
FOREST = TreeSettings(trees=200, depth=8, least_rows=10, boosted=False)
BOOSTED = TreeSettings(trees=300, depth=5, rate=0.05, row_share=0.8, least_rows=10)
SECOND_ORDER = TreeSettings(trees=300, depth=5, rate=0.05, row_share=0.8, column_share=0.8, least_weight=10, l2=1, newton=True)
# What the classifications of podium and winner change of these.
PODIUM = {
    "random_forest": replace(FOREST, logistic=True, root_columns=True),
    "gradient_boosting": replace(BOOSTED, depth=4, least_rows=15, logistic=True),
    "second_order_boosting": replace(SECOND_ORDER, depth=4, least_weight=15, logistic=True),
}
WINNER = {
    "random_forest": replace(PODIUM["random_forest"], least_rows=1),
    "gradient_boosting": replace(PODIUM["gradient_boosting"], trees=400, rate=0.03, least_rows=20),
    "second_order_boosting": replace(PODIUM["second_order_boosting"], trees=400, rate=0.03, least_weight=20),
}

# The eight searched settings (trees, depth, rate, row share, column share, least weight, least gain, l1).
SEARCH = (
    (300, 3, 0.03, 0.8, 0.8, 15, 0, 0),
    (400, 4, 0.03, 0.8, 0.8, 20, 0, 0),
    (500, 4, 0.02, 0.7, 0.7, 15, 0, 0),
    (500, 5, 0.02, 0.8, 0.9, 10, 0, 0),
    (600, 3, 0.02, 0.75, 0.8, 20, 0, 0),
    (400, 5, 0.03, 0.85, 0.85, 12, 0, 0),
    (500, 4, 0.025, 0.8, 0.8, 15, 0.1, 0),
    (600, 4, 0.02, 0.8, 0.85, 18, 0, 0.1),
)


def regressors() -> dict[str, TreeSettings]:
    return {"random_forest": FOREST, "gradient_boosting": BOOSTED, "second_order_boosting": SECOND_ORDER}


def classifiers(label: str) -> dict[str, TreeSettings]:
    """The settings of the winner task for its label, those of the podium task for others."""
    return dict(WINNER if label == "target_winner" else PODIUM)


@dataclass
class Trained:
    """Preparation and model, with the features they were fit on."""

    features: FeatureSet
    preparation: PipelineModel
    model: Model | TreeModel
    codes: dict[str, DataFrame] = field(default_factory=dict)

    def score(self, df: DataFrame, low: float | None = None, high: float | None = None) -> DataFrame:
        """Batch scoring; features that `df` lacks count as 0. Position predictions can be clipped."""
        return self._tidied(self.model.transform(self.prepared(df)), low, high)

    def prepared(self, df: DataFrame) -> DataFrame:
        """`df` with the feature vector."""
        return self.preparation.transform(coded(shaped(df, self.features), self.codes))

    def _tidied(self, out: DataFrame, low: float | None = None, high: float | None = None) -> DataFrame:
        out = out.drop("features", *[f"{c}__f" for c in self.features.inputs], *self.features.inputs[len(self.features.numeric):])
        # Give the categoricals their own type back.
        keys = [c for c in self.features.categorical if f"__key_{c}" in out.columns]
        out = out.drop(*keys).withColumnsRenamed({f"__key_{c}": c for c in keys})
        if low is not None and high is not None:
            out = out.withColumn("prediction", clip(F.col("prediction"), low, high))
        return out

    def importances(self) -> DataFrame:
        """Feature importances, highest first; one row per feature."""
        values = self.model.importances() if isinstance(self.model, TreeModel) else self.model.featureImportances.toArray()
        rows = [(name, float(v)) for name, v in zip(self.features.inputs, values)]
        spark = SparkSession.active()
        return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc(), "feature")

    def save(self, path: str) -> None:
        self.preparation.write().overwrite().save(f"{path}/preparation")
        own = isinstance(self.model, TreeModel)
        if own:
            self.model.save(f"{path}/model")
        else:
            PipelineModel([self.model]).write().overwrite().save(f"{path}/model")
        for column, table in self.codes.items():
            table.write.mode("overwrite").parquet(f"{path}/codes/{column}")
        note = json.dumps({"numeric": self.features.numeric, "categorical": self.features.categorical, "codes": list(self.codes), "own": own})
        SparkSession.active().createDataFrame([(note,)], "value string").write.mode("overwrite").text(f"{path}/features")

    @staticmethod
    def load(path: str) -> Trained:
        note = json.loads(SparkSession.active().read.text(f"{path}/features").first()[0])
        return Trained(
            FeatureSet(tuple(note["numeric"]), tuple(note["categorical"])),
            PipelineModel.load(f"{path}/preparation"),
            TreeModel.load(f"{path}/model") if note["own"] else PipelineModel.load(f"{path}/model").stages[0],
            {c: SparkSession.active().read.parquet(f"{path}/codes/{c}") for c in note["codes"]},
        )


def fit_all(
    train: DataFrame, features: FeatureSet, settings: Mapping[str, TreeSettings], label: str, max_labels: int = MAX_LABELS
) -> dict[str, Trained]:
    """Models of all settings on the labelled training rows: one preparation and one binned table, all grown side by side."""
    prepared, codes, rows = _preparation(train, features, label, max_labels)
    matrix = binned(prepared.transform(rows), label, len(features.inputs))
    models = fit_ensembles(matrix, list(settings.values()))
    return {name: Trained(features, prepared, model, codes) for name, model in zip(settings, models)}


def _preparation(
    train: DataFrame, features: FeatureSet, label: str, max_labels: int
) -> tuple[PipelineModel, dict[str, DataFrame], DataFrame]:
    rows = shaped(labelled(train, label), features)
    codes = {c: materialised(label_codes(rows, c), "codes") for c in wide_categoricals(rows, features, max_labels)}
    rows = coded(rows, codes)
    return fit_preparation(rows, features, codes), codes, rows


def fit(train: DataFrame, features: FeatureSet, estimator: Estimator | TreeSettings, label: str, max_labels: int = MAX_LABELS) -> Trained:
    """Fit preparation and model on the labelled training rows; the model may also be one of `pyspark.ml`."""
    if isinstance(estimator, TreeSettings):
        return fit_all(train, features, {"model": estimator}, label, max_labels)["model"]
    prepared, codes, rows = _preparation(train, features, label, max_labels)
    return Trained(features, prepared, estimator.fit(prepared.transform(rows)), codes)


def cross_validate(
    df: DataFrame, features: FeatureSet, estimator: Estimator | TreeSettings, label: str, folds: int = 5
) -> DataFrame:
    """MAE per expanding season fold; folds are fitted at the same time."""

    def one(part: tuple[DataFrame, DataFrame]) -> float:
        train, test = part
        scored = fit(train, features, estimator, label).score(labelled(test, label))
        return float(regression_metrics(scored, label, "prediction").first()["mae"])

    with ThreadPoolExecutor(FOLDS_AT_ONCE) as pool:
        errors = list(pool.map(inheritable_thread_target(df.sparkSession)(one), season_folds(df, folds)))
    return SparkSession.active().createDataFrame(list(enumerate(errors)), "fold int, mae double")


def search(
    df: DataFrame, features: FeatureSet, label: str, validation_season: int, settings: Sequence[tuple] = SEARCH
) -> tuple[Trained, DataFrame]:
    """Best setting by winner hit rate on a validation season that the training does not see, the first of equals."""
    train, rest = time_split(df, validation_season - 1)
    held_out = labelled(rest.filter(F.col("season") == validation_season), label)
    names = ("trees", "depth", "rate", "row_share", "column_share", "least_weight", "least_gain", "l1")
    tried = {str(k): replace(SECOND_ORDER, logistic=True, **dict(zip(names, values))) for k, values in enumerate(settings)}
    trained = list(fit_all(train, features, tried, label).values())
    rates = hit_rates(trained, held_out, label)
    rows = [(k, s.trees, s.depth, s.rate, rates.get(k, 0.0)) for k, s in enumerate(tried.values())]
    best = max(range(len(rows)), key=lambda k: (rates.get(k, 0.0), -k))
    table = SparkSession.active().createDataFrame(rows, "setting int, trees int, depth int, rate double, hit_rate double")
    return trained[best], table


def hit_rates(trained: Sequence[Trained], held_out: DataFrame, label: str, tie: str = "driver_id") -> dict[int, float]:
    """Share of races whose best-scored entrant wins, for each of several models of one preparation, in one pass."""
    models = held_out.sparkSession.sparkContext.broadcast([t.model for t in trained])

    @F.pandas_udf("array<double>")
    def scores(x: pd.Series) -> pd.Series:
        values = np.stack(x.to_numpy()) if len(x) else np.empty((0, 1))
        return pd.Series(list(np.stack([m.scores(values) for m in models.value], axis=1)) if len(x) else [])

    rows = trained[0].prepared(held_out).select(*RACE, tie, label, scores(vector_to_array("features")).alias("scores"))
    rows = rows.select(*RACE, tie, label, F.posexplode("scores").alias("setting", "score"))
    hits = race_hits(rows, "score", label, tie, ("setting", *RACE)).groupBy("setting").agg(F.avg("top1_hit").alias("rate"))
    return {r["setting"]: r["rate"] for r in hits.collect()}
