"""Feature selection, encoding, imputation and time splits for `pyspark.ml`."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwise.functions.scalars import finite, numeric_columns
from lapwise.operators.groups import left_enrich, quantiles
from lapwise.operators.ordered import HotGroups, with_position
from lapwise.plans.gold import IN_RACE, TARGETS

# The categorical columns.
CATEGORICAL = ("driver_id", "driver_code", "driver_name", "constructor_id", "constructor_name", "circuit_id", "circuit_name",
               "race_name")
SUFFIX = "_enc"

# An indexer keeps its labels on the driver; columns with more labels are coded through a table.
MAX_LABELS = 100_000


@dataclass(frozen=True)
class FeatureSet:
    """Which columns a model reads; stored with the model so that scoring cannot drift."""

    numeric: tuple[str, ...]
    categorical: tuple[str, ...] = ()

    @property
    def inputs(self) -> list[str]:
        return [*self.numeric, *[f"{c}{SUFFIX}" for c in self.categorical]]


def choose_features(df: DataFrame, include_in_race: bool = False, exclude: Iterable[str] = ()) -> FeatureSet:
    """Numeric columns known before the race, plus the categoricals that are present."""
    skip = {*CATEGORICAL, *TARGETS, "position", *exclude}
    if not include_in_race:
        skip |= set(IN_RACE)
    return FeatureSet(tuple(numeric_columns(df, skip)), tuple(c for c in CATEGORICAL if c in df.columns))


def shaped(df: DataFrame, features: FeatureSet) -> DataFrame:
    """Doubles for the numeric features (infinite or NaN is null, absent is 0) and texts for the categoricals."""
    have = set(df.columns)
    made = {c: (finite(F.col(c).cast("double")) if c in have else F.lit(0.0)).alias(c) for c in features.numeric}
    made |= {c: F.coalesce(F.col(c).cast("string") if c in have else F.lit(None).cast("string"), F.lit("")).alias(c)
             for c in features.categorical}
    keep = [c for c in df.columns if c not in made]
    return df.select(*keep, *[F.col(c).alias(f"__key_{c}") for c in features.categorical if c in have], *made.values())


def wide_categoricals(df: DataFrame, features: FeatureSet, limit: int = MAX_LABELS) -> list[str]:
    """Categoricals with too many labels for the driver."""
    if not features.categorical:
        return []
    counts = df.agg(*[F.approx_count_distinct(c).alias(c) for c in features.categorical]).first()
    return [c for c in features.categorical if counts[c] > limit]


def coded(df: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Join label codes; unknown labels share the code after the last one."""
    for column, table in tables.items():
        code = f"{column}{SUFFIX}"
        df = left_enrich(df, table.withColumnRenamed("code", code), [column])
        df = df.withColumn(code, F.coalesce(F.col(code), F.lit(table.count())).cast("double"))
    return df


def medians(rows: DataFrame, features: FeatureSet) -> DataFrame:
    """(feature, median): exact medians of the known, finite values of the numeric features; features without any are absent."""
    entries = [F.struct(F.lit(c).alias("feature"), finite(F.col(c).cast("double")).alias("value")) for c in features.numeric]
    return quantiles(rows.select(F.inline(F.array(*entries))), ["feature"], "value", {"median": 0.5})


def fit_preparation(rows: DataFrame, features: FeatureSet, in_tables: Iterable[str] = ()) -> PipelineModel:
    """Alphabetic codes, median imputation and the feature vector, fit on the (training) rows only.

    A feature without any value is filled with 0.
    """
    narrow = [c for c in features.categorical if c not in set(in_tables)]
    stages = [
        StringIndexer(inputCols=narrow, outputCols=[f"{c}{SUFFIX}" for c in narrow],
                      stringOrderType="alphabetAsc", handleInvalid="keep")
    ] if narrow else []
    if features.numeric:
        # One row per feature.
        known = {r["feature"]: r["median"] for r in medians(rows, features).collect()}
        filled = ", ".join(f"coalesce(nanvl(`{c}`, NULL), {known.get(c, 0.0)!r}D) AS `{c}__f`" for c in features.numeric)
        stages.append(SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"))
    # Trees read the codes as ordered numbers; adding 0.0 drops the indexer's category metadata.
    if features.categorical:
        plain = ", ".join(f"`{c}{SUFFIX}` + 0.0D AS `{c}{SUFFIX}__f`" for c in features.categorical)
        stages.append(SQLTransformer(statement=f"SELECT *, {plain} FROM __THIS__"))
    inputs = [f"{c}__f" for c in features.inputs]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"))
    return Pipeline(stages=stages).fit(rows)


# The whole table is one group: always numbered by a range sort, never by one task.
ONE_HOT_GROUP = HotGroups(everything=True)


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """Alphabetic code per distinct text value, as a table; a range sort numbers any number of values."""
    values = df.select(F.col(column).cast("string").alias(column)).distinct().withColumn("__all", F.lit(0))
    out = with_position(values, ["__all"], [column], "code", ONE_HOT_GROUP)
    return out.select(column, (F.col("code") - 1).alias("code"))


def labelled(df: DataFrame, label: str) -> DataFrame:
    """Rows whose target is known."""
    return df.filter(F.col(label).isNotNull()).withColumn(label, F.col(label).cast("double"))


def time_split(df: DataFrame, last_train: int, season: str = "season") -> tuple[DataFrame, DataFrame]:
    """Train up to a season, test after it."""
    return df.filter(F.col(season) <= last_train), df.filter(F.col(season) > last_train)


def fraction_split(df: DataFrame, order: Sequence[str], share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """The first `share` of rows in `order` for training, for data without seasons."""
    placed = with_position(df.withColumn("__all", F.lit(0)), ["__all"], order, "__at", ONE_HOT_GROUP)
    total = placed.agg(F.max("__at")).first()[0] or 0
    cut = int(total * share)
    drop = ("__all", "__at")
    return placed.filter(F.col("__at") <= cut).drop(*drop), placed.filter(F.col("__at") > cut).drop(*drop)


def season_folds(df: DataFrame, folds: int = 5, season: str = "season") -> list[tuple[DataFrame, DataFrame]]:
    """Expanding folds: train on all seasons before the validation season."""
    # One row per season.
    seasons = sorted(r[0] for r in df.select(season).distinct().collect())
    held_out = seasons[1:][-folds:]
    return [(df.filter(F.col(season) < s), df.filter(F.col(season) == s)) for s in held_out]

