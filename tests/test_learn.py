"""Preparation on training rows only, wide labels, evaluation, storage."""

import pytest
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F
from table_rows import rows_of

from lapwise.learn import evaluate, models
from lapwise.learn.features import FeatureSet, choose_features, fit_preparation, fraction_split, label_codes, season_folds, shaped
from lapwise.session import shared_dir

FEATURES = FeatureSet(("a", "b"), ("driver_id",))


@pytest.fixture(scope="module")
def table(spark):
    d = spark.range(240).select(
        (2020 + F.col("id") % 4).cast("int").alias("season"), (F.col("id") % 5).cast("int").alias("round"),
        F.concat(F.lit("d"), (F.col("id") % 12).cast("string")).alias("driver_id"),
        F.when(F.col("id") % 7 == 0, float("nan")).otherwise(F.col("id") % 12).cast("double").alias("a"),
        F.when(F.col("id") % 5 == 0, float("inf")).otherwise(F.col("id") % 3).cast("double").alias("b"),
        (F.col("id") % 12 + 1).cast("int").alias("target_position"))
    return d.withColumn("target_winner", (F.col("target_position") == 1).cast("int"))


def test_features_exclude_targets_and_in_race(spark):
    d = spark.createDataFrame([(1, 1, 1.0, 2.0, "x", 1)], "grid int, position int, pace_vs_field double, form double, driver_id string, target_winner int")
    assert choose_features(d) == FeatureSet(("grid", "form"), ("driver_id",))
    assert "pace_vs_field" in choose_features(d, include_in_race=True).numeric


def test_median_and_codes_come_from_training_rows(spark):
    train = spark.createDataFrame([(1.0, 1.0, "b"), (3.0, None, "a"), (None, 3.0, "b")], "a double, b double, driver_id string")
    test = spark.createDataFrame([(None, 900.0, "zz"), (float("inf"), None, "a")], "a double, b double, driver_id string")
    fitted = fit_preparation(shaped(train, FEATURES), FEATURES)
    got = [list(r["features"].toArray()) for r in fitted.transform(shaped(test, FEATURES)).collect()]
    # Exact medians 2 and 2 (the mean of the middle two), codes a=0, b=1, unknown=2.
    assert got == [[2.0, 900.0, 2.0], [2.0, 2.0, 0.0]]


def test_label_codes(spark):
    d = spark.createDataFrame([("b",), ("a",), ("b",), ("c",)], "x string")
    assert rows_of(label_codes(d, "x")) == [(0, "a"), (1, "b"), (2, "c")]


def test_tables_of_codes_score_like_the_indexer(spark, table):
    train, test = table.filter("season < 2023 AND driver_id <> 'd3'"), table.filter("season = 2023")
    forest = RandomForestRegressor(labelCol="target_position", featuresCol="features", numTrees=3, maxDepth=3, seed=1)
    narrow = models.fit(train, FEATURES, forest, "target_position")
    wide = models.fit(train, FEATURES, forest, "target_position", max_labels=1)
    assert wide.codes and not narrow.codes
    a, b = narrow.score(test, 1, 20), wide.score(test, 1, 20)
    assert a.columns == b.columns and a.schema["driver_id"].dataType.simpleString() == "string"
    assert sorted(r["driver_id"] for r in a.collect()) == sorted(r["driver_id"] for r in b.collect())
    folder = shared_dir(spark, "model")
    wide.save(folder)
    again = models.Trained.load(folder).score(test, 1, 20)
    assert rows_of(again.select("season", "round", "driver_id", "prediction")) == rows_of(b.select("season", "round", "driver_id", "prediction"))


def test_columns_of_the_race_itself_are_no_features(spark):
    names = ["grid", "had_slow_stop", "total_pit_time", "avg_pit_duration", "soft_deg_slope", "medium_deg_slope", "hard_deg_slope", "pace_vs_field"]
    from lapwise.plans import gold

    d = spark.createDataFrame([tuple(1.0 for _ in names)], ", ".join(f"{n} double" for n in names))
    assert choose_features(d.drop(*gold.LEAKY)).numeric == ("grid",)
    assert {"had_slow_stop", "total_pit_time", "avg_pit_duration"} <= set(gold.LEAKY)


def test_absent_features_count_as_zero(table):
    forest = RandomForestRegressor(labelCol="target_position", featuresCol="features", numTrees=2, maxDepth=2, seed=1)
    trained = models.fit(table, FEATURES, forest, "target_position")
    a = trained.score(table.drop("b"))
    b = trained.score(table.withColumn("b", F.lit(0.0)))
    assert rows_of(a.select("driver_id", "prediction")) == rows_of(b.select("driver_id", "prediction"))


def test_importances_cover_all_features(table):
    forest = RandomForestRegressor(labelCol="target_position", featuresCol="features", numTrees=2, maxDepth=3, seed=1)
    rows = models.fit(table, FEATURES, forest, "target_position").importances().collect()
    assert {r["feature"] for r in rows} == {"a", "b", "driver_id_enc"}
    assert rows[0]["importance"] == max(r["importance"] for r in rows)


def test_folds_expand_over_seasons(table):
    sizes = [(a.count(), b.count()) for a, b in season_folds(table)]
    assert sizes == [(60, 60), (120, 60), (180, 60)]


def test_row_share(spark):
    a, b = fraction_split(spark.range(10).toDF("t"), ["t"])
    assert rows_of(a) == [(i,) for i in range(8)] and rows_of(b) == [(8,), (9,)]


def test_classification_without_positive_calls(spark):
    d = spark.createDataFrame([(1, 0), (0, 0)], "y int, p int")
    r = evaluate.classification_metrics(d, "y", "p").first()
    assert (r["precision"], r["recall"], r["f1"], r["accuracy"]) == (0.0, 0.0, 0.0, 0.5)


def test_race_without_winner_counts_as_miss(spark):
    d = spark.createDataFrame([(1, 1, "a", 0.9, 1), (1, 1, "b", 0.1, 0), (1, 2, "a", 0.9, 0), (1, 2, "b", 0.1, 0)],
                              "season int, round int, driver_id string, s double, w int")
    r = evaluate.rank_metrics(d, "s", "w", "driver_id").first()
    assert (r["races"], r["top1_rate"], r["topk_rate"]) == (2, 0.5, 0.5)


def test_gate(spark):
    d = spark.createDataFrame([(4.1, 0.9), (3.0, 0.4), (3.0, 0.9), (None, None)], "m double, f double")
    assert [r[0] for r in d.select(evaluate.retrain_gate(F.col("m"), F.col("f"))).collect()] == [True, True, False, False]


def test_search_uses_the_validation_season(table):
    settings = [(5, 2, 0.3, 1.0, 1.0, 1, 0, 0), (8, 3, 0.3, 0.8, 0.8, 1, 0.1, 0.1)]
    best, rates = models.search(table, FEATURES, "target_winner", 2022, settings=settings)
    assert [r["trees"] for r in rates.orderBy("setting").collect()] == [5, 8]
    found = {r["setting"]: r["hit_rate"] for r in rates.collect()}
    assert all(0.0 <= r <= 1.0 for r in found.values())
    held_out = table.filter("season = 2022")
    # The shared pass gives the rate of the model alone.
    assert evaluate.WinnerHitRate(truth="target_winner").evaluate(best.score(held_out)) == max(found.values())


def test_cross_validation(table):
    forest = RandomForestRegressor(labelCol="target_position", featuresCol="features", numTrees=2, maxDepth=3, seed=1)
    assert models.cross_validate(table, FEATURES, forest, "target_position", 2).count() == 2


def test_registered_queries_train_in_full(spark, table, monkeypatch):
    from lapwise.learn import trees
    from lapwise.queries import learn_queries as queries

    grown = []
    fit_ensembles = models.fit_ensembles

    def noted(matrix, settings):
        grown.append([s.trees for s in settings])
        return fit_ensembles(matrix, [trees.replace(s, trees=1) for s in settings])

    monkeypatch.setattr(queries, "training_table", lambda spark, sf_dir: table)
    monkeypatch.setattr(queries, "LAST_TRAIN", 2022)
    monkeypatch.setattr(models, "fit_ensembles", noted)
    for query in (queries.compare_position_models, queries.compare_winner_models):
        assert query(spark, "").count() == 3
    assert queries.searched_settings(spark, "").count() == 8
    assert grown == [[200, 300, 300], [200, 400, 400], [300, 400, 500, 500, 600, 400, 500, 600]]
