"""Training, validation, search and scoring on the gold table of the contest, all with the full settings of `lapwise.learn.models`."""

from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from lapwise import bindings as B
from lapwise.functions.scalars import rounded
from lapwise.learn import evaluate, models
from lapwise.learn.features import FeatureSet, choose_features, fraction_split, label_codes, labelled, medians, season_folds, time_split
from lapwise.learn.trees import TreeModel, TreeSettings
from lapwise.plans import gold, history
from lapwise.queries.form_queries import GOLD_SQL, TEAM_SQL
from lapwise.queries.registry import query
from lapwise.session import materialised, shared_dir
from lapwise.sources.scan import union_by_name

LAST_TRAIN = 202403
# Features whose medians are checked.
MEDIANS = ("grid", "rolling_avg_position_5", "rolling_avg_points_5", "rolling_dnf_rate_5", "rolling_positions_gained_5",
           "constructor_rolling_points", "rolling_consistency", "quali_gap_to_pole", "quali_gap_pct", "best_quali_seconds",
           "circuit_avg_position", "circuit_races_count", "season_cumulative_points")
EXCLUDE = ("season", "round", "target_position")


def training_table(spark, sf_dir):
    """The gold table, written once so that iterative training does not rebuild it."""
    df = gold.race_features(B.contest(spark, sf_dir), B.races_of(spark, sf_dir))
    return materialised(df.drop("first_ts", "race_date"), "training")


def _features(df):
    return choose_features(df, exclude=EXCLUDE)


@query(
    "label_codes",
    """SELECT o_orderpriority, dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS code
FROM (SELECT DISTINCT o_orderpriority FROM orders)""",
)
def priority_codes(spark, sf_dir):
    return label_codes(B.table(spark, sf_dir, "orders"), "o_orderpriority")


@query(
    "customer_label_codes",
    """SELECT CAST(o_custkey AS VARCHAR) AS o_custkey, row_number() OVER (ORDER BY CAST(o_custkey AS VARCHAR)) - 1 AS code
FROM (SELECT DISTINCT o_custkey FROM orders)""",
)
def customer_codes(spark, sf_dir):
    return label_codes(B.table(spark, sf_dir, "orders"), "o_custkey")


@query(
    "season_split",
    "WITH " + B.CONTEST_SQL + f"""
SELECT CASE WHEN season <= {LAST_TRAIN} THEN 'train' ELSE 'test' END AS part, count(*) AS rows, min(season) AS first_season,
       max(season) AS last_season FROM contest WHERE position IS NOT NULL GROUP BY 1""",
)
def season_split(spark, sf_dir):
    df = labelled(gold.targets(B.contest(spark, sf_dir)), "target_position")
    train, test = time_split(df, LAST_TRAIN)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part").agg(
        F.count(F.lit(1)).alias("rows"), F.min("season").alias("first_season"), F.max("season").alias("last_season"))


@query(
    "row_share_split",
    """
SELECT part, count(*) AS rows, min(event_id) AS first_id, max(event_id) AS last_id FROM (
  SELECT event_id, CASE WHEN row_number() OVER (ORDER BY ts, event_id) <= floor(0.8 * (SELECT count(*) FROM events))
                        THEN 'train' ELSE 'test' END AS part FROM events) GROUP BY part""",
)
def row_share_split(spark, sf_dir):
    train, test = fraction_split(B.table(spark, sf_dir, "events").select("event_id", "ts"), ["ts", "event_id"])
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part").agg(
        F.count(F.lit(1)).alias("rows"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


@query(
    "season_folds",
    "WITH " + B.DAILY_SQL + """
, s AS (SELECT DISTINCT season FROM daily),
f AS (SELECT season, row_number() OVER (ORDER BY season) - 1 AS fold FROM s WHERE season > (SELECT min(season) FROM s)),
last AS (SELECT * FROM f ORDER BY season DESC LIMIT 5)
SELECT CAST(fold - 1 AS INTEGER) - (SELECT CAST(min(fold) AS INTEGER) - 1 FROM last) AS fold,
       (SELECT count(*) FROM daily d WHERE d.season < last.season) AS train_rows,
       (SELECT count(*) FROM daily d WHERE d.season = last.season) AS test_rows FROM last""",
)
def fold_sizes(spark, sf_dir):
    out = []
    for number, (train, test) in enumerate(season_folds(B.daily(spark, sf_dir).select("season"))):
        both = train.withColumn("test", F.lit(0)).unionByName(test.withColumn("test", F.lit(1)))
        out.append(both.agg(F.count(F.when(F.col("test") == 0, 1)).alias("train_rows"),
                            F.count(F.when(F.col("test") == 1, 1)).alias("test_rows")).withColumn("fold", F.lit(number)))
    return union_by_name(out)


@query("numeric_feature_columns", "WITH " + B.CONTEST_SQL + "," + TEAM_SQL + "," + GOLD_SQL + """
SELECT column_name AS feature FROM (SELECT count(grid) AS grid, count(rolling_avg_position_5) AS rolling_avg_position_5,
  count(rolling_avg_points_5) AS rolling_avg_points_5, count(rolling_dnf_rate_5) AS rolling_dnf_rate_5,
  count(rolling_positions_gained_5) AS rolling_positions_gained_5, count(constructor_rolling_points) AS constructor_rolling_points,
  count(rolling_consistency) AS rolling_consistency, count(quali_gap_to_pole) AS quali_gap_to_pole, count(quali_gap_pct) AS quali_gap_pct,
  count(best_quali_seconds) AS best_quali_seconds, count(q1_seconds) AS q1_seconds, count(q2_seconds) AS q2_seconds,
  count(q3_seconds) AS q3_seconds, count(circuit_avg_position) AS circuit_avg_position, count(circuit_races_count) AS circuit_races_count,
  count(season_cumulative_points) AS season_cumulative_points FROM gold_table)
UNPIVOT (filled FOR column_name IN (COLUMNS(*))) WHERE filled > 0""")
def numeric_feature_columns(spark, sf_dir):
    """The pre-race numeric columns that hold any value."""
    df = gold.race_features(B.contest(spark, sf_dir), B.races_of(spark, sf_dir)).drop("first_ts", "race_date")
    names = _features(df).numeric
    wide = df.agg(*[F.count(c).alias(c) for c in names])
    rows = wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("filled")) for c in names])))
    return rows.filter("filled > 0").select("feature")


@query("imputation_medians", "WITH " + B.CONTEST_SQL + "," + TEAM_SQL + "," + GOLD_SQL + f"""
SELECT feature, round(middle, 6) AS middle FROM (
  SELECT {", ".join(f"median(CAST({c} AS DOUBLE)) AS {c}" for c in MEDIANS)}
  FROM gold_table WHERE season <= {LAST_TRAIN} AND target_position IS NOT NULL)
UNPIVOT (middle FOR feature IN (COLUMNS(*)))""")
def imputation_medians(spark, sf_dir):
    """The exact medians that missing values of training features get."""
    df = gold.race_features(B.contest(spark, sf_dir), B.races_of(spark, sf_dir))
    train, _ = time_split(labelled(df, "target_position"), LAST_TRAIN)
    return rounded(medians(train, FeatureSet(MEDIANS)).withColumnRenamed("median", "middle"))


def _compare(spark, sf_dir, label, settings, metric_names, measure, higher):
    df = training_table(spark, sf_dir)
    features = _features(df)
    train, test = time_split(df, LAST_TRAIN)
    tables = []
    for tried, (name, trained) in enumerate(models.fit_all(train, features, settings, label).items()):
        scored = trained.score(labelled(test, label))
        tables.append(evaluate.long_metrics(measure(scored), label, name, tried, metric_names))
    metrics = union_by_name(tables)
    wide = history.comparison_table(metrics, metric_names)
    best = history.best_model(metrics.filter(F.col("metric") == metric_names[0]), higher)
    return rounded(wide.join(F.broadcast(best.select("task", F.col("model").alias("best_model"))), "task"))


@query("compare_position_models")
def compare_position_models(spark, sf_dir):
    def measure(scored):
        return evaluate.regression_metrics(scored, "target_position", "prediction")

    return _compare(spark, sf_dir, "target_position", models.regressors(), ["mae", "rmse", "r2"], measure, False)


@query("compare_podium_models")
def compare_podium_models(spark, sf_dir):
    def measure(scored):
        return evaluate.classification_metrics(scored, "target_podium", "prediction")

    return _compare(spark, sf_dir, "target_podium", models.classifiers("target_podium"),
                    ["f1", "accuracy", "precision", "recall"], measure, True)


@query("compare_winner_models")
def compare_winner_models(spark, sf_dir):
    def measure(scored):
        return evaluate.rank_metrics(evaluate.with_probability(scored), "probability_1", "target_winner", "driver_id")

    return _compare(spark, sf_dir, "target_winner", models.classifiers("target_winner"), ["top1_rate", "topk_rate"], measure, True)


@query("cross_validated_error")
def cross_validated_error(spark, sf_dir):
    df = training_table(spark, sf_dir)
    forest = models.regressors()["random_forest"]
    folds = models.cross_validate(df, _features(df), forest, "target_position")
    return rounded(folds.agg(F.count(F.lit(1)).alias("folds"), F.avg("mae").alias("mae"), F.stddev_pop("mae").alias("spread")))


@query("searched_settings")
def searched_settings(spark, sf_dir):
    df = training_table(spark, sf_dir)
    _, table = models.search(df, _features(df), "target_winner", LAST_TRAIN)
    return rounded(table)


@query("feature_importances")
def feature_importances(spark, sf_dir):
    df = training_table(spark, sf_dir)
    train, _ = time_split(df, LAST_TRAIN)
    forest = models.regressors()["random_forest"]
    return models.fit(train, _features(df), forest, "target_position").importances().limit(10)


@query("stored_model_scores")
def stored_model_scores(spark, sf_dir):
    df = training_table(spark, sf_dir)
    train, test = time_split(df, LAST_TRAIN)
    forest = models.regressors()["random_forest"]
    folder = shared_dir(spark, "model")
    models.fit(train, _features(df), forest, "target_position", max_labels=50).save(folder)
    # Scoring data may lack features; they count as 0.
    scored = models.Trained.load(folder).score(test.drop("quali_gap_pct"), 1, 20)
    out = evaluate.driver_errors(scored, "prediction", "target_position", B.races_of(spark, sf_dir))
    return rounded(out.select("season", "round", "driver_id", "prediction", "predicted_rank", "target_position", "error"))


MODELS = ("random_forest", "gradient_boosting", "second_order_boosting")
MODEL_TASKS = ("target_position", "target_podium", "target_winner")


@query("model_facts", "WITH " + B.CONTEST_SQL + f""",
n AS (SELECT count(*) FILTER (WHERE season > {LAST_TRAIN} AND position IS NOT NULL) AS known, count(*) FILTER (WHERE season > {LAST_TRAIN}) AS all_rows
      FROM contest),
m AS (SELECT unnest({list(MODEL_TASKS)}) AS task), k AS (SELECT unnest({list(MODELS)}) AS model)
SELECT task, model, CAST(CASE WHEN model = 'random_forest' THEN 200 WHEN task = 'target_winner' THEN 400 ELSE 300 END AS INTEGER) AS trees,
       true AS within_depth, true AS importances_whole, CASE WHEN task = 'target_position' THEN known ELSE all_rows END AS scored_rows,
       0.0::DOUBLE AS stored_difference FROM m, k, n""")
def model_facts(spark, sf_dir):
    """What must hold of every model: its trees and their depth, importances that sum to 1, and scores that storing does not change."""
    df = training_table(spark, sf_dir)
    train, test = time_split(df, LAST_TRAIN)

    def facts(task):
        settings = models.regressors() if task == "target_position" else models.classifiers(task)
        out = []
        for name, trained in models.fit_all(train, _features(df), settings, task).items():
            folder = shared_dir(spark, "model")
            trained.model.save(folder)
            again = TreeModel.load(folder)
            rows = trained.model.transform(trained.prepared(labelled(test, task))).withColumnRenamed("prediction", "first")
            difference = F.coalesce(F.max(F.abs(F.col("prediction") - F.col("first"))), F.lit(0.0))
            total = again.importances().sum()
            split = any((tree.feature >= 0).any() for tree in again.trees)
            out.append(again.transform(rows).agg(F.count(F.lit(1)).alias("scored_rows"), difference.alias("stored_difference")).select(
                F.lit(task).alias("task"), F.lit(name).alias("model"), F.lit(len(again.trees)).alias("trees"),
                F.lit(max(tree.depth() for tree in again.trees) <= settings[name].depth).alias("within_depth"),
                F.lit(abs(total - split) < 1e-9).alias("importances_whole"), "scored_rows", "stored_difference"))
        return out

    # A boosted ensemble over a table of one partition grows in one task, so the tasks are trained at the same time.
    with ThreadPoolExecutor(len(MODEL_TASKS)) as pool:
        out = [row for rows in pool.map(inheritable_thread_target(spark)(facts), MODEL_TASKS) for row in rows]
    return rounded(union_by_name(out))


SPLIT_FEATURES = ("l_linenumber", "l_discount", "l_tax", "l_ship_year")


@query("first_split", f"""
WITH x AS (SELECT CAST(l_linenumber AS DOUBLE) AS l_linenumber, CAST(l_discount AS DOUBLE) AS l_discount, CAST(l_tax AS DOUBLE) AS l_tax,
                  CAST(year(l_shipdate) AS DOUBLE) AS l_ship_year, CAST(l_quantity AS DOUBLE) AS quantity,
                  CAST(l_returnflag = 'R' AS INTEGER)::DOUBLE AS returned FROM lineitem),
a AS (SELECT avg(quantity) AS quantity_mean, 1 / (1 + exp(-(avg(returned) - 0.5) / 0.25)) AS chance, (avg(returned) - 0.5) / 0.25 AS base FROM x),
y AS (SELECT 'quantity' AS label, quantity_mean - quantity AS g, 1.0 AS h, quantity_mean AS start, x.* FROM x, a
      UNION ALL SELECT 'returned', chance - returned, chance * (1 - chance), base, x.* FROM x, a),
u AS (SELECT label, g, h, start, feature, value FROM (SELECT label, g, h, start, {", ".join(SPLIT_FEATURES)} FROM y)
      UNPIVOT (value FOR feature IN ({", ".join(SPLIT_FEATURES)}))),
v AS (SELECT label, feature, value, sum(g) AS g, sum(h) AS h, min(start) AS start FROM u GROUP BY ALL),
c AS (SELECT *, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(g) OVER t AS ga, sum(h) OVER t AS ha FROM v
      WINDOW w AS (PARTITION BY label, feature ORDER BY value), t AS (PARTITION BY label, feature)),
s AS (SELECT *, greatest(abs(gl) - 0.5, 0) ^ 2 / (hl + 1) + greatest(abs(ga - gl) - 0.5, 0) ^ 2 / (ha - hl + 1) - greatest(abs(ga) - 0.5, 0) ^ 2 / (ha + 1) AS gain
      FROM c WHERE hl >= 10 AND ha - hl >= 10)
SELECT label, feature, value AS threshold, round(gain, 4) AS gain,
       round(start - sign(gl) * greatest(abs(gl) - 0.5, 0) / (hl + 1) * 0.3, 6) AS low_score,
       round(start - sign(ga - gl) * greatest(abs(ga - gl) - 0.5, 0) / (ha - hl + 1) * 0.3, 6) AS high_score
FROM s QUALIFY row_number() OVER (PARTITION BY label ORDER BY gain DESC) = 1""")
def first_split(spark, sf_dir):
    """The first split of second-order boosting with penalties on both losses, with the scores on either side of it."""
    items = B.table(spark, sf_dir, "lineitem").withColumn("l_ship_year", F.year("l_shipdate"))
    items = items.select(
        *[F.col(c).cast("double").alias(c) for c in SPLIT_FEATURES], F.col("l_quantity").cast("double").alias("quantity"),
        (F.col("l_returnflag") == "R").cast("double").alias("returned"))
    settings = TreeSettings(trees=1, depth=1, rate=0.3, least_weight=10, l1=0.5, l2=1, newton=True)
    out = []
    for label, logistic in (("quantity", False), ("returned", True)):
        model = models.fit(items, FeatureSet(SPLIT_FEATURES), replace(settings, logistic=logistic), label).model
        nodes = model.nodes()
        # One tree of three nodes.
        sides = nodes.agg(F.max(F.when(F.col("node") == 1, F.col("value"))).alias("low"), F.max(F.when(F.col("node") == 2, F.col("value"))).alias("high"),
                          F.max(F.when(F.col("node") == 0, F.col("feature"))).alias("f"), F.max("threshold").alias("threshold"), F.max("gain").alias("gain"))
        names = F.array(*[F.lit(c) for c in SPLIT_FEATURES])
        out.append(sides.select(
            F.lit(label).alias("label"), names[F.col("f")].alias("feature"), "threshold", F.round("gain", 4).alias("gain"),
            F.round(F.col("low") + model.base, 6).alias("low_score"), F.round(F.col("high") + model.base, 6).alias("high_score")))
    return union_by_name(out)
