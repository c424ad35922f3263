"""Groups above the row limit give the same rows as plain windows; one key holds half of all rows."""

import random

import pandas as pd
import pytest
from table_rows import rows_of
from pyspark.sql import functions as F

from lapwise.operators import form, groups, ordered

R = random.Random(5)
ROWS = [
    (1 if R.random() < 0.5 else R.randint(2, 6), i, None if R.random() < 0.2 else R.randint(0, 5)) for i in range(3000)
]


@pytest.fixture(scope="module")
def df(spark):
    out = spark.createDataFrame(ROWS, "k int, t int, x int")
    return out.withColumn("f", F.coalesce((F.col("x") > 2).cast("int"), F.lit(0)))


CASES = {
    "position": lambda d: ordered.with_position(d, ["k"], ["t"], "p"),
    "position_desc_nulls": lambda d: ordered.with_position(d, ["k"], [F.col("x").desc_nulls_last(), "t"], "p"),
    "rolling": lambda d: ordered.rolling(
        d, ["k"], ["t"], {"a": lambda w: F.avg("x").over(w), "s": lambda w: F.stddev_samp("x").over(w)}, -5),
    "expanding": lambda d: ordered.expanding(
        d, ["k"], ["t"],
        {"a": ("avg", F.col("x")), "c": ("count", F.col("x")), "m": ("max", F.col("x")), "l": ("min", F.col("x")), "s": ("sum", F.col("x"))}),
    "expanding_through": lambda d: ordered.expanding(d, ["k"], ["t"], {"s": ("sum", F.col("x"))}, through_current=True),
    "rank": lambda d: ordered.with_rank(d, ["k"], "x", "r"),
    "rank_average": lambda d: ordered.with_rank(d, ["k"], "x", "r", descending=False, method="average"),
    "streak": lambda d: form.streaks_before(d, ["k"], ["t"], {"s": "f"}),
    "ewm": lambda d: form.ewm_before(d, ["k"], ["t"], {"e": F.col("x")}),
    "slope": lambda d: form.rolling_slope(d, ["k"], ["t"], "x", "s"),
    "second_difference": lambda d: form.second_difference(d, ["k"], ["t"], "x", "s"),
    "islands": lambda d: form.running_islands(d, ["k"], ["t"], "x", "i", "a"),
    "group_stats": lambda d: groups.group_stats(d, ["k"], {"m": F.avg("x"), "n": F.count("x")}),
    "quantiles": lambda d: groups.quantiles(d, ["k"], "x", {"q": 0.25, "m": 0.5, "h": 0.9}),
    "left_enrich": lambda d: groups.left_enrich(d, d.groupBy("k").agg(F.max("t").alias("last")).filter("k <> 2"), ["k"], {"last": -1}),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_hot_groups_agree_with_windows(df, hot, name):
    hot(1_000_000)
    want = rows_of(CASES[name](df))
    hot(400)
    assert ordered.hot_groups(df, ["k"]).rows
    assert rows_of(CASES[name](df)) == want


def test_everything_hot(df, hot, monkeypatch):
    want = rows_of(CASES["rolling"](df))
    hot(10)
    monkeypatch.setattr(ordered, "MAX_LISTED_GROUPS", 2)
    found = ordered.hot_groups(df, ["k"])
    assert found.everything
    assert rows_of(CASES["rolling"](df)) == want


def test_null_keys_form_one_group(spark, hot):
    d = spark.createDataFrame([(None, i, i) for i in range(50)] + [(1, i, i) for i in range(5)], "k int, t int, x int")
    want = rows_of(ordered.with_position(d, ["k"], ["t"], "p"))
    hot(20)
    assert rows_of(ordered.with_position(d, ["k"], ["t"], "p")) == want
    assert rows_of(groups.group_stats(d, ["k"], {"n": F.count("t")}))[-1][1] in (5, 50)


def test_a_finer_check_is_refused(df):
    hot_fine = ordered.HotGroups(by=("k", "x"), rows=((1, 2, 9),))
    with pytest.raises(ValueError):
        ordered.split_hot(df, ["k"], hot_fine)


def test_results_do_not_depend_on_partitions(spark, df):
    want = rows_of(CASES["expanding"](df))
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        assert rows_of(CASES["expanding"](df.repartition(5))) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("share", [0.002, 0.01, 0.9])
def test_ewm_against_pandas_over_blocks(spark, hot, share):
    """Sparse values, also right at the borders of blocks."""
    r = random.Random(share)
    x = [r.random() if r.random() < share or i in (999, 1000, 2000, 2999) else None for i in range(4200)]
    p = pd.DataFrame({"k": 1, "t": range(len(x)), "x": pd.Series(x, dtype=float)})
    want = p["x"].ewm(span=5).mean().shift(1)
    d = spark.createDataFrame([(1, i, v) for i, v in enumerate(x)], "k int, t int, x double")
    for rows in (1_000_000, 500):
        hot(rows)
        got = form.ewm_before(d, ["k"], ["t"], {"e": F.col("x")}).orderBy("t").toPandas()["e"]
        pd.testing.assert_series_equal(got, want, check_names=False, rtol=1e-12)


@pytest.mark.parametrize(("span", "rows"), [(5, 6000), (1001, 6000), (1, 50), (2, 2500)])
def test_ewm_of_any_span_and_length(spark, hot, span, rows):
    r = random.Random(span)
    x = [r.random() if r.random() < 0.9 else None for _ in range(rows)]
    want = pd.Series(x, dtype=float).ewm(span=span).mean().shift(1) if span > 1 else pd.Series(x, dtype=float).ffill().shift(1)
    d = spark.createDataFrame([(1, i, v) for i, v in enumerate(x)], "k int, t int, x double")
    for limit in (1_000_000, 700):
        hot(limit)
        got = form.ewm_before(d, ["k"], ["t"], {"e": F.col("x")}, span).orderBy("t").toPandas()["e"]
        pd.testing.assert_series_equal(got, want, check_names=False, rtol=1e-11)


def test_ewm_over_a_long_gap(spark):
    """Earlier blocks still count when whole blocks have no value."""
    d = spark.createDataFrame([(1, i, float(i) if i in (3, 5) else None) for i in range(3500)], "k int, t int, x double")
    got = form.ewm_before(d, ["k"], ["t"], {"e": F.col("x")}, hot=ordered.BOUNDED).filter("t = 3499").first()["e"]
    w = (2 / 3) ** 2
    assert got == pytest.approx((5 + 3 * w) / (1 + w))


def test_many_hot_keys_are_still_salted(spark, hot, monkeypatch):
    monkeypatch.setattr(ordered, "MAX_LISTED_GROUPS", 3)
    hot(20)
    fact = spark.range(1000).selectExpr("id % 10 AS k", "id AS t")
    dim = spark.range(10).selectExpr("id AS k", "id * 7 AS v")
    found = ordered.hot_groups(fact, ["k"])
    assert (found.everything, found.total, found.largest) == (True, 1000, 100)
    out = groups.spread_join(fact, dim, ["k"], found)
    assert "__salt" in plan_of(out)
    assert sorted(map(tuple, out.collect())) == sorted((i % 10, i, i % 10 * 7) for i in range(1000))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_limits_groups_before_the_shuffle(df):
    plan = plan_of(groups.top_k(df, ["k"], [F.col("x").desc(), F.col("t")], 3))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_dedup_combines_before_the_shuffle(df):
    plan = plan_of(groups.dedup_latest(df, ["k"], "t"))
    assert "partial_max" in plan and plan.count("Exchange") == 1


def test_driver_windows_share_one_shuffle(spark):
    from table_rows import SF

    from lapwise import bindings as B
    from lapwise.plans import gold

    master = B.contest(spark, SF)
    before = plan_of(master).count("Exchange hashpartitioning")
    df = gold.ewm_form(gold.streaks(gold.targets(gold.season_points(gold.circuit_history(gold.rolling_form(master))))))
    assert plan_of(df).count("Exchange hashpartitioning") == before + 1


def test_wide_plan_grows_by_scans_not_by_doubling(spark):
    from table_rows import SF

    from lapwise import bindings as B
    from lapwise.plans import gold
    from lapwise.session import materialised

    master = materialised(B.contest(spark, SF), "master")
    assert plan_of(gold.race_features(master)).count("FileScan") <= 4
