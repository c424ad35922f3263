"""Exact quantiles of hot groups by sketches and counts."""

import random

import numpy as np
import pytest

from lapwise.operators import groups
from lapwise.operators.ordered import hot_groups

POINTS = {"a": 0.0, "q": 0.25, "m": 0.5, "h": 0.9, "z": 1.0}


def values(kind):
    r = random.Random(kind)
    if kind == "ties":
        return [float(r.choice([1, 2, 2, 2, 7])) for _ in range(5000)]
    if kind == "equal":
        return [3.5] * 3000
    if kind == "spread":
        return [r.choice([-1, 1]) * 10 ** r.uniform(-8, 12) for _ in range(6001)]
    if kind == "heap":
        return [r.gauss(0, 1) for _ in range(3000)] + [1e9 + i * 1e-3 for i in range(3001)]
    return [float(i) for i in range(300)] + [50.0] * 900


@pytest.mark.parametrize("kind", ["ties", "equal", "spread", "heap", "half"])
def test_quantiles_of_hot_groups(spark, hot, kind):
    hot(40)
    v = values(kind)
    rows = [(g, x) for g in ("k", None) for x in v] + [("small", 4.0), ("small", 9.0), ("k", None), ("none", None)]
    random.Random(1).shuffle(rows)
    out = groups.quantiles(spark.createDataFrame(rows, "g string, x double"), ["g"], "x", POINTS)
    got = {r["g"]: r for r in out.collect()}
    assert set(got) == {"k", None, "small"}
    for c, p in POINTS.items():
        assert got["k"][c] == got[None][c] == pytest.approx(float(np.quantile(v, p)), rel=1e-12, abs=1e-12)
        assert got["small"][c] == pytest.approx(4 + 5 * p)


def test_whole_numbers_and_all_groups_hot(spark, hot, monkeypatch):
    from lapwise.operators import ordered

    hot(10)
    monkeypatch.setattr(ordered, "MAX_LISTED_GROUPS", 2)
    rows = [(g, (i * 7919) % 1001) for g in range(5) for i in range(1001)]
    df = spark.createDataFrame(rows, "g int, x long")
    assert hot_groups(df, ["g"]).everything
    out = groups.quantiles(df, ["g"], "x", {"m": 0.5, "t": 0.123})
    assert {(r["g"], r["m"], round(r["t"], 9)) for r in out.collect()} == {(g, 500.0, 123.0) for g in range(5)}


def test_no_group_is_sorted(spark, hot):
    """What is left to run after the narrowing has no window and no range exchange."""
    hot(40)
    df = spark.createDataFrame([("k", float(i)) for i in range(500)], "g string, x double")
    out = groups.quantiles(df, ["g"], "x", {"m": 0.5})
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Sort [" not in plan and "RepartitionByExpression" not in plan
