"""The assembled evaluation report on small tables."""

import pytest

from lapwise.learn.evaluate import evaluation_report

SCHEMA = "driver_id int, circuit_id int, target_position int, target_podium int, podium_call int, prediction double"


def report(spark, rows):
    out = evaluation_report(spark.createDataFrame(rows, SCHEMA), "target_position", "target_podium", "podium_call", "prediction", n=2)
    return {(r["section"], r["place"]): (r["name"], r["value"]) for r in out.collect()}


def test_report(spark):
    rows = [(1, 1, 1, 1, 1, 2.0), (2, 1, 2, 1, 0, 12.0), (3, 2, 9, 0, 1, 9.0), (4, 2, None, 0, 0, 5.0), (1, 3, 4, 0, 0, 5.0)]
    got = report(spark, rows)
    assert got["position", 1] == ("mae", 3.0) and got["position", 2] == ("rows", 4.0)
    assert got["podium", 1] == ("f1", pytest.approx(0.5)) and got["podium", 2] == ("rows", 5.0)
    assert [got["retrain", i][1] for i in (1, 2, 3)] == [0.0, 0.0, 0.0]
    assert got["worst_circuits", 1] == ("1", 5.5) and got["worst_circuits", 2] == ("3", 1.0)
    # Equal errors are settled by name.
    assert got["worst_drivers", 1] == ("2", 10.0) and got["worst_drivers", 2] == ("1", 1.0)
    assert len(got) == 11


def test_each_reason_to_train_again(spark):
    got = report(spark, [(1, 1, 1, 1, 1, 9.0)])
    assert [got["retrain", i][1] for i in (1, 2, 3)] == [1.0, 0.0, 1.0]
    got = report(spark, [(1, 1, 1, 1, 0, 2.0)])
    assert [got["retrain", i][1] for i in (1, 2, 3)] == [0.0, 1.0, 1.0]


def test_no_labels(spark):
    for rows in ([], [(1, 1, None, None, 1, 2.0)]):
        got = report(spark, rows)
        assert got["position", 1] == ("mae", None) and got["podium", 1] == ("f1", None)
        assert got["retrain", 3] == ("retrain", 0.0) and len(got) == 7
