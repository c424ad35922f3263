"""Ratings against a plain loop over all pairs, in every execution form."""

import random

import pytest

from lapwise.operators.rating import against_field, elo, latest_ratings, refresh_ratings
from lapwise.session import shared_dir

K, START = 32.0, 1500.0


def brute(rows, sequential):
    """rows: (universe, contest, entity, rank or None)."""
    out, ratings = {}, {}
    for u, c in sorted({(r[0], r[1]) for r in rows}):
        field = sorted((r for r in rows if r[:2] == (u, c)), key=lambda r: (r[3] is None, r[3] or 0, r[2]))
        old = {r[2]: ratings.get((u, r[2]), START) for r in field}
        now = dict(old)
        done = [r for r in field if r[3] is not None]
        for r in done:
            others = [o for o in done if o[2] != r[2]]
            if not others:
                continue
            seen = now if sequential else old
            delta = sum(K * ((1.0 if r[3] < o[3] else 0.0) - 1 / (1 + 10 ** ((seen[o[2]] - old[r[2]]) / 400))) for o in others)
            now[r[2]] = old[r[2]] + delta / len(others)
        for r in field:
            out[(u, c, r[2])] = old[r[2]]
        ratings.update({(u, e): v for e, v in now.items()})
    return out


@pytest.fixture(scope="module")
def rows():
    r = random.Random(3)
    out = []
    for u in ("a", "b"):
        for c in range(6):
            for e in r.sample(range(12), 9):
                out.append((u, c, e, None if r.random() < 0.15 else r.randint(1, 7)))  # ties and missing finishes
    out.append(("b", 9, 1, 1))  # a race with one entrant
    return out


@pytest.mark.parametrize("max_rows, block_rows, contests", [(10**9, 10**9, 10), (18, 10**9, 2), (10, 5, 2)])
@pytest.mark.parametrize("mode", ["sequential", "simultaneous"])
def test_elo(spark, rows, mode, max_rows, block_rows, contests):
    """In one task, one universe by contest and one in a task, and by contest in blocks of five entrants."""
    rows = [x for x in rows if x[1] < contests or x[1] == 9]
    d = spark.createDataFrame(rows, "u string, c int, e int, r int")
    got = elo(d, ["u"], ["c"], "e", "r", mode=mode, max_rows=max_rows, block_rows=block_rows)
    got = {(x["u"], x["c"], x["e"]): x["rating"] for x in got.collect()}
    want = brute(rows, mode == "sequential")
    assert got.keys() == want.keys()
    for key, value in want.items():
        assert got[key] == pytest.approx(value, abs=1e-8)


def test_wide_ratings_in_the_linear_form(spark):
    """Far apart ratings fall into many cells of the curve."""
    from lapwise.operators.rating import _one_contest

    r = random.Random(8)
    field = [(1, i, r.uniform(200, 3200), r.randint(1, 60)) for i in range(80)]
    d = spark.createDataFrame(field, "c int, e int, rating double, r int")
    got = {x["e"]: x["new_rating"] for x in _one_contest(d, ["c"], "r", K).collect()}
    for _, e, rating, rank in field:
        total = sum((1.0 if rank < o[3] else 0.0) - 1 / (1 + 10 ** ((o[2] - rating) / 400)) for o in field if o[1] != e)
        assert got[e] == pytest.approx(rating + K * total / 79, abs=1e-9)


@pytest.mark.parametrize("sequential", [True, False])
def test_wide_ratings_in_one_task(sequential):
    import numpy as np

    from lapwise.operators.rating import ScoreCurve, _contest_ratings

    r = random.Random(9)
    rating = np.array([r.uniform(200, 3200) for _ in range(90)])
    rank = np.sort(np.array([r.randint(1, 40) for _ in range(90)]))
    ahead = np.array([(rank > x).sum() for x in rank])
    got = _contest_ratings(ahead, rating, 90, K, sequential, ScoreCurve.of(rating))
    now = rating.copy()
    for i in range(90):
        seen = now if sequential else rating
        total = sum((1.0 if rank[i] < rank[j] else 0.0) - 1 / (1 + 10 ** ((seen[j] - rating[i]) / 400)) for j in range(90) if j != i)
        now[i] = rating[i] + K * total / 89
    np.testing.assert_allclose(got, now, atol=1e-9)


def test_unknown_mode(spark, rows):
    with pytest.raises(ValueError):
        elo(spark.createDataFrame(rows, "u string, c int, e int, r int"), ["u"], ["c"], "e", "r", mode="other")


@pytest.mark.parametrize("mode", ["sequential", "simultaneous"])
def test_a_continued_history_is_the_refolded_one(spark, rows, mode):
    store = shared_dir(spark, "ratings")
    schema = "u string, c int, e int, r int"
    for upto in (2, 4, 9, 9):
        d = spark.createDataFrame([x for x in rows if x[1] <= upto], schema)
        history = refresh_ratings(d, store, ["u"], ["c"], "e", "r", mode=mode)
    got = {(x["u"], x["c"], x["e"]): x["rating"] for x in history.collect()}
    want = brute(rows, mode == "sequential")
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(v, abs=1e-8) for k, v in want.items())
    # The last call found nothing new and wrote no version.
    assert spark.read.parquet(f"{store}/last").select("version").distinct().count() == 3
    # After the last contest of universe a, its ratings stand where a next contest would find them.
    after = brute([*rows, *[("a", 10, e, None) for e in range(12)]], mode == "sequential")
    state = {r["e"]: r["rating"] for r in latest_ratings(spark, store, "u string, e int, rating double").filter("u = 'a'").collect()}
    assert all(state.get(e, START) == pytest.approx(after["a", 10, e], abs=1e-8) for e in range(12))


def test_late_contests_are_reported(spark, rows):
    store = shared_dir(spark, "ratings")
    schema = "u string, c int, e int, r int"
    first = [x for x in rows if x[1] != 2]
    refresh_ratings(spark.createDataFrame(first, schema), store, ["u"], ["c"], "e", "r")
    with pytest.warns(UserWarning, match="18 rows belong to contests before"):
        history = refresh_ratings(spark.createDataFrame(rows, schema), store, ["u"], ["c"], "e", "r")
    assert history.count() == len(first)


def test_against_field(spark):
    facts = spark.createDataFrame([(1, 1), (1, 2)], "c int, e int")
    ratings = spark.createDataFrame([(1, 1, 1600.0)], "c int, e int, rating double")
    out = against_field(facts, ratings, ["c"], "e")
    got = {r["e"]: (r["driver_elo"], r["elo_vs_field"]) for r in out.collect()}
    assert got == {1: (1600.0, 50.0), 2: (1500.0, -50.0)}


def test_ranks_are_counted_once_for_all_contests(spark, rows, monkeypatch):
    """A step by contest repeats only what depends on the ratings."""
    from lapwise.operators import rating

    calls, plain = [], rating.expanding
    monkeypatch.setattr(rating, "expanding", lambda *a, **k: calls.append(1) or plain(*a, **k))
    d = spark.createDataFrame([x for x in rows if x[1] < 3], "u string, c int, e int, r int")
    elo(d, ["u"], ["c"], "e", "r", mode="simultaneous", max_rows=5)
    assert len(calls) == 1


def test_one_task_holds_fewer_rows_if_a_contest_can_be_spread(spark, rows, monkeypatch):
    from lapwise.operators import rating

    limits, plain = [], rating.hot_groups
    monkeypatch.setattr(rating, "hot_groups", lambda df, by, size, limit: limits.append(limit) or plain(df, by, size, limit))
    d = spark.createDataFrame(rows, "u string, c int, e int, r int")
    for mode in ("sequential", "simultaneous"):
        elo(d, ["u"], ["c"], "e", "r", mode=mode)
    assert limits == [2_000_000, 500_000]


def test_a_large_contest_is_one_job(spark, monkeypatch):
    """Many contests by blocks, past a stored rating, are the pairwise ones; each costs one job and no table."""
    from lapwise.operators import rating

    r = random.Random(5)
    rows = [(u, c, e, None if r.random() < 0.1 else r.randint(1, 9)) for u in ("a", "b") for c in range(9) for e in r.sample([None, *range(30)], 20)]
    d = spark.createDataFrame([x for x in rows if x[2] is not None], "u string, c int, e int, r int")
    written, plain = [], rating.materialised
    monkeypatch.setattr(rating, "materialised", lambda *a, **k: written.append(1) or plain(*a, **k))
    monkeypatch.setattr(rating, "STORED_STEPS", 4)
    got = rating.rate(d, ["u"], ["c"], "e", "r", mode="simultaneous", max_rows=5)
    got = {(x["u"], x["c"], x["e"]): x["rating"] for x in got.collect()}
    want = brute([x for x in rows if x[2] is not None], False)
    assert got.keys() == want.keys() and all(got[key] == pytest.approx(v, abs=1e-8) for key, v in want.items())
    assert len(written) < 9


def test_large_universes_begin_with_given_ratings_far_apart(spark):
    from lapwise.operators.rating import rate

    r = random.Random(6)
    rows = [("a", c, e, r.randint(1, 9)) for c in range(3) for e in range(25)]
    d = spark.createDataFrame(rows, "u string, c int, e int, r int")
    start = spark.createDataFrame([("a", e, r.uniform(-3000, 6000)) for e in range(20)], "u string, e int, rating double")
    small, large = (
        {(x["c"], x["e"]): (x["rating"], x["new_rating"]) for x in rate(d, ["u"], ["c"], "e", "r", 700.0, "simultaneous", n, start).collect()}
        for n in (10**9, 5))
    assert small.keys() == large.keys() and all(large[key] == pytest.approx(v, abs=1e-7) for key, v in small.items())
