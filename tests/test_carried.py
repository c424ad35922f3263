"""The gold store: rounds appended one by one give the rows of a full run."""

import random

import pytest
from table_rows import rows_of

from lapwise.plans.carried import full_gold, gold_rows, last_round, refresh_gold, rounds_after
from lapwise.session import shared_dir

SCHEMA = ("season int, round int, driver_id int, constructor_id int, circuit_id int, grid int, position int, points double, "
          "dnf boolean, best_quali_seconds double, num_pit_stops long, status string")


def season_rows(seed, seasons=3, rounds=7, drivers=9):
    """Drivers miss races and finishes, change teams, and one has no name."""
    r = random.Random(seed)
    out = []
    for s in range(seasons):
        for n in range(1, rounds + 1):
            field = [d for d in range(drivers) if r.random() < 0.8]
            r.shuffle(field)
            for place, d in enumerate(field, 1):
                dnf = r.random() < 0.2
                out.append((2000 + s, n, d or None, (d + (r.random() < 0.1)) // 2, n % 4 or None, r.randint(1, 20), None if dnf else place,
                            None if r.random() < 0.1 else float(max(0, 11 - place)), dnf, 80 + r.randint(0, 9) / 4,
                            r.randint(0, 4), "Finished"))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def rows():
    return season_rows(5)


@pytest.fixture(scope="module")
def full(spark, rows):
    return full_gold(frame(spark, rows))


def test_appended_rounds_equal_the_full_run(spark, rows, full):
    """The later calls get their own rounds only, so nothing but the state can hold the past."""
    store = shared_dir(spark, "gold")
    first = [x for x in rows if x[:2] <= (2002, 2)]
    refresh_gold(frame(spark, first), store)
    for n in (3, 4, 5):
        out = refresh_gold(frame(spark, [x for x in rows if x[:2] == (2002, n)]), store)
    out = refresh_gold(frame(spark, [x for x in rows if x[:2] > (2002, 5)]), store)
    assert sorted(out.columns) == sorted(full.columns)
    assert rows_of(out, 8) == rows_of(full, 8)
    assert last_round(spark, store)["version"] == 4


def test_a_backfill_in_steps(spark, rows, full):
    some = [x for x in rows if x[0] < 2002]
    store = shared_dir(spark, "gold")
    out = refresh_gold(frame(spark, some), store, step_rounds=6)
    assert rows_of(out, 8) == rows_of(full.filter("season < 2002"), 8)
    assert last_round(spark, store)["version"] == 2


def test_nothing_new_and_late_rows(spark, rows):
    store = shared_dir(spark, "gold")
    held = [x for x in rows if x[0] == 2000 and x[1] != 6]
    before = rows_of(refresh_gold(frame(spark, held), store), 8)
    assert rows_of(refresh_gold(frame(spark, held), store), 8) == before
    assert last_round(spark, store)["version"] == 0
    late = [x for x in rows if x[0] == 2000]
    with pytest.warns(UserWarning, match=f"{len(late) - len(held)} rows belong to rounds before"):
        assert rows_of(refresh_gold(frame(spark, late), store), 8) == before


def test_empty_and_undated(spark, rows):
    store = shared_dir(spark, "gold")
    assert refresh_gold(frame(spark, []), store) is None
    undated = [(None, 1, *rows[0][2:]), (2000, None, *rows[0][2:])]
    assert refresh_gold(frame(spark, undated), store) is None
    with pytest.raises(ValueError, match="no rounds"):
        gold_rows(spark, store)
    with pytest.raises(ValueError, match="rounds"):
        refresh_gold(frame(spark, rows), store, step_rounds=0)


def test_a_failed_version_does_not_count(spark, rows, full):
    """A call that ends before its last write leaves rows behind; the next call writes them anew."""
    store = shared_dir(spark, "gold")
    refresh_gold(frame(spark, [x for x in rows if x[0] == 2000]), store)
    half = frame(spark, [x for x in rows if x[0] == 2001][:5])
    full_gold(half).write.partitionBy("season").parquet(f"{store}/gold/version=1")
    assert gold_rows(spark, store).filter("season > 2000").isEmpty()
    out = refresh_gold(frame(spark, [x for x in rows if x[0] == 2001]), store)
    assert rows_of(out, 8) == rows_of(full.filter("season < 2002"), 8)


def test_old_seasons_are_not_read(spark, rows):
    path = shared_dir(spark, "master")
    frame(spark, rows).write.partitionBy("season").parquet(path)
    store = shared_dir(spark, "gold")
    refresh_gold(spark.read.parquet(path).filter("season < 2002"), store)
    plan = rounds_after(spark.read.parquet(path), last_round(spark, store))._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):].split("]")[0]
    assert "season" in filters and ">= 2001" in filters
