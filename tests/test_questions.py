"""Questions on the stored wide table read the season they name."""

from lapwise.plans import questions
from lapwise.session import shared_dir

SEASON = "(SELECT max(season) FROM race_data)"


def stored(spark):
    rows = [(s, n, d, d % 2, int(d == 1), 0.5 * d) for s in (2001, 2002, 2003) for n in (1, 2) for d in (1, 2, 3)]
    df = spark.createDataFrame(
        rows, "season int, round int, driver_id int, constructor_id int, target_winner int, quali_gap_to_pole double")
    path = shared_dir(spark, "race-data")
    questions.store_race_data(df, path)
    return questions.stored_race_data(spark, path)


def test_only_the_named_season_is_read(spark):
    data = stored(spark)
    for season, count in ((2002, 1), (SEASON, 1)):
        out = questions.ask(data, "most_wins_in_season", season=season)
        assert out.first().asDict() == {"driver_id": 1, "wins": 2}
        plan = out._jdf.queryExecution()
        plan.executedPlan().executeCollect()
        scans = [x for x in plan.executedPlan().toString().split("\n") if "FileScan" in x and "target_winner" in x]
        assert scans and all("PartitionFilters: [isnotnull(season" in x for x in scans)


def test_a_second_write_replaces_the_table(spark):
    data = stored(spark)
    path = shared_dir(spark, "race-data")
    questions.store_race_data(data, path)
    again = questions.store_race_data(data.filter("season < 2003"), path)
    assert again.count() == 12
