"""The gold table as a store that grows round by round.

Features look back, so a full run reads all history for every new round. The
store keeps what the features need of the past as small tables, each written
anew with every version:

* driver: the last five races, points of the season, streaks, and the sum and
  weight of the exponentially weighted means,
* visit: sums per driver and circuit,
* team: sum and number of points of the last ten races,
* circuit: retirements, entries, and mean and squared deviations of finishes.

A refresh reads the rounds after the last one, joins them with these tables
and writes their gold rows and the tables after them. Its work grows with the
new rounds and the number of drivers, teams and circuits, not with history.
"""

from __future__ import annotations

import warnings
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from lapwise.functions.scalars import flag, ratio
from lapwise.operators import form
from lapwise.operators.groups import calendar_join, left_enrich
from lapwise.operators.ordered import HotGroups, expanding, hot_groups, null_safe_join, with_position
from lapwise.plans import gold
from lapwise.plans.gold import ORDER, PER_DRIVER, RACE
from lapwise.session import materialised
from lapwise.sources.scan import read_glob

# Rounds in one version; bounds the rows of a driver in a step, and the weights of the exponential means.
STEP_ROUNDS = 400
FORM_RACES, TEAM_RACES, SPAN = 5, 10, 5
GROW = (SPAN + 1) / (SPAN - 1)

STREAKS = {"win_streak": "target_winner", "podium_streak": "target_podium", "points_streak": "target_points_finish"}
MEANS = {"ewm_position_5": "target_position", "ewm_points_5": "target_points_finish"}
TAIL = ("season", "round", "grid", "position", "points", "dnf")


def full_gold(master: DataFrame, hot: HotGroups | None = None) -> DataFrame:
    """The same columns from all history at once."""
    hot = hot_groups(master, RACE) if hot is None else hot
    df = gold.race_features(master, hot)
    visits = gold.circuit_history(master).select(*RACE, "driver_id", "driver_circuit_wins", "driver_circuit_podiums")
    df = null_safe_join(df, visits, [*RACE, "driver_id"])
    df = gold.ewm_form(gold.streaks(df))
    risk = gold.circuit_risk(master).select(*RACE, "circuit_id", "circuit_dnf_rate", "circuit_chaos_index").distinct()
    df = calendar_join(df, risk, [*RACE, "circuit_id"])
    return _within_race(materialised(df, "gold"), hot)


def _within_race(df: DataFrame, hot: HotGroups) -> DataFrame:
    """Features that need no more than the race; `df` is stored, so each step takes its aggregates from it."""
    out = gold.dominance(gold.quali_vs_teammate(df, hot, df), df)
    return gold.championship(out, hot, df)


def _visit_sums(position: Column) -> dict[str, tuple[str, Column]]:
    return {
        "place_sum": ("sum", position), "place_count": ("count", position), "visits": ("count", F.lit(1)),
        "wins": ("sum", flag(position == 1)), "podiums": ("sum", flag(position <= 3)),
    }


def _schemas(df: DataFrame) -> dict[str, str]:
    kind = {f.name: f.dataType.simpleString() for f in df.schema}
    named = lambda *columns: ", ".join(f"{c} {kind[c]}" for c in columns)
    tail = ", ".join(f"{c}: {kind[c]}" for c in TAIL)
    sums = ", ".join(f"{out}_top double, {out}_weight double" for out in MEANS)
    return {
        "driver": f"{named('driver_id')}, tail array<struct<{tail}>>, {named('season')}, season_points double, "
                  + ", ".join(f"{out} bigint" for out in STREAKS) + f", {sums}",
        "visit": f"{named('driver_id', 'circuit_id')}, place_sum bigint, place_count bigint, visits bigint, wins bigint, podiums bigint",
        "team": f"{named('constructor_id')}, tail array<struct<{named('season').replace(' ', ': ')}, "
                f"{named('round').replace(' ', ': ')}, __sum: double, __count: bigint>>",
        "circuit": f"{named('circuit_id', *RACE)}, __d bigint, __n bigint, __m double, __v double, __c bigint",
    }


KEYS = {"driver": ["driver_id"], "visit": ["driver_id", "circuit_id"], "team": ["constructor_id"], "circuit": ["circuit_id"]}


def _state(spark: SparkSession, store: str, schemas: dict[str, str], version: int | None) -> dict[str, DataFrame]:
    if version is None:
        return {name: spark.createDataFrame([], schema) for name, schema in schemas.items()}
    return {name: spark.read.schema(schema).parquet(f"{store}/{name}/version={version}") for name, schema in schemas.items()}


def _tails(state: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The carried races of the keys that `rows` has."""
    held = null_safe_join(state.select(key, "tail"), rows.select(key).distinct(), [key], "left_semi")
    return held.select(key, F.explode("tail").alias("r")).select(key, "r.*")


def _last(rows: DataFrame, key: str, columns: list[str], n: int) -> DataFrame:
    """(key, tail): the last `n` races of each key; a key has a step's rounds at most."""
    races = F.collect_list(F.struct(*columns))
    return rows.groupBy(key).agg(F.slice(F.sort_array(races, asc=False), 1, n).alias("tail"))


def _before(df: DataFrame, state: DataFrame) -> DataFrame:
    """Season points, streaks and exponential sums before each row, from the driver's state and the step's earlier rows."""
    carried = state.drop("tail").withColumnsRenamed({c: f"__{c}" for c in state.columns if c not in ("driver_id", "tail")})
    df = null_safe_join(df, carried, ["driver_id"])
    df = expanding(df, ["driver_id", "season"], ["round"], {"__own": ("sum", F.col("points"))}, hot=PER_DRIVER)
    held = F.when(F.col("__season") == F.col("season"), F.col("__season_points"))
    total = F.coalesce("__own", F.lit(0.0)) + F.coalesce(held, F.lit(0.0))
    df = df.withColumn("season_cumulative_points", total).drop("__own", "__season", "__season_points")

    df = with_position(df, ["driver_id"], ORDER, "__at", PER_DRIVER)
    earlier = F.col("__at") - 1
    df = gold.streaks(df)
    df = df.withColumns({
        out: F.when(F.col(out) == earlier, F.col(out) + F.coalesce(f"__{out}", F.lit(0))).otherwise(F.col(out)) for out in STREAKS
    })

    weight = F.pow(F.lit(GROW), earlier)
    sums = {}
    for out, value in MEANS.items():
        sums[f"__t_{out}"] = ("sum", F.col(value) * weight)
        sums[f"__w_{out}"] = ("sum", F.when(F.col(value).isNotNull(), weight))
    df = expanding(df, ["driver_id"], ORDER, sums, hot=PER_DRIVER, position="__at")
    # The row before weighs 1; the carried sums are as many rows older as the step has before this row.
    both = {}
    for out in MEANS:
        for short, long in (("t", "top"), ("w", "weight")):
            own = F.coalesce(f"__{short}_{out}", F.lit(0.0)) / F.pow(F.lit(GROW), earlier - 1)
            both[f"__{short}_{out}"] = own + F.coalesce(f"__{out}_{long}", F.lit(0.0)) / weight
    df = df.withColumns(both).withColumns({out: ratio(F.col(f"__t_{out}"), F.col(f"__w_{out}")) for out in MEANS})
    return df.drop("__at", *[f"__{out}" for out in STREAKS], *[f"__{out}_{s}" for out in MEANS for s in ("top", "weight")])


def _driver_after(df: DataFrame, rows: DataFrame) -> DataFrame:
    """The state of the step's drivers after their last row."""
    points = (F.col("season_cumulative_points") + F.coalesce("points", F.lit(0.0))).alias("season_points")
    streaks = [F.when(F.col(f) == 1, F.col(out) + 1).otherwise(F.lit(0)).cast("long").alias(out) for out, f in STREAKS.items()]
    sums = []
    for out, value in MEANS.items():
        sums.append((F.col(f"__t_{out}") / GROW + F.coalesce(value, F.lit(0))).alias(f"{out}_top"))
        sums.append((F.col(f"__w_{out}") / GROW + F.col(value).isNotNull().cast("int")).alias(f"{out}_weight"))
    last = df.groupBy("driver_id").agg(F.max_by(F.struct("season", points, *streaks, *sums), F.struct(*ORDER)).alias("l"))
    tail = _last(rows, "driver_id", list(TAIL), FORM_RACES)
    return null_safe_join(tail, last.select("driver_id", "l.*"), ["driver_id"])


def _step(new: DataFrame, state: dict[str, DataFrame]) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Gold rows of the new rounds, and the state of the keys they touch."""
    hot = hot_groups(new, RACE)
    rows = new.withColumn("__new", F.lit(True)).unionByName(
        _tails(state["driver"], new, "driver_id").withColumn("__new", F.lit(False)), allowMissingColumns=True)
    df = gold.targets(gold.rolling_form(rows).filter("__new").drop("__new"))

    visit = state["visit"].withColumnsRenamed({c: f"__{c}" for c in _visit_sums(F.lit(0))})
    df = null_safe_join(df, visit, KEYS["visit"])
    own = {f"__own_{c}": v for c, v in _visit_sums(F.col("position")).items()}
    df = expanding(df, KEYS["visit"], ORDER, own, hot=PER_DRIVER)
    total = {c: F.coalesce(f"__own_{c}", F.lit(0)) + F.coalesce(f"__{c}", F.lit(0)) for c in _visit_sums(F.lit(0))}
    df = df.select(
        "*", ratio(total["place_sum"], total["place_count"]).alias("circuit_avg_position"),
        total["visits"].alias("circuit_races_count"), total["wins"].alias("driver_circuit_wins"),
        total["podiums"].alias("driver_circuit_podiums"),
    ).drop(*own, *[f"__{c}" for c in total])

    df = _before(df, state["driver"])

    teams = form.team_races(new, "constructor_id", ORDER, "points")
    teams = teams.unionByName(_tails(state["team"], new, "constructor_id"))
    team_form = form.form_over_races(teams, "constructor_id", ORDER, "constructor_rolling_points", TEAM_RACES)
    df = left_enrich(df, team_form, ["constructor_id", *ORDER], hot=hot)

    moments = gold.race_moments(new).unionByName(
        null_safe_join(state["circuit"], new.select("circuit_id").distinct(), ["circuit_id"], "left_semi"))
    df = calendar_join(df, gold.spread_of(gold.moments_before(moments)), ["circuit_id", *RACE])
    df = df.fillna({"circuit_dnf_rate": gold.DEFAULT_DNF_RATE, "circuit_chaos_index": gold.DEFAULT_CHAOS})
    # Read twice below: by the features and by the state.
    df = materialised(df, "gold-step")

    sums = {c: v for c, v in _visit_sums(F.col("position")).items()}
    add = {"sum": F.sum, "count": F.count}
    visits = new.groupBy(*KEYS["visit"]).agg(*[F.coalesce(add[k](v), F.lit(0)).cast("long").alias(c) for c, (k, v) in sums.items()])
    held = null_safe_join(state["visit"], visits, KEYS["visit"], "left_semi")
    visits = visits.unionByName(held).groupBy(*KEYS["visit"]).agg(*[F.sum(c).alias(c) for c in sums])
    t = gold.circuit_moments(moments)
    mean = F.col("centre") + ratio(F.col("t__s"), F.col("t__c"))
    rest = F.greatest(F.col("t__q") - ratio(F.col("t__s") * F.col("t__s"), F.col("t__c")), F.lit(0.0))
    circuits = t.select("circuit_id", "last.*", F.col("t__d").alias("__d"), F.col("t__n").alias("__n"), mean.alias("__m"),
                        rest.alias("__v"), F.col("t__c").alias("__c"))
    after = {
        "driver": _driver_after(df, rows), "visit": visits, "circuit": circuits,
        "team": _last(teams, "constructor_id", [*ORDER, "__sum", "__count"], TEAM_RACES),
    }
    # The field, with stops and qualifying, comes from the race alone.
    hidden = [f"__{s}_{out}" for out in MEANS for s in ("t", "w")]
    out = gold.field_context(_within_race(df.drop(*hidden), hot), df)
    return out.drop(*gold.LEAKY), after


def rounds_after(df: DataFrame, last: Row | None) -> DataFrame:
    """The rounds after the last one; the season alone is compared as well, so that files of old seasons are pruned."""
    if last is None:
        return df.filter("season IS NOT NULL AND round IS NOT NULL")
    later = (F.col("season") > last["season"]) | ((F.col("season") == last["season"]) & (F.col("round") > last["round"]))
    return df.filter((F.col("season") >= last["season"]) & later)


def last_round(spark: SparkSession, store: str) -> Row | None:
    """The last version of a store as (season, round, version)."""
    done = read_glob(spark, f"{store}/last", "season bigint, round bigint, version bigint")
    return done.orderBy(F.col("version").desc()).first()


def _late(df: DataFrame, store: str, last: Row) -> int:
    """Rows of the last season, up to its last round, that have no gold row."""
    season = df.filter((F.col("season") == last["season"]) & (F.col("round") <= last["round"]))
    known = gold_rows(df.sparkSession, store).filter(F.col("season") == last["season"])
    return null_safe_join(season, known.select(*RACE, "driver_id"), [*RACE, "driver_id"], "left_anti").count()


def gold_rows(spark: SparkSession, store: str) -> DataFrame:
    """All gold rows of a store; versions that were not finished do not count."""
    last = last_round(spark, store)
    if last is None:
        raise ValueError(f"{store} holds no rounds yet")
    rows = spark.read.option("basePath", f"{store}/gold").parquet(f"{store}/gold")
    return rows.filter(F.col("version") <= last["version"]).drop("version")


def refresh_gold(df: DataFrame, store: str, step_rounds: int = STEP_ROUNDS) -> DataFrame | None:
    """Add the rounds of `df` that come after those in the store, and return all gold rows (None: no rounds at all).

    `df` is the race master with one row per driver and race; points are taken
    as doubles. New rounds are taken in steps of at most `step_rounds`, each
    one version: gold rows, state, and the last round, whose write makes the
    version count, so a call that fails may be repeated. Rows without season
    or round are not taken. Rounds that come late are not folded in; those of
    the season of the last round are reported as a warning.
    """
    if not 1 <= step_rounds <= STEP_ROUNDS:
        raise ValueError(f"a step takes 1 to {STEP_ROUNDS} rounds")
    spark = df.sparkSession
    df = df.withColumn("points", F.col("points").cast("double"))
    schemas = _schemas(df)
    last = last_round(spark, store)
    if last is not None and (late := _late(df, store, last)):
        warnings.warn(f"{late} rows belong to rounds before the last one and were not added", stacklevel=2)
    new = materialised(rounds_after(df, last), "new-rounds")
    # One row per round of the calendar.
    place = F.row_number().over(Window.orderBy(*RACE))
    rounds = new.select(*RACE).distinct().select(*RACE, place.alias("n"), F.count(F.lit(1)).over(Window.partitionBy()).alias("all"))
    ends = rounds.filter((F.col("n") % step_rounds == 0) | (F.col("n") == F.col("all"))).orderBy("n").collect()
    version = None if last is None else last["version"]
    for end in ends:
        upto = (F.col("season") < end["season"]) | ((F.col("season") == end["season"]) & (F.col("round") <= end["round"]))
        state = _state(spark, store, schemas, version)
        rows, after = _step(rounds_after(new, last).filter(upto), state)
        version = 0 if version is None else version + 1
        rows.write.mode("overwrite").partitionBy("season").parquet(f"{store}/gold/version={version}")

        def write(name: str) -> None:
            kept = null_safe_join(state[name], after[name], KEYS[name], "left_anti")
            kept.unionByName(after[name]).write.mode("overwrite").parquet(f"{store}/{name}/version={version}")

        # Four small jobs that do not wait for each other.
        with ThreadPoolExecutor(len(after)) as pool:
            list(pool.map(write, after))
        last = end
        mark = spark.createDataFrame([(end["season"], end["round"])], "season bigint, round bigint")
        mark.coalesce(1).write.mode("overwrite").parquet(f"{store}/last/version={version}")
    return None if last is None else gold_rows(spark, store)
