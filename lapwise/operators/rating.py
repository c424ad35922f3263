"""Pairwise rating over a sequence of contests.

Each entrant meets every other entrant of a contest; the rating moves by the
mean of K * (result - expected). Two modes:

* "sequential": entrants are updated one after the other in finishing order,
  so later ones meet ratings already changed in the same contest. Inside a
  contest this is a chain by definition.
* "simultaneous": all entrants are updated from the ratings before the
  contest. The result does not depend on any order inside a contest.

No pairs are formed. The sum of expected scores against a field, as a curve over
the own rating, is held at a few fixed ratings (a Chebyshev grid) and read off
for each entrant, so both modes are linear in the field. In the sequential mode
the curve moves with every entrant.

A universe (a competition) with few rows is folded in one task. Larger ones run
contest after contest. Simultaneous: what a contest does to an entrant follows
from their own rating and the curve, so entrants stay in blocks with all their
contests, and a contest is one job that adds up the curve; ratings are never
shuffled. Sequential: ratings are kept in a table, and a field is taken in blocks
of the finishing order, which hand on the curve. All ways give the same ratings.

`refresh_ratings` keeps versions of the ratings of every universe, so that new
contests are folded onto the latest version and old ones are not read again.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import partial, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapwise.operators.groups import calendar_join, group_stats, left_enrich
from lapwise.operators.ordered import BOUNDED, expanding, hot_groups, null_safe_join, split_hot, with_position
from lapwise.session import materialised, shared_dir
from lapwise.sources.scan import read_glob

# Step size, starting rating, rating scale.
K_FACTOR = 32.0
START = 1500.0
SCALE = 400.0

# Rows of a universe that one task folds (a worker holds about 250 bytes of each), and rows of a field in one block of a
# sequential contest, which is a chain, so that more steps gain little.
MAX_ROWS = {"sequential": 2_000_000, "simultaneous": 500_000}
BLOCK_ROWS = 1_000_000

# The expected-score curve is analytic within pi * 400 / ln 10 = 546 points of the
# real axis, so 16 nodes on cells of 200 points leave an error below 1e-14 per opponent.
CELL = 200.0
NODES = 16
ANGLES = np.pi * (np.arange(NODES) + 0.5) / NODES
# Entrants whose scores at all nodes are taken at a time.
CHUNK = 1 << 14
# Contests after which the ratings of the blocks are stored; a job repeats those since then.
STORED_STEPS = 16


class ScoreCurve:
    """Sums of expected scores against a field, at the nodes of the cells in which ratings are read."""

    def __init__(self, cells: np.ndarray, sums: np.ndarray):
        self.cells, self.sums = cells, sums
        self.nodes = ((cells[:, None] + 0.5) * CELL + np.cos(ANGLES) * CELL / 2).ravel()

    @staticmethod
    def of(ratings: np.ndarray, cells: np.ndarray | None = None) -> ScoreCurve:
        """The curve of a field, in the cells that it reaches itself unless others are given."""
        cells = np.unique(np.floor(ratings / CELL)) if cells is None else cells
        curve = ScoreCurve(cells, np.zeros(len(cells) * NODES))
        values, counts = np.unique(ratings, return_counts=True)
        for low in range(0, len(values), CHUNK):
            curve.sums += counts[low : low + CHUNK] @ curve.scores(values[low : low + CHUNK, None])
        return curve

    def scores(self, rating: float | np.ndarray) -> np.ndarray:
        """What the nodes expect against `rating`."""
        return 1.0 / (1.0 + 10.0 ** ((rating - self.nodes) / SCALE))

    def at(self, ratings: np.ndarray) -> np.ndarray:
        """Expected scores of `ratings` against the field less themselves, which is one half."""
        cell = np.floor(ratings / CELL)
        x = np.clip((ratings - (cell + 0.5) * CELL) / (CELL / 2), -1.0, 1.0)
        order = np.arange(NODES)
        weights = np.where(order == 0, 1.0, 2.0) / NODES
        sums = self.sums.reshape(-1, NODES)[np.searchsorted(self.cells, cell)]
        series = np.cos(order[:, None] * ANGLES) * weights[:, None]
        return np.einsum("nm,nm->n", sums @ series.T, np.cos(np.arccos(x)[:, None] * order)) - 0.5


def _contest_ratings(ahead: np.ndarray, rating: np.ndarray, n: int, k: float, sequential: bool, curve: ScoreCurve) -> np.ndarray:
    """Ratings after one contest of n entrants; `ahead` counts those strictly behind. Sequential entries are in finishing order."""
    if n < 2:
        return rating
    if not sequential:
        return np.concatenate([
            rating[low : low + CHUNK] + k * (ahead[low : low + CHUNK] - curve.at(rating[low : low + CHUNK])) / (n - 1)
            for low in range(0, len(rating), CHUNK)
        ])
    now = rating.copy()
    for i, old in enumerate(rating):
        now[i] = old + k * (ahead[i] - curve.at(rating[i : i + 1])[0]) / (n - 1)
        curve.sums += curve.scores(now[i]) - curve.scores(old)
    return now


def _fold(
    rows: pd.DataFrame, start: pd.DataFrame, order: list[str], entity: str, rank: str, k: float, sequential: bool
) -> pd.DataFrame:
    """All contests of one universe in order: each entrant's rating before and after."""
    ratings: dict = dict(zip(start[entity], start["rating"]))
    rows = rows.sort_values([*order, rank, entity], na_position="last", kind="stable").reset_index(drop=True)
    before, after = np.empty(len(rows)), np.empty(len(rows))
    contest = rows.groupby(order, sort=False, dropna=False).ngroup().to_numpy()
    for index in np.split(np.arange(len(rows)), np.flatnonzero(np.diff(contest)) + 1):
        names = rows[entity].to_numpy()[index]
        old = np.array([ratings.get(e, START) for e in names])
        ranks = rows[rank].to_numpy(dtype=float)[index]
        done = ~np.isnan(ranks)
        new = old.copy()
        if done.any():
            # Rows are sorted by rank, so those behind come after.
            ahead = done.sum() - np.searchsorted(ranks[done], ranks[done], side="right")
            new[done] = _contest_ratings(ahead, old[done], int(done.sum()), k, sequential, ScoreCurve.of(old[done]))
        before[index], after[index] = old, new
        ratings.update(zip(names, new))
    return rows.assign(rating=before, new_rating=after)


def rate(
    df: DataFrame, universe: Sequence[str], order: Sequence[str], entity: str, rank: str, k: float = K_FACTOR,
    mode: str = "sequential", max_rows: int | None = None, start: DataFrame | None = None, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Ratings before (rating) and after (new_rating) each contest, as (universe, order, entity, rating, new_rating).

    `df` has one row per universe, contest and entrant; a null `rank` counts for
    nothing. `start` holds ratings (universe, entity, rating) from before the
    first contest; others begin at 1500.
    """
    if mode not in ("sequential", "simultaneous"):
        raise ValueError(f"unknown mode {mode}")
    universe, order_ = list(universe), list(order)
    df = df.select(*universe, *order_, entity, rank)
    state = df.select(*universe, entity).schema.add("rating", "double")
    start = df.sparkSession.createDataFrame([], state) if start is None else start.select(*universe, entity, "rating")
    sequential = mode == "sequential"
    max_rows = MAX_ROWS[mode] if max_rows is None else max_rows
    small, large = split_hot(df, universe, hot_groups(df, universe, F.count(F.lit(1)), max_rows))
    parts = []
    if small is not None:
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", rating double, new_rating double"

        def fold(rows: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
            return _fold(rows, held, order_, entity, rank, k, sequential)

        # Only the universes that have contests here.
        held = null_safe_join(start, small.select(*universe).distinct(), universe, "left_semi")
        parts.append(small.groupBy(*universe).cogroup(held.groupBy(*universe)).applyInPandas(fold, schema).drop(rank))
    if large is not None and sequential:
        parts.append(_rate_by_contest(large, start, universe, order_, entity, rank, k, block_rows))
    elif large is not None:
        parts.append(_rate_in_blocks(large, start, universe, order_, entity, rank, k))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def elo(
    df: DataFrame, universe: Sequence[str], order: Sequence[str], entity: str, rank: str, k: float = K_FACTOR,
    mode: str = "sequential", max_rows: int | None = None, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Rating of each entrant before each contest, as (universe, order, entity, rating); see `rate`."""
    return rate(df, universe, order, entity, rank, k, mode, max_rows, block_rows=block_rows).drop("new_rating")


def refresh_ratings(
    df: DataFrame, store: str, universe: Sequence[str], order: Sequence[str], entity: str, rank: str, k: float = K_FACTOR,
    mode: str = "sequential", max_rows: int | None = None,
) -> DataFrame:
    """Fold the contests of `df` that come after those in the store, and return the whole history like `elo`.

    Every call that finds new contests writes one version: their history, and
    the ratings and the last contest of every universe after them. The second
    is written last and makes the version count, so a call that fails changes
    nothing and may be repeated. Contests that come late, before a universe's
    last one, are not folded in; they are reported as a warning. Contests
    without a date are not taken.
    """
    spark = df.sparkSession
    universe, order_ = list(universe), list(order)
    named = lambda columns, extra: ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*columns).schema) + extra
    row_schema = named([*universe, *order_, entity], ", rating double, new_rating double, version bigint")
    state_schema = named([*universe, entity], ", rating double, version bigint")
    last_schema = named([*universe, *order_], ", version bigint")
    done = read_glob(spark, f"{store}/last", last_schema)
    version = done.agg(F.max("version")).first()[0]
    history = read_glob(spark, f"{store}/history", row_schema).filter(F.col("version") <= (-1 if version is None else version))
    state = read_glob(spark, f"{store}/state", state_schema).filter(F.col("version") == version).drop("version")
    # The last contest of a universe: one row for each.
    last = done.filter(F.col("version") == version).select(*universe, F.struct(*order_).alias("__last"))
    dated = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in order_])
    rows = null_safe_join(df.select(*universe, *order_, entity, rank).filter(dated), last, universe)
    new = rows.filter(F.col("__last").isNull() | (F.struct(*order_) > F.col("__last"))).drop("__last")
    known = [*universe, *order_, entity]
    late = null_safe_join(rows.filter(F.struct(*order_) <= F.col("__last")), history.select(*known), known, "left_anti").count()
    if late:
        warnings.warn(f"{late} rows belong to contests before the last rated one and were not rated", stacklevel=2)
    new = materialised(new, "new-contests")
    if not new.isEmpty():
        number = 0 if version is None else version + 1
        rated = rate(new, universe, order_, entity, rank, k, mode, max_rows, state)
        rated.write.mode("overwrite").parquet(f"{store}/history/version={number}")
        rated = spark.read.schema(rated.schema).parquet(f"{store}/history/version={number}")
        moved = rated.groupBy(*universe, entity).agg(F.max_by("new_rating", F.struct(*order_)).alias("rating"))
        kept = null_safe_join(state, moved, [*universe, entity], "left_anti")
        kept.unionByName(moved).write.mode("overwrite").parquet(f"{store}/state/version={number}")
        latest = new.groupBy(*universe).agg(F.max(F.struct(*order_)).alias("__last")).unionByName(last)
        latest = latest.groupBy(*universe).agg(F.max("__last").alias("l")).select(*universe, "l.*")
        latest.write.mode("overwrite").parquet(f"{store}/last/version={number}")
        history = read_glob(spark, f"{store}/history", row_schema).filter(F.col("version") <= number)
    return history.select(*known, "rating")


def latest_ratings(spark: SparkSession, store: str, schema: str) -> DataFrame:
    """The ratings after the last version of a store, under `schema` (universe, entity, rating)."""
    state = read_glob(spark, f"{store}/state", schema + ", version bigint")
    last = read_glob(spark, f"{store}/last", "version bigint").agg(F.max("version")).first()[0]
    return state.filter(F.col("version") == last).drop("version")


def _sequential_contest(
    field: DataFrame, contest: list[str], entity: str, rank: str, k: float, block_rows: int
) -> DataFrame:
    """New ratings of one contest's field, entrant after entrant in blocks of the finishing order.

    A block's task gets the curve that the block before it left; a curve has a
    few numbers for each 200 points that ratings spread over.
    """
    ranked = field.filter(F.col(rank).isNotNull())
    counts = ranked.groupBy(*contest, rank).agg(F.count(F.lit(1)).alias("__c"))
    counts = expanding(counts, contest, [rank], {"__reached": ("sum", F.col("__c"))}, through_current=True)
    placed = group_stats(ranked, contest, {"__n": F.count(F.lit(1))}, calendar=True)
    placed = null_safe_join(placed, counts.select(*contest, rank, "__reached"), [*contest, rank])
    placed = with_position(placed, contest, [rank, entity], "__at")
    placed = materialised(placed.withColumn("__block", F.floor((F.col("__at") - 1) / block_rows)), "blocks", "__block")
    last = placed.agg(F.max("__block")).first()[0]
    # One row per contest: its cells, each with the sums at its nodes.
    sums = F.array(F.col("__cell").cast("double"), *[F.col(f"__f{i}") for i in range(NODES)])
    curve = _curve_sums(ranked, contest).groupBy(*contest).agg(F.flatten(F.array_sort(F.collect_list(sums))).alias("__curve"))
    names = [*field.columns, "new_rating", "__curve"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in field.schema) + ", new_rating double, __curve array<double>"

    def update(rows: pd.DataFrame, curves: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame(columns=names)
        table = np.asarray(curves["__curve"].iloc[0], dtype=float).reshape(-1, NODES + 1)
        own = ScoreCurve(table[:, 0].copy(), table[:, 1:].ravel().copy())
        rows = rows.sort_values("__at").reset_index(drop=True)
        ahead, n = (rows["__n"] - rows["__reached"]).to_numpy(dtype=float), int(rows["__n"].iloc[0])
        new = _contest_ratings(ahead, rows["rating"].to_numpy(dtype=float), n, k, True, own)
        out = rows.assign(new_rating=new, __curve=None)
        out.at[0, "__curve"] = np.concatenate([table[:, :1], own.sums.reshape(-1, NODES)], axis=1).ravel()
        return out[names]

    parts = []
    for block in range(0 if last is None else last + 1):
        rows = placed.filter(F.col("__block") == block).drop("__block")
        done = materialised(rows.groupBy(*contest).cogroup(curve.groupBy(*contest)).applyInPandas(update, schema), "block")
        curve = done.filter("__curve IS NOT NULL").select(*contest, "__curve")
        parts.append(done.drop("__curve"))
    idle = field.filter(F.col(rank).isNull()).withColumn("new_rating", F.col("rating"))
    return reduce(DataFrame.unionByName, parts, idle)


def _calendar(df: DataFrame, universe: list[str], order: list[str]) -> DataFrame:
    """(universe, order, step): the contests of every universe, numbered from 1."""
    contests = df.select(*universe, *order).distinct()
    # One row per universe and contest of the calendar.
    # A contest without a date comes last, as in `_fold`.
    step = F.row_number().over(Window.partitionBy(*universe).orderBy(*[F.col(c).asc_nulls_last() for c in order])).alias("step")
    return materialised(contests.select("*", step), "calendar")


def _rate_by_contest(
    df: DataFrame, state: DataFrame, universe: list[str], order: list[str], entity: str, rank: str, k: float, block_rows: int
) -> DataFrame:
    """One step per contest of every universe: step t holds the t-th of each. The calendar bounds the steps.

    A step is one job for the ratings to meet the entrants, and those of `_sequential_contest`.
    """
    # Read several times.
    df = materialised(df, "contest-rows")
    contests = _calendar(df, universe, order)
    steps = contests.agg(F.max("step")).first()[0] or 0
    # One folder per step, so that each job reads its own contests only; several tasks write a large step.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slot = F.pmod(F.xxhash64(entity), F.lit(max(1, 4 * parts // max(steps, 1))))
    df = materialised(calendar_join(df, contests, [*universe, *order]).repartition(F.col("step"), slot), "contests", "step")
    key, spark = [*universe, entity], df.sparkSession
    # Every step writes one folder of the result, which is read back in one scan.
    results = shared_dir(spark, "contest-ratings")
    for t in range(1, steps + 1):
        held = materialised(_meet(df.filter(F.col("step") == t).drop("step"), state, key), "ratings", "__in")
        field = held.filter("__in").drop("__in")
        after = _sequential_contest(field, [*universe, *order], entity, rank, k, block_rows)
        after.write.parquet(f"{results}/step={t}")
        after = spark.read.schema(after.schema).parquet(f"{results}/step={t}")
        moved = after.select(*key, F.col("new_rating").alias("rating"))
        state = held.filter("NOT __in").select(*key, "rating").unionByName(moved)
    return spark.read.parquet(results).select(*universe, *order, entity, "rating", "new_rating")


# The curves of contests, by (number of the universe, step).
Curves = Mapping[tuple[int, int], ScoreCurve]


@dataclass
class Entrants:
    """A block of entrants: number of the universe and rating of each, and their visits to contests by step.

    A visit has the place of the entrant, the ranked field and those behind; both are NaN without a rank.
    """

    universe: np.ndarray
    rating: np.ndarray
    step: np.ndarray
    who: np.ndarray
    field: np.ndarray
    ahead: np.ndarray

    @staticmethod
    def of(universe: np.ndarray, rating: np.ndarray, sizes: np.ndarray, step: np.ndarray, field: np.ndarray, ahead: np.ndarray) -> tuple[Entrants, np.ndarray]:
        """The block of entrants with `sizes` visits each, and the order it has put the visits into."""
        by_step = np.argsort(step, kind="stable")
        who = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        return Entrants(universe, rating, step[by_step], who[by_step], field[by_step], ahead[by_step]), by_step

    def fields(self, step: int) -> Iterator[tuple[int, np.ndarray]]:
        """(universe, visits) of the ranked entrants of each contest of a step."""
        low, high = np.searchsorted(self.step, [step, step + 1])
        visits = np.arange(low, high)[~np.isnan(self.field[low:high])]
        universe = self.universe[self.who[visits]]
        for u in np.unique(universe).tolist():
            yield u, visits[universe == u]

    def moved(self, rating: np.ndarray, step: int, curves: Curves, k: float) -> np.ndarray:
        """The ratings after the contests of a step, from those before."""
        rating = rating.copy()
        for u, visits in self.fields(step):
            who = self.who[visits]
            rating[who] = _contest_ratings(self.ahead[visits], rating[who], int(self.field[visits[0]]), k, False, curves[u, step])
        return rating

    def stored(self, first: int, step: int, curves: Curves, k: float) -> Entrants:
        """The block with the ratings before `step` in place of those before `first`, without the visits between."""
        rating = reduce(lambda r, t: self.moved(r, t, curves, k), range(first, step), self.rating)
        later = self.step >= step
        return replace(self, rating=rating, step=self.step[later], who=self.who[later], field=self.field[later], ahead=self.ahead[later])


# Of some blocks: sums at the nodes of each universe's cells, and the cells that its ratings may be in after the step.
Found = tuple[dict[int, np.ndarray], dict[int, set[float]]]


def _found(first: int, step: int, curves: Curves, cells: Mapping[int, np.ndarray], k: float, blocks: Iterator[Entrants]) -> Iterator[Found]:
    """What the blocks of a partition add to the curves of a step; `first` is the step that their ratings are from."""
    sums: dict[int, np.ndarray] = {}
    reached: dict[int, set[float]] = {}
    for block in blocks:
        rating = reduce(lambda r, t: block.moved(r, t, curves, k), range(first, step), block.rating)
        for u, visits in block.fields(step):
            own = ScoreCurve.of(rating[block.who[visits]], cells[u]).sums
            sums[u] = sums[u] + own if u in sums else own
        # A contest moves a rating by less than k.
        low, high = (np.floor((rating + d) / CELL) for d in (-abs(k), abs(k)))
        spans = np.unique(np.stack([block.universe, low, high]), axis=1) if len(rating) else np.empty((3, 0))
        for u, a, b in spans.T.tolist():
            reached.setdefault(int(u), set()).update(np.arange(a, b + 1).tolist())
    yield sums, reached


def _added(a: Found, b: Found) -> Found:
    sums = {u: a[0].get(u, 0.0) + b[0].get(u, 0.0) for u in a[0].keys() | b[0].keys()}
    return sums, {u: a[1].get(u, set()) | b[1].get(u, set()) for u in a[1].keys() | b[1].keys()}


def _visits(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Number of visits of each entrant of an Arrow batch, and step, field and ahead of all visits."""
    flat = column.flatten()
    values = [flat.field(c).to_numpy(zero_copy_only=False) for c in ("step", "__n", "__ahead")]
    return np.diff(column.offsets.to_numpy()), values


def _rate_in_blocks(
    df: DataFrame, start: DataFrame, universe: list[str], order: list[str], entity: str, rank: str, k: float
) -> DataFrame:
    """Simultaneous contests: one job each, which adds up the curves of the t-th contest of every universe.

    The entrants stay where they are: a job brings the ratings of a block up to date
    by the curves before. A curve has a few numbers for each 200 points that the
    ratings of a universe spread over, and only curves reach the driver. Their ratings
    are stored with the blocks every `STORED_STEPS` contests.
    """
    spark = df.sparkSession
    # Read several times.
    df = materialised(df, "contest-rows")
    contests = _calendar(df, universe, order)
    # One row for each of the large universes.
    numbers = contests.select(*universe).distinct()
    numbers = numbers.withColumn("__u", F.row_number().over(Window.orderBy(*universe)) - 1)
    contests = materialised(calendar_join(contests, numbers, universe), "calendar")
    steps = contests.agg(F.max("step")).first()[0] or 0
    rows = calendar_join(_with_ahead(df, [*universe, *order], rank), contests, [*universe, *order])
    visit = F.struct("step", F.col("__n").cast("double").alias("__n"), F.col("__ahead").cast("double").alias("__ahead"), *order)
    # An entrant has one visit for each contest of the calendar at most.
    entrants = rows.groupBy("__u", *universe, entity).agg(F.array_sort(F.collect_list(visit)).alias("__visits"))
    entrants = null_safe_join(entrants, start, [*universe, entity]).withColumn("rating", F.coalesce("rating", F.lit(START)))
    entrants = materialised(entrants, "entrants")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, values = _visits(batch.column(2))
            block, _ = Entrants.of(*[batch.column(i).to_numpy() for i in (0, 1)], sizes, *values)
            yield pa.RecordBatch.from_pydict({c: pa.array([v.tobytes()], pa.binary()) for c, v in block.__dict__.items()})

    kinds = {"universe": np.int32, "rating": np.float64, "step": np.int32, "who": np.int32, "field": np.float64, "ahead": np.float64}
    packed = materialised(
        entrants.select("__u", "rating", "__visits").mapInArrow(pack, ", ".join(f"{c} binary" for c in kinds)), "entrant-blocks")
    first_blocks = packed.rdd.map(lambda row: Entrants(**{c: np.frombuffer(row[c], kind) for c, kind in kinds.items()}))
    first_blocks.persist(StorageLevel.MEMORY_AND_DISK)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark, "rounds"))

    blocks, first = first_blocks, 1
    curves: dict[tuple[int, int], ScoreCurve] = {}
    recent: dict[tuple[int, int], ScoreCurve] = {}
    # Step 0 has no contests: it finds the cells of the starting ratings.
    cells: dict[int, np.ndarray] = {}
    for t in range(steps + 1):
        sums, reached = blocks.mapPartitions(partial(_found, first, t, recent, cells, k)).treeReduce(_added)
        recent = recent | {(u, t): ScoreCurve(cells[u], own) for u, own in sums.items()}
        curves.update(recent)
        cells = {u: np.array(sorted(c)) for u, c in reached.items()}
        if t + 1 - first >= STORED_STEPS and t < steps:
            older, blocks = blocks, _with_ratings(blocks, first, t + 1, recent, k)
            if older is not first_blocks:
                older.unpersist()
            first, recent = t + 1, {}
    for held in (first_blocks, blocks):
        held.unpersist()

    known = spark.sparkContext.broadcast(curves)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, values = _visits(batch.column("__visits"))
            block, by_step = Entrants.of(batch.column("__u").to_numpy(), batch.column("rating").to_numpy(), sizes, *values)
            rating, before, after = block.rating, np.empty(len(by_step)), np.empty(len(by_step))
            for t in np.unique(block.step).tolist():
                at = slice(*np.searchsorted(block.step, [t, t + 1]))
                before[by_step[at]] = rating[block.who[at]]
                rating = block.moved(rating, t, known.value, k)
                after[by_step[at]] = rating[block.who[at]]
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            made = {c: pa.ListArray.from_arrays(offsets, pa.array(v)) for c, v in (("__before", before), ("__after", after))}
            batch = batch.select([*universe, entity, "__visits"])
            yield pa.RecordBatch.from_arrays([*batch.columns, *made.values()], names=[*batch.schema.names, *made])

    schema = entrants.select(*universe, entity, "__visits").schema
    for c in ("__before", "__after"):
        schema = schema.add(c, T.ArrayType(T.DoubleType()))
    rated = entrants.mapInArrow(fold, schema).select(*universe, entity, F.explode(F.arrays_zip("__visits", "__before", "__after")).alias("__v"))
    rated = rated.select(
        *universe, *[F.col("__v.__visits")[c].alias(c) for c in order], entity, F.col("__v.__before").alias("rating"),
        F.col("__v.__after").alias("new_rating"))
    return materialised(rated, "contest-ratings")


def _with_ratings(blocks: RDD, first: int, step: int, curves: Curves, k: float) -> RDD:
    """The blocks with the ratings before `step`, checkpointed."""
    out = blocks.map(lambda block: block.stored(first, step, curves, k)).persist(StorageLevel.MEMORY_AND_DISK)
    out.checkpoint()
    out.count()
    return out


def _meet(field: DataFrame, state: DataFrame, key: list[str]) -> DataFrame:
    """The entrants of a step with their ratings (`__in`), and the ratings of all others, as one table."""
    names = {c: f"__held_{c}" for c in key}
    entrants, state = field.withColumn("__in", F.lit(True)), state.withColumnsRenamed(names)
    match = reduce(lambda a, b: a & b, [entrants[c].eqNullSafe(state[names[c]]) for c in key])
    both = entrants.join(state, match, "full")
    return both.select(
        *[F.when(F.col("__in"), F.col(c)).otherwise(F.col(names[c])).alias(c) if c in key else c for c in field.columns],
        F.coalesce("rating", F.lit(START)).alias("rating"), F.coalesce("__in", F.lit(False)).alias("__in"))


def _with_ahead(df: DataFrame, contest: list[str], rank: str) -> DataFrame:
    """Adds the ranked entrants of the contest (`__n`) and those strictly behind each (`__ahead`); null without a rank."""
    ranked = df.filter(F.col(rank).isNotNull())
    # Entrants strictly behind: field size minus those with the same or a better rank.
    counts = ranked.groupBy(*contest, rank).agg(F.count(F.lit(1)).alias("__c"))
    counts = expanding(counts, contest, [rank], {"__reached": ("sum", F.col("__c"))}, through_current=True)
    out = group_stats(ranked, contest, {"__n": F.count(F.lit(1))}, calendar=True)
    out = null_safe_join(out, counts.select(*contest, rank, "__reached"), [*contest, rank])
    out = out.select(*df.columns, "__n", (F.col("__n") - F.col("__reached")).alias("__ahead"))
    return out.unionByName(df.filter(F.col(rank).isNull()), allowMissingColumns=True)


def _curve_sums(ranked: DataFrame, contest: list[str]) -> DataFrame:
    """(contest, __cell, __f0 ...): sums of expected scores against the field at the nodes of every occupied cell."""
    # Cells are 200 rating points wide, so a contest has a handful of them.
    cells = ranked.select(*contest, F.floor(F.col("rating") / CELL).alias("__cell")).distinct()
    pairs = calendar_join(ranked.select(*contest, "rating"), F.broadcast(cells), contest, "inner")
    # One power for each cell; the nodes of a cell differ from its center by fixed factors.
    pairs = pairs.withColumn("__power", F.pow(F.lit(10.0), (F.col("rating") - (F.col("__cell") + 0.5) * CELL) / SCALE))
    return pairs.groupBy(*contest, "__cell").agg(*[
        F.expr(f"sum(1D / (1D + __power * {10.0 ** (-math.cos(a) * CELL / 2 / SCALE)!r}D))").alias(f"__f{i}")
        for i, a in enumerate(ANGLES.tolist())
    ])


def _one_contest(field: DataFrame, contest: list[str], rank: str, k: float) -> DataFrame:
    """New ratings of the fields of contests, without forming pairs; a contest at a time of what `_rate_in_blocks` does."""
    keep = [c for c in field.columns if c not in ("__n", "__ahead")]
    if len(keep) == len(field.columns):
        field = _with_ahead(field, contest, rank)
    angles = ANGLES.tolist()
    coefficients = [
        F.expr("(" + " + ".join(f"__f{i} * {math.cos(m * a)!r}D" for i, a in enumerate(angles)) + f") * {(1.0 if m == 0 else 2.0) / NODES!r}D").alias(f"__q{m}")
        for m in range(NODES)
    ]
    curve = _curve_sums(field.filter(F.col(rank).isNotNull()), contest).select(*contest, "__cell", *coefficients)
    # A few rows for each contest of the step.
    out = calendar_join(field.withColumn("__cell", F.floor(F.col("rating") / CELL)), F.broadcast(curve), [*contest, "__cell"])
    out = out.withColumn("__angle", F.expr(f"acos(greatest(-1D, least(1D, (rating - (__cell + 0.5D) * {CELL}D) / {CELL / 2}D)))"))
    # The curve includes the entrant against themselves, which is one half.
    expected = F.expr(" + ".join(f"__q{m} * cos(__angle * {m}D)" for m in range(NODES)) + " - 0.5D")
    delta = F.when(F.col(rank).isNotNull() & (F.col("__n") > 1), k * (F.col("__ahead") - expected) / (F.col("__n") - 1)).otherwise(F.lit(0.0))
    return out.select(*keep, (F.col("rating") + delta).alias("new_rating"))


def against_field(
    df: DataFrame, ratings: DataFrame, contest: Sequence[str], entity: str, source: DataFrame | None = None
) -> DataFrame:
    """Join ratings back to the facts (default START) and compare with the mean of the contest.

    Facts and ratings are unique per contest and entrant; `source` may hold the facts' rows with less lineage.
    """
    key = [*contest, entity]
    named = ratings.select(*key, F.col("rating").alias("driver_elo"))

    def rated(rows: DataFrame) -> DataFrame:
        return left_enrich(rows, named, key, {"driver_elo": START}, BOUNDED)

    entries = rated((df if source is None else source).select(*key))
    out = group_stats(rated(df), list(contest), {"__mean": F.avg("driver_elo")}, calendar=True, source=entries)
    return out.withColumn("elo_vs_field", F.col("driver_elo") - F.col("__mean")).drop("__mean")
