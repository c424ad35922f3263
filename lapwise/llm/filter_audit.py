"""What each of several filters removes, in every order of applying them, and its Shapley share.

Filters may be applied in any order, but what is left depends only on the set
already applied. So all orders are paths through the lattice of subsets. Paths
are counted forward (orders that reach a state) and backward (orders that lead
from it to the end); an edge is one filter's step from a state to the next, and
what it removes, weighted by the paths through it and summed over its filter's
edges, is the Shapley share. Single orders read their steps from the same edges.

The corpus enters as counts of documents by the set of filters they fail, one
row per part and set, so all later work is as small as the number of parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapwise.llm.common import slices, text_or_empty
from lapwise.session import materialised

# The limits and marks of the five filters; filter E is for copies.
LETTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITALS_PERCENT = 2
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARKS = b"#$%&*|"
COPY = 1 << LETTERS.index("E")

COUNTS = ("n", "good", "toxic")


def text_failures(text: bytes, chars: int) -> int:
    """The set of filters A to D, as bits, that a text of so many code points fails."""
    # Bytes are split at the same six characters as words.
    words = text.split()
    capitals = len(text) - len(text.translate(None, CAPITALS))
    failed = (
        len(words) < MIN_WORDS,
        100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words),
        100 * capitals > MAX_CAPITALS_PERCENT * chars,
        len(text.translate(None, MARKS)) < len(text),
    )
    return sum(1 << k for k, f in enumerate(failed) if f)


def text_marks(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """(id, part, fails, digest): the text filters each row fails, and the SHA-256 of its whole text."""
    schema = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("part", T.StringType()),
        T.StructField("fails", T.IntegerType()), T.StructField("digest", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            chars = pa.compute.utf8_length(batch.column(2)).to_pylist()
            texts = batch.column(2).cast(pa.large_binary()).to_pylist()
            fails = pa.array(map(text_failures, texts, chars), pa.int32())
            digests = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), fails, digests], names=schema.names)

    part = text_or_empty(part_col).alias("part")
    rows = docs.select(F.col(id_col).alias("id"), part, text_or_empty(text_col).alias("text")).mapInArrow(run, schema)
    # Read twice below, by id and without one.
    return materialised(rows, "marks")


def failure_counts(marks: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(part, fails, n, good, toxic): rows by the set of filters they fail, the one for copies included.

    A row fails that one if its text is the text of a smaller id anywhere in the
    table; a null id is smaller than none and never fails by it. Rows are counted
    per text, part and label before equal texts meet, so what meets of a group of
    copies is a few rows for each part.
    """
    flag = lambda c: F.max((F.col(c) == 1).cast("long"))
    known = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("l_id"))
    known = known.agg(flag("quality").alias("good"), flag("toxic").alias("toxic"))
    named = marks.filter("id IS NOT NULL").join(known, F.col("id") == F.col("l_id"), "left").drop("l_id")
    named = named.fillna(0, ["good", "toxic"])
    cell = ["digest", "part", "fails", "good", "toxic"]
    named = named.groupBy("id", *cell).agg(F.count(F.lit(1)).alias("n"))
    # Of each cell: its rows, and its smallest id with the rows of that id.
    cells = named.groupBy(*cell).agg(F.sum("n").alias("n"), F.min(F.struct("id", "n")).alias("low"))
    first = F.min("low.id").over(Window.partitionBy("digest"))
    originals = F.when(F.col("low.id") == first, F.col("low.n")).otherwise(F.lit(0).cast("long"))
    cells = cells.withColumn("originals", originals).select(
        "part", "good", "toxic", F.explode(F.array(
            F.struct(F.col("fails"), F.col("originals").alias("n")),
            F.struct(F.col("fails").bitwiseOR(F.lit(COPY)).alias("fails"), (F.col("n") - F.col("originals")).alias("n")),
        )).alias("c"))
    cells = cells.select("part", "c.fails", "c.n", (F.col("good") * F.col("c.n")).alias("good"), (F.col("toxic") * F.col("c.n")).alias("toxic"))
    zero = F.lit(0).cast("long")
    nameless = marks.filter("id IS NULL").select("part", "fails", F.lit(1).cast("long").alias("n"), zero.alias("good"), zero.alias("toxic"))
    return cells.union(nameless).groupBy("part", "fails").agg(*[F.sum(c).alias(c) for c in COUNTS])


def lattice(n: int) -> tuple[list[tuple[int, int, int]], list[tuple[tuple[int, ...], int, int, int]]]:
    """Edges (state, filter, orders through it) of the subsets of n filters, and steps (order, step, state, filter) of all orders."""
    full = (1 << n) - 1
    reach, leave = [0] * (full + 1), [0] * (full + 1)
    reach[0] = leave[full] = 1
    edges = [(s, f) for s in range(full + 1) for f in range(n) if not s >> f & 1]
    for state, f in edges:
        reach[state | 1 << f] += reach[state]
    for state, f in reversed(edges):
        leave[state] += leave[state | 1 << f]
    steps = []
    for order in permutations(range(n)):
        state = 0
        for step, f in enumerate(order, 1):
            steps.append((order, step, state, f))
            state |= 1 << f
    return [(s, f, reach[s] * leave[s | 1 << f]) for s, f in edges], steps


def audit(counts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per part, order and step of the counts (part, fails, n, good, toxic); see `filter_audit`."""
    edges, steps = lattice(len(letters))
    spark = counts.sparkSession
    # Both lists depend on the number of filters alone.
    each = F.explode(F.array(*[
        F.struct(F.lit(s).alias("state"), F.lit(f).alias("filter"), F.lit(1 << f).alias("bit"), F.lit(p).cast("long").alias("paths"))
        for s, f, p in edges
    ]))
    rows = counts.select("part", "fails", *COUNTS, each.alias("e")).select("part", "fails", *COUNTS, "e.*")
    meets = (F.col("fails").bitwiseAND(F.col("state"))) == 0
    fails = (F.col("fails").bitwiseAND(F.col("bit"))) != 0

    def total(value: str, condition: Column) -> Column:
        return F.sum(F.when(condition, F.col(value)).otherwise(F.lit(0).cast("long")))

    rows = rows.groupBy("part", "state", "filter", "paths").agg(
        total("n", meets & ~fails).alias("kept"),
        total("n", meets & fails).alias("removed"),
        total("n", ~meets & fails).alias("redundant"),
        total("n", F.col("fails") == F.col("bit")).alias("unique_fails"),
        total("good", meets & fails).alias("good_lost"),
        total("toxic", meets & fails).alias("toxic_lost"),
    )
    through = F.sum(F.col("removed") * F.col("paths")).over(Window.partitionBy("part", "filter"))
    rows = rows.withColumn("shapley", through)
    named = [("".join(letters[k] for k in order), step, state, f) for order, step, state, f in steps]
    table = spark.createDataFrame(named, "filter_order string, step int, state int, filter int")
    rows = rows.join(F.broadcast(table), ["state", "filter"])
    return rows.select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def filter_audit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source"
) -> DataFrame:
    """One row per part, order of the filters and step: what the step's filter does there.

    `kept` rows are left after the step, `removed` ones go in it, `redundant`
    ones fail its filter but went before, `unique_fails` fail no other filter at
    all; `good_lost` and `toxic_lost` count removed rows with such a label, and
    `shapley` sums what the filter removes over all orders. A null text counts
    as empty, a null part as the empty string. Rows with equal ids and texts are
    originals together; rows with null ids have no labels and are no copies. Of
    several labels of an id, one good or toxic one is enough. Other columns are
    not read; an empty table gives no rows.
    """
    return audit(failure_counts(text_marks(docs, id_col, text_col, part_col), labels, id_col))


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
             min(doc_id) OVER (PARTITION BY text) AS first FROM d),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
             {'A': len(words) < 200, 'B': 100 * len(list_distinct(words)) < 50 * len(words),
              'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text),
              'D': regexp_matches(text, '[#$%&*|]'), 'E': doc_id > first} AS m
      FROM w LEFT JOIN l USING (doc_id)),
x AS (SELECT part, good, toxic, m.A AS a, m.B AS b, m.C AS c, m.D AS d, m.E AS e, count(*) AS n FROM f GROUP BY ALL),
y AS (SELECT part, n, n * good AS good, n * toxic AS toxic,
             CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END
             || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END AS failed FROM x),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (SELECT p.f || q.f || r.f || s.f || t.f AS filter_order FROM letter p, letter q, letter r, letter s, letter t
      WHERE len(list_distinct([p.f, q.f, r.f, s.f, t.f])) = 5),
step AS (SELECT filter_order, k AS step, filter_order[k] AS f, filter_order[1:k - 1] AS earlier FROM o, (SELECT unnest(range(1, 6)) AS k)),
seen AS (SELECT part, filter_order, step, f, n, good, toxic, failed, contains(failed, f) AS fails,
                translate(failed, earlier, '') = failed AS reached FROM step, y),
total AS (SELECT part, filter_order, step, f,
                 coalesce(sum(n) FILTER (WHERE reached AND NOT fails), 0) AS kept, coalesce(sum(n) FILTER (WHERE reached AND fails), 0) AS removed,
                 coalesce(sum(n) FILTER (WHERE fails AND NOT reached), 0) AS redundant, coalesce(sum(n) FILTER (WHERE failed = f), 0) AS unique_fails,
                 coalesce(sum(good) FILTER (WHERE reached AND fails), 0) AS good_lost,
                 coalesce(sum(toxic) FILTER (WHERE reached AND fails), 0) AS toxic_lost FROM seen GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM total
"""
