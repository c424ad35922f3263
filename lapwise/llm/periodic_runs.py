"""Maximal periodic runs of words, by Lyndon roots and longest common extensions.

Every run has a root that is the longest Lyndon word at its start in one of the
two orders of the alphabet (the order of symbols and its reverse). So the
longest Lyndon words of all positions, in both orders, are the candidates; each
is extended to both sides by a longest common extension, which the suffix trees
of the text and of its reversal answer in constant time.

A run of `least` words or more repeats itself for at least half of that, so its
words lie in word n-grams of that size that occur twice in the text. Trees are
built over the stretches covered by such n-grams, which hold every run whole.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapwise.llm.common import SPACES, slices, text_or_empty
from lapwise.llm.hashing import mix, ngrams
from lapwise.llm.suffix_tree import Extensions

LEAST_WORDS = 12
RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


def next_smaller(ranks: np.ndarray) -> np.ndarray:
    """For every suffix the next one of lower rank: the end of the longest Lyndon word at its start."""
    ranks = ranks.tolist()
    out = [len(ranks)] * len(ranks)
    open_: list[int] = []
    for i in range(len(ranks) - 1, -1, -1):
        rank = ranks[i]
        while open_ and ranks[open_[-1]] > rank:
            open_.pop()
        if open_:
            out[i] = open_[-1]
        open_.append(i)
    return np.array(out, np.int64)


def runs_of(codes: np.ndarray, least: int) -> np.ndarray:
    """(start, length, period) of the runs of `least` symbols or more, by start and period."""
    n = len(codes)
    if n < max(2, least):
        return np.empty((0, 3), np.int64)
    forward = Extensions(codes)
    ends = [next_smaller(forward.ranks()), next_smaller(forward.ranks_downward())]
    start = np.tile(np.arange(n), 2)
    period = np.concatenate(ends) - start
    right = start + period + forward(start, start + period)
    del forward
    backward = Extensions(codes[::-1])
    left = start - backward(n - start, n - start - period)
    found = np.stack([left, right - left, period], axis=1)
    return np.unique(found[found[:, 1] >= np.maximum(least, 2 * period)], axis=0)


def repeated_stretches(codes: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
    """Bounds of the stretches of `least` symbols or more that are covered by n-grams which occur twice."""
    size = -(-least // 2)
    if len(codes) < least:
        return
    grams, _ = ngrams(mix(codes.astype(np.uint64) + np.uint64(1)), np.zeros(len(codes), np.int8), size)
    order = np.argsort(grams)
    same = grams[order[1:]] == grams[order[:-1]]
    if not same.any():
        return
    # +1 where a repeated n-gram begins and -1 behind it; sums above 0 are covered.
    edge = np.zeros(len(codes) + 1, np.int64)
    twice = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
    edge[twice] += 1
    edge[twice + size] -= 1
    covered = np.concatenate([[False], np.cumsum(edge)[:-1] > 0, [False]])
    turns = np.flatnonzero(covered[1:] != covered[:-1])
    for low, high in zip(turns[::2].tolist(), turns[1::2].tolist()):
        if high - low >= least:
            yield low, high


def word_runs(words: list[bytes], least: int) -> np.ndarray:
    """(start, length, period) of the runs of words, by start and period."""
    if len(words) < least:
        return np.empty((0, 3), np.int64)
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    codes = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    found = []
    for low, high in repeated_stretches(codes, least):
        inside = runs_of(codes[low:high], least)
        inside[:, 0] += low
        found.append(inside)
    return np.concatenate(found) if found else np.empty((0, 3), np.int64)


def without_repeats(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not len(runs):
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(edge)[:-1] == 0).tolist()]


def periodic_runs(docs: DataFrame, least: int = LEAST_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, runs, collapsed.

    A run is a stretch of `least` words or more, and of two periods or more,
    that no word beside it prolongs; `runs` lists (start, length, period) by
    start and period, words counted from 0, the period the smallest. `collapsed`
    has the words that no run holds after its first period, with one space
    between. Words are runs of characters other than white space; they are
    compared exactly. A null or empty text, or one without words, has no runs
    and an empty `collapsed`. Null ids and repeated rows pass, other columns are
    not read, an empty table gives no rows. Whole texts; memory is some 700
    bytes for each word of a text's longest repeated stretch.
    """
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])
    runs_type = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            offsets, values, texts = [0], [], []
            for text in batch.column(1).cast(pa.large_binary()).to_pylist():
                # Bytes are split at the same six characters as words.
                words = text.split()
                runs = word_runs(words, least)
                values.append(runs)
                offsets.append(offsets[-1] + len(runs))
                texts.append(b" ".join(without_repeats(words, runs)))
            flat = np.concatenate(values)
            entries = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), entries).cast(runs_type)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), lists, pa.array(texts, pa.binary()).cast(pa.string())], names=[id_col, "runs", "collapsed"]
            )

    return docs.select(id_col, text_or_empty(text_col).alias("__text")).mapInArrow(run, schema)


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` (id, text) where each text whose id's CRC-32 h is divisible by 10 ends in a repeated stretch.

    With n words and g = floor(h / 10), each word i >= a = g % n becomes the
    word a + (i - a) % p, for p = 1 + floor((n - a) / (3 + g % 8)). Other texts,
    texts without words and those of null ids stay.
    """
    crc = F.crc32(F.col(id_col).cast("string"))
    rows = docs.select(id_col, F.col(text_col), F.when(crc % 10 == 0, F.filter(F.split(text_or_empty(text_col), SPACES), lambda w: w != "")).alias("__words"))
    rows = rows.withColumn("__n", F.size("__words")).withColumn("__g", F.floor(crc / 10))
    rows = rows.withColumn("__a", F.when(F.col("__n") > 0, F.col("__g") % F.col("__n")).cast("int"))
    rows = rows.withColumn("__p", (1 + F.floor((F.col("__n") - F.col("__a")) / (3 + F.col("__g") % 8))).cast("int"))
    tail = "flatten(array_repeat(slice(__words, __a + 1, __p), cast(ceil((__n - __a) / __p) AS INT)))"
    words = F.expr(f"concat(slice(__words, 1, __a), slice({tail}, 1, __n - __a))")
    return rows.select(id_col, F.when(F.col("__a").isNull(), F.col(text_col)).otherwise(F.array_join(words, " ")).alias(text_col))


def _sha(column: Column) -> Column:
    return F.sha2(column.cast("binary"), 256)


def run_digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per row of `periodic_runs`: the number of runs, the longest one, and digests of all runs and of `collapsed`.

    Of the longest runs the one with the smallest start, then period, is given;
    without runs its four columns are null.
    """
    order = F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period")))
    rows = found.select(id_col, "runs", "collapsed", F.array_min(order).alias("best"))
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    listed = F.concat(F.array_join(listed, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    length = -F.col("best.l")
    return rows.select(
        id_col,
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        length.alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(1000 * -best.l) div best.period").alias("exponent_milli"),
        _sha(listed).alias("runs_sha256"),
        _sha(F.col("collapsed")).alias("collapsed_sha256"),
    )


# CRC-32 bit by bit: 3988292384 is its reversed polynomial.
SQL = r"""
WITH c AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
  xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda crc, x: list_reduce(list_prepend(xor(crc, x), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda r, z: CASE WHEN r % 2 = 1 THEN xor(r >> 1, 3988292384::BIGINT) ELSE r >> 1 END)), 4294967295::BIGINT) AS h
  FROM documents),
k AS (SELECT doc_id, w, len(w) AS n, h, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM c),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM k),
t AS (SELECT doc_id, i, CASE WHEN a IS NULL OR i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END AS word
      FROM (SELECT *, unnest(range(n)) AS i FROM p)),
s AS (SELECT doc_id, i, lead(word, 5) OVER o AS sixth, concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o,
        lead(word, 3) OVER o, lead(word, 4) OVER o, lead(word, 5) OVER o) AS gram FROM t WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
m AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM s x JOIN s y ON x.doc_id = y.doc_id AND x.gram = y.gram AND x.i < y.i
      WHERE x.sixth IS NOT NULL AND y.sixth IS NOT NULL),
b AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM m),
e AS (SELECT doc_id, min(i) AS start, max(i) - min(i) + 6 + q AS length, q FROM b GROUP BY doc_id, q, island),
r AS (SELECT doc_id, start, length, min(q) AS period FROM e WHERE length >= greatest(12, 2 * q) GROUP BY doc_id, start, length),
d AS (SELECT t.doc_id, t.i, t.word, sum(coalesce(x.step, 0)) OVER (PARTITION BY t.doc_id ORDER BY t.i) AS inside FROM t LEFT JOIN (
        SELECT doc_id, i, sum(step) AS step FROM (SELECT doc_id, start + period AS i, 1 AS step FROM r
          UNION ALL SELECT doc_id, start + length, -1 FROM r) GROUP BY doc_id, i) x ON t.doc_id = x.doc_id AND t.i = x.i),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM d WHERE inside = 0 GROUP BY doc_id),
listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs FROM r GROUP BY doc_id),
best AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1)
SELECT c.doc_id, coalesce(n_runs, 0) AS n_runs, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length,
       CAST(period AS BIGINT) AS period, CAST(1000 * length // period AS BIGINT) AS exponent_milli,
       sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM c LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
