"""Quality selection by importance resampling over hashed word n-grams.

Two bag models over hashed unigrams and bigrams are estimated: one of all
texts, one of labelled target texts. A document's log weight is the log ratio
of its probability under the target and the raw model, tempered by its length
so that long documents do not lose to short ones. Adding Gumbel noise
and keeping the k largest keys samples k documents without replacement in
proportion to their weights.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapwise.llm.common import slices, text_or_empty, uniform
from lapwise.llm.hashing import batch_words, mix, ngrams
from lapwise.session import materialised

BUCKETS = 100_000
# Labelled rows that the target model and the kept share are fitted on, at most.
LABELLED_ROWS = 20_000
SMOOTHING = 0.5
# Long texts weigh by their mean log ratio, as much as so many n-grams would; short ones by their sum.
EVIDENCE = 200
SLICE_BYTES = 4 << 20


def buckets_of(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text index) of every unigram and bigram."""
    words, owners = batch_words(texts)
    pairs, pair_owners = ngrams(words, owners, 2)
    grams = np.concatenate([mix(words + np.uint64(1)), mix(pairs + np.uint64(2))])
    return (grams % np.uint64(buckets)).astype(np.int64), np.concatenate([owners, pair_owners])


def labelled_sample(labels: DataFrame, rows: int, id_col: str = "doc_id") -> DataFrame:
    """At most `rows` labelled ids, chosen by a hash of the id: (l_id, quality, toxic)."""
    seen = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("l_id"))
    seen = seen.agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    return seen.orderBy(F.xxhash64("l_id"), "l_id").limit(rows)


def gram_counts(texts: DataFrame, buckets: int) -> DataFrame:
    """(bucket, raw, target) counts of all rows (text, is_target)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in slices(batches, 0, SLICE_BYTES):
            gram, owner = buckets_of(batch.column(0), buckets)
            raw += np.bincount(gram, minlength=buckets)
            wanted = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            if wanted.any():
                target += np.bincount(gram[wanted[owner]], minlength=buckets)
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(target[at])], names=["bucket", "raw", "target"])

    counts = texts.mapInArrow(run, "bucket long, raw long, target long")
    return counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame, buckets: int) -> np.ndarray:
    """log(target probability / raw probability) per bucket; all 0 without target texts. `buckets` bounds what is collected."""
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for row in counts.collect():
        raw[row["bucket"]], target[row["bucket"]] = row["raw"], row["target"]
    if not target.sum():
        return np.zeros(buckets)
    space = SMOOTHING * buckets
    return np.log((target + SMOOTHING) / (target.sum() + space)) - np.log((raw + SMOOTHING) / (raw.sum() + space))


def kth_largest(scores: DataFrame, key: str, k: int, few: int = 10_000) -> float | None:
    """The k-th largest value of `key` by narrowing histograms; None if there are no rows."""
    low, high, n = scores.agg(F.min(key), F.max(key), F.count(key)).first()
    if not n:
        return None
    k = min(max(k, 1), n)
    above = 0
    inside = scores
    while n > few and high > low:
        width = (high - low) / 1000
        place = F.least(F.floor((F.col(key) - low) / width), F.lit(999))
        found = sorted(((r["place"], r["n"], r["lo"], r["hi"]) for r in inside.groupBy(place.alias("place")).agg(
            F.count(key).alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi")).collect()), reverse=True)
        for _, size, lo, hi in found:
            if above + size >= k:
                break
            above += size
        low, high, n = lo, hi, size
        inside = scores.filter(F.col(key).between(low, high))
    if high == low:
        return low
    return sorted((r[0] for r in inside.select(key).collect()), reverse=True)[k - above - 1]


def gumbel(*parts: Column) -> Column:
    return -F.log(-F.log(uniform(*parts)))


def _scored(
    docs: DataFrame, labels: DataFrame, keep_share: float | None, id_col: str, text_col: str, buckets: int, labelled_rows: int, seed: str
) -> tuple[DataFrame, Column]:
    """(id, text_key, n_grams, log_weight, key) of every row, and which of them are kept."""
    spark = docs.sparkSession
    sample = materialised(labelled_sample(labels, labelled_rows), "labelled")
    is_clean = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    known, good = sample.agg(F.count(F.lit(1)), F.count(F.when(is_clean, 1))).first()
    share = keep_share if keep_share is not None else (good / known if known else 1.0)
    clean = sample.filter(is_clean).select("l_id")
    text = text_or_empty(text_col)
    # `labelled_rows` bounds this broadcast.
    marked = docs.select(F.col(id_col).alias("id"), text.alias("text")).join(F.broadcast(clean), F.col("id") == F.col("l_id"), "left")
    marked = marked.select("text", F.col("l_id").isNotNull().alias("is_target"))
    ratios = spark.sparkContext.broadcast(log_ratios(gram_counts(marked, buckets), buckets))
    schema = T.StructType(
        [T.StructField("id", docs.schema[id_col].dataType), T.StructField("text_key", T.LongType()),
         T.StructField("n_grams", T.LongType()), T.StructField("log_weight", T.DoubleType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2, SLICE_BYTES):
            gram, owner = buckets_of(batch.column(2), buckets)
            n = np.bincount(owner, minlength=batch.num_rows)
            weight = np.bincount(owner, weights=ratios.value[gram], minlength=batch.num_rows)
            weight = weight * EVIDENCE / (EVIDENCE + n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n.astype(np.int64)), pa.array(weight.astype(np.float64))], names=schema.names
            )

    scores = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_key"), text.alias("text")).mapInArrow(run, schema)
    scores = materialised(scores.withColumn("key", F.col("log_weight") + gumbel(F.lit(seed), F.col("id"))), "scores")
    k = math.ceil(share * scores.count())
    cut = kth_largest(scores, "key", k) if k else math.inf
    return scores, F.lit(True) if cut is None else F.col("key") >= F.lit(float(cut))


def resample(
    docs: DataFrame,
    labels: DataFrame,
    keep_share: float | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    buckets: int = BUCKETS,
    labelled_rows: int = LABELLED_ROWS,
    seed: str = "resample",
) -> DataFrame:
    """One row per input row: id, n_grams, log_weight, key, kept.

    Raw counts cover all texts. Target texts are those labelled good and not
    toxic, from at most `labelled_rows` labels. k is `keep_share` of all rows;
    None takes the share of the labels that are good and not toxic. Rows that
    tie with the k-th are kept too. A null or empty text has weight 0 (log) and competes by
    its noise; a null id takes noise like any other; repeated rows get equal
    keys. Without target labels all log weights are 0; without labels and
    share all rows are kept. An empty table gives no rows.
    """
    scores, kept = _scored(docs, labels, keep_share, id_col, text_col, buckets, labelled_rows, seed)
    return scores.select(F.col("id").alias(id_col), "n_grams", "log_weight", "key", kept.alias("kept"))


def kept_documents(
    docs: DataFrame,
    labels: DataFrame,
    keep_share: float | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    buckets: int = BUCKETS,
    labelled_rows: int = LABELLED_ROWS,
    seed: str = "resample",
) -> DataFrame:
    """The rows of `docs` that `resample` keeps."""
    scores, kept = _scored(docs, labels, keep_share, id_col, text_col, buckets, labelled_rows, seed)
    scores = scores.filter(kept).select(F.col("id").alias("k_id"), F.col("text_key").alias("k_text"))
    # The hash of the text tells rows with equal ids apart.
    named = docs.withColumn("__text_key", F.xxhash64(text_or_empty(text_col)))
    same = named[id_col].eqNullSafe(scores["k_id"]) & (named["__text_key"] == scores["k_text"])
    return named.join(scores, same, "left_semi").drop("__text_key")
