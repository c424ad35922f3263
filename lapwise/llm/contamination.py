"""Benchmark items inside documents by size-partitioned MinHash containment search.

Only shingles that occur in some item can count, so document sets are first
restricted to those; containment does not change. Restricted sets are
partitioned by size. For an item of q shingles and a set of at most u, a
containment of t means a Jaccard similarity of at least c / (q + u - c) with
c = t * q, which gives the number of hash functions whose minima must be
compared to miss a pair with a probability of at most MISS. Pairs of sizes that
would need more functions than there are go by their shared shingles. Every
candidate is verified on the words of its shingles.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwise.llm.common import SPACES, ascii_lower, text_or_empty
from lapwise.session import materialised

WORDS_PER_SHINGLE = 5
CONTAINMENT = 0.8
HASHES = 64
MISS = 1e-6
# Rows up to which a side is broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 200_000


def bound(value: Column, body) -> Column:
    """`body(value)` with `value` computed once a row, also where lambdas inside use it for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(column: str) -> Column:
    return F.filter(F.split(ascii_lower(text_or_empty(column)), SPACES), lambda w: w != "")


def shingle_hashes(words: Column, n: int) -> Column:
    """xxHash64 of every run of n words, from the hashes of the words; null with fewer words."""

    def runs(hashed: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(hashed) - n)
        each = F.transform(starts, lambda i: F.xxhash64(*[F.get(hashed, i + k) for k in range(n)]))
        return F.when(F.size(hashed) >= n, each)

    return bound(F.transform(words, lambda w: F.xxhash64(w)), runs)


def shingle_texts(words: str, n: int) -> Column:
    """The distinct runs of n words as texts."""

    def runs(ws: Column) -> Column:
        texts = F.transform(F.sequence(F.lit(1), F.size(ws) - n + 1), lambda i: F.array_join(F.slice(ws, i, n), " "))
        return F.when(F.size(ws) >= n, texts).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(bound(F.col(words), runs))


def _sized(df: DataFrame, rows: int) -> DataFrame:
    """`df` marked for broadcast if it has few rows."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _minima(sets: DataFrame, by: str, size: str, hashes: int) -> DataFrame:
    """(by, size, j, low): size and the minimum under each hash function of the distinct (by, h)."""
    # A real hash for each function: minima of h XOR fixed patterns depend on each other.
    lows = [F.min(F.xxhash64(F.col("h"), F.lit(j))).alias(f"m{j}") for j in range(hashes)]
    found = sets.groupBy(by).agg(F.count(F.lit(1)).alias(size), *lows)
    return found.select(by, size, F.posexplode(F.array(*[f"m{j}" for j in range(hashes)])).alias("j", "low"))


def needed_hashes(q: Column, u: Column, containment: float, miss: float) -> Column:
    shared = F.ceil(q * F.lit(containment) - 1e-9)
    similarity = F.least(shared / (q + u - shared), F.lit(1 - 1e-12))
    return F.ceil(F.lit(math.log(miss)) / F.log(1 - similarity))


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    n: int = WORDS_PER_SHINGLE,
    containment: float = CONTAINMENT,
    hashes: int = HASHES,
    miss: float = MISS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
) -> DataFrame:
    """(id, item_id, n_item, n_shared): pairs with 100 * n_shared >= 100 * containment * n_item.

    Sets are the distinct runs of n words of the whole text, A-Z lower-cased.
    Items with fewer than n words, null or empty texts and null ids have no
    shingles and match nothing. Rows with equal ids count as one document or
    item each by its own text; a pair is listed once, with its largest share. Empty
    tables give no rows.
    """
    percent = round(containment * 100)
    items = items.filter(F.col(item_col).isNotNull()).select(F.col(item_col).alias("item"), words_of("text").alias("i_words"))
    items = materialised(items.filter(F.size("i_words") >= n).dropDuplicates(), "items")
    n_items = items.count()
    grams = items.select("item", F.explode(shingle_hashes(F.col("i_words"), n)).alias("h")).distinct()
    grams = materialised(grams, "item-grams")
    n_grams = grams.count()
    vocabulary = _sized(grams.select(F.col("h").alias("v")).distinct(), n_grams)

    # Distinct (document, shingle) for shingles of some item.
    own = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), words_of(text_col).alias("words"))
    hits = own.select("id", F.explode(shingle_hashes(F.col("words"), n)).alias("h"))
    hits = hits.join(vocabulary, hits["h"] == F.col("v"), "left_semi").distinct()
    hits = materialised(hits, "hits")

    # u is the upper end of the size partition: a power of two.
    lows = _minima(hits, "id", "x", hashes).withColumn("u", F.pow(F.lit(2.0), F.ceil(F.log2("x"))))
    item_lows = materialised(_minima(grams, "item", "q", hashes), "item-minima").withColumnsRenamed({"j": "k", "low": "least"})
    need = needed_hashes(F.col("q"), F.col("u"), containment, miss)
    same = (F.col("j") == F.col("k")) & (F.col("low") == F.col("least"))
    found = lows.join(_sized(item_lows, n_items * hashes), same).filter((need <= hashes) & (F.col("j") < need)).select("id", "item")
    # Size pairs beyond the hash functions: by their shared shingles. Need rises with u and falls with q,
    # so the smallest item tells which sets are too large for some item.
    small = item_lows.filter("k = 0").select(F.col("item").alias("s_item"), "q")
    least_q = small.agg(F.min("q")).first()[0] or 1
    large = lows.filter("j = 0").filter(needed_hashes(F.lit(least_q), F.col("u"), containment, miss) > hashes).select("id", "u")
    far = hits.join(large, "id").join(_sized(grams, n_grams), "h")
    far = far.groupBy("id", "u", "item").agg(F.count(F.lit(1)).alias("shared"))
    far = far.join(_sized(small, n_items), F.col("item") == F.col("s_item"))
    far = far.filter((need > hashes) & (F.col("shared") * 100 >= F.col("q") * percent)).select("id", "item")
    pairs = materialised(found.union(far).distinct(), "candidates")

    # Verification on the words. The texts of candidate documents only travel.
    ids = pairs.select(F.col("id").alias("p_id")).distinct()
    texts = own.join(_sized(ids, pairs.count()), own["id"] == F.col("p_id"), "left_semi")
    texts = texts.select("id", shingle_texts("words", n).alias("grams"))
    listed = items.select(F.col("item").alias("l_item"), shingle_texts("i_words", n).alias("i_grams"))
    pairs = pairs.join(_sized(listed, n_items), F.col("item") == F.col("l_item")).join(texts, "id")
    pairs = pairs.select(
        F.col("id").alias(id_col),
        F.col("item").alias(item_col),
        F.size("i_grams").cast("long").alias("n_item"),
        F.size(F.array_intersect("grams", "i_grams")).cast("long").alias("n_shared"),
    )
    pairs = pairs.filter(F.col("n_shared") * 100 >= F.col("n_item") * percent)
    best = F.max(F.struct(F.col("n_shared") / F.col("n_item"), "n_shared", "n_item")).alias("best")
    return pairs.groupBy(id_col, item_col).agg(best).select(id_col, item_col, "best.n_item", "best.n_shared")


def without_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of `docs` whose id is in no pair."""
    found = materialised(contaminated(docs, items, id_col=id_col, **options).select(F.col(id_col).alias("c_id")).distinct(), "found")
    return docs.join(_sized(found, found.count()), docs[id_col] == found["c_id"], "left_anti")


SQL = r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                            '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents WHERE text IS NOT NULL),
b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM benchmark WHERE text IS NOT NULL),
d AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) AS g FROM w),
i AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) AS g FROM b),
n AS (SELECT item_id, count(*) AS n_item FROM i GROUP BY item_id)
SELECT doc_id, item_id, n_item, count(*) AS n_shared FROM d JOIN i USING (g) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_item HAVING count(*) * 100 >= n_item * 80
"""
