"""Near copies by SimHash, found with covering locality-sensitive hashing.

Each of the 64 bit positions gets a non-zero vector of radius + 1 bits. A table
of buckets belongs to each non-zero vector v of that length: its mask keeps the
positions whose vectors have an odd product with v. Any `radius` positions span
too little to meet all masks, so two fingerprints that differ in at most that
many positions agree under some mask, without fail.

Within a bucket no pairs are listed. Small buckets are compared by their own
members; the members of a large one differ in the masked-out positions only and
are sent to the centres of the balls that hold them, where members that share a
centre are within the radius.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapwise.llm.common import slices, text_or_empty
from lapwise.llm.components import connected_components
from lapwise.session import materialised

BITS = 64
WORDS_PER_SHINGLE = 3
SEED = 42
RADIUS = 2
# Fingerprints of a bucket that are compared with each other; those of larger buckets meet at centres.
SMALL = 32
# Parts that the members of a bucket are dealt over.
SALTS = 16
# A fingerprint of more than 1 / HOT_SHARE of all rows is hot; there can be no more than HOT_SHARE of them.
HOT_SHARE = 10_000
# Shingles whose bits are counted at a time.
CHUNK = 1 << 16

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: bytes, n: int = WORDS_PER_SHINGLE) -> int:
    """The SimHash of the n-word shingles of a text, A-Z lower-cased; without words 0."""
    # Bytes are split at the same six characters as words.
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    size = min(n, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    total = len(words) - size + 1
    ones = np.zeros(BITS, np.int64)
    for low in range(0, total, CHUNK):
        high = min(low + CHUNK, total)
        spans = zip(starts[low:high].tolist(), ends[low + size - 1 : high + size - 1].tolist())
        hashes = [xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in spans]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << k for k in np.flatnonzero(2 * ones > total).tolist())


def cover_masks(radius: int = RADIUS) -> list[int]:
    """The masks as unsigned numbers: every set of `radius` bits is outside one of them."""
    vectors = range(1, 1 << (radius + 1))
    place = [1 + k % len(vectors) for k in range(BITS)]
    return [sum(1 << k for k in range(BITS) if (place[k] & v).bit_count() % 2) for v in vectors]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def fingerprints(docs: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """(id, f): the fingerprint of every row, as a signed long."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("f", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            texts = batch.column(1).cast(pa.large_binary()).to_pylist()
            found = np.array([fingerprint(t, n) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=schema.names)

    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).mapInArrow(run, schema)
    return materialised(rows, "fingerprints")


def links(distinct: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all fingerprints (f) of the table with `RADIUS` or fewer differing bits; each is such a pair."""
    masks = cover_masks()
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(_signed(m)).alias("mask")) for t, m in enumerate(masks)])
    rows = distinct.select("f", F.explode(tables).alias("m"))
    rows = rows.select("f", F.col("m.t").alias("t"), F.col("f").bitwiseAND(F.col("m.mask")).alias("key"))
    sizes = rows.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # A bucket's members are dealt over salts, each of which meets the bucket's one row.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    sizes = sizes.select(F.col("t").alias("b_t"), F.col("key").alias("b_key"), "n", salts.alias("b_salt"))
    salt = F.pmod(F.xxhash64("f"), F.lit(SALTS)).cast("int")
    match = (F.col("t") == F.col("b_t")) & (F.col("key") == F.col("b_key")) & (salt == F.col("b_salt"))
    members = materialised(rows.join(sizes, match).select("f", "t", "key", "n"), "buckets")
    small = members.filter(F.col("n") <= SMALL).groupBy("t", "key").agg(F.collect_list("f").alias("all"))
    near = F.filter("all", lambda b: (b < F.col("a")) & (F.bit_count(b.bitwiseXOR(F.col("a"))) <= RADIUS))
    small = small.select("all", F.explode("all").alias("a")).select("a", F.explode(near).alias("b"))
    # The centres within 1 of a member that lie in its bucket: itself, and one bit changed outside the mask. Two members
    # within 2 of each other share one; members that share one are within 2 of each other.
    steps = F.array(*[F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << k)) for k in range(BITS) if not m >> k & 1]) for m in masks])
    balls = members.filter(F.col("n") > SMALL).select("f", F.explode(steps[F.col("t")]).alias("step"))
    # A ball of radius 1 has one member more than there are bits, at most.
    balls = balls.groupBy(F.col("f").bitwiseXOR(F.col("step")).alias("centre")).agg(F.collect_set("f").alias("all"))
    balls = balls.filter(F.size("all") > 1).select(F.array_min("all").alias("b"), F.explode("all").alias("a"))
    return small.union(balls.filter("a <> b").select("a", "b")).distinct()


def with_value(rows: DataFrame, key: str, values: DataFrame, total: int) -> DataFrame:
    """`rows` with the `value` of their key in `values` (key, n, value), where n of `total` rows have that key.

    Keys of more than 1 / HOT_SHARE of the rows, which bounds their number, are
    broadcast, so that no task gets all rows of one; the others are shuffled.
    """
    hot = F.col("n") * HOT_SHARE > total
    warm = values.filter(hot).select(F.col("key").alias("h_key"), F.col("value").alias("h_value"))
    cold = values.filter(~hot).select(F.col("key").alias("c_key"), "value")
    marked = rows.join(F.broadcast(warm), F.col(key) == F.col("h_key"), "left")
    rest = marked.filter("h_key IS NULL").drop("h_key", "h_value").join(cold, F.col(key) == F.col("c_key")).drop("c_key")
    found = marked.filter("h_key IS NOT NULL").drop("h_key").withColumnRenamed("h_value", "value")
    return found.unionByName(rest)


def link_near_copies(
    docs: DataFrame, n: int = WORDS_PER_SHINGLE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id (the smallest id reachable by links, its own included).

    Words are runs of characters other than white space, A-Z lower-cased. A bit
    of the fingerprint is 1 if it is set in more than half of the XXH64 hashes
    (seed 42) of the text's runs of n words, repeats included; with fewer words
    the whole sequence is one run. A null or empty text, or one without words,
    has fingerprint 0 and is linked like any other. Fingerprints with 2 or fewer
    differing bits are linked. Null ids never name a component unless it has no
    other; rows with equal ids are linked each by its own text. Other columns
    are not read; an empty table gives no rows.
    """
    marked = fingerprints(docs, n, id_col, text_col)
    groups = materialised(marked.groupBy("f").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("low")), "distinct")
    total, texts = groups.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    parts = connected_components(links(groups.select("f")))
    named = groups.withColumn("part", F.col("f"))
    if parts is not None:
        named = groups.join(parts, F.col("f") == F.col("node"), "left").withColumn("part", F.coalesce("component", "f"))
        named = materialised(named.select("f", "n", "low", "part"), "parts")
        smallest = named.groupBy(F.col("part").alias("key")).agg(F.count(F.lit(1)).alias("n"), F.min("low").alias("value"))
        named = with_value(named, "part", smallest, texts).drop("low").withColumnRenamed("value", "low")
    values = materialised(named.select(F.col("f").alias("key"), "n", F.col("low").alias("value")), "components")
    out = with_value(marked, "f", values, total)
    return out.select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("f")), 16, "0").alias("fingerprint"), F.col("value").alias("component_id")
    )
