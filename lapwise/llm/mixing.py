"""Mixing sources to target weights with weighted sampling without replacement.

Every document gets an exponential key whose rate is its quality weight; in
key order a source is a weighted sample without replacement. A source's target
is first spent on complete passes over it, the rest on documents in key order
up to the budget. The running sums are taken in bins of keys, so a source with
a third of all rows is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapwise.llm.common import WORDS, global_positions, text_or_empty, uniform
from lapwise.session import materialised

# Rows that one window group of keys holds on average.
BIN_ROWS = 1_000


def word_count(column: str) -> Column:
    return F.regexp_count(text_or_empty(column), F.lit(WORDS)).cast("long")


def quality_weights(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One weight per labelled id: 2 for good and not toxic, 0.5 for the others. Unlabelled documents weigh 1."""
    seen = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("w_id"))
    seen = seen.agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    return seen.select("w_id", F.when(good, 2.0).otherwise(0.5).alias("weight"))


def source_targets(
    sizes: DataFrame, source_col: str, pattern: Sequence[float], share: float, max_passes: int
) -> DataFrame:
    """Targets per source: (source, source_size, target).

    Sources in code point order, null last, take their weights from `pattern`
    in turn and share `share` times all words. A target stops at `max_passes`
    times the source's size; what it leaves is shared again by weight.
    """
    order = [F.col(source_col).asc_nulls_last()]
    weight = F.array(*[F.lit(float(w)) for w in pattern])
    ranked = global_positions(sizes, order, "__at")
    ranked = materialised(
        ranked.select(
            source_col,
            "source_size",
            F.get(weight, (F.col("__at") % len(pattern)).cast("int")).alias("__weight"),
            (F.col("source_size") * float(max_passes)).alias("__cap"),
        ),
        "sources",
    )
    total = float(ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    left, weights, capped = total, ranked.agg(F.sum("__weight")).first()[0] or 0.0, -1
    # The level only rises, so sources at their cap stay there; it settles after a few rounds.
    while True:
        at_cap = F.col("__cap") * F.lit(weights) < F.col("__weight") * F.lit(left)
        n, caps, free = ranked.agg(
            F.count(F.when(at_cap, 1)), F.sum(F.when(at_cap, F.col("__cap"))), F.sum(F.when(~at_cap, F.col("__weight")))
        ).first()
        if n == capped or not free:
            break
        capped, left, weights = n, total - (caps or 0.0), free
    if not weights:
        weights = 1.0
    target = F.when(at_cap, F.col("__cap")).otherwise(F.col("__weight") * F.lit(left) / F.lit(weights))
    return ranked.select(source_col, "source_size", target.alias("target"))


def mix_sources(
    docs: DataFrame,
    weights: DataFrame | None = None,
    pattern: Sequence[float] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    max_passes: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: str = "mix",
    bin_rows: int = BIN_ROWS,
) -> DataFrame:
    """One row per input row: id, source, size, weight, source_size, target, taken.

    `taken` counts words, repeats included: complete passes first, then whole
    documents in key order; the document at the edge of the budget gives only
    its first words up to it. `weights` has (w_id, weight). A null text has size 0, a
    null source is a source, a null id takes a key like any other, repeated
    rows count each. An empty table gives no rows.
    """
    sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"))
    if weights is not None:
        sized = sized.join(weights, sized["id"] == weights["w_id"], "left").drop("w_id")
        sized = sized.withColumn("weight", F.coalesce("weight", F.lit(1.0)))
    else:
        sized = sized.withColumn("weight", F.lit(1.0))
    sized = sized.withColumn("key", -F.log(uniform(F.lit(seed), F.col("id"))) / F.col("weight"))
    sized = materialised(sized, "sized")
    bins = max(1, -(-sized.count() // bin_rows))
    # Any rising function of the key will do; this one spreads keys of weight 1 evenly.
    place = F.least(F.floor((1 - F.exp(-F.col("key"))) * bins), F.lit(bins - 1)).cast("long")
    sized = sized.withColumn("bin", place)
    binned = materialised(sized.groupBy("source", "bin").agg(F.sum("size").alias("words")), "bins")
    sizes = binned.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(sizes, "source", pattern, share, max_passes)
    # One row per source and bin: far fewer rows than documents for a large source.
    earlier = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = binned.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0))).drop("words")
    offsets = offsets.withColumnsRenamed({"source": "o_source", "bin": "o_bin"})
    offsets = offsets.join(targets, offsets["o_source"].eqNullSafe(targets["source"])).drop("source")
    match = sized["source"].eqNullSafe(offsets["o_source"]) & (sized["bin"] == offsets["o_bin"])
    inside = Window.partitionBy("source", "bin").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = sized.join(offsets, match).drop("o_source", "o_bin")
    rows = rows.withColumn("before", F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    budget = F.floor(F.col("target") + 0.5).cast("long")
    rows = rows.withColumn("budget", budget).withColumn("whole", F.greatest("source_size", F.lit(1)))
    edge = F.least(F.col("size"), F.expr("budget % whole") - F.col("before"))
    taken = F.expr("budget div whole") * F.col("size") + F.greatest(F.lit(0), edge)
    return rows.select(
        F.col("id").alias(id_col), "source", "size", "weight", "source_size", "target", taken.cast("long").alias("taken")
    )


def mixed_documents(
    docs: DataFrame, weights: DataFrame | None = None, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **options
) -> DataFrame:
    """The rows of `docs` that the mix takes any words of, with size, source_size, target and taken.

    These four take the place of columns of `docs` with the same names; all
    others stay. Rows that agree in id, source and size share the largest
    `taken` of them.
    """
    mix = mix_sources(docs, weights, id_col=id_col, source_col=source_col, text_col=text_col, **options)
    made = ("size", "source_size", "target", "taken")
    keys = [F.col(id_col).alias("__mix_id"), F.col("source").alias("__mix_source"), F.col("size").alias("__mix_size")]
    mix = mix.groupBy(*keys).agg(*[F.max(c).alias(f"__mix_{c}") for c in made[1:]]).filter("__mix_taken > 0")
    rows = docs.withColumn("__mix_words", word_count(text_col))
    same = rows[id_col].eqNullSafe(mix["__mix_id"]) & rows[source_col].eqNullSafe(mix["__mix_source"]) & (rows["__mix_words"] == mix["__mix_size"])
    own = [rows[c] for c in docs.columns if c not in made]
    return rows.join(mix, same).select(*own, *[F.col(f"__mix_{c}").alias(c) for c in made])


SQL = r"""
WITH w AS (SELECT doc_id, CASE WHEN max(quality) = 1 AND coalesce(max(toxic), 0) = 0 THEN 2.0 ELSE 0.5 END AS weight
           FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (SELECT d.doc_id, d.source, CAST(len(regexp_extract_all(coalesce(d.text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
             CAST(coalesce(w.weight, 1.0) AS DOUBLE) AS weight FROM documents d LEFT JOIN w USING (doc_id)),
k AS (SELECT *, -ln((CAST('0x' || substr(md5('mix|' || doc_id), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0::DOUBLE) / weight AS key FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w FROM d GROUP BY source),
c AS (SELECT *, source_size * 2.0::DOUBLE AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS total FROM s),
l AS (SELECT *, total - coalesce(sum(cap) OVER (ORDER BY cap / w RANGE UNBOUNDED PRECEDING EXCLUDE GROUP), 0) AS rest,
             sum(w) OVER (ORDER BY cap / w RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free FROM c),
f AS (SELECT rest, free FROM l WHERE cap * free >= w * rest ORDER BY cap / w LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN cap * f.free < w * f.rest THEN cap ELSE w * f.rest / f.free END AS target FROM c, f),
p AS (SELECT k.doc_id, k.source, k.size, k.weight, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS budget,
             CAST(coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
      FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, size, weight, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
            + greatest(0, least(size, budget % source_size - before)) END AS BIGINT) AS taken FROM p
"""
