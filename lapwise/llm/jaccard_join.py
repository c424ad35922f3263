"""Documents linked by the Jaccard similarity of their word n-grams, found by universe partitioning.

Shingles are hashed into segments. Two sets within a symmetric difference of H
agree in some segment, or come within one shingle of it, if the segments' units
add up to more than H: one unit for comparing a segment as it is, two for also
comparing its one-deletion neighbourhood. Sizes fall into bands; a set is
indexed in the scheme of its band and probes that of each band that may hold
smaller partners. A scheme's segments are chosen by cost from the number of
sets in the band, and a probe spends the units it can spare on leaving out its
smallest, least selective segments. Every candidate is verified on its sets.

Buckets of equal signatures are not expanded into pairs. The sets of a bucket
are compared with one of its probes, the hub. Sets that are linked to the hub
are one component. A set that is not can be linked to another only if their
differences from the hub overlap, which a join on the rarest shingles of these
differences finds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapwise.llm.common import slices, text_or_empty
from lapwise.llm.components import connected_components
from lapwise.llm.hashing import batch_words, mix, ngrams, sequence_hash
from lapwise.session import materialised

WORDS_PER_SHINGLE, PERCENT = 5, 80
SLICE_BYTES = 2 << 20
# Rows up to which a side is broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 500_000
# A band spans sizes up to this power of 1 / similarity.
BAND_POWER = 2
# Cost model: the chance that one shingle of a segment is shared by an unrelated set, and rows that a candidate is worth.
CHANCE, CANDIDATE_ROWS = 0.002, 1.0


class Scheme(NamedTuple):
    """How sets of `low` to `high` shingles are indexed."""

    band: int
    low: int
    high: int
    # Segments compared as they are, and segments compared with their one-deletion neighbourhoods.
    plain: int
    near: int

    @property
    def segments(self) -> int:
        return self.plain + self.near

    @property
    def units(self) -> int:
        return self.plain + 2 * self.near


def difference(total: int, percent: int) -> int:
    """The largest symmetric difference of two linked sets with `total` shingles together."""
    return (100 - percent) * total // (100 + percent)


def band_ends(largest: int, percent: int, power: int = BAND_POWER) -> list[tuple[int, int]]:
    ends, low = [], 1
    while low <= largest:
        high = max(low, int(low * (100 / percent) ** power))
        ends.append((low, high))
        low = high + 1
    return ends


def choose_scheme(band: int, low: int, high: int, sets: int, percent: int) -> Scheme:
    """The cheapest mix of segments for a band with `sets` sets: signatures written plus candidates expected."""
    h = difference(high + high * 100 // percent, percent)
    middle = (low + high) / 2
    if h == 0:
        # Only equal sets are linked, and those are one set already.
        return Scheme(band, low, high, 0, 0)
    spare = h // 12
    best = None
    for near in range(min((h + 2) // 2, 8) + 1):
        plain = max(0, h + 1 + spare - 2 * near)
        size = middle / (plain + near)
        alone = math.exp(-size) * (math.exp(CHANCE * size) - 1) + (0.0 if spare else math.exp(-2 * size))
        rows = plain + near * (2 * size + 2)
        candidates = sets * alone * (plain + near * (size + 1))
        cost = rows + CANDIDATE_ROWS * candidates
        if best is None or cost < best[0]:
            best = (cost, plain, near)
    return Scheme(band, low, high, best[1], best[2])


def set_hashes(texts: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text; a text with fewer than n words has one, without words none."""
    words, owners = batch_words(texts)
    grams, gram_owners = ngrams(words, owners, n)
    word_ends = np.searchsorted(owners, np.arange(len(texts) + 1))
    gram_ends = np.searchsorted(gram_owners, np.arange(len(texts) + 1))
    out = []
    for i in range(len(texts)):
        few = words[word_ends[i] : word_ends[i + 1]]
        if 0 < len(few) < n:
            out.append(np.array([sequence_hash(few)], np.uint64))
        else:
            out.append(np.unique(grams[gram_ends[i] : gram_ends[i + 1]]))
    return out


def set_names(shingles: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes of a set; the lowest bit of the first is 0."""
    size = np.uint64(len(shingles))
    first = mix(np.array([mix(shingles).sum() + size], np.uint64))[0]
    second = mix(np.array([mix(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum() + size], np.uint64))[0]
    return int((first & ~np.uint64(1)).astype(np.int64)), int(second.astype(np.int64))


def _salt(band: int, kind: int, places: np.ndarray) -> np.ndarray:
    return mix(np.uint64((band << 34) | (kind << 32)) + places.astype(np.uint64) + np.uint64(1))


def signatures(shingles: np.ndarray, scheme: Scheme, needed: int, index: bool) -> tuple[np.ndarray, np.ndarray]:
    """(keys, probe flags) of a set under a scheme, where probes must spend `needed` units.

    Kind 0 names a segment's subset, kind 1 a subset that lacks one shingle of
    the indexed segment.
    """
    m, near = scheme.segments, scheme.near
    if not m:
        return np.empty(0, np.uint64), np.empty(0, bool)
    segment = ((shingles >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
    ends = np.searchsorted(segment, np.arange(m + 1, dtype=np.uint64))
    sizes = np.diff(ends)
    mixed = mix(shingles) + np.uint64(0x632BE59BD9B4E019)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
    totals = sums[ends[1:]] - sums[ends[:-1]]
    places = np.arange(m)
    units = np.where(places < near, 2, 1)
    # Leave out the smallest segments that the spare units pay for.
    order = np.argsort(sizes, kind="stable")
    used = np.ones(m, bool)
    used[order[np.cumsum(units[order]) <= scheme.units - needed]] = False
    plain_salt = _salt(scheme.band, 0, places)
    keys, flags = [], []

    def add(key: np.ndarray, flag: np.ndarray) -> None:
        keys.append(mix(key))
        flags.append(flag)

    whole = totals + plain_salt
    if index:
        add(whole, used)
    else:
        add(whole[used], np.ones(int(used.sum()), bool))
    if near:
        lack_salt = _salt(scheme.band, 1, places)
        owner = segment.astype(np.int64)
        inside = owner < near
        lacking = totals[owner[inside]] - mixed[inside]
        if index:
            add(lacking + lack_salt[owner[inside]], np.zeros(len(lacking), bool))
        probes = used[:near]
        add((totals[:near] + lack_salt[:near])[probes], np.ones(int(probes.sum()), bool))
        mine = probes[owner[inside]]
        add((lacking + plain_salt[owner[inside]])[mine], np.ones(int(mine.sum()), bool))
    return np.concatenate(keys), np.concatenate(flags)


def all_signatures(shingles: np.ndarray, schemes: Sequence[Scheme], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of a set in its own band and in lower bands that can hold partners of its size."""
    size = len(shingles)
    least = -(-size * percent // 100)
    keys, flags = [], []
    for scheme in schemes:
        if scheme.low > size or scheme.high < least:
            continue
        partner = min(size, scheme.high)
        key, flag = signatures(shingles, scheme, difference(size + partner, percent) + 1, size <= scheme.high)
        keys.append(key)
        flags.append(flag)
    return np.concatenate(keys), np.concatenate(flags)


class Links:
    """The candidate search and verification over one table."""

    def __init__(self, docs: DataFrame, n: int, percent: int, id_col: str, text_col: str) -> None:
        self.n, self.percent = n, percent
        self.kind = docs.schema[id_col].dataType
        text = text_or_empty(text_col)
        # The hash of the text tells rows with equal ids apart.
        self.rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))

    def sets(self) -> DataFrame:
        """(id, key, size, name, check) of every row."""
        n = self.n
        schema = T.StructType(
            [T.StructField("id", self.kind)] + [T.StructField(c, T.LongType()) for c in ("key", "size", "name", "check")]
        )

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, 2, SLICE_BYTES):
                sets = set_hashes(batch.column(2), n)
                names = [set_names(s) for s in sets]
                columns = [[len(s) for s in sets], [a for a, _ in names], [b for _, b in names]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), *[pa.array(c, pa.int64()) for c in columns]], names=schema.names
                )

        return materialised(self.rows.mapInArrow(run, schema), "sets")

    def schemes(self, sets: DataFrame) -> list[Scheme]:
        largest = sets.agg(F.max("size")).first()[0] or 0
        ends = band_ends(largest, self.percent)
        # Sizes on a fine logarithmic scale: a few hundred rows whatever the table.
        scale = F.floor(F.log("size") * 20).alias("at")
        found = {r["at"]: r["n"] for r in sets.filter("size > 0").groupBy(scale).agg(F.count(F.lit(1)).alias("n")).collect()}
        out = []
        for band, (low, high) in enumerate(ends):
            inside = sum(n for at, n in found.items() if low <= math.exp((at + 0.5) / 20) < high + 1)
            out.append(choose_scheme(band, low, high, inside, self.percent))
        return out

    def buckets(self, schemes: list[Scheme]) -> DataFrame:
        """(sig, name, probe, size of the bucket) of the signatures that different sets share and some set probes."""
        n, percent = self.n, self.percent

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # Copies are combined where they are read.
            seen: set[int] = set()
            for batch in slices(batches, 0, SLICE_BYTES):
                sigs, tags = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
                for shingles in set_hashes(batch.column(0), n):
                    if not len(shingles):
                        continue
                    name = set_names(shingles)[0]
                    if name in seen:
                        continue
                    seen.add(name)
                    key, flag = all_signatures(shingles, schemes, percent)
                    sigs.append(key)
                    tags.append(flag.astype(np.int64) | np.int64(name))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(sigs).view(np.int64)), pa.array(np.concatenate(tags))], names=["sig", "tag"]
                )

        rows = self.rows.select("text").mapInArrow(run, "sig long, tag long")
        name = F.col("tag").bitwiseAND(F.lit(~1))
        same = Window.partitionBy("sig")
        rows = rows.withColumn("low", F.min(name).over(same)).withColumn("high", F.max(name).over(same))
        rows = rows.withColumn("size", F.count(F.lit(1)).over(same))
        rows = rows.withColumn("probed", F.bit_or("tag").over(same).bitwiseAND(F.lit(1)))
        rows = rows.filter((F.col("low") != F.col("high")) & (F.col("probed") == 1))
        rows = rows.select("sig", name.alias("name"), (F.col("tag").bitwiseAND(F.lit(1)) == 1).alias("probe"), "size")
        return materialised(rows.groupBy("sig", "name").agg(F.max("probe").alias("probe"), F.max("size").alias("size")), "buckets")

    def involved(self, sets: DataFrame, buckets: DataFrame) -> DataFrame:
        """(name, text): one text for every set in a bucket."""
        names = buckets.select(F.col("name").alias("b_name")).distinct()
        row = F.min(F.struct("id", "key")).alias("row")
        picked = sets.join(names, F.col("name") == F.col("b_name"), "left_semi").groupBy("name").agg(row)
        picked = materialised(picked.select("name", F.col("row.id").alias("p_id"), F.col("row.key").alias("p_key")), "picked")
        small = picked.count() <= BROADCAST_ROWS
        match = F.col("id").eqNullSafe(F.col("p_id")) & (F.col("key") == F.col("p_key"))
        texts = self.rows.join(F.broadcast(picked) if small else picked, match).select("name", "text")
        return materialised(texts.dropDuplicates(["name"]), "texts")

    def _beside(self, pairs: DataFrame, texts: DataFrame) -> DataFrame | None:
        """(a, b, ta, tb) of the pairs, with those of one `a` together; None without pairs."""
        pairs = materialised(pairs.select("a", "b"), "pairs")
        count = pairs.count()
        if not count:
            return None
        if count <= BROADCAST_ROWS:
            ends = F.broadcast(pairs.select(F.col("a").alias("e")).union(pairs.select("b")).distinct())
            texts = texts.join(ends, F.col("name") == F.col("e"), "left_semi")
        left = texts.select(F.col("name").alias("a"), F.col("text").alias("ta"))
        right = texts.select(F.col("name").alias("b"), F.col("text").alias("tb"))
        return pairs.join(right, "b").join(left, "a").select("a", "b", "ta", "tb")

    def verified(self, pairs: DataFrame, texts: DataFrame) -> DataFrame | None:
        """The pairs (a, b) whose sets are linked; None without pairs."""
        percent, sets_of = self.percent, partial(pair_sets, self.n)
        both = self._beside(pairs, texts)
        if both is None:
            return None

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kept: dict = {}
            for batch in slices(slices(batches, 2, SLICE_BYTES), 3, SLICE_BYTES):
                linked = []
                for x, y in sets_of(batch, kept):
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    linked.append(100 * shared >= percent * (len(x) + len(y) - shared))
                yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))

        return materialised(both.mapInArrow(run, "a long, b long"), "links")

    def gaps(self, pairs: DataFrame, texts: DataFrame) -> DataFrame | None:
        """(a, b, na, nb, gap): the sizes and the symmetric difference of every pair; None without pairs."""
        sets_of = partial(pair_sets, self.n)
        both = self._beside(pairs, texts)
        if both is None:
            return None
        schema = "a long, b long, na long, nb long, gap array<long>"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kept: dict = {}
            for batch in slices(slices(batches, 2, SLICE_BYTES), 3, SLICE_BYTES):
                na, nb, gap = [], [], []
                for x, y in sets_of(batch, kept):
                    na.append(len(x))
                    nb.append(len(y))
                    gap.append(np.setxor1d(x, y, assume_unique=True).view(np.int64))
                columns = [pa.array(na, pa.int64()), pa.array(nb, pa.int64()), pa.array(gap, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["a", "b", "na", "nb", "gap"])

        return both.mapInArrow(run, schema)


def pair_sets(n: int, batch: pa.RecordBatch, kept: dict) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The two sets of each pair (a, b, ta, tb); the left one is hashed once for neighbouring pairs."""
    names = batch.column(0).to_pylist()
    new = [i for i, a in enumerate(names) if (names[i - 1] if i else kept.get("name")) != a]
    left = iter(set_hashes(batch.column(2).take(pa.array(new, pa.int64())), n))
    fresh = set(new)
    for i, right in enumerate(set_hashes(batch.column(3), n)):
        if i in fresh:
            kept["name"], kept["set"] = names[i], next(left)
        yield kept["set"], right


def _with_component(rows: DataFrame, parts: DataFrame | None, name: str, out: str) -> DataFrame:
    if parts is None:
        return rows.withColumn(out, F.col(name))
    parts = parts.select(F.col("node").alias(f"{out}_node"), F.col("component").alias(f"{out}_part"))
    rows = rows.join(parts, F.col(name) == F.col(f"{out}_node"), "left")
    return rows.withColumn(out, F.coalesce(f"{out}_part", name)).drop(f"{out}_node", f"{out}_part")


def left_pairs(gaps: DataFrame, parts: DataFrame | None, percent: int) -> DataFrame:
    """Pairs (a, b) around a common hub that may be linked although one of them is not linked to the hub.

    `gaps` holds the symmetric difference of every set with its hub. The
    difference of two sets is what is in one gap and not in the other, so with
    r not linked to the hub, r and s can be linked only if their gaps overlap in
    about half of s's gap or more. Both then share a shingle among the rarest of
    their gaps, as many as the least overlap leaves over, plus one.
    """
    c = (100 - percent) / (100 + percent)
    rows = _with_component(_with_component(gaps, parts, "a", "hub_part"), parts, "b", "part")
    rows = materialised(rows.withColumn("d", F.size("gap")), "gaps")
    # Least overlaps that some partner may need, with one to spare for rounding.
    largest = F.col("nb") * (1 + 100 / percent) * c
    outer = F.when(F.col("part") != F.col("hub_part"), F.col("d") + 1 - F.greatest(F.lit(1), F.ceil((F.col("d") - largest) / 2 - 1)))
    inner = F.col("d") + 1 - F.greatest(F.lit(1), F.ceil((F.col("d") + c * (F.col("na") - F.col("nb"))) / 2 - 1))
    rows = rows.select("a", "b", "part", "d", "nb", outer.alias("outer"), inner.alias("inner"), F.explode("gap").alias("h"))
    uses = rows.groupBy(F.col("a").alias("u_a"), F.col("h").alias("u_h")).agg(F.count(F.lit(1)).alias("uses")).filter("uses > 1")
    # Shingles of one gap only come first in the order and pair nothing, so their places need counting, not listing.
    marked = rows.join(uses, (F.col("a") == F.col("u_a")) & (F.col("h") == F.col("u_h")), "left")
    # A gap has no more rows than two sets have shingles.
    order = Window.partitionBy("a", "b").orderBy(F.col("uses").asc_nulls_first(), "h")
    marked = marked.withColumn("place", F.row_number().over(order)).filter("uses IS NOT NULL AND (place <= outer OR place <= inner)")
    marked = materialised(marked.select("a", "h", "b", "part", "d", "nb", "outer", "inner", "place"), "rare")
    names = {"b": "x", "part": "px", "d": "dx", "nb": "nx", "place": "ix"}
    left = marked.filter("place <= outer").drop("outer", "inner").withColumnsRenamed(names)
    right = marked.filter("place <= inner").drop("inner").withColumnRenamed("outer", "oy")
    right = right.withColumnsRenamed({k: v.replace("x", "y") for k, v in names.items()})
    # The overlap that this very pair needs, and the places that its first common shingle must then have.
    need = F.greatest(F.lit(1), F.ceil((F.col("dx") + F.col("dy") - c * (F.col("nx") + F.col("ny"))) / 2 - 1e-6))
    early = (F.col("ix") <= F.col("dx") + 1 - need) & (F.col("iy") <= F.col("dy") + 1 - need)
    # Two sets that are both apart from the hub are on both sides; one order is enough.
    once = F.col("oy").isNull() | (F.col("x") < F.col("y"))
    pairs = left.join(right, ["a", "h"]).filter((F.col("px") != F.col("py")) & once & early)
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def linked_sets(links: Links, sets: DataFrame) -> DataFrame | None:
    """(node, component) of the set names that have links; None without any."""
    buckets = links.buckets(links.schemes(sets))
    texts = links.involved(sets, buckets)
    found = parts = None

    def verify(pairs: DataFrame) -> None:
        nonlocal found, parts
        more = links.verified(pairs, texts)
        if more is not None and more.limit(1).count():
            found = more if found is None else found.union(more)
            parts = connected_components(found)

    def crossing(pairs: DataFrame) -> DataFrame:
        pairs = _with_component(_with_component(pairs, parts, "a", "ca"), parts, "b", "cb")
        return pairs.filter("ca <> cb").select("a", "b")

    # The set with most company is the most central one: few sets differ much from it, and many buckets share it.
    company = buckets.groupBy(F.col("name").alias("c_name")).agg(F.sum("size").alias("company"))
    stars = buckets.join(company, F.col("name") == F.col("c_name"))
    hub = F.max_by("name", F.when(F.col("probe"), F.struct("company", "name"))).over(Window.partitionBy("sig"))
    stars = stars.withColumn("a", hub).filter("a IS NOT NULL AND name <> a")
    stars = materialised(stars.groupBy("a", F.col("name").alias("b")).agg(F.count(F.lit(1)).alias("n")), "stars")
    # First the hub that a set shares most buckets with; where that links, the others need no comparison.
    verify(stars.groupBy("b").agg(F.max_by("a", F.struct("n", "a")).alias("a")))
    verify(crossing(stars))
    # Hubs all of whose sets are in their component are done.
    apart = _with_component(_with_component(stars, parts, "a", "ca"), parts, "b", "cb").filter("ca <> cb")
    apart = apart.groupBy(F.col("a").alias("open_a")).agg(F.count(F.lit(1)).alias("apart"))
    members = stars.groupBy("a").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    hubs = members.join(apart, F.col("a") == F.col("open_a")).select(F.col("a").alias("open_a"))
    gaps = links.gaps(stars.join(hubs, F.col("a") == F.col("open_a"), "left_semi"), texts)
    if gaps is not None:
        verify(left_pairs(gaps, parts, links.percent))
    return parts


def _linked_rows(docs: DataFrame, n: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(id, key, size, part) of every row; rows of one part are linked. Rows without words are parts of their own."""
    links = Links(docs, n, percent, id_col, text_col)
    sets = links.sets()
    return _with_component(sets, linked_sets(links, sets), "name", "part")


def link_documents(
    docs: DataFrame,
    n: int = WORDS_PER_SHINGLE,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (the smallest id reachable by links, its own included).

    Words are runs of characters other than white space, A-Z lower-cased. A
    document's set holds its distinct runs of n words, with fewer words the
    whole sequence; a null or empty text, or one without words, has none and is
    linked with nothing. Two documents are linked when 100 * intersection >=
    percent * union. Sets are compared on 64-bit hashes of their shingles.
    Null ids never name a component unless it has no other; rows with equal ids
    are linked each by its own text. An empty table gives no rows.
    """
    rows = _linked_rows(docs, n, percent, id_col, text_col)
    smallest = rows.filter("size > 0").groupBy(F.col("part").alias("s_part")).agg(F.min("id").alias("smallest"))
    # Copies may make one component hot; it joins with one row, a join that Spark can split.
    rows = rows.join(smallest, (F.col("size") > 0) & (F.col("part") == F.col("s_part")), "left")
    component = F.when(F.col("size") == 0, F.col("id")).otherwise(F.col("smallest"))
    return rows.select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"), component.alias("component_id"))


def one_of_each_group(
    docs: DataFrame,
    n: int = WORDS_PER_SHINGLE,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of `docs` less those that are linked to a row that stays: of each component the row with the smallest id."""
    rows = _linked_rows(docs, n, percent, id_col, text_col).filter("size > 0")
    row = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    first = rows.groupBy(F.col("part").alias("f_part")).agg(F.min(row).alias("first"))
    gone = rows.join(first, F.col("part") == F.col("f_part")).filter(row != F.col("first"))
    gone = gone.select(F.col("id").alias("g_id"), F.col("key").alias("g_key"))
    same = docs[id_col].eqNullSafe(gone["g_id"]) & (F.xxhash64(text_or_empty(text_col)) == gone["g_key"])
    return docs.join(gone, same, "left_anti")
