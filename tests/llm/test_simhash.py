"""SimHash links against all pairs of fingerprints."""

import random
from itertools import combinations

import helpers as H
import pytest
import xxhash

from lapwise.llm import simhash_cover as S


def plain_fingerprint(text):
    w = H.words(H.lower(text))
    grams = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(prints, ids):
    part = list(range(len(prints)))

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for i, j in combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 2:
            part[find(j)] = find(i)
    low = {}
    for k, i in enumerate(ids):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    return [low.get(find(k)) for k in range(len(prints))]


def test_every_pair_within_the_radius_agrees_under_a_mask():
    for radius in (1, 2, 3):
        masks = S.cover_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for places in combinations(range(S.BITS), radius):
            change = sum(1 << p for p in places)
            assert any(not m & change for m in masks)


def test_fingerprints():
    texts = ["", " \t", "One", "one two", "A b c d e f a b c a b c", "ünï 日本 \U0001f642 é x", H.LONG]
    texts += [t for _, t, _ in H.near_copies(4, groups=4)]
    assert [S.fingerprint(t.encode()) for t in texts] == [plain_fingerprint(t) for t in texts]


def test_spark_and_the_library_hash_alike(spark):
    from pyspark.sql import functions as F

    row = spark.range(1).select(F.xxhash64(F.lit("one two three")).alias("h")).first()
    assert row["h"] % 2**64 == xxhash.xxh64_intdigest(b"one two three", 42)


def test_documents(spark):
    rows = H.odd_rows() + H.near_copies(6) + [(500 + i, t.upper(), s) for i, t, s in H.near_copies(7, groups=3, length=400)]
    rows += [(700 + i, H.near_copies(6)[0][1], "s") for i in range(50)]
    got = S.link_near_copies(H.docs(spark, rows)).collect()
    prints = [plain_fingerprint(t) for _, t, _ in rows]
    parts = plain_components(prints, [i for i, _, _ in rows])
    H.same([tuple(r) for r in got], [(i, f"{f:016x}", c) for (i, _, _), f, c in zip(rows, prints, parts)])


@pytest.mark.parametrize("small", [1, 4, 32])
def test_links_of_crowded_buckets(spark, monkeypatch, small):
    """Whatever counts as a small bucket, the components are those of all pairs."""
    monkeypatch.setattr(S, "SMALL", small)
    r = random.Random(8)
    prints = {0, (1 << 64) - 1, *(r.getrandbits(64) for _ in range(40))}
    for centre in [r.getrandbits(64) for _ in range(3)] + [0]:
        for _ in range(60):
            f = centre
            for _ in range(r.choice([1, 2, 2, 3, 4])):
                f ^= 1 << r.randrange(64)
            prints.add(f)
    prints = sorted(prints)
    df = spark.createDataFrame([(S._signed(f),) for f in prints], "f long")
    edges = [(a % 2**64, b % 2**64) for a, b in S.links(df).collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in edges)
    at = {f: k for k, f in enumerate(prints)}
    part = list(range(len(prints)))

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for a, b in edges:
        part[max(find(at[a]), find(at[b]))] = min(find(at[a]), find(at[b]))
    assert [find(k) for k in range(len(prints))] == plain_components(prints, list(range(len(prints))))


def test_hot_keys_and_empty_table(spark, monkeypatch):
    df = H.docs(spark, H.odd_rows())
    assert S.link_near_copies(df.limit(0)).collect() == []
    want = sorted(map(repr, S.link_near_copies(df).collect()))
    monkeypatch.setattr(S, "HOT_SHARE", 1)
    assert sorted(map(repr, S.link_near_copies(df).collect())) == want
    only = H.docs(spark, [(None, "a b c", "s"), (None, "a b c", "s")])
    assert {tuple(r)[2] for r in S.link_near_copies(only).collect()} == {None}
