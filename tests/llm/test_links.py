"""The n-gram Jaccard join and connected components against brute force."""

import random

import helpers as H
import numpy as np
import pyarrow as pa
import pytest

from lapwise.llm import jaccard_join as J
from lapwise.llm.components import connected_components
from lapwise.llm.hashing import batch_words


def found(spark, rows, n, percent):
    return [tuple(r) for r in J.link_documents(H.docs(spark, rows), n, percent).collect()]


@pytest.mark.parametrize(("seed", "n", "percent"), [(1, 4, 85), (2, 5, 80), (3, 1, 60)])
def test_families(spark, seed, n, percent):
    rows = H.near_copies(seed)
    H.same(found(spark, rows, n, percent), H.component_ids(rows, n, percent))


def test_odd_rows(spark):
    rows = H.odd_rows()
    H.same(found(spark, rows, 4, 85), H.component_ids(rows, 4, 85))
    assert J.link_documents(H.docs(spark, [])).count() == 0


@pytest.mark.parametrize("seed", [5, 6])
def test_large_families_near_the_limit(spark, seed):
    """Most pairs of a family share signatures, but only some are linked, and not all to the hub."""
    r = random.Random(seed)
    rows = []
    for g in range(3):
        base = [f"t{g}x{i}" for i in range(120)]
        for k in range(45):
            w = list(base)
            for at in r.sample(range(120), r.choice([1, 2, 3, 4, 5])):
                w[at] = f"v{r.randrange(10**6)}"
            if k % 3 == 0:
                w[10:30] = [f"u{g}y{i}" for i in range(20)]
            rows.append((len(rows), " ".join(w), "s"))
    want = H.component_ids(rows, 4, 85)
    assert 3 < len({c for *_, c in want}) < len(rows)
    H.same(found(spark, rows, 4, 85), want)


def test_one_of_each_group(spark):
    rows = H.near_copies(7) + [(500, "", "a"), (501, None, "b")]
    part, sets = H.components(rows, 5, 80)
    keep = [i for k, (i, _, _) in enumerate(rows) if not sets[k] or part[k] == k]
    out = J.one_of_each_group(H.docs(spark, rows))
    assert sorted(r["doc_id"] for r in out.collect()) == keep and "h" in out.columns


@pytest.mark.parametrize(("plain", "near"), [(9, 0), (0, 1), (5, 2), (1, 4)])
def test_close_sets_always_share_a_probed_signature(plain, near):
    """Any pair within the difference that the units cover meets, whatever the probe leaves out."""
    r = random.Random(plain * 10 + near)
    scheme = J.Scheme(3, 1, 1000, plain, near)
    for _ in range(300):
        h = r.randrange(scheme.units)
        base = {r.randrange(2**64) for _ in range(r.randrange(h + 1, 60))}
        other = set(base)
        for _ in range(h):
            if r.random() < 0.5 and len(other) > 1:
                other.discard(next(iter(other & base or other)))
            else:
                other.add(r.randrange(2**64))
        a, b = (np.array(sorted(s), np.uint64) for s in (base, other))
        gap = len(base ^ other)
        if gap >= scheme.units or not len(b):
            continue
        ka, pa_ = J.signatures(a, scheme, gap + 1, True)
        kb, _ = J.signatures(b, scheme, gap + 1, True)
        assert set(ka[pa_].tolist()) & set(kb.tolist())


def test_cost_chooses_neighbourhoods_for_crowded_small_bands():
    few, many = J.choose_scheme(1, 6, 8, 10, 85), J.choose_scheme(1, 6, 8, 10**9, 85)
    assert few.near == 0 and many.near > 0
    assert J.choose_scheme(0, 1, 1, 10, 85).segments == 0


def test_words_across_chunks(monkeypatch):
    import lapwise.llm.hashing as hashing

    texts = ["Aa bb", "", None, " x\ty ", "long" * 50 + " end", "é\x1cz"]
    whole = batch_words(pa.array(texts, pa.string()))
    monkeypatch.setattr(hashing, "CHUNK", 7)
    parts = batch_words(pa.array(texts, pa.string()))
    assert all((a == b).all() for a, b in zip(whole, parts))
    assert np.bincount(whole[1], minlength=6).tolist() == [2, 0, 0, 2, 2, 1]


def test_components(spark):
    r = random.Random(4)
    edges = [(r.randrange(80), r.randrange(80)) for _ in range(60)] + [(100 + i, 101 + i) for i in range(30)] + [(0, 0)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    out = connected_components(spark.createDataFrame(edges, "a long, b long"))
    H.same([tuple(x) for x in out.collect()], [(x, find(x)) for x in linked])
    assert connected_components(spark.createDataFrame([(1, 1), (None, 2)], "a long, b long")) is None
