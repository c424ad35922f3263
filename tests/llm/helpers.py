"""Small tables with odd rows, and brute-force forms of the operators."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, h int"
LONG = " ".join(f"w{i % 97}x{i}" for i in range(30_000))


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def docs(spark, rows):
    """Rows (doc_id, text, source) with columns whose names clash with those inside the operators."""
    full = [(i, t, None, s, None if t is None else len(t), 7, 1) for i, t, s in rows]
    return spark.createDataFrame(full, DOCS)


def odd_rows():
    return [
        (1, "Alpha beta  gamma\tdelta epsilon zeta eta theta", "a"),
        (2, "alpha beta gamma delta epsilon zeta eta theta", "b"),
        (3, "alpha beta gamma delta epsilon zeta eta theta", None),
        (3, "alpha beta gamma delta epsilon zeta eta theta", None),
        (4, None, "a"),
        (5, "", "b"),
        (6, " \n\t ", None),
        (7, "one", "a"),
        (8, LONG, "a"),
        (9, LONG + " tail", "b"),
        (None, "one", "b"),
        (10, "日本 ünï \U0001f642 é", "ünï"),
        (10, "another text under the same id", "ünï"),
    ]


def exact_groups(rows):
    """(doc_id, keep_id, group_size, sha256) per row."""
    def form(t):
        return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")

    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[form(t)].append(i)
    keep = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return [(i, keep[form(t)], len(groups[form(t)]), hashlib.sha256(form(t).encode()).hexdigest()) for i, t, _ in rows]


def shingles(text, n, short=True):
    w = words(lower(text))
    if len(w) < n:
        return frozenset([tuple(w)]) if w and short else frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def components(rows, n, percent):
    """Index of the component of every row, by comparing all pairs."""
    sets = [shingles(t, n) for _, t, _ in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(rows))], sets


def component_ids(rows, n, percent):
    """(doc_id, n_shingles, component_id) per row."""
    part, sets = components(rows, n, percent)
    low = {}
    for (i, _, _), p in zip(rows, part):
        if i is not None:
            low[p] = min(low.get(p, i), i)
    return [(i, len(s), i if not s else low.get(p)) for (i, _, _), p, s in zip(rows, part, sets)]


def near_copies(seed, groups=12, size=6, length=60):
    """Texts in families whose members differ by a few words."""
    import random

    r = random.Random(seed)
    out = []
    for g in range(groups):
        base = [f"t{r.randrange(400)}" for _ in range(r.choice([3, 6, 9, 14, 25, length]))]
        for _ in range(size):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 4])):
                w[r.randrange(len(w))] = f"v{r.randrange(10**6)}"
            if r.random() < 0.3:
                w += [f"z{r.randrange(10**6)}"] * r.choice([1, 2])
            out.append((len(out), " ".join(w), f"s{g % 3}"))
    return out


def same(got, want):
    assert sorted(map(repr, got)) == sorted(map(repr, want))
