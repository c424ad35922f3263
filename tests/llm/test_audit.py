"""The filter audit against filters applied one after the other."""

import random
from collections import defaultdict
from itertools import permutations
from math import factorial

import helpers as H

from lapwise.llm import filter_audit as A

LABELS = "doc_id long, quality int, toxic int, n int, part string"


def plain_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    smallest = {}
    for i, t, _ in rows:
        if i is not None:
            smallest[t or ""] = min(smallest.get(t or "", i), i)
    parts = defaultdict(list)
    for i, t, s in rows:
        t = t or ""
        w = H.words(t)
        failed = "".join(c for c, bad in zip("ABCDE", (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
            any(c in "#$%&*|" for c in t), i is not None and smallest[t] < i)) if bad)
        parts[s or ""].append((i, failed))
    out = []
    for part, members in parts.items():
        mine = []
        for order in map("".join, permutations("ABCDE")):
            left = members
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                failing = sum(f in x[1] for x in members)
                mine.append((part, order, step, len(left), len(gone), failing - len(gone), sum(x[1] == f for x in members),
                             sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone)))
        total = defaultdict(int)
        for r in mine:
            total[r[1][r[2] - 1]] += r[4]
        out += [(*r, total[r[1][r[2] - 1]]) for r in mine]
    return out


def varied_rows():
    r = random.Random(3)
    out = H.odd_rows()
    for i in range(120):
        n = r.choice([20, 150, 199, 200, 260])
        words = [r.choice(["the", "a", f"w{r.randrange(1000)}", f"w{r.randrange(1000)}", "Big" if i % 4 == 0 else "small"]) for _ in range(n)]
        out.append((100 + i, " ".join(words) + (" 5 %" if i % 7 == 0 else ""), r.choice(["x", "y", None, ""])))
    out += [(300 + i, out[-1 - i][1], "z") for i in range(30)]
    return out + [(None, out[20][1], "x"), (301, out[20][1], "x"), (120, out[20][1], "y")]


def test_audit_is_that_of_single_orders(spark):
    rows = varied_rows()
    labels = [(i, int(i % 3 > 0), int(i % 5 == 0)) for i, _, _ in rows if i is not None and i % 2]
    labels += [(101, 0, 0), (101, 1, 1), (None, 1, 1), (103, None, None), (9999, 1, 0)]
    table = spark.createDataFrame([(*x, 1, "p") for x in labels], LABELS)
    got = [tuple(x) for x in A.filter_audit(H.docs(spark, rows), table).collect()]
    H.same(got, plain_audit(rows, labels))


def test_without_rows_or_labels(spark):
    labels = spark.createDataFrame([], LABELS)
    df = H.docs(spark, H.odd_rows())
    assert A.filter_audit(df.limit(0), labels).collect() == []
    H.same([tuple(x) for x in A.filter_audit(df, labels).collect()], plain_audit(H.odd_rows(), []))


def test_paths_of_the_lattice():
    for n in range(1, 6):
        edges, steps = A.lattice(n)
        assert len(edges) == n * 2 ** (n - 1) and len(steps) == n * factorial(n)
        counted = defaultdict(int)
        for _, _, state, f in steps:
            counted[state, f] += 1
        assert {(s, f): p for s, f, p in edges} == counted


def test_another_number_of_filters(spark):
    counts = spark.createDataFrame([("p", 0, 5, 1, 0), ("p", 3, 2, 1, 1)], "part string, fails int, n long, good long, toxic long")
    got = {(r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["shapley"]) for r in A.audit(counts, "XY").collect()}
    assert got == {("XY", 1): (5, 2, 0, 2), ("XY", 2): (5, 0, 2, 2), ("YX", 1): (5, 2, 0, 2), ("YX", 2): (5, 0, 2, 2)}
