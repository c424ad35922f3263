"""Periodic runs against a plain search of all periods."""

import hashlib
import random
import zlib

import helpers as H
import numpy as np
import pytest

from lapwise.llm import periodic_runs as P


def plain_runs(words, least):
    n, longest = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q):
                longest.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n_, q) for (s, n_), q in longest.items())


def plain_collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


@pytest.mark.parametrize("least", [2, 3, 5, 12])
def test_runs_of_small_alphabets(least):
    r = random.Random(least)
    for _ in range(600):
        n, k = r.randrange(0, 70), r.choice([1, 2, 3, 6])
        codes = [r.randrange(k) for _ in range(n)]
        if r.random() < 0.4 and n > 9:
            a, p = r.randrange(n // 2), r.randrange(1, 9)
            codes = codes[:a] + (codes[a : a + p] * n)[: n - a]
        want = plain_runs(codes, least)
        assert [tuple(x) for x in P.runs_of(np.array(codes, np.int64), least).tolist()] == want
        words = [b"%d" % c for c in codes]
        found = P.word_runs(words, least)
        assert [tuple(x) for x in found.tolist()] == want
        assert P.without_repeats(words, found) == plain_collapse(words, want)


def test_long_texts_of_one_word_and_of_long_periods():
    assert P.word_runs([b"a"] * 50_000, 12).tolist() == [[0, 50_000, 1]]
    block = [b"w%d" % i for i in range(20_000)]
    assert P.word_runs([b"x", *block, *block, b"y"], 12).tolist() == [[1, 40_000, 20_000]]
    assert not len(P.word_runs(block, 12))


def test_extensions():
    codes = np.array([0, 1, 0, 1, 0, 2, 0, 1, 0], np.int64)
    both = [(i, j) for i in range(10) for j in range(10) if i != j]
    i, j = np.array(both).T

    def common(a, b):
        n = 0
        while max(a, b) + n < 9 and codes[a + n] == codes[b + n]:
            n += 1
        return n

    assert P.Extensions(codes)(i, j).tolist() == [common(a, b) for a, b in both]


def plain_planted(doc_id, text):
    words = H.words(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_query_over_odd_and_repetitive_rows(spark):
    r = random.Random(5)
    rows = H.odd_rows() + H.near_copies(2)
    rows += [(1000 + i, " ".join(f"v{r.randrange(30)}" for _ in range(r.randrange(1, 300))), "s") for i in range(60)]
    rows += [(2000 + i, "x " + "ha " * (10 + i) + "tail  \t end", "s") for i in range(6)]
    df = H.docs(spark, rows)
    got = P.run_digests(P.periodic_runs(P.planted(df))).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want, planted = [], 0
    for i, text, _ in rows:
        words = plain_planted(i, text)
        planted += words != H.words(text)
        runs = plain_runs(words, 12) if i not in (8, 9) else []
        best = min(((-n, s, q) for s, n, q in runs), default=None)
        four = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
        want.append((i, len(runs), *four, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(plain_collapse(words, runs)))))
    assert planted > 5
    H.same([tuple(x) for x in got], want)


def test_real_outputs_and_empty_table(spark):
    df = H.docs(spark, [(2, "go " + "a b c " * 5 + "end", "s"), (3, None, "s")])
    got = {r["doc_id"]: (r["runs"], r["collapsed"]) for r in P.periodic_runs(df).collect()}
    assert got[2][0][0].asDict() == {"start": 1, "length": 15, "period": 3} and got[2][1] == "go a b c end"
    assert got[3] == ([], "")
    empty = P.run_digests(P.periodic_runs(P.planted(df.limit(0))))
    assert empty.collect() == [] and empty.columns[0] == "doc_id"
