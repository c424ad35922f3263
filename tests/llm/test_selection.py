"""Importance resampling, line spread, benchmark passages."""

import random
from collections import defaultdict

import helpers as H
from pyspark.sql import functions as F

from lapwise.llm import contamination, importance, line_spread


def corpus(seed=1, n=300):
    r = random.Random(seed)
    good, bad = [f"good{i}" for i in range(60)], [f"bad{i}" for i in range(60)]
    rows = [(i, " ".join(r.choices(bad if i % 5 == 0 else good, k=r.randint(20, 60))), "s") for i in range(n)]
    return rows, [(i, 0 if i % 5 == 0 else 1, 0) for i in range(0, n, 2)]


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_target_like_texts_stay(spark):
    rows, marks = corpus()
    out = importance.resample(H.docs(spark, rows), labels(spark, marks)).collect()
    assert {r["doc_id"] for r in out if r["kept"]} == {i for i, _, _ in rows if i % 5}
    assert {r["doc_id"]: r["n_grams"] for r in out} == {i: 2 * len(H.words(t)) - 1 for i, t, _ in rows}


def test_toxic_labels_do_not_raise_the_kept_share(spark):
    rows, marks = corpus()
    toxic = {i for i, _, _ in rows if i % 5 == 1}
    rows = [(i, t.replace("good", "tox") if i in toxic else t, s) for i, t, s in rows]
    marks = [(i, q, int(i in toxic)) for i, q, _ in marks]
    out = importance.resample(H.docs(spark, rows), labels(spark, marks)).collect()
    assert {r["doc_id"] for r in out if r["kept"]} == {i for i, _, _ in rows if i % 5 > 1}


def test_the_largest_keys_are_kept(spark):
    rows, marks = corpus(2)
    out = importance.resample(H.docs(spark, rows), labels(spark, marks), keep_share=0.4).collect()
    keys = sorted((r["key"] for r in out), reverse=True)
    assert [r["kept"] for r in out] == [r["key"] >= keys[119] for r in out] and sum(r["kept"] for r in out) == 120
    again = importance.resample(H.docs(spark, rows), labels(spark, marks), keep_share=0.4).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, out))


def test_kth_largest(spark):
    r = random.Random(3)
    values = [r.choice([r.gauss(0, 1), r.randrange(3), 1e6]) for _ in range(2000)]
    frame = spark.createDataFrame([(float(v),) for v in values], "x double")
    for k in (1, 7, 600, 2000, 5000):
        assert importance.kth_largest(frame, "x", k, few=10) == sorted(values, reverse=True)[min(k, 2000) - 1]
    assert importance.kth_largest(frame.limit(0), "x", 3) is None


def test_odd_rows_and_missing_labels(spark):
    rows = H.odd_rows()
    frame, none = H.docs(spark, rows), labels(spark, [])
    out = importance.resample(frame, none).collect()
    assert len(out) == len(rows) and all(r["kept"] and r["log_weight"] == 0 for r in out)
    kept = importance.kept_documents(frame, labels(spark, [(1, 1, 0), (7, 0, None), (None, 1, 0)]))
    assert kept.columns == frame.columns and 0 < kept.count() <= len(rows)
    assert importance.resample(H.docs(spark, []), none).count() == 0


def test_scores_beside_clashing_columns(spark):
    names = ["l_id", "quality", "toxic", "k_id", "k_text", "key", "is_target", "text_key"]
    rows = H.odd_rows()
    frame = H.docs(spark, rows).select("*", *[F.lit(k).alias(c) for k, c in enumerate(names)])
    some = labels(spark, [(1, 1, 0), (7, 0, None), (8, 1, 1), (None, 1, 0)])
    want = sorted(map(repr, importance.resample(H.docs(spark, rows), some).collect()))
    assert sorted(map(repr, importance.resample(frame, some).collect())) == want
    kept = importance.kept_documents(frame, some)
    assert kept.columns == frame.columns and all(r[c] == k for r in kept.collect() for k, c in enumerate(names))


def spread(rows, least):
    sites = defaultdict(set)
    for _, t, s in rows:
        for line in (t or "").split("\n"):
            sites[" ".join(H.words(line))].add(s)
    cut = {k for k, v in sites.items() if k and len(v - {None}) >= least}
    out = []
    for i, t, _ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if " ".join(H.words(x)) not in cut]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def test_spread_lines(spark):
    r = random.Random(5)
    rows = [(i, "\n".join(r.choice(["same line", " same  line ", "", "few", f"own {i}"]) for _ in range(8)), f"s{i % 9}") for i in range(90)]
    rows += [(90 + i, "few\nonly here", "s1") for i in range(20)] + [(200 + i, f"k{i // 2}\nx\n", f"q{i}") for i in range(12)]
    rows = [(i, t.replace("few", "f") if s > "s4" else t, s) for i, t, s in rows]
    for least in (2, 5, 6, 9):
        out = line_spread.cut_spread_lines(H.docs(spark, rows), least)
        H.same([tuple(x) for x in out.collect()], spread(rows, least))


def test_few_registers_are_made_good_by_exact_counts(spark):
    rows = [(1000 * k + i, f"line {k}", f"s{i}") for k in range(90, 111) for i in range(k)]
    out = line_spread.cut_spread_lines(H.docs(spark, rows), 100, lg_registers=4)
    assert {r["doc_id"] // 1000 for r in out.collect() if r["n_cut"]} == set(range(100, 111))


def test_hot_lines_and_odd_rows(spark, monkeypatch):
    rows = H.odd_rows() + [(100 + i, "hot\nown " + str(i), f"s{i}") for i in range(30)]
    monkeypatch.setattr(line_spread, "HOT_SHARE", 2)
    out = line_spread.cut_spread_lines(H.docs(spark, rows), 3)
    H.same([tuple(x) for x in out.collect()], spread(rows, 3))
    assert line_spread.cut_spread_lines(H.docs(spark, [])).count() == 0


def test_rows_with_equal_or_null_ids_are_cut_each_by_their_own_text(spark):
    rows = [(100 + i, f"hot\nown {i}", f"s{i}") for i in range(8)]
    rows += [(50, "a\nb\nc\nd\nhot", "s1"), (50, "only", "s2"), (51, "hot\nx", "s3"), (51, "keep me\ny", "s3"), (51, "keep me\ny", "s3")]
    rows += [(None, "hot\nhot\nz", "s1"), (None, "z", None), (None, "one\ntwo\nthree\nhot", "s9"), (None, None, "s1")]
    H.same([tuple(x) for x in line_spread.cut_spread_lines(H.docs(spark, rows), 5).collect()], spread(rows, 5))


def items(spark, texts):
    return spark.createDataFrame([(i, t, 3) for i, t in enumerate(texts)], "item_id long, text string, h int")


def contained(rows, texts, n=5, percent=80):
    out = {}
    for j, t in enumerate(texts):
        q = H.shingles(t, n, short=False)
        for i, d, _ in rows:
            k = len(q & H.shingles(d, n, short=False))
            if q and i is not None and 100 * k >= percent * len(q):
                out[i, j] = (i, j, len(q), max(k, out.get((i, j), (0, 0, 0, 0))[3]))
    return list(out.values())


def test_passages_in_long_documents(spark):
    r = random.Random(6)
    texts = [" ".join(f"b{r.randrange(500)}" for _ in range(r.randint(6, 60))) for _ in range(25)] + ["too short", None, "", "x " * 40]
    rows = []
    for i in range(120):
        w = [f"d{r.randrange(900)}" for _ in range(r.randint(0, 800))]
        for t in r.sample(texts[:25], r.choice([0, 0, 1, 1, 2, 20])):
            p = t.split()
            for _ in range(r.choice([0, 0, 1, 2])):
                p[r.randrange(len(p))] = "changed"
            at = r.randrange(len(w) + 1)
            w[at:at] = [x.upper() for x in p]
        rows.append((i, " ".join(w), "s"))
    rows += [(900, "x " * 300, "s"), *[x for x in H.odd_rows() if x[0] != 10]]
    want = contained(rows, texts)
    frame = H.docs(spark, rows)
    assert len(want) > 60
    H.same([tuple(x) for x in contamination.contaminated(frame, items(spark, texts)).collect()], want)
    left = contamination.without_contaminated(frame, items(spark, texts))
    gone = {x[0] for x in want}
    assert left.columns == frame.columns
    H.same([x["doc_id"] for x in left.collect()], [i for i, _, _ in rows if i not in gone])


def test_no_items_or_documents(spark):
    none = items(spark, [])
    assert contamination.contaminated(H.docs(spark, H.odd_rows()), none).count() == 0
    assert contamination.contaminated(H.docs(spark, []), items(spark, ["a b c d e f"])).count() == 0


def test_shuffled_sides_give_the_same(spark, monkeypatch):
    rows = [(i, f"{i} a b c d e f g h {i}", "s") for i in range(20)]
    frame, bench = H.docs(spark, rows), items(spark, ["a b c d e f g h", "q r s t u v"])
    want = sorted(map(tuple, contamination.contaminated(frame, bench).collect()))
    monkeypatch.setattr(contamination, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, contamination.contaminated(frame, bench).collect())) == want and len(want) == 20


def test_needed_hashes(spark):
    row = spark.range(1).select(
        contamination.needed_hashes(F.lit(10), F.lit(8.0), 0.8, 1e-6).alias("tight"),
        contamination.needed_hashes(F.lit(10), F.lit(1024.0), 0.8, 1e-6).alias("loose"),
    ).first()
    assert 1 <= row["tight"] < 20 and row["loose"] > 1000


def test_hash_functions_are_independent(spark):
    both = spark.range(400).select((F.col("id") % 200).alias("id"), F.xxhash64("id").alias("h"))
    one = spark.range(200).select("id", F.xxhash64("id").alias("h"))
    a, b = (contamination._minima(x, "id", n, 64).select("id", "j", F.col("low").alias(n)) for x, n in ((both, "x"), (one, "y")))
    wins = a.join(b, ["id", "j"]).groupBy("id").agg(F.sort_array(F.collect_list(F.when(F.col("x") == F.col("y"), F.col("j")))).alias("js")).collect()
    # Which of two elements is the least differs from pair to pair, and is the first under half of the functions.
    assert len({tuple(r["js"]) for r in wins}) == 200
    assert abs(sum(len(r["js"]) for r in wins) / (200 * 64) - 0.5) < 0.05
