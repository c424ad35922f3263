"""Exact dedup and source mixing."""

from collections import defaultdict

import helpers as H
from pyspark.sql import functions as F

from lapwise.llm import exact_dedup, mixing


def test_groups_match_brute_force(spark):
    rows = H.odd_rows()
    for per_salt in (100_000, 2):
        out = exact_dedup.duplicate_groups(H.docs(spark, rows), rows_per_salt=per_salt).collect()
        H.same([(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in out], H.exact_groups(rows))
        assert sum(r["kept"] for r in out) == len({w[3] for w in H.exact_groups(rows)})
        assert all(r["doc_id"] == r["keep_id"] for r in out if r["kept"])


def test_a_large_group_is_cut_by_salts(spark):
    rows = [(i, "same text", "a") for i in range(300)] + [(300 + i, f"own {i}", "a") for i in range(50)]
    out = exact_dedup.duplicate_groups(H.docs(spark, rows), rows_per_salt=20)
    assert out.filter("kept").count() == 51
    assert {(r["keep_id"], r["group_size"]) for r in out.filter("doc_id < 300").collect()} == {(0, 300)}


def test_kept_rows_keep_their_text_and_columns(spark):
    rows = H.odd_rows()
    frame = H.docs(spark, rows)
    out = exact_dedup.without_duplicates(frame, rows_per_salt=3)
    assert out.columns == frame.columns
    got = [(r["doc_id"], r["text"], r["source"], r["h"]) for r in out.collect()]
    assert len(got) == len(set(got)) == len({w[3] for w in H.exact_groups(rows)})
    assert {(1, rows[0][1], "a", 1), (4, None, "a", 1), (7, "one", "a", 1)} <= set(got)


def test_one_read_of_the_texts_serves_both_steps(spark):
    out = exact_dedup.duplicate_groups(H.docs(spark, H.odd_rows()))
    out.collect()
    assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()


def test_empty_tables(spark):
    empty = H.docs(spark, [])
    assert exact_dedup.duplicate_groups(empty).count() == 0
    assert exact_dedup.without_duplicates(empty).count() == 0
    assert mixing.mix_sources(empty).count() == 0


def mixed(spark, rows, **options):
    return mixing.mix_sources(H.docs(spark, rows), **options).collect()


def test_targets_are_met(spark):
    rows = [(i, "w " * (i % 17 + 1), "abcd"[i % 4] if i % 5 else None) for i in range(600)]
    out = mixed(spark, rows, bin_rows=7)
    by = defaultdict(list)
    for r in out:
        by[r["source"]].append(r)
        assert 0 <= r["taken"] <= 2 * r["size"]
    total = sum(r["size"] for r in out)
    targets = {s: rs[0]["target"] for s, rs in by.items()}
    assert abs(sum(targets.values()) - 1.5 * total) < 1e-6
    weights = dict(zip([*sorted(s for s in by if s), None], [5, 2, 1, 5, 2]))
    free = {s: targets[s] / weights[s] for s, rs in by.items() if targets[s] < 2 * rs[0]["source_size"]}
    assert max(free.values()) - min(free.values()) < 1e-9
    for s, rs in by.items():
        assert rs[0]["source_size"] == sum(r["size"] for r in rs)
        assert abs(sum(r["taken"] for r in rs) - targets[s]) <= 0.5
    assert sorted(map(repr, mixed(spark, rows, bin_rows=10_000))) == sorted(map(repr, out))


def test_complete_passes_come_first(spark):
    out = mixed(spark, [(i, "w w w", "a") for i in range(40)])
    assert {r["taken"] for r in out} == {3, 6} and sum(r["taken"] for r in out) == 180


def test_weights_change_who_is_taken(spark):
    rows = [(i, "w", "a") for i in range(1000)] + [(1000 + i, "w", "b") for i in range(1000)]
    weights = spark.range(2000).select(F.col("id").alias("w_id"), F.when(F.col("id") % 2 == 0, 4.0).otherwise(1.0).alias("weight"))
    out = mixed(spark, rows, weights=weights, pattern=(1.0,), share=0.5, max_passes=2)
    taken = [sum(r["taken"] for r in out if r["doc_id"] % 2 == k) for k in (0, 1)]
    assert sum(taken) == 1000 and taken[0] > 1.8 * taken[1]


def test_odd_rows_are_mixed(spark):
    rows = H.odd_rows()
    out = mixed(spark, rows)
    assert len(out) == len(rows)
    assert all(r["taken"] == 0 for r in out if r["size"] == 0)
    assert {r["size"] for r in out} >= {0, 1, 8, 30_000}


def test_mixed_documents_keep_rows(spark):
    out = mixing.mixed_documents(H.docs(spark, H.odd_rows()[:2] + H.odd_rows()[4:8]))
    assert {"doc_id", "text", "h", "size", "target", "taken"} <= set(out.columns)
    assert all(r["taken"] > 0 for r in out.collect()) and out.count() == 3


def test_mixed_documents_keep_clashing_columns(spark):
    names = ["m_id", "m_source", "__size", "o_id", "weight", "bin", "w_id", "l_id", "k_id", "text_key"]
    rows = H.docs(spark, H.odd_rows()).select("*", *[F.lit(k).alias(c) for k, c in enumerate(names)])
    out = mixing.mixed_documents(rows)
    assert out.columns == [*rows.columns, "size", "source_size", "target", "taken"]
    got = out.collect()
    assert got and all(r[c] == k for r in got for k, c in enumerate(names))
    again = mixing.mixed_documents(out.withColumn("taken", F.lit(-1)))
    assert again.columns == out.columns and again.filter("taken < 0").count() == 0
