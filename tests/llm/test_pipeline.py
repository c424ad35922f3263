"""The corpus pipeline against its stages done by hand."""

import corpus_pipeline
import helpers as H

from lapwise.llm import queries

SF = "/root/testdata/sf0.001"


def write(spark, folder, docs, labels, bench):
    H.docs(spark, docs).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_stages_and_run(spark, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontaminate", "mix"]
    docs = H.near_copies(3, groups=10, size=5, length=40)
    docs += [(200 + i, " ".join(f"junk{j}" for j in range(i, i + 30)), "s1") for i in range(0, 300, 31)]
    docs += [(600, "q0 q1 q2 q3 q4 q5 q6 q7 q8 t1 t2 t3", "s0"), (601, docs[0][1].replace(" ", "  "), "s2")]
    labels = [(i, 0 if 200 <= i < 600 else 1, 0) for i, _, _ in docs]
    bench = [(0, "q0 q1 q2 q3 q4 q5 q6 q7 q8")]
    write(spark, str(tmp_path), docs, labels, bench)
    folder = f"file://{tmp_path}"
    rows = [r for r in docs if not 200 <= r[0] < 600]
    stay = {i for (i, _, _), (_, keep, *_) in zip(rows, H.exact_groups(rows)) if i == keep}
    rows = [r for r in rows if r[0] in stay]
    stay = {i for i, _, c in H.component_ids(rows, 5, 80) if i == c}
    want = sorted(stay - {600})
    out = corpus_pipeline.run(spark, folder)
    sizes = {i: len(H.words(t)) for i, t, _ in docs}
    got = out.collect()
    # The mix may take nothing of some documents.
    assert {r["doc_id"] for r in got} <= set(want)
    assert {"doc_id", "text", "lang", "source", "n_chars", "size", "source_size", "target", "taken"} == set(out.columns)
    assert all(r["size"] == sizes[r["doc_id"]] and 0 < r["taken"] <= 2 * r["size"] for r in got)
    total = sum(sizes[i] for i in want)
    assert abs(sum(r["taken"] for r in got) - 1.5 * total) <= 3


def test_toxic_rows_go(spark, tmp_path):
    docs = [(i, f"u{i} " + " ".join(f"c{(7 * i + j) % 40}" for j in range(30)), "s0") for i in range(60)]
    docs += [(100 + i, f"u{100 + i} " + " ".join(f"tox{(7 * i + j) % 40}" for j in range(30)), "s1") for i in range(20)]
    labels = [(i, 1, int(i >= 100)) for i, _, _ in docs]
    write(spark, str(tmp_path), docs, labels, [(0, "none of these words is in any text")])
    sf = f"file://{tmp_path}"
    kept = corpus_pipeline.select_quality(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)
    assert {r["doc_id"] for r in kept.collect()} == set(range(60))
    got = {r["doc_id"] for r in corpus_pipeline.run(spark, sf).collect()}
    assert got and got <= set(range(60))


def test_queries_and_entry():
    import __spark_entry__ as entry

    assert {f"op{n}_" for n in range(1, 14)} == {q[: q.index("_") + 1] for q in queries.QUERIES}
    assert set(queries.SQL) <= set(queries.QUERIES) <= set(entry.queries())
    assert "pipeline" in entry.queries() and "pipeline" not in entry.oracle_sql()


def test_queries_match_sql(spark):
    from oracle_check import compare, connect

    con = connect(SF)
    for name, sql in queries.SQL.items():
        result = compare(spark, con, name, queries.QUERIES[name], sql, SF)
        assert result.startswith("ok"), f"{name}: {result}"
