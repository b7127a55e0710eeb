"""Queries with SQL, against it; entry points; the pipeline against plain Python."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from rescuelens.llm import queries
from tests.llm.test_decontamination import words as item_words
from tests.llm.test_line_dedup import brute as line_brute
from tests.llm.test_line_dedup import key as line_key
from tests.llm.test_near_dedup import brute as near_brute
from tests.llm.test_packing import check_places, ids_of, tokenizer

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def test_all_operators_are_registered():
    names = {re.match(r"op(\d+)_", n)[1] for n in entry.queries() if n.startswith("op")}
    assert names == {str(k) for k in range(1, 14)} and "pipeline" in entry.queries()
    assert set(queries.ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_equals_sql(spark, db, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    result = db.execute(queries.ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted(map(repr, result.fetchall()))
    assert sorted(map(repr, (tuple(r) for r in df.select(*columns).collect()))) == want and want


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_plans_have_no_cross_join(spark, sf_dir, name):
    plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


# --- pipeline ------------------------------------------------------------------------------


def has_window(text, items):
    w = item_words(text)
    own = {tuple(w[k:k + n]) for n in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10) for k in range(len(w) - n + 1)}
    return any(tuple(v[k:k + 10]) in own for v in items for k in range(max(1, len(v) - 9)) if v)


def test_stages_against_plain_python(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [item_words(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        out = spark.read.parquet(path)
        before = {r.doc_id: r for r in docs.collect()}
        if name == "packing":
            rows = out.collect()
            check_places(rows, 2048)
            ids = {}
            for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
                ids[r.doc_id] = ids.get(r.doc_id, b"") + bytes(r.ids)
            reference = tokenizer()
            assert ids == {k: ids_of(reference, r.text) + b"\0\0\0\0" for k, r in before.items()}
            break
        assert out.columns == docs.columns
        after = {r.doc_id: r for r in out.collect()}
        assert len(after) == out.count() > 0
        if name == "quality_rules":
            kept = {r.doc_id for r in queries.op9_quality(spark, sf_dir).filter("kept").collect()}
            assert set(after) == kept and all(after[k] == before[k] for k in after)
        elif name == "line_dedup":
            want = line_brute([(k, r.text) for k, r in before.items()])
            want = {k: v[2] for k, v in want.items()
                    if v[1] == 0 or any(line_key(x) for x in v[2].split("\n"))}
            assert {k: r.text for k, r in after.items()} == want
        elif name == "near_dedup":
            groups = near_brute([(k, r.text) for k, r in before.items()], 5)
            assert set(after) == {k for k, (_, c) in groups.items() if k == c}
        elif name == "decontamination":
            assert set(after) == {k for k, r in before.items() if not has_window(r.text, items)}
        docs = out


def test_run_equals_its_stages(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.count() == out.select("doc_id", "piece").distinct().count() > 0
    assert out.agg(F.max("length")).first()[0] <= 2048


def test_edge_rows(spark, sf_dir, docs):
    """Nulls, empty and repeated rows go through every stage."""
    words = " ".join(f"word{k}" for k in range(40))
    frame = docs([(1, words), (2, None), (3, ""), (None, words), (4, words), (4, words), (5, "x " * 50_000)])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, sf_dir)
        assert out.columns == frame.columns
        out.collect()
        assert stage(spark, frame.limit(0), sf_dir).collect() == []
    corpus_pipeline.STAGES[-1][1](spark, frame, sf_dir).collect()


def test_short_lines_survive_a_repeated_header(spark, sf_dir, docs):
    header = "A header that is shared"
    rows = [(1, f"{header}\nthe first body of all"), (2, f"{header}\nO Rose,\nart sick."), (3, f"{header}\n詩の行\n"),
            (4, f"{header}\n \n\t"), (5, header)]
    out = corpus_pipeline.repeated_lines(spark, docs(rows), sf_dir).collect()
    assert {r.doc_id: r.text for r in out} == {1: rows[0][1], 2: "O Rose,\nart sick.", 3: "詩の行\n"}
