import unicodedata

import pytest
from pyspark.sql import functions as F

from rescuelens.functions import text
from tests import brute
from tests.samples import ALL


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(list(enumerate(ALL)), "id int, t string").cache()


def collected(df):
    return {r.id: r[1] for r in df.collect()}


def test_fold_is_case_folding(spark, rows):
    got = collected(rows.select("id", text.fold("t")))
    assert got == {i: t if t is None else t.casefold() for i, t in enumerate(ALL)}


def test_fold_of_every_special_character(spark):
    chars = [chr(c) for c in range(0x2FFFF) if not 0xD800 <= c <= 0xDFFF]
    # characters newer than the engine's Unicode tables are left out
    special = [c for c in chars if c.casefold() != c and unicodedata.age(c) < "14"] if hasattr(
        unicodedata, "age") else [c for c in chars if c.casefold() != c and ord(c) != 0x1C89]
    df = spark.createDataFrame([(c, f"a{c}B{c}") for c in special], "c string, t string")
    wrong = [r for r in df.select("t", text.fold("t").alias("f")).collect()
             if r.f != r.t.casefold()]
    assert not wrong


def test_norm_and_cluster(spark, rows):
    df = text.with_cluster_id(text.with_norm_text(rows, "t", "n"), "n")
    got = {r.id: (r.n, r.cluster_id) for r in df.collect()}
    want = {i: (brute.clean(t), brute.cluster(brute.clean(t))) for i, t in enumerate(ALL)}
    assert got == want


def test_nfkc_of_every_character_that_changes(spark):
    chars = [chr(c) for c in range(0x2FFFF) if not 0xD800 <= c <= 0xDFFF]
    changing = [c for c in chars if unicodedata.normalize("NFKC", c) != c]
    joined = [a + b for a in "aeınoK" for b in "̧́̇ͅ"] + ["각"]
    df = spark.createDataFrame([(f"x{c}y",) for c in changing + joined], "t string")
    wrong = [r for r in df.select("t", text.nfkc("t").alias("n")).collect()
             if r.n != unicodedata.normalize("NFKC", r.t)]
    assert not wrong


def test_nfkc_hands_only_risky_rows_to_python(spark):
    safe = "İstanbul’da çığ düştü, ğüşöç 😀 – “su” Привет 水"
    df = spark.createDataFrame([("ascii only",), (safe,), ("a…",)], "t string")
    flags = [r[0] for r in df.select(text.may_hold(F.col("t"), text._nfkc_risks())).collect()]
    assert flags == [False, False, True]


def test_spaces(spark):
    raw = "\x1c a  \t b \n"
    df = spark.createDataFrame([(raw,)], "t string")
    row = df.select(text.strip("t"), text.collapse_spaces("t")).first()
    assert row[0] == raw.strip()
    assert row[1] == " a b "


def test_title_case(spark):
    words = ["kadıköy-moda", "ŞAHİNBEY", "istanbul", "-abc-", "a-b", "IĞDIR"]
    df = spark.createDataFrame([(w,) for w in words], "t string")
    assert [r[0] for r in df.select(text.title_case("t")).collect()] == [w.title() for w in words]


def test_evaluate_once_stays_in_one_stage(spark, rows):
    df = text.evaluate_once(rows, "f", text.fold_for_search("t"))
    df = df.filter(F.col("f").contains("a") | F.col("f").contains("b"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lower(") and "Contains(f" in plan
    assert "Exchange" not in plan
