import pytest

from rescuelens.llm import line_dedup
from pyspark.sql import functions as F

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def brute(rows):
    first = {}
    for k, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                first[key(line)] = min(k, first.get(key(line), k))
    out = {}
    for k, text in rows:
        lines = (text or "").split("\n")
        keep = [len(key(x)) < 10 or first[key(x)] == k for x in lines]
        out[k] = (len(lines), keep.count(False), "\n".join(x for x, y in zip(lines, keep) if y))
    return out


ROWS = [
    (5, "A shared line here\nown line of five\n\nshort\nshort"), (3, "own line of three\n  a SHARED line here\t\n"),
    (4, "a shared line here"), (7, None), (8, ""), (9, "\n\n"), (10, "Élan vital déjà\nélan vital déjà"),
    (11, "élan vital déjà"), (12, "repeated in one\nrepeated in one"), (13, "ten chars!\nnine char\n\x1fa shared line here"),
    (14, "nine char\nten chars!\nten chars! \r\nx"), (15, " ten chars!"), (16, "line of many\n" * 3000 + "last one of all"),
    (2, "line of many\nlast one of all")]


@pytest.mark.parametrize("salts", [1, 16])
def test_against_brute_force(docs, salts):
    out = line_dedup.with_bitmaps(docs(ROWS).select("doc_id", "text"), salts=salts).withColumn(
        "kept", line_dedup.kept_text(F.col("text"), F.col("line_runs"))).collect()
    assert {r.doc_id: (r.line_n, r.line_dropped, r.kept) for r in out} == brute(ROWS)
    for r in out:
        assert sum(r.line_runs) == r.line_n and sum(r.line_runs[1::2]) == r.line_dropped


def test_hot_line(docs):
    rows = [(k, f"the very same line\nline number {k % 70} of some") for k in range(600)]
    out = line_dedup.with_bitmaps(docs(rows).select("doc_id", "text")).collect()
    assert {r.doc_id: r.line_dropped for r in out} == {k: v[1] for k, v in brute(rows).items()}


def test_lines_of_one_hash_are_told_apart(docs):
    """Two lines that xxhash64 does not tell apart by itself."""
    one, two = (f"{a} of the hash they share {b} and so on to the end of" for a, b in
                [("the line", "and more"), ("-fhdv):-", "9 03a7e?")])
    out = line_dedup.with_bitmaps(docs([(1, one), (2, two)]).select(
        "doc_id", "text", F.xxhash64("text").alias("hash"))).collect()
    assert one != two and len({r.hash for r in out}) == 1
    assert [r.line_dropped for r in out] == [0, 0]


def test_rows_without_an_id_and_repeated_rows(docs):
    rows = [(None, "a line that is shared\nx"), (3, "a line that is shared\ny"), (4, "z\na line that is shared"),
            (4, "z\na line that is shared")]
    out = line_dedup.with_bitmaps(docs(rows).select("doc_id", "text")).collect()
    assert sorted((str(r.doc_id), r.line_dropped, r.line_runs) for r in out) == [
        ("3", 0, [2]), ("4", 1, [1, 1, 0]), ("4", 1, [1, 1, 0]), ("None", 0, [2])]


def test_empty_table(docs):
    assert line_dedup.with_bitmaps(docs([]).select("doc_id", "text")).collect() == []


def test_without_repeats_drops_what_is_left_empty(docs):
    frame = docs(ROWS)
    out = line_dedup.without_repeats(frame)
    assert out.columns == frame.columns
    want = {k: v[2] for k, v in brute(ROWS).items()
            if v[1] == 0 or any(key(x) for x in v[2].split("\n"))}
    got = {r.doc_id: r.text for r in out.collect()}
    assert got.pop(7) is None and want.pop(7) == ""
    assert got == want
    assert all(r.n_chars == len(r.text) for r in out.filter("text is not null").collect())


def test_native_plan(docs):
    plan = line_dedup.with_bitmaps(docs(ROWS).select("doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "shufflepartitionidpassthrough" in plan


def test_short_lines_are_left(docs):
    out = line_dedup.without_repeats(docs([(1, "A header that is shared\nbody"), (2, "A header that is shared\nO Rose,\nart sick.")]))
    assert {r.doc_id: r.text for r in out.collect()} == {1: "A header that is shared\nbody", 2: "O Rose,\nart sick."}


def test_columns_of_any_name(spark):
    names = ("dropped", "line_doc", "row", "pos", "line_dropped", "hash")
    rows = [(1, "a line that is shared\nx", *names), (2, "a line that is shared\ny", *names)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    assert sorted(tuple(r) for r in line_dedup.without_repeats(frame).collect()) == [rows[0], (2, "y", *names)]
    assert [r.line_dropped for r in line_dedup.with_bitmaps(frame).orderBy("doc_id").collect()] == [0, 1]


def test_texts_are_split_once(docs):
    plan = line_dedup.dropped_lines(docs(ROWS))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("posexplode") == 1 and "Union" not in plan
