import re

from rescuelens.llm import decontamination as dec

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(text, items, size):
    w, hit, found = words(text), set(), set()
    for item_id, item in items:
        v = words(item)
        for k in range(max(1, len(v) - size + 1) if v else 0):
            window = v[k:k + size]
            for at in range(len(w) - len(window) + 1):
                if w[at:at + len(window)] == window:
                    hit.update(range(at, at + len(window)))
                    found.add(item_id)
    return len(w), sorted(hit), sorted(found)


ITEMS = [(1, "One two, THREE four"), (2, "two three four five"), (3, "déjà vu"), (4, None), (5, "  "),
         (6, "One two, three four"), (7, "x")]
TEXTS = [(1, None), (2, ""), (3, "zero ONE--two\nthree four five six"), (4, "Il y a déjà vu; déjà vu vu"),
         (5, "one two three"), (6, "Éx x xx x"), (7, "one two three four " * 50), (7, "nothing here")]


def check(spark, docs, size, block_bytes):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = dec.overlaps(docs(TEXTS), items, size, block_bytes).collect()
    got = sorted((r.doc_id, r.n_words, [w for s in r.words_hit for w in range(s.first_word, s.last_word + 1)],
                  r.item_ids) for r in out)
    assert got == sorted((k, *brute(t, ITEMS, size)) for k, t in TEXTS)
    return out


def test_against_brute_force(spark, docs):
    for size in (1, 3, 10):
        check(spark, docs, size, 1 << 19)


def test_several_blocks_give_the_same(spark, docs):
    check(spark, docs, 3, 20)


def test_blocks_over_rows_out_of_a_shuffle(spark, docs):
    """Rows that come in another order each time they are computed."""
    from pyspark.sql import functions as F
    rows = [(k % 40, f"text {k} one two three four five {k}") for k in range(300)]
    shuffled = docs(rows).repartition(7).withColumn("r", F.rand()).sortWithinPartitions("r").drop("r")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = dec.overlaps(shuffled, items, 3, 20).collect()
    want = sorted((k, *brute(t, ITEMS, 3)) for k, t in rows)
    assert sorted((r.doc_id, r.n_words, [w for s in r.words_hit for w in range(s.first_word, s.last_word + 1)],
                   r.item_ids) for r in out) == want


def test_offsets_point_into_the_original(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    text = "«Ça!» zero ONE--two\nthree four, five six"
    row = dec.overlaps(docs([(1, text)]), items, 4).first()
    assert [text[s.start:s.end] for s in row.words_hit] == ["ONE--two\nthree four, five"]


def test_empty_tables(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert dec.overlaps(docs([]), items).collect() == []
    rows = dec.overlaps(docs(TEXTS), items.limit(0)).collect()
    assert all(r.words_hit == [] and r.item_ids == [] for r in rows) and len(rows) == len(TEXTS)
    assert dec.clean_rows(docs(TEXTS), items.limit(0)).count() == len(TEXTS)


def test_clean_rows_keep_all_columns(spark, docs):
    items = spark.createDataFrame(ITEMS[:2], "item_id long, text string")
    frame = docs(TEXTS)
    for block_bytes in (1 << 19, 10):
        out = dec.clean_rows(frame, items, 4, block_bytes)
        assert out.columns == frame.columns
        assert sorted(r.doc_id for r in out.collect()) == [1, 2, 4, 5, 6, 7]


def test_no_shuffle(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    plan = dec.overlaps(docs(TEXTS), items)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
