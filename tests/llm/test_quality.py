import re

import numpy as np
import pytest

from rescuelens.llm import quality, queries

BLANK = r"[^\x20\x09-\x0D]+"


def brute(text):
    text = text or ""
    words, windows, covered = re.findall(BLANK, text), {}, set()
    for k in range(len(words) - 7):
        windows.setdefault(tuple(words[k:k + 8]), []).append(k)
    for at in windows.values():
        if len(at) > 1:
            covered.update(p for k in at for p in range(k, k + 8))
    seen, repeated = set(), 0
    for line in text.split("\n"):
        repeated += bool(re.search(BLANK, line)) and line in seen
        seen.add(line)
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered)]


TEXTS = [None, "", " \n\t ", "one", "a b c d e f g h " * 3, "x " * 40, "l\n\n\nl\n l\nl", "é ü #$ <b> | Übermaß\u00a0x\x85y\x1cz",
         "A a A a A a A a a A", "w " * 7, "same line\n" * 500, "long words " + "y" * 70_000, "p q r s t u v w\np q r s t u v w"]


def test_counts_against_brute_force(docs, monkeypatch):
    rows = list(enumerate(TEXTS))
    for size in (1 << 20, 64):
        monkeypatch.setattr(quality.textscan, "SLICE", size)
        out = quality.scored(docs(rows), None).collect()
        for r in out:
            assert [r[n] for n in quality.COUNTS] == brute(TEXTS[r.doc_id]), r.doc_id
            assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
            assert r.kept == (not r.base_failed)


def test_long_text_in_parts():
    from rescuelens.llm import textscan
    rng = np.random.default_rng(0)
    text = " ".join("w%d" % k for k in rng.integers(0, 300, 400_000)).encode()
    data = np.frombuffer(text, np.uint8)
    hashes, row, first, last = textscan.words_of(data, np.zeros(1, np.int64), lower=False)
    assert len(hashes) == 400_000 and not row.any()
    assert len(set(hashes.tolist())) == len(set(text.split()))
    assert [text[a:b] for a, b in zip(first[-5:], last[-5:])] == text.split()[-5:]


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    out = queries.op9_quality(spark, sf_dir).collect()
    assert len(out) == len(texts)
    for r in out:
        assert [r[n] for n in quality.COUNTS] == brute(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_held_out_accuracy(spark):
    """Fitted on a sample, judged on labelled rows that it has not seen."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    unseen = labels.filter("doc_id % 3 = 0")
    model = quality.train(docs, labels.filter("doc_id % 3 <> 0"))
    rated = {r.doc_id: r.kept for r in quality.scored(docs.join(unseen, "doc_id", "left_semi"), model).collect()}
    good = [rated[r.doc_id] for r in unseen.filter("quality = 1").collect() if r.doc_id in rated]
    bad = [rated[r.doc_id] for r in unseen.filter("quality = 0").collect() if r.doc_id in rated]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.15


def test_labels_of_one_class_or_none(docs, spark):
    labels = spark.createDataFrame([(1, 1, 0), (99, 1, 0), (None, 0, 0), (1, 1, None)], "doc_id long, quality int, toxic int")
    frame = docs([(1, "some words " * 12), (2, None)])
    for some in (labels, labels.limit(0)):
        assert quality.rate(frame, some).filter("quality is not null").count() == 0


def test_kept_rows_have_all_columns(docs, spark):
    words = " ".join(f"w{k}" for k in range(30))
    frame = docs([(1, words), (2, "few words"), (3, None), (4, words)])
    out = quality.kept_rows(frame, None)
    assert out.columns == frame.columns and sorted(r.doc_id for r in out.collect()) == [1, 4]
    assert quality.kept_rows(docs([]), None).collect() == []


@pytest.mark.parametrize("rows", [1, 5])
def test_sample_is_bounded(spark, sf_dir, rows):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    assert quality.labelled_sample(docs, labels, rows).count() <= 2 * rows
