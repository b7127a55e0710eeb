import zlib

import numpy as np
import pytest

from rescuelens.llm import toxicity


def random_index(seed, examples=300, terms=40):
    rng = np.random.default_rng(seed)
    lists = [np.unique(rng.integers(0, terms, rng.integers(0, 6))) for _ in range(examples)]
    counts = [rng.integers(1, 5, len(x)) for x in lists]
    toxic = rng.random(examples) < 0.3
    idf = rng.random(terms) * 3 + 1
    index = toxicity.build_index(lists, counts, np.arange(examples), toxic, np.ones(examples), idf)
    dense = np.zeros((len(index.ids), terms))
    for place, doc in enumerate(index.ids):
        if len(lists[doc]):
            dense[place, lists[doc]] = index.vector(lists[doc], counts[doc])
    return rng, index, dense


@pytest.mark.parametrize("seed", range(4))
def test_nearest_are_exact(seed):
    rng, index, dense = random_index(seed)
    for _ in range(60):
        terms = np.unique(rng.integers(0, 40, rng.integers(1, 7)))
        vector = index.vector(terms, rng.integers(1, 4, len(terms)))
        places, scores = index.nearest(terms, vector, 10)
        cosines = dense[:, terms] @ vector
        want = np.lexsort((np.arange(len(cosines)), -np.round(cosines, 9)))[:10]
        want = want[cosines[want] > 0]
        assert np.allclose(scores, cosines[want])
        assert np.allclose(cosines[places], scores)


def test_most_blocks_are_not_visited():
    _, index, _ = random_index(9, 3000)
    visited = []
    postings = index.postings
    index.postings = {k: visited.append(1) or v for k, v in enumerate(postings)}

    class Counted(dict):
        def __getitem__(self, key):
            visited.append(key)
            return dict.__getitem__(self, key)
    index.postings = Counted(enumerate(postings))
    visited.clear()
    index.nearest(np.array([3]), np.array([1.0]), 5)
    assert len(visited) < index.block_max.shape[1] / 2


def test_held_out_rows_and_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    out = toxicity.scored(docs, labels).collect()
    assert len(out) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    learned = {e.doc_id for r in out for e in r.evidence}
    assert learned and all(zlib.crc32(str(k).encode()) % 3 != 1 for k in learned)
    judged = [(truth[r.doc_id], r.predicted) for r in out if r.held_out and r.doc_id in truth]
    hits = sum(t and p for t, p in judged)
    assert hits / sum(p for _, p in judged) > 0.95
    assert hits / sum(t for t, _ in judged) > 0.7


def test_labels_of_held_out_rows_change_nothing(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    from pyspark.sql import functions as F
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r.doc_id: r.score for r in toxicity.scored(docs, x).collect()} for x in (labels, turned))
    assert a == b


def test_edge_rows(docs, spark):
    labels = spark.createDataFrame([(k, 0, int(k % 2 == 0)) for k in range(60)] + [(None, 1, 1), (999, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    rows = [(k, f"plain words {'idiot fool' if k % 2 == 0 else 'nice day'} number{k}") for k in range(60)]
    rows += [(100, None), (101, ""), (102, "You IDIOT, fool!"), (102, "nothing"), (103, "idiot " * 30_000), (None, "idiot")]
    out = toxicity.scored(docs(rows), labels).collect()
    assert len(out) == len(rows)
    assert [r.held_out for r in out if r.doc_id is None] == [False]
    scores = {r.doc_id: r.score for r in out if r.doc_id != 102}
    assert scores[103] > 0.7 and scores[100] == scores[101] < 0.3
    assert max(r.score for r in out if r.doc_id == 102) > 0.7


@pytest.mark.parametrize("toxic", [[], [0, 0], [1]])
def test_labels_of_one_class_or_none(docs, spark, toxic):
    labels = spark.createDataFrame([(k, 0, t) for k, t in enumerate(toxic)], "doc_id long, quality int, toxic int")
    out = toxicity.scored(docs([(0, "a"), (1, "b"), (2, None)]), labels).collect()
    assert len(out) == 3 and len({r.score for r in out}) == 1
    assert toxicity.scored(docs([]), labels).collect() == []
