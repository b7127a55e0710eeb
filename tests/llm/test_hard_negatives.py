import math
import random

import pytest
from pyspark.sql import functions as F

from rescuelens.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, score string, negative int, windows string"
NAMES = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def run(spark, rows, anchors=5):
    frame = spark.createDataFrame([(k, v, l, "x", 1, "y") for k, v, l in rows], SCHEMA)
    out = hard_negatives.hard_negatives(frame, F.col("vec_id") % anchors == 0, F.col("label"))
    assert out.columns == list(NAMES)
    return sorted(tuple(r) for r in out.collect())


def brute(rows, anchors=5):
    used = {}
    for k, v, label in rows:
        if k is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (label, v)
        used[k] = min(used.get(k, row), row)
    whole = {k: (label, [math.floor(256 * x) for x in v]) for k, (label, v) in used.items()}
    out = []
    for a, (label, v) in whole.items():
        if a % anchors:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), k, other) for k, (other, w) in whole.items() if k != a)
        for score, p in [(-s, k) for s, k, other in scored if other == label][:5]:
            fit = [(k, -s) for s, k, other in scored if other != label and 50 * score <= -100 * s <= 95 * score][:3]
            out += [(a, p, n + 1, k, score, s) for n, (k, s) in enumerate(fit)]
    return sorted(out)


def vectors(seed, n, dims, labels, hot=0):
    rng = random.Random(seed)
    same = [round(rng.gauss(0, .3), 2) for _ in range(dims)]
    # halves, quarters and so on are exact as floats; many scores are equal
    return [(k, list(same) if rng.random() < hot else [rng.randrange(-8, 9) / 8 for _ in range(dims)],
             rng.randrange(labels)) for k in range(-n // 2, n // 2)]


def as_float(rows):
    import numpy as np
    return [(k, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label)
            for k, v, label in rows]


@pytest.mark.parametrize("dims, labels, hot", [(3, 3, 0), (2, 2, .4), (6, 40, .1)])
def test_against_all_pairs(spark, dims, labels, hot):
    rows = as_float(vectors(dims, 160, dims, labels, hot))
    want = brute(rows)
    assert run(spark, rows) == want and want


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ANCHORS", 7)
    monkeypatch.setattr(hard_negatives, "ROWS", 20)
    rows = as_float(vectors(9, 200, 3, 3, .3))
    assert run(spark, rows) == brute(rows)


def test_edge_rows(spark):
    rows = [(0, [1.0, 1.0], 1), (1, [1.0, 1.0], 1), (2, [.5, 1.0], 2), (3, [1.0, .75], 2), (4, [.75], 2),
            (5, [], 1), (6, None, 1), (7, [1.0, None], 2), (8, [float("nan"), 1.0], 2),
            (9, [float("inf"), 1.0], 2), (10, [0.0, 0.0], 1), (11, [0.0, 0.0], 3), (None, [1.0, 1.0], 2),
            (12, [1.0, .5], None), (2, [.5, 1.0], 2), (1, [1.0, 1.0], 1), (3, [1.0, .8], 2), (15, [-1.0, 2.0, 4.0], 3)]
    rows = as_float(rows)
    want = brute(rows)
    assert run(spark, rows) == want and any(r[4] == 0 for r in want)
    assert run(spark, []) == [] and run(spark, rows[1:4]) == []


def test_large_components(spark):
    rows = as_float([(0, [2.0 ** 20, 3.0], 1), (1, [2.0 ** 20 + 8, 1.0], 1), (2, [2.0 ** 19 + 4, 5.0], 2)])
    assert run(spark, rows) == brute(rows) != []
    huge = as_float([(0, [1e30], 1), (1, [1e30], 1)])
    with pytest.raises(Exception, match="may not fit into a long"):
        run(spark, huge)


def test_one_pass_holds_only_open_windows():
    """A stream of any length: what it reads is never kept."""
    def keys():
        for score in range(10 ** 6, 10 ** 6 - 5, -1):
            yield pack(score, False, score), None
        for score in range(999_000, 400_000, -1):
            yield pack(score, True, score), None
            yield pack(score, True, score), None

    def pack(score, negative, row):
        return hard_negatives._KEY.pack(7 + (1 << 63), (1 << 64) - 1 - (score + (1 << 63)), negative, row + (1 << 63))

    out = list(hard_negatives._windows(keys()))
    assert len(out) == 15 and [r[2] for r in out if r[1] == 10 ** 6] == [1, 2, 3]
    assert [r[3] for r in out if r[1] == 10 ** 6] == [950_000, 949_999, 949_998]


def test_packed_keys_sort_as_the_scores_do():
    class Row:
        def __init__(self, *values):
            self.anchor_id, self.score, self.negative, self.id = values
    rng = random.Random(1)
    rows = [(rng.choice([-50, 0, 50]), rng.randrange(-3, 4) * 10 ** 15, rng.random() < .5, rng.randrange(-9, 9))
            for _ in range(400)]
    by_key = sorted(rows, key=lambda r: hard_negatives._packed(Row(*r))[0])
    assert by_key == sorted(rows, key=lambda r: (r[0], -r[1], r[2], r[3]))
