"""Hard negatives by a secondary-sort shuffle of pair scores.

Every anchor is scored against all rows, in units of one block of anchors and one block of rows.
A unit streams its rows past its anchors and keeps, per anchor, the best few: an exact reduction
ahead of the shuffle, so that what an anchor sends does not depend on how many rows a label has.
Two rounds are made. The first finds the positives. The second knows their scores and keeps the
best different-label rows within the window of each.

Both meet in one shuffle. A pair is packed into a key of bytes whose order is (anchor, descending
score, positives first, id); ``repartitionAndSortWithinPartitions`` sorts the keys, and an
iterator reads them once: a positive opens its window, a negative goes to every open window that
it lies in, and a window closes when it is full or left behind. Nothing of an anchor is held but
its open windows.

A vector's components x count as floor(256 * x), scores are integer inner products. Rows without an
id, a label or a vector, or with a null or non-finite component, take no part. Shorter vectors
count as if zeros followed. Of rows with one id the one with the least (label, vector) counts,
copies of a row count once; equal scores are ordered by id. An empty table, or one without
anchors, gives no rows. Scores have to fit into a long, larger ones raise OverflowError. Extra
columns are ignored, whatever their names.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rescuelens.llm import staging

POSITIVES, NEGATIVES = 5, 3
#: a negative's score lies between these percentages of the positive's
LOW_PERCENT, HIGH_PERCENT = 50, 95
#: anchors of a unit, by number and by bytes of their vectors
ANCHORS, ANCHOR_BYTES = 4096, 1 << 25
#: rows of a unit, unless that makes too many blocks (an anchor gets a few rows from each)
ROWS, ROW_BLOCKS = 8192, 1024
#: rows scored at once, by number of scores
SCORES = 1 << 20

PAIR = "anchor_id long, score long, negative boolean, id long"
RESULT = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
          "negative_score long")
_KEY = struct.Struct(">QQBQ")
_SIGN, _ALL = 1 << 63, (1 << 64) - 1


def usable(vectors: DataFrame, label: Column) -> DataFrame:
    """(id, label, vector) of the rows that take part, one per id."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), label.cast("long").alias("label"),
                          F.col("embedding").alias("vector"), whole.alias("whole"))
    rows = rows.filter("id IS NOT NULL AND label IS NOT NULL AND whole")
    return rows.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("r")).select("id", "r.label", "r.vector")


def _matrix(column: pa.Array) -> np.ndarray:
    """floor(256 x) of all vectors, shorter ones filled up with zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = np.floor(256 * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = flat
    return out


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of two matrices of whole numbers."""
    width = min(left.shape[1], right.shape[1])
    left, right = left[:, :width], right[:, :width]
    largest = width * np.abs(left).max(initial=0) * np.abs(right).max(initial=0)
    if largest < 2 ** 53:
        return (left @ right.T).astype(np.int64)
    if largest < 2 ** 63:
        return left.astype(np.int64) @ right.astype(np.int64).T
    raise OverflowError("an inner product may not fit into a long")


class _Best:
    """The best ``size`` (score, id) of each place; rows come in the order of their ids."""

    def __init__(self, places: int, size: int) -> None:
        self.size = size
        self.place = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.id = np.zeros(0, np.int64)
        #: a later row has to beat this
        self.worst = np.full(places, np.iinfo(np.int64).min)
        self.full = np.zeros(places, bool)

    def add(self, place: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(place):
            return
        place, score, ids = (np.concatenate(x) for x in ((self.place, place), (self.score, score), (self.id, ids)))
        # scores are turned by ~, which cannot overflow
        order = np.lexsort((ids, ~score, place))
        place, score, ids = place[order], score[order], ids[order]
        first = np.searchsorted(place, place)
        rank = np.arange(len(place)) - first
        kept = rank < self.size
        self.place, self.score, self.id = place[kept], score[kept], ids[kept]
        last = rank == self.size - 1
        self.worst[place[last]], self.full[place[last]] = score[last], True

    def beaten(self, places: slice, scores: np.ndarray) -> np.ndarray:
        return ~self.full[places, None] | (scores > self.worst[places, None])


class _Unit:
    """One block of anchors, past which rows are streamed."""

    def __init__(self) -> None:
        self.ids, self.labels, self.vectors, self.windows = [], [], [], []
        self.best: list[_Best] | None = None

    def anchor(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, windows: list) -> None:
        self.ids.append(ids)
        self.labels.append(labels)
        self.vectors.append(vectors)
        self.windows += windows

    def _start(self) -> None:
        width = max((v.shape[1] for v in self.vectors), default=0)
        self.vectors = np.concatenate([np.pad(v, ((0, 0), (0, width - v.shape[1]))) for v in self.vectors])
        self.ids, self.labels = np.concatenate(self.ids), np.concatenate(self.labels)
        n = len(self.ids)
        self.mining = any(w is not None for w in self.windows)
        count, size = (POSITIVES, NEGATIVES) if self.mining else (1, POSITIVES)
        self.best = [_Best(n, size) for _ in range(count)]
        if self.mining:
            # bounds in hundredths as whole numbers: low <= 100 score <= high
            scores = [[w[k] if w and k < len(w) else None for w in self.windows] for k in range(POSITIVES)]
            self.low = np.array([[0 if s is None else -(-LOW_PERCENT * s // 100) for s in of] for of in scores])
            self.high = np.array([[-1 if s is None else HIGH_PERCENT * s // 100 for s in of] for of in scores])

    def rows(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        if not self.windows:
            return
        if self.best is None:
            self._start()
        step = max(1, SCORES // len(self.ids))
        for k in range(0, len(ids), step):
            of, own = ids[k:k + step], labels[k:k + step]
            scores = _products(self.vectors, vectors[k:k + step])
            same = self.labels[:, None] == own[None, :]
            if not self.mining:
                self._keep(self.best[0], same & (self.ids[:, None] != of[None, :]), scores, of)
                continue
            for best, low, high in zip(self.best, self.low, self.high):
                self._keep(best, ~same & (scores >= low[:, None]) & (scores <= high[:, None]), scores, of)

    @staticmethod
    def _keep(best: _Best, able: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        place, row = np.nonzero(able & best.beaten(slice(None), scores))
        best.add(place, scores[place, row], ids[row])

    def result(self) -> pa.RecordBatch:
        found = self.best or []
        place, score, ids = (np.concatenate([getattr(b, n) for b in found] or [np.zeros(0, np.int64)])
                             for n in ("place", "score", "id"))
        order = np.lexsort((ids, place))
        place, score, ids = place[order], score[order], ids[order]
        # a row may lie in several windows of an anchor
        new = np.ones(len(place), bool)
        new[1:] = (place[1:] != place[:-1]) | (ids[1:] != ids[:-1])
        place, score, ids = place[new], score[new], ids[new]
        anchors = self.ids[place] if found else ids
        negative = np.full(len(ids), bool(found) and self.mining)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (anchors, score, negative, ids)],
                                          ["anchor_id", "score", "negative", "id"])


def _score_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by unit, anchors first, each kind by id."""
    key, unit = None, _Unit()
    for batch in batches:
        if not batch.num_rows:
            continue
        a, r, scored = (batch.column(n).to_numpy(zero_copy_only=False)
                        for n in ("anchor_block", "row_block", "scored"))
        new = np.flatnonzero((a[1:] != a[:-1]) | (r[1:] != r[:-1]) | (scored[1:] != scored[:-1])) + 1
        for start, stop in zip([0, *new], [*new, batch.num_rows]):
            if (a[start], r[start]) != key:
                if key is not None:
                    yield unit.result()
                key, unit = (a[start], r[start]), _Unit()
            part = batch.slice(start, stop - start)
            values = (part.column("id").to_numpy(), part.column("label").to_numpy(), _matrix(part.column("vector")))
            if scored[start]:
                unit.rows(*values)
            else:
                unit.anchor(*values, part.column("windows").to_pylist())
    if key is not None:
        yield unit.result()


def pair_scores(rows: DataFrame, anchors: DataFrame, anchor_blocks: int, row_blocks: int) -> DataFrame:
    """(anchor_id, score, negative, id): the best pairs of every anchor and block of rows.

    ``windows`` of an anchor holds the scores of its positives; where no anchor has one, the pairs
    are the positives.
    """
    own = F.pmod(F.xxhash64(F.lit(11), "id"), F.lit(anchor_blocks)).cast("int")
    block = F.pmod(F.xxhash64(F.lit(12), "id"), F.lit(row_blocks)).cast("int")

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = anchors.select(own.alias("anchor_block"), each(row_blocks).alias("row_block"),
                          F.lit(False).alias("scored"), "id", "label", "vector", "windows")
    right = rows.select(each(anchor_blocks).alias("anchor_block"), block.alias("row_block"),
                        F.lit(True).alias("scored"), "id", "label", "vector",
                        F.lit(None).cast("array<long>").alias("windows"))
    return (left.unionByName(right).repartition("anchor_block", "row_block")
            .sortWithinPartitions("anchor_block", "row_block", "scored", "id").mapInArrow(_score_units, PAIR))


def _packed(row) -> tuple[bytes, None]:
    return _KEY.pack(row.anchor_id + _SIGN, _ALL - (row.score + _SIGN), row.negative, row.id + _SIGN), None


def _windows(keys: Iterator[tuple[bytes, None]]) -> Iterator[tuple]:
    """Negatives of sorted keys. Held are the open windows of one anchor: (score, id, found)."""
    anchor, opened, before = None, [], None
    for key, _ in keys:
        if key == before:
            continue
        before = key
        of, turned, negative, row = _KEY.unpack(key)
        score, row = _ALL - turned - _SIGN, row - _SIGN
        if of != anchor:
            anchor, opened = of, []
        if not negative:
            opened.append([score, row, 0])
            continue
        opened = [w for w in opened if w[2] < NEGATIVES and 100 * score >= LOW_PERCENT * w[0]]
        for window in opened:
            if 100 * score <= HIGH_PERCENT * window[0]:
                window[2] += 1
                yield anchor - _SIGN, window[1], window[2], row, window[0], score


def _anchor_partition(partitions: int):
    def place(key: bytes) -> int:
        return (int.from_bytes(key[:8], "big") * 0x9E3779B97F4A7C15 & _ALL) * partitions >> 64
    return place


def mined(spark: SparkSession, pairs: DataFrame) -> DataFrame:
    """The negatives of each positive from all pairs of both kinds, in one pass over sorted keys."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = pairs.rdd.map(_packed).repartitionAndSortWithinPartitions(partitions, _anchor_partition(partitions))
    return spark.createDataFrame(keys.mapPartitions(_windows), RESULT)


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column) -> DataFrame:
    """Per anchor and positive: the first negatives in the positive's window, by rank.

    ``vectors`` has vec_id and embedding; ``is_anchor`` and ``label`` are expressions over it.
    """
    spark = vectors.sparkSession
    rows = staging.stage(usable(vectors, label), "vectors")
    chosen = vectors.filter(is_anchor).select(F.col("vec_id").cast("long").alias("id")).distinct()
    own = staging.stage(rows.join(chosen, "id", "left_semi"), "anchors")
    n_rows, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    per_block = max(1, min(ANCHORS, ANCHOR_BYTES // (8 * max(1, width))))
    blocks = max(1, -(-own.count() // per_block)), max(1, min(ROW_BLOCKS, -(-n_rows // ROWS)))

    first = pair_scores(rows, own.withColumn("windows", F.lit(None).cast("array<long>")), *blocks)
    best = W.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    positives = staging.stage(first.withColumn("n", F.row_number().over(best))
                              .filter(F.col("n") <= POSITIVES).drop("n"), "positives")
    windows = positives.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list("score").alias("windows"))
    negatives = pair_scores(rows, own.join(windows, "id"), *blocks)
    return mined(spark, positives.unionByName(negatives))
