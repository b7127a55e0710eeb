"""Quality rules: counts of a text, and a hashed n-gram logistic regression over it.

The model averages the weights of a text's word unigrams and bigrams and of its byte 3-grams
and 4-grams, each kind hashed to ``BUCKETS`` weights. It is fitted in one task on a bounded
sample of labelled rows (``SAMPLE_ROWS`` per class, whole texts), calibrated by a logistic
curve on every fifth of them with the classes weighted as in all labels, and sent to the tasks
as one array of fixed size. Scoring is vectorised over Arrow batches.

Null and empty texts have no words and fail the base rule. Without labels of both classes the
verdict is the base rule alone. Labels that appear twice for a document train twice; labels
without a document are ignored. Extra columns pass through or are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rescuelens.llm import textscan

#: labelled rows of each class the model is fitted on, at most
SAMPLE_ROWS = 1500
BUCKETS = 1 << 16
KINDS = 4
#: a text goes if its calibrated probability of being good is below this
LEAST_QUALITY = 0.5
#: base rule: fewest words, and largest share of words in repeated windows, in percent
LEAST_WORDS, MOST_REPEATED = 20, 30
REPEAT_WINDOW = 8

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_BLANKS = b" \t\n\x0b\x0c\r"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SCORED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("row_key", T.LongType()),
                       *[T.StructField(n, T.LongType()) for n in COUNTS],
                       T.StructField("quality", T.DoubleType())])


class Slice:
    """Consecutive whole texts: their bytes, rows and words."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> None:
        self.data, self.starts, self.stops, self.rows = data, starts, stops, len(starts)
        self.hashes, self.row, self.first, self.last = textscan.words_of(data, starts, lower=False)
        self.n_words = np.bincount(self.row, minlength=self.rows)

    def counts(self) -> list[np.ndarray]:
        letters = np.concatenate([[0], np.cumsum((self.data & 0xC0) != 0x80)])
        chars = np.bincount(self.row, letters[self.last] - letters[self.first], self.rows)
        symbols = np.concatenate([[0], np.cumsum(_SYMBOLS[self.data])])
        return [self.n_words, chars.astype(np.int64), symbols[self.stops] - symbols[self.starts],
                self._repeated_lines(), self._repeated_words()]

    def _repeated_lines(self) -> np.ndarray:
        found = np.zeros(self.rows, np.int64)
        for k, (a, b) in enumerate(zip(self.starts.tolist(), self.stops.tolist())):
            lines = self.data[a:b].tobytes().split(b"\n")
            if len(lines) > len(different := set(lines)):
                empty = [line for line in different if not line.strip(_BLANKS)]
                found[k] = (len(lines) - sum(map(lines.count, empty))
                            - len(different) + len(empty))
        return found

    def _repeated_words(self) -> np.ndarray:
        size, row = REPEAT_WINDOW, self.row
        if len(row) < size:
            return np.zeros(self.rows, np.int64)
        at = np.flatnonzero(row[size - 1:] == row[:len(row) - size + 1])
        factors = textscan.seeded(size, 11)
        key = row[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for k in range(size):
            key = key + self.hashes[at + k] * factors[k]
        key = textscan.mix(key)
        ordered = np.sort(key)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if not len(twice):
            return np.zeros(self.rows, np.int64)
        place = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
        starts = at[twice[place] == key]
        change = np.bincount(starts, minlength=len(row) + 1)
        change -= np.bincount(starts + size, minlength=len(row) + 1)
        return np.bincount(row[np.cumsum(change)[:-1] > 0], minlength=self.rows)

    def features(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per kind of n-gram: bucket, and where each text's n-grams begin and end."""
        words = np.concatenate([[0], np.cumsum(self.n_words)])
        shift = np.uint64(48)
        yield (self.hashes >> shift).astype(np.int64), words[:-1], words[1:]
        pair = (self.hashes[:-1] * np.uint64(3) + self.hashes[1:]) * np.uint64(0x9E3779B97F4A7C15)
        yield ((pair >> shift).astype(np.int64) + BUCKETS, np.minimum(words[:-1], len(pair)),
               np.minimum(np.maximum(words[1:] - 1, words[:-1]), len(pair)))
        wide = self.data.astype(np.uint32)
        grams = wide[:-2] | wide[1:-1] << np.uint32(8) | wide[2:] << np.uint32(16)
        for size in (3, 4):
            if size == 4:
                grams = grams[:-1] | wide[3:] << np.uint32(24)
            bucket = (grams * np.uint32(0x9E3779B1) >> np.uint32(16)).astype(np.int64)
            yield (bucket + (size - 1) * BUCKETS, np.minimum(self.starts, len(grams)),
                   np.minimum(np.maximum(self.stops - size + 1, self.starts), len(grams)))

    def raw_scores(self, weights: np.ndarray) -> np.ndarray:
        total = np.zeros(self.rows)
        for bucket, first, last in self.features():
            sums = np.concatenate([[0], np.cumsum(weights[bucket], dtype=np.float64)])
            total += (sums[last] - sums[first]) / np.maximum(last - first, 1)
        return total


def text_slices(column: pa.Array) -> Iterator[Slice]:
    data, offsets = textscan.raw_texts(column)
    for a, b in textscan.slices(offsets):
        yield Slice(data[offsets[a]:offsets[b]], offsets[a:b] - offsets[a],
                    offsets[a + 1:b + 1] - offsets[a])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _fit_weights(rows: list[tuple[np.ndarray, np.ndarray]], good: np.ndarray,
                 steps: int = 80) -> np.ndarray:
    """Logistic regression by Adam over sparse rows of (bucket, value)."""
    index = np.concatenate([r[0] for r in rows])
    value = np.concatenate([r[1] for r in rows])
    of = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    weights, mean, square = (np.zeros(KINDS * BUCKETS + 1) for _ in range(3))
    share = np.where(good, 0.5 / max(good.sum(), 1), 0.5 / max((~good).sum(), 1))
    for step in range(1, steps + 1):
        score = np.bincount(of, weights[index] * value, len(rows)) + weights[-1]
        error = (_sigmoid(score) - good) * share
        slope = np.bincount(index, error[of] * value, len(weights)) + 1e-6 * weights
        slope[-1] = error.sum()
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope ** 2
        weights -= 0.3 * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-9)
    return weights


def _fit_curve(score: np.ndarray, good: np.ndarray, share: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a weighted logistic curve, by Newton's method with a weak prior."""
    slope, offset = 1.0, 0.0
    design = np.stack([score, np.ones(len(score))], 1)
    for _ in range(30):
        p = _sigmoid(slope * score + offset)
        gradient = design.T @ ((p - good) * share) + 1e-3 * np.array([slope - 1, offset])
        curve = (design * (p * (1 - p) * share)[:, None]).T @ design + 1e-3 * np.eye(2)
        change = np.linalg.solve(curve, gradient)
        slope, offset = slope - change[0], offset - change[1]
    return float(slope), float(offset)


def fit(sample: DataFrame, shares: dict[int, int]) -> np.ndarray | None:
    """Weights, bias, slope and offset from a bounded table (text, quality).

    ``shares`` holds how many labels of each class there are in all; the curve follows them.
    """
    if not shares.get(0) or not shares.get(1):
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, good = [], []
        for batch in batches:
            good += batch.column("quality").to_pylist()
            for part in text_slices(batch.column("text")):
                kinds = list(part.features())
                for k in range(part.rows):
                    grams = [np.unique(b[f[k]:t[k]], return_counts=True) for b, f, t in kinds]
                    rows.append((np.concatenate([g[0] for g in grams]), np.concatenate(
                        [g[1] / max(t[k] - f[k], 1) for g, (_, f, t) in zip(grams, kinds)])))
        good = np.array(good, int) == 1
        if good.all() or not good.any():
            return
        held = np.arange(len(rows)) % 5 == 0
        used = [r for r, h in zip(rows, held) if not h]
        weights = _fit_weights(used, good[~held])
        score = np.array([weights[i] @ v + weights[-1] for (i, v), h in zip(rows, held) if h])
        truth = good[held]
        total = shares[0] + shares[1]
        share = np.where(truth, shares[1] / max(truth.sum(), 1), shares[0] / max((~truth).sum(), 1))
        curve = _fit_curve(score, truth, share / total * held.sum())
        packed = np.concatenate([weights, curve]).astype("<f4").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], ["model"])

    ordered = sample.select("text", "quality", "doc_id").repartition(1).sortWithinPartitions("doc_id")
    found = ordered.mapInArrow(run, "model binary").collect()
    return np.frombuffer(found[0].model, "<f4") if found else None


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``rows`` labelled documents per class, by a hash of the id, with whole texts."""
    pick = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality").filter(
        "quality IN (0, 1) AND doc_id IS NOT NULL")
    chosen = [pick.filter(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
              for q in (0, 1)]
    # two lists of at most `rows` numbers
    few = F.broadcast(chosen[0].unionByName(chosen[1]))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.join(few, "doc_id")


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> np.ndarray | None:
    shares = {r.quality: r["count"] for r in
              labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("quality").count().collect()}
    return fit(labelled_sample(docs, labels, rows), shares)


def _rated(column: pa.Array, model: np.ndarray | None) -> tuple[list[np.ndarray], np.ndarray | None]:
    """Counts and calibrated quality of a column of texts."""
    columns, quality = [[np.zeros(0, np.int64)] for _ in COUNTS], [np.zeros(0)]
    for part in text_slices(column):
        for into, found in zip(columns, part.counts()):
            into.append(found)
        if model is not None:
            slope, offset = model[-2:].astype(float)
            raw = part.raw_scores(model[:KINDS * BUCKETS]) + model[KINDS * BUCKETS]
            quality.append(_sigmoid(slope * raw + offset))
    return [np.concatenate(c) for c in columns], np.concatenate(quality) if model is not None else None


def scored(docs: DataFrame, model: np.ndarray | None) -> DataFrame:
    """Counts, calibrated quality (null without a model), and the verdict per row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, quality = _rated(batch.column("text"), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_key"), *(pa.array(c, pa.int64()) for c in counts),
                 pa.nulls(batch.num_rows, pa.float64()) if quality is None else pa.array(quality)],
                SCORED.names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.monotonically_increasing_id().alias("row_key"))
    failed = ((F.col("n_words") < LEAST_WORDS)
              | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))
    return rows.mapInArrow(run, SCORED).withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.coalesce("quality", F.lit(1.0)) >= LEAST_QUALITY))


def kept_rows(docs: DataFrame, model: np.ndarray | None) -> DataFrame:
    """The rows whose text is kept, with all their columns; nothing is joined or moved."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, quality = _rated(batch.column("text"), shared.value)
            words, repeated = counts[0], counts[COUNTS.index("n_repeat_words")]
            keep = (words >= LEAST_WORDS) & (100 * repeated <= MOST_REPEATED * words)
            yield batch.filter(pa.array(keep if quality is None else keep & (quality >= LEAST_QUALITY)))

    return docs.mapInArrow(run, docs.schema)


def rate(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Trains on the labels and scores every document."""
    return scored(docs, train(docs, labels, rows))
