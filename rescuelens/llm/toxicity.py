"""Toxicity by the nearest labelled examples, exact TF-IDF cosine over a block-max inverted index.

Terms are words and beginnings of words (4, 5 and 6 bytes). From a bounded sample of labelled
examples (``TOXIC_EXAMPLES`` and ``CLEAN_EXAMPLES`` rows, whole texts) the ``TERMS`` terms are kept
that tell toxic ones best (likelihood ratio). One pass over all texts counts these terms; the
document frequencies come from all of them. Every example is indexed, and every text's ``NEAREST``
examples are found exactly: the index holds each term's largest weight per block of examples, blocks
are visited by falling upper bound, and the search ends when no block left can change the result.

Neighbours vote with their cosine, weighted by how many labelled rows an example stands for. The
votes are calibrated by a logistic curve on the examples themselves, each left out of its own vote.
A text without any term, empty ones included, gets the share among examples without any.

Null texts are empty. Without labels of both classes every score is the share of toxic labels, or 0.
Labels that appear twice for a document count once each; labels without a document are ignored.
Extra columns are ignored; of the documents only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rescuelens.llm import staging, textscan
from rescuelens.llm.decontamination import _TABLE
from rescuelens.llm.quality import _fit_curve, _sigmoid

#: labelled rows of each class that are indexed, at most
TOXIC_EXAMPLES, CLEAN_EXAMPLES = 2000, 4000
TERMS = 768
PREFIXES = (4, 5, 6)
NEAREST = 16
BLOCK = 64
#: a term is kept if so many toxic examples hold it at least, if its share among them is so many
#: times that among clean ones, and if the likelihood ratio is beyond what chance gives
LEAST_TOXIC, LEAST_RATIO, LEAST_WORTH = 5, 4, 8
#: weight of the share of toxic labels in every vote
PRIOR_WEIGHT = 0.2
THRESHOLD = 0.7
#: texts scored by one task
ROWS_A_TASK = 10_000

_SPLIT = np.frombuffer(_TABLE, np.uint8)
COUNTED = "doc_id long, row_key long, terms array<int>, counts array<int>"
SCORES = ("doc_id long, score double, "
          "evidence array<struct<doc_id: long, cosine: double, toxic: boolean>>")


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def term_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every term occurrence in consecutive texts."""
    data = _SPLIT[data]
    hashes, row, first, last = textscan.words_of(data, starts, lower=False)
    out, of = [hashes], [row]
    for size in PREFIXES:
        long = np.flatnonzero(last - first >= size)
        total = np.full(len(long), size, np.uint64)
        for k, factor in enumerate(textscan.seeded(size, 21)):
            total = total + (data[first[long] + k].astype(np.uint64) + np.uint64(1)) * factor
        out.append(textscan.mix(total))
        of.append(row[long])
    return np.concatenate(out), np.concatenate(of)


def _likelihood(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Log likelihood ratio of a term's counts, 0 where its shares are too much alike."""
    a, b = toxic + 0.5, clean + 0.5
    both = (a + b) / (n_toxic + n_clean + 1)
    ratio = a * np.log(a / (n_toxic + 1) / both) + b * np.log(b / (n_clean + 1) / both)
    return np.where(a / (n_toxic + 1) > LEAST_RATIO * b / (n_clean + 1), ratio, 0)


def telling_terms(sample: DataFrame, terms: int = TERMS) -> np.ndarray:
    """Sorted hashes of the terms that tell toxic examples best, from a bounded (text, toxic)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[bool, list[np.ndarray]] = {True: [], False: []}
        rows = {True: 0, False: 0}
        for batch in batches:
            toxic = np.array(batch.column("toxic").to_pylist()) == 1
            data, offsets = textscan.raw_texts(batch.column("text"))
            for a, b in textscan.slices(offsets):
                hashes, of = term_hashes(data[offsets[a]:offsets[b]], offsets[a:b] - offsets[a])
                order = np.lexsort((hashes, of))
                hashes, of = hashes[order], of[order]
                new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])])
                for label in (True, False):
                    found[label].append(hashes[new & (toxic[a:b][of] == label)] if len(hashes) else hashes)
            rows[True] += int(toxic.sum())
            rows[False] += int((~toxic).sum())
        names, toxic = np.unique(np.concatenate([*found[True], np.zeros(0, np.uint64)]), return_counts=True)
        names, toxic = names[toxic >= LEAST_TOXIC], toxic[toxic >= LEAST_TOXIC]
        others, times = np.unique(np.concatenate([*found[False], np.zeros(0, np.uint64)]), return_counts=True)
        clean = np.zeros(len(names))
        if len(others):
            place = np.minimum(np.searchsorted(others, names), len(others) - 1)
            clean = np.where(others[place] == names, times[place], 0)
        worth = _likelihood(toxic, clean, rows[True], rows[False])
        best = np.lexsort((names, -worth))[:terms]
        kept = np.sort(names[best[worth[best] >= LEAST_WORTH]])
        yield pa.RecordBatch.from_arrays([pa.array([kept.tobytes()], pa.binary())], ["terms"])

    ordered = sample.select("text", "toxic", "doc_id").repartition(1).sortWithinPartitions("doc_id")
    return np.frombuffer(ordered.mapInArrow(run, "terms binary").collect()[0].terms, np.uint64)


def term_counts(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """Per row the known terms (numbers in ``terms``) and how often each occurs."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        maybe = np.zeros(1 << 16, bool)
        maybe[(known & np.uint64(0xFFFF)).astype(np.int64)] = True
        for batch in batches:
            data, offsets = textscan.raw_texts(batch.column("text"))
            sizes, numbers, counts = [], [], []
            for a, b in textscan.slices(offsets):
                hashes, of = term_hashes(data[offsets[a]:offsets[b]], offsets[a:b] - offsets[a])
                some = np.flatnonzero(maybe[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
                hashes, of = hashes[some], of[some]
                if len(known):
                    place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                    hit = known[place] == hashes
                    pairs, times = np.unique(of[hit] * len(known) + place[hit], return_counts=True)
                else:
                    pairs, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
                sizes.append(np.bincount(pairs // max(len(known), 1), minlength=b - a))
                numbers.append(pairs % max(len(known), 1))
                counts.append(times)
            ends = pa.array(np.concatenate([[0], np.cumsum(np.concatenate([*sizes, []]))]), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([*x, []]), pa.int32()))
                     for x in (numbers, counts)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row_key"), *lists],
                                             ["doc_id", "row_key", "terms", "counts"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.monotonically_increasing_id().alias("row_key"))
    return rows.mapInArrow(run, COUNTED)


@dataclass
class Index:
    """Examples as unit vectors, ordered by their strongest term and cut into blocks."""

    idf: np.ndarray
    ids: np.ndarray
    toxic: np.ndarray
    stands_for: np.ndarray
    #: per term: examples, weights, and the largest weight per block
    postings: list[tuple[np.ndarray, np.ndarray]]
    block_max: np.ndarray
    none_score: float
    share: float
    curve: tuple[float, float] = (1.0, 0.0)

    def vector(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        weights = (1 + np.log(counts)) * self.idf[terms]
        return weights / np.sqrt((weights ** 2).sum())

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1
                ) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` examples of largest cosine (over 0; ties by place), and the cosines."""
        bound = weights @ self.block_max[terms]
        places, scores = np.zeros(0, np.int64), np.zeros(0)
        least = 0.0
        for block in np.argsort(-bound, kind="stable"):
            if bound[block] <= 0 or (len(scores) == k and bound[block] < least - 1e-12):
                break
            first, score = block * BLOCK, np.zeros(BLOCK)
            for term, weight in zip(terms, weights):
                if self.block_max[term, block] > 0:
                    at, values = self.postings[term]
                    a, b = np.searchsorted(at, (first, first + BLOCK))
                    score[at[a:b] - first] += weight * values[a:b]
            if first <= without < first + BLOCK:
                score[without - first] = 0
            own = np.flatnonzero(score > 0)
            places = np.concatenate([places, own + first])
            scores = np.concatenate([scores, score[own]])
            best = np.lexsort((places, -scores))[:k]
            places, scores = places[best], scores[best]
            least = scores[-1] if len(scores) else 0.0
        return places, scores

    def vote(self, places: np.ndarray, scores: np.ndarray) -> float:
        """Log odds of the neighbours' weighted vote."""
        weights = scores * self.stands_for[places]
        mean = self.stands_for.mean()
        total = weights.sum() + PRIOR_WEIGHT * mean
        p = ((weights * self.toxic[places]).sum() + PRIOR_WEIGHT * mean * self.share) / total
        p = min(max(p, 1e-4), 1 - 1e-4)
        return float(np.log(p / (1 - p)))


def build_index(terms: list[np.ndarray], counts: list[np.ndarray], ids: np.ndarray, toxic: np.ndarray,
                stands_for: np.ndarray, idf: np.ndarray) -> Index:
    """An index over the examples, with the curve fitted on their own left-out votes."""
    share = float((stands_for * toxic).sum() / max(stands_for.sum(), 1e-9))
    has = np.array([len(t) > 0 for t in terms], bool)
    rest = ~has
    none = float(((stands_for * toxic)[rest].sum() + share) / (stands_for[rest].sum() + 1)) if rest.any() else share
    index = Index(idf, ids, toxic, stands_for, [], np.zeros((0, 0)), none, share)
    vectors = [index.vector(t, c) if len(t) else np.zeros(0) for t, c in zip(terms, counts)]
    strongest = np.array([t[v.argmax()] if len(t) else -1 for t, v in zip(terms, vectors)], np.int64)
    order = np.lexsort((ids, toxic, strongest))
    order = order[has[order]]
    index.ids, index.toxic, index.stands_for = ids[order], toxic[order], stands_for[order]
    lengths = [len(terms[k]) for k in order]
    all_terms = np.concatenate([*[terms[k] for k in order], np.zeros(0, np.int64)]).astype(np.int64)
    all_weights = np.concatenate([*[vectors[k] for k in order], np.zeros(0)])
    place = np.repeat(np.arange(len(order)), lengths)
    blocks = len(order) // BLOCK + 1
    index.block_max = np.zeros((len(idf), blocks))
    np.maximum.at(index.block_max, (all_terms, place // BLOCK), all_weights)
    by_term = np.lexsort((place, all_terms))
    cuts = np.searchsorted(all_terms[by_term], np.arange(len(idf) + 1))
    index.postings = [(place[by_term[a:b]], all_weights[by_term[a:b]]) for a, b in zip(cuts, cuts[1:])]
    if len(order):
        votes = np.array([index.vote(*index.nearest(terms[k], vectors[k], NEAREST, without=n))
                          for n, k in enumerate(order)])
        weights = index.stands_for / index.stands_for.sum() * len(order)
        index.curve = _fit_curve(votes, index.toxic, weights)
    return index


def example_rows(docs: DataFrame, labels: DataFrame, toxic_rows: int, clean_rows: int) -> tuple[DataFrame, dict]:
    """Bounded (doc_id, toxic) of labels that may be learned from, and how many there are in all."""
    able = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").filter(
        "toxic IN (0, 1) AND doc_id IS NOT NULL").filter(~held_out(F.col("doc_id")))
    total = {r.toxic: r["count"] for r in able.groupBy("toxic").count().collect()}
    chosen = [able.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
              for label, rows in ((1, toxic_rows), (0, clean_rows))]
    return chosen[0].unionByName(chosen[1]), total


def scored(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_EXAMPLES,
           clean_rows: int = CLEAN_EXAMPLES) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence) for every row of ``docs``."""
    spark = docs.sparkSession
    chosen, total = example_rows(docs, labels, toxic_rows, clean_rows)
    chosen = staging.stage(chosen, "examples")
    few = F.broadcast(chosen)  # at most toxic_rows + clean_rows pairs of numbers
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    terms = (telling_terms(texts.join(few, "doc_id")) if total.get(0) and total.get(1)
             else np.zeros(0, np.uint64))

    counted = staging.stage(term_counts(docs, terms), "terms")
    frequency = {r.term: r["count"] for r in counted.select(
        F.explode("terms").alias("term")).groupBy("term").count().collect()}
    texts_in_all = counted.count()
    idf = np.array([np.log((texts_in_all + 1) / (frequency.get(k, 0) + 1)) + 1 for k in range(len(terms))])

    # vectors of the examples: as many rows as were chosen
    rows = counted.join(few, "doc_id").orderBy("doc_id", "row_key").collect()
    toxic = np.array([r.toxic == 1 for r in rows], bool)
    each = {label: total.get(label, 0) / max(int((toxic == label).sum()), 1) for label in (0, 1)}
    index = build_index(
        [np.array(r.terms, np.int64) for r in rows], [np.array(r.counts, np.int64) for r in rows],
        np.array([r.doc_id for r in rows], np.int64), toxic,
        np.where(toxic, each[1], each[0]).astype(float), idf)
    shared = spark.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, known = shared.value, {}
        for batch in batches:
            scores, evidence = [], []
            for doc_id, found, counts in zip(*(
                    batch.column(n).to_pylist() for n in ("doc_id", "terms", "counts"))):
                if not found:
                    scores.append(index.none_score)
                    evidence.append([])
                    continue
                key = (tuple(found), tuple(counts))
                if key not in known:
                    if len(known) > 20_000:
                        known.clear()
                    at = np.array(found, np.int64)
                    places, cosines = index.nearest(at, index.vector(at, np.array(counts)), NEAREST)
                    slope, offset = index.curve
                    known[key] = (float(_sigmoid(np.array(slope * index.vote(places, cosines) + offset))),
                                  [{"doc_id": int(index.ids[p]), "cosine": float(c), "toxic": bool(index.toxic[p])}
                                   for p, c in zip(places, cosines)])
                scores.append(known[key][0])
                evidence.append(known[key][1])
            shape = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.bool_())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64()),
                                              pa.array(evidence, shape)], ["doc_id", "score", "evidence"])

    # the counted terms are few, but each row may need a search
    dealt = counted.select("doc_id", "terms", "counts").repartition(texts_in_all // ROWS_A_TASK + 1)
    return dealt.mapInArrow(run, SCORES).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"), "evidence")
