"""MinHash near-duplicates by a multi-index Hamming join of b-bit signatures.

Every distinct shingle set gets a signature of ``CHUNKS * CHUNK_SYMBOLS`` symbols, each the low
16 bits of a minimum hash. The signature is split into chunks. By the pigeonhole principle, two
signatures that differ in at most ``CHUNKS * (ERRORS + 1) - 1`` symbols have a chunk with at most
``ERRORS`` differences; for each chunk all choices of ``ERRORS`` symbols to leave out are
enumerated, and the symbols left are a key. Sets with a key in common are candidates. A pair of
similarity 0.8 misses all keys of the default layout with probability below 3e-6.

Candidates are never expanded within a group. Each key links its members to its smallest one
(first within a task, so a key held by a third of all rows sends one row per task). All sets that
these links connect are a family, so all members of a key are in one, whatever their smallest one
is like. A family is compared in units of two blocks of bounded size: pairs whose set sizes and
signatures allow the similarity exactly, on full sets. A unit keeps track of what is connected
already and compares only what is not, and returns no more links than it has members. Every
pair that could still join two components is compared, so none is lost; large families are many
units, without those of sizes too far apart. Tables of links, ids and units shrink to little in files, so
beyond ``staging.SENT_ROWS`` their joins are told to shuffle. Equal sets are one class throughout and are not expanded into pairs.

Null texts, and texts without words, have no shingles and are linked with nothing. A text with
fewer words than a shingle is one shingle. Document ids are assumed to be distinct; repeated
rows with equal ids fall into one class, rows without an id are linked with nothing. Extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rescuelens.llm import staging, textscan
from rescuelens.llm.components import components

SHINGLE_WORDS = 5
THRESHOLD_PERCENT = 80
CHUNKS, CHUNK_SYMBOLS, ERRORS = 12, 6, 1
SYMBOLS = CHUNKS * CHUNK_SYMBOLS
#: most symbols in which two sets of the threshold's similarity differ, but for 1 pair in 10^7
MOST_DIFFERENT = 34
#: classes and shingles of one of the two blocks that are compared in one task
BLOCK_ROWS, BLOCK_SHINGLES = 500, 2_000_000
#: families of more blocks have blocks of similar set sizes
BANDED_BLOCKS = 3
#: up to so many ids a broadcast picks the texts of the families, beyond it a shuffle
SENT_IDS = 1_000_000

SIGNED = "doc_id long, n_shingles long, digest binary, signature binary"


def signature(shingles: np.ndarray) -> np.ndarray:
    """Low 16 bits of the smallest of each family of hashes over a set."""
    factors = textscan.seeded(SYMBOLS, 3)[:, None]
    least = np.full(SYMBOLS, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(shingles), 512):
        np.minimum(least, (factors * shingles[None, k:k + 512]).min(axis=1), out=least)
    return (textscan.mix(least) & np.uint64(0xFFFF)).astype("<u2")


def signed(docs: DataFrame, shingle_words: int) -> DataFrame:
    """Per document: set size, digest of the set and signature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, signatures = [], [], []
            for found in textscan.shingle_sets(batch.column("text"), shingle_words):
                counts.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                signatures.append(signature(found).tobytes() if len(found) else b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()),
                 pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())],
                ["doc_id", "n_shingles", "digest", "signature"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SIGNED)


_LEFT_OUT = [list(c) for c in combinations(range(CHUNK_SYMBOLS), ERRORS)]
KEYS = CHUNKS * len(_LEFT_OUT)


def keys_of(signatures: np.ndarray) -> np.ndarray:
    """All keys of each signature (one row each)."""
    chunks = signatures.reshape(len(signatures), CHUNKS, CHUNK_SYMBOLS).astype(np.uint64)
    factors = textscan.seeded(CHUNK_SYMBOLS, 5)
    out = np.empty((len(signatures), CHUNKS, len(_LEFT_OUT)), np.uint64)
    place = np.arange(CHUNKS, dtype=np.uint64)[None, :] * np.uint64(len(_LEFT_OUT))
    for k, left_out in enumerate(_LEFT_OUT):
        used = [s for s in range(CHUNK_SYMBOLS) if s not in left_out]
        mixed = (chunks[:, :, used] + np.uint64(1)) * factors[used]
        out[:, :, k] = textscan.mix(textscan.mix(mixed).sum(axis=2, dtype=np.uint64)
                                    + (place + np.uint64(k)) * textscan.seeded(1, 9)[0])
    return out.reshape(len(signatures), KEYS).view(np.int64)


def _signature_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, SYMBOLS)


def _keyed(classes: DataFrame) -> DataFrame:
    """(key, id, head): the smallest class of each key within a few thousand rows of a task, without
    a head, and each of the others there, once for every such head."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            if not len(ids):
                continue
            order = np.argsort(ids, kind="stable")
            keys = keys_of(_signature_rows(batch.column("signature"))[order]).ravel()
            of = np.repeat(ids[order], KEYS)
            by_key = np.argsort(keys, kind="stable")
            keys, of = keys[by_key], of[by_key]
            first = np.concatenate([[True], keys[1:] != keys[:-1]])
            head = of[np.flatnonzero(first)[np.cumsum(first) - 1]]
            others = np.flatnonzero(~first)
            others = others[np.lexsort((of[others], head[others]))]
            again = (head[others[1:]] == head[others[:-1]]) & (of[others[1:]] == of[others[:-1]])
            others = np.concatenate([others[:1], others[1:][~again]])
            rows = np.concatenate([np.flatnonzero(first), others])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[rows]), pa.array(of[rows]), pa.array(head[rows], mask=first[rows])],
                ["key", "id", "head"])
    return classes.select("id", "signature").mapInArrow(run, "key long, id long, head long")


def candidate_links(classes: DataFrame) -> DataFrame:
    """(a, b): links that connect all members of each key, heads to the smallest of them.

    Heads and the links to them come from one scan, so they always fit together.
    """
    least = F.min("id").over(W.partitionBy("key", "head"))
    return (_keyed(classes).select(F.coalesce("head", least).alias("a"), F.col("id").alias("b"))
            .filter("a <> b").distinct())


def _differ(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.count_nonzero(left != right, axis=-1)


def family_units(families: DataFrame, classes: DataFrame, n_ids: int, percent: int) -> DataFrame:
    """(id, family, own, low, high): the units of two blocks in which a class is compared.

    Blocks of a large family are made within bands of set sizes, and only those of one band or of
    neighbouring bands are compared: sizes further apart do not allow the similarity.
    """
    # a little wider than the similarity allows, for the rounding of logarithms
    width = max(math.log(100 / max(percent, 1e-9)), 1e-6) * 1.001
    members = families.join(staging.side(classes.select("id", "n"), n_ids), "id").withColumn(
        "band", F.floor(F.log("n") / width))

    def blocks(rows, shingles):
        return F.greatest(F.ceil(rows / BLOCK_ROWS), F.ceil(shingles / BLOCK_SHINGLES))

    whole, in_order = W.partitionBy("component"), W.partitionBy("component").orderBy("band")
    bands = members.groupBy("component", "band").agg(F.count("*").alias("rows"), F.sum("n").alias("sum")).select(
        "component", "band", blocks(F.col("rows"), F.col("sum")).alias("blocks"),
        blocks(F.sum("rows").over(whole), F.sum("sum").over(whole)).alias("all_blocks"))
    for name, near, step in (("before", F.lag, -1), ("after", F.lead, 1)):
        bands = bands.withColumn(name, F.when(near("band").over(in_order) == F.col("band") + step,
                                              near("blocks").over(in_order)).otherwise(0))

    def numbers(band, count):
        first = band * (1 << 32)
        return F.when(count > 0, F.sequence(first, first + count - 1)).otherwise(F.array().cast("array<long>"))

    band, banded = F.col("band"), F.col("all_blocks") > BANDED_BLOCKS
    others = F.when(banded, F.concat(numbers(band - 1, F.col("before")), numbers(band, F.col("blocks")),
                                     numbers(band + 1, F.col("after")))).otherwise(
        numbers(F.lit(0).cast("long"), F.col("all_blocks")))
    hashed = F.xxhash64("id")
    own = F.when(banded, band * (1 << 32) + F.pmod(hashed, F.col("blocks"))).otherwise(
        F.pmod(hashed, F.col("all_blocks")))
    placed = members.join(staging.side(bands, n_ids), ["component", "band"]).select(
        "id", F.col("component").alias("family"), own.alias("own"), F.explode(others).alias("other"))
    return placed.select("id", "family", "own", F.least("own", "other").alias("low"),
                         F.greatest("own", "other").alias("high"))


class _Unit:
    """Classes of one family that are compared in one task."""

    def __init__(self, rows: list[tuple], percent: int) -> None:
        self.ids = [r[0] for r in rows]
        self.sets = [np.frombuffer(r[2], np.uint64) for r in rows]
        self.blocks = np.array([r[1] for r in rows])
        self.sizes = np.array([len(s) for s in self.sets])
        self.signatures = np.array([signature(s) for s in self.sets])
        self.root = np.arange(len(rows))
        self.percent = percent

    def _similar(self, x: int, y: int) -> bool:
        a, b = self.sets[x], self.sets[y]
        place = np.minimum(np.searchsorted(a, b), len(a) - 1)
        both = np.count_nonzero(a[place] == b)
        return 100 * both >= self.percent * (len(a) + len(b) - both)

    def links(self) -> Iterator[tuple[int, int]]:
        """Links that connect what is connected; at most one per class."""
        mixed = self.blocks.min() != self.blocks.max()
        for x in range(1, len(self.ids)):
            size, before = self.sizes[x], self.sizes[:x]
            able = 100 * np.minimum(before, size) >= self.percent * np.maximum(before, size)
            if mixed:
                # pairs within one block are compared where that block is alone
                able &= self.blocks[:x] != self.blocks[x]
            at = np.flatnonzero(able)
            differ = _differ(self.signatures[at], self.signatures[x])
            order = np.argsort(differ, kind="stable")
            at = at[order[differ[order] <= MOST_DIFFERENT]]
            while len(at := at[self.root[at] != self.root[x]]):
                y, at = at[0], at[1:]
                if self._similar(x, y):
                    yield self.ids[y], self.ids[x]
                    self.root[self.root == self.root[y]] = self.root[x]


def family_links(docs: DataFrame, units: DataFrame, n_ids: int, n_rows: int, shingle_words: int,
                 percent: int) -> DataFrame:
    """(a, b): verified links that connect every family's components."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [s.tobytes() for s in textscan.shingle_sets(batch.column("text"), shingle_words)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.binary())],
                                             ["id", "shingles"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, rows = None, []

        def finished() -> pa.RecordBatch:
            found = list(_Unit(rows, percent).links()) if len(rows) > 1 else []
            return pa.RecordBatch.from_arrays(
                [pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            keys = zip(*(batch.column(n).to_pylist() for n in ("family", "low", "high")))
            values = zip(*(batch.column(n).to_pylist() for n in ("id", "own", "shingles")))
            for key, value in zip(keys, values):
                if key != unit:
                    if len(rows) > 1:
                        yield finished()
                    unit, rows = key, []
                rows.append(value)
        if len(rows) > 1:
            yield finished()

    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    ids = units.select("id").distinct()
    # the ids of the families are sent to all tasks only while they are few
    chosen = texts.join(F.broadcast(ids) if n_ids <= SENT_IDS else ids.hint("merge"), "id", "left_semi")
    full = chosen.mapInArrow(sets, "id long, shingles binary")
    return (full.join(staging.side(units, n_rows), "id").select("family", "low", "high", "id", "own", "shingles")
            .repartition("family", "low", "high")
            .sortWithinPartitions("family", "low", "high", "id")
            .mapInArrow(compare, "a long, b long"))


def linked(docs: DataFrame, shingle_words: int = SHINGLE_WORDS,
           percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """Per document: n_shingles, component_id (smallest id reachable by links) and kept."""
    spark = docs.sparkSession
    signs = staging.stage(signed(docs, shingle_words), "signatures")
    own = signs.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = staging.stage(own.groupBy("digest").agg(
        F.min("doc_id").alias("id"), F.min("n_shingles").alias("n"),
        F.min("signature").alias("signature")), "classes")
    # sizes and signatures are left to the pairs: two members of a key may be alike when neither is
    # like the key's smallest one
    families = staging.stage(components(candidate_links(classes)), "families")
    n_ids = families.count()
    units = staging.stage(family_units(families, classes, n_ids, percent), "units")
    links = family_links(docs, units, n_ids, units.count(), shingle_words, percent)
    labels = staging.stage(components(links), "labels")
    staging.drop(spark, units, families)

    named = classes.join(staging.side(labels, n_ids), "id", "left").select(
        "digest", F.coalesce("component", "id").alias("component"))
    of_class = own.join(staging.side(named, signs.count()), "digest").select(
        "doc_id", "n_shingles", F.col("component").alias("component_id"))
    alone = signs.filter("n_shingles = 0 OR doc_id IS NULL").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return of_class.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def first_of_each(docs: DataFrame, shingle_words: int = SHINGLE_WORDS,
                  percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """The rows of documents that are the first of their component, with all their columns."""
    of = staging.unused_name(docs, "gone_id")
    gone = staging.stage(linked(docs, shingle_words, percent).filter("NOT kept").select(F.col("doc_id").alias(of)), "gone")
    ids = F.broadcast(gone) if gone.count() <= SENT_IDS else gone.hint("merge")
    return docs.join(ids, F.col("doc_id").cast("long") == F.col(of), "left_anti")
