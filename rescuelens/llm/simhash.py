"""SimHash near-duplicates by anchor-point covering.

Bit k of a text's fingerprint is set if it is in over half of the hashes of its shingles. Two
fingerprints are linked if they differ in at most ``THRESHOLD`` bits.

Anchors are the words of a covering code. Of the 64 bits two parts of 23 are covered by the Golay
code, in which every word has exactly one code word within ``RADIUS`` = 3; the other 18 bits of
an anchor are zero. That makes 2^24 anchors. A fingerprint is at home at the code words nearest
to its parts, and is replicated to every anchor that another one at home there could be linked with
it from: those whose distances from its parts exceed the radius by ``THRESHOLD`` bits in all. If x
and y differ in at most that many bits, y is replicated to the home of x, so each link is met
there. Replication is 68 anchors at most. Anchors at which nothing is at home are left out; a bitmap
of 2 MB, whatever the size of the input, says which.

At an anchor all that are at home are compared with all that came. Equal fingerprints are one class
throughout. An anchor with many rows is cut into blocks of homes and of arrivals, each pair of
blocks is a unit of bounded size, and a unit returns connected parts, never pairs: one link for
each of its members at most.

Null texts and texts without words have the fingerprint zero and are linked like any other; a text
of fewer words than a shingle is one shingle. Rows with one id and different texts keep their own
fingerprints, both under their smallest reachable id. Rows without an id get a fingerprint and no
component, and link nothing. An empty table gives an empty one. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rescuelens.llm import staging, textscan
from rescuelens.llm.components import components

SHINGLE_WORDS, SEED = 3, 42
THRESHOLD = 2

#: the Golay code: length of a word, generator polynomial, covering radius
LENGTH, GENERATOR, RADIUS = 23, 0b110001110101, 3
CHECKS = GENERATOR.bit_length() - 1
CODE_BITS = LENGTH - CHECKS

#: homes and arrivals of an anchor that are compared in one unit
HOMES, ARRIVALS = 4096, 32768
#: pairs compared at once
PAIRS = 1 << 22
#: up to so many anchors with blocks of their own a broadcast tells them, beyond it a shuffle
SENT_ANCHORS = 1_000_000


# --- fingerprints --------------------------------------------------------------------------


def _shingles(text: np.ndarray, size: int) -> Iterator[tuple[bytes, list[int], list[int]]]:
    """Parts of a text: words joined by blanks, where the shingles begin and where they end."""
    carried, found = [], False
    for start, stop in textscan.segments(text):
        words = carried + text[start:stop].tobytes().translate(textscan.ASCII_LOWER).split()
        if len(words) >= size:
            found = True
            yield _places(words, size)
            words = words[len(words) - size + 1:]
        carried = words
    if carried and not found:
        yield _places(carried, len(carried))


def _places(words: list[bytes], size: int) -> tuple[bytes, list[int], list[int]]:
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    return b" ".join(words), (ends - lengths)[:len(words) - size + 1].tolist(), ends[size - 1:].tolist()


def fingerprint(text: np.ndarray, size: int = SHINGLE_WORDS) -> int:
    """Of a text's UTF-8 bytes; unsigned."""
    counts, total = np.zeros(64, np.int64), 0
    for joined, starts, ends in _shingles(text, size):
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends)], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def signed(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, bits): fingerprints as signed longs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = textscan.raw_texts(batch.column("text"))
            bits = np.array([fingerprint(data[a:b], shingle_words) for a, b in zip(offsets, offsets[1:])], "<u8")
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(bits.view(np.int64))],
                                             ["doc_id", "bits"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, bits long")


# --- anchors -------------------------------------------------------------------------------


def _remainder(word: int) -> int:
    """Of a word as a polynomial, divided by the generator: zero for code words."""
    for k in range(LENGTH - 1, CHECKS - 1, -1):
        if word >> k & 1:
            word ^= GENERATOR << k - CHECKS
    return word


class _Code:
    """For each remainder: what to flip to get to the code words around, nearest first, and by how many
    bits they are beyond the radius. Rows are filled up with words that are too far."""

    def __init__(self) -> None:
        tables = []
        for first, last in ((0, CODE_BITS), (CODE_BITS, LENGTH)):
            table = np.zeros(1, np.int64)
            for k in range(first, last):
                table = np.concatenate([table, table ^ _remainder(1 << k)])
            tables.append(table)
        self.low, self.high = tables
        words = np.arange(1 << CODE_BITS, dtype=np.int64) << CHECKS
        words |= self.remainder(words)
        near = [0] + [1 << k for k in range(LENGTH)]
        near = sorted({a ^ b ^ c for a in near for b in near for c in near})
        of = np.argsort(self.remainder(np.array(near, np.int64)))
        flips = [words ^ near[k] for k in of]
        beyond = [np.maximum(np.bitwise_count(f).astype(np.int8) - RADIUS, 0) for f in flips]
        order = [np.argsort(b, kind="stable") for b in beyond]
        most = max(int((b <= THRESHOLD).sum()) for b in beyond)
        self.flips = np.array([f[o[:most]] for f, o in zip(flips, order)])
        self.beyond = np.array([b[o[:most]] for b, o in zip(beyond, order)])

    def remainder(self, words: np.ndarray) -> np.ndarray:
        return self.low[words & (1 << CODE_BITS) - 1] ^ self.high[words >> CODE_BITS]


_codes: list[_Code] = []


def _code() -> _Code:
    """Made by each worker that needs it."""
    if not _codes:
        _codes.append(_Code())
    return _codes[0]


def _parts(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << LENGTH) - 1)
    bits = bits.view(np.uint64)
    return (bits & mask).astype(np.int64), (bits >> np.uint64(LENGTH) & mask).astype(np.int64)


def _numbers(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Anchors by number: the highest bits of a code word tell it."""
    return (first >> CHECKS) << CODE_BITS | second >> CHECKS


def homes_of(bits: np.ndarray) -> np.ndarray:
    """The anchor nearest to each fingerprint."""
    code = _code()
    return _numbers(*(part ^ code.flips[code.remainder(part), 0] for part in _parts(bits)))


def anchors_of(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All anchors to which fingerprints are replicated: (anchor, place of the fingerprint)."""
    code = _code()
    (first, left), (second, right) = ((part, code.remainder(part)) for part in _parts(bits))
    place, a, b = np.nonzero(code.beyond[left][:, :, None] + code.beyond[right][:, None, :] <= THRESHOLD)
    return _numbers(first[place] ^ code.flips[left[place], a], second[place] ^ code.flips[right[place], b]), place


def classes_of(signs: DataFrame) -> DataFrame:
    """(bits, id, home): each fingerprint with the smallest id and the anchor it is at home at."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            home = homes_of(batch.column("bits").to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home)], ["bits", "id", "home"])
    return (signs.filter("doc_id IS NOT NULL").groupBy("bits").agg(F.min("doc_id").alias("id"))
            .mapInArrow(run, "bits long, id long, home long"))


def home_bitmap(classes: DataFrame) -> np.ndarray:
    """One bit per anchor, set where a class is at home; of a fixed size."""
    number = F.col("home") + 1
    rows = classes.groupBy(F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("part")).collect()
    out = np.zeros(1 << 2 * CODE_BITS - 3, np.uint8)
    for row in rows:
        start = (row.bucket - 1) * len(row.part)
        out[start:start + len(row.part)] = np.frombuffer(row.part, np.uint8)
    return out


def arrivals_of(classes: DataFrame) -> DataFrame:
    """(anchor, arrived, bits, id): each class at home, and at every anchor it is replicated to at
    which some class is at home."""
    used = classes.sparkSession.sparkContext.broadcast(home_bitmap(classes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_bits, all_ids, homes = (batch.column(n).to_numpy() for n in ("bits", "id", "home"))
            for k in range(0, len(all_bits), 4096):
                bits, ids, home = (x[k:k + 4096] for x in (all_bits, all_ids, homes))
                anchor, place = anchors_of(bits)
                wanted = used.value[anchor >> 3] >> (anchor & 7) & 1 == 1
                anchor, place = anchor[wanted], place[wanted]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in (
                        (home, anchor), (np.zeros(len(home), bool), np.ones(len(anchor), bool)),
                        (bits, bits[place]), (ids, ids[place]))], ["anchor", "arrived", "bits", "id"])
    return classes.mapInArrow(run, "anchor long, arrived boolean, bits long, id long")


def units_of(arrivals: DataFrame) -> DataFrame:
    """Arrivals with their unit (anchor, home_block, block); anchors with many rows have several."""
    spark = arrivals.sparkSession
    sizes = arrivals.groupBy("anchor").agg(F.count_if(~F.col("arrived")).alias("homes"),
                                           F.count_if(F.col("arrived")).alias("rows"))
    large = staging.stage(sizes.filter((F.col("homes") > HOMES) | (F.col("rows") > ARRIVALS)).select(
        "anchor", F.ceil(F.col("homes") / HOMES).cast("int").alias("home_blocks"),
        F.ceil(F.col("rows") / ARRIVALS).cast("int").alias("blocks")), "large-anchors")
    n_large = large.count()
    if not n_large:
        staging.drop(spark, large)
        return arrivals.withColumns({"home_block": F.lit(0), "block": F.lit(0)})
    large = F.broadcast(large) if n_large <= SENT_ANCHORS else large
    rows = arrivals.join(large, "anchor", "left").fillna(1, ["home_blocks", "blocks"])

    def block(of: str) -> F.Column:
        return F.pmod(F.xxhash64("bits"), F.col(of)).cast("int")

    def each(of: str) -> F.Column:
        return F.sequence(F.lit(0), F.col(of) - 1)

    one = F.array(block("home_blocks")), F.array(block("blocks"))
    return (rows.withColumn("home_block", F.explode(F.when(F.col("arrived"), each("home_blocks")).otherwise(one[0])))
            .withColumn("block", F.explode(F.when(F.col("arrived"), one[1]).otherwise(each("blocks"))))
            .drop("home_blocks", "blocks"))


def _joined(labels: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Labels after the rows ``left`` and ``right`` are joined pairwise; a label is a smallest row."""
    while True:
        a, b = labels[left], labels[right]
        open_ = a != b
        if not open_.any():
            return labels
        left, right, a, b = left[open_], right[open_], a[open_], b[open_]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while ((nearer := labels[labels]) != labels).any():
            labels = nearer


def _links(unit: np.ndarray, arrived: np.ndarray, bits: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the rows of whole units; ``unit`` numbers them, homes come first."""
    labels = np.arange(len(bits))
    homes = np.flatnonzero(~arrived)
    sizes = np.bincount(unit)
    ends = np.cumsum(sizes)
    n_homes = np.bincount(unit[homes], minlength=len(sizes))
    n_arrivals = (sizes - n_homes)[unit[homes]]
    first = (ends - sizes + n_homes)[unit[homes]]
    total = np.cumsum(n_arrivals)
    start = 0
    while start < len(homes):
        stop = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + PAIRS, "right")))
        n = n_arrivals[start:stop]
        left = np.repeat(homes[start:stop], n)
        offset = np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)
        right = np.repeat(first[start:stop], n) + offset
        near = np.bitwise_count(bits[left] ^ bits[right]) <= THRESHOLD
        labels = _joined(labels, left[near], right[near])
        start = stop
    rows = np.flatnonzero(ids[labels] != ids)
    return ids[labels[rows]], ids[rows]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by unit, homes first. Held are a batch and the rows of the unit at its end."""
    names = ("anchor", "home_block", "block", "arrived", "bits", "id")
    held = None

    def finished(rows: list[np.ndarray], unit: np.ndarray) -> pa.RecordBatch:
        found = _links(unit, rows[3], rows[4].view(np.uint64), rows[5])
        return pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["a", "b"])

    for batch in batches:
        rows = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
        if held:
            rows = [np.concatenate(x) for x in zip(held, rows)]
        new = np.any([x[1:] != x[:-1] for x in rows[:3]], axis=0)
        unit = np.concatenate([[0], np.cumsum(new)]) if len(rows[0]) else np.zeros(0, np.int64)
        cut = int(np.searchsorted(unit, unit[-1])) if len(unit) else 0
        if cut:
            yield finished([x[:cut] for x in rows], unit[:cut])
        held = [x[cut:] for x in rows]
    if held and len(held[0]):
        yield finished(held, np.zeros(len(held[0]), np.int64))


def links(arrivals: DataFrame) -> DataFrame:
    """(a, b): links that connect, at every anchor, the classes that differ by few bits."""
    keys = ("anchor", "home_block", "block")
    return (units_of(arrivals).select(*keys, "arrived", "bits", "id").repartition(*keys)
            .sortWithinPartitions(*keys, "arrived").mapInArrow(_compare, "a long, b long"))


def linked(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits) and component_id (smallest id reachable)."""
    signs = staging.stage(signed(docs, shingle_words), "fingerprints")
    classes = staging.stage(classes_of(signs), "classes")
    labels = staging.stage(components(links(arrivals_of(classes))), "labels")
    named = classes.join(labels, "id", "left").select(
        "bits", F.coalesce("component", "id").alias("component_id"))
    out = signs.filter("doc_id IS NOT NULL").join(named, "bits").unionByName(
        signs.filter("doc_id IS NULL"), allowMissingColumns=True)
    return out.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")
