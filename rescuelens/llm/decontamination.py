"""Benchmark decontamination with one Aho-Corasick automaton per block of test items.

Texts and items are normalised alike: A-Z lowered, every run of ASCII characters other than
digits and letters is one gap. An item's windows of ``size`` consecutive words are the
patterns; an item with fewer words is one window. A text is scanned once, whole, and every
occurrence is mapped back to word numbers and to characters of the original text.

Benchmarks are small beside a corpus, but their size is checked: windows are dealt to blocks
of at most ``BLOCK_BYTES``, and the corpus is scanned once per block. A usual benchmark is one
block, and then nothing is shuffled. With more blocks the texts are staged first, and the blocks'
findings are put together by row.

Null texts have no words. Texts without words, items without words and an empty item table
give no hits. Items with the same windows are all reported. Repeated documents are reported
once per row. Extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rescuelens.llm import staging, textscan

WINDOW_WORDS = 10
#: text of the items whose windows make up one automaton
BLOCK_BYTES = 1 << 19

_TABLE = bytes(c if 48 <= c <= 57 or c >= 128 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32
               for c in range(256))

#: words and windows hit: first word, words, first character, characters, items
HITS = T.StructType([
    T.StructField("row_key", T.LongType()), T.StructField("doc_id", T.LongType()),
    T.StructField("n_words", T.LongType()),
    T.StructField("words_hit", T.ArrayType(T.StructType([
        T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()),
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("item_ids", T.ArrayType(T.LongType()))])


def normalised(text: bytes) -> bytes:
    """Words of a text with one blank between and around them; empty without words."""
    words = text.translate(_TABLE).split()
    return b" ".join([b"", *words, b""]) if words else b""


def windows(item: bytes, size: int = WINDOW_WORDS) -> set[bytes]:
    words = item.translate(_TABLE).split()
    return {b" ".join([b"", *words[k:k + size], b""])
            for k in range(max(1, len(words) - size + 1))} if words else set()


def automaton(items: list[tuple[int, bytes]], size: int) -> ahocorasick.Automaton | None:
    """Finds windows; each has its number of words, its length and the items that hold it."""
    owners: dict[bytes, set[int]] = {}
    for item_id, text in items:
        for window in windows(text, size):
            owners.setdefault(window, set()).add(item_id)
    if not owners:
        return None
    machine = ahocorasick.Automaton()
    for window, ids in owners.items():
        machine.add_word(window.decode("latin-1"),
                         (window.count(b" ") - 1, len(window), tuple(sorted(ids))))
    machine.make_automaton()
    return machine


def _spans(text: bytes, clean: bytes, found: list) -> list[tuple[int, int, int, int]]:
    """Runs of hit words with their characters in the original text."""
    gaps = np.flatnonzero(np.frombuffer(clean, np.uint8) == 32)
    runs: list[list[int]] = []
    for end, (count, length, _) in found:
        first = int(np.searchsorted(gaps, end - length + 1))
        runs.append([first, first + count - 1])
    runs.sort()
    joined = [runs[0]]
    for first, last in runs[1:]:
        if first <= joined[-1][1] + 1:
            joined[-1][1] = max(joined[-1][1], last)
        else:
            joined.append([first, last])
    # first and last byte of every word in the original
    solid = np.concatenate([[False], np.frombuffer(text.translate(_TABLE), np.uint8) != 32, [False]])
    starts = np.flatnonzero(solid[1:] & ~solid[:-1])
    stops = np.flatnonzero(solid[:-1] & ~solid[1:])
    chars = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    return [(a, b, int(chars[starts[a]]), int(chars[stops[b]])) for a, b in joined]


#: the automaton a worker built last, by the block's own name
_built: dict[str, ahocorasick.Automaton | None] = {}


def _machine(name: str, block, size: int) -> ahocorasick.Automaton | None:
    if name not in _built:
        _built.clear()
        _built[name] = automaton(block.value, size)
    return _built[name]


def _scan(block, size: int):
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _machine(name, block, size)
        for batch in batches:
            data, offsets = textscan.raw_texts(batch.column("text"))
            counts, spans, items = [], [], []
            for r in range(batch.num_rows):
                text = data[offsets[r]:offsets[r + 1]].tobytes()
                clean = normalised(text)
                counts.append(max(0, clean.count(b" ") - 1))
                found = list(machine.iter(clean.decode("latin-1"))) if machine and clean else []
                spans.append([dict(zip(("first_word", "last_word", "start", "end"), s))
                              for s in _spans(text, clean, found)] if found else [])
                items.append(sorted({i for _, hit in found for i in hit[2]}))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_key"), batch.column("doc_id"), pa.array(counts, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([(n, pa.int64()) for n in
                                                     ("first_word", "last_word", "start", "end")]))),
                 pa.array(items, pa.list_(pa.int64()))],
                ["row_key", "doc_id", "n_words", "words_hit", "item_ids"])
    return run


def item_blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[int, bytes]]]:
    """The items, block by block."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"),
                         F.coalesce("text", F.lit("")).alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    blocks = int(size // block_bytes + 1)
    for k in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        yield [(r.item_id, r.text.encode()) for r in part.collect()]


def overlaps(docs: DataFrame, items: DataFrame, size: int = WINDOW_WORDS,
             block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs``: n_words, runs of hit words (with characters of the text, end
    exclusive) and the items found. ``row_key`` tells rows with equal ids apart.
    """
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.monotonically_increasing_id().alias("row_key"),
                       F.col("doc_id").cast("long").alias("doc_id"), "text")
    blocks = [context.broadcast(block) for block in item_blocks(items, block_bytes)]
    if len(blocks) > 1:
        # the scans are put together by row, so all of them have to number the rows alike
        rows = staging.stage(rows, "texts")
    parts = [rows.mapInArrow(_scan(block, size), HITS) for block in blocks]
    if len(parts) == 1:
        return parts[0]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    merged = every.groupBy("row_key").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("words_hit")).alias("words_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"))
    return merged.mapInPandas(_join_runs, HITS)


def clean_rows(docs: DataFrame, items: DataFrame, size: int = WINDOW_WORDS,
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows without any window of any item, with all their columns; nothing is moved."""
    context = docs.sparkSession.sparkContext

    def without(block):
        name = uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            machine = _machine(name, block, size)
            for batch in batches:
                data, offsets = textscan.raw_texts(batch.column("text"))
                keep = [machine is None or next(machine.iter(normalised(
                    data[offsets[r]:offsets[r + 1]].tobytes()).decode("latin-1")), None) is None
                    for r in range(batch.num_rows)]
                yield batch.filter(pa.array(keep, pa.bool_()))
        return run

    for block in item_blocks(items, block_bytes):
        docs = docs.mapInArrow(without(context.broadcast(block)), docs.schema)
    return docs


def _join_runs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs found in several blocks become runs that don't touch."""
    def joined(spans: list[dict]) -> list[dict]:
        out: list[dict] = []
        for s in sorted(spans, key=lambda s: s["first_word"]):
            if out and s["first_word"] <= out[-1]["last_word"] + 1:
                if s["last_word"] > out[-1]["last_word"]:
                    out[-1] |= {"last_word": s["last_word"], "end": s["end"]}
            else:
                out.append(dict(s))
        return out

    for frame in frames:
        yield frame.assign(words_hit=[joined(s) for s in frame["words_hit"]])


def n_hit(words_hit) -> F.Column:
    """How many words the runs hold."""
    return F.aggregate(words_hit, F.lit(0).cast("long"),
                       lambda n, run: n + run["last_word"] - run["first_word"] + 1)
