"""Best-fit packing by the sum-of-squares rule.

``packed`` turns texts into token sequences of at most ``capacity`` tokens. Each document is
tokenised once and ends with id 0; only longer ones are cut. Packing itself moves nothing
but (document, piece, length) rows: they are dealt to groups of about ``group_rows`` pieces
by a hash, so no group grows with the data, and each group fills its own sequences. In a
group the next piece, long ones first, goes where the sum of squares of N(g), the number of
open sequences with residual gap g, becomes smallest; a new sequence counts as a choice. At the
end of a group sequences that are open are emptied into the gaps of others where they fit.

Null and empty texts are one piece that holds id 0. Repeated rows with the same document id,
or without one, are packed apart, but their pieces can't be told apart by id. Extra columns are
ignored.
"""

from __future__ import annotations

import os
import re
from bisect import bisect_left, insort
import unicodedata
from collections import namedtuple
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rescuelens.llm import staging, textscan

CAPACITY = 2048
GROUP_ROWS = 50_000

PIECES = "doc_id long, piece int, start long, length int, row_key long, ids binary"
PLACES = "doc_id long, piece int, row_key long, sequence_id long, offset int"

#: pieces: doc_id, piece, start, length, row_key, ids (little-endian unsigned 32 bits)
#: places: doc_id, piece, row_key, sequence_id, offset
Packed = namedtuple("Packed", "pieces places")


def _merge_ranks(tokenizer) -> dict[bytes, int]:
    """The tokenizer's vocabulary as byte strings by rank, the end of a word as a blank."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(others)}
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    ranks = {}
    for token, i in tokenizer.get_vocab().items():
        ends = token.endswith("</w>") and len(token) > 4
        if token not in special:
            ranks[bytes(byte_of[c] for c in (token[:-4] if ends else token)) + b" " * ends] = i
    return ranks


#: how the tokenizer parts words: fixed by its file
PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")

# classes of bytes: blank, letter, digit, mark; bytes of several-byte characters are checked apart
_CLASS = np.full(256, 3, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[[*range(97, 123), *range(128, 256)]] = 1
_CLASS[48:58] = 2


class TextIds:
    """Ids of whole texts, equal to those of the tokenizer and several times as fast.

    The texts of a slice are parted into words at once and encoded together by a second
    library with the tokenizer's own merges. Texts with special tokens or control characters
    go through the tokenizer itself.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        ranks = _merge_ranks(self.tokenizer)
        self.merges = tiktoken.Encoding("words", pat_str=r"[^ ]+ ", mergeable_ranks=ranks,
                                        special_tokens={})
        self.ends = np.zeros(max(ranks.values()) + 1, bool)
        self.ends[[i for b, i in ranks.items() if len(b) > 1 and b.endswith(b" ")]] = True
        self.odd: dict[str, bool] = {}

    def _is_odd(self, char: str) -> bool:
        """Whether a character needs more care than lowering and parting by its class."""
        if char not in self.odd:
            self.odd[char] = not (
                ("!" <= char <= "~" and char != "'") or char in " \n\t\r\x0b\x0c"
                or (char.isalpha() and char.lower().isalpha() and char not in "\u03a3"
                    and not "\u1100" <= char <= "\u11ff"
                    and unicodedata.is_normalized("NFC", char + char.lower())))
        return self.odd[char]

    def _parted(self, texts: list[bytes]) -> tuple[bytes, np.ndarray]:
        """Words of plain lower-case texts, each with a blank after it, and how many a text has."""
        data = np.frombuffer(b"".join(texts), np.uint8)
        stops = np.cumsum([len(t) for t in texts])
        kind = _CLASS[data]
        after = np.zeros(len(data), np.uint8)
        after[:-1] = kind[1:]
        ends = (kind > 0) & ((after != kind) | (kind == 2))
        inner = stops[(stops > 0)] - 1
        ends[inner] = kind[inner] > 0
        solid = np.flatnonzero(kind)
        closing = ends[solid]
        place = np.arange(len(solid)) + np.cumsum(closing) - closing
        out = np.full(len(solid) + int(closing.sum()), 32, np.uint8)
        out[place] = data[solid]
        total = np.concatenate([[0], np.cumsum(ends)])
        return out.tobytes(), np.diff(total[np.concatenate([[0], stops])])

    def of_texts(self, texts: list[bytes]) -> list[bytes]:
        """Ids of every text as little-endian unsigned 32-bit numbers."""
        plain = not any(map(self._is_odd, set(b"".join(texts).decode())))
        parts, counts, whole = [], [], {}
        if plain and not any(b"<|" in t for t in texts):
            joined, counts = self._parted([t.decode().lower().encode() for t in texts])
            parts.append(joined.decode())
        else:
            for k, text in enumerate(texts):
                if b"<|" in text or _CONTROL.search(text):
                    whole[k] = self.tokenizer.encode(text.decode(), add_special_tokens=False).ids
                    counts.append(0)
                    continue
                lowered = "".join(map(str.lower, unicodedata.normalize("NFC", text.decode())))
                words = PARTS.findall(lowered)
                parts.extend((" ".join(words), " " if words else ""))
                counts.append(len(words))
        ids = self.merges.encode_to_numpy("".join(parts), disallowed_special=())
        stops = np.concatenate([[0], np.flatnonzero(self.ends[ids]) + 1])
        if stops[-1] != len(ids) or len(stops) != np.sum(counts) + 1:
            raise ValueError("the vocabulary does not end every word with an end token")
        raw = ids.astype("<u4").tobytes()
        cuts = (4 * stops[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]).tolist()
        return [np.asarray(whole[k], "<u4").tobytes() if k in whole else raw[cuts[k]:cuts[k + 1]]
                for k in range(len(texts))]


#: blanks that libraries see differently
_CONTROL = re.compile(rb"[\x00-\x08\x0e-\x1f\x7f]|\xc2[\x80-\x9f]")

_open: dict[str, TextIds] = {}


def text_ids(path: str) -> TextIds:
    if path not in _open:
        _open[path] = TextIds(path)
    return _open[path]


def cut_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of every text, with their ids.

    ``path`` is the tokenizer's file on every machine; ``TextIds`` says which kind it takes.
    ``row_key`` tells equal document ids apart.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = text_ids(path)
        end = b"\0\0\0\0"
        for batch in batches:
            data, offsets = textscan.raw_texts(batch.column("text"))
            doc_ids, keys = batch.column("doc_id"), batch.column("row_key")
            for a, b in textscan.slices(offsets):
                texts = [data[offsets[r]:offsets[r + 1]].tobytes() for r in range(a, b)]
                rows, pieces, starts, lengths, ids = [], [], [], [], []
                for r, encoded in enumerate(words.of_texts(texts), a):
                    encoded += end
                    for k, at in enumerate(range(0, len(encoded), 4 * capacity)):
                        part = encoded[at:at + 4 * capacity]
                        rows.append(r)
                        pieces.append(k)
                        starts.append(at // 4)
                        lengths.append(len(part) // 4)
                        ids.append(part)
                rows = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.take(rows), pa.array(pieces, pa.int32()),
                     pa.array(starts, pa.int64()), pa.array(lengths, pa.int32()),
                     keys.take(rows), pa.array(ids, pa.binary())],
                    ["doc_id", "piece", "start", "length", "row_key", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.monotonically_increasing_id().alias("row_key"))
    return rows.mapInArrow(run, PIECES)


class OpenSequences:
    """Open sequences of one group by residual gap, and the placing rule."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.count = np.zeros(capacity + 1)
        # a sequence filled to the end is no open one any more: no cost after placing
        self.count[0] = -0.5
        self.made = 0

    def place(self, length: int) -> tuple[int, int]:
        """Sequence and offset for a piece."""
        capacity, count = self.capacity, self.count
        gap = capacity
        if length < capacity:
            before, after = count[length:capacity], count[:capacity - length]
            # change of the sum of squares if a gap g becomes g - length
            change = np.where(before > 0, 2 * (after - before + 1), np.inf)
            best = int(change.argmin())
            if change[best] <= 2 * count[capacity - length] + 1:
                gap = best + length
        if gap == capacity:
            sequence, self.made = self.made, self.made + 1
        else:
            sequence = self.by_gap[gap].pop()
            count[gap] -= 1
        rest = gap - length
        if rest:
            self.by_gap[rest].append(sequence)
            count[rest] += 1
        return sequence, capacity - gap


def place_lengths(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of every piece; long pieces are placed first."""
    sequences = np.zeros(len(lengths), np.int64)
    bins = OpenSequences(capacity)
    for k in np.argsort(-lengths, kind="stable"):
        sequences[k], _ = bins.place(int(lengths[k]))
    dissolve(lengths, sequences, capacity)
    order = np.lexsort((-lengths, sequences))
    before = np.concatenate([[0], np.cumsum(lengths[order])[:-1]])
    first = np.concatenate([[True], sequences[order][1:] != sequences[order][:-1]])[:len(order)]
    offsets = np.zeros(len(lengths), np.int32)
    offsets[order] = before[:len(order)] - np.repeat(
        before[:len(order)][first], np.diff(np.append(np.flatnonzero(first), len(order))))
    return sequences, offsets


def dissolve(lengths: np.ndarray, sequences: np.ndarray, capacity: int) -> None:
    """Empties sequences into the gaps of others, best fit, the emptiest first.

    The rule leaves gaps of all sizes open for pieces to come; at the end there are none. A
    sequence is only emptied if all its pieces find a place.
    """
    filled = np.bincount(sequences, lengths).astype(np.int64)
    members: dict[int, list[int]] = {}
    for k in np.flatnonzero(filled[sequences] < capacity).tolist():
        members.setdefault(int(sequences[k]), []).append(k)
    gap_of = {s: capacity - int(filled[s]) for s in members}
    gaps = sorted((gap, s) for s, gap in gap_of.items())

    def drop(entry: tuple[int, int]) -> None:
        at = bisect_left(gaps, entry)
        if at < len(gaps) and gaps[at] == entry:
            del gaps[at]

    for sequence in sorted(members, key=lambda s: (filled[s], s)):
        pieces = sorted(members[sequence], key=lambda k: -lengths[k])
        if not gaps or pieces and lengths[pieces[0]] > gaps[-1][0]:
            continue
        own = gap_of[sequence], sequence
        drop(own)
        moves = []
        for k in pieces:
            length = int(lengths[k])
            at = bisect_left(gaps, (length, -1))
            if at == len(gaps):
                break
            gap, other = gaps.pop(at)
            moves.append((k, gap, other))
            gap_of[other] = gap - length
            if gap > length:
                insort(gaps, (gap - length, other))
        else:
            for k, _, other in moves:
                sequences[k] = other
                members[other].append(k)
            members[sequence] = []
            continue
        # some piece has no place: all go back
        for k, gap, other in reversed(moves):
            drop((gap_of[other], other))
            insort(gaps, (gap, other))
            gap_of[other] = gap
        if own[0]:
            insort(gaps, own)


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY,
                 group_rows: int = GROUP_ROWS) -> DataFrame:
    """Where each piece goes: sequence and offset. Sequence numbers are unique, with gaps."""
    groups = pieces.count() // group_rows + 1

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "piece", "row_key"], ignore_index=True)
        sequences, offsets = place_lengths(rows["length"].to_numpy(np.int64), capacity)
        return pd.DataFrame({"doc_id": rows["doc_id"], "piece": rows["piece"],
                             "row_key": rows["row_key"],
                             "sequence_id": sequences * groups + key[0], "offset": offsets})

    group = F.pmod(F.xxhash64("doc_id", "piece", "row_key"), F.lit(groups)).alias("group")
    return (pieces.select("doc_id", "piece", "row_key", "length", group)
            .groupBy("group").applyInPandas(run, PLACES))


def packed(docs: DataFrame, path: str, capacity: int = CAPACITY,
           group_rows: int = GROUP_ROWS) -> Packed:
    """Pieces with their ids, and their places, as two tables with the same keys."""
    pieces = staging.stage(cut_pieces(docs, path, capacity), "pieces")
    return Packed(pieces, place_pieces(pieces, capacity, group_rows))


def sequences(result: Packed) -> DataFrame:
    """Pieces with ids and places in one table: what a trainer reads, by sequence and offset."""
    return result.pieces.join(result.places.drop("doc_id"), ["row_key", "piece"]).drop("row_key")
