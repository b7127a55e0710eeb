"""Secret scan: fixed patterns, and random strings shown by a token-efficiency test.

A subword vocabulary writes words and names with few tokens and random strings with many. Every run of
``LEAST_CHARS`` or more characters of ``[A-Za-z0-9+/_-]`` with a letter is encoded; fewer than
``LEAST_RATIO`` characters per token expose a random string. Known digests (hex of the usual lengths) and
UUIDs are left out first, and so is what lies within a span of a fixed pattern. So are identifiers:
runs of which at least half of the letters are in words that the vocabulary has as one token. Runs
that are written like words, in one case and at most with a number behind, may be words of a language
that the vocabulary hardly knows, and are random only below ``LEAST_WORD_RATIO``.

Whole texts are scanned in Arrow batches, as bytes; offsets are code points, end exclusive. Null
and empty texts have no spans. Repeated rows are scanned apart. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rescuelens.llm import textscan

# --- fixed values -------------------------------------------------------------------------

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(rb"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
                    rb"([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{32,}")

# --- end of fixed values ------------------------------------------------------------------

LEAST_CHARS = 16
#: characters per token; English words come to four and more, random base64 to under two
LEAST_RATIO = 2.2
#: the same for what may be words; random letters come to under 1.4
LEAST_WORD_RATIO = 1.5
#: letters of a word that tells an identifier
LEAST_WORD = 3

_RUN = re.compile(rb"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}={0,2}" % LEAST_CHARS)
_DIGEST = re.compile(rb"(?:[0-9a-f]+|[0-9A-F]+)\Z")
_DIGEST_CHARS = {32, 40, 48, 56, 64, 96, 128}
_UUID = re.compile(rb"(?i)[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}\Z")
#: written like words
_WORDS = re.compile(rb"(?:[A-Z]?[a-z]+|[A-Z]+)(?:[+/_-]+(?:[A-Z]?[a-z]+|[A-Z]+))*[0-9]{0,4}\Z")
_PARTS = re.compile(rb"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

FOUND = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType())])))])


def vocabulary(path: str, pattern: str):
    """The encoder of a vocabulary file of base64 strings and ranks."""
    import tiktoken
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("subwords", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def is_known(run: bytes) -> bool:
    """Digests, UUIDs and numbers: strings that look random but tell no secret."""
    core = run.rstrip(b"=")
    return (not re.search(rb"[A-Za-z]", core) or bool(_UUID.match(core))
            or (len(core) in _DIGEST_CHARS and bool(_DIGEST.match(core))))


def is_identifier(run: bytes, encoder) -> bool:
    """Whether words of the vocabulary hold at least half of the letters."""
    letters = known = 0
    for part in _PARTS.findall(run):
        letters += len(part)
        if len(part) >= LEAST_WORD:
            word = part.decode()
            known += len(part) * any(len(encoder.encode_ordinary(w)) == 1 for w in (word, " " + word, " " + word.lower()))
    return 2 * known >= letters


def is_random(run: bytes, encoder) -> bool:
    """The token test, after what is known by its form."""
    if is_known(run):
        return False
    ratio = len(run) / len(encoder.encode_ordinary(run.decode()))
    if _WORDS.match(run):
        return ratio < LEAST_WORD_RATIO
    return ratio < LEAST_RATIO and not is_identifier(run, encoder)


def spans_of(text: bytes, encoder) -> list[tuple[int, int, str]]:
    """(start, end, kind) in bytes, by start and kind."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text)
             if m.end(2) - m.start(2) >= 8]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)
              if m.end() - m.start() >= 16]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    # the furthest end of the spans that begin at or before each start
    starts = sorted(s[0] for s in found)
    ends = list(accumulate((s[1] for s in sorted(found)), max))
    for m in _RUN.finditer(text):
        before = bisect_right(starts, m.start())
        if before and ends[before - 1] >= m.end():
            continue
        if is_random(m.group(), encoder):
            found.append((m.start(), m.end(), "random"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


_open: dict[tuple[str, str], object] = {}


def scan(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, spans) per row. ``path`` and ``pattern`` describe the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (path, pattern) not in _open:
            _open[path, pattern] = vocabulary(path, pattern)
        encoder = _open[path, pattern]
        for batch in batches:
            data, offsets = textscan.raw_texts(batch.column("text"))
            out = []
            for r in range(batch.num_rows):
                text = data[offsets[r]:offsets[r + 1]].tobytes()
                spans = spans_of(text, encoder)
                if spans and not text.isascii():
                    chars = np.concatenate([[0], np.cumsum(
                        (np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
                    spans = [(int(chars[a]), int(chars[b]), kind) for a, b, kind in spans]
                out.append([{"kind": kind, "start": a, "end": b} for a, b, kind in spans])
            spans = pa.array(out, pa.list_(pa.struct(
                [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), spans], ["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, FOUND)
