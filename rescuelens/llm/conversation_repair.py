"""Repairs conversations with a generalised LR parser over the grammar of roles.

A sound conversation is an optional system turn and pairs of user and assistant turns, or
nothing: ``(s?(ua)+)?`` in initials. The parser reads turns in order and may keep a turn (cost 0),
give it another role (3), delete it (4) or insert an empty turn (3); a faulty turn that stays
costs 3 more if it is cut off, and has to go if it is blank or a duplicate. All ways are followed
at once on a graph-structured stack: stacks share their lower parts, and equal stack tops are
merged into the one of the least (cost, audit), audit being the initials of the edits. Before a
row is read all audits hold the same number of edits of rows and end in one, so none begins
another, and the lesser of two stays the lesser whatever follows: their order is kept as a rank, and
audits themselves are never compared. Tops that cost over ``SLACK`` more than the best can't win
and are left out. What is left depends on few things, so each step is worked out once and looked up
afterwards.

Three steps run on Spark. Equal rows of a conversation become one with a count, ahead of the
shuffle; first occurrences are a minimum per role and text. Then the faults, not the texts, are
sorted by conversation and a task streams them through the parser; it holds the tops of one
conversation and their audits. Last, texts are sorted behind their audit, and the edits are
applied to them as they pass. A conversation's repair is a sequential computation, so it is one
task's work, but none of its texts is held.

Null roles and texts count as one space. Turns are ordered by number (null first), then role and
digest of the text; repeated rows are repeated turns. Rows without a conversation id are one
conversation without an id. A text of any length is searched whole. An empty table gives empty
results. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rescuelens.llm import staging

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3
#: roles that turns may get, by initial
ROLES = {"u": "user", "a": "assistant"}
#: to follow another top's edits takes an insert to be in step, the deletion of a system turn or two
#: inserts at the end
SLACK = 2 * INSERT + DELETE

# LR table of C -> | P and P -> u a | s u a | P u a; the end is accepted in states 0 and 4
SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 3, (2, "a"): 5, (3, "a"): 6, (4, "u"): 7, (7, "a"): 8}
REDUCE = {5: ("P", 2), 6: ("P", 3), 8: ("P", 3)}
GOTO = {(0, "P"): 4}
ACCEPTED = {0, 4}

#: rows after which the audits of all tops are written down as strings
WRITTEN = 4096

AUDIT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
         "audit string")
TURN = "conv_id long, place long, role string, text string, edit string"
_BLANKS = " \t\n\x0b\x0c\r"


# --- parser --------------------------------------------------------------------------------


class Stack(NamedTuple):
    """A node of the stack; equal ones are one, however they came about."""

    state: int
    below: Stack | None


BOTTOM = Stack(0, None)
Tops = tuple[tuple[Stack, int], ...]


@cache
def shifted(top: Stack, symbol: str) -> Stack | None:
    """The top after a symbol and the reductions that follow, None if it does not fit."""
    state = SHIFT.get((top.state, symbol))
    if state is None:
        return None
    top = Stack(state, top)
    while top.state in REDUCE:
        symbol, length = REDUCE[top.state]
        for _ in range(length):
            top = top.below
        top = Stack(GOTO[top.state, symbol], top)
    return top


def _with_inserts(top: Stack) -> Iterator[tuple[Stack, int, str]]:
    """Tops reached by inserts: (top, cost, audit); a top that was there before costs less."""
    seen, reached = set(), [(top, 0, "")]
    for top, cost, audit in reached:
        if top in seen:
            continue
        seen.add(top)
        yield top, cost, audit
        for symbol in ROLES:
            if (after := shifted(top, symbol)) is not None:
                reached.append((after, cost + INSERT, audit + "I"))


@cache
def step(tops: Tops, initial: str, cut_off: bool, must_go: bool) -> tuple[Tops, tuple, int]:
    """Reads a row: the tops after it, where each comes from, and what the cheapest costs more.

    ``tops`` are (top, cost above the cheapest) in the order of their audits.
    """
    found: dict[Stack, tuple] = {}
    stay = CUT_OFF if cut_off else 0
    for rank, (base, cost) in enumerate(tops):
        for top, more, audit in _with_inserts(base):
            edits = [(top, DELETE, "D")]
            if not must_go:
                edits.append((shifted(top, initial), KEEP + stay, "K"))
                edits += [(shifted(top, role), REROLE + stay, "R") for role in ROLES]
            for after, price, edit in edits:
                way = (cost + more + price, rank, audit + edit)
                if after is not None and (after not in found or way < found[after]):
                    found[after] = way
    least = min(way[0] for way in found.values())
    kept = sorted((way[1], way[2], top, way[0] - least) for top, way in found.items() if way[0] - least <= SLACK)
    return tuple((top, cost) for _, _, top, cost in kept), tuple((rank, edits) for rank, edits, _, _ in kept), least


@cache
def close(tops: Tops) -> tuple[int, int, str]:
    """The cheapest end: cost above the cheapest top, its rank, the inserts."""
    return min((cost + more, rank, audit) for rank, (base, cost) in enumerate(tops)
               for top, more, audit in _with_inserts(base) if top.state in ACCEPTED)


class Repair:
    """The parse of one conversation, and what is counted on the way."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id = conv_id
        self.tops: Tops = ((BOTTOM, 0),)
        # audits as chains: (edits, what came before, are these edits written down)
        self.audits: list[tuple] = [("", None, True)]
        self.cost = self.rows = 0
        self.low = self.high = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before = None

    def read(self, turn: int | None, initial: str, blank: bool, cut_off: bool, first: bool, copies: int) -> None:
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += 1
        self.blank += copies if blank else 0
        self.duplicate += 0 if blank else copies - first
        self.truncated += cut_off and first and not blank
        if self.before is not None:
            self.illegal += self.before + initial not in ("su", "ua", "au")
        self.illegal += copies - 1
        self.before = initial
        symbol = initial if initial in ("s", *ROLES) else ""
        for n in range(copies):
            must_go = blank or not first or n > 0
            self._edit(symbol, cut_off and not must_go, must_go)

    def _edit(self, initial: str, cut_off: bool, must_go: bool) -> None:
        self.tops, origins, more = step(self.tops, initial, cut_off, must_go)
        self.audits = [(edits, self.audits[rank], False) for rank, edits in origins]
        self.cost += more
        self.rows += 1
        if self.rows % WRITTEN == 0:
            self.audits = [self._written(a) for a in self.audits]

    @staticmethod
    def _written(audit: tuple) -> tuple:
        edits = []
        while not audit[2]:
            edits.append(audit[0])
            audit = audit[1]
        return "".join(reversed(edits)), audit, True

    def result(self) -> tuple:
        more, rank, inserts = close(self.tops)
        parts, audit = [inserts], self.audits[rank]
        while audit:
            parts.append(audit[0])
            audit = audit[1]
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, (1 << 63) - 1)
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal,
                self.cost + more, "".join(reversed(parts)))


# --- rows ----------------------------------------------------------------------------------


def counted(turns: DataFrame) -> DataFrame:
    """Equal rows of a conversation as one, with their number, their digest and their faults."""
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    text = F.btrim("text", F.lit(_BLANKS))
    return rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies")).select(
        "*", F.unhex(F.sha2(F.concat_ws("\0", "role", "text"), 256)).alias("digest"),
        F.substring("role", 1, 1).alias("initial"), (text == "").alias("blank"),
        ((text != "") & ~F.substring(text, -1, 1).isin(".", "!", "?")).alias("cut_off"))


def marked(rows: DataFrame) -> DataFrame:
    """``counted`` rows without their texts; ``first`` where no earlier turn has role and text."""
    slim = rows.drop("text")
    first = rows.groupBy("conv_id", "digest").agg(F.min(F.struct(F.col("turn").isNotNull(), "turn")).alias("f")).select(
        F.col("conv_id").alias("f_conv"), F.col("digest").alias("f_digest"), F.col("f.turn").alias("f_turn"))
    # both sides have one row per key, however often a text occurs
    return slim.join(first, F.col("conv_id").eqNullSafe(F.col("f_conv")) & (F.col("digest") == F.col("f_digest"))
                     & F.col("turn").eqNullSafe(F.col("f_turn")), "left").withColumn(
        "first", F.col("f_digest").isNotNull()).drop("f_conv", "f_digest", "f_turn")



def _in_order(rows: DataFrame, *before: str) -> DataFrame:
    """Conversations together, their rows in order; partitions are dealt by conversation."""
    return rows.repartition("conv_id").sortWithinPartitions(
        "conv_id", *before, F.asc_nulls_first("turn"), "role", "digest")


def _record(rows: list[tuple], names: tuple[str, ...], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], list(names))


def audits_of(marks: DataFrame) -> DataFrame:
    """Per conversation: faults, cost of the cheapest repair and its edits."""
    names = ("conv_id", "turn", "initial", "blank", "cut_off", "first", "copies")
    fields = [f.strip().split()[0] for f in AUDIT.split(",")]
    types = [pa.int64()] * 7 + [pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repair, done = None, []
        for batch in batches:
            for conv_id, *row in zip(*(batch.column(n).to_pylist() for n in names)):
                if repair is None or repair.conv_id != conv_id:
                    if repair:
                        done.append(repair.result())
                    repair = Repair(conv_id)
                repair.read(*row)
            if done:
                yield _record(done, fields, types)
                done.clear()
        if repair:
            yield _record([repair.result()], fields, types)

    return _in_order(marks).select(*names).mapInArrow(run, AUDIT)


def applied(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The repaired turns (conv_id, place, role, text, edit). Rows of a conversation follow each other
    in a partition."""
    fields = [f.strip().split()[0] for f in TURN.split(",")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    edits = audits.select("conv_id", F.lit(False).alias("is_turn"), "audit", *(
        F.lit(None).cast(t).alias(n) for n, t in (
            ("turn", "long"), ("role", "string"), ("digest", "binary"), ("text", "string"), ("copies", "long"))))
    texts = rows.select("conv_id", F.lit(True).alias("is_turn"), F.lit(None).cast("string").alias("audit"),
                        "turn", "role", "digest", "text", "copies")
    names = ("conv_id", "is_turn", "audit", "role", "text", "copies")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_id, audit, at, place, top, out = None, "", 0, 0, BOTTOM, []

        def put(edit: str, role: str, text: str) -> None:
            nonlocal place, top
            if edit != "K":
                symbol = next(s for s in ROLES if shifted(top, s) is not None)
                role = ROLES[symbol]
            top = shifted(top, role[:1])
            out.append((conv_id, place, role, text, edit))
            place += 1

        def inserts() -> None:
            nonlocal at
            while audit[at:at + 1] == "I":
                put("I", "", "")
                at += 1

        for batch in batches:
            for of, is_turn, edits, role, text, copies in zip(*(batch.column(n).to_pylist() for n in names)):
                if not is_turn:
                    # what is left of the conversation before are inserts at its end
                    inserts()
                    conv_id, audit, at, place, top = of, edits, 0, 0, BOTTOM
                    continue
                for _ in range(copies):
                    inserts()
                    if audit[at] != "D":
                        put(audit[at], role, text)
                    at += 1
            if out:
                yield _record(out, fields, types)
                out.clear()
        inserts()
        if out:
            yield _record(out, fields, types)

    return _in_order(edits.unionByName(texts), "is_turn").select(*names).mapInArrow(run, TURN)


class Repaired(NamedTuple):
    audits: DataFrame
    turns: DataFrame


def repaired(turns: DataFrame) -> Repaired:
    """Audits (one row per conversation) and the turns of the repaired conversations."""
    rows = staging.stage(counted(turns), "turns")
    audits = staging.stage(audits_of(marked(rows)), "audits")
    return Repaired(audits, applied(rows, audits))


def digests(turns: DataFrame) -> DataFrame:
    """SHA-256 of ``role:text`` lines per conversation, of turns as ``applied`` leaves them. One
    running digest is held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_id, digest, done = None, None, []
        names, types = ("conv_id", "repaired_sha256"), [pa.int64(), pa.string()]
        for batch in batches:
            for of, place, role, text in zip(*(batch.column(n).to_pylist()
                                               for n in ("conv_id", "place", "role", "text"))):
                if place == 0:
                    if digest:
                        done.append((conv_id, digest.hexdigest()))
                    conv_id, digest = of, hashlib.sha256()
                digest.update(f"{chr(10) if place else ''}{role}:{text}".encode())
            if done:
                yield _record(done, names, types)
                done.clear()
        if digest:
            yield _record([(conv_id, digest.hexdigest())], names, types)

    return turns.select("conv_id", "place", "role", "text").mapInArrow(run, "conv_id long, repaired_sha256 string")
