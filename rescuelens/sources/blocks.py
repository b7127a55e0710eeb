"""Records of CSV and JSON array files, each file read by as many tasks as it has splits.

A record may span lines, so where one begins depends on all text before it. That dependence is small:
whether a quoted string is open, and how many brackets are. A file is read in units that Spark's text
reader can find from any byte (lines of CSV; of JSON what lies between closing braces). A first pass
works out, for every split, what it makes of either state of the quotes. The effects of the
splits of a file are combined in order, which gives the state at the start of each. A second pass
then cuts every split into records by itself. A record across the border of two splits is put together
from their edges, which the first pass has kept.

What comes to the driver is three numbers per split, as many as there are tasks, and one row per
file, as in any listing; edges are at most ``EDGE`` bytes or one unit per split. Files with a record so long that its part at a border is not within the
edge are told apart (``unsplit``); their reader has to take them whole.

Both passes have to cut files at the same places. ``spark.sql.files.minPartitionNum`` is therefore set
if it is not, so that the number of executors has no say. Spark's splits are smaller where a scan has less in all, so
the second pass reads all files too, whatever their headers and encodings, and numbers its records by group of files.
A split that the first pass has not seen, from its beginning to its end, ends the job with an error.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rescuelens import session

EDGE = 1 << 18
#: units handled at a time, whatever a batch holds
PIECE = 1024

State = tuple[bool, int]


class CsvLines:
    """Lines; a record ends with a line that leaves no quoted field open. A quote opens a field only as
    its first character, and is doubled inside."""

    separator = b"\n"
    #: a state says by itself whether a record has ended
    flat = True
    # whole fields, then one that is not closed
    _open = re.compile(rb'(?:(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+|),)*+"[^"]*+(?:""[^"]*+)*+\Z')

    @classmethod
    def fold(cls, unit: bytes, inside: bool) -> State:
        """State of the quotes after a unit and its separator, and by how much the depth changes."""
        if b'"' not in unit:
            return inside, 0
        return cls._open.match(b'"' + unit if inside else unit) is not None, 0

    @staticmethod
    def closed(state: State) -> bool:
        return not state[0]

    @staticmethod
    def record(raw: bytes) -> bytes:
        return raw[:-1] if raw.endswith(b"\r") else raw

    @staticmethod
    def top(start: bytes) -> int:
        return 0


class JsonObjects:
    """What lies between closing braces; a record is an object of the top array, or at the top."""

    separator = b"}"
    flat = False
    _string = re.compile(rb'"[^"\\]*(?:\\.[^"\\]*)*"', re.S)
    _end = re.compile(rb'[^"\\]*(?:\\.[^"\\]*)*"', re.S)
    _between = b" \t\r\n,[\xef\xbb\xbf"

    @classmethod
    def fold(cls, unit: bytes, inside: bool) -> State:
        if inside:
            end = cls._end.match(unit)
            if not end:
                return True, 0
            unit = unit[end.end():]
        unit = cls._string.sub(b"", unit) if b'"' in unit else unit
        opened = unit.find(b'"')
        outside = unit if opened < 0 else unit[:opened]
        depth = outside.count(b"{") + outside.count(b"[") - outside.count(b"]")
        return (True, depth) if opened >= 0 else (False, depth - 1)

    @staticmethod
    def closed(state: State) -> bool:
        return not state[0] and state[1] <= 1

    @classmethod
    def record(cls, raw: bytes) -> bytes:
        raw = raw.lstrip(cls._between)
        return raw + b"}" if raw.startswith(b"{") else b""

    @classmethod
    def top(cls, start: bytes) -> int:
        """A file that begins with an object counts as if it stood in an array."""
        return int(start.lstrip(b" \t\r\n\xef\xbb\xbf").startswith(b"{"))


Syntax = type[CsvLines] | type[JsonObjects]


@dataclass
class _Split:
    """What the first pass notes of a split, for a start outside (0) and one inside (1) of quotes."""

    syntax: Syntax
    states: list[State] = field(default_factory=lambda: [(False, 0), (True, 0)])
    units: int = 0
    last: int = 0
    prefix: list[bytes] = field(default_factory=list)
    prefix_bytes: int = 0
    whole: bool = True
    #: whether the prefix holds a record's end, for either start
    ended: list[bool] = field(default_factory=lambda: [False, False])
    #: units since the last end of a record, for either start
    open: list[int] = field(default_factory=lambda: [0, 0])
    suffix: deque = field(default_factory=deque)
    suffix_bytes: int = 0
    valid: bool = True
    undefined: bool = False

    def add(self, unit: bytes, row: int) -> None:
        before = tuple(self.states)
        for h in (0, 1):
            inside, depth = self.states[h]
            inside, more = self.syntax.fold(unit, inside)
            self.states[h] = inside, depth + more
        size = len(unit) + 1
        self.whole = self.whole and not all(self.ended) and (not self.prefix or self.prefix_bytes + size <= EDGE)
        if self.whole:
            self.prefix.append(unit)
            self.prefix_bytes += size
        self.suffix.append((unit, before))
        self.suffix_bytes += size
        while self.suffix_bytes > EDGE and len(self.suffix) > 1:
            self.suffix_bytes -= len(self.suffix.popleft()[0]) + 1
        if self.syntax.flat:
            self._note_end(unit, before)
        self.units, self.last = self.units + 1, row

    def _note_end(self, unit: bytes, before: tuple[State, State]) -> None:
        """What lies between the first and the last end of a record is in no edge."""
        closed = [self.syntax.closed(s) for s in self.states]
        # from outside, a blank line is no record
        solid = not self.syntax.closed(before[0]) or self.syntax.record(unit)
        self.ended = [self.ended[0] or bool(closed[0] and solid), self.ended[1] or closed[1]]
        self.open = [0 if c else n + 1 for c, n in zip(closed, self.open)]
        while len(self.suffix) > max(self.open):
            self.suffix_bytes -= len(self.suffix.popleft()[0]) + 1

    def row(self, block: int) -> tuple:
        join = self.syntax.separator.join
        (in_0, depth_0), (in_1, depth_1) = self.suffix[0][1] if self.suffix else self.states
        prefix = join(self.prefix)
        return (in_0, depth_0, in_1, depth_1, *self.states[0], *self.states[1], self.units, self.last,
                prefix, self.whole, join([u for u, _ in self.suffix]), len(self.suffix),
                self.syntax.top(prefix) if block == 0 else 0, self.valid, self.undefined)


_EVIDENCE = [("from_inside_0", pa.bool_()), ("from_depth_0", pa.int64()), ("from_inside_1", pa.bool_()),
             ("from_depth_1", pa.int64()), ("inside_0", pa.bool_()), ("depth_0", pa.int64()),
             ("inside_1", pa.bool_()), ("depth_1", pa.int64()), ("units", pa.int64()), ("last", pa.int64()),
             ("prefix", pa.binary()), ("whole", pa.bool_()), ("suffix", pa.binary()), ("suffix_units", pa.int64()),
             ("top", pa.int64()), ("valid", pa.bool_()), ("undefined", pa.bool_())]
_SQL = {pa.bool_(): "boolean", pa.int64(): "long", pa.binary(): "binary", pa.string(): "string"}
#: bytes that windows-1254 leaves undefined
_UNDEFINED = re.compile(rb"[\x8d\x8e\x8f\x90\x9d\x9e]")


def _batch(rows: list[tuple], fields: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(fields)],
                                      [n for n, _ in fields])


def _ddl(fields: list[tuple]) -> str:
    return ", ".join(f"{n} {_SQL[t]}" for n, t in fields)


def _note_encoding(split: _Split, units: list[bytes]) -> None:
    try:
        b"\n".join(units).decode()
    except UnicodeDecodeError:
        for unit in units:
            try:
                unit.decode()
            except UnicodeDecodeError:
                split.valid = False
                split.undefined = split.undefined or _UNDEFINED.search(unit) is not None


def _units(spark: SparkSession, path, syntax: Syntax, **options) -> DataFrame:
    """Units as bytes, with file, split and a number that grows within the split."""
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    lines = spark.read.options(lineSep=syntax.separator.decode(), **options).text(path)
    return _in_few_tasks(lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_block_length").alias("length"),
        F.monotonically_increasing_id().alias("row"), F.col("value").cast("binary").alias("unit")))


#: bytes of small splits that are one task's work, where there are splits enough for all cores
TASK = 16 << 20


def _in_few_tasks(units: DataFrame) -> DataFrame:
    """Several small splits to a task: to begin one in Python takes longer than to read a small split."""
    conf, cores = units.sparkSession.conf, units.sparkSession.sparkContext.defaultParallelism
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", conf.get("spark.sql.files.maxPartitionBytes").strip().lower()).groups()
    together = TASK // max(1, int(number) << 10 * " kmgtp".index(unit or " "))
    if together < 2:
        return units
    splits = units.rdd.getNumPartitions()
    tasks = max(8 * cores, -(-splits // together))
    return units.coalesce(tasks) if tasks < splits else units


def _pieces(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Few rows at a time, as Python objects take several times the room of a batch."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def _runs(batch: pa.RecordBatch, *keys: str) -> Iterator[tuple[tuple, int, int]]:
    """Stretches of rows with equal keys."""
    columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
    n = batch.num_rows
    if n:
        new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        for a, b in zip([0, *new], [*new, n]):
            yield tuple(c[a] for c in columns), int(a), int(b)


def _evidence(spark: SparkSession, path, syntax: Syntax, **options) -> DataFrame:
    fields = [("file", pa.string()), ("block", pa.int64()), ("length", pa.int64()), *_EVIDENCE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, split = None, None
        for batch in _pieces(batches, PIECE):
            done = []
            units, rows = batch.column("unit").to_pylist(), batch.column("row").to_pylist()
            for of, a, b in _runs(batch, "file", "block", "length"):
                if of != key:
                    if split:
                        done.append((*key, *split.row(key[1])))
                    key, split = of, _Split(syntax)
                for unit, row in zip(units[a:b], rows[a:b]):
                    split.add(unit, row)
                _note_encoding(split, units[a:b])
            if done:
                yield _batch(done, fields)
        if split:
            yield _batch([(*key, *split.row(key[1]))], fields)

    return _units(spark, path, syntax, **options).mapInArrow(run, _ddl(fields))


def _with_start(evidence: DataFrame) -> DataFrame:
    """The state at the start of each split (``inside``, ``depth``), from the effects of those before.

    An effect on the quotes leaves the state, turns it, or sets it. So the state is what was set last,
    turned as often as turns have followed.
    """
    order = W.partitionBy("file").orderBy("block")
    upto, earlier = order.rowsBetween(W.unboundedPreceding, 0), order.rowsBetween(W.unboundedPreceding, -1)
    sets = F.col("inside_0") == F.col("inside_1")
    turns = F.sum(F.when(F.col("inside_0") & ~F.col("inside_1"), 1).otherwise(0)).over(upto)
    out = evidence.withColumn("turns", turns).withColumn(
        "was_set", F.when(sets, F.struct(F.col("inside_0").alias("to"), F.col("turns").alias("at"))))
    set_last = F.coalesce(F.last("was_set", True).over(earlier),
                          F.struct(F.lit(False).alias("to"), F.lit(0).cast("long").alias("at")))
    turned = (F.coalesce(F.lag("turns").over(order), F.lit(0)) - set_last["at"]) % 2 == 1
    out = out.withColumn("inside", set_last["to"] != turned)
    change = F.when(F.col("inside"), F.col("depth_1")).otherwise(F.col("depth_0"))
    out = out.withColumn("change", change).withColumn("tops", F.sum("top").over(W.partitionBy("file")))
    return out.withColumn("depth", F.col("tops") + F.coalesce(F.sum("change").over(earlier), F.lit(0))).drop(
        "turns", "was_set", "change", "tops", "top")


_EDGES = [("file", pa.string()), ("block", pa.int64()), ("kind", pa.string()), ("row", pa.int64()),
          ("part", pa.binary())]


def _edges(starts: DataFrame, syntax: Syntax) -> DataFrame:
    """Per split: ``head`` (what ends an open record), ``tail`` (what begins one that stays open),
    ``first`` (the first record of the file), ``unsplit`` (an edge is too short)."""
    names = [f.name for f in starts.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches, 1):
            values = [batch.column(n)[0].as_py() for n in names]
            yield _batch([*edges_of(dict(zip(names, values)))], _EDGES)

    def edges_of(s: dict) -> Iterator[tuple]:
        start = (s["inside"], s["depth"])
        h = "1" if s["inside"] else "0"
        end = (s["inside_" + h], s["depth"] + s["depth_" + h])
        place = (s["file"], s["block"])
        prefix = s["prefix"].split(syntax.separator)

        if s["block"] == 0:
            state, raw = start, []
            for unit in prefix:
                raw.append(unit)
                inside, more = syntax.fold(unit, state[0])
                state = inside, state[1] + more
                if syntax.closed(state):
                    found = syntax.record(syntax.separator.join(raw))
                    if found:
                        break
                    raw = []
            else:
                found = syntax.record(syntax.separator.join(raw)) if s["whole"] else None
            yield (*place, "first", 0, found) if found is not None else (*place, "unsplit", 0, b"")

        if not syntax.closed(start):
            state = start
            for k, unit in enumerate(prefix):
                inside, more = syntax.fold(unit, state[0])
                state = inside, state[1] + more
                if syntax.closed(state):
                    yield *place, "head", 0, syntax.separator.join(prefix[:k + 1])
                    break
            else:
                # no record begins here
                yield *place, "head" if s["whole"] else "unsplit", 0, s["prefix"]
                return

        if not syntax.closed(end):
            suffix = s["suffix"].split(syntax.separator)
            state = s["from_inside_" + h], s["depth"] + s["from_depth_" + h]
            at = 0 if syntax.closed(state) else None
            for k, unit in enumerate(suffix):
                inside, more = syntax.fold(unit, state[0])
                state = inside, state[1] + more
                if syntax.closed(state):
                    at = k + 1
            if at is None:
                yield *place, "unsplit", 0, b""
            else:
                yield *place, "tail", s["last"] - len(suffix) + 1 + at, syntax.separator.join(suffix[at:])

    return starts.mapInArrow(run, _ddl(_EDGES))


@dataclass
class Blocks:
    """What the first pass has found out about the files of a scan."""

    spark: SparkSession
    path: str | Sequence[str]
    syntax: Syntax
    options: dict
    files: list[FileFacts]
    #: files with a record that can't be put together from edges
    unsplit: set[str]
    #: keys of the splits in order, and the state each begins with
    keys: np.ndarray
    inside: np.ndarray
    depth: np.ndarray
    edges: DataFrame | None

    def records(self, groups: dict[str, int] | None = None, skip_first: bool = False) -> DataFrame:
        """(file, block, row, group, record); ``groups`` numbers the files, those without a number are left out."""
        of = self.spark.sparkContext.broadcast(dict.fromkeys((f.file for f in self.files), 0) if groups is None else groups)
        whole = _whole_records(self, of, skip_first)
        return whole if self.edges is None else whole.unionByName(_joined(self.edges, of, self.syntax))


class FileFacts(NamedTuple):
    file: str
    #: the first record, None if it is in no edge
    first: bytes | None
    #: all lines are UTF-8; lines that are not hold bytes that windows-1254 leaves undefined
    valid: bool
    undefined: bool


def survey(spark: SparkSession, path, syntax: Syntax, **options) -> Blocks:
    """The first pass over all files of a scan."""
    kept = session.fresh_path(spark, "splits")
    _with_start(_evidence(spark, path, syntax, **options)).write.parquet(kept)
    splits = spark.read.parquet(kept)
    edges = _edges(splits, syntax)

    columns = splits.select(_split_key(), "inside", "depth", "valid", "undefined",
                            F.xxhash64("file").alias("of")).toArrow()
    key, inside, depth, valid, undefined, of = (c.to_numpy() for c in columns.columns)
    order = np.argsort(key)
    not_utf8, odd = set(of[~valid].tolist()), set(of[undefined].tolist())
    # at most one row of each kind per file
    found = edges.select("file", F.xxhash64("file").alias("of"), "kind",
                         F.when(F.col("kind") == "first", F.col("part")).alias("first")).distinct().collect()
    first = {r.file: r.first for r in found if r.kind == "first"}
    names = {r.file: r.of for r in found}
    files = [FileFacts(f, first.get(f), names[f] not in not_utf8, names[f] in odd) for f in sorted(names)]
    some = any(r.kind in ("head", "tail") for r in found)
    if not some:
        session.remove(spark, kept)
    return Blocks(spark, path, syntax, options, files, {r.file for r in found if r.kind == "unsplit"},
                  key[order], inside[order], depth[order], edges.filter("kind IN ('head', 'tail')") if some else None)


def _split_key() -> F.Column:
    """A split is told by its file, and where it begins and ends."""
    return F.xxhash64("file", "block", "length").alias("key")


_RECORD = [("file", pa.string()), ("block", pa.int64()), ("row", pa.int64()), ("group", pa.int64()),
           ("record", pa.binary())]


def _whole_records(blocks: Blocks, groups: Broadcast, skip_first: bool) -> DataFrame:
    """Records that begin and end in one split."""
    syntax = blocks.syntax
    known = blocks.spark.sparkContext.broadcast((blocks.keys, blocks.inside, blocks.depth))

    def start_of(key: int) -> State:
        keys, inside, depth = known.value
        at = int(np.searchsorted(keys, key))
        if at == len(keys) or keys[at] != key:
            raise RuntimeError("a file is split elsewhere than in the first pass; did files or the settings "
                               "spark.sql.files.* change?")
        return bool(inside[at]), int(depth[at])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, state, raw, skip, header, group = None, None, [], False, False, None
        for batch in _pieces(batches, PIECE):
            out = []
            units, rows = batch.column("unit").to_pylist(), batch.column("row").to_pylist()
            files = batch.column("file").to_pylist()
            for (key, block), a, b in _runs(batch, "key", "block"):
                if (key, block) != split:
                    split, state, raw, group = (key, block), start_of(key), [], groups.value.get(files[a])
                    # what is left of a record that began before is in the edges
                    skip = not syntax.closed(state)
                    header = skip_first and block == 0
                if group is None:
                    continue
                for k in range(a, b):
                    raw.append(units[k])
                    inside, more = syntax.fold(units[k], state[0])
                    state = inside, state[1] + more
                    if not syntax.closed(state):
                        continue
                    found = syntax.record(syntax.separator.join(raw) if len(raw) > 1 else raw[0])
                    if found and header:
                        header = False
                    elif found and not skip:
                        out.append((files[k], block, rows[k] - len(raw) + 1, group, found))
                    skip, raw = False, []
            if out:
                yield _batch(out, _RECORD)

    units = _units(blocks.spark, blocks.path, syntax, **blocks.options)
    return units.withColumn("key", _split_key()).mapInArrow(run, _ddl(_RECORD))


def _joined(edges: DataFrame, groups: Broadcast, syntax: Syntax) -> DataFrame:
    """Records across borders: a tail, and the heads up to the next tail."""
    order = W.partitionBy("file").orderBy("block", "kind")
    of = F.sum(F.when(F.col("kind") == "tail", 1).otherwise(0)).over(order)
    # the separator may be a line break, so parts are joined as strings of the same bytes
    part = F.struct("block", "kind", "row", F.col("part").cast("string").alias("part"))
    rows = edges.withColumn("of", of).groupBy("file", "of").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    whole = F.array_join("parts.part", syntax.separator.decode()).cast("binary")

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches, PIECE):
            found = pa.array([syntax.record(r) for r in batch.column("record").to_pylist()], pa.binary())
            of = pa.array([groups.value.get(f) for f in batch.column("file").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], of, found], [n for n, _ in _RECORD])

    first = F.col("parts")[0]
    return (rows.select("file", first["block"].alias("block"), first["row"].alias("row"), whole.alias("record"))
            .mapInArrow(cleaned, _ddl(_RECORD)).filter(F.col("group").isNotNull() & (F.length("record") > 0)))
