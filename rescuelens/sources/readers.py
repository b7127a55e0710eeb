"""Readers for post dumps and record files. Schemas are always given, never inferred."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rescuelens import lexicons as lx
from rescuelens.operators.labels import LABEL_DDL
from rescuelens.sources import blocks, columns

EVENT_COLUMNS = ("tweet_id", "tweet_text", "class_label")
CRISIS_COLUMNS = ("id", "event", "source", "text", "lang", "lang_conf", "class_label")
CRISIS_REQUIRED = ("id", "text")
TAGGED_COLUMNS = ("date", "content", "hashtags", "language", "coordinates", "place")
TAGGED_REQUIRED = ("content", "language")

#: order of the rows of a scan: file path by its parts, block, row in the block
SCAN_ORDER = ("_path", "_block", "_row")

PAIR_DDL = f"user string, assistant struct<{LABEL_DDL.replace(chr(10), ' ')}>"
CHAT_DDL = "messages array<struct<role: string, content: string>>"


def list_files(spark: SparkSession, path: str | Sequence[str], glob: str = "*",
               recursive: bool = False) -> DataFrame:
    """Paths of the input files, listed by Spark without reading them.

    Fails if there are none, be it a missing folder or an empty match.
    """
    try:
        files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
                 .option("recursiveFileLookup", str(recursive).lower())
                 .load(path if isinstance(path, str) else list(path)))
    except AnalysisException as e:
        raise FileNotFoundError(f"no {glob} files under {path}") from e
    if not files.inputFiles():
        raise FileNotFoundError(f"no {glob} files under {path}")
    return files.select(F.col("path").alias("_path"))


def path_order(path: Column) -> Column:
    """Sort key of a path: its decoded parts, so that a folder sorts before a/b < a-b."""
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.split(plain, "/")


def _null_cells(c: Column) -> Column:
    return F.when(~c.isin("", *lx.NULL_CELLS), c)


_BLANK = " \t\r\n\ufeff"


@dataclass(frozen=True)
class _Group:
    """Files of a scan that have the same header, and are encoded alike."""

    names: tuple[str, ...]
    files: list[str]
    encoding: str = "UTF-8"

    def column(self, name: str) -> str:
        """Name of a header's column in a schema of positions; of equal names the first counts."""
        return f"c{self.names.index(name)}"

    @property
    def schema(self) -> T.StructType:
        # one more column tells rows that are too long
        return T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(len(self.names) + 1)])


def _grouped(headers: Iterable[tuple[str, Sequence[str], str]]) -> list[_Group]:
    """Groups of (file, header cells, encoding), in the order of their first files."""
    groups: dict[tuple, _Group] = {}
    for file, cells, encoding in headers:
        names = tuple((c or "").strip(_BLANK) for c in cells)
        groups.setdefault((names, encoding), _Group(names, [], encoding)).files.append(file)
    return list(groups.values())


def _literal(file: str) -> str:
    """A listed file as a path to read: decoded, and not taken for a pattern."""
    return re.sub(r"([\[\]{}*?\\,])", r"\\\1", unquote(file))


#: rows of a scan, how to get a cell by column, and the groups that the rows are of; if these are several,
#: their numbers are in the column ``group``
_Scan = tuple[DataFrame, Callable[[str], Column], dict[int, _Group]]


def _by_group(groups: list[_Group], wanted: Sequence[str] | None, required: Sequence[str], order: bool,
              skip_long: bool, scans: Callable[[], Iterable[_Scan]]) -> DataFrame:
    """Rows of all groups, each by its own header; no join.

    Files may hold the columns in any order; one that a file lacks is null there. Every file
    needs the required ones. Missing cells are null, cells beyond the header are ignored, or
    their rows skipped.
    """
    for group in groups:
        columns.require([n for n in group.names if n], required)
    if not groups:
        columns.require([], required)
        raise FileNotFoundError("no file has a header")
    found = dict.fromkeys(n for g in groups for n in g.names if n)
    # without wanted ones: those of the first file, then what others add
    keep = columns.present(found, found if wanted is None else wanted)
    frames = []
    for rows, cell, own in scans():
        def cell_or_null(at: str | None, cell=cell) -> Column:
            return F.lit(None).cast("string") if at is None else cell(at)

        if skip_long:
            rows = rows.filter(_per_group(own, lambda g: f"c{len(g.names)}", cell).isNull())
        picked = [_null_cells(_per_group(own, lambda g: g.column(c) if c in g.names else None, cell_or_null)).alias(c)
                  for c in keep]
        frames.append(rows.select(*picked, *([path_order(F.col("file")).alias("_path"), F.col("block").alias("_block"),
                                              F.col("row").alias("_row")] if order else [])))
    return reduce(DataFrame.unionAll, frames)


def _per_group(own: dict[int, _Group], key: Callable[[_Group], str | None],
               value: Callable[[str | None], Column]) -> Column:
    """A value that depends on the group by a key alone."""
    alike: dict[str | None, list[int]] = {}
    for number, group in own.items():
        alike.setdefault(key(group), []).append(number)
    if len(alike) == 1:
        return value(next(iter(alike)))
    return reduce(lambda chain, k: chain.when(F.col("group").isin(alike[k]), value(k)), alike, F)


def _placed(rows: DataFrame) -> DataFrame:
    """Next to the cells: file, block, and a number that grows within the block."""
    return rows.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                       F.monotonically_increasing_id().alias("row"))


#: mean size of files from which on they are not read to the end for their first line
LARGE_FILE = 64 << 20


def first_lines(spark: SparkSession, path, **options) -> DataFrame:
    """(file, line): the first line of every file that is not blank.

    Large files are one task each, which ends as soon as it has the line: little of a file is read,
    whatever its size. That costs a Python worker per file, so small ones are read as usual.
    """
    lengths = spark.read.format("binaryFile").options(**options).load(path).agg(F.avg("length")).first()[0] or 0
    peek = spark
    if lengths >= LARGE_FILE:
        peek = spark.newSession()
        for name in ("maxPartitionBytes", "openCostInBytes"):
            peek.conf.set(f"spark.sql.files.{name}", str(1 << 50))
        peek.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    lines = peek.read.options(**options).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), "value")
    solid = F.length(F.btrim("value", F.lit(_BLANK))) > 0
    if peek is spark or lines.rdd.getNumPartitions() != len(lines.inputFiles()):
        return lines.filter((F.col("block") == 0) & solid).groupBy("file").agg(F.min_by("value", "row").alias("line"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, line in zip(*(batch.column(n).to_pylist() for n in ("file", "line"))):
                if line.strip(b" \t\r\n\xef\xbb\xbf"):
                    yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([line.decode(errors="replace")])],
                                                     ["file", "line"])
                    return

    return lines.select("file", F.col("value").cast("binary").alias("line")).mapInArrow(run, "file string, line string")


def read_tsv(spark: SparkSession, path: str | Sequence[str], wanted: Sequence[str],
             required: Sequence[str], recursive: bool = False,
             types: dict[str, str] | None = None, order: bool = False) -> DataFrame:
    """Scan ``*.tsv`` files with a header each and no quoting.

    A stray quote is an ordinary character. Extra fields are ignored, missing ones null,
    blank lines do not count. ``order`` adds the columns of ``SCAN_ORDER``.
    """
    list_files(spark, path, "*.tsv", recursive)
    paths = path if isinstance(path, str) else list(path)
    options = {"pathGlobFilter": "*.tsv", "recursiveFileLookup": str(recursive).lower()}
    heads = first_lines(spark, paths, **options).orderBy("file").collect()
    groups = _grouped((r.file, r.line.split("\t"), "UTF-8") for r in heads)

    def scans():
        for n, group in enumerate(groups):
            rows = spark.read.schema(group.schema).options(
                header="true", sep="\t", quote="", escape="\0", nullValue="", mode="PERMISSIVE", **options).csv(
                paths if len(groups) == 1 else [_literal(f) for f in group.files])
            yield _placed(rows), F.col, {n: group}

    df = _by_group(groups, wanted, required, order, False, scans)
    for c, t in (types or {}).items():
        if c in df.columns:
            df = df.withColumn(c, F.col(c).try_cast(t))
    return df


def read_event_posts(spark: SparkSession, root, order: bool = False) -> DataFrame:
    """Event corpus: nested folders of TSV files. Ids stay text, so none loses digits."""
    return read_tsv(spark, root, EVENT_COLUMNS, EVENT_COLUMNS, recursive=True, order=order)


def read_crisis_posts(spark: SparkSession, folder, order: bool = False) -> DataFrame:
    """Crisis corpus: the TSV files of one folder; all but id and text are optional."""
    return read_tsv(spark, folder, CRISIS_COLUMNS, CRISIS_REQUIRED,
                    types={"lang_conf": "double"}, order=order)


#: CSV as Spark reads it: an absent cell is null, an empty one is not
_CSV = {"escape": '"', "nullValue": "\ufdd0", "emptyValue": "", "mode": "PERMISSIVE"}


def read_csv(spark: SparkSession, path, wanted: Sequence[str] | None = None,
             required: Sequence[str] = (), encoding: str = "UTF-8",
             order: bool = False, skip_long: bool = False, multi_line: bool = True) -> DataFrame:
    """Scan CSV files with a header each and standard quoting.

    Values may span lines unless ``multi_line`` is off; a file is many tasks' work in either case.
    Missing fields are null; rows with too many are cut to the header, or skipped.
    """
    if multi_line:
        return _read_records(blocks.survey(spark, path, blocks.CsvLines), wanted, required, order, skip_long,
                             lambda file: encoding)
    heads = first_lines(spark, path).orderBy("file").collect()
    groups = _grouped((r.file, _header_cells(r.line), encoding) for r in heads)

    def scans():
        for n, group in enumerate(groups):
            rows = spark.read.schema(group.schema).options(header="true", encoding=encoding, **_CSV).csv(
                path if len(groups) == 1 else [_literal(f) for f in group.files])
            yield _placed(rows), F.col, {n: group}

    return _by_group(groups, wanted, required, order, skip_long, scans)


def _header_cells(record: str) -> list[str]:
    return next(csv.reader(io.StringIO(record.strip(_BLANK), newline="")), [])


def _read_records(found: blocks.Blocks, wanted: Sequence[str] | None, required: Sequence[str], order: bool,
                  skip_long: bool, encoding_of: Callable[[blocks.FileFacts], str]) -> DataFrame:
    """CSV records that span lines, by header and encoding."""
    spark = found.spark
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")

    headers = []
    for f in found.files:
        encoding = encoding_of(f)
        if f.first is not None:
            headers.append((f.file, _header_cells(f.first.decode(encoding, "replace")), encoding))
        elif f.file in found.unsplit:
            row = spark.read.options(multiLine="true", encoding=encoding, **_CSV).csv(_literal(f.file)).first()
            headers.append((f.file, list(row or []), encoding))
    groups = _grouped(headers)

    def scans():
        # one scan of all files that are cut, whatever their headers and encodings
        number = {f: n for n, group in enumerate(groups) for f in group.files if f not in found.unsplit}
        own = {n: groups[n] for n in sorted(set(number.values()))}
        if own:
            widest = max(own.values(), key=lambda g: len(g.names)).schema
            records = found.records(number, skip_first=True)
            text = _per_group(own, lambda g: g.encoding, lambda encoding: F.col("record").cast("string")
                              if encoding == "UTF-8" else F.decode("record", encoding))
            yield records.select(
                F.from_csv(text, ", ".join(f"{c} string" for c in widest.names), {"multiLine": "true", **_CSV})
                .alias("cells"), "file", "block", "row", "group"), lambda name: F.col("cells")[name], own
        for n, group in enumerate(groups):
            rest = [_literal(f) for f in group.files if f in found.unsplit]
            if rest:
                rows = spark.read.schema(group.schema).options(
                    multiLine="true", header="true", encoding=group.encoding, **_CSV).csv(rest)
                yield _placed(rows), F.col, {n: group}

    return _by_group(groups, wanted, required, order, skip_long, scans)


def read_tagged_posts(spark: SparkSession, path, order: bool = False) -> DataFrame:
    """Tagged corpus: CSV; dates in any usual form, unreadable ones null, in UTC."""
    df = read_csv(spark, path, TAGGED_COLUMNS, TAGGED_REQUIRED, order=order)
    if "date" in df.columns:
        df = df.withColumn("date", parse_date(F.col("date")))
    return df


#: date forms tried in turn, after the ISO ones; times without a zone are UTC
DATE_FORMS = ("EEE MMM dd HH:mm:ss Z yyyy", "EEE, d MMM yyyy HH:mm:ss Z", "EEE, d MMM yyyy HH:mm:ss z",
              "M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "M/d/yyyy", "yyyyMMdd", "yyyyMMdd HHmmss",
              "yyyy/M/d H:mm:ss", "yyyy/M/d H:mm", "yyyy/M/d", "MMM d, yyyy H:mm:ss", "MMM d, yyyy",
              "MMMM d, yyyy", "d MMM yyyy H:mm:ss", "d MMM yyyy", "d MMMM yyyy", "d-MMM-yyyy")


def parse_date(c: Column) -> Column:
    """Timestamp of a date in an ISO form or one of ``DATE_FORMS``; null if there is none.

    The day of the week is not checked against the date: it is cut off first. In forms with
    slashes the month comes first.
    """
    text = F.btrim(F.regexp_replace(c, r"\s+", " "))
    # eight digits are a date, not a year
    iso = F.when(~text.rlike("^[0-9]{5,}( |$)"), F.try_to_timestamp(text))
    plain = F.regexp_replace(text, "^(?i:mon|tue|wed|thu|fri|sat|sun)[a-z]*,? ", "")
    forms = [f.removeprefix("EEE, ").removeprefix("EEE ") for f in DATE_FORMS]
    return F.coalesce(iso, *[F.try_to_timestamp(plain, F.lit(f)) for f in forms])


def file_encodings(spark: SparkSession, path) -> DataFrame:
    """Encoding of every file: UTF-8 if all its lines are, else a Turkish single-byte one.

    Lines are tested as raw bytes where they lie, so large files are split like any
    scan. Bytes that windows-1254 leaves undefined point to ISO-8859-9.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("value"))
    valid = F.is_valid_utf8("value")
    undefined = F.when(~valid, F.hex(F.col("value").cast("binary")).rlike(
        "^(?:..)*(?:8D|8E|8F|90|9D|9E)"))
    return lines.groupBy("file").agg(
        F.when(F.bool_and(valid), "UTF-8")
         .when(F.coalesce(F.bool_or(undefined), F.lit(False)), "ISO-8859-9")
         .otherwise("windows-1254").alias("encoding"))


def read_csv_any_encoding(spark: SparkSession, path, wanted: Sequence[str] | None = None,
                          required: Sequence[str] = ()) -> DataFrame:
    """CSV files in UTF-8 (with or without mark) or a Turkish single-byte encoding.

    The pass that finds the records' places also tests the bytes, so the text is read twice in all.
    """
    found = blocks.survey(spark, path, blocks.CsvLines)

    def encoding_of(file: blocks.FileFacts) -> str:
        return "UTF-8" if file.valid else "ISO-8859-9" if file.undefined else "windows-1254"
    return _read_records(found, wanted, required, False, False, encoding_of)


def read_json_array(spark: SparkSession, path, schema: str = PAIR_DDL) -> DataFrame:
    """Files that hold one JSON array of records each; a file of any size is many tasks' work."""
    found = blocks.survey(spark, path, blocks.JsonObjects)
    split = [f.file for f in found.files if f.file not in found.unsplit]
    frames = []
    if split or not found.unsplit:
        records = found.records(dict.fromkeys(split, 0))
        frames.append(records.select(F.from_json(F.col("record").cast("string"), schema).alias("r")).select("r.*"))
    if found.unsplit:
        frames.append(spark.read.schema(schema).option("multiLine", "true").json(
            [_literal(f) for f in sorted(found.unsplit)]))
    return reduce(DataFrame.unionAll, frames)


def read_json_sets(spark: SparkSession, path: str, set_col: str, sets: Sequence[str],
                   schema: str = PAIR_DDL) -> DataFrame:
    """What :func:`writers.write_json_sets` has written, with the set as last column."""
    return reduce(DataFrame.unionAll, [read_json_array(spark, f"{path}/{set_col}={name}", schema)
                                       .withColumn(set_col, F.lit(name)) for name in sets])


def read_jsonl(spark: SparkSession, path, schema: str = CHAT_DDL) -> DataFrame:
    """One JSON record per line."""
    return spark.read.schema(schema).json(path)


def append_all(*frames: DataFrame) -> DataFrame:
    """Rows of all inputs; columns one of them lacks are null there."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result
