"""Sinks. Every writer replaces what the path held before and writes in parallel."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: records handled at a time, whatever a batch holds
PIECE = 256


def write_csv(df: DataFrame, path: str, encoding: str = "UTF-8") -> None:
    """CSV parts with a header each; values keep their white space and line breaks."""
    if encoding != "UTF-8":
        df.sparkSession.conf.set("spark.sql.legacy.javaCharsets", "true")
    (df.write.mode("overwrite").option("header", "true").option("escape", '"')
       .option("emptyValue", "").option("ignoreLeadingWhiteSpace", "false")
       .option("ignoreTrailingWhiteSpace", "false").option("encoding", encoding).csv(path))


def write_tsv(df: DataFrame, path: str, *folders: str) -> None:
    """Unquoted TSV parts with a header each, in one folder per value of ``folders``.

    A tab or line break inside a value would break its line, so it becomes a blank.
    """
    plain = [F.col(c) if c in folders else F.translate(c, "\t\r\n", "   ").alias(c)
             for c in df.columns]
    (df.select(*plain).write.mode("overwrite").partitionBy(*folders)
       .option("header", "true").option("sep", "\t").option("quote", "\u0000")
       .option("escapeQuotes", "false").option("emptyValue", "")
       .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
       .option("extension", "tsv").csv(path))


def write_json_array(df: DataFrame, path: str, indent: bool = False) -> None:
    """Parts that each hold one JSON array, null fields included; indented by two if wished.

    A part is one task's rows, record by record, so its size follows the input splits and no
    row is held back.
    """
    write_json_texts(df.select(_record(F.struct("*"), indent).alias("value")), path)


def write_json_texts(df: DataFrame, path: str) -> None:
    """The same for records that are JSON already, in the only column."""
    # a task that ends with nothing writes an empty array; the reader skips it
    df.toDF("value").mapInArrow(_framed, "value string").write.mode("overwrite").option("extension", "json").text(path)


def _framed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Brackets and commas around the records of one task, a few records at a time."""
    first = True
    for batch in batches:
        for k in range(0, batch.num_rows, PIECE):
            values = batch.column("value").slice(k, PIECE)
            marks = pa.array(["[" if first else ",", *[","] * (len(values) - 1)], values.type)
            first = False
            yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(marks, values, pa.scalar("", values.type))],
                                             ["value"])
    yield pa.RecordBatch.from_arrays([pa.array(["[]" if first else "]"])], ["value"])


def _record(record: Column, indent: bool = False) -> Column:
    return F.to_json(record, {"ignoreNullFields": "false", "pretty": str(indent).lower()})


def write_json_sets(df: DataFrame, path: str, set_col: str, sets: Sequence[str], indent: bool = False) -> None:
    """One folder ``set_col=...`` per set, of parts that each hold one JSON array of the other columns.

    Every set has a part, if only an empty array. A task writes one part per set; a part is seen only
    once the whole job has succeeded, so failed tasks leave nothing.
    """
    rows = df.select(F.col(set_col).cast("string").alias("of"),
                     _record(F.struct(*(c for c in df.columns if c != set_col)), indent).alias("value"))

    def framed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # n is the order in the part: brackets and commas have to stay where they are
        written = dict.fromkeys(sets, 0) if TaskContext.get().partitionId() == 0 else {}
        for frame in frames:
            for of, own in frame.groupby("of", sort=False):
                n = written.get(of, 0)
                values = "," + own["value"]
                if n == 0:
                    values.iloc[0] = "[" + own["value"].iloc[0]
                yield pd.DataFrame({"of": of, "n": range(n, n + len(own)), "value": values.to_numpy()})
                written[of] = n + len(own)
        yield pd.DataFrame([(of, n, "]" if n else "[]") for of, n in written.items()], columns=["of", "n", "value"])

    if df.rdd.getNumPartitions() == 0:
        rows = rows.repartition(1)
    (rows.mapInPandas(framed, "of string, n long, value string").sortWithinPartitions("of", "n")
     .select(F.col("of").alias(set_col), "value").write.mode("overwrite").partitionBy(set_col)
     .option("extension", "json").text(path))


def write_jsonl(df: DataFrame, path: str) -> None:
    """One record per line, null fields included, other scripts unescaped."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_pairs(df: DataFrame, path: str, split_col: str | None = None) -> None:
    """Training pairs as JSON lines, without the cluster column kept for splitting.

    With a split column, one folder ``split=...`` per set.
    """
    writer = (df.drop("_cluster").write.mode("overwrite")
              .option("ignoreNullFields", "false"))
    if split_col is not None:
        writer = writer.partitionBy(split_col)
    writer.json(path)
