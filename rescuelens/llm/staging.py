"""Results that are read more than once are written to the shared folder first."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rescuelens.session import fresh_path

#: a table of more rows is joined by a shuffle
SENT_ROWS = 100_000

_written: list[str] = []


def stage(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` under ``spark.checkpoint.dir`` and returns the table read back.

    This cuts the lineage in a place that all executors see, so a lost executor costs no
    more than the tasks it ran.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    _written.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def side(df: DataFrame, rows: int) -> DataFrame:
    """``df`` as a side of a join that shuffles if one of the sides may have so many ``rows``.

    Spark sends a table to all tasks by the size of its files, and sorted ids and repeated numbers
    take less than a byte there: 21 million rows were 6 MB, and over 1 GB in the driver.
    """
    return df if rows <= SENT_ROWS else df.hint("merge")


def unused_name(df: DataFrame, name: str) -> str:
    """``name``, or one like it that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def drop(spark: SparkSession, *frames: DataFrame) -> None:
    """Removes staged tables that no later step reads."""
    for df in frames:
        files = df.inputFiles() if df is not None else []
        if files:
            remove(spark, files[0].rsplit("/", 1)[0])


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def clear(spark: SparkSession) -> None:
    """Removes every table staged so far; call it once the results have been stored."""
    while _written:
        remove(spark, _written.pop())
