"""Counts along a filter run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def kept_per_file(files: DataFrame, kept: DataFrame, file_col: str) -> DataFrame:
    """Kept rows of every scanned file, zero for files without any.

    Both sides are reduced to one row per file before the join.
    """
    counts = kept.groupBy(file_col).agg(F.count("*").alias("kept"))
    return (files.select(file_col).distinct().join(counts, file_col, "left")
            .select(file_col, F.coalesce("kept", F.lit(0)).alias("kept")))


def run_totals(per_file: DataFrame) -> DataFrame:
    """Files scanned, files with matches and rows kept of one run."""
    return per_file.agg(
        F.count("*").alias("files_scanned"),
        F.count_if(F.col("kept") > 0).alias("files_matched"),
        F.coalesce(F.sum("kept"), F.lit(0)).alias("rows_kept"))


def stage_columns(stages: dict[str, Column]) -> list[Column]:
    """Rows read and rows left after each test, every test on top of the ones before."""
    passed, counts = F.lit(True), [F.count(F.lit(1)).alias("rows_read")]
    for name, test in stages.items():
        passed = passed & test
        counts.append(F.count_if(passed).alias(name))
    return counts


def stage_counts(df: DataFrame, stages: dict[str, Column]) -> DataFrame:
    """The same as a table of one row."""
    return df.agg(*stage_columns(stages))
