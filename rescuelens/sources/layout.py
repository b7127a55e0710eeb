"""Spreading input over the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan with fewer splits than there are cores.

    A file of one row group, or a compressed or multi-line text file, is read by a single
    task, which would then do all of the text search alone. Large inputs have more splits
    than cores and pass through without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
