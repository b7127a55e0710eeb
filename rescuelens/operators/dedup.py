"""First-wins deduplication and checks against earlier output.

``row_number() = 1`` over the key is planned with a per-task limit before the
shuffle, so a key that holds a third of all rows sends at most one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rescuelens.functions import text


def id_or_text_key(id_col: str, text_col: str) -> Column:
    """Trimmed id; where it is missing or blank, the folded, space-collapsed text."""
    return F.coalesce(text.empty_to_null(text.strip(id_col)), text_key(text_col))


def text_key(c: Column | str) -> Column:
    column = F.col(c) if isinstance(c, str) else c
    return text.fold(text.strip(text.collapse_spaces(F.coalesce(column, F.lit("")))))


def digest(key: Column) -> Column:
    """What is shuffled, sorted and joined in place of a key that may be a whole text."""
    return F.sha2(key, 256)


def first_per_key(df: DataFrame, key: Column, order: Sequence[Column | str]) -> DataFrame:
    """The first row of every key in the given order."""
    window = Window.partitionBy("_key").orderBy(*order)
    return (df.withColumn("_key", digest(key))
              .withColumn("_rank", F.row_number().over(window))
              .filter("_rank = 1")
              .drop("_key", "_rank"))


def drop_known(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key does not occur in earlier output.

    Both sides should hold a key once (``df`` from :func:`first_per_key`); the known
    side is reduced here, with partial aggregation, so that a repeated key cannot
    pile up in one task. Spark chooses the join by size.
    """
    return df.join(known.select(key).distinct(), key, "left_anti")
