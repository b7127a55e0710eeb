"""From filtered posts to labelled training pairs and from transcripts to training text."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rescuelens import session
from rescuelens.operators import chat, labels, splits
from rescuelens.sources import columns, writers

SETS = ("train", "val", "test")


def training_pairs(df: DataFrame, text_col: str | None = None, max_rows: int | None = None,
                   order: tuple[str, ...] = ()) -> DataFrame:
    """Pairs of post and label. ``max_rows`` takes the first rows in the given order."""
    text_col = columns.text_column(df, text_col)
    if max_rows is not None:
        if not order:
            raise ValueError("the first rows need an order")
        df = df.orderBy(*order).limit(max_rows)
    return labels.label_posts(df, text_col)


def write_training_pairs(pairs: DataFrame, output: str, train: float = 1.0, val: float = 0.0,
                         test: float = 0.0, seed: int = 42, arrays: bool = False, indent: bool = False
                         ) -> DataFrame:
    """Write the pairs, split by cluster unless all of them are for training.

    They are JSON lines, or JSON arrays, then one folder per set in either case. Returns the number of
    pairs per set. Splitting reads its input twice, so labelled pairs go to a staging table in the
    shared folder first.
    """
    splits.check_ratios(train, val, test)
    spark = pairs.sparkSession
    if val == 0.0 and test == 0.0:
        if arrays:
            kept = Observation()
            writers.write_json_array(pairs.drop("_cluster").observe(kept, F.count(F.lit(1)).alias("n")), output, indent)
            return spark.createDataFrame([("train", int(kept.get["n"]))], "split string, n long")
        writers.write_pairs(pairs, output)
        return spark.read.schema("user string").json(output).agg(F.count("*").alias("n")).select(
            F.lit("train").alias("split"), "n")
    staging = session.fresh_path(spark, "pairs")
    pairs.write.parquet(staging)
    staged = spark.read.schema(pairs.schema).parquet(staging)
    split = splits.cluster_split(staged, "_cluster", train, val, test, seed)
    if arrays:
        sizes = splits.split_sizes(split)
        sizes = spark.createDataFrame(sizes.collect(), sizes.schema)
        writers.write_json_sets(split.drop("_cluster"), output, "split", SETS, indent)
        session.remove(spark, staging)
        return sizes
    writers.write_pairs(split, output, "split")
    session.remove(spark, staging)
    return splits.split_sizes(spark.read.schema("user string, split string").json(output))


def training_texts(turns: DataFrame, conv_col: str, turn_col: str, role_col: str,
                   text_col: str, turn_template: str | None = None) -> DataFrame:
    """One training text per conversation: first system, user and assistant message."""
    first = chat.first_by_role(turns, conv_col, turn_col, role_col, text_col)
    parts = [F.col(f"{r}_text") for r in chat.ROLES]
    whole = (chat.plain_training_text(*parts) if turn_template is None
             else chat.render(chat.training_messages(*parts), turn_template))
    return first.select(conv_col, whole.alias("text"))


def message_texts(conversations: DataFrame, turn_template: str | None = None) -> DataFrame:
    """Same for a table with a ``messages`` array; only the text is kept."""
    parts = [chat.first_in_messages(F.col("messages"), r) for r in chat.ROLES]
    whole = (chat.plain_training_text(*parts) if turn_template is None
             else chat.render(chat.training_messages(*parts), turn_template))
    return conversations.select(whole.alias("text"))
