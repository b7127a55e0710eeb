"""Train, validation and test sets that keep near-copy clusters together.

Clusters are put in the order of a seeded hash. Instead of ranking them in one sorted
list and joining the ranks back, the hash values at the two cut positions are found,
and every row compares its own hash with them. Rows are not shuffled at all, so a
cluster that holds a third of them does no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: hex digits of the hash that number a bucket: 16**4 buckets
BUCKET_DIGITS = 4


def _order_hash(cluster_col: str, seed: int) -> Column:
    # Never null: a not-null test on one of the two reads of the cluster list would keep
    # them from sharing one exchange.
    return F.sha1(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(cluster_col), F.lit(""))))


def _cuts(clusters: DataFrame, train: float, val: float) -> DataFrame:
    """One row: the hash of the last training and of the last validation cluster.

    Buckets are counted first. The running total over the bucket table (at most 65,536
    rows, whatever the data) tells in which bucket a cut lies and how many clusters
    into it, so only the two buckets with a cut are ranked.
    """
    bucket = F.substring("_hash", 1, BUCKET_DIGITS)
    counts = clusters.groupBy(bucket.alias("_bucket")).agg(F.count("*").alias("_n"))
    running = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("_n").over(everything)
    # rint rounds halves to even
    n_train = F.rint(total * train).cast("bigint")
    n_val = F.rint(total * val).cast("bigint")
    placed = counts.select(
        "_bucket", "_n", F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_before"),
        n_train.alias("_k1"), (n_train + n_val).alias("_k2"))
    holds = lambda k: (F.col(k) > F.col("_before")) & (F.col(k) <= F.col("_before") + F.col("_n"))
    cut_buckets = placed.filter(holds("_k1") | holds("_k2"))

    ranked = (clusters.withColumn("_bucket", bucket)
              .join(F.broadcast(cut_buckets), "_bucket")  # two rows at most
              .withColumn("_at", F.col("_before") + F.row_number().over(
                  Window.partitionBy("_bucket").orderBy("_hash"))))
    # no training (validation) clusters: a cut before every hash
    return ranked.agg(
        F.coalesce(F.max(F.when(F.col("_at") == F.col("_k1"), F.col("_hash"))), F.lit("")
                   ).alias("_train_cut"),
        F.coalesce(F.max(F.when(F.col("_at") == F.col("_k2"), F.col("_hash"))), F.lit("")
                   ).alias("_val_cut"))


def check_ratios(train: float, val: float, test: float) -> None:
    if round(train + val + test, 6) != 1.0:
        raise ValueError("split ratios must sum to 1.0")


def cluster_split(df: DataFrame, cluster_col: str, train: float, val: float, test: float,
                  seed: int = 42) -> DataFrame:
    """Add ``split``. Sizes count clusters: halves round to even, the rest is test.

    ``df`` is read twice; write an expensive one to a table before.
    """
    check_ratios(train, val, test)
    clusters = df.select(_order_hash(cluster_col, seed).alias("_hash")).distinct()
    cuts = _cuts(clusters, train, val).select(
        F.struct("_train_cut", "_val_cut").alias("_cuts"))
    hashed = df.withColumn("_hash", _order_hash(cluster_col, seed)).withColumn(
        "_cuts", cuts.scalar())
    return hashed.withColumn(
        "split",
        F.when(F.col("_hash") <= F.col("_cuts._train_cut"), "train")
         .when(F.col("_hash") <= F.col("_cuts._val_cut"), "val")
         .otherwise("test")).drop("_hash", "_cuts")


def split_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("n"))


def cluster_sizes(df: DataFrame, cluster_col: str) -> DataFrame:
    return df.groupBy(cluster_col).agg(F.count("*").alias("n"))
