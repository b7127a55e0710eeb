"""Connected components of a table of links, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rescuelens.llm import staging


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id in ``edges`` (a, b); component is the smallest id reached.

    Alternates two steps until nothing changes: each node links its larger neighbours to its
    smallest one, then its smaller neighbours likewise. Every step keeps the components, and
    the trees become stars after a number of rounds that grows with the logarithm of their
    size. Links are staged in the shared folder each round. A node's smallest neighbour is an
    aggregation with a partial step, so a node with very many links is no single task's load.
    """
    spark = edges.sparkSession
    links = staging.stage(edges.select("a", "b").filter("a <> b").distinct(), "links")
    before, count = None, links.count()
    while True:
        large = _star(links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            links.select(F.col("b").alias("node"), F.col("a").alias("other"))), larger=True, rows=count)
        small = _star(large.select(F.greatest("a", "b").alias("node"),
                                   F.least("a", "b").alias("other")), larger=False, rows=count)
        following = staging.stage(small.withColumn("mark", F.xxhash64("a", "b")), "links")
        state = following.agg(F.count("*"), F.coalesce(F.sum(F.col("mark").cast("decimal(38,0)")),
                                                       F.lit(0))).first()
        staging.drop(spark, links)
        links = following.select("a", "b")
        if tuple(state) == before:
            break
        before, count = tuple(state), state[0]
    members = links.select(F.greatest("a", "b").alias("id"), F.least("a", "b").alias("component"))
    return members.unionByName(links.select(F.least("a", "b").alias("id"),
                                            F.least("a", "b").alias("component"))).distinct()


def _star(pairs: DataFrame, larger: bool, rows: int) -> DataFrame:
    """Links every (larger or smaller) neighbour of a node, and the node, to its smallest."""
    least = pairs.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("least"))
    joined = pairs.join(staging.side(least, rows), "node")
    if larger:
        out = joined.filter("other > node").select(F.col("other").alias("a"), F.col("least").alias("b"))
    else:
        out = joined.select(F.col("other").alias("a"), F.col("least").alias("b")).unionByName(
            least.select(F.col("node").alias("a"), F.col("least").alias("b")))
    return out.filter("a <> b").select(F.greatest("a", "b").alias("a"),
                                       F.least("a", "b").alias("b")).distinct()
