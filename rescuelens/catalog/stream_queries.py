"""Catalogue: the post filter and deduplication over a stream of files.

Posts are written to the shared folder, streamed from there until all are read, and the sink is
read back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from rescuelens import session
from rescuelens.catalog import sql
from rescuelens.catalog.filter_queries import ID_KEY
from rescuelens.catalog.relations import POSTS_SQL, posts, table
from rescuelens.operators import dedup, masks
from rescuelens.streaming import posts as streaming

#: part of the time the events cover
WINDOW = ("2024-01-10 00:00:00", "2024-01-20 12:00:00")


def _streamed(spark, sf_dir):
    folder = session.fresh_path(spark, "stream")
    df = posts(spark, sf_dir)
    df.write.parquet(folder)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 4).parquet(folder)


def _run(spark, df):
    """Runs a stream into a new table and returns it."""
    output = session.fresh_path(spark, "sink")
    query = (df.writeStream.format("parquet").option("path", output)
             .option("checkpointLocation", session.fresh_path(spark, "progress"))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(output)


def stream_filter(spark, sf_dir):
    flagged = streaming.help_stream(_streamed(spark, sf_dir), "post_text")
    return _run(spark, flagged.select("seq", "post_id", "_sos", "_flood", "_need", "_haz"))


def stream_counters(spark, sf_dir):
    """Rows read and kept, added up over the batches."""
    output = session.fresh_path(spark, "sink")
    (_streamed(spark, sf_dir).writeStream.foreachBatch(streaming.count_batch(output, "post_text"))
     .option("checkpointLocation", session.fresh_path(spark, "progress"))
     .trigger(availableNow=True).start().awaitTermination())
    return streaming.counted(spark, output)


def stream_distinct(spark, sf_dir):
    """One post per key; which one depends on the order of arrival."""
    key = dedup.id_or_text_key("post_id", "post_text")
    return _run(spark, streaming.distinct_posts(_streamed(spark, sf_dir), key).select(
        dedup.digest(key).alias("key")))


def stream_event_time(spark, sf_dir):
    """First event per user and kind within a window of real event times, over a stream with a watermark."""
    folder = session.fresh_path(spark, "events")
    # a watermark wants an instant; times without a zone are UTC here
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")).filter(
        masks.in_window("ts", *WINDOW))
    events.repartitionByRange(4, "ts").write.parquet(folder)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    key = F.concat_ws(":", F.col("user_id").cast("string"), "event_type")
    # the delay covers the window, so files may come in any order
    return _run(spark, streaming.distinct_posts(stream, key, "ts", "31 days").select(key.alias("key")))


def stream_append(spark, sf_dir):
    output = session.fresh_path(spark, "sink")
    key = dedup.id_or_text_key("post_id", "post_text")
    streaming.start_append(_streamed(spark, sf_dir), output, session.fresh_path(spark, "progress"),
                           key, ["seq"]).start().awaitTermination()
    return spark.read.parquet(output).select(F.col("_key").alias("key"))


QUERIES = {"stream_filter": stream_filter, "stream_counters": stream_counters,
           "stream_distinct": stream_distinct, "stream_event_time": stream_event_time,
           "stream_append": stream_append}

_KEYS = f"WITH {POSTS_SQL} SELECT DISTINCT sha256({ID_KEY}) AS key FROM posts"

ORACLES = {
    "stream_filter": f"""WITH {sql.signals("event")} SELECT seq, post_id, sos AS _sos, flood AS _flood,
        need AS _need, hazard AS _haz FROM sig WHERE {sql.kept("balanced")}""",
    "stream_counters": f"""WITH {sql.signals("event")} SELECT count(*) AS rows_read,
        count(*) FILTER ({sql.kept("balanced")}) AS rows_kept FROM sig""",
    "stream_distinct": _KEYS, "stream_append": _KEYS,
    "stream_event_time": f"""SELECT DISTINCT CAST(user_id AS VARCHAR) || ':' || event_type AS key FROM events
        WHERE ts BETWEEN TIMESTAMP '{WINDOW[0]}' AND TIMESTAMP '{WINDOW[1]}'""",
}
