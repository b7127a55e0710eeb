"""The post filter over a stream.

The filter itself is stateless and shares its expressions with the batch plans. For
deduplication there are two ways:

* :func:`distinct_posts` keeps the seen keys in the state store. First means first to
  arrive. A watermark on the date, or on the time of arrival, bounds what is kept.
* :func:`append_batch` is for ``foreachBatch``: it deduplicates each micro-batch like a
  batch and drops keys the output already holds. Order inside a batch is exact, and a key
  repeated all over the input is reduced before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQueryListener

from rescuelens.functions import signals as sg
from rescuelens.operators import dedup, masks


def help_stream(posts: DataFrame, text_col: str, rules: sg.SignalRules = sg.EVENT_RULES,
                mode: str = "balanced", allow_retweets: bool = True) -> DataFrame:
    """Matching posts with audit flags, and counters named ``funnel`` in the progress."""
    seen = posts.observe("read", F.count(F.lit(1)).alias("rows"))
    kept = masks.keep_help_posts(seen, text_col, rules, mode, allow_retweets)
    flagged = sg.without_signals(masks.audit_flags(kept, rules))
    return flagged.observe("kept", F.count(F.lit(1)).alias("rows"))


def distinct_posts(posts: DataFrame, key: Column, date_col: str | None = None,
                   delay: str = "1 day", keep: str | None = "30 days") -> DataFrame:
    """First post to arrive per key.

    With a date, a key is forgotten ``delay`` after its post's date; without one, ``keep`` after it
    has come, or never. A key goes to the state at most once per task and batch, so one that a third
    of the posts have is no single task's load.
    """
    keyed = _first_in_task(posts.withColumn("_key", dedup.digest(key)), "_key")
    if date_col is not None:
        keyed = keyed.withWatermark(date_col, delay)
    elif keep is not None:
        keyed = keyed.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", keep)
    else:
        return keyed.dropDuplicates(["_key"]).drop("_key")
    return keyed.dropDuplicatesWithinWatermark(["_key"]).drop("_key", "_arrived")


def _first_in_task(df: DataFrame, key: str) -> DataFrame:
    """First row per key of every task. A task holds the keys of its own rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for batch in batches:
            new = []
            for k in batch.column(key).to_pylist():
                new.append(k not in seen)
                seen.add(k)
            yield batch.filter(pa.array(new, pa.bool_()))
    return df.mapInArrow(run, df.schema)


def append_batch(path: str, key: Column, order: Sequence[str]
                 ) -> Callable[[DataFrame, int], None]:
    """Handler for ``foreachBatch`` that appends the new keys of a batch to a table.

    Each batch owns a folder, replaced as a whole, so a batch that runs again after a
    failure leaves no second copy.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        first = dedup.first_per_key(batch, key, order).withColumn("_key", dedup.digest(key))
        known = _earlier_keys(batch, path, batch_id)
        if known is not None:
            first = dedup.drop_known(first, known, "_key")
        first.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return handle


def count_batch(path: str, text_col: str, rules: sg.SignalRules = sg.EVENT_RULES,
                mode: str = "balanced", allow_retweets: bool = True) -> Callable[[DataFrame, int], None]:
    """Handler for ``foreachBatch`` that writes the rows read and kept of a batch to a table.

    The progress of a stream is forgotten after 100 batches; the table holds all of them. Each
    batch owns a folder, so a batch that runs again counts once.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        counts = read_and_kept(batch, text_col, rules, mode, allow_retweets)
        counts.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return handle


def read_and_kept(posts: DataFrame, text_col: str, rules: sg.SignalRules = sg.EVENT_RULES,
                  mode: str = "balanced", allow_retweets: bool = True) -> DataFrame:
    """(rows_read, rows_kept), in one pass and as part of the data: a task that runs again counts once."""
    judged = sg.with_signals(posts, text_col, rules).select(
        masks.help_mask(rules, mode, allow_retweets).alias("kept"))
    return judged.agg(F.count(F.lit(1)).alias("rows_read"), F.count_if("kept").alias("rows_kept"))


class FunnelCounts(StreamingQueryListener):
    """Writes the counters of :func:`help_stream` to a table as the batches end.

    The stream that writes the posts counts them as well, so nothing is read twice. The table is read
    with :func:`counted`. A batch that runs again replaces its row.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        rows = {name: row["rows"] for name, row in progress.observedMetrics.items() if name in ("read", "kept")}
        if len(rows) == 2:
            (self.spark.range(1).select(F.lit(rows["read"]).cast("long").alias("rows_read"),
                                        F.lit(rows["kept"]).cast("long").alias("rows_kept"))
             .write.mode("overwrite").parquet(f"{self.path}/batch={progress.batchId}"))

    def onQueryTerminated(self, event) -> None:
        pass


def counted(spark: SparkSession, path: str) -> DataFrame:
    """(rows_read, rows_kept) over all batches that ``count_batch`` wrote; 0 without any."""
    table = spark.createDataFrame([(0, 0)], "rows_read long, rows_kept long")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        table = table.unionByName(spark.read.schema(table.schema).parquet(path).select(table.columns))
    return table.agg(F.sum("rows_read").alias("rows_read"), F.sum("rows_kept").alias("rows_kept"))


def _earlier_keys(batch: DataFrame, path: str, batch_id: int) -> DataFrame | None:
    if batch_id == 0:
        return None
    table = batch.sparkSession.read.schema("_key string, batch bigint").option(
        "basePath", path).parquet(path)
    return table.filter(F.col("batch") < batch_id).select("_key")


def start_append(posts: DataFrame, path: str, checkpoint: str, key: Column,
                 order: Sequence[str]) -> DataStreamWriter:
    """Writer for all input that is there now; start it to run."""
    return (posts.writeStream.foreachBatch(append_batch(path, key, order))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True))
