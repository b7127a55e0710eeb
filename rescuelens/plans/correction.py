"""Records sent to a model that corrects them, and its answers put back in their place."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rescuelens import session
from rescuelens.operators import answers, chat
from rescuelens.sources import readers, writers

NO_ANSWER = "no_answer"

#: from requests (record_key, messages) to answers (record_key, raw_text)
Model = Callable[[DataFrame], DataFrame]


def record_key(record: Column) -> Column:
    """Equal records have one key, so a model is asked about each of them once."""
    return F.sha2(record, 256)


def requests(records: DataFrame, system_prompt: str) -> DataFrame:
    """(record_key, messages) of the different records in a column ``record`` of JSON texts."""
    keyed = records.groupBy(record_key(F.col("record")).alias("record_key")).agg(F.any_value("record").alias("record"))
    return keyed.select("record_key", F.array(chat.message("system", F.lit(system_prompt)),
                                              chat.message("user", F.col("record"))).alias("messages"))


def joined(records: DataFrame, replies: DataFrame) -> DataFrame:
    """Every record with its answer (``corrected``, a JSON object as text) or why there is none (``error``).

    Of several answers to one record the first that is valid counts, by its text.
    """
    judged = answers.with_envelope(replies.select("record_key", "raw_text"), "raw_text")
    best = judged.groupBy(F.col("record_key").alias("key")).agg(
        F.min("parsed").alias("corrected"), F.min("error").alias("error"))
    key = record_key(F.col("record"))
    out = records.withColumn("key", key).join(best, "key", "left")
    error = F.when(F.col("corrected").isNull(), F.coalesce("error", F.lit(NO_ANSWER)))
    return out.select("record", "corrected", error.alias("error"))


def run_correction(spark: SparkSession, path: str, model: Model, system_prompt: str, output: str,
                   schema: str = readers.PAIR_DDL) -> DataFrame:
    """Corrects the records of JSON arrays into JSON arrays under ``output/corrected``.

    A record without a valid answer does not end the run: it is written with the reason, as JSON
    lines, under ``output/failed``, and can be sent again. The answers cost money, so they are staged
    in the shared folder before anything else is done with them. Returns records and failures.
    """
    records = readers.read_json_array(spark, path, schema).select(chat.record_json(F.struct("*")).alias("record"))
    staging = [session.fresh_path(spark, n) for n in ("answers", "joined")]
    model(requests(records, system_prompt)).select("record_key", "raw_text").write.parquet(staging[0])
    replies = spark.read.schema("record_key string, raw_text string").parquet(staging[0])
    joined(records, replies).write.parquet(staging[1])
    done = spark.read.schema("record string, corrected string, error string").parquet(staging[1])
    writers.write_json_texts(done.filter("error IS NULL").select("corrected"), f"{output}/corrected")
    writers.write_jsonl(done.filter("error IS NOT NULL").select("record", "error"), f"{output}/failed")
    counts = done.agg(F.count(F.lit(1)).alias("records"), F.count("error").alias("failed"))
    result = spark.createDataFrame(counts.collect(), counts.schema)
    session.remove(spark, *staging)
    return result
