"""A run that generates training examples: instructions, attempts, stop rule, output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rescuelens import lexicons as lx
from rescuelens import session
from rescuelens.operators import chat, synthetic
from rescuelens.sources import writers


def instructions(template: str, system_prompt: str) -> F.Column:
    """What the generator is told: its template with the labeller's prompt in every slot."""
    return chat.fill_prompt(template, system_prompt)


def run_generation(attempts: DataFrame, output: str, attempt_col: str = "attempt", raw_col: str = "raw",
                   target: int = lx.SYNTHETIC_TARGET, per_sample: int = lx.ATTEMPTS_PER_SAMPLE) -> DataFrame:
    """Writes the accepted examples as JSON lines, in attempt order; returns accepted and calls.

    The run is over with ``target`` examples or after ``per_sample`` times as many attempts. That is
    the stop rule of a run that pays for each attempt, so the output is bounded by the target.
    """
    spark = attempts.sparkSession
    staging = session.fresh_path(spark, "accepted")
    accepted = synthetic.accept(attempts, attempt_col, raw_col, target, per_sample)
    accepted.select(attempt_col, raw_col).write.parquet(staging)
    kept = spark.read.parquet(staging)
    # a line break in valid JSON stands between tokens
    line = F.translate(raw_col, "\r\n", "  ")
    kept.repartitionByRange(attempt_col).sortWithinPartitions(attempt_col).select(line.alias("value")).write.mode(
        "overwrite").option("extension", "jsonl").text(output)
    totals = synthetic.attempt_totals(attempts, attempt_col, raw_col, target, per_sample)
    result = spark.createDataFrame(totals.collect(), totals.schema)
    session.remove(spark, staging)
    return result
