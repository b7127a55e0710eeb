"""From raw model answers to checked and repaired labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rescuelens.functions import text
from rescuelens.operators import answers


def review_answers(df: DataFrame, raw_col: str,
                   profile: answers.Profile = answers.RUNTIME) -> DataFrame:
    """Envelope, list of broken rules and repaired label of every answer.

    Answers without valid JSON keep their row; their label is null. An answer is parsed once.
    """
    found = answers.with_envelope(df, raw_col, "_value")
    judged = answers.with_violations(found, "parsed", profile, value="_value")
    labelled = text.evaluate_once(judged, "_label", answers.label_of(F.col("_value")))
    return labelled.withColumn("label", F.when(F.col("is_json"), answers.repair_label(F.col("_label")))).drop(
        "_value", "_label")
