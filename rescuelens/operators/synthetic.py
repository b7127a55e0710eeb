"""Checking and accepting generated training examples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rescuelens.functions import text
from rescuelens.operators import dedup

_ROLE_ORDER = ("system", "user", "assistant")


def validated(df: DataFrame, raw_col: str) -> DataFrame:
    """Add ``reason`` (null if the example is acceptable), ``user_content``, ``strict``.

    Reasons, first that applies: ``empty``, ``not_json``, ``not_object``, ``messages``
    (no list of exactly three) and ``user_content`` (not a string). ``strict`` adds the
    generator's own contract: roles system, user, assistant in order and no other key.
    """
    raw = F.coalesce(F.col(raw_col), F.lit(""))
    listed = F.concat(F.lit("["), raw, F.lit("]"))
    df = text.evaluate_once(df, "_parsed", F.when(
        F.json_array_length(listed) == 1, F.try_parse_json(raw)))
    df = text.evaluate_once(df, "_kind", F.schema_of_variant("_parsed"))
    messages = F.try_variant_get("_parsed", "$.messages", "array<variant>")
    kind = lambda path: F.schema_of_variant(F.try_variant_get("_parsed", path, "variant"))
    user = F.try_variant_get("_parsed", "$.messages[1].content", "string")
    roles = F.array(*[F.coalesce(F.try_variant_get("_parsed", f"$.messages[{i}].role", "string"),
                                 F.lit("")) for i in range(3)])
    reason = (F.when(raw == "", "empty")
              .when(F.col("_parsed").isNull(), "not_json")
              .when(~F.col("_kind").startswith("OBJECT"), "not_object")
              .when(~F.coalesce(kind("$.messages").startswith("ARRAY"), F.lit(False))
                    | (F.coalesce(F.size(messages), F.lit(0)) != 3), "messages")
              .when(~F.coalesce(kind("$.messages[1].content") == "STRING", F.lit(False)),
                    "user_content"))
    df = df.withColumn("reason", reason)
    acceptable = F.col("reason").isNull()
    only_messages = F.json_object_keys(raw) == F.array(F.lit("messages"))
    in_order = roles == F.array(*map(F.lit, _ROLE_ORDER))
    return df.withColumns({
        "user_content": F.when(acceptable, user),
        "strict": acceptable & in_order & F.coalesce(only_messages, F.lit(False)),
    }).drop("_parsed", "_kind")


def accept(df: DataFrame, attempt_col: str, raw_col: str, target: int | None = None,
           attempts_per_sample: int | None = None) -> DataFrame:
    """Acceptable examples with a new user text, first attempt first.

    Over a table nothing is left out. A run that pays for each attempt stops at ``target``
    examples, or at ``attempts_per_sample`` times as many attempts (numbered from one); with a
    target the result is a top-k in attempt order, not a sort of the table.
    """
    made = _made(df, attempt_col, target, attempts_per_sample)
    good = validated(made, raw_col).filter(F.col("reason").isNull())
    unique = dedup.first_per_key(good, F.sha2(F.col("user_content"), 256), [attempt_col]).drop("reason")
    return unique if target is None else unique.orderBy(attempt_col).limit(target)


def _made(df: DataFrame, attempt_col: str, target: int | None, attempts_per_sample: int | None) -> DataFrame:
    if target is None or attempts_per_sample is None:
        return df
    return df.filter(F.col(attempt_col) <= target * attempts_per_sample)


def attempt_totals(df: DataFrame, attempt_col: str, raw_col: str, target: int | None = None,
                   attempts_per_sample: int | None = None) -> DataFrame:
    """Accepted examples, and the calls spent until the target or the cap was reached."""
    accepted = accept(df, attempt_col, raw_col, target, attempts_per_sample).agg(
        F.count("*").alias("accepted"), F.max(attempt_col).alias("_last"))
    made = _made(df, attempt_col, target, attempts_per_sample).agg(F.count("*").alias("_made"))
    reached = F.lit(False) if target is None else F.col("accepted") == target
    return accepted.withColumn("_made", made.scalar()).select(
        "accepted", F.when(reached, F.col("_last")).otherwise(F.col("_made")).alias("calls"))
