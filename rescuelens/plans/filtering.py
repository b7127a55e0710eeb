"""From raw posts to the filtered table with audit flags, for each corpus."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rescuelens import session
from rescuelens.functions import signals as sg
from rescuelens.operators import dedup, funnel, masks
from rescuelens.sources import readers, writers


def help_posts(df: DataFrame, id_col: str, text_col: str, order: Sequence[str],
               rules: sg.SignalRules = sg.EVENT_RULES, mode: str = "balanced",
               allow_retweets: bool = True) -> DataFrame:
    """Filter, first-wins deduplication, flags. The only shuffle is on the dedup key.

    The order matters: the filter comes before the deduplication, because a post that
    fails it must not take the place of a later one with the same key.
    """
    kept = masks.keep_help_posts(df, text_col, rules, mode, allow_retweets).drop(sg.FOLDED)
    first = dedup.first_per_key(kept, dedup.id_or_text_key(id_col, text_col), order)
    return masks.audit_flags(first, rules).drop(sg.PHRASES)


def tagged_stages(df: DataFrame, start=None, end=None) -> dict[str, Column]:
    """Language and time tests of the tagged corpus; cheap, so ahead of the text search."""
    date = "date" if "date" in df.columns else None
    return {"after_language": masks.in_languages("language"), "after_time": masks.in_window(date, start, end)}


def _tagged_signals(df: DataFrame, text: Column, rules: sg.SignalRules) -> tuple[DataFrame, Column, str | None]:
    position = "coordinates" if "coordinates" in df.columns else None
    return (sg.with_signals(df.withColumn("_text", text), "_text", rules),
            masks.tagged_help_mask(position, rules), position)


def _tagged_text(df: DataFrame) -> Column:
    return masks.combined_text("content", "hashtags" if "hashtags" in df.columns else None)


def tagged_matches(df: DataFrame, start=None, end=None, rules: sg.SignalRules = sg.TAGGED_RULES) -> DataFrame:
    """Posts of the tagged corpus that pass its tests, with flags and their ``_text``. Needs no shuffle."""
    tests = tagged_stages(df, start, end)
    posts, mask, position = _tagged_signals(
        df.filter(tests["after_language"] & tests["after_time"]), _tagged_text(df), rules)
    return sg.without_signals(masks.tagged_audit_flags(posts.filter(mask), position, rules))


def tagged_help_posts(df: DataFrame, order: Sequence[str], start=None, end=None,
                      rules: sg.SignalRules = sg.TAGGED_RULES) -> DataFrame:
    """Strict mask, then text of content and hashtags as key of the deduplication."""
    return _first_tagged(tagged_matches(df, start, end, rules), order)


def _first_tagged(matches: DataFrame, order: Sequence[str]) -> DataFrame:
    return dedup.first_per_key(matches, dedup.text_key("_text"), order).drop("_text")


def tagged_funnel(df: DataFrame, start=None, end=None, rules: sg.SignalRules = sg.TAGGED_RULES) -> DataFrame:
    """Rows read, left after language and time, and kept, as one row from one pass."""
    tests = tagged_stages(df, start, end)
    # texts of rows that are out already are not searched
    passed = tests["after_language"] & tests["after_time"]
    posts, mask, _ = _tagged_signals(df, F.when(passed, _tagged_text(df)), rules)
    key = F.when(passed & mask, dedup.digest(dedup.text_key("_text")))
    return posts.withColumn("_key", key).agg(*funnel.stage_columns(tests), F.count_distinct("_key").alias("kept"))


@dataclass(frozen=True)
class Corpus:
    """How one TSV corpus is read and judged."""

    columns: tuple[str, ...]
    required: tuple[str, ...]
    id_col: str
    text_col: str
    recursive: bool
    rules: sg.SignalRules


EVENT = Corpus(readers.EVENT_COLUMNS, readers.EVENT_COLUMNS, "tweet_id", "tweet_text", True,
               sg.EVENT_RULES)
CRISIS = Corpus(readers.CRISIS_COLUMNS, readers.CRISIS_REQUIRED, "id", "text", False,
                sg.CRISIS_RULES)


def run_filter(spark: SparkSession, corpus: Corpus, path, output: str, mode: str = "balanced",
               allow_retweets: bool = True) -> DataFrame:
    """Filter a TSV corpus into CSV; returns files scanned, files with matches, rows kept.

    The kept rows go to a staging table in the shared folder first, so that the costly
    text search runs once although both the output and the counts read its result.
    """
    posts = readers.read_tsv(spark, path, corpus.columns, corpus.required, corpus.recursive,
                             order=True)
    kept = help_posts(posts, corpus.id_col, corpus.text_col, readers.SCAN_ORDER, corpus.rules,
                      mode, allow_retweets)
    staging = session.fresh_path(spark, "kept")
    kept.write.parquet(staging)
    kept = spark.read.schema(kept.schema).parquet(staging)
    writers.write_csv(kept.drop(*readers.SCAN_ORDER), output)
    files = readers.list_files(spark, path, "*.tsv", corpus.recursive).select(
        readers.path_order(F.col("_path")).alias("_path"))
    # the listing says file:/x where the scan says file:///x
    named = lambda df: df.withColumn("_path", F.array_join(
        F.filter("_path", lambda part: part != ""), "/"))
    totals = funnel.run_totals(funnel.kept_per_file(named(files), named(kept), "_path"))
    # one row; the staging table has served its purpose
    result = spark.createDataFrame(totals.collect(), totals.schema)
    session.remove(spark, staging)
    return result


TAGGED_COUNTS = ("rows_read", "after_language", "after_time")


def run_tagged_filter(spark: SparkSession, path, output: str, start=None, end=None) -> DataFrame:
    """Filter the tagged corpus from CSV into CSV; returns rows read, after language, after
    time, and kept.

    The posts are read once. Their matches go to a staging table, before the deduplication: that job
    has no shuffle, so the counts taken on the way have every row once, whatever is lost and run again.
    """
    posts = readers.read_tagged_posts(spark, path, order=True)
    seen = Observation()
    counted = posts.observe(seen, *funnel.stage_columns(tagged_stages(posts, start, end)))
    matches = tagged_matches(counted, start, end)
    staging = session.fresh_path(spark, "matches")
    matches.write.parquet(staging)
    counts = seen.get
    staged = spark.read.schema(matches.schema).parquet(staging)
    kept = Observation()
    first = _first_tagged(staged, readers.SCAN_ORDER).drop(*readers.SCAN_ORDER)
    writers.write_csv(first.observe(kept, F.count(F.lit(1)).alias("kept")), output)
    result = spark.createDataFrame([tuple(int(counts[n]) for n in TAGGED_COUNTS) + (int(kept.get["kept"]),)],
                                   ", ".join(f"{n} long" for n in (*TAGGED_COUNTS, "kept")))
    session.remove(spark, staging)
    return result
