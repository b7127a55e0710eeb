"""Line dedup: the first document of every line keeps it, others get a bitmap without it.

DataFrame functions only. A line's key is the line without blanks at its ends and with A-Z
lowered; keys shorter than ``least_chars`` are never dropped. Keys travel as two 64-bit hashes.
They are dealt out by ranges of the hash, sorted by (hash, document, position), and the first
document of each hash is carried along the sorted rows. So that a line of a third of all
documents is no single task's load, ranges are salted by the document: each of ``salts`` shares
of a hash finds its first document, and only rows of those first documents meet in a second
step, at most ``salts`` documents per hash. Texts are split and hashed once.

The result holds no text: per document the number of lines, the number dropped, and the keep
bitmap compressed to run lengths, kept lines first (``[3, 2, 4]``: keep 3, drop 2, keep 4).
``kept_text`` applies it.

A null or empty text is one empty line. Document ids are assumed to be distinct; equal rows with
one id are one document and lose the same lines. Rows without an id keep all their lines and drop
none elsewhere. Extra columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rescuelens.llm import staging

LEAST_CHARS = 10
SALTS = 16
BLANKS = " \t\n\x0b\x0c\r"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), string.ascii_uppercase, string.ascii_lowercase)


def _first_document(rows: DataFrame, *keys: str) -> DataFrame:
    """Adds ``first_doc``: the smallest document of the key, streamed along its sorted rows."""
    order = W.partitionBy(*keys).orderBy("doc_id", "pos").rowsBetween(W.unboundedPreceding, 0)
    return rows.withColumn("first_doc", F.first("doc_id").over(order))


def dropped_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, salts: int = SALTS) -> DataFrame:
    """(doc_id, pos) of every line whose key an earlier document holds."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    keyed = (lines.filter((F.length("line") >= least_chars) & F.col("doc_id").isNotNull())
             .select("doc_id", "pos", line_key(F.col("line")).alias("key"))
             .filter(F.length("key") >= least_chars)
             .select("doc_id", "pos", F.xxhash64("key").alias("h1"),
                     # the seed comes first: after the key it would only hash h1 again
                     F.xxhash64(F.lit(1), "key").alias("h2"),
                     F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("salt")))
    # hashes are even, so equal ranges need no sample; a salt shifts the ranges
    range_id = F.pmod(F.shiftright("h1", 40) * parts / F.lit(1 << 24) + F.col("salt") * parts / salts,
                      F.lit(float(parts))).cast("int")
    shares = _first_document(keyed.withColumn("range_id", range_id).repartitionById(parts, "range_id"),
                             "range_id", "h1", "h2", "salt")
    # rows that are dropped already go along, dealt evenly: a second branch would read the texts again
    later = F.col("doc_id") != F.col("first_doc")
    firsts = shares.select("doc_id", "pos", later.alias("later"),
                           F.when(later, F.xxhash64("doc_id", "pos")).otherwise(F.col("h1")).alias("h1"),
                           F.when(later, F.lit(0)).otherwise(F.col("h2")).alias("h2"))
    return _first_document(firsts, "later", "h1", "h2").filter("later OR doc_id <> first_doc").select("doc_id", "pos")


def _run_lengths(dropped: Column, n_lines: Column) -> Column:
    """Run lengths, kept lines first, from the sorted positions of dropped lines.

    Arrays are combined element by element, so the work is in proportion to their length.
    """
    starts = F.filter(dropped, lambda p, i: (i == 0) | (F.get(dropped, i - 1) < p - 1))
    ends = F.filter(dropped, lambda p, i: (i == F.size(dropped) - 1) | (F.get(dropped, i + 1) > p + 1))
    runs = F.zip_with(F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
                      F.concat(F.array(F.lit(-1)), ends),
                      lambda run, before: F.when(run.isNull(), F.array(n_lines - 1 - before)).otherwise(
                          F.array(run["a"] - before - 1, run["b"] - run["a"] + 1)))
    return F.flatten(runs)


def keep_bitmaps(docs: DataFrame, least_chars: int = LEAST_CHARS, salts: int = SALTS) -> DataFrame:
    """(doc_id, dropped): documents that lose lines, with the sorted positions they lose."""
    return dropped_lines(docs, least_chars, salts).groupBy("doc_id").agg(
        F.array_sort(F.collect_set("pos")).alias("dropped"))


def with_bitmaps(docs: DataFrame, least_chars: int = LEAST_CHARS, salts: int = SALTS) -> DataFrame:
    """``docs`` with line_n, line_dropped and line_runs (the compressed keep bitmap)."""
    of, dropped = (staging.unused_name(docs, n) for n in ("line_doc", "dropped"))
    lost = keep_bitmaps(docs, least_chars, salts).withColumnsRenamed({"doc_id": of, "dropped": dropped})
    joined = docs.join(lost.hint("shuffle_hash"), F.col("doc_id").cast("long") == F.col(of), "left")
    n_lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    n_lines = F.coalesce(n_lines, F.lit(1))
    return joined.withColumns({
        "line_n": n_lines.cast("long"),
        "line_dropped": F.coalesce(F.size(dropped), F.lit(0)).cast("long"),
        "line_runs": F.when(F.col(dropped).isNull(), F.array(n_lines)).otherwise(
            _run_lengths(F.col(dropped), n_lines))}).drop(of, dropped)


def kept_text(text: Column, runs: Column) -> Column:
    """The text of the kept lines."""
    keep = F.flatten(F.transform(runs, lambda n, i: F.array_repeat(i % 2 == 0, n)))
    marked = F.zip_with(lines_of(text), keep, lambda line, k: F.when(k, line))
    return F.when(F.size(runs) == 1, F.coalesce(text, F.lit(""))).otherwise(
        F.array_join(marked, "\n"))


def without_repeats(docs: DataFrame, least_chars: int = LEAST_CHARS, salts: int = SALTS) -> DataFrame:
    """``docs`` with the kept text in place of the text, and ``n_chars`` set after it.

    Documents that lost lines go if nothing but blanks is left: all they held is in earlier documents.
    """
    row = docs.select(F.struct("*").alias("row"), "doc_id", "text")
    marked = with_bitmaps(row, least_chars, salts).select(
        "row", "line_dropped", kept_text(F.col("text"), F.col("line_runs")).alias("kept"))
    some = F.exists(lines_of(F.col("kept")), lambda line: line_key(line) != "")
    kept = marked.filter((F.col("line_dropped") == 0) | some)
    changed = F.col("line_dropped") > 0
    new = {"text": F.when(changed, F.col("kept")).otherwise(F.col("row.text")),
           "n_chars": F.when(changed, F.length("kept")).otherwise(F.col("row.n_chars"))
           if "n_chars" in docs.columns else None}
    return kept.select(*[(new[c].cast(docs.schema[c].dataType) if c in new else F.col("row")[c]).alias(c)
                         for c in docs.columns])
