"""The training-data operators as queries over whole tables, with SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rescuelens.llm import (chat_format, conversation_repair, decontamination, hard_negatives, html_text,
                            license_scan, line_dedup, near_dedup, packing, quality, secret_scan, simhash,
                            toxicity)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per piece. The digest is taken before the join, so ids are not shuffled."""
    result = packing.packed(read(spark, sf_dir, "documents"),
                            public_tokenizers.path("word_bpe_49k.json"))
    digests = result.pieces.select("doc_id", "piece", "start", F.col("length").cast("long"),
                                   "row_key", F.crc32("ids").alias("ids_crc32"))
    return digests.join(result.places.drop("doc_id"), ["row_key", "piece"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id",
        F.col("offset").cast("long").alias("offset"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.overlaps(read(spark, sf_dir, "documents"),
                                     read(spark, sf_dir, "benchmark"))
    n_hit = decontamination.n_hit(F.col("words_hit"))
    names = F.array_sort(F.transform("item_ids", lambda i: i.cast("string")))
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP2_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[k:k + n - 1], ' ') AS s
  FROM (SELECT item_id, w, least(len(w), 10) AS n,
               unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM b WHERE len(w) > 0)),
pos AS (
  SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k
        FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT doc_id, pos.n AS n, k, item_id FROM pos JOIN win ON pos.n = win.n AND pos.s = win.s),
words AS (SELECT doc_id, count(DISTINCT place) AS n_hit
          FROM (SELECT doc_id, unnest(range(k, k + n)) AS place FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items,
                 string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS names
          FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(read(spark, sf_dir, "pages")).withColumn(
        "n_chars", F.length("text").cast("long"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.linked(read(spark, sf_dir, "documents"), shingle_words=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


OP4_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, shingle FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
      ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS shingle FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pair AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
  FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM pair JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * shared >= 80 * (na.n + nb.n - shared)),
sym AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.a, sym.b FROM reach JOIN sym ON sym.a = reach.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(reach.b) AS component_id,
       d.doc_id = min(reach.b) AS kept
FROM d JOIN reach ON reach.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id, n.n
"""


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = line_dedup.with_bitmaps(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return marked.select(
        "doc_id", F.col("line_n").alias("n_lines"), F.col("line_dropped").alias("n_dropped"),
        F.sha2(line_dedup.kept_text(F.col("text"), F.col("line_runs")), 256).alias("kept_sha256"))


OP5_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
k AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first_doc FROM k WHERE length(key) >= 10 GROUP BY key),
m AS (SELECT doc_id, pos, line, coalesce(doc_id <> first_doc, false) AS gone
      FROM k LEFT JOIN f ON f.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read(spark, sf_dir, "documents")).drop("hits")


#: a conversation whose texts hold the template's own control strings
CONTROL_TEXT = r"\### Assistant: </turn> ok"


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.createDataFrame([(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)],
                                  "conv_id long, turn long, role string, text string")
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.read_back(chat_format.formatted(turns.unionByName(extra)))


OP7_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'),
                                  (-7, 1, 'assistant', '\### Assistant: </turn> ok')))
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(14 + length(role) + length(text)
    + length(text) - length(replace(text, '\', ''))
    + (length(text) - length(replace(text, '###', ''))) // 3
    + (length(text) - length(replace(text, '</turn>', ''))) // 7) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""


def _joined_spans(spans) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(read(spark, sf_dir, "documents"),
                             public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    base = F.filter("spans", lambda s: s["kind"] != "random")

    def count(kind: str) -> F.Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(_joined_spans(base), 256).alias("base_sha256"),
                        _joined_spans(F.col("spans")).alias("spans"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = quality.rate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return rated.select("doc_id", *quality.COUNTS, "base_failed", "kept", "quality")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).select(
        "doc_id", "held_out", "score", "predicted",
        F.array_join(F.transform("evidence", lambda e: e["doc_id"].cast("string")), ",").alias("nearest"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)


OP11_SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
pos AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM p WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT pos.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY pos.anchor_id, positive_id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
       n.id AS negative_id, positive_score, n.score AS negative_score
FROM pos JOIN p n ON n.anchor_id = pos.anchor_id AND NOT n.same
  AND 50 * positive_score <= 100 * n.score AND 100 * n.score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY pos.anchor_id, positive_id ORDER BY n.score DESC, n.id) <= 3
"""


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.linked(read(spark, sf_dir, "documents"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults that the crc32 of conversation and turn decides on."""
    conv_id, turn, role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" "))
                                 for c in ("conv_id", "turn", "role", "text"))
    fault = (F.crc32(F.concat_ws(":", conv_id, turn)) % 20).cast("int")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"),
                                F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), fault.alias("fault"))
    return rows.filter("fault <> 0").select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("copy"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read(spark, sf_dir, "conversations")
    repair = conversation_repair.repaired(damaged(conversations))
    ids = conversations.select(F.col("conv_id").cast("long").alias("id")).distinct()
    audits = repair.audits.withColumnRenamed("conv_id", "of")
    sums = conversation_repair.digests(repair.turns).withColumnRenamed("conv_id", "sum_of")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return (ids.join(audits, F.col("id").eqNullSafe(F.col("of")), "left")
            .join(sums, F.col("id").eqNullSafe(F.col("sum_of")), "left")
            .select(F.col("id").alias("conv_id"), *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts),
                    F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_decontamination": op2_decontamination,
    "op3_html_text": op3_html_text,
    "op4_near_dedup": op4_near_dedup,
    "op5_line_dedup": op5_line_dedup,
    "op6_license_scan": op6_license_scan,
    "op7_chat_format": op7_chat_format,
    "op8_secret_scan": op8_secret_scan,
    "op9_quality": op9_quality,
    "op10_toxicity": op10_toxicity,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_simhash": op12_simhash,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLES: dict[str, str] = {
    "op2_decontamination": OP2_SQL,
    "op4_near_dedup": OP4_SQL,
    "op5_line_dedup": OP5_SQL,
    "op7_chat_format": OP7_SQL,
    "op11_hard_negatives": OP11_SQL,
}
