"""Catalogue: scans and sinks.

The given tables are Parquet, so each query first writes its posts in the format under
test to a new folder (in the shared folder of the session) and then scans that.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from rescuelens import session
from rescuelens.catalog import filter_queries, label_queries, record_queries, sql
from rescuelens.catalog.filter_queries import ID_KEY
from rescuelens.catalog.relations import POSTS_SQL, attempts, posts, table
from rescuelens.operators import chat, labels
from rescuelens.plans import correction, filtering, generation, training
from rescuelens.sources import readers, writers


def _event_posts(spark, sf_dir):
    return posts(spark, sf_dir).select(
        F.col("post_id").alias("tweet_id"), F.col("post_text").alias("tweet_text"),
        F.col("seq").cast("string").alias("class_label"), "file")


def _event_folder(spark, sf_dir):
    folder = session.fresh_path(spark, "event")
    writers.write_tsv(_event_posts(spark, sf_dir), folder, "file")
    return folder


def scan_tsv(spark, sf_dir):
    df = readers.read_event_posts(spark, _event_folder(spark, sf_dir))
    return df.select("tweet_id", F.md5("tweet_text").alias("digest"), "class_label")


def scan_flat(spark, sf_dir):
    """The TSV files of one folder, with an optional number among the columns."""
    folder = session.fresh_path(spark, "crisis")
    writers.write_tsv(posts(spark, sf_dir).select(
        F.col("seq").cast("string").alias("id"), F.col("post_text").alias("text"), F.col("language").alias("lang"),
        F.when(F.col("seq") % 3 == 0, "unsure").otherwise((F.col("seq") % 4 / 4).cast("string")).alias("lang_conf"),
        F.lit("x").alias("other")), folder)
    return readers.read_crisis_posts(spark, folder).select(
        "id", F.md5("text").alias("digest"), "lang", "lang_conf")


def filter_run(spark, sf_dir):
    """Whole run from TSV folders to CSV, read back: ids and how many posts without one."""
    output = session.fresh_path(spark, "help")
    filtering.run_filter(spark, filtering.EVENT, _event_folder(spark, sf_dir), output)
    return readers.read_csv(spark, output).groupBy("tweet_id").agg(F.count("*").alias("n"))


def scan_skip_bad(spark, sf_dir):
    """Lines of two (padded), three, and four fields (cut), with lone quotes."""
    folder = session.fresh_path(spark, "bad")
    d = F.col("doc_id")
    fields = F.array(d.cast("string"),
                     F.concat(F.lit('"'), F.translate("text", "\t\r\n", "   ")),
                     F.lit("label"), F.lit("extra"))
    line = F.array_join(F.slice(fields, F.lit(1), (d % 3 + 2).cast("int")), "\t")
    # one column whose name is the header line
    lines = table(spark, sf_dir, "documents").select(
        line.alias("\t".join(readers.EVENT_COLUMNS)))
    (lines.write.option("header", "true").option("sep", "\x01").option("quote", "\0")
        .option("escapeQuotes", "false").option("extension", "tsv")
        .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
        .csv(folder))
    return readers.read_event_posts(spark, folder).select(
        "tweet_id", F.md5("tweet_text").alias("digest"), "class_label")


def scan_headers(spark, sf_dir):
    """Files of one scan in two orders of columns; half of them lack an optional one."""
    df = _tagged_posts(spark, sf_dir)
    folders = [session.fresh_path(spark, "headers") for _ in range(2)]
    even = F.col("place").cast("long") % 2 == 0
    writers.write_csv(df.filter(even), folders[0])
    writers.write_csv(df.filter(~even).select("like_count", "place", "content", "language", "date"), folders[1])
    return readers.read_tagged_posts(spark, folders).select(
        "date", F.md5("content").alias("digest"), "hashtags", "language", "place")


def scan_dates(spark, sf_dir):
    """Dates in five forms, and one that is none."""
    at, form = F.col("posted_at"), F.col("seq") % 6
    forms = ["yyyy-MM-dd HH:mm:ssXXX", "EEE MMM dd HH:mm:ss Z yyyy", "yyyyMMdd", "MMM d, yyyy", "MM/dd/yyyy HH:mm"]
    written = F.lit("some day")
    for k, f in enumerate(forms):
        written = F.when(form == k, F.date_format(at, f)).otherwise(written)
    return posts(spark, sf_dir).select("seq", readers.parse_date(written).alias("date"))


def _tagged_posts(spark, sf_dir):
    return posts(spark, sf_dir).select(
        F.date_format("posted_at", "yyyy-MM-dd HH:mm:ssXXX").alias("date"),
        F.col("post_text").alias("content"), "hashtags", "language", "coordinates",
        F.col("seq").cast("string").alias("place"), F.lit("1").alias("like_count"))


def scan_csv(spark, sf_dir):
    folder = session.fresh_path(spark, "tagged")
    writers.write_csv(_tagged_posts(spark, sf_dir), folder)
    return readers.read_tagged_posts(spark, folder).select(
        "date", F.md5("content").alias("digest"), "hashtags", "language", "coordinates", "place")


def _small_splits(spark):
    """A session that cuts files into splits of 512 KB, so that small ones are many tasks' work too."""
    small = spark.newSession()
    small.conf.set("spark.sql.session.timeZone", "UTC")
    small.conf.set("spark.sql.files.maxPartitionBytes", "512k")
    return small


def scan_csv_split(spark, sf_dir):
    """Values with line breaks, in files that are cut anywhere."""
    folder = session.fresh_path(spark, "tagged")
    writers.write_csv(posts(spark, sf_dir).select(
        F.col("seq").cast("string").alias("place"), F.concat("post_text", F.lit('\n"quoted",\n'), "post_text").alias("content")),
        folder)
    return readers.read_csv(_small_splits(spark), folder).select("place", F.md5("content").alias("digest"))


def scan_json_split(spark, sf_dir):
    """Arrays with brackets and escapes in their strings, in files that are cut anywhere."""
    folder = session.fresh_path(spark, "arrays")
    text = F.concat(F.lit('}, {"[\\'), "post_text", F.lit('\n]}'))
    writers.write_json_array(posts(spark, sf_dir).select("seq", F.struct(text.alias("text")).alias("post")), folder)
    return readers.read_json_array(_small_splits(spark), folder, "seq long, post struct<text: string>").select(
        "seq", F.md5("post.text").alias("digest"))


ENCODINGS = ("UTF-8", "windows-1254")


def scan_encoding(spark, sf_dir):
    folders = []
    for encoding in ENCODINGS:
        folders.append(session.fresh_path(spark, "encoded"))
        writers.write_csv(_tagged_posts(spark, sf_dir).select(
            "content", "place", F.lit(encoding).alias("written")), folders[-1], encoding)
    return readers.read_csv_any_encoding(spark, folders).select(
        "written", "place", F.md5("content").alias("digest"))


def scan_json_array(spark, sf_dir):
    """Pairs as JSON arrays, one per task, and back."""
    folder = session.fresh_path(spark, "arrays")
    pairs = labels.label_posts(posts(spark, sf_dir), "post_text").select("user", "assistant")
    writers.write_json_array(pairs, folder)
    return readers.read_json_array(spark, folder).select(
        chat.record_json(F.struct("user", "assistant")).alias("record"))


def sink_json_array(spark, sf_dir):
    """The same in the indented form."""
    folder = session.fresh_path(spark, "arrays")
    pairs = labels.label_posts(posts(spark, sf_dir), "post_text").select("user", "assistant")
    writers.write_json_array(pairs, folder, indent=True)
    return readers.read_json_array(spark, folder).select(
        chat.record_json(F.struct("user", "assistant")).alias("record"))


def tagged_run(spark, sf_dir):
    """The tagged corpus from CSV to CSV, read back, with the counts of its stages."""
    folder, output = session.fresh_path(spark, "tagged"), session.fresh_path(spark, "kept")
    writers.write_csv(_tagged_posts(spark, sf_dir), folder)
    counts = filtering.run_tagged_filter(spark, folder, output, filter_queries.START, None)
    kept = readers.read_csv(spark, output).select(
        F.md5("content").alias("digest"),
        *[F.col(c).cast("boolean").alias(c) for c in ("_hit_sos", "_first_person")])
    # one row of counts beside the rows kept
    return kept.crossJoin(F.broadcast(counts.drop("kept")))


def scan_jsonl(spark, sf_dir):
    folder = session.fresh_path(spark, "chats")
    first = chat.first_by_role(
        table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    writers.write_jsonl(first.select(F.array(*[
        chat.message(r, F.col(f"{r}_text")) for r in chat.ROLES]).alias("messages")), folder)
    return training.message_texts(readers.read_jsonl(spark, folder))


def sink_roundtrip(spark, sf_dir):
    """Pairs to a split JSON sink and back, cluster column stripped."""
    folder = session.fresh_path(spark, "pairs")
    training.write_training_pairs(
        labels.label_posts(posts(spark, sf_dir), "post_text"), folder,
        label_queries.TRAIN, label_queries.VAL, label_queries.TEST, label_queries.SEED)
    return spark.read.schema(readers.PAIR_DDL + ", split string").json(folder).select(
        "split", chat.record_json(F.struct("user", "assistant")).alias("record"))


def sink_sets(spark, sf_dir):
    """Pairs as JSON arrays of the three sets, and back."""
    folder = session.fresh_path(spark, "sets")
    training.write_training_pairs(labels.label_posts(posts(spark, sf_dir), "post_text"), folder, label_queries.TRAIN,
                                  label_queries.VAL, label_queries.TEST, label_queries.SEED, arrays=True)
    return readers.read_json_sets(spark, folder, "split", training.SETS).select(
        "split", chat.record_json(F.struct("user", "assistant")).alias("record"))


def _stand_in(requests):
    """Answers to correction requests: the record within some prose, or a way to fail."""
    asked = F.element_at("messages", 2)["content"]
    kind = F.substring("record_key", 1, 1)
    return requests.filter(kind != "2").select("record_key", F.when(kind == "0", "I can't")
        .when(kind == "1", F.concat(F.lit('{"user": '), asked)).otherwise(
            F.concat(F.lit("Here you are:\n"), asked, F.lit("\nDone."))).alias("raw_text"))


def correction_run(spark, sf_dir):
    """Arrays of records corrected into arrays; what failed is kept with the reason."""
    folder, output = session.fresh_path(spark, "records"), session.fresh_path(spark, "corrected")
    pairs = labels.label_posts(posts(spark, sf_dir), "post_text").select("user", "assistant")
    writers.write_json_array(pairs, folder)
    correction.run_correction(spark, folder, _stand_in, "Correct this.", output)
    done = readers.read_json_array(spark, f"{output}/corrected").select(
        chat.record_json(F.struct("user", "assistant")).alias("record"), F.lit("ok").alias("state"))
    return done.unionByName(spark.read.schema("record string, error string").json(f"{output}/failed")
                            .withColumnRenamed("error", "state"))


def crisis_run(spark, sf_dir):
    """The flat corpus from TSV to CSV, read back: ids and how many posts without one."""
    folder, output = session.fresh_path(spark, "crisis"), session.fresh_path(spark, "help")
    writers.write_tsv(posts(spark, sf_dir).select(
        F.col("post_id").alias("id"), F.col("post_text").alias("text"), F.col("language").alias("lang")), folder)
    filtering.run_filter(spark, filtering.CRISIS, folder, output)
    return readers.read_csv(spark, output).groupBy("id").agg(F.count("*").alias("n"))


def synth_run(spark, sf_dir):
    """A generator run with its stop rule: the examples written, and what they cost."""
    output = session.fresh_path(spark, "examples")
    totals = generation.run_generation(attempts(spark, sf_dir), output)
    content = F.try_variant_get(F.parse_json("value"), "$.messages[1].content", "string")
    # one row of totals beside the examples
    total = totals.first()
    return spark.read.text(output).select(F.md5(content).alias("digest"), F.lit(total.accepted).alias("accepted"),
                                          F.lit(total.calls).alias("calls"))


QUERIES = {
    "sink_sets": sink_sets, "correction_run": correction_run, "crisis_run": crisis_run, "synth_run": synth_run,
    "scan_flat": scan_flat, "scan_headers": scan_headers, "scan_dates": scan_dates, "tagged_run": tagged_run,
    "scan_csv_split": scan_csv_split, "scan_json_split": scan_json_split,
    "sink_json_array": sink_json_array, "scan_tsv": scan_tsv, "filter_run": filter_run, "scan_skip_bad": scan_skip_bad,
    "scan_csv": scan_csv, "scan_encoding": scan_encoding, "scan_json_array": scan_json_array,
    "scan_jsonl": scan_jsonl, "sink_roundtrip": sink_roundtrip,
}

# --- the same in SQL -----------------------------------------------------------------

_FLAT = "translate({}, chr(9) || chr(13) || chr(10), '   ')"
_PAIRS = label_queries.ORACLES["label_json"]

ORACLES = {
    "scan_flat": f"""WITH {POSTS_SQL} SELECT CAST(seq AS VARCHAR) AS id,
        md5(nullif({_FLAT.format('post_text')}, '')) AS digest, language AS lang,
        CASE WHEN seq % 3 <> 0 THEN (seq % 4) / 4 END::DOUBLE AS lang_conf FROM posts""",
    "scan_tsv": f"""WITH {POSTS_SQL} SELECT nullif(post_id, '') AS tweet_id,
        md5(nullif({_FLAT.format('post_text')}, '')) AS digest,
        CAST(seq AS VARCHAR) AS class_label FROM posts""",
    "filter_run": f"""WITH {sql.signals("event", _FLAT.format("post_text"))}
        SELECT nullif(post_id, '') AS tweet_id, count(DISTINCT {ID_KEY}) AS n
        FROM sig WHERE {sql.kept("balanced")} GROUP BY 1""",
    "scan_skip_bad": f"""SELECT CAST(doc_id AS VARCHAR) AS tweet_id,
        md5('"' || {_FLAT.format('text')}) AS digest,
        CASE WHEN doc_id % 3 <> 0 THEN 'label' END AS class_label FROM documents""",
    "scan_headers": f"""WITH {POSTS_SQL} SELECT posted_at AS date, md5(nullif(post_text, '')) AS digest,
        CASE WHEN seq % 2 = 0 THEN hashtags END AS hashtags, language, CAST(seq AS VARCHAR) AS place
        FROM posts""",
    "scan_dates": f"""WITH {POSTS_SQL} SELECT seq, CASE WHEN seq % 6 = 5 THEN NULL
        WHEN seq % 6 = 4 THEN date_trunc('minute', posted_at) WHEN seq % 6 IN (2, 3)
        THEN date_trunc('day', posted_at) ELSE posted_at END AS date FROM posts""",
    "tagged_run": f"""WITH {filter_queries.TAGGED_SIG},
        kept AS ({filter_queries.TAGGED_FIRST})
        SELECT kept.*, rows_read, after_language, after_time FROM kept, (SELECT count(*) AS rows_read,
            count(*) FILTER (WHERE lower(language) IN ('tr', 'en')) AS after_language,
            count(*) FILTER (WHERE lower(language) IN ('tr', 'en') AND {filter_queries.IN_TIME}) AS after_time
            FROM posts)""",
    "scan_csv_split": f"""WITH {POSTS_SQL} SELECT CAST(seq AS VARCHAR) AS place,
        md5(post_text || chr(10) || '"quoted",' || chr(10) || post_text) AS digest FROM posts""",
    "scan_json_split": f"""WITH {POSTS_SQL} SELECT seq,
        md5('}}, {{"[\\' || post_text || chr(10) || ']}}') AS digest FROM posts""",
    "sink_json_array": f"SELECT record FROM ({_PAIRS})",
    "correction_run": f"""SELECT record, CASE left(sha256(record), 1) WHEN '0' THEN 'no_object'
        WHEN '1' THEN 'bad_json' WHEN '2' THEN 'no_answer' ELSE 'ok' END AS state FROM ({_PAIRS})""",
    "crisis_run": f"""WITH {sql.signals("crisis", _FLAT.format("post_text"))}
        SELECT nullif(post_id, '') AS id, count(DISTINCT {ID_KEY}) AS n
        FROM sig WHERE {sql.kept("balanced")} GROUP BY 1""",
    "synth_run": record_queries.SYNTH_RUN,
    "scan_csv": f"""WITH {POSTS_SQL} SELECT posted_at AS date,
        md5(nullif(post_text, '')) AS digest, hashtags, language, coordinates,
        CAST(seq AS VARCHAR) AS place FROM posts""",
    "scan_encoding": f"""WITH {POSTS_SQL} SELECT written, CAST(seq AS VARCHAR) AS place,
        md5(nullif(post_text, '')) AS digest
        FROM posts, (VALUES {', '.join(f"('{e}')" for e in ENCODINGS)}) e(written)""",
    "scan_json_array": f"SELECT record FROM ({_PAIRS})",
    "scan_jsonl": f"SELECT text FROM ({record_queries.ORACLES['chat_text']})",
    "sink_roundtrip": f"""WITH clustered AS ({label_queries.CLUSTERED_PAIRS}),
        ranked AS (SELECT cluster, count(*) OVER () AS n, row_number() OVER (
            ORDER BY sha1('{label_queries.SEED}|' || cluster)) AS rn
            FROM (SELECT DISTINCT cluster FROM clustered))
        SELECT record, CASE WHEN rn <= round_even({label_queries.TRAIN}::DOUBLE * n, 0)
            THEN 'train' WHEN rn <= round_even({label_queries.TRAIN}::DOUBLE * n, 0)
                + round_even({label_queries.VAL}::DOUBLE * n, 0) THEN 'val' ELSE 'test' END AS split
        FROM clustered c JOIN ranked r ON c.cluster = r.cluster""",
}
ORACLES["sink_sets"] = ORACLES["sink_roundtrip"]
