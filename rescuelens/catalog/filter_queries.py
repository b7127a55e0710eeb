"""Catalogue: signals, masks, deduplication, funnels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rescuelens import lexicons as lx
from rescuelens.catalog import sql
from rescuelens.catalog.relations import POSTS_SQL, documents, posts
from rescuelens.functions import signals as sg
from rescuelens.functions import text
from rescuelens.operators import dedup, funnel, masks
from rescuelens.plans import filtering
from rescuelens.sources import readers

START, END = "2023-02-07 00:00:00", "2023-03-01 12:00:00"


def _signals(spark: SparkSession, sf_dir: str, rules=sg.EVENT_RULES) -> DataFrame:
    return sg.with_signals(posts(spark, sf_dir), "post_text", rules)


def _folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.evaluate_once(
        posts(spark, sf_dir), sg.FOLDED,
        text.fold_for_search(F.coalesce("post_text", F.lit(""))))


def signal_flags(spark, sf_dir):
    r = sg.EVENT_RULES
    names = ["sos", "flood", "need", "hazard", "first_person", "offer", "location_word"]
    return _signals(spark, sf_dir).select(
        "seq", *[sg.signal(r, n).alias(n) for n in names], sg.retweet().alias("retweet"))


def signal_dash_offers(spark, sf_dir):
    """Offers with both spellings that the bracketed entry stands for."""
    rules = sg.with_dash_offers(sg.EVENT_RULES)
    df = sg.with_signals(posts(spark, sf_dir), "post_text", rules)
    return df.select("seq", sg.signal(rules, "offer").alias("offer"))


def signal_phone(spark, sf_dir):
    return _folded(spark, sf_dir).select("seq", sg.phone().alias("phone"))


def signal_coord(spark, sf_dir):
    return _folded(spark, sf_dir).select(
        "seq", sg.coordinates().alias("in_text"),
        sg.coordinates_column("coordinates").alias("in_column"))


def signal_address(spark, sf_dir):
    return _folded(spark, sf_dir).select("seq", sg.address(sg.FOLDED).alias("address"))


def url_guard(spark, sf_dir):
    return _folded(spark, sf_dir).select(
        "seq", sg.url_count().cast("bigint").alias("urls"),
        sg.enough_text(sg.EVENT_RULES).alias("loose"),
        sg.enough_text(sg.TAGGED_RULES).alias("tight"))


def _mask(mode="balanced", rules=sg.EVENT_RULES, allow_retweets=True):
    def query(spark, sf_dir):
        return masks.keep_help_posts(posts(spark, sf_dir), "post_text", rules, mode,
                                     allow_retweets).select("seq", "post_id")
    return query


def _tagged(spark, sf_dir):
    return posts(spark, sf_dir).withColumn(
        "_text", masks.combined_text("post_text", "hashtags"))


def mask_kaggle(spark, sf_dir):
    df = sg.with_signals(_tagged(spark, sf_dir), "_text", sg.TAGGED_RULES)
    return df.filter(masks.tagged_help_mask("coordinates")).select("seq", "post_id")


def lang_filter(spark, sf_dir):
    return posts(spark, sf_dir).filter(masks.in_languages("language")).select("seq", "language")


def event_window(spark, sf_dir):
    return posts(spark, sf_dir).select(
        "seq", masks.in_window("posted_at", START, END).alias("inside"),
        masks.in_window("posted_at", START).alias("since"),
        masks.in_window("posted_at", None, END).alias("until"),
        masks.in_window("posted_at").alias("open"))


def audit_flags(spark, sf_dir):
    return filtering.help_posts(posts(spark, sf_dir), "post_id", "post_text", ["seq"]).select(
        "seq", "post_id", "_sos", "_flood", "_need", "_haz")


def _as_tagged(spark, sf_dir):
    return posts(spark, sf_dir).withColumnsRenamed(
        {"post_text": "content", "posted_at": "date"})


def audit_flags_tagged(spark, sf_dir):
    return filtering.tagged_help_posts(_as_tagged(spark, sf_dir), ["seq"], START, None).select(
        "seq", "_hit_sos", "_hit_phone", "_hit_coord", "_hit_addr", "_hit_locw",
        "_first_person")


def dedup_id_or_text(spark, sf_dir):
    return dedup.first_per_key(
        posts(spark, sf_dir), dedup.id_or_text_key("post_id", "post_text"), ["seq"]
    ).select("seq", "post_id")


def dedup_text(spark, sf_dir):
    return dedup.first_per_key(
        _tagged(spark, sf_dir), dedup.text_key("_text"), ["seq"]).select("seq")


EARLIER = "src4"  # files up to this name are an earlier delivery


def incremental_anti(spark, sf_dir):
    keyed = posts(spark, sf_dir).withColumn(
        "key", dedup.digest(dedup.id_or_text_key("post_id", "post_text")))
    known = keyed.filter(F.col("file") <= EARLIER)
    new = dedup.first_per_key(keyed.filter(F.col("file") > EARLIER), F.col("key"), ["seq"])
    return dedup.drop_known(new, known, "key").select("seq", "post_id")


def _per_file(spark, sf_dir):
    all_posts = posts(spark, sf_dir)
    kept = filtering.help_posts(all_posts, "post_id", "post_text", ["file", "seq"])
    return funnel.kept_per_file(all_posts, kept, "file")


def funnel_files(spark, sf_dir):
    return _per_file(spark, sf_dir)


def funnel_totals(spark, sf_dir):
    return funnel.run_totals(_per_file(spark, sf_dir))


def funnel_stages(spark, sf_dir):
    return filtering.tagged_funnel(_as_tagged(spark, sf_dir), START, END)


def head_n(spark, sf_dir):
    return posts(spark, sf_dir).orderBy("seq").limit(100).select("seq", "post_id")


def union_corpora(spark, sf_dir):
    event = masks.keep_help_posts(posts(spark, sf_dir), "post_text", sg.EVENT_RULES, "recall")
    crisis = masks.keep_help_posts(posts(spark, sf_dir), "post_text", sg.CRISIS_RULES, "strict")
    return readers.append_all(
        event.select(F.lit("event").alias("corpus"), "seq", "post_id"),
        crisis.select(F.lit("crisis").alias("corpus"), "seq", "post_id", "language"))


def fold_text(spark, sf_dir):
    df = text.evaluate_once(documents(spark, sf_dir), "f", text.fold("text"))
    return df.select("doc_id", F.md5("f").alias("digest"), F.length("f").alias("chars"))


QUERIES = {
    "signal_flags": signal_flags, "signal_dash_offers": signal_dash_offers, "signal_phone": signal_phone, "signal_coord": signal_coord,
    "signal_address": signal_address, "url_guard": url_guard,
    "mask_strict": _mask("strict"), "mask_balanced": _mask(), "mask_recall": _mask("recall"),
    "mask_crisis": _mask(rules=sg.CRISIS_RULES), "mask_kaggle": mask_kaggle,
    "mask_no_rt": _mask(allow_retweets=False),
    "lang_filter": lang_filter, "event_window": event_window,
    "audit_flags": audit_flags, "audit_flags_tagged": audit_flags_tagged,
    "dedup_id_or_text": dedup_id_or_text, "dedup_text": dedup_text,
    "incremental_anti": incremental_anti, "funnel_files": funnel_files,
    "funnel_totals": funnel_totals, "funnel_stages": funnel_stages, "head_n": head_n,
    "union_corpora": union_corpora, "fold_text": fold_text,
}

# --- the same in SQL -----------------------------------------------------------------

ID_KEY = (f"coalesce(nullif({sql.stripped('post_id')}, ''), "
           f"{sql.folded(sql.stripped(sql.collapsed('post_text')))})")
_TAGGED_TEXT = "coalesce(post_text, '') || ' ' || coalesce(hashtags, '')"
_TAGGED_KEY = sql.folded(sql.stripped(sql.collapsed(f"({_TAGGED_TEXT})")))


def _select(columns: str, corpus: str = "event", where: str = "true") -> str:
    return f"WITH {sql.signals(corpus)} SELECT {columns} FROM sig WHERE {where}"


def _first(source: str, key: str, order: str, columns: str, where: str = "true") -> str:
    return (f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {key} "
            f"ORDER BY {order}) AS rn FROM {source} WHERE {where}) WHERE rn = 1")


TAGGED_SIG = sql.signals("tagged", f"({_TAGGED_TEXT})")
IN_TIME = f"posted_at >= TIMESTAMP '{START}'"
#: one row per key of what the tagged run keeps, without what depends on the order of the files
TAGGED_FIRST = f"""SELECT md5(post_text) AS digest, sos AS _hit_sos, first_person AS _first_person
    FROM (SELECT *, row_number() OVER (PARTITION BY {_TAGGED_KEY} ORDER BY seq) AS rn FROM sig
          WHERE lower(language) IN ('tr', 'en') AND {IN_TIME} AND {sql.TAGGED_KEPT}) WHERE rn = 1"""
_UNTIL = f"posted_at <= TIMESTAMP '{END}'"
_POSITION = "(coord OR coalesce(regexp_matches(coordinates, '[0-9]'), false))"
_KEPT_FILES = f"""WITH {sql.signals("event")},
kept AS ({_first("sig", ID_KEY, "file, seq", "file", sql.kept("balanced"))}),
per_file AS (SELECT a.file, count(b.n) * coalesce(max(b.n), 0) AS kept
    FROM (SELECT DISTINCT file FROM posts) a
    LEFT JOIN (SELECT file, count(*) AS n FROM kept GROUP BY file) b ON a.file = b.file
    GROUP BY a.file)"""

ORACLES = {
    "signal_flags": _select("seq, sos, flood, need, hazard, first_person, offer, "
                            "location_word, retweet"),
    "signal_dash_offers": f"""WITH {sql.signals("event")} SELECT seq,
        {sql.has("f", lx.OFFERS_TR + lx.OFFERS_EN + lx.DROP_OFF_FORMS)} AS offer FROM sig""",
    "signal_phone": _select("seq, phone"),
    "signal_coord": _select("seq, coord AS in_text, "
                            "coalesce(regexp_matches(coordinates, '[0-9]'), false) AS in_column"),
    "signal_address": _select("seq, address"),
    "url_guard": _select("seq, urls, enough AS loose, length(f) - urls * "
                         f"{lx.GUARD_TIGHT[0]} > {lx.GUARD_TIGHT[1]} AS tight"),
    "mask_strict": _select("seq, post_id", where=sql.kept("strict")),
    "mask_balanced": _select("seq, post_id", where=sql.kept("balanced")),
    "mask_recall": _select("seq, post_id", where=sql.kept("recall")),
    "mask_crisis": _select("seq, post_id", "crisis", sql.kept("balanced")),
    "mask_kaggle": f"WITH {TAGGED_SIG} SELECT seq, post_id FROM sig WHERE {sql.TAGGED_KEPT}",
    "mask_no_rt": _select("seq, post_id", where=sql.kept("balanced") + " AND NOT retweet"),
    "lang_filter": f"WITH {POSTS_SQL} SELECT seq, language FROM posts "
                   "WHERE lower(language) IN ('tr', 'en')",
    "event_window": f"""WITH {POSTS_SQL} SELECT seq,
        coalesce({IN_TIME} AND {_UNTIL}, false) AS inside, coalesce({IN_TIME}, false) AS since,
        coalesce({_UNTIL}, false) AS until, true AS open FROM posts""",
    "audit_flags": f"WITH {sql.signals('event')} " + _first(
        "sig", ID_KEY, "seq",
        "seq, post_id, sos AS _sos, flood AS _flood, need AS _need, hazard AS _haz",
        sql.kept("balanced")),
    "audit_flags_tagged": f"WITH {TAGGED_SIG} " + _first(
        "sig", _TAGGED_KEY, "seq",
        f"seq, sos AS _hit_sos, phone AS _hit_phone, {_POSITION} AS _hit_coord, "
        "address AS _hit_addr, location_word AS _hit_locw, first_person AS _first_person",
        f"lower(language) IN ('tr', 'en') AND {IN_TIME} AND {sql.TAGGED_KEPT}"),
    "dedup_id_or_text": f"WITH {POSTS_SQL} " + _first("posts", ID_KEY, "seq", "seq, post_id"),
    "dedup_text": f"WITH {POSTS_SQL} " + _first("posts", _TAGGED_KEY, "seq", "seq"),
    "incremental_anti": f"WITH {POSTS_SQL}, keyed AS (SELECT *, {ID_KEY} AS key FROM posts) "
        + _first("keyed", "key", "seq", "seq, post_id", f"file > '{EARLIER}' AND key NOT IN "
                 f"(SELECT key FROM keyed WHERE file <= '{EARLIER}')"),
    "funnel_files": f"{_KEPT_FILES} SELECT file, CAST(kept AS BIGINT) AS kept FROM per_file",
    "funnel_totals": f"""{_KEPT_FILES} SELECT count(*) AS files_scanned,
        count(*) FILTER (WHERE kept > 0) AS files_matched,
        CAST(coalesce(sum(kept), 0) AS BIGINT) AS rows_kept FROM per_file""",
    "funnel_stages": f"""WITH {TAGGED_SIG},
        staged AS (SELECT *, lower(language) IN ('tr', 'en') AS by_lang,
            coalesce({IN_TIME} AND {_UNTIL}, false) AS by_time FROM sig)
        SELECT count(*) AS rows_read, count(*) FILTER (WHERE by_lang) AS after_language,
            count(*) FILTER (WHERE by_lang AND by_time) AS after_time,
            (SELECT count(DISTINCT {_TAGGED_KEY}) FROM staged
             WHERE by_lang AND by_time AND {sql.TAGGED_KEPT}) AS kept
        FROM staged""",
    "head_n": f"WITH {POSTS_SQL} SELECT seq, post_id FROM posts ORDER BY seq LIMIT 100",
    "union_corpora": f"""WITH {sql.signals("event")}
        SELECT 'event' AS corpus, seq, post_id, NULL::VARCHAR AS language FROM sig
        WHERE {sql.kept("recall")}
        UNION ALL
        SELECT 'crisis', seq, post_id, language FROM
            (WITH {sql.signals("crisis")} SELECT * FROM sig WHERE {sql.kept("strict")})""",
    "fold_text": f"""SELECT doc_id, md5({sql.folded('text')}) AS digest,
        CAST(length({sql.folded('text')}) AS INTEGER) AS chars FROM documents""",
}
