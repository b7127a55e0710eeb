"""Catalogue: normal form, labels, clusters and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from rescuelens import lexicons as lx
from rescuelens import session
from rescuelens.catalog import sql
from rescuelens.catalog.relations import POSTS_SQL, documents, posts, quoted
from rescuelens.functions import text
from rescuelens.operators import answers, chat, labels, splits
from rescuelens.plans import training

TRAIN, VAL, TEST, SEED = 0.8, 0.1, 0.1, 42


def _joined(c):
    return F.array_join(c, "|")


def _cued(spark, sf_dir):
    return labels.with_cues(posts(spark, sf_dir), "post_text")


def norm_text(spark, sf_dir):
    df = text.with_norm_text(posts(spark, sf_dir), "post_text", "n")
    return df.select("seq", F.md5("n").alias("digest"), F.length("n").alias("chars"))


_LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
_WIDE = "".join(chr(ord(c) + 0xFEE0) for c in _LETTERS)


def norm_nfkc(spark, sf_dir):
    """Posts written in full-width letters and digits have the normal form of the plain ones."""
    wide = posts(spark, sf_dir).withColumn("wide", F.translate("post_text", _LETTERS, _WIDE))
    return text.with_norm_text(wide, "wide", "n").select("seq", F.md5("n").alias("digest"))


def label_map(spark, sf_dir):
    """A caller's own labeller over whole texts, in batches."""
    def counted(frame):
        post = frame["post_text"].fillna("")
        return frame[["seq"]].assign(marks=post.str.count(r"[.!?]"), chars=post.str.len())
    return labels.map_records(posts(spark, sf_dir).select("seq", "post_text"), counted, "seq long, marks long, chars long")


def pairs_found_column(spark, sf_dir):
    """Pairs of a table whose text column has to be found by its name."""
    df = posts(spark, sf_dir).select(F.col("file").alias("origin"), F.col("post_text").alias("Text"), "language")
    return training.training_pairs(df).select(F.md5("user").alias("digest"))


def cluster_id(spark, sf_dir):
    return text.with_cluster_id(documents(spark, sf_dir), "text").select(
        "doc_id", "cluster_id")


def _digests(spark, sf_dir):
    """Document and cluster, written once: splitting reads them twice."""
    path = session.fresh_path(spark, "clusters")
    found = text.with_cluster_digest(documents(spark, sf_dir), "text", "cluster").select(
        "doc_id", "cluster")
    found.write.parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def cluster_sizes(spark, sf_dir):
    digests = text.with_cluster_digest(documents(spark, sf_dir), "text", "cluster")
    return splits.cluster_sizes(digests, "cluster").select(
        text.cluster_label("cluster").alias("cluster_id"), "n")


def cluster_split(spark, sf_dir):
    split = splits.cluster_split(_digests(spark, sf_dir), "cluster", TRAIN, VAL, TEST, SEED)
    return split.select("doc_id", text.cluster_label("cluster").alias("cluster_id"), "split")


def split_sizes(spark, sf_dir):
    return splits.split_sizes(cluster_split(spark, sf_dir))


def _of(**columns):
    def query(spark, sf_dir):
        return _cued(spark, sf_dir).select(
            "seq", *[make().alias(name) for name, make in columns.items()])
    return query


label_needs = _of(needs=lambda: _joined(labels.needs()))
label_evidence = _of(
    need_evidence=lambda: _joined(labels.need_evidence()),
    urgency_evidence=lambda: _joined(labels.urgency_evidence()),
    group_evidence=lambda: _joined(labels.vulnerable_evidence()))
label_urgency = _of(urgency=labels.urgency, life_threatening=labels.life_threatening)
label_vulnerable = _of(vulnerable_groups=lambda: _joined(labels.vulnerable_groups()))
label_people = _of(people_count=labels.people_count)
label_post_type = _of(post_type=labels.post_type)
label_confidence = _of(confidence=labels.confidence)


def label_location(spark, sf_dir):
    df = labels.with_location(_cued(spark, sf_dir))
    return df.select("seq", "location.*")


def _pairs(spark, sf_dir):
    return labels.label_posts(posts(spark, sf_dir), "post_text", ["seq"])


def label_pair(spark, sf_dir):
    return _pairs(spark, sf_dir).select(
        "seq", "user", _joined(F.col("assistant.needs")).alias("needs"),
        *[F.col(f"assistant.{k}").alias(k) for k in (
            "urgency", "life_threatening", "people_count", "post_type", "confidence",
            "dedup_cluster_id")],
        *[F.col(f"assistant.location.{k}").alias(k) for k in lx.LOCATION_KEYS],
        _joined(F.col("assistant.vulnerable_groups")).alias("vulnerable_groups"))


def label_json(spark, sf_dir):
    return _pairs(spark, sf_dir).select(
        "seq", chat.record_json(F.struct("user", "assistant")).alias("record"))


def correction_requests(spark, sf_dir):
    messages = chat.correction_messages("Correct the labels.", F.struct("user", "assistant"))
    return _pairs(spark, sf_dir).select("seq", F.posexplode(messages).alias("at", "m")).select(
        "seq", "at", "m.role", F.md5("m.content").alias("digest"))


def label_translate(spark, sf_dir):
    pairs = labels.label_posts(posts(spark, sf_dir), "post_text", ["seq"],
                               ("needs", "vulnerable_groups", "post_type"))
    return pairs.select(
        "seq", answers.translate_label(F.col("assistant")).alias("l")).select(
        "seq", _joined(F.col("l.needs")).alias("needs"),
        _joined(F.col("l.vulnerable_groups")).alias("vulnerable_groups"), "l.post_type")


QUERIES = {
    "norm_nfkc": norm_nfkc, "label_map": label_map, "pairs_found_column": pairs_found_column,
    "norm_text": norm_text, "cluster_id": cluster_id, "cluster_sizes": cluster_sizes,
    "cluster_split": cluster_split, "split_sizes": split_sizes,
    "label_needs": label_needs, "label_evidence": label_evidence,
    "label_urgency": label_urgency, "label_vulnerable": label_vulnerable,
    "label_location": label_location, "label_people": label_people,
    "label_post_type": label_post_type, "label_confidence": label_confidence,
    "label_pair": label_pair, "label_json": label_json,
    "correction_requests": correction_requests, "label_translate": label_translate,
}

# --- the same in SQL -----------------------------------------------------------------

_CLEAN = sql.stripped("replace(replace(coalesce(post_text, ''), chr(8203), ' '), chr(160), ' ')")


def _cluster_digest(column: str) -> str:
    lowered = sql.collapsed(f"lower(replace({sql.stripped(column)}, 'İ', 'i̇'))")
    return rf"sha1(regexp_replace({lowered}, '\d+', '<num>', 'g'))"


def _cluster(column: str) -> str:
    return f"substr({_cluster_digest(column)}, 1, 12)"


def _forms(groups) -> list[str]:
    return [f for cue in groups for f in cue]


def _any_i(phrase: str) -> str:
    """Phrase as a pattern in which every i matches all its kinds."""
    out = "".join("[iıIİ]" if c in "iıIİ" else "\\" + c if c in ".[](){}*+?^$|-" else c
                  for c in phrase)
    return out


def _span(groups) -> str:
    """Surface of the first cue that occurs, in cue order; null if none."""
    parts = []
    for cue in groups:
        forms = "|".join(map(_any_i, sorted(cue, key=len, reverse=True)))
        pattern = rf"(?i)(?:^|[^\p{{L}}\p{{N}}_])({forms})(?:[^\p{{L}}\p{{N}}_]|$)"
        parts.append(f"nullif(regexp_extract(t, {quoted(pattern)}, 1), '')")
    return f"coalesce({', '.join(parts)})"


def _evidence(groups: dict) -> str:
    spans = ", ".join(map(_span, groups.values()))
    # list_distinct does not keep the order
    return (f"array_to_string(list_filter([{spans}], lambda x, i: x IS NOT NULL AND "
            f"list_position([{spans}], x) = i), '|')")


def _listing(names: dict, groups: dict) -> str:
    cases = ", ".join(f"CASE WHEN {sql.has('c', _forms(groups[n]))} THEN {quoted(v)} END"
                      for n, v in names.items())
    return f"coalesce(array_to_string([{cases}], '|'), '')"


_ALL_NEEDS = [f for g in lx.NEED_CUES.values() for f in _forms(g)]
_ALL_GROUPS = [f for g in lx.VULNERABLE_CUES.values() for f in _forms(g)]
_UP, _LET = "A-ZÇĞİIÖŞÜ", "A-Za-zÇĞİIÖŞÜçğıiöşü"
_W = r"[^\p{L}\p{N}_]"
_PROVINCES = "|".join(map(_any_i, lx.PROVINCES))
_PROVINCE = rf"(?s)^(|.*?{_W})((?i:{_PROVINCES}))(?:{_W}.*)?$"
_HOOD = rf"(?:^|{_W})([{_LET}][{_LET}\-]{{2,}})\s+(?i:mah|mahallesi)(?:{_W}|$)"
_HOUSE = "mahalle|mah|cadde|sokak|bulvar|köyü|köy"
_NW = r"[^\n,\p{L}\p{N}_]"
_PHRASE = rf"([{_UP}][^\n,]{{0,59}}{_NW}(?:{_HOUSE})(?:{_NW}[^\n,]{{0,39}}|[\n,]|$))"
_PEOPLE = "|".join(sorted({p.replace("ı", "i") for p in lx.PEOPLE_WORDS}))


def _title(x: str) -> str:
    return f"upper(substr({x}, 1, 1)) || lower(substr({x}, 2))"


_LABELS = f"""{POSTS_SQL},
clean AS (SELECT seq, {_CLEAN} AS t FROM posts),
caseless AS (SELECT *, {sql.caseless('t')} AS c FROM clean),
cue AS (SELECT *,
    {sql.has('c', _forms(lx.CRITICAL_CUES))} OR contains(t, '!!!') AS critical,
    {sql.has('c', _forms(lx.HIGH_CUES))} AS high,
    {sql.has('c', _ALL_NEEDS)} AS any_need, {sql.has('c', _ALL_GROUPS)} AS any_group,
    regexp_extract(t, {quoted(_PROVINCE)}, 1) AS head,
    nullif(regexp_extract(t, {quoted(_PROVINCE)}, 2), '') AS surface,
    nullif(regexp_extract(t, {quoted(_HOOD)}, 1), '') AS hood,
    regexp_extract(t, {quoted(_PHRASE)}, 1) AS phrase
    FROM caseless),
tailed AS (SELECT *, CASE WHEN surface IS NOT NULL
    THEN substr(t, length(head) + length(surface) + 1) END AS tail FROM cue),
worded AS (SELECT *,
    nullif(regexp_extract(tail, '([{_UP}][{_LET}\\-]{{3,}})', 1), '') AS word FROM tailed),
placed AS (SELECT *, CASE WHEN surface IS NOT NULL THEN 'Turkey' END AS country,
    {_title('surface')} AS province,
    CASE WHEN lower(word) NOT IN ({', '.join(map(quoted, lx.NOT_A_DISTRICT))})
        THEN {_title('word')} END AS district,
    {_title('hood')} AS neighborhood,
    nullif({sql.stripped(f'''CASE WHEN surface IS NOT NULL
        THEN CASE WHEN length(head) > 40 THEN right(head, 40) ELSE head END
            || surface || left(tail, 60) ELSE rtrim(phrase, ',') END''')}, '') AS address_note
    FROM worded),
label AS (SELECT *,
    CASE WHEN province IS NOT NULL AND (district IS NOT NULL OR neighborhood IS NOT NULL) THEN 0.8
        WHEN province IS NOT NULL THEN 0.6
        WHEN neighborhood IS NOT NULL OR address_note IS NOT NULL THEN 0.3
        ELSE 0.0 END::DOUBLE AS geo_confidence,
    CASE WHEN critical THEN 'critical' WHEN high THEN 'high' ELSE 'normal' END AS urgency,
    critical OR {sql.has('c', _forms(lx.NEED_CUES['search_rescue']))} AS life_threatening,
    TRY_CAST(nullif(regexp_extract(c, '(\\d+)\\s*({_PEOPLE})', 1), '') AS BIGINT) AS people_count,
    CASE WHEN {sql.has('c', lx.OFFER_CUES)} THEN 'yardim_teklifi'
        WHEN any_need OR {sql.has('c', lx.REQUEST_CUES)} OR critical OR high THEN 'yardim_talebi'
        WHEN {sql.has('c', lx.COMPLAINT_CUES)} THEN 'sikayet'
        WHEN {sql.has('c', lx.PRAYER_CUES)} THEN 'duygu/dua' ELSE 'bilgi' END AS post_type,
    round(CASE WHEN any_need THEN 0.4 ELSE 0.2 END + CASE WHEN critical THEN 0.3
        WHEN high THEN 0.2 ELSE 0 END + CASE WHEN any_group THEN 0.1 ELSE 0 END, 2
        )::DOUBLE AS confidence,
    {_listing(lx.NEED_LABELS, lx.NEED_CUES)} AS needs,
    {_listing(lx.GROUP_LABELS, lx.VULNERABLE_CUES)} AS vulnerable_groups,
    {_cluster_digest('t')} AS cluster, substr(cluster, 1, 12) AS dedup_cluster_id
    FROM placed)"""


def _label(columns: str) -> str:
    return f"WITH {_LABELS} SELECT {columns} FROM label"


def _list(column: str) -> str:
    return f"CASE WHEN {column} = '' THEN []::VARCHAR[] ELSE string_split({column}, '|') END"


_RECORD = f"""CAST(to_json({{'user': t, 'assistant': {{
    'needs': {_list('needs')}, 'urgency': urgency, 'life_threatening': life_threatening,
    'location': {{'country': country, 'province': province, 'district': district,
        'neighborhood': neighborhood, 'address_note': address_note,
        'geo_confidence': geo_confidence}},
    'people_count': people_count, 'vulnerable_groups': {_list('vulnerable_groups')},
    'post_type': post_type, 'confidence': confidence,
    'dedup_cluster_id': dedup_cluster_id}}}}) AS VARCHAR)"""

_MARK = "CASE WHEN contains(t, '!!!') THEN '!!!' END"


def _mapped(column: str, mapping: dict) -> str:
    known = {k: v for k, v in mapping.items() if v is not None}
    cases = " ".join(f"WHEN x = {quoted(k)} THEN {quoted(v)}" for k, v in known.items())
    return (f"coalesce(array_to_string(list_transform({_list(column)}, "
            f"lambda x: CASE {cases} END), '|'), '')")


_CLUSTERS = f"""clustered AS (SELECT doc_id, {_cluster_digest('text')} AS cluster FROM documents),
ranked AS (SELECT cluster, row_number() OVER (ORDER BY sha1('{SEED}|' || cluster)) AS rn,
    count(*) OVER () AS n FROM (SELECT DISTINCT cluster FROM clustered)),
assigned AS (SELECT cluster, CASE WHEN rn <= round_even({TRAIN}::DOUBLE * n, 0) THEN 'train'
    WHEN rn <= round_even({TRAIN}::DOUBLE * n, 0) + round_even({VAL}::DOUBLE * n, 0) THEN 'val'
    ELSE 'test' END AS split FROM ranked),
divided AS (SELECT doc_id, substr(c.cluster, 1, 12) AS cluster_id, split
    FROM clustered c JOIN assigned a ON c.cluster = a.cluster)"""

#: pairs with the whole digest of their cluster
CLUSTERED_PAIRS = _label(f"{_RECORD} AS record, cluster")

ORACLES = {
    "norm_text": f"""WITH {POSTS_SQL} SELECT seq, md5({_CLEAN}) AS digest,
        CAST(length({_CLEAN}) AS INTEGER) AS chars FROM posts""",
    "norm_nfkc": f"WITH {POSTS_SQL} SELECT seq, md5({_CLEAN}) AS digest FROM posts",
    "label_map": f"""WITH {POSTS_SQL} SELECT seq, CAST(len(regexp_extract_all(coalesce(post_text, ''), '[.!?]')) AS BIGINT)
        AS marks, CAST(length(coalesce(post_text, '')) AS BIGINT) AS chars FROM posts""",
    "pairs_found_column": f"WITH {POSTS_SQL} SELECT md5({_CLEAN}) AS digest FROM posts",
    "cluster_id": f"SELECT doc_id, {_cluster('text')} AS cluster_id FROM documents",
    "cluster_sizes": f"""SELECT substr(cluster, 1, 12) AS cluster_id, count(*) AS n
        FROM (SELECT {_cluster_digest('text')} AS cluster FROM documents) GROUP BY cluster""",
    "cluster_split": f"WITH {_CLUSTERS} SELECT doc_id, cluster_id, split FROM divided",
    "split_sizes": f"WITH {_CLUSTERS} SELECT split, count(*) AS n FROM divided GROUP BY split",
    "label_needs": _label("seq, needs"),
    "label_evidence": _label(f"""seq, {_evidence(lx.NEED_CUES)} AS need_evidence,
        coalesce({_span(lx.CRITICAL_CUES)}, {_MARK}, {_span(lx.HIGH_CUES)}, '')
            AS urgency_evidence,
        {_evidence(lx.VULNERABLE_CUES)} AS group_evidence"""),
    "label_urgency": _label("seq, urgency, life_threatening"),
    "label_vulnerable": _label("seq, vulnerable_groups"),
    "label_location": _label("seq, country, province, district, neighborhood, address_note, "
                             "geo_confidence"),
    "label_people": _label("seq, people_count"),
    "label_post_type": _label("seq, post_type"),
    "label_confidence": _label("seq, confidence"),
    "label_pair": _label("""seq, t AS "user", needs, urgency, life_threatening, people_count,
        post_type, confidence, dedup_cluster_id, country, province, district, neighborhood,
        address_note, geo_confidence, vulnerable_groups"""),
    "label_json": _label(f"seq, {_RECORD} AS record"),
    "correction_requests": f"""WITH {_LABELS}
        SELECT seq, CAST(0 AS INTEGER) AS at, 'system' AS role,
            md5('Correct the labels.') AS digest FROM label
        UNION ALL SELECT seq, CAST(1 AS INTEGER), 'user', md5({_RECORD}) FROM label""",
    "label_translate": _label(
        f"seq, {_mapped('needs', lx.NEED_TRANSLATION)} AS needs, "
        f"{_mapped('vulnerable_groups', lx.GROUP_TRANSLATION)} AS vulnerable_groups, "
        "CASE " + " ".join(f"WHEN post_type = {quoted(k)} THEN {quoted(v)}"
                           for k, v in lx.POST_TYPE_TRANSLATION.items()) + " END AS post_type"),
}
