"""Catalogue: model answers, generated examples, chat transcripts."""

from __future__ import annotations

from pyspark.sql import functions as F

from rescuelens import lexicons as lx
from rescuelens.catalog.relations import (ANSWERS_SQL, ATTEMPTS_SQL, answers, attempts, quoted,
                                          table)
from rescuelens.operators import answers as an
from rescuelens.operators import chat, synthetic
from rescuelens.plans import review, training

PROMPT = "You label posts."
TEMPLATE = "Use this prompt:\n{{SYSTEM_PROMPT}}\nand repeat it: {{SYSTEM_PROMPT}}"


def _envelope(spark, sf_dir):
    return an.with_envelope(answers(spark, sf_dir), "raw_text")


def json_extract(spark, sf_dir):
    return answers(spark, sf_dir).select(
        "answer_id", F.md5(an.json_slice("raw_text")).alias("digest"))


def answer_envelope(spark, sf_dir):
    return _envelope(spark, sf_dir).select(
        "answer_id", F.md5("raw_text").alias("raw"), "is_json", "parsed", "error")


def json_valid_rate(spark, sf_dir):
    return an.valid_rate(_envelope(spark, sf_dir), "model")


def _violations(profile):
    def query(spark, sf_dir):
        return an.with_violations(_envelope(spark, sf_dir), "parsed", profile).select(
            "answer_id", F.array_join("violations", "|").alias("violations"))
    return query


def _flat(label: str):
    place = F.col(f"{label}.location")
    return [F.array_join(f"{label}.needs", "|").alias("needs"),
            *[F.col(f"{label}.{k}").alias(k) for k in (
                "urgency", "life_threatening", "people_count", "post_type", "confidence",
                "dedup_cluster_id")],
            F.array_join(f"{label}.vulnerable_groups", "|").alias("vulnerable_groups"),
            place["province"].alias("province"), place["geo_confidence"].alias("geo_confidence")]


def _parsed(spark, sf_dir):
    return _envelope(spark, sf_dir).filter("is_json").select(
        "answer_id", an.parse_label(F.col("parsed")).alias("label"))


def label_defaults(spark, sf_dir):
    df = _parsed(spark, sf_dir)
    return df.withColumn("l", an.with_defaults(F.col("label"))).select("answer_id", *_flat("l"))


def label_repair(spark, sf_dir):
    df = _parsed(spark, sf_dir)
    return df.withColumn("l", an.repair_label(F.col("label"))).select("answer_id", *_flat("l"))


def review_answers(spark, sf_dir):
    """Envelope, broken rules and repaired label of every answer in one pass."""
    found = review.review_answers(answers(spark, sf_dir), "raw_text").withColumnRenamed("label", "l")
    return found.select("answer_id", "is_json", F.array_join("violations", "|").alias("violations"),
                        *_flat("l"))


def synth_validate(spark, sf_dir):
    return synthetic.validated(attempts(spark, sf_dir), "raw").select(
        "attempt", "reason", "strict", F.md5("user_content").alias("digest"))


def synth_accept(spark, sf_dir):
    return synthetic.accept(attempts(spark, sf_dir), "attempt", "raw").select(
        "attempt", F.md5("user_content").alias("digest"))


def synth_totals(spark, sf_dir):
    return synthetic.attempt_totals(attempts(spark, sf_dir), "attempt", "raw")


def prompt_fill(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(chat.fill_prompt(TEMPLATE, F.col("text"))).alias("digest"))


def _first(spark, sf_dir):
    return chat.first_by_role(
        table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")


def chat_first_by_role(spark, sf_dir):
    return _first(spark, sf_dir)


def chat_merge(spark, sf_dir):
    def content(messages, at):
        return F.coalesce(F.try_element_at(messages, F.lit(at))["content"], F.lit("-"))
    system, user = F.lit(PROMPT + "\n"), F.col("user_text")
    split = chat.chat_messages(system, user, system_role=True)
    merged = chat.chat_messages(system, user, system_role=False)
    bare = chat.chat_messages(F.lit(""), user, system_role=True)
    return _first(spark, sf_dir).select(
        "conv_id", content(split, 1).alias("split_1"), content(split, 2).alias("split_2"),
        content(merged, 1).alias("merged_1"), content(merged, 2).alias("merged_2"),
        content(bare, 1).alias("bare_1"), chat.plain_prompt(system, user).alias("plain"))


def _texts(template=None):
    def query(spark, sf_dir):
        return training.training_texts(table(spark, sf_dir, "conversations"), "conv_id", "turn",
                                       "role", "text", template)
    return query


TURN = "<{role}>{content}</{role}>\n"

QUERIES = {
    "json_extract": json_extract, "answer_envelope": answer_envelope,
    "json_valid_rate": json_valid_rate,
    "review_answers": review_answers, "label_violations": _violations(an.RUNTIME),
    "label_violations_corrected": _violations(an.CORRECTED),
    "label_defaults": label_defaults, "label_repair": label_repair,
    "synth_validate": synth_validate, "synth_accept": synth_accept,
    "synth_totals": synth_totals, "prompt_fill": prompt_fill,
    "chat_first_by_role": chat_first_by_role, "chat_merge": chat_merge,
    "chat_text": _texts(), "chat_text_template": _texts(TURN),
}

# --- the same in SQL -----------------------------------------------------------------

_SLICE = r"nullif(regexp_extract(raw_text, '(?s)\{.*\}', 0), '')"
_ENVELOPE = f"""{ANSWERS_SQL},
sliced AS (SELECT *, {_SLICE} AS j FROM answers),
-- json_valid lets a trailing comma pass
env AS (SELECT *, coalesce(json_valid(j) AND NOT regexp_matches(j, ',\\s*[}}\\]]'), false)
    AS is_json FROM sliced),
good AS (SELECT answer_id, CAST(j AS JSON) AS v FROM env WHERE is_json)"""


def _in(values) -> str:
    return "(" + ", ".join(map(quoted, values)) + ")"


def _array(values) -> str:
    return "[" + ", ".join(map(quoted, values)) + "]"


def _check(path: str, right_type: str, value: str = "true") -> str:
    name = path[2:]
    return (f"CASE WHEN json_type(v, '{path}') IS NULL THEN '{name}:missing' "
            f"WHEN NOT ({right_type.replace('@', f'''json_type(v, '{path}')''')}) "
            f"THEN '{name}:type' WHEN NOT ({value}) THEN '{name}:value' END")


def _items(path: str) -> str:
    return f"from_json(json_extract(v, '{path}'), '[\"VARCHAR\"]')"


def _text_list(path: str) -> str:
    return (f"@ = 'ARRAY' AND len(list_filter(json_extract(v, '{path}[*]'), "
            f"lambda x: json_type(x) NOT IN ('VARCHAR', 'NULL'))) = 0")


def _all_in(path: str, allowed) -> str:
    return (f"len(list_filter(json_extract_string(v, '{path}[*]'), "
            f"lambda x: x NOT IN {_in(allowed)})) = 0")


_NUM = "@ IN ('BIGINT', 'UBIGINT', 'DOUBLE')"


def _share(path: str) -> str:
    return f"CAST(json_extract_string(v, '{path}') AS DOUBLE) BETWEEN 0 AND 1"


def _violations_sql(profile: an.Profile) -> str:
    text = lambda p: f"json_extract_string(v, '{p}')"
    place = lambda c: f"CASE WHEN json_type(v, '$.location') = 'OBJECT' THEN {c} END"
    checks = [
        _check("$.needs", _text_list("$.needs"),
               _all_in("$.needs", profile.needs) if profile.needs else "true"),
        _check("$.urgency", "@ = 'VARCHAR'", f"{text('$.urgency')} IN {_in(lx.URGENCY_VALUES)}"),
        _check("$.life_threatening", "@ = 'BOOLEAN'"),
        _check("$.location", "@ = 'OBJECT'"),
        *[place(_check(f"$.location.{k}", "@ IN ('VARCHAR', 'NULL')"))
          for k in lx.LOCATION_KEYS[:-1]],
        place(_check("$.location.geo_confidence", _NUM, _share("$.location.geo_confidence"))),
        _check("$.people_count", "@ IN ('BIGINT', 'UBIGINT', 'NULL')"),
        _check("$.vulnerable_groups", _text_list("$.vulnerable_groups"),
               _all_in("$.vulnerable_groups", lx.GROUP_VALUES)),
        _check("$.post_type", "@ = 'VARCHAR'",
               f"{text('$.post_type')} IN {_in(profile.post_types)}"),
        _check("$.confidence", _NUM, _share("$.confidence")),
    ]
    if lx.CLUSTER_KEY in profile.keys:
        checks.append(_check(f"$.{lx.CLUSTER_KEY}", "@ IN ('VARCHAR', 'NULL')"))
    extra = (f"list_transform(list_sort(list_filter(json_keys(v), lambda k: k NOT IN "
             f"{_in(profile.keys)})), lambda k: 'extra:' || k)")
    return f"""WITH {_ENVELOPE}
        SELECT answer_id, coalesce(array_to_string(
            list_concat([{', '.join(checks)}], {extra}), '|'), '') AS violations FROM good
        UNION ALL SELECT answer_id, 'object' FROM env WHERE NOT is_json"""


_FIELDS = """fields AS (SELECT answer_id,
    coalesce(array_to_string(json_extract_string(v, '$.needs[*]'), '|'), '') AS needs,
    json_extract_string(v, '$.urgency') AS urgency,
    TRY_CAST(json_extract_string(v, '$.life_threatening') AS BOOLEAN) AS life_threatening,
    CASE WHEN json_type(v, '$.people_count') IN ('BIGINT', 'UBIGINT')
        THEN CAST(json_extract_string(v, '$.people_count') AS BIGINT) END AS people_count,
    json_extract_string(v, '$.post_type') AS post_type,
    CAST(json_extract_string(v, '$.confidence') AS DOUBLE) AS confidence,
    json_extract_string(v, '$.dedup_cluster_id') AS dedup_cluster_id,
    coalesce(array_to_string(json_extract_string(v, '$.vulnerable_groups[*]'), '|'), '')
        AS vulnerable_groups,
    json_extract_string(v, '$.location.province') AS province,
    CAST(json_extract_string(v, '$.location.geo_confidence') AS DOUBLE) AS geo_confidence
    FROM good),
judged AS (SELECT *, needs = '' AND coalesce(post_type IN ('emotion/prayer', 'complaint'), false)
    AS quiet FROM fields)"""

_J = "TRY_CAST(raw AS JSON)"
_VALID = f"""{ATTEMPTS_SQL},
checked AS (SELECT *, CASE WHEN raw = '' THEN 'empty'
    WHEN NOT json_valid(raw) THEN 'not_json'
    WHEN json_type({_J}) <> 'OBJECT' THEN 'not_object'
    WHEN coalesce(json_type({_J}, '$.messages'), '') <> 'ARRAY'
        OR json_array_length({_J}, '$.messages') <> 3 THEN 'messages'
    WHEN coalesce(json_type({_J}, '$.messages[1].content'), '') <> 'VARCHAR'
        THEN 'user_content' END AS reason,
    json_extract_string({_J}, '$.messages[1].content') AS content FROM attempts),
accepted AS (SELECT attempt, content FROM (SELECT *, row_number() OVER (
        PARTITION BY content ORDER BY attempt) AS rn FROM checked
        WHERE reason IS NULL) WHERE rn = 1)"""

#: the stop rule: 500 examples, or 1,500 attempts
SYNTH_RUN = f"""WITH {_VALID},
taken AS (SELECT * FROM accepted WHERE attempt <= {lx.SYNTHETIC_TARGET * lx.ATTEMPTS_PER_SAMPLE}
          ORDER BY attempt LIMIT {lx.SYNTHETIC_TARGET})
SELECT md5(content) AS digest, (SELECT count(*) FROM taken) AS accepted,
    CASE WHEN (SELECT count(*) FROM taken) = {lx.SYNTHETIC_TARGET} THEN (SELECT max(attempt) FROM taken)
    ELSE (SELECT count(*) FROM attempts WHERE attempt <= {lx.SYNTHETIC_TARGET * lx.ATTEMPTS_PER_SAMPLE}) END AS calls
FROM taken"""

_FIRST = """first AS (SELECT conv_id,
    coalesce(arg_min(text, turn) FILTER (WHERE role = 'system' AND text <> ''), '') AS system_text,
    coalesce(arg_min(text, turn) FILTER (WHERE role = 'user' AND text <> ''), '') AS user_text,
    coalesce(arg_min(text, turn) FILTER (WHERE role = 'assistant' AND text <> ''), '')
        AS assistant_text
    FROM conversations GROUP BY conv_id)"""


def _strip(c: str) -> str:
    return rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


_NL = "chr(10)"
_ASKED = (f"'User: ' || {_strip('user_text')} || {_NL} || 'Assistant: ' || "
          f"{_strip('assistant_text')}")
_MERGED = _strip(f"({_strip('system_text')} || {_NL} || {_NL} || {_strip('user_text')})")

ORACLES = {
    "json_extract": f"WITH {_ENVELOPE} SELECT answer_id, md5(j) AS digest FROM sliced",
    "answer_envelope": f"""WITH {_ENVELOPE} SELECT answer_id, md5(raw_text) AS raw, is_json,
        CASE WHEN is_json THEN j END AS parsed,
        CASE WHEN j IS NULL THEN {quoted(an.NO_OBJECT)} WHEN NOT is_json
            THEN {quoted(an.BAD_JSON)} END AS error FROM env""",
    "json_valid_rate": f"""WITH {_ENVELOPE} SELECT model, count(*) AS answers,
        count(*) FILTER (WHERE is_json) AS valid,
        avg(CAST(is_json AS INTEGER)) AS valid_rate FROM env GROUP BY model""",
    "label_violations": _violations_sql(an.RUNTIME),
    "label_violations_corrected": _violations_sql(an.CORRECTED),
    "label_defaults": f"WITH {_ENVELOPE}, {_FIELDS} SELECT * EXCLUDE (quiet) FROM judged",
    "label_repair": f"""WITH {_ENVELOPE}, {_FIELDS} SELECT answer_id, needs,
        CASE WHEN quiet THEN 'low' ELSE urgency END AS urgency,
        CASE WHEN quiet THEN false ELSE life_threatening END AS life_threatening,
        people_count, post_type,
        CASE WHEN quiet THEN least(confidence, 0.3) ELSE confidence END AS confidence,
        dedup_cluster_id, vulnerable_groups, province,
        CASE WHEN province IS NULL AND (SELECT coalesce(
            json_extract_string(v, '$.location.country'),
            json_extract_string(v, '$.location.district'),
            json_extract_string(v, '$.location.neighborhood'),
            json_extract_string(v, '$.location.address_note')) FROM good g
            WHERE g.answer_id = judged.answer_id) IS NULL THEN 0
            ELSE coalesce(geo_confidence, 0) END::DOUBLE AS geo_confidence FROM judged""",
    "synth_validate": f"""WITH {_VALID} SELECT attempt, reason,
        reason IS NULL AND json_keys({_J}) = ['messages']
            AND json_extract_string({_J}, '$.messages[*].role') = {_array(chat.ROLES)} AS strict,
        CASE WHEN reason IS NULL THEN md5(content) END AS digest FROM checked""",
    "synth_accept": f"WITH {_VALID} SELECT attempt, md5(content) AS digest FROM accepted",
    "synth_totals": f"""WITH {_VALID} SELECT count(*) AS accepted,
        (SELECT count(*) FROM attempts) AS calls
        FROM accepted""",
    "prompt_fill": f"""SELECT doc_id, md5(replace({quoted(TEMPLATE)}, '{{{{SYSTEM_PROMPT}}}}',
        text)) AS digest FROM documents""",
    "chat_first_by_role": f"WITH {_FIRST} SELECT * FROM first",
    "chat_merge": f"""WITH {_FIRST} SELECT conv_id, {quoted(PROMPT)} || {_NL} AS split_1,
        user_text AS split_2,
        {_strip(f"({quoted(PROMPT)} || {_NL} || {_NL} || {_strip('user_text')})")} AS merged_1,
        '-' AS merged_2, user_text AS bare_1,
        {quoted(PROMPT)} || {_NL} || {_NL} || {_NL} || 'User: ' || user_text || {_NL}
            || 'Assistant:' AS plain FROM first""",
    "chat_text": f"""WITH {_FIRST} SELECT conv_id, CASE WHEN {_strip('system_text')} <> ''
        THEN {_strip('system_text')} || {_NL} || {_NL} || {_ASKED} ELSE {_ASKED} END AS text
        FROM first""",
    "chat_text_template": f"""WITH {_FIRST} SELECT conv_id, '<user>' || {_MERGED} || '</user>'
        || {_NL} || '<assistant>' || {_strip('assistant_text')} || '</assistant>' || {_NL} AS text
        FROM first""",
}
ORACLES["review_answers"] = f"""SELECT v.answer_id, r.answer_id IS NOT NULL AS is_json, v.violations,
    r.* EXCLUDE (answer_id)
    FROM ({ORACLES["label_violations"]}) v LEFT JOIN ({ORACLES["label_repair"]}) r
    ON v.answer_id = r.answer_id"""
