"""Relations the catalogue queries run on, derived from the given tables.

Each relation exists twice: as a Spark data frame and as a SQL common table expression
for the check in another engine. All rows and whole texts are used: every document is
part of a post, an answer and an attempt, and ``doc_id`` only decides which phrase is put
in front of it or how an answer is broken. Cases without a text are rows of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rescuelens.sources.layout import spread

#: phrase number = doc_id % 20
PHRASES = [
    "We are trapped in the house after the flood",
    "please help, address 12 Main street",
    "need water and food near the river, my family is here",
    "RT @user: stuck on the roof, water rising, we are scared",
    "donation drive, we are collecting: need help, location north hall",
    "earthquake felt downtown, everyone is safe, drop-off at the school",
    "Enkaz altındayım, konum Van Erciş mah. ACİL yardım edin",
    "ÇADIR lazım, 12 kişi, çocuklar var, adres Malatya Battalgazi Fırat mahallesi, deprem",
    "send ambulance 0532 123 4567 https://t.co/abc",
    "stuck i'm https://a.b",
    "su yükseliyor, çatıdayız, biz 5 kişi",
    "dua ediyoruz, geçmiş olsun",
    "coordinates 37.06, 37.38 need help now",
    "kimse gelmedi, devlet yok",
    "need a boat, evacuate us, storm surge is coming",
    "blanket and insulin, my family is cold",
    "boat wanted #shelter",
    "trapped, send someone https://web.archive.org/web/https://a.b/c seehttps://d.e/f",
    "",
    "",
]
#: phrases that also make a post of their own, without the document
ALONE = (9, 18, 19)
TURKISH = (6, 7, 10, 11, 13)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, for text work: spread over the cores even if they are one file."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))


def _pick(options: list[str], by: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, options)), (by + 1).cast("int"))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts: a phrase in front of every document, with ids, tags, dates and a file.

    Some phrases make a second post that is nothing else, or null.
    """
    k = F.col("doc_id") % 20
    alone = F.explode(F.when(k.isin(*ALONE), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    rows = documents(spark, sf_dir).select("*", alone.alias("alone")).withColumn(
        "seq", 2 * F.col("doc_id") + F.col("alone"))
    d = F.col("seq")
    return rows.select(
        d,
        F.when(d % 11 == 0, "").when(d % 10 == 3, (d - 2).cast("string"))
         .otherwise(d.cast("string")).alias("post_id"),
        F.when(F.col("alone") == 0, F.concat(_pick(PHRASES, k), F.lit(" "), F.col("text")))
         .when(F.col("doc_id") % 40 != 19, _pick(PHRASES, k)).alias("post_text"),
        F.when(k.isin(*TURKISH), "tr").otherwise(F.col("lang")).alias("language"),
        F.when(d % 7 == 0, "#imdat").alias("hashtags"),
        F.when(d % 5 == 0, "37.06,37.38").alias("coordinates"),
        F.when(d % 13 != 0, F.timestamp_seconds(F.lit(1675641600) + F.col("doc_id") * 3600)
               ).alias("posted_at"),
        F.col("source").alias("file"))


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _numbered(values: list[str]) -> str:
    return ", ".join(f"({i}, {quoted(v)})" for i, v in enumerate(values))


def _ints(values) -> str:
    return ", ".join(map(str, values))


POSTS_SQL = f"""
phrase(k, p) AS (VALUES {_numbered(PHRASES)}),
numbered AS (
    SELECT *, 2 * doc_id + alone AS seq
    FROM documents JOIN phrase ON k = doc_id % 20, (VALUES (0), (1)) a(alone)
    WHERE alone = 0 OR k IN ({_ints(ALONE)})),
posts AS (
    SELECT seq,
        CASE WHEN seq % 11 = 0 THEN '' WHEN seq % 10 = 3 THEN CAST(seq - 2 AS VARCHAR)
             ELSE CAST(seq AS VARCHAR) END AS post_id,
        CASE WHEN alone = 0 THEN p || ' ' || text WHEN doc_id % 40 <> 19 THEN p END AS post_text,
        CASE WHEN k IN ({_ints(TURKISH)}) THEN 'tr' ELSE lang END AS language,
        CASE WHEN seq % 7 = 0 THEN '#imdat' END AS hashtags,
        CASE WHEN seq % 5 = 0 THEN '37.06,37.38' END AS coordinates,
        CASE WHEN seq % 13 <> 0
             THEN TIMESTAMP '2023-02-06 00:00:00' + to_hours(doc_id) END AS posted_at,
        source AS file
    FROM numbered
)"""

# --- model answers -----------------------------------------------------------------

_PLACE = ('{"country":"Turkey","province":"Hatay","district":null,"neighborhood":null,'
          '"address_note":^,"geo_confidence":0.6}')
_NOWHERE = ('{"country":null,"province":null,"district":null,"neighborhood":null,'
            '"address_note":^,"geo_confidence":0.4}')
_GOOD = ('{"needs":["water","food"],"urgency":"high","life_threatening":false,"location":'
         + _PLACE + ',"people_count":#,"vulnerable_groups":["child"],'
         '"post_type":"help_request","confidence":0.7}')
#: answer form = doc_id % 14; # is the document number, ~ the whole document text, ^ the same
#: as a JSON string
ANSWERS = [
    _GOOD,
    "Here it is: " + _GOOD + "\nThat is all.",
    "I cannot help with that. ~",
    "} odd ~ {",
    _GOOD[:-1] + ",}",
    _GOOD.replace('"', "'"),
    _GOOD + " " + _GOOD,
    _GOOD.replace('"urgency":"high",', ""),
    _GOOD[:-1] + ',"note":"x"}',
    _GOOD.replace('"high"', '"soon"').replace('0.7}', '1.4}'),
    _GOOD.replace(_PLACE, "null") + " ~",
    _GOOD.replace(_PLACE, _NOWHERE).replace('["water","food"]', "[]")
         .replace("help_request", "emotion/prayer").replace("false", "true"),
    _GOOD.replace('["child"]', '["child","cat"]').replace("#", '"three"'),
    '{"needs":["tents"],"post_type":"complaint","dedup_cluster_id":"c#"} ~',
]


def _as_json(text: str) -> Column:
    """A text as a JSON string: an array of one string without its brackets."""
    listed = F.to_json(F.array(text))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model answers in good and broken forms."""
    d = F.col("doc_id")
    numbered = F.replace(_pick(ANSWERS, d % 14), F.lit("#"), d.cast("string"))
    # a form has one of the two marks
    return table(spark, sf_dir, "documents").select(
        d.alias("answer_id"), F.col("source").alias("model"),
        F.when(F.contains(numbered, F.lit("^")), F.replace(numbered, F.lit("^"), _as_json("text")))
         .otherwise(F.replace(numbered, F.lit("~"), F.col("text"))).alias("raw_text"))


ANSWERS_SQL = f"""
form(k, f) AS (VALUES {_numbered(ANSWERS)}),
answers AS (
    SELECT doc_id AS answer_id, source AS model,
        CASE WHEN contains(f, '^') THEN replace(replace(f, '#', CAST(doc_id AS VARCHAR)),
            '^', CAST(to_json(text) AS VARCHAR))
        ELSE replace(replace(f, '#', CAST(doc_id AS VARCHAR)), '~', text) END AS raw_text
    FROM documents JOIN form ON k = doc_id % 14
)"""

# --- generated examples --------------------------------------------------------------


def _example(*turns: str, extra: str = "") -> str:
    return '{"messages":[' + ",".join(turns) + "]" + extra + "}"


def _turn(role: str, content: str) -> str:
    return f'{{"role":"{role}","content":{content}}}'


_SYSTEM, _USER, _ANSWER = _turn("system", '"s"'), _turn("user", "~"), _turn("assistant", '"{}"')
#: example form = doc_id % 12; ~ is the document text as a JSON string. The last form makes
#: a second attempt that is empty.
EXAMPLES = [
    _example(_SYSTEM, _USER, _ANSWER),
    _example(_SYSTEM, _USER, _ANSWER, extra=',"note":1'),
    _example(_USER, _ANSWER),
    _example(_USER, _USER, _ANSWER),
    '{"messages":"~"}'.replace('"~"', "~"),
    "[" + _example(_SYSTEM, _USER, _ANSWER) + "]",
    "~",
    _example(_turn("system", "~"), _turn("user", "5"), _ANSWER),
    "not json ~",
    _example(_SYSTEM, _USER, _ANSWER),
    _example(_turn("system", "~"), _turn("user", '"the same post"'), _ANSWER),
    '{"other":[~]}',
]


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generation attempts, numbered from one."""
    d = F.col("doc_id")
    empty = F.explode(F.when(d % 12 == 11, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    filled = F.replace(_pick(EXAMPLES, d % 12), F.lit("~"), _as_json("text"))
    return table(spark, sf_dir, "documents").select("doc_id", "text", empty.alias("empty")).select(
        (2 * d + F.col("empty") + 1).alias("attempt"),
        F.when(F.col("empty") == 0, filled).otherwise("").alias("raw"))


ATTEMPTS_SQL = f"""
form(k, f) AS (VALUES {_numbered(EXAMPLES)}),
attempts AS (
    SELECT 2 * doc_id + nothing + 1 AS attempt,
        CASE WHEN nothing = 0 THEN replace(f, '~', CAST(to_json(text) AS VARCHAR)) ELSE '' END AS raw
    FROM documents JOIN form ON k = doc_id % 12, (VALUES (0), (1)) e(nothing)
    WHERE nothing = 0 OR k = 11
)"""
