"""Tables of model answers: find the JSON, parse, check against the schema, repair.

An answer counts as valid JSON if its text from the first ``{`` to the last ``}`` is
one strict JSON object. Wrapping it in brackets lets the array length tell one object
from several in a row. Unlike a lenient parser, this one rejects repeated keys and NaN.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rescuelens import lexicons as lx
from rescuelens.functions import text
from rescuelens.operators.labels import LABEL_DDL

NO_OBJECT = "no_object"
BAD_JSON = "bad_json"

_ENVELOPE = "_answer"


def json_slice(c: Column | str) -> Column:
    """Text from the first ``{`` to the last ``}``; null if there is no such stretch."""
    column = text._col(c)
    start = F.instr(column, "{")
    after = F.length(column) - F.instr(F.reverse(column), "}") + 1
    found = (start > 0) & F.contains(column, F.lit("}")) & (after > start)
    return F.when(found, F.substring(column, start, after - start + 1))


def _in_brackets(json: Column) -> Column:
    """The text as a parsed array, which tells one object from several in a row."""
    return F.try_parse_json(F.concat(F.lit("["), json, F.lit("]")))


def _first(listed: Column) -> Column:
    """Its only element; null if there are more, or none."""
    return F.when(F.try_variant_get(listed, "$[1]", "variant").isNull(), F.try_variant_get(listed, "$[0]", "variant"))


def with_envelope(df: DataFrame, raw_col: str, value: str | None = None) -> DataFrame:
    """Add ``raw_text, is_json, parsed, error``. Bad answers stay in the table as data.

    ``parsed`` is the JSON text, ready for ``from_json``. It is parsed once; ``value`` names a column
    that keeps what came of it.
    """
    df = text.evaluate_once(df, "_json", json_slice(F.coalesce(F.col(raw_col), F.lit(""))))
    df = text.evaluate_once(df, "_listed", _in_brackets(F.col("_json")))
    df = text.evaluate_once(df, "_value", F.when(F.startswith("_json", F.lit("{")), _first(F.col("_listed"))))
    valid = F.col("_value").isNotNull()
    return df.select(
        *[F.col(c) for c in df.columns if c not in ("_json", "_listed", "_value", raw_col)],
        F.col(raw_col).alias("raw_text"), valid.alias("is_json"),
        F.when(valid, F.col("_json")).alias("parsed"),
        F.when(F.col("_json").isNull(), NO_OBJECT).when(~valid, BAD_JSON).alias("error"),
        *([F.col("_value").alias(value)] if value else []))


def valid_rate(df: DataFrame, by: str) -> DataFrame:
    """Answers and share of valid JSON per group, from an envelope table."""
    return df.groupBy(by).agg(
        F.count("*").alias("answers"), F.count_if("is_json").alias("valid"),
        F.avg(F.col("is_json").cast("int")).alias("valid_rate"))


# --- schema check ----------------------------------------------------------------

class Profile:
    """What one of the label vocabularies allows. ``None`` for needs: an open list."""

    def __init__(self, needs, post_types, cluster_key: bool):
        self.needs, self.post_types = needs, post_types
        self.keys = lx.LABEL_KEYS + ((lx.CLUSTER_KEY,) if cluster_key else ())


RUNTIME = Profile(None, lx.RUNTIME_POST_TYPES, cluster_key=False)
CORRECTED = Profile(lx.CORRECTED_NEEDS, lx.CORRECTED_POST_TYPES, cluster_key=True)

_FIELDS = "map<string,variant>"
_WHOLE = r"^(BIGINT|DECIMAL\([0-9]+,0\))$"
_NUMBER = r"^(BIGINT|DOUBLE|FLOAT|DECIMAL\(.*\))$"


def with_violations(df: DataFrame, json_col: str, profile: Profile,
                    name: str = "violations", value: str | None = None) -> DataFrame:
    """Add the broken rules of a JSON label, as ``field:rule`` texts in schema order.

    Rules: ``missing`` key, wrong ``type``, ``value`` outside the vocabulary or range,
    and one ``extra:<key>`` for every key the schema does not have. A text that is no
    object gives the single entry ``object``.

    The text is parsed once, or not at all where ``value`` names a column of parsed answers; all
    checks read that value and its two maps of keys.
    """
    json = F.col(json_col)
    if value is None:
        df = text.evaluate_once(df, "_listed", _in_brackets(json))
        parsed = F.when(F.startswith(json, F.lit("{")), _first(F.col("_listed")))
    else:
        parsed = F.col(value)
    df = text.evaluate_once(df, "_top", F.try_variant_get(parsed, "$", _FIELDS))
    df = text.evaluate_once(df, "_place", F.try_variant_get(F.col("_top")["location"], "$", _FIELDS))

    def value_of(path: str) -> Column:
        names = path.split(".")
        return F.col("_top" if len(names) == 2 else "_place")[names[-1]]

    def kind(path: str) -> Column:
        return F.schema_of_variant(value_of(path))

    def field(path: str, types: str, rule: Column | None = None) -> Column:
        label = F.lit(path[2:])
        check = (F.when(value_of(path).isNull(), F.concat(label, F.lit(":missing")))
                 .when(~kind(path).rlike(types), F.concat(label, F.lit(":type"))))
        if rule is not None:
            check = check.when(~F.coalesce(rule, F.lit(True)), F.concat(label, F.lit(":value")))
        return check

    def string(path: str) -> Column:
        return F.try_variant_get(value_of(path), "$", "string")

    def share(path: str) -> Column:
        return F.try_variant_get(value_of(path), "$", "double").between(0.0, 1.0)

    def all_in(path: str, allowed) -> Column:
        values = F.try_variant_get(value_of(path), "$", "array<string>")
        return F.size(F.array_except(values, F.array(*map(F.lit, allowed)))) == 0

    text_list = r"^ARRAY<(STRING|VOID)>$"
    nullable_text = r"^(STRING|VOID)$"
    is_place = F.col("_place").isNotNull()
    checks = [
        field("$.needs", text_list, all_in("$.needs", profile.needs) if profile.needs else None),
        field("$.urgency", "^STRING$", string("$.urgency").isin(*lx.URGENCY_VALUES)),
        field("$.life_threatening", "^BOOLEAN$"),
        field("$.location", "^OBJECT"),
        *[F.when(is_place, field(f"$.location.{k}", nullable_text))
          for k in lx.LOCATION_KEYS[:-1]],
        F.when(is_place, field("$.location.geo_confidence", _NUMBER,
                               share("$.location.geo_confidence"))),
        field("$.people_count", r"^VOID$|" + _WHOLE),
        field("$.vulnerable_groups", text_list,
              all_in("$.vulnerable_groups", lx.GROUP_VALUES)),
        field("$.post_type", "^STRING$", string("$.post_type").isin(*profile.post_types)),
        field("$.confidence", _NUMBER, share("$.confidence")),
    ]
    if lx.CLUSTER_KEY in profile.keys:
        checks.append(field(f"$.{lx.CLUSTER_KEY}", nullable_text))
    unknown = F.array_except(F.map_keys("_top"), F.array(*map(F.lit, profile.keys)))
    extra = F.transform(F.array_sort(unknown), lambda k: F.concat(F.lit("extra:"), k))
    return df.withColumn(name, F.when(
        F.col("_top").isNotNull(), F.concat(F.array_compact(F.array(*checks)), extra)
    ).otherwise(F.array(F.lit("object")))).drop("_listed", "_top", "_place")


def parse_label(json: Column) -> Column:
    """JSON label as the typed struct. A field of the wrong type becomes null."""
    return F.from_json(json, LABEL_DDL)


def label_of(value: Column) -> Column:
    """The same from a parsed answer. A field of another type than the schema's is null."""
    def typed(path: str, types: str, target: str) -> Column:
        kind = F.schema_of_variant(F.try_variant_get(value, path, "variant"))
        return F.when(kind.rlike(types), F.try_variant_get(value, path, target))

    def field(struct: T.StructType, prefix: str) -> list[Column]:
        out = []
        for f in struct.fields:
            path, name = f"{prefix}.{f.name}", f.dataType.simpleString()
            if isinstance(f.dataType, T.StructType):
                is_object = F.schema_of_variant(F.try_variant_get(value, path, "variant")).startswith("OBJECT")
                out.append(F.when(is_object, F.struct(*field(f.dataType, path))).alias(f.name))
            else:
                out.append(typed(path, _KINDS[name], name).alias(f.name))
        return out

    return F.when(value.isNotNull(), F.struct(*field(T.StructType.fromDDL(LABEL_DDL), "$")))


_KINDS = {"string": "^STRING$", "boolean": "^BOOLEAN$", "double": _NUMBER, "bigint": _WHOLE,
          "array<string>": "^ARRAY<"}


# --- defaults, translation, repair ---------------------------------------------------

def with_defaults(label: Column) -> Column:
    """Missing lists become empty, a missing location an empty one; scalars stay null."""
    place = label["location"]
    return F.struct(
        F.coalesce(label["needs"], F.array().cast("array<string>")).alias("needs"),
        label["urgency"].alias("urgency"),
        label["life_threatening"].alias("life_threatening"),
        F.struct(*[place[k].alias(k) for k in lx.LOCATION_KEYS]).alias("location"),
        label["people_count"].alias("people_count"),
        F.coalesce(label["vulnerable_groups"], F.array().cast("array<string>")
                   ).alias("vulnerable_groups"),
        label["post_type"].alias("post_type"),
        label["confidence"].alias("confidence"),
        label[lx.CLUSTER_KEY].alias(lx.CLUSTER_KEY))


def repair_label(label: Column) -> Column:
    """Fill what is missing, then apply the rules that need no judgement.

    * no place named: geo confidence is 0;
    * a prayer or complaint without needs: urgency low, no threat to life, confidence
      at most 0.3;
    * the cluster id is never changed.
    """
    full = with_defaults(label)
    place = full["location"]
    nowhere = F.coalesce(*[place[k] for k in lx.LOCATION_KEYS[:-1]]).isNull()
    quiet = (F.coalesce(full["post_type"].isin("emotion/prayer", "complaint"), F.lit(False))
             & (F.size(full["needs"]) == 0))
    place = place.withField("geo_confidence", F.when(nowhere, 0.0).otherwise(
        F.coalesce(place["geo_confidence"], F.lit(0.0))))
    return (full.withField("location", place)
            .withField("urgency", F.when(quiet, "low").otherwise(full["urgency"]))
            .withField("life_threatening",
                       F.when(quiet, False).otherwise(full["life_threatening"]))
            .withField("confidence", F.when(quiet, F.least(full["confidence"], F.lit(0.3)))
                       .otherwise(full["confidence"])))


def _translation(table: dict[str, str | None]):
    """Lookup expression; values the table does not know stay as they are."""
    def lookup(c: Column) -> Column:
        result = None
        for source, target in table.items():
            result = (F if result is None else result).when(c == source, F.lit(target))
        return result.otherwise(c)
    return lookup


def translate_label(label: Column) -> Column:
    """Labeller vocabulary to the corrected one; repeated or dropped needs collapse."""
    needs = F.transform(label["needs"], _translation(lx.NEED_TRANSLATION))
    groups = F.transform(label["vulnerable_groups"], _translation(lx.GROUP_TRANSLATION))
    return (label.withField("needs", F.array_distinct(F.array_compact(needs)))
            .withField("vulnerable_groups", groups)
            .withField("post_type", _translation(lx.POST_TYPE_TRANSLATION)(label["post_type"])))
