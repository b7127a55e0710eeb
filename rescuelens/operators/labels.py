"""Rule-based labels of a post: needs, urgency, people, place, kind, confidence.

All cue lists are searched in one pass over the folded text. Because every cue is a
literal phrase, that pass yields the set of cues present, and the labels are tests
on that small set. Surface spans (evidence, province, district) are cut from the
unfolded text, and only in rows where the cue is known to occur.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rescuelens import lexicons as lx
from rescuelens.functions import regex, text
from rescuelens.functions.signals import find_phrases, has_any

#: columns added by :func:`with_cues`
CLEAN, FOLDED, CUES = "_clean", "_caseless", "_cues"

# Letters of place names, and the patterns of district, address and neighborhood below.
_UPPER = "A-ZÇĞİIÖŞÜ"
_LETTER = "A-Za-zÇĞİIÖŞÜçğıiöşü"


def _flat(groups) -> list[str]:
    return [form for cue in groups for form in cue]


def _all_cues() -> list[str]:
    grouped = [*lx.NEED_CUES.values(), lx.CRITICAL_CUES, lx.HIGH_CUES,
               *lx.VULNERABLE_CUES.values()]
    return ([f for g in grouped for f in _flat(g)]
            + list(lx.REQUEST_CUES + lx.OFFER_CUES + lx.COMPLAINT_CUES + lx.PRAYER_CUES)
            + list(lx.PROVINCES + lx.ADDRESS_PHRASE_WORDS + lx.NEIGHBORHOOD_WORDS))


_VOCABULARY = frozenset(map(text.search_form, _all_cues()))


def with_cues(df: DataFrame, text_col: str) -> DataFrame:
    """Add clean text, its folded form and the cues found, each computed once."""
    df = text.with_norm_text(df, text_col, CLEAN)
    df = text.evaluate_once(df, FOLDED, text.fold_letters(CLEAN))
    return text.evaluate_once(df, CUES, find_phrases(F.col(FOLDED), _VOCABULARY))


def without_cues(df: DataFrame) -> DataFrame:
    return df.drop(CLEAN, FOLDED, CUES)


def mentions(forms) -> Column:
    """True if one of the phrases occurs. A found longer cue stands for its beginning."""
    wanted = {text.search_form(f) for f in forms}
    proofs = [p for p in _VOCABULARY
              if p in wanted or any(p.startswith(w + " ") for w in wanted)]
    return has_any(F.col(CUES), proofs)


def _first_span(groups) -> Column:
    """Surface of the first cue, in cue order, that occurs; null if none does."""
    spans = [F.when(mentions(cue), F.regexp_substr(CLEAN, F.lit(regex.caseless_words(cue))))
             for cue in groups]
    return F.coalesce(*spans)


def _listing(labels: dict[str, str], groups: dict) -> Column:
    return F.array_compact(F.array(*[
        F.when(mentions(_flat(groups[name])), F.lit(label)) for name, label in labels.items()]))


def _evidence(groups: dict) -> Column:
    return F.array_distinct(F.array_compact(F.array(*map(_first_span, groups.values()))))


# --- single labels -------------------------------------------------------------

def needs() -> Column:
    return _listing(lx.NEED_LABELS, lx.NEED_CUES)


def has_needs() -> Column:
    return mentions([f for g in lx.NEED_CUES.values() for f in _flat(g)])


def need_evidence() -> Column:
    return _evidence(lx.NEED_CUES)


def vulnerable_groups() -> Column:
    return _listing(lx.GROUP_LABELS, lx.VULNERABLE_CUES)


def has_vulnerable() -> Column:
    return mentions([f for g in lx.VULNERABLE_CUES.values() for f in _flat(g)])


def vulnerable_evidence() -> Column:
    return _evidence(lx.VULNERABLE_CUES)


def is_critical() -> Column:
    return mentions(_flat(lx.CRITICAL_CUES)) | F.col(CLEAN).contains(lx.CRITICAL_MARK)


def is_high() -> Column:
    """High cue present; says nothing about critical ones, which take precedence."""
    return mentions(_flat(lx.HIGH_CUES))


def urgency() -> Column:
    return F.when(is_critical(), "critical").when(is_high(), "high").otherwise("normal")


def urgency_evidence() -> Column:
    """Surface of the cue that decided the urgency, as an array of at most one."""
    mark = F.when(F.col(CLEAN).contains(lx.CRITICAL_MARK), F.lit(lx.CRITICAL_MARK))
    span = F.coalesce(_first_span(lx.CRITICAL_CUES), mark, _first_span(lx.HIGH_CUES))
    return F.array_compact(F.array(span))


def life_threatening() -> Column:
    return is_critical() | mentions(_flat(lx.NEED_CUES["search_rescue"]))


def people_count() -> Column:
    """First number followed by a word for people. Null beyond the range of bigint."""
    nouns = {text.search_form(w) for w in lx.PEOPLE_WORDS}
    pattern = rf"(?<!\p{{Nd}})(\p{{Nd}}++)[{regex.SPACE}]*+(?:{'|'.join(sorted(nouns))})"
    return text.to_long(text.empty_to_null(F.regexp_extract(FOLDED, pattern, 1)))


def post_type() -> Column:
    """Offer, request, complaint, prayer, else information, in this precedence.

    A request word outranks a complaint, so "yardım gelmedi" never decides.
    """
    return (F.when(mentions(lx.OFFER_CUES), lx.POST_OFFER)
            .when(has_needs() | mentions(lx.REQUEST_CUES) | is_critical() | is_high(),
                  lx.POST_REQUEST)
            .when(mentions(lx.COMPLAINT_CUES), lx.POST_COMPLAINT)
            .when(mentions(lx.PRAYER_CUES), lx.POST_PRAYER)
            .otherwise(lx.POST_INFO))


def confidence() -> Column:
    tenths = (F.when(has_needs(), 4).otherwise(2)
              + F.when(is_critical(), 3).when(is_high(), 2).otherwise(0)
              + F.when(has_vulnerable(), 1).otherwise(0))
    return F.least(tenths / F.lit(10.0), F.lit(0.95))


# --- place -----------------------------------------------------------------------

def with_location(df: DataFrame, name: str = "location") -> DataFrame:
    """Add the location struct.

    One split at the leftmost province name gives the text before and after it; the
    surface of the name is what lies between.
    """
    clean = F.col(CLEAN)
    around = F.when(mentions(lx.PROVINCES),
                    F.split(clean, regex.caseless_words(lx.PROVINCES), 2))
    df = text.evaluate_once(df, "_around", around)
    head, tail = F.try_element_at("_around", F.lit(1)), F.try_element_at("_around", F.lit(2))
    surface = F.substring(clean, F.length(head) + 1,
                          F.length(clean) - F.length(head) - F.length(tail))
    province = F.initcap(surface)

    word_after = text.empty_to_null(F.regexp_extract(tail, rf"([{_UPPER}][{_LETTER}\-]{{3,}})", 1))
    district = F.when(~F.lower(word_after).isin(*lx.NOT_A_DISTRICT), text.title_case(word_after))

    nearby = F.concat(F.right(head, F.lit(lx.NOTE_BEFORE)), surface,
                      F.left(tail, F.lit(lx.NOTE_AFTER)))
    words = "|".join(sorted(lx.ADDRESS_PHRASE_WORDS, key=len, reverse=True))
    phrase = (rf"[{_UPPER}][^\n,]{{0,60}}{regex.BEFORE}(?:{words}){regex.AFTER}[^\n,]{{0,40}}")
    note = F.when(head.isNotNull(), nearby).when(
        mentions(lx.ADDRESS_PHRASE_WORDS), F.regexp_substr(clean, F.lit(phrase)))

    hood_words = "|".join(sorted(lx.NEIGHBORHOOD_WORDS, key=len, reverse=True))
    hood = (rf"{regex.BEFORE}([{_LETTER}][{_LETTER}\-]{{2,}})[{regex.SPACE}]++"
            rf"(?iu:{hood_words}){regex.AFTER}")
    neighborhood = F.when(mentions(lx.NEIGHBORHOOD_WORDS), text.title_case(
        text.empty_to_null(F.regexp_extract(clean, hood, 1))))

    # the parts are computed once, then read twice: as fields and for the confidence
    parts = F.struct(
        province.alias("province"), district.alias("district"),
        neighborhood.alias("neighborhood"), text.empty_to_null(text.strip(note)).alias("note"))
    df = text.evaluate_once(df, "_place", parts)
    p = {k: F.col(f"_place.{k}") for k in ("province", "district", "neighborhood", "note")}
    geo = (F.when(p["province"].isNotNull()
                  & (p["district"].isNotNull() | p["neighborhood"].isNotNull()), 0.8)
           .when(p["province"].isNotNull(), 0.6)
           .when(p["neighborhood"].isNotNull() | p["note"].isNotNull(), 0.3)
           .otherwise(0.0))
    return df.withColumn(name, F.struct(
        F.when(p["province"].isNotNull(), lx.COUNTRY).alias("country"),
        p["province"].alias("province"), p["district"].alias("district"),
        p["neighborhood"].alias("neighborhood"), p["note"].alias("address_note"),
        geo.alias("geo_confidence"))).drop("_around", "_place")


# --- whole record ------------------------------------------------------------------

LABEL_DDL = """
    needs array<string>, urgency string, life_threatening boolean,
    location struct<country: string, province: string, district: string,
        neighborhood: string, address_note: string, geo_confidence: double>,
    people_count bigint, vulnerable_groups array<string>,
    post_type string, confidence double, dedup_cluster_id string
"""


def label_posts(df: DataFrame, text_col: str, keep: list[str] | None = None,
                fields: Sequence[str] | None = None) -> DataFrame:
    """One training pair per post: ``user`` text and the ``assistant`` label struct.

    ``keep`` names columns to carry along. ``fields`` names the parts of the label that are
    wanted; what only others need is not computed. With the cluster id in the label, the whole
    cluster digest is added as a column of its own for splitting (the sink drops it).
    """
    makers = {
        "needs": needs, "urgency": urgency, "life_threatening": life_threatening,
        "location": lambda: F.col("location"), "people_count": people_count,
        "vulnerable_groups": vulnerable_groups, "post_type": post_type, "confidence": confidence,
        "dedup_cluster_id": lambda: text.cluster_label("_cluster")}
    wanted = [name for name in makers if fields is None or name in fields]
    df = with_cues(df, text_col)
    clustered = "dedup_cluster_id" in wanted
    if clustered:
        df = text.with_cluster_digest(df, CLEAN, "_cluster")
    if "location" in wanted:
        df = with_location(df)
    label = F.struct(*[makers[name]().alias(name) for name in wanted])
    return df.select(*(keep or []), F.col(CLEAN).alias("user"), label.alias("assistant"),
                     *(["_cluster"] if clustered else []))


def map_records(df: DataFrame, labeller, schema: str) -> DataFrame:
    """Apply a caller's batch labeller, pandas frame in and out, over the whole table."""
    def batches(frames):
        for frame in frames:
            yield labeller(frame)
    return df.mapInPandas(batches, schema)

