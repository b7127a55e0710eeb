"""Which posts are likely calls for help.

Each mode is written so that every signal occurs once and the cheapest test comes
first: the tests on found phrases are short array lookups, and the whole-text
patterns (phone, coordinates) are reached only by posts that need them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rescuelens import lexicons as lx
from rescuelens.functions import signals as sg
from rescuelens.functions import text

MODES = ("strict", "balanced", "recall")


def base_rule(rules: sg.SignalRules, mode: str) -> Column:
    """The mode's rule before offers, retweets and the URL guard."""
    person_or_hazard = sg.signal(rules, "first_person", "hazard")
    need_in_context = sg.signal(rules, "need") & person_or_hazard
    if mode == "strict":
        # a plea, or a need with a person or hazard; both need a locator
        return (sg.signal(rules, "sos") | need_in_context) & sg.locator(rules)
    if mode == "balanced":
        # a plea (also a flood plea) with any context; a need with a locator and more
        plea = sg.signal(rules, "sos", "flood")
        return F.when(plea, person_or_hazard | sg.locator(rules)).otherwise(
            need_in_context & sg.locator(rules))
    if mode == "recall":
        return sg.signal(rules, "sos", "flood") | (
            sg.signal(rules, "need") & (person_or_hazard | sg.locator(rules)))
    raise ValueError(f"mode must be one of {MODES}, not {mode!r}")


def help_mask(rules: sg.SignalRules, mode: str = "balanced",
              allow_retweets: bool = True) -> Column:
    """Mask for the event and crisis corpora, over :func:`signals.with_signals`.

    Allowed retweets have to match the rule like any other post, so allowing them
    adds no test.
    """
    keep = base_rule(rules, mode) & ~sg.signal(rules, "offer") & sg.enough_text(rules)
    return keep if allow_retweets else keep & ~sg.retweet()


def tagged_help_mask(coordinates_col: str | None = "coordinates",
                     rules: sg.SignalRules = sg.TAGGED_RULES) -> Column:
    """Strict mask of the tagged corpus: a plea with a locator, never a retweet.

    A plea with a first person and a phone or position adds nothing to that.
    """
    located = sg.signal(rules, "address", "location_word")
    if coordinates_col is not None:
        located = located | sg.coordinates_column(coordinates_col)
    located = located | sg.phone_or_coordinates()
    return (sg.signal(rules, "sos") & ~sg.signal(rules, "offer") & ~sg.retweet()
            & located & sg.enough_text(rules))


def keep_help_posts(df: DataFrame, text_col: str, rules: sg.SignalRules,
                    mode: str = "balanced", allow_retweets: bool = True) -> DataFrame:
    """Posts that pass the mask, with the helper signal columns still attached."""
    return sg.with_signals(df, text_col, rules).filter(help_mask(rules, mode, allow_retweets))


def combined_text(content: str = "content", hashtags: str | None = "hashtags") -> Column:
    """Content, one blank, hashtags. The blank stays when either is missing."""
    tags = F.coalesce(F.col(hashtags), F.lit("")) if hashtags else F.lit("")
    return F.concat(F.coalesce(F.col(content), F.lit("")), F.lit(" "), tags)


def in_languages(c: str, languages=lx.KEEP_LANGUAGES) -> Column:
    return text.fold(F.col(c)).isin(*languages)


def in_window(c: str | None, start=None, end=None) -> Column:
    """Inclusive time window; each end optional, no window or no column keeps all.

    With a window set, a missing date fails it.
    """
    if c is None or (start is None and end is None):
        return F.lit(True)
    tests = []
    if start is not None:
        tests.append(F.col(c) >= F.lit(start).cast("timestamp"))
    if end is not None:
        tests.append(F.col(c) <= F.lit(end).cast("timestamp"))
    return F.coalesce(tests[0] if len(tests) == 1 else tests[0] & tests[1], F.lit(False))


def audit_flags(df: DataFrame, rules: sg.SignalRules) -> DataFrame:
    """Flags of the kept posts of the event and crisis corpora."""
    return df.withColumns({
        "_sos": sg.signal(rules, "sos"),
        "_flood": sg.signal(rules, "flood"),
        "_need": sg.signal(rules, "need"),
        "_haz": sg.signal(rules, "hazard"),
    })


def tagged_audit_flags(df: DataFrame, coordinates_col: str | None = "coordinates",
                       rules: sg.SignalRules = sg.TAGGED_RULES) -> DataFrame:
    """Flags of the kept posts of the tagged corpus."""
    position = sg.coordinates()
    if coordinates_col is not None:
        position = sg.coordinates_column(coordinates_col) | position
    return df.withColumns({
        "_hit_sos": sg.signal(rules, "sos"),
        "_hit_phone": sg.phone(),
        "_hit_coord": position,
        "_hit_addr": sg.signal(rules, "address"),
        "_hit_locw": sg.signal(rules, "location_word"),
        "_first_person": sg.signal(rules, "first_person"),
    })
