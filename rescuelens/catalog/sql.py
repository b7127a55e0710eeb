"""Pieces of the check queries: the same rules in another SQL dialect.

That dialect's regular expressions have no look-around, so a word boundary consumes the
neighbouring character, and ı and i are only equal after folding.
"""

from __future__ import annotations

from rescuelens import lexicons as lx
from rescuelens.catalog.relations import POSTS_SQL, quoted

_NOT_WORD = r"[^\p{L}\p{N}_]"


def _escape(text: str) -> str:
    return "".join("\\" + c if c in r"\.[]{}()*+-?^$|" else c for c in text)


def alternatives(phrases) -> str:
    return "|".join(_escape(p) for p in sorted(set(phrases), key=lambda p: (-len(p), p)))


def folded(column: str) -> str:
    """Case folding, as far as the texts here need it."""
    return f"replace(lower(replace(coalesce({column}, ''), 'İ', 'i̇')), 'ß', 'ss')"


def for_search(column: str) -> str:
    return f"replace({folded(column)}, 'ı', 'i')"


def caseless(column: str) -> str:
    """Folding of the labeller: every kind of i is the same letter."""
    return f"replace(lower(replace({column}, 'İ', 'i')), 'ı', 'i')"


def has(column: str, phrases) -> str:
    forms = {p.replace("İ", "i").lower().replace("ı", "i") for p in phrases}
    pattern = f"(^|{_NOT_WORD})({alternatives(forms)})({_NOT_WORD}|$)"
    return f"regexp_matches({column}, {quoted(pattern)})"


def stripped(column: str) -> str:
    return rf"regexp_replace({column}, '^\s+|\s+$', '', 'g')"


def collapsed(column: str) -> str:
    return rf"regexp_replace({column}, '\s+', ' ', 'g')"


PHONE = r"\p{Nd}{3}[\s.\-]?\p{Nd}{3}[\s.\-]?\p{Nd}{4}"
COORDINATES = r"[-+]?\p{Nd}{1,2}\.\p{Nd}+\s*[, ]\s*[-+]?\p{Nd}{1,3}\.\p{Nd}+"

_SOS = lx.SOS_TR + lx.SOS_EN
_PERSON = lx.FIRST_PERSON_TR + lx.FIRST_PERSON_EN
_OFFERS = lx.OFFERS_TR + lx.OFFERS_EN
_LISTS = {
    "event": (_SOS, _PERSON, _OFFERS, lx.LOCATION_WORDS, lx.GUARD_LOOSE),
    "crisis": (_SOS, tuple(p for p in _PERSON if p != "enkazdayım"), _OFFERS,
               lx.LOCATION_WORDS, lx.GUARD_LOOSE),
    "tagged": (_SOS + ("acil",), tuple(p for p in _PERSON if p not in ("my mom", "my dad")),
               tuple(p for p in _OFFERS if p != "bağış yapın"),
               tuple(p for p in lx.LOCATION_WORDS if p not in ("pin", "share location")),
               lx.GUARD_TIGHT),
}


def signals(corpus: str, text: str = "post_text") -> str:
    """Common table expressions ``posts``, ``folded`` and ``sig`` (posts plus signals)."""
    sos, person, offers, location, (price, floor) = _LISTS[corpus]
    urls = r"len(regexp_extract_all(f, 'https?://\S+'))"
    return f"""{POSTS_SQL},
folded AS (SELECT *, {for_search(text)} AS f FROM posts),
sig AS (
    SELECT *, {has('f', sos)} AS sos,
        {has('f', lx.FLOOD_SOS_TR + lx.FLOOD_SOS_EN)} AS flood,
        {has('f', lx.NEEDS_TR + lx.NEEDS_EN)} AS need,
        {has('f', lx.HAZARDS_TR + lx.HAZARDS_EN)} AS hazard,
        {has('f', person)} AS first_person,
        {has('f', offers)} AS offer,
        {has('f', location)} AS location_word,
        {has('f', lx.ADDRESS_TOKENS)} AS address,
        regexp_matches(f, '{PHONE}') AS phone,
        regexp_matches(f, '{COORDINATES}') AS coord,
        regexp_matches(f, '^\\s*rt\\s+@') AS retweet,
        {urls} AS urls, length(f) - {urls} * {price} > {floor} AS enough
    FROM folded
)"""


LOCATOR = "(phone OR coord OR address OR location_word)"
MODES = {
    "strict": f"(sos AND {LOCATOR}) OR (need AND {LOCATOR} AND (first_person OR hazard))",
    "recall": f"sos OR flood OR (need AND (first_person OR hazard OR {LOCATOR}))",
}
MODES["balanced"] = (f"({MODES['strict']}) OR (sos AND (first_person OR hazard)) "
                     f"OR (flood AND (first_person OR {LOCATOR} OR hazard))")


def kept(mode: str) -> str:
    return f"({MODES[mode]}) AND NOT offer AND enough"


TAGGED_KEPT = ("sos AND (phone OR coord OR coalesce(regexp_matches(coordinates, '[0-9]'), false)"
               " OR address OR location_word) AND NOT offer AND NOT retweet AND enough")
