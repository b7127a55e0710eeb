"""Lexical signals of a post.

All word-list signals of a post come from one pass over its folded text:
:func:`find_phrases` returns the phrases that occur, and a signal is then a test on
that short array. Contact and position patterns are separate expressions because
they are not word lists.

Notes on meaning, kept on purpose:

* matching is whole-word, and i, ı and I are the same letter; a capital İ folds to
  i plus a combining dot and therefore does not match a plain i;
* the address token "no" is also an English word, so many English posts count as
  having an address;
* a phone number may be the inside of a longer run of digits;
* short Turkish words collide with English ones ("bot", "mama", "ben", "sel").
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rescuelens import lexicons as lx
from rescuelens.functions import regex, text

# Optional parts around the ten digits (country prefix, trunk zero) cannot change
# whether a number is found, so both phone styles share this pattern.
PHONE = rf"\p{{Nd}}{{3}}[{regex.SPACE}.\-]?\p{{Nd}}{{3}}[{regex.SPACE}.\-]?\p{{Nd}}{{4}}"
# The separator is a comma with any spaces around it, or spaces with at least one
# plain blank among them. One digit before the point and one at the end suffice.
_SEPARATOR = (rf"(?:[{regex.SPACE}]*+,|[{regex.SPACE}&&[^ ]]*+ )[{regex.SPACE}]*+")
COORDINATES = rf"\p{{Nd}}\.\p{{Nd}}++{_SEPARATOR}[-+]?\p{{Nd}}{{1,3}}\.\p{{Nd}}"
RETWEET = rf"^[{regex.SPACE}]*+rt[{regex.SPACE}]++@"
# the whole token: a second address inside it is part of the first
URL = rf"https?://[^{regex.SPACE}]++"

#: names of the helper columns added by :func:`with_signals`
FOLDED, PHRASES = "_folded", "_phrases"


@dataclass(frozen=True)
class SignalRules:
    """Word lists of one corpus, by signal name, and its URL guard."""

    lists: dict[str, tuple[str, ...]]
    guard: tuple[int, int] = lx.GUARD_LOOSE
    forms: dict[str, frozenset[str]] = field(init=False, repr=False, compare=False)

    def __post_init__(self):
        forms = {name: frozenset(map(text.search_form, phrases))
                 for name, phrases in self.lists.items()}
        object.__setattr__(self, "forms", forms)

    @property
    def vocabulary(self) -> frozenset[str]:
        return frozenset().union(*self.forms.values())

    def answering(self, *names: str) -> list[str]:
        """Found phrases that prove one of the named signals.

        Only the longest phrase is reported per position, so a phrase also stands
        for every shorter one it begins with.
        """
        wanted = frozenset().union(*(self.forms[n] for n in names))
        return sorted(p for p in self.vocabulary
                      if p in wanted or any(p.startswith(w + " ") for w in wanted))


def _rules(sos=(), first_person=(), offers=(), location=(), guard=lx.GUARD_LOOSE) -> SignalRules:
    return SignalRules({
        "sos": sos,
        "flood": lx.FLOOD_SOS_TR + lx.FLOOD_SOS_EN,
        "need": lx.NEEDS_TR + lx.NEEDS_EN,
        "hazard": lx.HAZARDS_TR + lx.HAZARDS_EN,
        "first_person": first_person,
        "offer": offers,
        "location_word": location,
        "address": lx.ADDRESS_TOKENS,
    }, guard)


def _without(phrases: Iterable[str], *dropped: str) -> tuple[str, ...]:
    return tuple(p for p in phrases if p not in dropped)


_SOS = lx.SOS_TR + lx.SOS_EN
_FIRST_PERSON = lx.FIRST_PERSON_TR + lx.FIRST_PERSON_EN
_OFFERS = lx.OFFERS_TR + lx.OFFERS_EN

#: event corpus: id, text, class label
EVENT_RULES = _rules(_SOS, _FIRST_PERSON, _OFFERS, lx.LOCATION_WORDS)
#: crisis corpus: id, event, text, language, label; "enkazdayım" is not a first person
CRISIS_RULES = _rules(_SOS, _without(_FIRST_PERSON, "enkazdayım"), _OFFERS, lx.LOCATION_WORDS)
#: tagged corpus: content plus hashtags; a bare "acil" is a plea, fewer other words.
#: A leading # needs no rule of its own: it is not a word character.
TAGGED_RULES = _rules(
    _SOS + ("acil",), _without(_FIRST_PERSON, "my mom", "my dad"), _without(_OFFERS, "bağış yapın"),
    _without(lx.LOCATION_WORDS, "pin", "share location"), lx.GUARD_TIGHT)


def with_dash_offers(rules: SignalRules) -> SignalRules:
    """The same rules, with "drop-off" and "drop off" as offers.

    The word list only holds the bracketed spelling ``drop[- ]off``.
    """
    lists = dict(rules.lists)
    lists["offer"] = lists["offer"] + lx.DROP_OFF_FORMS
    return SignalRules(lists, rules.guard)


# --- expressions --------------------------------------------------------------

def find_phrases(folded: Column, vocabulary: Iterable[str]) -> Column:
    """Phrases of the vocabulary that occur in folded text as whole words."""
    return F.regexp_extract_all(
        F.concat(F.lit(" "), folded), F.lit(regex.every_phrase(vocabulary)), F.lit(1))


def has_any(phrases: Column, wanted: Iterable[str]) -> Column:
    return F.arrays_overlap(phrases, F.array(*[F.lit(w) for w in sorted(wanted)]))


def with_signals(df: DataFrame, text_col: str, rules: SignalRules) -> DataFrame:
    """Add the folded text and the found phrases, each computed once per row."""
    df = text.evaluate_once(
        df, FOLDED, text.fold_for_search(F.coalesce(F.col(text_col), F.lit(""))))
    return text.evaluate_once(df, PHRASES, find_phrases(F.col(FOLDED), rules.vocabulary))


def without_signals(df: DataFrame) -> DataFrame:
    return df.drop(FOLDED, PHRASES)


def signal(rules: SignalRules, *names: str) -> Column:
    """True if one of the named word-list signals is present."""
    return has_any(F.col(PHRASES), rules.answering(*names))


def phone(folded: Column | str = FOLDED) -> Column:
    return text._col(folded).rlike(PHONE)


def coordinates(folded: Column | str = FOLDED) -> Column:
    return text._col(folded).rlike(COORDINATES)


def coordinates_column(c: Column | str) -> Column:
    """A coordinates cell counts as present if it holds any digit."""
    return F.coalesce(text._col(c).rlike(r"\p{Nd}"), F.lit(False))


def phone_or_coordinates(folded: Column | str = FOLDED) -> Column:
    return text._col(folded).rlike(f"{PHONE}|{COORDINATES}")


def address(folded: Column | str) -> Column:
    """Address tokens, for use without :func:`with_signals`."""
    return text._col(folded).rlike(regex.any_phrase(lx.ADDRESS_TOKENS))


def locator(rules: SignalRules) -> Column:
    """Phone, coordinates, address token or location word. Cheap tests first."""
    return signal(rules, "address", "location_word") | phone_or_coordinates()


def retweet(folded: Column | str = FOLDED) -> Column:
    return text._col(folded).rlike(RETWEET)


def url_count(folded: Column | str = FOLDED) -> Column:
    return F.regexp_count(text._col(folded), F.lit(URL))


def enough_text(rules: SignalRules, folded: Column | str = FOLDED) -> Column:
    """URL guard: characters left after charging a fixed price per URL."""
    price, floor = rules.guard
    c = text._col(folded)
    return (F.length(c) > floor) & (F.length(c) - url_count(c) * price > floor)
