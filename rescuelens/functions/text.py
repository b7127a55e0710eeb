"""Text functions as column expressions: folding, normalising, fingerprints."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rescuelens import lexicons as lx
from rescuelens.functions.regex import SPACE


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _code_points():
    return (chr(i) for i in range(sys.maxunicode + 1) if not 0xD800 <= i <= 0xDFFF)


def _range_list(chars) -> list[list[int]]:
    ranges: list[list[int]] = []
    for p in sorted(map(ord, chars)):
        if ranges and p == ranges[-1][1] + 1:
            ranges[-1][1] = p
        else:
            ranges.append([p, p])
    return ranges


def _ranges(ranges) -> str:
    return "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in ranges)


# one character from each block that fills most non-ASCII text
_FREQUENT = "éğş’αжमک中あ가"
_EMOJI = ord("😀")


def _run_around(point: int, taken: list[list[int]]) -> list[int] | None:
    """Longest run of code points around one that touches no taken range."""
    if any(a <= point <= b for a, b in taken):
        return None
    return [max((b + 1 for a, b in taken if b < point), default=0),
            min((a - 1 for a, b in taken if a > point), default=sys.maxunicode)]


def may_hold(c: Column, chars) -> Column:
    """True if the text holds one of a large set of characters.

    A class of hundreds of ranges is slow, so single ranges come first and rule out
    ASCII and the runs around frequent letters; only what is left meets the whole set.
    (The first range is a positive one: a negated class is several times slower.) A
    look-behind sees only half of a character outside the basic plane, so there every
    character that is not an emoji counts as one of the set, if the set has any there.
    """
    points = _range_list(chars)
    low = [r for r in points if r[1] <= 0xFFFF]
    runs = []
    for run in (_run_around(ord(f), low + [[0xD800, 0x10FFFF]]) for f in _FREQUENT):
        if run is not None and run not in runs:
            runs.append(run)
    skips = "".join(f"(?<![{_ranges([r])}])" for r in runs)
    found = c.rlike(rf"[\x{{80}}-\x{{FFFF}}]{skips}(?<=[{_ranges(low)}])")
    if len(low) < len(points):
        a, b = _run_around(_EMOJI, points)
        found = found | c.rlike(f"[{_ranges([[0x10000, a - 1], [b + 1, 0x10FFFF]])}]")
    return found


# --- white space ----------------------------------------------------------

_SPACES = "".join(c for c in _code_points() if c.isspace())


def strip(c: Column | str) -> Column:
    """Remove white space at both ends (every Unicode space, not only blanks)."""
    return F.btrim(_col(c), F.lit(_SPACES))


def collapse_spaces(c: Column | str) -> Column:
    """Every run of white space becomes one blank; single blanks are left alone."""
    runs = rf" [{SPACE}]++|[{SPACE}&&[^ ]][{SPACE}]*+"
    return F.regexp_replace(_col(c), runs, " ")


# --- case -----------------------------------------------------------------

@lru_cache(maxsize=1)
def _fold_extras() -> dict[str, str]:
    """Lower-case characters that full case folding still changes (ß, ς, ligatures)."""
    return {c: c.casefold() for c in _code_points()
            if c.lower() == c and c.casefold() != c}


# a code point that is never assigned to a character
_PARKED = "\ufdd0"


def fold(c: Column | str) -> Column:
    """Full Unicode case folding.

    ASCII rows take the cheap branch, and of the others only those with a character
    that lower case leaves unfolded take the long way, through upper case. There,
    ı is set aside, since its upper case is a plain I. Everything stays in generated
    code: a higher-order function here would take the whole stage out of it.
    """
    extras = _fold_extras()
    text = _col(c)
    low = F.lower(text)
    # what upper case and back does not fold: final sigma and the Cherokee letters
    left = {x: y for x, y in extras.items() if len(y) == 1 and x.upper().lower() != y}
    left["ς"] = "σ"
    # (taking ı back between the two also keeps the optimiser from merging them)
    raised = F.translate(F.upper(F.translate(low, "ı", _PARKED)), _PARKED, "ı")
    long_way = F.translate(F.lower(raised), "".join(left), "".join(left.values()))
    return (F.when(F.length(text) == F.octet_length(text), low)
            .when(may_hold(low, set(extras) - {"ß"}), long_way)
            .otherwise(F.replace(low, F.lit("ß"), F.lit("ss"))))


def dotless(c: Column | str) -> Column:
    """Map ı to i, which case-insensitive search treats as the same letter."""
    return F.replace(_col(c), F.lit("ı"), F.lit("i"))


def _unless_ascii(text: Column, otherwise: Column) -> Column:
    """Plain lower case for ASCII rows, which need nothing else."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(otherwise)


def fold_for_search(c: Column | str) -> Column:
    """Folding under which the signal word lists are compared."""
    return _unless_ascii(_col(c), dotless(fold(c)))


def fold_letters(c: Column | str) -> Column:
    """Length-preserving folding for the labeller, where İ, I, ı and i are equal."""
    return _unless_ascii(
        _col(c), dotless(F.lower(F.replace(_col(c), F.lit("İ"), F.lit("i")))))


def search_form(phrase: str) -> str:
    """The form a word-list phrase takes in text folded for search."""
    return phrase.replace("İ", "i").casefold().replace("ı", "i")


def title_case(c: Column | str) -> Column:
    """Capitalise every word, also after a hyphen (a word may have several)."""
    word = _col(c)
    return F.when(word.contains("-"), F.replace(
        F.initcap(F.replace(word, F.lit("-"), F.lit("- "))), F.lit("- "), F.lit("-"))
    ).otherwise(F.initcap(word))


# --- compatibility normalisation -------------------------------------------

@lru_cache(maxsize=1)
def _nfkc_risks() -> frozenset[str]:
    """The characters without which a text is already in NFKC form.

    Those are characters that NFKC changes, marks, and characters that may join the one
    before them.
    """
    risky = set()
    for c in _code_points():
        if unicodedata.combining(c) or unicodedata.normalize("NFKC", c) != c:
            risky.add(c)
        risky.update(unicodedata.normalize("NFD", c)[1:])
    return frozenset(risky)


@F.pandas_udf(T.StringType())
def _nfkc_batch(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


def nfkc(c: Column | str) -> Column:
    """NFKC. Only rows that can change are handed to Python; the rest pass as null."""
    text = _col(c)
    return F.coalesce(_nfkc_batch(F.when(may_hold(text, _nfkc_risks()), text)), text)


# --- evaluating an expression once ------------------------------------------

def evaluate_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column whose expression is computed exactly once per row.

    A plain ``withColumn`` is inlined wherever the column is used, so a filter with
    nine tests would fold the text nine times. A one-element ``explode`` stays a
    node of its own and still runs inside the same generated-code stage.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


# --- normal form and fingerprint ----------------------------------------------

def with_norm_text(df: DataFrame, text_col: str, name: str) -> DataFrame:
    """Clean text of the labeller: null to empty, odd spaces to blanks, NFKC, stripped."""
    blanks = F.translate(F.coalesce(F.col(text_col), F.lit("")), lx.ODD_SPACES, " " * len(lx.ODD_SPACES))
    df = evaluate_once(df, "_blanks", blanks)
    df = evaluate_once(df, name, strip(nfkc("_blanks")))
    return df.drop("_blanks")


def with_cluster_digest(df: DataFrame, text_col: str, name: str) -> DataFrame:
    """Near-copy cluster: SHA-1 (40 hex digits) of the fingerprint text.

    The fingerprint is what near copies share: lower case, single blanks, digits masked.
    """
    df = evaluate_once(df, "_lowered", collapse_spaces(F.lower(strip(text_col))))
    masked = F.regexp_replace(nfkc("_lowered"), r"\p{Nd}++", lx.NUMBER_MARK)
    return df.withColumn(name, F.sha1(masked)).drop("_lowered")


def cluster_label(digest: Column | str) -> Column:
    """The published id of a cluster: 12 digits, too few to tell billions of clusters apart."""
    return F.substring(digest, 1, 12)


def with_cluster_id(df: DataFrame, text_col: str, name: str = "cluster_id") -> DataFrame:
    """The published id; to group or split use the whole digest."""
    return with_cluster_digest(df, text_col, name).withColumn(name, cluster_label(name))


# --- assorted ---------------------------------------------------------------

@lru_cache(maxsize=1)
def _decimal_digits() -> tuple[str, str]:
    odd = [c for c in _code_points() if unicodedata.category(c) == "Nd" and c > "9"]
    return "".join(odd), "".join(str(unicodedata.decimal(c)) for c in odd)


def to_long(digits: Column) -> Column:
    """Digits of any script to a number; null if it does not fit."""
    odd, plain = _decimal_digits()
    ascii_digits = F.when(digits.rlike("[^0-9]"), F.translate(digits, odd, plain)).otherwise(digits)
    return ascii_digits.try_cast("bigint")


def empty_to_null(c: Column) -> Column:
    return F.when(c != "", c)
