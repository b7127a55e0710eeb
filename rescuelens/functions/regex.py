"""Java regular expressions for whole-word phrase search.

``\\b`` and ``\\w`` differ between Java releases and from the definition used
here, so word characters are spelled out: letters, numbers and underscore.
"""

from __future__ import annotations

from collections.abc import Iterable

WORD = r"\p{L}\p{N}_"
#: white space in the Unicode sense, plus the four ASCII separators
SPACE = r"\t-\r\x1c-\x1f\x85\p{Z}"
BEFORE = rf"(?<![{WORD}])"
AFTER = rf"(?![{WORD}])"

_META = set(r"\.[]{}()*+-?^$|&~#")


def escape(text: str) -> str:
    return "".join("\\" + c if c in _META else c for c in text)


def _prefix_tree(phrases: Iterable[str]) -> dict:
    root: dict = {}
    for phrase in phrases:
        node = root
        for char in phrase:
            node = node.setdefault(char, {})
        node[""] = {}
    return root


def _render(node: dict) -> str:
    branches = [escape(c) + _render(child) for c, child in node.items() if c]
    if not branches:
        return ""
    if len(branches) == 1 and "" not in node:
        return branches[0]
    return f"(?:{'|'.join(branches)})" + ("?" if "" in node else "")


def _search(phrases: Iterable[str], chunk: int = 8) -> str:
    """Prefix tree whose first letters are tried in chunks behind a character class."""
    root = _prefix_tree(phrases)
    letters = sorted(root)
    groups = []
    for i in range(0, len(letters), chunk):
        part = letters[i:i + chunk]
        branches = "|".join(escape(c) + _render(root[c]) for c in part)
        groups.append(f"(?=[{''.join(map(escape, part))}])(?:{branches})")
    return f"(?:{'|'.join(groups)})"


# Most positions lie inside an ASCII word, so that is tested first.
_START = rf"(?<![a-z]){BEFORE}"


def any_phrase(phrases: Iterable[str]) -> str:
    """Pattern that finds one of the (already folded) phrases as whole words."""
    return _START + _search(phrases) + AFTER


# Single characters of a class are looked up in a table, which ranges are not; so the
# ASCII characters that end a word are listed one by one.
_MAY_PRECEDE = "".join(rf"\x{i:02X}" for i in range(128)
                       if not (chr(i).isalnum() or chr(i) == "_")) + r"\x{80}-\x{10FFFF}"


def every_phrase(phrases: Iterable[str]) -> str:
    """Pattern whose group 1 is the longest phrase starting there.

    It wants the text with one blank put in front: a match is the character before the
    phrase, and the phrase itself is only looked at. So overlapping phrases are all found
    in one pass, and most positions are done with after one table lookup.
    """
    return f"[{_MAY_PRECEDE}](?=({_search(phrases)}){AFTER}){BEFORE}"


def caseless_words(phrases: Iterable[str]) -> str:
    """Case-insensitive whole-word pattern for unfolded text, longest first."""
    longest_first = sorted(phrases, key=len, reverse=True)
    return f"{BEFORE}(?iu:{'|'.join(escape(p) for p in longest_first)}){AFTER}"
