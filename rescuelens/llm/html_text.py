"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one per block element. Menus, headers, footers, sidebars, forms,
adverts, notices and reader comments are left out, and leave nothing that could part the text around
them. Every line has a weight: the length of its text outside links, or nothing if most of it is in links.
Weights are summed over windows of ``WINDOW`` lines. The text begins where the sum surges over a
threshold and ends where it dives to zero; all lines between are kept. The threshold follows short
pages: it is never more than half the largest sum of the page.

Article elements are one of the signals. Where they hold enough of the text (``ARTICLE_SHARE``), lines
outside them have no weight and no part in the text, and every line inside weighs at least as much as a
surge takes: it is kept, however short, linked or cut off from the others.

Character references are decoded after markup is read. White space inside a block is one space;
a line break tag is white space. Blocks are joined by one line feed. Null and empty pages, and
pages without a main text, give an empty text. Markup that is cut off at the end is dropped.
Repeated rows are extracted apart. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

WINDOW = 3
SURGE = 80
#: least share of a page's text that an article element must hold to stand for the whole
ARTICLE_SHARE = 0.4
#: share of its text that a line may have in links and still count
MOST_LINKED = 0.6

# --- fixed values: elements and names ------------------------------------------------------

BLOCKS = frozenset(
    "address article blockquote body center dd details dialog div dl dt fieldset figcaption figure "
    "h1 h2 h3 h4 h5 h6 hr html li main ol optgroup p pre section summary table tbody tfoot thead tr "
    "ul caption header footer nav aside form".split())
#: what is inside is no text
SILENT = ("script style noscript template svg iframe object canvas head select button textarea "
          "audio video map datalist option math").split()
#: parts beside the text, whatever their names
BESIDE = frozenset("nav footer aside form menu dialog".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert form".split())
#: words in class or id that mark a part beside the text
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion "
    "promoted banner cookie cookies consent gdpr privacy sidebar sidenav menu nav navbar navigation "
    "breadcrumb breadcrumbs comment comments commentlist disqus respond replies reply share sharing social "
    "related recommended newsletter subscribe subscription popup modal overlay notice notification "
    "alert disclaimer footer masthead toolbar pagination pager login signup search widget".split())
HEADERS = frozenset("header topbar".split())
#: words in a name that only say where or how
PLACES = frozenset(
    "site page main top bottom left right inner outer wrap wrapper container box block area section row col column "
    "list item items unit slot bar panel group link links button buttons icon icons form field title heading "
    "thread author meta body the a b c id primary secondary global sticky fixed float floating in on inline "
    "post posts article entry user users reader readers holder placeholder".split())
#: parts of an article that are never beside it for their names
PARAGRAPHS = frozenset("p section h1 h2 h3 h4 h5 h6 li figure figcaption blockquote pre table td th".split())
#: names that win over the ones above
CONTENT = frozenset("article content post entry main story body text".split())

# --- end of fixed values -------------------------------------------------------------------

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<silent>" + "|".join(SILENT) + r")\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=silent)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<bad>/?[a-z][^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)", re.I | re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_END = re.compile(r"</([a-z][a-z0-9:-]*)\s*>", re.I)
_NAME_PARTS = re.compile(r"[a-z]+", re.I)
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _is_name_beside(value: str, in_article: bool) -> bool:
    """Whether one of the names in a class or id marks a part beside the text.

    A name counts whole, or if all its parts do or only say where or how: ``site-footer`` does,
    ``share-price`` does not.
    """
    for name in value.split():
        parts = {p.lower() for p in _NAME_PARTS.findall(_HUMP.sub(" ", name))}
        if not parts or parts & CONTENT and not parts & {"comments", "sidebar"}:
            continue
        if parts & NAMES and parts <= NAMES | HEADERS | PLACES | CONTENT:
            return True
        if parts & HEADERS and parts <= HEADERS | PLACES and not in_article:
            return True
    return False


def _is_beside(tag: str, rest: str, in_article: bool) -> bool:
    if tag in BESIDE or (tag == "header" and not in_article):
        return True
    if not rest or tag in ("body", "html", "article", "main"):
        return False
    for name, *values in _ATTRIBUTE.findall(rest):
        name, value = name.lower(), next(filter(None, values), "")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "style":
            if re.search(r"display\s*:\s*none", value, re.I):
                return True
        elif name == "role":
            if value.lower() in ROLES:
                return True
        elif not (in_article and tag in PARAGRAPHS) and _is_name_beside(value, in_article):
            return True
    return False


class _Line:
    __slots__ = ("parts", "linked", "article")

    def __init__(self, article: bool) -> None:
        self.parts: list[str] = []
        self.linked = 0
        self.article = article


def lines_of(html: str) -> list[tuple[str, int, bool]]:
    """(text, weight, whether in an article) of every block with text."""
    out: list[tuple[str, int, bool]] = []
    line = _Line(False)
    # an element that never ends is no part beside the text
    last_end = {m[1].lower(): m.start() for m in _END.finditer(html)}
    skipped, depth, links, article = "", 0, 0, 0

    def end_line() -> None:
        nonlocal line
        text = " ".join(unescape("".join(line.parts)).split())
        if text:
            out.append((text, 0 if line.linked > MOST_LINKED * len(text) else len(text), line.article))
        line = _Line(article > 0)

    def add(text: str) -> None:
        if skipped or not text:
            return
        line.parts.append(text)
        line.article = line.article or article > 0
        if links:
            line.linked += len(" ".join(unescape(text).split()))

    at = 0
    for token in _TOKEN.finditer(html):
        add(html[at:token.start()])
        at = token.end()
        tag = token["tag"]
        if token["bad"]:
            tag = re.match(r"/?[a-z0-9]*", token["bad"], re.I)[0].lstrip("/")
        if not tag:
            continue
        tag = tag.lower()
        closing = bool(token["close"]) or (token["bad"] or "").startswith("/")
        if skipped:
            if tag == skipped:
                depth += -1 if closing else 1
                if depth == 0:
                    skipped = ""
            elif tag in ("article", "main") and not closing and skipped in ("p", "span", "li"):
                skipped = ""
            if not skipped and tag not in ("article", "main"):
                continue
            if skipped:
                continue
        if tag in ("article", "main"):
            end_line()
            article = max(0, article + (-1 if closing else 1))
            line.article = article > 0
        elif not closing and tag not in VOID and _is_beside(tag, token["rest"] or "", article > 0):
            if last_end.get(tag, -1) >= at:
                end_line()
                skipped, depth = tag, 1
        elif tag in BLOCKS:
            end_line()
        elif tag == "a":
            links = 0 if closing else 1
        elif tag in ("br", "td", "th"):
            add(" ")
    add(html[at:])
    end_line()
    return out


def stretches(weights: list[int]) -> Iterator[tuple[int, int]]:
    """Where the text is: from a surge of the windows' sums to the dive after it."""
    sums = [sum(weights[k:k + WINDOW]) for k in range(len(weights))]
    surge = min(SURGE, max(sums, default=0) / 2)
    k = 0
    while surge and k < len(weights):
        if sums[k] < surge:
            k += 1
            continue
        stop = k
        while stop < len(weights) and sums[stop]:
            stop += 1
        # the window sees the first line of weight before it is there
        while not weights[k]:
            k += 1
        yield k, stop
        k = stop + 1


def main_text(html: str) -> str:
    lines = lines_of(html)
    weights = [weight for _, weight, _ in lines]
    inside = [weight if article else 0 for _, weight, article in lines]
    articles = any(inside) and sum(inside) >= ARTICLE_SHARE * sum(weights)
    if articles:
        weights = [max(weight, SURGE) if article else 0 for _, weight, article in lines]
    return "\n".join(text for start, stop in stretches(weights) for text, _, article in lines[start:stop]
                     if article or not articles)


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) if h else "" for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"),
                                              pa.array(texts, pa.string())], ["page_id", "url", "text"])
    return pages.selectExpr("CAST(page_id AS long) AS page_id", "url", "html").mapInArrow(
        run, "page_id long, url string, text string")
