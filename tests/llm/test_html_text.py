import html as htmllib
import re

from rescuelens.llm import html_text, queries
from rescuelens.llm.html_text import main_text

LONG = "A paragraph that goes on for quite a while, so that its length alone says it is the text of a page."


def test_article_without_its_surroundings():
    page = (f"<html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body>"
            f"<nav><ul><li><a href='/'>Home</a></li></ul></nav><div class='ad banner'>Buy now, it is cheap</div>"
            f"<article><h1>Title</h1><p>{LONG}</p><p>Short.</p><!-- <p>no</p> --><ul><li>one</li><li>two</li></ul>"
            f"<p>{LONG} &amp; &eacute;&#33;</p></article><div id='comments'><p>{LONG}</p></div>"
            f"<aside>{LONG}</aside><form><p>{LONG}</p></form><footer>&copy; me</footer></body></html>")
    assert main_text(page) == f"Title\n{LONG}\nShort.\none\ntwo\n{LONG} & é!"


def test_page_without_semantic_elements():
    page = (f"<div id=topMenu><a href=/>Home</a> <a href=/n>News</a></div><div class='cookie-notice'>{LONG}</div>"
            f"<div class=content><h2>Heading</h2><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div>"
            f"<div class='user-comments'><p>{LONG}</p></div><div class=site-footer>{LONG}</div>")
    assert main_text(page) == f"Heading\n{LONG}\nShort.\n{LONG}"


def test_white_space_breaks_and_unclosed_elements():
    assert main_text("<p>a\n  b&nbsp;c<br>d<p><b>e<i>f</i>") == "a b c d\nef"


def test_link_lists_do_not_surge():
    links = "".join(f"<li><a href=/{k}>A linked headline of another story, number {k}</a></li>" for k in range(9))
    page = f"<div><ul>{links}</ul></div>" + "<div></div>" * 4 + f"<div><p>{LONG}</p></div>"
    assert main_text(page) == LONG


def test_broken_markup():
    for text in ("", "<", "<p", "a < b > c", "<p>x</p", "<div class='ad>never closed <p>y</p>", "<script>never",
                 "<!-- never", "</p></div>", "&am", "<nav>never closed<p>" + LONG, "<" * 5000, "<a " + "x=\"" * 3000):
        assert isinstance(main_text(text), str)
    assert LONG in main_text("<nav>never closed<p>" + LONG)


def test_short_article_is_kept():
    assert main_text("<article><p>Hi.</p></article>") == "Hi."


def test_query_against_the_known_layout(spark, sf_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    out = queries.op3_html_text(spark, sf_dir).collect()
    assert len(out) == len(pages)
    for r in out:
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", pages[r.page_id].html, re.S)[1]
        blocks = [" ".join(htmllib.unescape(re.sub(r"<[^>]*(?:>|\Z)", "", b.replace("<br>", " "))).split())
                  for b in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n".join(filter(None, blocks))
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_edge_rows(spark):
    rows = [(1, None, None, "z"), (1, "u", "", "z"), (2, "u", f"<p>{LONG}</p>" * 3000, "z"), (None, "u", "<p>x</p>", "z")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = html_text.extracted(frame).collect()
    assert sorted((str(r.page_id), len(r.text)) for r in out) == [("1", 0), ("1", 0), ("2", 3000 * (len(LONG) + 1) - 1), ("None", 1)]
    assert html_text.extracted(frame.limit(0)).collect() == []


def test_short_lines_between_removed_parts_of_an_article():
    long = "word " * 60
    beside = ["<div class=advert><p>Buy now</p></div>", "<aside><p>An aside</p></aside>",
              "<form><p>Your name</p></form>", "<div class=notice><p>A notice</p></div>"]
    page = (f"<article><h1>The title of the page</h1><p>{long}</p>" + "".join(
        f"{part}<p>A short line, number {k}.</p>" for k, part in enumerate(beside))
        + f"{beside[0]}<ul><li>one</li></ul>{beside[1]}<figcaption>caption</figcaption></article><p>Not in it</p>")
    want = ["The title of the page", long.strip(), *[f"A short line, number {k}." for k in range(4)], "one", "caption"]
    assert main_text(page) == "\n".join(want)


def test_no_article_and_removed_parts_within():
    aside = "<aside><p>beside</p></aside>"
    assert main_text(f"<p>{LONG}</p><div class=ad><p>Buy</p></div><p>The end.</p>") == f"{LONG}\nThe end."
    assert main_text(f"<p>{LONG}</p>{aside}<p>Short.</p>{aside}<p>{LONG}</p>") == f"{LONG}\nShort.\n{LONG}"


def test_names_of_an_article_s_own_parts():
    page = ("<article><section id=privacy><p>One.</p></section><p class='share-price'>Two.</p>"
            "<h2 id=sidebar>Three</h2><p id='notice-of-appeal'>Four.</p><div class='ad-slot'>Buy</div>"
            "<div class=share-price>Five.</div><div class='comment-list'>reader</div></article>")
    assert main_text(page) == "One.\nTwo.\nThree\nFour.\nFive."


def test_whole_names_outside_of_an_article():
    beside = "".join(f"<div class='{n}'>{LONG}</div>" for n in (
        "site-footer", "cookieBanner", "main nav", "widget_area", "post-comments", "share-buttons", "topbar"))
    kept = "".join(f"<div class='{n}'>{LONG}</div>" for n in ("share-price", "search-engines", "header-of-the-house"))
    assert main_text(beside) == ""
    assert main_text(beside + kept) == "\n".join([LONG] * 3)


def plain_stretches(weights):
    """Line by line: in the text or not, from what the windows hold."""
    sums = [sum(weights[k:k + 3]) for k in range(len(weights))]
    least = min(80, max(sums, default=0) / 2)
    inside, out = False, []
    for k, total in enumerate(sums):
        if inside and total == 0:
            inside = False
        elif not inside and least and total >= least:
            inside = True
        out.append(inside)
    # lines without weight ahead of the text are not part of it
    begun = False
    for k, on in enumerate(out):
        begun = begun and on
        if on and not begun:
            begun = out[k] = bool(weights[k])
    return [k for k, on in enumerate(out) if on]


def test_surge_and_dive_against_a_plain_scan():
    import random
    rng = random.Random(3)
    for _ in range(3000):
        weights = [rng.choice([0, 0, 0, 5, 30, 200]) for _ in range(rng.randrange(25))]
        got = [k for start, stop in html_text.stretches(weights) for k in range(start, stop)]
        assert got == plain_stretches(weights), weights


def test_every_page_goes_through_the_windows(spark, sf_dir, monkeypatch):
    calls = []
    real = html_text.stretches
    monkeypatch.setattr(html_text, "stretches", lambda weights: calls.append(len(weights)) or real(weights))
    pages = [r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("html").collect()]
    texts = [html_text.main_text(h or "") for h in pages]
    assert len(calls) == len(pages) and all(texts)


def test_unclosed_parts_take_linear_time():
    import time
    page = "<aside>" * 20_000 + f"<p>{LONG}</p>"
    began = time.perf_counter()
    assert main_text(page) == LONG
    assert time.perf_counter() - began < 5
