import os
import random
import re
from html.parser import HTMLParser

import pytest

from meterflow.llm import html_extract
from meterflow.llm.html_extract import main_text

STORY = "It was a long day and the sun was shining over the hills of the whole valley."

PAGES = {
    "<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href='/x'>Home</a>"
    "</li></ul></nav><article><h1>A &amp; B</h1><p><b>One<br>two.<p>To.</article>"
    "<footer>&copy; x</footer></body></html>": "A & B\n\nOne two.\n\nTo.",
    f"<body><div class='menu'><a href=x>Home</a></div><div id=content><h1>Title</h1><p>{STORY}</p>"
    "<aside>Read this</aside><p>Short.</p></div><div class='reader-comments'><p>First! What a long"
    " comment this is, written by a reader of the text above, all in one line of it.</p></div>"
    "</body>": f"Title\n\n{STORY}\n\nShort.",
    "<article><p>a < b &lt;c&gt; x&nbsp;&nbsp;y</p><script>var t='</p>';</script><p>caf&eacute;</p>":
        "a < b <c> x y\n\ncafé",
    "<article class='post has-sidebar'><p>kept</p><div class='ad'>buy</div><form><p>mail</p></form>"
    "<p>end": "kept\n\nend",
    "<article><p>one</p><p title='a > b'>two</p><!-- <p>no</p> --><p>three</p": "one\n\ntwo\n\nthree",
    "<main><article class='comment'><p>no</p></article><p>yes</p></main>": "yes",
    "<aside><article><p>teaser</p></article></aside><article><header><h1>T</h1><p>by me</p></header>"
    "<p>body</p><div class='related'><article><p>other</p></article></div></article>": "T\n\nbody",
    "<body class='no-sidebar'><div class='page has-sidebar'><article class='main-menu'><p>in</p>"
    "</article></div><div id='cookie-notice'><p>We use cookies</p></div>": "in",
    "plain text only": "plain text only",
    "": "", "<p>": "", "<": "<", "<article": "", "<!-- open": "",
}


@pytest.mark.parametrize("page", PAGES)
def test_pages(page):
    assert main_text(page) == PAGES[page]


@pytest.mark.parametrize("page, text", [
    ("<article><p>a <svg-icon></svg-icon>b</p><p>c</p></article>", "a b\n\nc"),
    ("<article><p>a<video-player src=x></video-player><title-bar>t</title-bar><object-view/>b",
     "atb"),
    ("<article><p>a <svg width='1' title='x>y'/>b</p><p>c</p></article>", "a b\n\nc"),
    ("<article><p>a <svg><path d=''/><text>no</text></svg>b</p></article>", "a b"),
    ("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be</p></article>", "Let x=2 be"),
    ("<article><p>a <math class='ad'/>b</p><p>c</p></article>", "a b\n\nc"),
])
def test_names_that_begin_like_skipped_elements(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("page, text", [
    ("<article><h2 id='search-algorithms'>Search algorithms</h2><p>Body</p>"
     "<section id='social-history'><h3 id=related>Related</h3><p>More</p></section></article>",
     "Search algorithms\n\nBody\n\nRelated\n\nMore"),
    ("<article><p>a <select><option>1<option>2</select> b <span class='ad'>Buy now</span> c"
     " <noscript>enable js</noscript> d <button>Share</button></p></article>", "a b c d"),
    ("<article><p>kept</p><section id='reader-comments'><p>First!</p></section></article>", "kept"),
    ("<article><p data-id='ad'>kept</p><p class='ad'>buy</p></article>", "kept"),
    (f"<div class=x><p>{STORY} <span class='sponsored'>Buy</span></p><p>{STORY}</p></div>",
     f"{STORY}\n\n{STORY}"),
])
def test_slugs_and_skipped_parts_of_a_line(page, text):
    assert main_text(page) == text


def test_the_mark_is_a_prior_and_density_decides():
    far = "<div class='ad'>buy</div>" * 6
    page = f"<article><p>{STORY * 3}</p>{far}<p>Short end.</p></article>{far}<p>Stray</p>"
    assert main_text(page) == f"{STORY * 3}\n\nShort end."
    # Text outside that is as dense as a whole article by far is text all the same.
    page = f"<article><p>teaser</p></article>{far}<div><p>{STORY * 9}</p></div>"
    assert main_text(page) == f"teaser\n\n{STORY * 9}"


class Plain(HTMLParser):
    """Blocks of a page with the library's parser: (text, skipped, in an article, linked)."""

    def __init__(self):
        super().__init__()
        self.open, self.blocks, self.now = [], [], []

    def cut(self):
        kept = [part for part in self.now if not part[1]] or self.now
        text = " ".join("".join(part[0] for part in kept).split())
        if not text or not "".join(p[0] for p in kept).strip():
            kept = self.now
            text = " ".join("".join(part[0] for part in kept).split())
        if text:
            solid = [p for p in kept if p[0].strip()]
            self.blocks.append((text, kept[0][1] and all(p[1] for p in solid),
                                any(p[2] for p in solid),
                                sum(len(p[0].strip()) for p in kept if p[3])))
        self.now = []

    def handle_starttag(self, tag, attrs):
        if tag in html_extract.BLOCKS:
            self.cut()
        if tag not in html_extract.VOID:
            attrs = "".join(f' {k}="{v}"' for k, v in attrs if v)
            self.open.append((tag, attrs))

    def handle_endtag(self, tag):
        if tag in html_extract.BLOCKS:
            self.cut()
        names = [name for name, _ in self.open]
        if tag in names:
            del self.open[len(names) - 1 - names[::-1].index(tag):]

    def handle_data(self, data):
        skipped = article = comments = False
        for i, (tag, attrs) in enumerate(self.open):
            words = html_extract._names(tag, attrs, article)
            named = words & html_extract.SKIPPED_WORDS
            comments = comments or words & html_extract.COMMENT_WORDS
            if tag == "body":
                skipped = False
            elif tag in ("article", "main") and not comments:
                article = article or not skipped
            elif tag in html_extract.HEADINGS and article and self.open[i - 1][0] == "header":
                skipped = bool(named)
            elif tag in html_extract.SKIPPED | {"header", "script", "style", "title"} or named:
                skipped = tag != "html"
        if any(tag in ("script", "style", "title") for tag, _ in self.open):
            return
        link = any(tag == "a" for tag, _ in self.open)
        self.now.append((data, bool(skipped), bool(article), link))


def plain_text(html):
    parser = Plain()
    parser.feed(html)
    parser.close()
    parser.cut()
    return "\n\n".join(html_extract.main_lines(parser.blocks))


SMALL = "/root/testdata/sf0.01/pages.parquet"


@pytest.mark.skipif(not os.path.exists(SMALL), reason="no test tables here")
def test_given_pages_against_the_library_parser(spark):
    pages = [row.html or "" for row in spark.read.parquet(SMALL).select("html").collect()]
    for page in pages:
        text = main_text(page)
        assert text == plain_text(page)
        assert text == main_text(re.sub(r"<(/?)article\b", r"<\1div", page))


def brute_lines(lines, window, surge):
    """The density rule for pages without a mark, stretch by stretch of every possible border."""
    texts = ["" if skipped or linked > 0.6 * len(text) else text for text, skipped, _, linked in lines]
    sums = [sum(map(len, texts[max(0, i - window + 1):i + 1])) for i in range(len(texts))]
    least = min(surge, max(sums, default=0) / 2)
    kept = set()
    for a in range(len(sums)):
        for b in range(a, len(sums)):
            if all(sums[a:b + 1]) and max(sums[a:b + 1]) >= least:
                kept |= set(range(a, b + 1))
    return [texts[i] for i in sorted(kept) if texts[i]]


def test_density_against_every_stretch():
    draw = random.Random(6)
    for _ in range(200):
        lines = [("x" * draw.choice([0, 3, 30, 90, 200]), draw.random() < 0.4, False,
                  draw.choice([0, 0, 30])) for _ in range(draw.randrange(25))]
        assert html_extract.main_lines(lines) == brute_lines(lines, 3, 86)


def test_density_without_marked_article():
    lines = [(f"menu {i}", False, False, 6) for i in range(8)]
    lines += [("Title", False, False, 0)] + [(STORY, False, False, 0)] * 3
    lines += [("x", True, False, 0)] * 6 + [("tiny", False, False, 0)]
    assert html_extract.main_lines(lines) == ["Title"] + [STORY] * 3


def test_long_page():
    page = "<article>" + "".join(f"<p>line {i}</p>" for i in range(30_000)) + "</article>"
    assert main_text(page).count("\n\n") == 29_999
    assert main_text("<" * 200_000) == "<" * 200_000
    assert main_text("<div>" * 20_000 + "deep") == "deep"


def test_table(spark):
    rows = [(1, "u", "<article><p>é x</p></article>"), (1, "u", None), (None, None, ""),
            (2, "v", "<p>a</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "'own' as text", "0 as n_chars")
    found = html_extract.extract_pages(pages).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in found) == [
        (0, "", 0), (1, "", 0), (1, "é x", 3), (2, "a", 1)]
    assert html_extract.extract_pages(pages.limit(0)).count() == 0
