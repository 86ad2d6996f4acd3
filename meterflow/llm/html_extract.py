"""HTML extraction by line-block distribution.

Markup is stripped into lines, one for each block of the page; what stands in menus, headers,
footers, side bars, notices, adverts, forms, scripts, styles or reader comments is left out of its
line, and a line that has nothing else, or is mostly links, is empty. Text lengths are summed over
sliding windows of ``WINDOW`` lines. Text begins at a surge, where a window without text is
followed by one with text, and ends at the dive back to windows without any; a stretch counts if
its highest window comes near the page's highest or reaches ``SURGE`` characters. All lines of such
stretches are kept, in page order. Where the page marks its article, the mark is a prior: a line
inside counts for ``SURGE`` characters more, one outside for a share ``OUTSIDE`` of its length.

Character references are decoded, white space inside a block becomes one space, and blocks are
joined by an empty line.

Defined cases: null counts as the empty page; a page without text gives the empty text. A page
that ends inside a tag loses that tag, one that ends inside a skipped element is skipped to its
end. Elements may be left open; a closing tag closes what was opened inside it. Repeated rows
each get their row. An empty table gives no rows. Other columns may have any name.
"""

import re
from html import unescape

import pandas as pd

from meterflow.llm.common import small_batches

WINDOW = 3
SURGE = 86
LINKS = 0.6
OUTSIDE = 0.25

# Names of elements, and words of classes, ids and roles.
BLOCKS = frozenset("""
address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section
summary table tbody tfoot thead title tr ul caption
""".split())
SPACES = frozenset(("br", "td", "th"))
VOID = frozenset("""
area base br col embed hr img input link meta param source track wbr
""".split())
SKIPPED = frozenset("""
head nav footer aside form dialog menu noscript template button select
""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
SKIPPED_WORDS = frozenset("""
ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion
banner sidebar sidebars sidenav aside menu menus nav navbar navigation breadcrumb breadcrumbs
masthead topbar footer foot notice notices cookie cookies consent gdpr newsletter subscribe
subscription signup popup modal overlay share sharing social related recommended recommendations
widget toolbar login search searchbox comment comments commentlist disqus replies respond
discussion copyright pagination pager header contentinfo complementary alert dialog form
""".split())
LAYOUT = frozenset("has with no without hide".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus replies respond discussion".split())

MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)
    |<(?P<empty>svg|math)(?=[\s/>])(?:[^>"']++|"[^"]*+"|'[^']*+')*+(?<=/)>
    |<(?P<raw>script|style|textarea|title|iframe|svg|object|canvas|audio|video)
        (?=[\s/>])[^>]*+(?:>.*?(?:</(?P=raw)\s*>|\Z)|\Z)
    |<(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*)
        (?P<attributes>(?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*+(?:>|\Z))
    |<[!?/][^>]*+(?:>|\Z)""",
    re.IGNORECASE | re.DOTALL | re.VERBOSE,
)
NAMED = re.compile(
    r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(
    r"""\shidden(?=[\s=>/]|\Z)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I
)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _names(name, attributes, article):
    """Words in the class, id and role of a tag. An id of several words is mostly a place that
    links lead to, made of a heading: that of a heading does not count, nor one inside an article,
    but for words of comments."""
    if "=" not in attributes:
        return frozenset()
    found = []
    for kind, *values in NAMED.findall(attributes):
        words = [word.lower() for word in WORDS.findall("".join(values))]
        if kind.lower() == "id" and (name in HEADINGS or article and len(words) > 1):
            words = [] if name in HEADINGS else [w for w in words if w in COMMENT_WORDS]
        found += words
    # "has-sidebar" or "no-menu" tells of a page's layout, not of the element.
    return frozenset(
        word for before, word in zip(["", *found], found) if before not in LAYOUT
    )


class _Page:
    """Lines of a page: the text of each block, whether it is skipped, marked as article, and
    how much of it is links."""

    def __init__(self):
        self.lines, self.parts = [], []  # parts: text, skipped, inside an article, inside a link
        # Open elements: name, skipped, inside an article, inside comments, inside a link.
        self.stack = [("", False, False, False, False)]

    def end_line(self):
        if not self.parts:
            return
        for skipped in (False, True):
            parts = [part for part in self.parts if skipped or not part[1]]
            text = " ".join(unescape("".join(part[0] for part in parts)).split())
            if text:
                links = sum(len(part[0].strip()) for part in parts if part[3])
                article = any(part[2] for part in parts if part[0].strip())
                self.lines.append((text, skipped, article, links))
                break
        self.parts = []

    def text(self, text):
        if text:
            _, skipped, article, _, link = self.stack[-1]
            self.parts.append((text, skipped, article, link))

    def open(self, name, attributes):
        if name in BLOCKS:
            self.end_line()
            if name in ("p", "li", "dd", "dt", "tr") or name in HEADINGS:
                self.close_open(name)
        elif name in SPACES:
            self.parts.append((" ", False, False, False))
        if name in VOID:
            return
        _, skipped, article, comments, link = self.stack[-1]
        if name == "body":
            skipped = False
        elif name != "html":
            words = _names(name, attributes, article)
            comments = comments or bool(words & COMMENT_WORDS)
            named = bool(words & SKIPPED_WORDS) or bool(HIDDEN.search(attributes))
            if name in ("article", "main") and not comments:
                article = article or not skipped
            elif name == "header":
                skipped = True
            elif name in HEADINGS and article and self.stack[-1][0] == "header" and not named:
                skipped = False
            else:
                skipped = skipped or comments or named or name in SKIPPED
        if link or name == "a":
            link = True
        self.stack.append((name, skipped, article, comments, link))

    def close_open(self, name):
        """An open paragraph or item ends where the next one begins."""
        if self.stack[-1][0] == name:
            self.stack.pop()

    def close(self, name):
        if name in BLOCKS:
            self.end_line()
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] == name:
                del self.stack[i:]
                return


def page_lines(html):
    """(text, skipped, in an article, characters in links) of the blocks, in page order."""
    page, at = _Page(), 0
    for tag in MARKUP.finditer(html):
        page.text(html[at:tag.start()])
        at = tag.end()
        name = tag["name"]
        if name is None:
            if tag["raw"] and tag["raw"].lower() == "title":
                page.end_line()
        elif tag["close"]:
            page.close(name.lower())
        else:
            page.open(name.lower(), tag["attributes"])
    page.text(html[at:])
    page.end_line()
    return page.lines


def main_lines(lines, window=WINDOW, surge=SURGE, links=LINKS, outside=OUTSIDE):
    """The lines that the distribution of text lengths shows to be the main text."""
    marked = any(article for _, skipped, article, _ in lines if not skipped)
    texts, weights = [], []
    for text, skipped, article, linked in lines:
        mostly_links = not article and linked > links * len(text)
        texts.append("" if skipped or mostly_links else text)
        weight = len(texts[-1])
        if marked and weight:
            weight = weight + surge if article else weight * outside
        weights.append(weight)
    sums = [sum(weights[max(0, i - window + 1):i + 1]) for i in range(len(weights))]
    least = min(surge, max(sums, default=0) / 2)
    kept, i = [], 0
    while i < len(sums):
        if not sums[i]:
            i += 1
            continue
        dive = i
        while dive < len(sums) and sums[dive]:
            dive += 1
        if max(sums[i:dive]) >= least:
            kept += [text for text in texts[i:dive] if text]
        i = dive
    return kept


def main_text(html):
    """The main text of a page."""
    return "\n\n".join(main_lines(page_lines(html or "")))


def extract_pages(pages):
    """One row per page: ``page_id``, ``url``, ``text``, ``n_chars``."""
    def rows(batches):
        for batch in batches:
            texts = [main_text(html) for html in batch["html"]]
            yield batch[["page_id", "url"]].assign(
                text=pd.Series(texts, dtype=object, index=batch.index),
                n_chars=pd.Series(map(len, texts), dtype="int64", index=batch.index),
            )

    small_batches(pages.sparkSession)
    page_id = pages.select("page_id").schema[0].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInPandas(
        rows, f"page_id {page_id}, url string, text string, n_chars long"
    )
