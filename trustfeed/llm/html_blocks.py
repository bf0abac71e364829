"""Main text of web pages by line-block distribution.

Markup is stripped and the page becomes a list of blocks (the "lines" of the method): text between block-level tags, with
character references decoded and white space made one space. A block weighs the length of its text (outside
an article: without links); blocks within scripts, styles, forms, navigation, page headers and footers, sidebars, notices, adverts and comments
(by tag, role, class or id) weigh nothing. Weights are summed over sliding windows of ``WINDOW`` blocks. Where the sum
surges, a stretch of text begins; where it dives to nothing, it ends.

If the page has an <article> or <main> with at least as much text as any stretch outside, the one with the most text bounds the search,
together with those that have at least ``SHARE`` of its text and with all articles within these, however short; what stands directly in a
<main> around it (headline, lead) belongs to it. Else the stretch with the most text is the main text, together with the stretches that
have at least ``SHARE`` of its text and with every stretch of the same element, so adverts, forms and lists within the text don't end it.
Blocks of nothing but one link are kept in that element; lists and rows of links are menus.

A class, id or role marks boilerplate by its words. Words that articles use, too ("share", "related", "notice"), and all words within an
article, count only in names made of nothing but such words and those of page layout: "share-buttons" goes, "share-price" stays.

Each page is parsed on its own in an Arrow batch, in time linear in its length, malformed or not; nothing is shuffled.

Edge cases: null or empty html gives an empty text; unclosed elements end with their parent; an unclosed drawing or formula ends at the
next block element, an unclosed script or style with the page; stray "<" and tags that never end are text; if a tag's quotes stay open to the
end of the page, quotes don't count from there on; pages without
block tags are one block; repeated rows give equal rows; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustfeed.llm.common import arrow_rows, texts_of

WINDOW = 3
SURGE = 1          # characters in a window that begin a stretch
SHARE = 0.3
MAIN_DDL = "page_id bigint, url string, text string, n_chars bigint"
_MAIN = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

# Element names.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
                   "strike strong sub sup time tt u var wbr img".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style noscript template textarea select iframe object canvas title head".split())
# raw elements that reach to the end of the page if they aren't closed
RAW_TO_END = frozenset("script style textarea".split())
DRAWN = frozenset(("svg", "math"))
# elements whose end need not be written: a new one ends the open one of the same kind
IMPLIED = frozenset("p li dt dd tr td th option".split())
BOILERPLATE = frozenset("nav footer aside form header button dialog menu".split())
MAIN_TAGS = frozenset(("article", "main"))
LISTS = frozenset("ul ol dl".split())
# elements that hold a piece of a text, not a text
PIECES = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre figure figcaption table caption thead tbody tfoot tr td th "
                   "header hgroup address details summary".split())
# Words of class, id and role that mark what isn't part of the article.
CLEAR = frozenset("ad ads advert adverts advertisement advertisements advertising adsense breadcrumb breadcrumbs comments commentlist "
                  "complementary consent contentinfo cookie cookies disqus footer gdpr menu modal nav navbar navigation newsletter "
                  "pagination popup sidebar sponsor sponsored sponsors subscribe toolbar".split())
UNCLEAR = frozenset("alert comment notice pager promo promos promoted promotion related replies reply search share sharing skip social "
                    "widget widgets".split())
PAGE_HEADS = frozenset("banner header masthead".split())
# Words of layout that may stand beside a mark.
LAYOUT = frozenset("area articles banner bar block body bottom box btn button buttons card cards center col column container content cta footer "
                   "form group header icon icons inline inner item items left link links list main menu native network networks outer page "
                   "panel post posts right row section sections signup site slot stories thread title tools top unit widget wrap wrapper".split())
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PLAIN = re.compile(r"[^>\"']*")
_DRAWN_END = re.compile(r"<(?:(/?)(svg|math|foreignobject|annotation-xml)\b|(?:p|div|h[1-6]|ul|ol|dl|li|table|article|section|main|body|footer|"
                        r"header|nav|aside|blockquote|pre|hr|br)\b)", re.I)
_WORD_ENDS = re.compile(r"[_-]+")
_SPACES = re.compile(r"\s+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
# numbers of character references: leading zeros, and numbers that no character has
_ZEROS = re.compile(r"&#(?:0+(?=[0-9])|([xX])0+(?=[0-9a-fA-F]))")
_TOO_LARGE = re.compile(r"&#(?:[0-9]{9,}|[xX][0-9a-fA-F]{9,});?")


class Block(NamedTuple):
    text: str
    weight: int        # 0 if boilerplate
    article: int       # number of the innermost article or main element, 0 outside
    home: int          # number of the innermost element that isn't a piece of a text
    listed: int        # number of the outermost list, 0 outside
    links: int
    boilerplate: bool


class Element(NamedTuple):
    tag: str
    number: int
    boilerplate: bool
    article: int
    home: int
    listed: int


class Page(NamedTuple):
    blocks: list[Block]
    parents: list[int]          # parent of each element
    lasts: list[int]            # last element opened within it
    tags: list[str]


def _decode(text: str) -> str:
    if "&#" in text:
        text = _TOO_LARGE.sub("\ufffd", _ZEROS.sub(lambda m: f"&#{m[1] or ''}", text))
    return html.unescape(text)


def _is_marked(attrs: str, in_article: int) -> bool:
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id", "role"):
            for part in value.lower().split():
                words = [w for w in _WORD_ENDS.split(part) if w]
                marks = [w for w in words if w in CLEAR or w in UNCLEAR]
                if not in_article and (any(w in CLEAR for w in marks) or any(w in PAGE_HEADS for w in words)):
                    return True
                if marks and all(w in CLEAR or w in UNCLEAR or w in LAYOUT or w.isdigit() for w in words):
                    return True
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and _HIDDEN.search(value):
            return True
    return False


class _Scanner:
    """Finds the ends of tags and raw elements; what isn't found is not looked for again."""

    def __init__(self, page: str):
        self.page = page
        self.last_gt = page.rfind(">")
        self.quotes = True
        self.closes: dict[str, tuple[float, int]] = {}

    def find(self, sub: str, at: int) -> int:
        """Where ``sub`` is next, or -1."""
        start, end = self._next(sub, re.escape(sub), at)
        return end - len(sub) if end >= 0 else -1

    def close_of(self, tag: str, at: int) -> int:
        """Behind the next end tag of a raw element, or -1."""
        # a head without end stops where the body begins
        return self._next(tag, rf"</{re.escape(tag)}\s*>" + (r"|(?=<body\b)" if tag == "head" else ""), at)[1]

    def _next(self, key: str, pattern: str, at: int) -> tuple[float, int]:
        known = self.closes.get(key)
        if known is None or known[0] < at:
            m = re.compile(pattern, re.I).search(self.page, at)
            known = self.closes[key] = (m.start(), m.end()) if m else (float("inf"), -1)
        return known

    def tag_end(self, at: int) -> int:
        """Where the tag's ">" is, quoted ones left out, or -1."""
        if self.last_gt < at:
            return -1
        pos = at
        while self.quotes:
            pos = _PLAIN.match(self.page, pos).end()
            if pos < len(self.page) and self.page[pos] == ">":
                return pos
            close = self.page.find(self.page[pos], pos + 1) if pos < len(self.page) else -1
            if close < 0:
                self.quotes = False
            pos = close + 1
        return self.page.find(">", at)

    def drawn_end(self, at: int) -> int:
        """End of a drawing or formula, nested ones included; block elements end one that isn't closed."""
        depth, foreign = 1, 0
        for m in _DRAWN_END.finditer(self.page, at):
            name = (m[2] or "").lower()
            if name in DRAWN:
                depth += -1 if m[1] else 1
                if not depth:
                    close = self.page.find(">", m.end())
                    return close + 1 if close >= 0 else len(self.page)
            elif name:
                foreign = max(0, foreign + (-1 if m[1] else 1))
            elif not foreign:
                return m.start()
        return len(self.page)


def blocks_of(page: str) -> Page:
    """The blocks in page order, and the elements."""
    blocks: list[Block] = []
    parts: list[tuple[str, bool]] = []
    root = Element("", 0, False, 0, 0, 0)
    opened, n_open = [root], Counter()
    parents, lasts, tags = [0], [0], [""]
    scan = _Scanner(page)
    linked, n_links, at, text_from = False, 0, 0, 0

    def add(text: str):
        if text:
            # references are decoded in whole runs, so that one cut by a tag stays as written
            parts.append((_decode(text), linked))

    def close_block():
        nonlocal linked, n_links
        if parts:
            text = _SPACES.sub(" ", "".join(p for p, _ in parts)).strip()
            if text:
                e = opened[-1]
                # within an article links are part of the text
                free = sum(len(_SPACES.sub(" ", p).strip()) for p, in_link in parts if e.article or not in_link)
                blocks.append(Block(text, 0 if e.boilerplate else free, e.article, e.home, e.listed, n_links, e.boilerplate))
            parts.clear()
        linked, n_links = False, 0

    def close_element():
        e = opened.pop()
        n_open[e.tag] -= 1
        lasts[e.number] = len(parents) - 1

    while (at := page.find("<", at)) >= 0:
        if page.startswith("<!--", at):
            add(page[text_from:at])
            end = scan.find("-->", at)
            at = text_from = end + 3 if end >= 0 else len(page)
            continue
        if page.startswith("<![CDATA[", at) and (end := scan.find("]]>", at)) >= 0:
            add(page[text_from:at])
            parts.append((page[at + 9:end], linked))
            at = text_from = end + 3
            continue
        m = _TAG.match(page, at)
        if not m and page[at + 1:at + 2] not in ("!", "?"):
            at += 1
            continue
        end = scan.tag_end(m.end()) if m else page.find(">", at) if scan.last_gt > at else -1
        if end < 0:
            break           # no tag ends any more
        add(page[text_from:at])
        at = text_from = end + 1
        if not m:
            continue
        tag, ending, attrs = m[2].lower(), bool(m[1]), page[m.end():end]
        alone = attrs.rstrip().endswith("/")
        if tag in RAW or tag in DRAWN:
            if not ending and not alone:
                # the content isn't text
                close = scan.drawn_end(at) if tag in DRAWN else scan.close_of(tag, at)
                at = text_from = close if close >= 0 else len(page) if tag in RAW_TO_END else at
            continue
        if tag in INLINE:
            if tag == "a":
                linked = not ending
                n_links += linked
            continue
        close_block()
        if tag in VOID or tag in ("html", "body"):
            continue
        if ending:
            if n_open[tag]:
                while opened[-1].tag != tag:
                    close_element()
                close_element()
            continue
        if alone:
            continue
        # a paragraph ends where a block begins
        if opened[-1].tag == "p":
            close_element()
        if tag in IMPLIED and opened[-1].tag == tag:
            close_element()
        up = opened[-1]
        number, article = len(parents), up.article
        # a header within an article holds its headline
        own = tag in BOILERPLATE and not (tag == "header" and article)
        if tag in MAIN_TAGS and not up.boilerplate:
            article = number
        boilerplate = up.boilerplate or own or (tag not in MAIN_TAGS and _is_marked(attrs, article))
        home = up.home if tag in PIECES else number
        listed = up.listed or (number if tag in LISTS else 0)
        opened.append(Element(tag, number, boilerplate, article, home, listed))
        n_open[tag] += 1
        parents.append(up.number)
        lasts.append(number)
        tags.append(tag)
    add(page[text_from:])
    close_block()
    while len(opened) > 1:
        close_element()
    return Page(blocks, parents, lasts, tags)


def surges(weights: list[int], window: int = WINDOW, surge: int = SURGE) -> list[tuple[int, int]]:
    """(first, last) blocks of the stretches: from the surge of the window sums to their dive."""
    sums = [sum(weights[i:i + window]) for i in range(len(weights))]
    out, start = [], None
    for i, s in enumerate(sums):
        if start is None and s >= surge and weights[i] > 0:
            start = i
        elif start is not None and s == 0:
            out.append((start, i - 1))
            start = None
    if start is not None:
        out.append((start, len(weights) - 1))
    return out


def _sums(pairs) -> dict[int, int]:
    out: dict[int, int] = {}
    for key, n in pairs:
        out[key] = out.get(key, 0) + n
    return out


def _around(parsed: Page, article: int) -> set[int]:
    """The elements from the article's outermost <main> down to its parent, none if it has no <main> around it."""
    path, outermost = [], 0
    while article := parsed.parents[article]:
        path.append(article)
        if parsed.tags[article] == "main":
            outermost = len(path)
    return set(path[:outermost])


def main_text(page: str | None, window: int = WINDOW, share: float = SHARE) -> str:
    parsed = blocks_of(page or "")
    blocks = parsed.blocks
    by_article = _sums((b.article, b.weight) for b in blocks if b.article)
    # lists of which no item has text beside its links are menus
    free_lists = _sums((b.listed, b.weight) for b in blocks if b.listed)

    def one_link(b: Block) -> bool:
        return not b.boilerplate and b.links == 1 and (not b.listed or free_lists[b.listed] > 0)

    free = [0 if b.article else b.weight for b in blocks]
    outside = max((sum(free[a:b + 1]) for a, b in surges(free, window)), default=0)
    # the article with the most text bounds the search, unless more text stands outside
    best = max(by_article, key=lambda a: (by_article[a], -a), default=0)
    if (most := by_article.get(best, 0)) and most >= outside:
        around, whole, end = _around(parsed, best), set(), 0
        for a in sorted(by_article):
            if by_article[a] >= share * most:
                whole.add(a)
                if a == best or parsed.tags[a] == "article":
                    end = max(end, parsed.lasts[a])
            elif a <= end:          # within one of these
                whole.add(a)
        bound = [b for b in blocks if b.article and (b.article in whole or b.home in around)]
        weights = [b.weight for b in bound]
        return "\n".join(bound[i].text for first, last in surges(weights, window) for i in range(first, last + 1) if weights[i])
    weights = [b.weight for b in blocks]
    found = surges(weights, window)
    if not found:
        return ""
    amount = [sum(weights[a:b + 1]) for a, b in found]
    most = max(amount)
    a, b = found[amount.index(most)]
    by_home = _sums((x.home, x.weight) for x in blocks)
    # the element that holds most of the longest stretch; in the page itself its parts are blocks of their own
    held = max((x.home for x in blocks[a:b + 1]), key=lambda h: (by_home[h], -h))
    kept = {i for (a, b), n in zip(found, amount) if n >= share * most for i in range(a, b + 1) if weights[i]}
    for i, x in enumerate(blocks):
        if held and held <= x.home <= parsed.lasts[held] or x.home == held:
            if weights[i] or held and x.home == held and one_link(x):
                kept.add(i)
    return "\n".join(blocks[i].text for i in sorted(kept))


def extract_main(pages: DataFrame, window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for page_id, url, page in texts_of(batch, "page_id", "url", "html"):
                text = main_text(page, window, share)
                rows.append((page_id, url, text, len(text)))
            yield arrow_rows(rows, _MAIN)

    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html").mapInArrow(extract, MAIN_DDL)
