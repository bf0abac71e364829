"""Main text of pages: awkward articles, malformed pages, and the whole table against a plain parser."""

import time
from html.parser import HTMLParser

import pytest

from conftest import SF_SMALL
from trustfeed.llm import html_blocks
from trustfeed.llm.queries import QUERIES

LONG = ("A sentence of the article goes on for a while. " * 8).strip()
P = f"<p>{LONG}</p>"


@pytest.mark.parametrize("page,want", [
    # adverts within an element without article
    (f"<div>{P * 3}{'<div class=ad>Buy</div>' * 3}<p>Closing.</p></div><div><p>Elsewhere</p></div>", [LONG] * 3 + ["Closing."]),
    # headline and lead before the article
    (f"<main><h1>Head</h1><p>Lead.</p><article>{P * 2}</article></main><p>Out</p>", ["Head", "Lead.", LONG, LONG]),
    (f"<main><div><header><h1>Head</h1></header><article>{P}</article></div><div><p>Teaser</p></div></main>", ["Head", LONG]),
    # a paragraph that is one link, beside a menu
    (f"<div>{P}<p><a href=x>One link</a></p>{P}<ul><li><a href=1>A</a></li><li><a href=2>B</a></li></ul></div>", [LONG, "One link", LONG]),
    # drawings
    (f"<article><p>A</p><svg><path>{P}</article><p>Out", ["A", LONG]),
    (f"<article><p>A <svg><g><svg></svg><text>no</text></g></svg>b</p><svg><foreignObject><p>no</p></foreignObject></svg>{P}</article>",
     ["A b", LONG]),
    # names that only look like boilerplate
    (f"<article>{P}<p id='share-price'>Price</p><div class='related-work'><h2>Work</h2></div><p class='ad-hoc'>Ad hoc</p>"
     "<div class='share-buttons'>no</div><div class='related posts'>no</div><div id='comments-2'><p>no</p></div></article>",
     [LONG, "Price", "Work", "Ad hoc"]),
    # words of other attributes mark nothing; far too large references
    (f"<article><p title='hidden class=ad'>Shown</p><p hidden>no</p><p>&#00065;&#{'9' * 6000};&#x41;</p></article>", ["Shown", "A�A"]),
    # the end tag of a paragraph may be missing before a block
    (f"<article><p class=ad>no<div>{LONG}</div></article>", [LONG]),
])
def test_whole_articles(page, want):
    assert html_blocks.main_text(page) == "\n".join(want)


@pytest.mark.parametrize("bad", ["a <b ", "<a title=\"it's 'q\" x ", "<a x=\">\" ", "<svg>", "<svg><p>", "<!--", "<![CDATA[", "</x>",
                                 "<title>", "<select>", "<!x ", "<div></p>", "<main><article>x"])
def test_long_malformed_pages_take_linear_time(bad):
    page = bad * (5_000_000 // len(bad))
    began = time.time()
    html_blocks.main_text(page)
    assert time.time() - began < 60


@pytest.mark.parametrize("page,want", [
    # short articles within a long one, and one beside it
    (f"<main><article>{P * 3}<article><p>Part.</p></article></article></main><p>Out</p>", [LONG] * 3 + ["Part."]),
    (f"<article>{P * 3}<section><article><p>Part.</p></article></section><p>End.</p></article><article><p>Out</p></article>",
     [LONG] * 3 + ["Part.", "End."]),
    # the text stands outside a short article
    (f"<div><article><p>Teaser</p></article></div><div id=text>{P * 3}</div>", ["Teaser"] + [LONG] * 3),
])
def test_no_part_of_the_text_is_left_out(page, want):
    assert html_blocks.main_text(page) == "\n".join(want)


def test_stray_signs_are_text():
    assert html_blocks.main_text("a <b 1 < 2 </ x") == "a <b 1 < 2 </ x"


class PlainArticle(HTMLParser):
    """Blocks within <article>, outside anything that isn't part of it."""

    OUT = {"script", "style", "nav", "aside", "footer", "form", "title"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.blocks, self.text = [], [], ""

    def end_block(self):
        words = self.text.split()
        if words:
            self.blocks.append(" ".join(words))
        self.text = ""

    def handle_starttag(self, tag, attrs):
        if tag not in html_blocks.INLINE:
            self.end_block()
        if tag not in html_blocks.VOID:
            self.open.append((tag, dict(attrs).get("class") or ""))

    def handle_endtag(self, tag):
        if tag not in html_blocks.INLINE:
            self.end_block()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                break

    def handle_data(self, data):
        tags = {t for t, _ in self.open}
        if "article" in tags and not tags & self.OUT and not any(c == "ad" for _, c in self.open):
            self.text += data


def test_the_pages_equal_a_plain_parser(spark):
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in QUERIES["op4_extract_main"](spark, SF_SMALL).collect()}
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    assert len(got) == len(pages) > 0
    for row in pages:
        plain = PlainArticle()
        plain.feed(row["html"] or "")
        plain.close()
        plain.end_block()
        text = "\n".join(plain.blocks)
        assert got[row["page_id"]] == (text, len(text))
