"""Main text of pages: the query against articles that are known, and pages that are odd, deep or long."""

import html.parser
import time
import tracemalloc

import pytest

from panelwright.llm import html_blocks, html_extract, queries

LINE = {"a", "b", "i", "em", "strong", "span", "code", "small", "sub", "sup", "u", "s", "mark", "abbr", "cite", "q", "time", "img", "wbr", "br"}


class Article(html.parser.HTMLParser):
    """The text of the article element, a line per block; what it holds of other kinds is left out."""

    OTHER = {"script", "style", "nav", "aside", "form", "header", "footer", "noscript", "section"}

    def __init__(self):
        super().__init__()
        self.inside, self.other, self.lines, self.parts = 0, [], [], []

    def close_line(self):
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append(text)
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag not in LINE:
            self.close_line()
        named = " ".join(v or "" for k, v in attrs if k in ("class", "id"))
        if tag == "article":
            self.inside += 1
        elif self.inside and (self.other or tag in self.OTHER or (tag == "div" and named)) and tag not in LINE and tag not in ("p", "li", "h1", "h2", "h3"):
            self.other.append(tag)

    def handle_endtag(self, tag):
        if tag not in LINE:
            self.close_line()
        if tag == "article":
            self.inside -= 1
        elif self.other and self.other[-1] == tag:
            self.other.pop()

    def handle_data(self, data):
        if self.inside and not self.other:
            self.parts.append(data)


def article_of(page):
    reader = Article()
    reader.feed(page or "")
    reader.close_line()
    return "\n".join(reader.lines)


def test_the_query_gives_the_articles(spark):
    """Every page of the table has its text in an article element; a plain reader finds it there."""
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    assert all("<article" in p for p in pages.values())
    got = queries.QUERIES["op8_html_extract"](spark, sf).collect()
    assert {r.page_id for r in got} == set(pages) and len(got) == len(pages)
    wrong = [r.page_id for r in got if r.text != article_of(pages[r.page_id])]
    assert len(wrong) <= 0.01 * len(pages), wrong[:5]
    assert all(r.n_chars == len(r.text) for r in got)


@pytest.mark.parametrize("page, want", [
    ('<article><p>a</p><p>b</p><a href="x', ["a", "b"]),
    ('<p>a <a href="x>y</a> z</p>', ["a y z"]),
    ("<p>a <b title='it>s'>y</b> z</p>", ["a y z"]),
    ("<p title=it's>a 'b' c</p>", ["a 'b' c"]),
    ("<p>1 < 2 <3</p>", ["1 < 2 <3"]),
    ("<p>a<!-->b</p>", ["ab"]),
    ("<p>a</p><!-- never closed <p>b</p>", ["a"]),
    ("<p>a</p><", ["a", "<"]),
    ("<p a=b=c d = 'e>f' g>x</p>", ["x"]),
    ("<p>a</p><div class=", ["a"]),
    ("<p>a<script>if (a < b) x = '</p>'</script>b</p>", ["ab"]),
    ("<li>a<li>b<ul><li>c</ul>d", ["a", "b", "c", "d"]),
])
def test_odd_markup(page, want):
    assert [b.text for b in html_blocks.blocks(page)] == want


ODD = {
    "a quote without its other": '<a ' * 80_000 + '"',
    "deep": "<div>x" * 40_000,
    "deep, each named": "".join(f'<div class="c{i} menu">x' for i in range(10_000)),
    "no end of tag but in quotes": '<a b=">"' * 30_000,
    "items under a deep list": "<li><ul>" + "<div>" * 15_000 + "<li>x</li>" * 15_000,
    "ends of nothing": "<div>" * 20_000 + "</p>x" * 30_000,
    "raw text that never ends": "<svg><script>" * 20_000,
}


@pytest.mark.parametrize("name", ODD)
def test_odd_pages_take_time_and_memory_in_proportion(name):
    """A quarter of a megabyte is done in seconds, at a few hundred bytes for each of its own."""
    model = html_extract.default_model()
    page = ODD[name]
    start = time.perf_counter()
    text = html_extract.main_text(page, model)
    assert time.perf_counter() - start < 8 and "<" not in text.replace('"<', "")
    tracemalloc.start()
    html_extract.main_text(page[: len(page) // 2], model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300 * len(page)


def test_known_features_change_nothing():
    model = html_extract.default_model()
    page = "<div class='menu a b'><p>x y z.</p></div><article class=zzz><p>Some text here.</p></article>"
    all_, known = html_blocks.blocks(page), html_blocks.blocks(page, model[0])
    assert html_extract.decode(all_, *model) == html_extract.decode(known, *model)
    assert [b.text for b in all_] == [b.text for b in known]
