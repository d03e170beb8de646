"""The main text of web pages by a linear-chain conditional random field over leaf blocks.

A block's features are the tags around it, the words in their class, id and role, and what its text is like: length,
share in links, marks. The field scores each block as article or not, and each change between the two; Viterbi decoding
labels a page's blocks together. It is trained here, by maximum likelihood, on labelled pages that ``labelled_pages``
writes in several layouts; ``train`` takes any others.

Cases: a null or empty page, and one without text, gives an empty text. Broken and cut-off markup is read as browsers
do, as far as blocks go, but that no text is lost: a tag or quoted value that never ends is taken to end at the tag's first
``>`` (without one, the page ends there), and of a video, picture or the like that is never closed only the tag goes. Pages
of any size and depth take time and memory in proportion. Null ids, repeated rows and extra columns don't matter, as each page is read by itself; an
empty table gives an empty result.
"""

from __future__ import annotations

import functools
import math
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import text_or_empty, whole_row
from .html_blocks import Block, blocks

Page = tuple[list[Block], list[int]]
PAGES, STEPS, RATE, DAMPING = 600, 150, 0.15, 0.3


def features(block: Block, at: int, n: int) -> list[str]:
    text, size = block.text, len(block.text)
    place = block.place
    out = [f"tag:{place.tag}", f"parent:{place.above}", *place.around, *(f"own:{w}" for w in place.words)] if place else ["tag:-", "parent:-"]
    share = block.linked / size
    out.append(f"links:{0 if not block.linked else 1 if share < 0.3 else 2 if share < 0.8 else 3}")
    out.append(f"size:{min(8, int(math.log2(size + 1)))}")
    out.append(f"{'prose' if size > 80 and share < 0.3 else 'short'}:{block.tag}")
    if text[-1] in ".!?…:;\"'”":
        out.append("closed")
    if "©" in text or "copyright" in text.lower():
        out.append("rights")
    if " | " in text or " · " in text:
        out.append("bars")
    out.append("first" if at == 0 else "last" if at == n - 1 else "middle")
    return out


def train(pages: list[Page], steps: int = STEPS) -> tuple[dict[str, float], list[list[float]]]:
    """Weights by feature (for article against not) and the scores of changes [from][to]."""
    names: dict[str, int] = {}
    longest = max(len(b) for b, _ in pages)
    rows, slots, found, labels = len(pages), [], [], np.zeros((len(pages), longest), int)
    mask = np.zeros((rows, longest), bool)
    for i, (page, marks) in enumerate(pages):
        for t, block in enumerate(page):
            for f in features(block, t, len(page)):
                found.append(names.setdefault(f, len(names)))
                slots.append(i * longest + t)
            labels[i, t], mask[i, t] = marks[t], True
    slot, feature = np.array(slots), np.array(found)
    w, change = np.zeros(len(names)), np.zeros((2, 2))
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(change), np.zeros_like(change)]
    seen = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            seen[a, b] = ((labels[:, :-1] == a) & (labels[:, 1:] == b) & mask[:, 1:]).sum()
    for step in range(1, steps + 1):
        score = np.bincount(slot, w[feature], rows * longest).reshape(rows, longest)
        emit = np.stack([np.zeros_like(score), score], axis=2)
        forward, backward = np.zeros((rows, longest, 2)), np.zeros((rows, longest, 2))
        forward[:, 0] = emit[:, 0]
        for t in range(1, longest):
            forward[:, t] = np.logaddexp.reduce(forward[:, t - 1, :, None] + change, axis=1) + emit[:, t]
        for t in range(longest - 2, -1, -1):
            after = np.logaddexp.reduce(change[None] + (emit[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
            backward[:, t] = np.where(mask[:, t + 1, None], after, 0)
        ends = mask.sum(axis=1) - 1
        total = np.logaddexp.reduce(forward[np.arange(rows), ends], axis=1)
        likely = np.exp(forward + backward - total[:, None, None])[:, :, 1]
        gradient = np.bincount(feature, ((labels - likely) * mask).ravel()[slot], len(names)) - DAMPING * w
        pairs = forward[:, :-1, :, None] + change + (emit[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None]
        changes = seen - np.where(mask[:, 1:, None, None], np.exp(np.minimum(pairs, 0)), 0).sum(axis=(0, 1)) - DAMPING * change
        for k, (value, g) in enumerate(((w, gradient), (change, changes))):
            m, v = moments[2 * k], moments[2 * k + 1]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            value += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return {f: float(w[i]) for f, i in names.items()}, change.tolist()


def decode(page: list[Block], weights: dict[str, float], change: list[list[float]]) -> list[int]:
    """The best labels of a page's blocks together."""
    if not page:
        return []
    get, back, (a, b) = weights.get, [], (0.0, 0.0)
    for t, block in enumerate(page):
        score = sum(get(f, 0.0) for f in features(block, t, len(page)))
        if t == 0:
            a, b = 0.0, score
            continue
        from_a, from_b = (a + change[0][0], a + change[0][1]), (b + change[1][0], b + change[1][1])
        back.append((int(from_b[0] > from_a[0]), int(from_b[1] > from_a[1])))
        a, b = max(from_a[0], from_b[0]), max(from_a[1], from_b[1]) + score
    labels = [int(b > a)]
    for step in reversed(back):
        labels.append(step[labels[-1]])
    return labels[::-1]


def main_text(page: str, model: tuple[dict[str, float], list[list[float]]]) -> str:
    found = blocks(page, model[0])
    return "\n".join(b.text for b, label in zip(found, decode(found, *model)) if label)


class _Writer:
    """Writes labelled pages. Article text carries a mark that no other text has."""

    MARK = "⁣"

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.syllables = [a + b for a in "b c d f g l m n p r s t v".split() for b in "a e i o u an er on is".split()]

    def words(self, low: int, high: int) -> str:
        return " ".join("".join(self.r.choices(self.syllables, k=self.r.randint(1, 3))) for _ in range(self.r.randint(low, high)))

    def sentence(self, low: int = 4, high: int = 18) -> str:
        return self.words(low, high).capitalize() + self.r.choice(".....!?")

    def prose(self, most: int = 6) -> str:
        return " ".join(self.sentence() for _ in range(self.r.randint(1, most)))

    def mine(self, text: str) -> str:
        return self.MARK + text

    def inline(self, text: str) -> str:
        pick = self.r.random()
        if pick < 0.2:
            return f"<b>{text}</b>"
        if pick < 0.4:
            return text + f' <a href="/x">{self.words(1, 4)}</a> {self.words(2, 6)}.'
        return text.replace(" ", " &amp; ", 1) if pick < 0.5 else text

    def links(self, low: int = 2, high: int = 7) -> str:
        return "<ul>" + "".join(f'<li><a href="/{i}">{self.words(1, 3)}</a></li>' for i in range(self.r.randint(low, high))) + "</ul>"

    def maybe(self, chance: float, text: str) -> str:
        return text if self.r.random() < chance else ""

    def named(self, *names: str) -> str:
        return f'{self.r.choice(("class", "id", "class"))}="{self.r.choice(names)}"'

    def advert(self) -> str:
        body = self.r.choice((self.sentence(), f"<p>{self.prose(2)}</p>", f'<a href="/buy">{self.sentence()}</a>', f"{self.sentence()}\n{self.words(1, 2)}."))
        return f'<{(t := self.r.choice(("div", "div", "aside", "section")))} {self.named("ad", "ads", "advert", "ad-box", "advertisement", "promo", "sponsored", "banner-ad")}>{body}</{t}>'

    def notice(self) -> str:
        body = self.r.choice((self.prose(2), f"<p>{self.prose(2)}</p><button>{self.words(1, 2)}</button>"))
        return f'<div {self.named("cookie-notice", "cookie-banner", "notice", "alert", "consent", "gdpr", "popup", "modal")}>{body}</div>'

    def form(self) -> str:
        return (f'<form {self.named("newsletter", "search", "signup", "login", "contact-form")}><label>{self.words(1, 3)}</label><input name="q">'
                f'{self.maybe(0.5, f"<p>{self.prose(1)}</p>")}<button>{self.words(1, 2)}</button></form>')

    def comments(self) -> str:
        one = lambda: self.r.choice((f'<div class="comment"><b>{self.words(1, 2)}</b><p>{self.prose(3)}</p></div>',
                                     f'<li class="comment"><cite>{self.words(1, 2)}</cite> {self.prose(3)}</li>',
                                     f"<article><h4>{self.words(1, 2)}</h4><p>{self.prose(3)}</p></article>", f"<p>{self.prose(3)}</p>"))
        body = self.maybe(0.7, f"<h3>{self.words(1, 3)}</h3>") + "".join(one() for _ in range(self.r.randint(1, 5)))
        return f'<{(t := self.r.choice(("section", "div", "div", "ol")))} {self.named("comments", "comment-list", "reader-comments", "discussion", "responses", "disqus-comments")}>{body}</{t}>'

    def sidebar(self) -> str:
        body = self.maybe(0.6, f"<h3>{self.words(1, 3)}</h3>") + self.r.choice((self.links(), f"<p>{self.prose(2)}</p>", self.links() + self.advert()))
        if self.r.random() < 0.5:
            return f"<aside>{body}</aside>"
        return f'<div {self.named("sidebar", "side", "related", "widget", "rail", "recommended", "more-stories", "share social", "tags")}>{body}</div>'

    def top(self) -> str:
        nav = self.r.choice((f"<nav>{self.links()}</nav>", f'<div {self.named("menu", "nav", "navbar", "navigation", "topbar", "breadcrumb")}>{self.links()}</div>',
                             f'<ul {self.named("menu", "main-nav")}>' + self.links()[4:], f"<nav>{' | '.join(f'<a href=x>{self.words(1, 2)}</a>' for _ in range(4))}</nav>"))
        title = self.r.choice((f"<h1>{self.words(1, 4)}</h1>", f'<p class="tagline">{self.sentence()}</p>', f'<a href="/">{self.words(1, 2)}</a>', f"<div>{self.words(1, 3)}</div>"))
        head = self.r.choice((f"<header>{title}{nav}</header>", f"{nav}", f'<div {self.named("header", "site-header", "masthead")}>{title}</div>{nav}', f"<header>{title}</header>{nav}"))
        return head

    def bottom(self) -> str:
        body = self.r.choice((f"&copy; {self.words(1, 2)} &middot; {self.prose(2)}", f"<p>&copy; 2024 {self.words(1, 3)}</p>{self.links(2, 4)}", f"<p>{self.prose(2)}</p>",
                              f"Copyright {self.words(2, 4)}. {self.sentence()}"))
        return self.r.choice((f"<footer>{body}</footer>", f"<footer>{body}</footer>", f'<div {self.named("footer", "site-footer", "bottom", "legal", "copyright")}>{body}</div>'))

    def article(self) -> str:
        r, mine = self.r, self.mine
        title = f"<h1>{mine(self.words(2, 12))}</h1>"
        out = [self.maybe(0.85, r.choice((title, title, f"<header>{title}</header>", f'<h2 class="title">{mine(self.words(2, 9))}</h2>')))]
        for _ in range(r.choice((1, 1, 2, 3, 4, 6, 9))):
            pick = r.random()
            text = mine(self.inline(self.prose()))
            if pick < 0.62:
                out.append(f"<p>{text}</p>")
            elif pick < 0.68:
                out.append(f"<p><b>{text}<br>")  # left open
            elif pick < 0.76:
                out.append(f"<{(h := r.choice(('h2', 'h3')))}>{mine(self.words(1, 7))}</{h}>")
            elif pick < 0.82:
                out.append("<ul>" + "".join(f"<li>{mine(self.sentence(2, 12))}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
            elif pick < 0.86:
                out.append(f"<blockquote>{mine(self.prose(2))}</blockquote>")
            elif pick < 0.90:
                out.append("<table>" + "".join(f"<tr><td>{mine(self.words(1, 3))}</td><td>{mine(self.words(1, 2))}</td></tr>" for _ in range(r.randint(1, 3))) + "</table>")
            elif pick < 0.93:
                out.append(f"<pre>{mine(self.words(3, 12))}</pre>")
            elif pick < 0.96:
                out.append(f"<figure><img src=x><figcaption>{mine(self.sentence(3, 9))}</figcaption></figure>")
            else:
                out.append(f"<p>{mine(self.sentence(1, 5))}</p>")
            out.append(self.maybe(0.06, r.choice((self.advert, self.form, self.sidebar, self.notice))()))
        return "".join(out) + self.maybe(0.08, self.comments())

    def page(self) -> str:
        r, body = self.r, self.article()
        name = r.choice(("content", "main", "article-body", "post-content", "entry-content", "story", "page", "text", "main-content", "post", "article", "body", "wrap"))
        holder = r.choice(("<article>{}</article>", "<article>{}</article>", "<main><article>{}</article></main>", "<main>{}</main>", f'<div class="{name}">{{}}</div>',
                           f'<div id="{name}">{{}}</div>', '<div id="wrap"><div class="row"><div>{}</div></div></div>', f'<section class="{name}">{{}}</section>', "{}"))
        middle = holder.replace("{}", body)
        extra = [self.maybe(0.5, self.advert()), self.maybe(0.25, self.notice()), self.maybe(0.2, self.form()), self.maybe(0.3, self.sidebar())]
        r.shuffle(extra)
        after = [self.maybe(0.3, self.comments()), self.maybe(0.35, self.sidebar()), self.maybe(0.2, self.form()), self.maybe(0.25, self.advert()), self.maybe(0.1, self.notice())]
        r.shuffle(after)
        inner = self.maybe(0.93, self.top()) + "".join(extra) + middle + "".join(after) + self.maybe(0.93, self.bottom())
        page = f"<!DOCTYPE html><html><head><title>{self.words(2, 6)}</title><style>p{{margin:0}}</style></head><body><!-- x -->{inner}<script>var a='</p>';</script></body></html>"
        return page[: page.rfind("</footer>")] if "</footer>" in page and r.random() < 0.08 else page


def labelled_pages(n: int = PAGES, seed: int = 11) -> list[Page]:
    """Pages in the layouts that web pages have, their blocks with 1 for article and 0 for the rest."""
    writer, out = _Writer(seed), []
    for _ in range(n):
        found = blocks(writer.page())
        marks = [int(writer.MARK in b.text) for b in found]
        for b in found:
            b.text = b.text.replace(writer.MARK, "").strip() or "-"
        if found:
            out.append((found, marks))
    return out


@functools.lru_cache(maxsize=1)
def default_model() -> tuple[dict[str, float], list[list[float]]]:
    return train(labelled_pages())


def _extract(model):
    def run(batches):
        for batch in batches:
            texts = [main_text(page.as_py(), model) for page in batch.column("html")]
            yield pa.RecordBatch.from_arrays([batch.column("page"), pa.array(texts, pa.string())], ["page", "text"])
    return run


def extracted(pages: DataFrame, html_col: str = "html", model=None) -> DataFrame:
    """``page`` (the row as it came, without its html) and ``text``, the main text of the whole page."""
    others = pages.drop(html_col)
    row = whole_row(others, "page") if others.columns else F.lit(None).alias("page")
    asked = pages.select(row, text_or_empty(html_col).alias("html"))
    schema = asked.drop("html").schema.add("text", "string")
    return asked.mapInArrow(_extract(model or default_model()), schema)
