"""HTML extraction: a conditional random field says which leaf blocks of a page are its main text.

Blocks are the runs of text between block elements. Features come from the elements around a block, the words of their
classes and ids, and its text: length, share of links, how it ends. The field is trained on `PAGES`
labelled pages, drawn by a fixed seed from the layouts below, and decoded by Viterbi. It is a few kilobytes and goes to the
tasks with the function; pages are worked on where they are read.

Defined cases: a null or empty html gives an empty text; markup that is broken or never closed is read to its end;
repeated rows give repeated results; an empty table gives an empty result. Only the named columns are read, whatever else
there is.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from ratingloom.llm.crf import Model, train
from ratingloom.llm.dom import Block, blocks_of

PAGES = 160
SEED = 1
LANDMARKS = frozenset("article main section nav header footer aside form table figure body".split())
LETTERS = re.compile("[a-z]+")
RIGHTS = re.compile(r"©|copyright|\(c\)|all rights", re.I)


def features_of(blocks: list[Block]) -> list[list[str]]:
    rows = []
    for block in blocks:
        words = block.text.count(" ") + 1
        share = 4 * block.linked // len(block.text)
        names = {f"last:{block.last}", f"words:{min(words.bit_length(), 6)}", f"links:{share}"}
        near = "none"
        for name, named in block.around:
            names.add(f"in:{name}")
            if name in LANDMARKS:
                near = name
            if named:
                names.update(f"class:{word}" for word in LETTERS.findall(named))
        names.add(f"near:{near}")
        names.add("ends" if block.text[-1] in ".!?…:;\"»”" else "open")
        if RIGHTS.search(block.text):
            names.add("rights")
        rows.append(sorted(names))
    return rows


# Layouts of the labelled pages: what parts of a page are called. Real sites use these names in many spellings.
MAIN = ("content", "main", "post", "entry", "article", "story", "text", "body", "page content", "entry-content", "post-body")
SIDE = ("sidebar", "side", "widget", "related", "rail", "aside", "recommended", "trending", "most-read")
MENU = ("nav", "menu", "navigation", "navbar", "breadcrumb", "breadcrumbs", "toc", "pagination", "skip", "tabs")
TOP = ("header", "site-header", "masthead", "topbar", "branding", "logo", "top")
LOW = ("footer", "site-footer", "bottom", "copyright", "legal", "credits", "colophon")
NOTICE = ("notice", "cookie", "cookie-notice", "cookies", "alert", "consent", "gdpr", "banner", "popup", "modal", "disclaimer")
ADVERT = ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "adsense", "ad-slot", "promotion", "sponsor")
TALK = ("comments", "comment", "discussion", "replies", "responses", "reply", "comment-list", "disqus")
SHARE = ("share", "social", "sharing", "follow", "subscribe", "newsletter", "signup", "login", "search", "tags", "meta", "byline")


class Layouts:
    """Draws pages as (label, html) parts. A label of None is markup that belongs to no block."""

    def __init__(self, seed: int):
        self.choose = random.Random(seed)

    def words(self, least: int, most: int, close: str = ".") -> str:
        sizes = [self.choose.randint(1, 9) for _ in range(self.choose.randint(least, most))]
        return " ".join("".join(self.choose.choices("aeionrstlmdé", k=n)) for n in sizes).capitalize() + close

    def chance(self, share: float) -> bool:
        return self.choose.random() < share

    def boxed(self, tags: tuple[str, ...], names: tuple[str, ...], inside: list) -> list:
        """`inside` in an element that says what it is by its tag, or by the class or id of another."""
        if tags and self.chance(0.5):
            tag = self.choose.choice(tags)
            return [(None, f"<{tag}>"), *inside, (None, f"</{tag}>")]
        tag, key = self.choose.choice(("div", "div", "section", "ul" if "menu" in names else "div")), self.choose.choice(("class", "id"))
        return [(None, f'<{tag} {key}="{self.choose.choice(names)}">'), *inside, (None, f"</{tag}>")]

    def links(self, label: int = 0) -> list:
        items = [f"<li><a href='/x'>{self.words(1, 3, self.choose.choice(('', '.')))}</a></li>" for _ in range(self.choose.randint(2, 6))]
        return [(None, "<ul>"), *((label, item) for item in items), (None, "</ul>")]

    def said(self, label: int, least: int = 1, most: int = 3) -> list:
        """Paragraphs, or text straight in its box, of any length: length alone must not decide."""
        if self.chance(0.4):
            return [(label, self.words(2, 30))]
        return [(label, f"<p>{self.words(1, 40)}</p>") for _ in range(self.choose.randint(least, most))]

    def form(self) -> list:
        field = "<input name=q><textarea>x</textarea>"
        return [(None, "<form>"), (0, f"<p>{self.words(1, 12)}</p>"), (None, field), (0, f"<button>{self.words(1, 2, '')}</button>"), (None, "</form>")]

    def main_text(self) -> list:
        parts = [(1, f"<h1>{self.words(1, 10, '')}</h1>")] if self.chance(0.9) else []
        if parts and self.chance(0.2):
            parts = [(None, "<header>"), *parts, (None, "</header>")]
        for _ in range(self.choose.randint(1, 7)):
            kind = self.choose.random()
            if kind < 0.6:
                parts.append((1, f"<p>{self.words(1, 60, self.choose.choice(('.', '.', '')))}</p>"))
            elif kind < 0.68:
                parts.append((1, f"<h2>{self.words(1, 6, '')}</h2>"))
            elif kind < 0.76:
                parts += [(None, "<ul>"), *((1, f"<li>{self.words(1, 15)}</li>") for _ in range(3)), (None, "</ul>")]
            elif kind < 0.8:
                parts.append((1, f"<blockquote>{self.words(3, 30)}</blockquote>"))
            elif kind < 0.84:
                cells = [(1, f"<td>{self.words(1, 4, '')}</td>") for _ in range(3)]
                parts += [(None, "<table><tr>"), *cells, (None, "</tr></table>")]
            elif kind < 0.88:
                parts += [(None, "<figure>"), (1, f"<figcaption>{self.words(2, 9)}</figcaption>"), (None, "</figure>")]
            elif kind < 0.9:
                parts.append((1, f"<pre>{self.words(2, 20, '')}</pre>"))
            elif kind < 0.92:
                parts.append((1, f"<div>{self.words(2, 40)}</div>"))
            else:
                parts += self.choose.choice((self.advert, self.side, self.form, self.share, self.notice))()
        return parts

    def menu(self) -> list:
        return self.boxed(("nav",), MENU, self.links())

    def top(self) -> list:
        return self.boxed(("header",), TOP, [(0, f"<{t}>{self.words(1, 4, '')}</{t}>") for t in self.choose.choice((("h1",), ("p",), ("div", "p")))])

    def low(self) -> list:
        mark = self.choose.choice(("&copy; 2000 ", "", "Copyright "))
        return self.boxed(("footer",), LOW, [(0, f"{mark}example.com &middot; {self.words(1, 15)}"), *(self.links() if self.chance(0.3) else [])])

    def notice(self) -> list:
        return self.boxed((), NOTICE, [*self.said(0), *([(0, "<button>OK</button>")] if self.chance(0.5) else [])])

    def advert(self) -> list:
        return self.boxed((), ADVERT, self.said(0))

    def side(self) -> list:
        return self.boxed(("aside",), SIDE, self.choose.choice((self.links, lambda: self.said(0), lambda: [(0, f"<h3>{self.words(1, 3, '')}</h3>"), *self.links()]))())

    def share(self) -> list:
        return self.boxed((), SHARE, self.choose.choice((self.links, lambda: self.said(0)))())

    def talk(self) -> list:
        each = [part for _ in range(self.choose.randint(1, 4)) for part in [(None, f'<div class="{self.choose.choice(TALK)}">'), *self.said(0), (None, "</div>")]]
        return self.boxed((), TALK, [(0, f"<h3>{self.words(1, 3, '')}</h3>"), *each])

    def page(self) -> list:
        before, after = [], []
        for part, share in ((self.top, 0.4), (self.menu, 0.8), (self.notice, 0.3), (self.advert, 0.6), (self.side, 0.25), (self.form, 0.15)):
            before += part() if self.chance(share) else []
        for part, share in ((self.share, 0.3), (self.talk, 0.35), (self.side, 0.3), (self.advert, 0.2), (self.form, 0.2), (self.notice, 0.1)):
            after += part() if self.chance(share) else []
        inside = self.main_text()
        if self.chance(0.25):
            before, after = [], []
        if self.chance(0.25):
            inside += self.talk()
        kind = self.choose.random()
        if kind < 0.5:
            main = [(None, "<article>"), *inside, (None, "</article>")]
        elif kind < 0.62:
            main = [(None, "<main>"), *inside, (None, "</main>")]
        elif kind < 0.84:
            main = self.boxed(("main", "article"), MAIN, inside)
        else:
            main = inside
        return [(None, "<body>"), *before, *main, *after, *(self.low() if self.chance(0.9) else []), (None, "</body>")]


def labelled(page: list) -> tuple[list[list[str]], list[int]]:
    """Features and labels of the blocks of a drawn page. A mark in each text says what label it was given."""
    html = "".join(part if label is None else re.sub(r"(<[^/>]*>)?([^<]+)", rf"\1#{label}#\2", part, count=1) if "<a" not in part else part.replace("'/x'>", f"'/x'>#{label}#") for label, part in page)
    blocks, labels = [], []
    for block in blocks_of(html):
        found = re.search(r"#([01])#", block.text)
        if found:
            text = re.sub(r"#[01]#", "", block.text)
            blocks.append(Block(text, block.around, min(block.linked, len(text)), block.last))
            labels.append(int(found[1]))
    return features_of(blocks), labels


@lru_cache(maxsize=1)
def trained(pages: int = PAGES, seed: int = SEED) -> Model:
    layouts = Layouts(seed)
    return train([labelled(layouts.page()) for _ in range(pages)], steps=40)


def main_text(html: str, model: Model) -> str:
    blocks = blocks_of(html)
    labels = model.decode(features_of(blocks))
    return "\n".join(block.text for block, label in zip(blocks, labels, strict=True) if label)


def extract(pages: DataFrame, model: Model | None = None, rows: int = 500) -> DataFrame:
    """page_id, url, text and n_chars of every page. `pages` needs page_id, url and html."""
    field = model or trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                some = batch.slice(at, rows)
                texts = [main_text(html or "", field) for html in some.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [some.column("page_id"), some.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    schema = pages.select("page_id", "url").schema.add("text", "string").add("n_chars", "long")
    return pages.select("page_id", "url", "html").mapInArrow(run, schema)
