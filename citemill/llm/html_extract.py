"""The main text of pages, by boosted trees over the blocks of their documents.

No table says which blocks of a page are its article, so the trees are trained on pages that
are made up here: articles in many wrappings among menus, headers, notices, adverts,
sidebars, forms, comments and footers, tidy or not. The number of pages is a parameter, and
the model depends on nothing else.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from citemill.llm import boosting
from citemill.llm.common import byte_buffer, each_batch, runs, unused
from citemill.llm.html_dom import Blocks

TRAINING_PAGES = 900
_MARK = chr(0xE000)  # for private use
_RUN_BYTES, _RUN_ROWS = 2 << 20, 512


class _Writer:
    """Made-up pages; main text carries a mark."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        parts = [a + b for a in "b c d f g l m n p r s t v st tr sch".split() for b in "a e i o u é ü en er ion".split()]
        self.bank = ["".join(self.r.choice(parts) for _ in range(self.r.randint(1, 4))) for _ in range(3000)]

    def words(self, low: int, high: int) -> list[str]:
        return [self.r.choice(self.bank) for _ in range(self.r.randint(low, high))]

    def sentence(self, low: int = 1, high: int = 16) -> str:
        words = self.words(low, high)
        words = [w + "," if self.r.random() < 0.08 else w for w in words]
        return " ".join(words).capitalize() + self.r.choice("....!?")

    def prose(self, sentences: int) -> str:
        return " ".join(self.sentence() for _ in range(sentences))

    def odd(self, text: str) -> str:
        """Articles may be junk; they are main text all the same."""
        style = self.r.random()
        if style < 0.75:
            return text
        words = text.split()
        if style < 0.82:
            return " ".join(w + self.r.choice(("###", "***", "%%%", "$$$", "&amp;&amp;")) for w in words)
        if style < 0.88:
            return " ".join(w.upper() + "!!" for w in words)
        if style < 0.94:
            return " | ".join(words)
        return " ".join([words[0]] * len(words))

    def links(self, low: int, high: int, words: int = 3) -> str:
        return "".join(f'<li><a href="/{x}">{" ".join(self.words(1, words))}</a></li>' for x in self.words(low, high))

    def named(self, *names: str) -> str:
        """An attribute with such a name, now and then none."""
        if self.r.random() < 0.12:
            return ""
        name = self.r.choice(names)
        extra = self.r.choice(("", "", "-1", "-wrap", " clearfix", " row", "__inner", "-area", " left"))
        return f' {self.r.choice(("class", "class", "id"))}="{name}{extra}"'

    def wrapped(self, inside: str) -> str:
        for _ in range(self.r.choice((0, 0, 1, 2, 3))):
            name = self.r.choice(("", ' class="container"', ' class="row"', ' class="inner"', ' id="wrap"', ' class="col-8"'))
            inside = f"<div{name}>{inside}</div>"
        return inside

    def aside(self) -> str:
        """Something that is not the article."""
        r, kind = self.r, self.r.randrange(9)
        prose = self.prose(r.choice((1, 1, 2, 4)))
        if kind == 0:
            return f'<div{self.named("ad", "ads", "advert", "banner", "sponsored", "promo")}>{prose}</div>'
        if kind == 1:
            tag = r.choice(("aside", "div"))
            return f'<{tag}{self.named("sidebar", "side", "widget", "related")}><h3>{self.sentence(1, 4)}</h3><ul>{self.links(2, 9)}</ul></{tag}>'
        if kind == 2:
            return f'<div{self.named("cookie-notice", "consent", "notice", "alert", "newsletter", "popup")}><p>{prose}</p><button>ok</button></div>'
        if kind == 3:
            return f'<form{self.named("search", "login", "subscribe", "form")}><label>{self.sentence(1, 4)}</label><input name="q"><p>{prose}</p></form>'
        if kind == 4:
            return f'<div{self.named("share", "social", "tags", "share-bar")}><a href="/a">{self.sentence(1, 2)}</a> <a href="/b">{self.sentence(1, 2)}</a></div>'
        if kind == 5:
            return f'<div{self.named("related", "recommended", "more", "trending")}><h2>{self.sentence(1, 4)}</h2><ul>{self.links(2, 7, 9)}</ul></div>'
        if kind == 6:
            return f'<ul{self.named("breadcrumb", "menu", "pagination")}>{self.links(2, 6)}</ul>'
        if kind == 7:
            return f'<aside{self.named("sidebar", "aside", "promo")}><p>{prose}</p></aside>'
        return f'<div{self.named("ad", "advertisement", "sponsor", "widget")}><p><a href="/x">{prose}</a></p></div>'

    def comments(self) -> str:
        tag = self.r.choice(("div", "section"))
        each = "".join(
            f'<{self.r.choice(("div", "li", "article"))}{self.named("comment", "reply", "comment-body")}><p>{self.prose(self.r.randint(1, 4))}</p></div>'
            for _ in range(self.r.randint(1, 6))
        )
        return f'<{tag}{self.r.choice((" class", " id"))}="{self.r.choice(("comments", "replies", "comment-list", "disqus"))}"><h3>{self.sentence(1, 3)}</h3>{each}</{tag}>'

    def main(self, text: str) -> str:
        return _MARK + self.odd(text)

    def article(self) -> str:
        r, parts = self.r, []
        if r.random() < 0.85:
            parts.append(f"<h1>{self.main(self.sentence(1, 9))}</h1>")
        bare = r.random() < 0.1
        for _ in range(r.choice((1, 1, 2, 3, 5, 9, 20))):
            kind, text = r.random(), self.main(self.prose(r.choice((1, 1, 2, 4, 8))))
            if kind < 0.72:
                text = f"<b>{text}<br>" if r.random() < 0.15 else text
                parts.append(f"<p>{text}" + ("</p>" if r.random() < 0.85 else ""))
            elif kind < 0.78:
                parts.append(f"<h2>{self.main(self.sentence(1, 6))}</h2>")
            elif kind < 0.85:
                items = "".join(f"<li>{self.main(self.sentence())}</li>" for _ in range(r.randint(1, 6)))
                parts.append(f"<ul>{items}</ul>")
            elif kind < 0.89:
                parts.append(f"<blockquote><p>{text}</p></blockquote>")
            elif kind < 0.92:
                cells = "".join(f"<tr><td>{self.main(self.sentence(1, 3))}</td></tr>" for _ in range(r.randint(1, 4)))
                parts.append(f"<table>{cells}</table>")
            elif kind < 0.95:
                parts.append(f"<figure><img src=x><figcaption>{text}</figcaption></figure>")
            else:
                parts.append(f"<pre>{text}</pre>" if not bare else f"<div>{text}</div>")
            if r.random() < 0.06:
                parts.append(self.aside())
        inside = "".join(parts)
        kind = r.random()
        if kind < 0.45:
            return f'<article{self.named("post", "entry", "story", "") if r.random() < 0.5 else ""}>{inside}</article>'
        if kind < 0.6:
            return f"<main>{inside}</main>"
        if kind < 0.92:
            return f'<div{self.named("content", "post", "entry", "article", "story", "main", "article-body", "post-content", "text")}>{inside}</div>'
        return f'<table{self.named("layout", "page")}><tr><td><ul>{self.links(2, 6)}</ul></td><td>{inside}</td></tr></table>'

    def page(self) -> str:
        r = self.r
        parts = []
        if r.random() < 0.5:
            tag = r.choice(("header", "div"))
            parts.append(f'<{tag}{self.named("header", "masthead", "site-header", "top")}><h1><a href="/">{self.sentence(1, 3)}</a></h1><p>{self.sentence(1, 6)}</p></{tag}>')
        if r.random() < 0.85:
            tag = r.choice(("nav", "nav", "div"))
            parts.append(f'<{tag}{self.named("nav", "menu", "navbar", "main-menu") if tag == "div" or r.random() < 0.4 else ""}><ul>{self.links(2, 9)}</ul></{tag}>')
        parts += [self.aside() for _ in range(r.choice((0, 1, 1, 2)))]
        parts.append(self.wrapped(self.article()))
        if r.random() < 0.3:
            parts.append(self.comments())
        parts += [self.aside() for _ in range(r.choice((0, 0, 1, 2)))]
        if r.random() < 0.85:
            tag, says = r.choice(("footer", "footer", "div")), self.prose(r.choice((1, 1, 2, 3)))
            says = r.choice((f"&copy; {says}", f"<p>{says}</p>", f"<ul>{self.links(2, 6)}</ul><p>{says}</p>", f"site.example &middot; {says}"))
            parts.append(f'<{tag}{self.named("footer", "site-footer", "copyright") if tag == "div" or r.random() < 0.3 else ""}>{says}</{tag}>')
        end = "</body></html>" if r.random() < 0.9 else ""
        return f"<!DOCTYPE html><html><head><title>{self.sentence()}</title><script>a='</p>'</script></head><body>{''.join(parts)}{end}"


def training_rows(pages: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and labels of the blocks of made-up pages: leaves by mark, holders by their leaves."""
    writer, blocks = _Writer(seed), Blocks(_MARK)
    for _ in range(pages):
        blocks.add_page(writer.page())
    label = list(blocks.marked)
    for k in range(len(label) - 1, -1, -1):
        if label[k] and blocks.parent[k] >= 0:
            label[blocks.parent[k]] = True
    judged, rows = blocks.features()
    return rows, np.array(label, np.float64)[judged]


def train(pages: int = TRAINING_PAGES, seed: int = 11) -> boosting.Trees:
    return boosting.fit(*training_rows(pages, seed))


def extract(model: boosting.Trees, pages: list[str]) -> list[str]:
    blocks = Blocks()
    for html in pages:
        blocks.add_page(html)
    judged, rows = blocks.features()
    return blocks.texts(blocks.decode(judged, model.score(rows)))


def main_text(rows: DataFrame, model: boosting.Trees, html: str = "html") -> DataFrame:
    """``rows`` with ``text``, the page's main text, empty if there is none.

    A column ``text`` is replaced; others are kept. A null page counts as empty; a page without
    markup is one block. Pages of any length are parsed whole, in time linear in their
    length. No shuffle; an empty table gives an empty one.
    """
    rows = rows.drop("text") if html != "text" else rows
    (page,) = unused(rows, "page")
    given = rows.withColumn(page, F.coalesce(F.col(html), F.lit("")))
    rows = rows.drop("text")
    schema = rows.selectExpr("*", "'' text").limit(0).schema
    for field in schema:
        field.nullable = True
    shared = rows.sparkSession.sparkContext.broadcast(model)
    keep = rows.columns

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        _, offsets = byte_buffer(batch.column(page))
        for first, last in runs(offsets, _RUN_BYTES, _RUN_ROWS):
            part = batch.slice(first, last - first)
            found = extract(shared.value, part.column(page).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in keep], pa.array(found, pa.string())], names=[*keep, "text"]
            )

    return given.mapInArrow(each_batch(run), schema)
