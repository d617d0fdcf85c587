"""HTML extraction with a linear-chain conditional random field over the leaf blocks of a page.

Each block is main text or not.  Its features are the elements around it, the words of their classes and ids, and what
its text looks like; neighbouring blocks are tied by transition weights.  Weights maximise the likelihood of labelled
pages; pages are decoded by Viterbi, whole, one after the other inside each task.

Labelled pages come from a bounded sample (``MAX_PAGES``) of the pages themselves.  Pages that mark their article with
an element for it are labelled by that.  As other pages do not, the paragraphs of the sample are set anew in layouts of
many kinds (menus, notices, adverts, forms, comments, sidebars, with and without elements that name them), whose labels
are known.
"""

from __future__ import annotations

import html
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillmark.llm.html_blocks import Leaf, leaves
from tillmark.llm.learning import Adam, bounded_sample

MAX_PAGES = 300
MAX_PAGE_CHARS = 50_000  # of a page that is used for training
LAYOUTS = 700
STEPS = 150
DECAY = 2e-3
SEED = 11

# Words of classes and ids, by what they tell.
HINTS = {
    "nav": "nav navbar navigation menu menubar breadcrumb breadcrumbs topnav toc pagination pager",
    "ad": "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner adsense",
    "comment": "comment comments commentlist disqus reply replies respond discussion responses",
    "side": "sidebar side aside widget widgets related recommended recommendations popular trending teaser complementary",
    "foot": "footer foot copyright legal contentinfo colophon",
    "head": "header masthead top topbar logo branding site tagline",
    "notice": "cookie cookies consent notice gdpr alert popup modal overlay newsletter subscribe signup disclaimer message",
    "form": "form search login signin register contact field",
    "share": "share sharing social tags meta byline author date",
    "main": "article content main post story entry body text articlebody hentry prose",
}
_HINT_KIND = {word: kind for kind, words in HINTS.items() for word in words.split()}
# Elements that say what they enclose.
TELLING = frozenset(
    "article main nav header footer aside form button figure figcaption section table ul ol li dl blockquote pre p div h1 "
    "h2 h3 h4 h5 h6 dialog fieldset label menu a address details".split()
)


def page_blocks(page: str | None) -> list[Leaf]:
    """``leaves`` with what the model looks at, in time in proportion to the page."""
    return leaves(page, TELLING, frozenset(_HINT_KIND))


def features(blocks: list[Leaf]) -> list[list[str]]:
    """Names of what holds for each block."""
    out = []
    for place, block in enumerate(blocks):
        words = block.text.split()
        size = len(words)
        own = ["bias", f"leaf:{block.tag}"]
        own += [f"in:{tag}" for tag in block.inside & TELLING]
        own += [f"hint:{kind}" for kind in {_HINT_KIND[h] for h in block.hints if h in _HINT_KIND}]
        own.append(f"words:{min(size.bit_length(), 8)}")
        share = block.linked / max(len(block.text), 1)
        own.append("links:none" if share == 0 else "links:some" if share < 0.5 else "links:most")
        own.append("stop" if block.text[-1] in ".!?…" else "open")
        if "©" in block.text or "copyright" in block.text.lower():
            own.append("copyright")
        if place == 0:
            own.append("first")
        if place == len(blocks) - 1:
            own.append("last")
        if not block.inside & {"article", "main"}:
            own.append("unmarked")
        out.append(own)
    return out


@dataclass
class Field:
    """Weights of a two-label chain: by feature, by transition, and of the label that the first block has."""

    names: dict[str, int]
    emit: np.ndarray  # features x 2
    move: np.ndarray  # from x to
    start: np.ndarray

    def scores(self, blocks: list[Leaf]) -> np.ndarray:
        out = np.zeros((len(blocks), 2))
        for row, own in enumerate(features(blocks)):
            out[row] = self.emit[[self.names[f] for f in own if f in self.names]].sum(axis=0)
        return out

    def decode(self, blocks: list[Leaf]) -> list[int]:
        """The most likely labels of a page's blocks, by Viterbi."""
        if not blocks:
            return []
        rows = self.scores(blocks).tolist()
        (m00, m01), (m10, m11) = self.move.tolist()
        a, b = rows[0][0] + self.start[0], rows[0][1] + self.start[1]
        back = []
        for e0, e1 in rows[1:]:
            from_0, from_1 = a + m00 >= b + m10, a + m01 >= b + m11
            back.append((0 if from_0 else 1, 0 if from_1 else 1))
            a, b = (a + m00 if from_0 else b + m10) + e0, (a + m01 if from_1 else b + m11) + e1
        labels = [0 if a >= b else 1]
        for choice in reversed(back):
            labels.append(choice[labels[-1]])
        return labels[::-1]

    def text(self, page: str | None) -> str:
        blocks = page_blocks(page)
        return "\n\n".join(b.text for b, label in zip(blocks, self.decode(blocks)) if label)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(pages: list[tuple[list[Leaf], list[int]]]) -> Field:
    """Maximum-likelihood weights by forward and backward sums over all pages at once."""
    pages = sorted((p for p in pages if p[0]), key=lambda p: -len(p[0]))
    listed = [features(blocks) for blocks, _ in pages]
    names = {n: i for i, n in enumerate(sorted({f for page in listed for own in page for f in own}))}
    count, longest = len(pages), len(pages[0][0])
    page_of, place_of, feature_of = [], [], []
    gold = np.zeros((count, longest), int)
    inside = np.zeros((count, longest), bool)
    for p, (own, (_, labels)) in enumerate(zip(listed, pages)):
        gold[p, : len(labels)] = labels
        inside[p, : len(labels)] = True
        for t, found in enumerate(own):
            page_of += [p] * len(found)
            place_of += [t] * len(found)
            feature_of += [names[f] for f in found]
    flat, feature_of = np.array(page_of) * longest + np.array(place_of), np.array(feature_of)
    sizes = inside.sum(axis=1)
    target = np.zeros((count, longest, 2))
    target[np.arange(count)[:, None], np.arange(longest), gold] = 1
    target *= inside[..., None]
    moves = np.zeros((2, 2))
    for t in range(1, longest):
        np.add.at(moves, (gold[inside[:, t], t - 1], gold[inside[:, t], t]), 1)
    emit, move, start = np.zeros((len(names), 2)), np.zeros((2, 2)), np.zeros(2)
    step = Adam(emit.size + 6, 0.1)
    total = inside.sum()
    for _ in range(STEPS):
        score = np.stack([np.bincount(flat, emit[feature_of, k], count * longest) for k in (0, 1)], 1)
        score = score.reshape(count, longest, 2)
        ahead, behind = np.zeros((count, longest, 2)), np.zeros((count, longest, 2))
        ahead[:, 0] = score[:, 0] + start
        for t in range(1, longest):
            ahead[:, t] = _log_sum(ahead[:, t - 1, :, None] + move, 1) + score[:, t]
        for t in range(longest - 2, -1, -1):
            onward = _log_sum(move + (score[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(inside[:, t + 1, None], onward, 0.0)
        norm = _log_sum(ahead[np.arange(count), sizes - 1], 1)
        likely = np.exp(ahead + behind - norm[:, None, None]) * inside[..., None]
        both = np.exp(
            ahead[:, :-1, :, None] + move + (score + behind)[:, 1:, None, :] - norm[:, None, None, None]
        ) * inside[:, 1:, None, None]
        off = (likely - target).reshape(-1, 2)
        by_feature = np.stack([np.bincount(feature_of, off[flat, k], len(names)) for k in (0, 1)], 1)
        gradient = np.concatenate(
            [
                (by_feature / total + DECAY * emit / len(names)).ravel(),
                ((both.sum(axis=(0, 1)) - moves) / total).ravel(),
                (likely[:, 0] - target[:, 0]).sum(axis=0) / total,
            ]
        )
        change = step.change(gradient)
        emit = emit - change[: emit.size].reshape(emit.shape)
        move = move - change[emit.size : emit.size + 4].reshape(2, 2)
        start = start - change[emit.size + 4 :]
    return Field(names, emit, move, start)


_ASIDE = {"nav", "aside", "footer", "form", "header", "dialog"}
_AGAINST = {"nav", "ad", "comment", "side", "foot", "notice", "form", "share"}


def labelled_by_markup(page: str) -> tuple[list[Leaf], list[int]] | None:
    """A page's blocks with labels, where an element marks the article; None where none does."""
    blocks = page_blocks(page)
    if not any({"article", "main"} & b.inside for b in blocks):
        return None
    labels = []
    for block in blocks:
        kinds = {_HINT_KIND.get(h) for h in block.hints}
        marked = {"article", "main"} & block.inside
        labels.append(int(bool(marked) and not _ASIDE & block.inside and not _AGAINST & kinds))
    return blocks, labels


class _Layout:
    """One page of known labels, set from given paragraphs."""

    def __init__(self, rng: np.random.Generator, paragraphs: list[str]):
        self.rng, self.paragraphs = rng, paragraphs
        self.labels: list[int] = []
        self.out: list[str] = []

    def one(self, *of):
        return of[self.rng.integers(len(of))]

    def maybe(self, chance: float) -> bool:
        return self.rng.random() < chance

    def paragraph(self) -> str:
        return self.paragraphs[self.rng.integers(len(self.paragraphs))]

    def snippet(self, most: int) -> str:
        return " ".join(self.paragraph().split()[: self.rng.integers(1, most + 1)])

    def block(self, text: str, label: int, tag: str) -> None:
        text = html.escape(text)
        if self.maybe(0.15):
            text = f"<b>{text}</b>"
        if label and self.maybe(0.15):
            first, _, rest = text.partition(" ")
            text = f'{first} <a href="/x">{rest.split(" ")[0]}</a> {rest}' if rest else text
        self.out.append(f"<{tag}>{text}</{tag}>")
        self.labels.append(label)

    def named(self, tags: tuple[str, ...], names: tuple[str, ...]) -> tuple[str, str]:
        tag = self.one(*tags)
        name = f' {self.one("class", "id")}="{self.one(*names)}"' if tag in ("div", "section", "ul", "p") or self.maybe(0.5) else ""
        return f"<{tag}{name}>", f"</{tag}>"

    def menu(self) -> None:
        start, end = self.named(("nav", "nav", "div", "ul"), ("menu", "nav", "main-nav", "navbar", "breadcrumbs", "top-menu"))
        self.out.append(start)
        for _ in range(self.rng.integers(2, 8)):
            self.out.append(f'<li><a href="/{self.rng.integers(99)}">{html.escape(self.snippet(3))}</a></li>')
            self.labels.append(0)
        self.out.append(end)

    def box(self, tags: tuple[str, ...], names: tuple[str, ...], most: int, long: bool) -> None:
        start, end = self.named(tags, names)
        self.out.append(start)
        for _ in range(self.rng.integers(1, most + 1)):
            self.block(self.paragraph() if long and self.maybe(0.7) else self.snippet(10), 0, self.one("p", "div", "p", "li", "h3"))
        self.out.append(end)

    def advert(self) -> None:
        self.box(("div", "div", "aside", "section"), ("ad", "ads", "advert", "ad-banner", "sponsored", "promo-box"), 2, True)

    def notice(self) -> None:
        self.box(("div", "div", "dialog", "section", "aside"), ("cookie-notice", "cookie-banner", "consent", "gdpr", "alert notice", "newsletter", "popup", "subscribe-box"), 2, True)

    def form(self) -> None:
        self.out.append(self.one('<form action="/s">', '<form class="search">', '<form id="contact-form">'))
        for _ in range(self.rng.integers(1, 4)):
            self.block(self.snippet(6), 0, self.one("fieldset", "button", "p", "div"))
            self.out.append("<input>")
        self.out.append("</form>")

    def comments(self) -> None:
        self.box(("section", "div", "div", "ol", "aside"), ("comments", "comment-list", "comments-area", "disqus", "reader-comments", "replies"), 5, True)

    def sidebar(self) -> None:
        self.box(("aside", "aside", "div"), ("sidebar", "related", "widget", "side-column", "popular-posts", "recommended"), 4, True)

    def header(self) -> None:
        self.box(("header", "header", "div"), ("header", "site-header", "masthead", "page-header", "topbar"), 2, False)

    def footer(self) -> None:
        start, end = self.named(("footer", "footer", "div"), ("footer", "site-footer", "page-footer", "legal"))
        self.out.append(start)
        for _ in range(self.rng.integers(1, 4)):
            mark = "© " if self.maybe(0.5) else ""
            self.block(mark + (self.paragraph() if self.maybe(0.4) else self.snippet(8)), 0, self.one("p", "div"))
        self.out.append(end)

    def article(self) -> None:
        start, end = self.one(
            ("<article>", "</article>"),
            ("<article>", "</article>"),
            ("<main>", "</main>"),
            ("<main><article>", "</article></main>"),
            ('<div class="content">', "</div>"),
            ('<div id="main-content">', "</div>"),
            ('<div class="post">', "</div>"),
            ('<section class="entry story">', "</section>"),
            ("<div>", "</div>"),
            ("<section>", "</section>"),
        )
        self.out.append(start)
        if self.maybe(0.8):
            self.block(self.snippet(14), 1, "h1")
        for _ in range(self.rng.integers(1, 12)):
            kind = self.rng.random()
            if kind < 0.7:
                self.block(self.paragraph(), 1, "p")
            elif kind < 0.8:
                self.block(self.snippet(4), 1, "p")
            elif kind < 0.85:
                self.block(self.snippet(6), 1, self.one("h2", "h3"))
            elif kind < 0.9:
                self.out.append(self.one("<ul>", "<ol>"))
                for _ in range(self.rng.integers(2, 5)):
                    self.block(self.snippet(12), 1, "li")
                self.out.append("</ul>")
            elif kind < 0.93:
                self.block(self.paragraph(), 1, self.one("blockquote", "pre"))
            else:
                self.one(self.advert, self.sidebar, self.notice, self.form)()
        if self.maybe(0.12):
            self.comments()
        self.out.append(end)

    def made(self) -> tuple[list[Leaf], list[int]] | None:
        """The blocks and labels of one page; one in seven is nothing but its article."""
        bare = self.maybe(0.15)
        before = (self.notice, 0.35), (self.header, 0.5), (self.menu, 0.8), (self.advert, 0.4), (self.form, 0.2), (self.sidebar, 0.2)
        after = (
            (self.advert, 0.2), (self.comments, 0.5), (self.sidebar, 0.4), (self.form, 0.25), (self.menu, 0.15),
            (self.notice, 0.2), (self.footer, 0.85),
        )
        self.out.append("<html><body>")
        for part, chance in before:
            if not bare and self.maybe(chance):
                part()
        self.article()
        for part, chance in after:
            if not bare and self.maybe(chance):
                part()
        self.out.append("</body></html>")
        blocks = page_blocks("".join(self.out))
        return (blocks, self.labels) if len(blocks) == len(self.labels) else None


def training_pages(sample: list[str]) -> list[tuple[list[Leaf], list[int]]]:
    marked = [found for page in sample if (found := labelled_by_markup(page))]
    texts = sorted({b.text for blocks, labels in marked for b, label in zip(blocks, labels) if label})
    texts = texts or sorted({b.text for page in sample for b in page_blocks(page)})
    if not texts:
        return []
    rng = np.random.default_rng(SEED)
    made = [_Layout(rng, texts).made() for _ in range(LAYOUTS)]
    return marked + [m for m in made if m]


def fit(pages: DataFrame, *, id_column: str = "page_id", html_column: str = "html") -> Field | None:
    """A field trained on a bounded sample of ``pages``; None where the sample holds no text at all."""
    short = F.length(html_column).between(1, MAX_PAGE_CHARS)
    rows = bounded_sample(pages.where(short).select(id_column, html_column), MAX_PAGES, id_column).select(html_column)
    found = training_pages(sorted(r[0] for r in rows.collect()))
    return train(found) if found else None


def extracted(pages: DataFrame, field: Field | None, *, html_column: str = "html", column: str = "main_text") -> DataFrame:
    """``pages`` with the main text in ``column`` (replaced if there is one); empty where a page has none.

    The whole page is read, however long; nothing is dropped but what the field labels as not main text.
    """
    pages = pages.drop(column)
    schema = StructType([*pages.schema.fields, StructField(column, StringType())])

    def extract(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(html_column)).to_pylist()
            found = pa.array([field.text(t) if field else "" for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, column])

    return pages.mapInArrow(extract, schema)
