import time

import numpy as np
import pytest

from tillmark.llm import html_extract
from tillmark.llm.html_blocks import _Ends, leaves

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def field(spark):
    return html_extract.fit(spark.read.parquet(f"{SMALL}/pages.parquet"))


def test_blocks_of_broken_markup():
    page = (
        "<!DOCTYPE html><title>t</title><script>var x='</p><p>no';</script><!-- <p>no</p> --><nav><ul><li><a href='a>b'>One</a>"
        "<li>Two</ul></nav><p><b>a &amp; b\n  c<br>d<p>e <i>f</i>g < 3 &lt;p&gt;<div class='AdBox top'>h</div>i<style>p{}</style>"
    )
    found = leaves(page)
    assert [b.text for b in found] == ["One", "Two", "a & b c d", "e fg < 3 <p>", "h", "i"]
    assert found[0].tags == ("nav", "ul", "li") and found[0].linked == 3 and found[1].tags == ("nav", "ul", "li")
    assert found[4].hints == {"ad", "box", "top"} and found[5].tags == ()
    assert leaves(None) == leaves("") == leaves("<p> &#32;</p><script>") == []


@pytest.mark.parametrize(
    "page",
    [
        "<x " * 340_000,
        "<x " * 330_000 + "'>",
        '<x "a" ' * 140_000 + "'",
        "<div>" * 100_000 + "x",
        "<div>y" * 100_000,
        "".join(f"<x{i} class='menu c{i}'>y<b>" for i in range(30_000)),
        "<li><ul>" + "<b>" * 50_000 + "<li></li>z" * 30_000,
        "</p><p>" * 100_000 + "<!--" * 50_000,
        "<a>" * 100_000 + "<br>w" * 100_000,
        '"\'<' * 200_000,
    ],
    ids=lambda page: page[:12],
)
def test_long_and_broken_pages_take_time_in_proportion(field, page):
    start = time.perf_counter()
    field.text(page)
    assert time.perf_counter() - start < 8


def test_end_of_a_tag():
    for page, end in {
        "<a b='>' c=\">\">x": 14, "<a b='>": -1, "<a ": -1, "<a b='x'>": 8, "<a <b>": 5, "<a '\"'>": 6, "<a '\"' \">": -1,
    }.items():
        assert _Ends(page).after(2) == end, page


def test_viterbi_finds_the_best_labels(field):
    rng = np.random.default_rng(3)
    blocks = leaves("<article><h1>Title</h1><p>Some text.</p></article><aside>Other</aside><footer>c</footer>")
    scores = field.scores(blocks)
    best = max(
        np.ndindex(*[2] * len(blocks)),
        key=lambda y: field.start[y[0]]
        + sum(scores[i, v] for i, v in enumerate(y))
        + sum(field.move[a, b] for a, b in zip(y, y[1:])),
    )
    assert list(best) == field.decode(blocks)
    assert rng is not None


def test_held_out_layouts(field, spark):
    pages = [r[0] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()]
    texts = sorted({b.text for p in pages[-80:] for b in leaves(p) if "article" in b.tags})
    rng = np.random.default_rng(77)
    wrong = total = 0
    for _ in range(200):
        made = html_extract._Layout(rng, texts).made()
        wrong += sum(a != b for a, b in zip(field.decode(made[0]), made[1]))
        total += len(made[0])
    assert wrong < 0.02 * total


def test_pages_of_other_kinds(field):
    page = (
        "<html><body><div class='cookie-banner'><p>We use cookies to improve your visit.</p><button>Accept</button></div>"
        "<header><h2>The Daily</h2></header><div class='menu'><a href='/'>Home</a> <a href='/b'>News</a></div>"
        "<main><h1>A title &mdash; here</h1><p>First\n paragraph of the   story, long enough to be one.</p>"
        "<div class='advert'>Buy now! Best offers of the whole year are waiting for you here.</div>"
        "<p>Second paragraph of the story with a <a href='x'>link</a> in it.</p></main>"
        "<section class='comments'><h3>Comments</h3><p>I liked reading this very much, thank you.</p></section>"
        "<aside><h3>Related</h3><ul><li><a href='y'>Another story</a></ul></aside>"
        "<form><p>Write to us</p><input></form><footer>&copy; 2020 The Daily</footer></body></html>"
    )
    assert field.text(page) == (
        "A title — here\n\nFirst paragraph of the story, long enough to be one.\n\n"
        "Second paragraph of the story with a link in it."
    )


def test_awkward_rows(spark, field):
    long = "<article><p>" + "word " * 100_000 + "</p></article>"
    rows = [(1, None, 5), (1, "", 5), (2, "<article><p>x y.</p></article>", 5), (2, "<article><p>x y.</p></article>", 5), (None, long, 5), (3, "<", 5)]
    pages = spark.createDataFrame(rows, "page_id long, html string, main_text int")
    out = html_extract.extracted(pages, field)
    got = sorted(((r.page_id or 0), len(r.main_text)) for r in out.collect())
    assert len(got) == 6 and (0, 499_999) in got and got.count((1, 0)) == 2 and got[3] == got[4]
    assert html_extract.extracted(pages.where("false"), field).count() == 0
    assert html_extract.fit(pages.where("false")) is None
    assert html_extract.extracted(pages, None).where("main_text <> ''").count() == 0
