import html
import itertools
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from vedrina.llm import html_text
from vedrina.llm.html_blocks import parse
from vedrina.llm.html_text import PRIOR, edges_of, extracted, fitted, hints, learn, main_text, minimum_cut


def texts(page):
    return [block.text for block in parse(page)[1]]


@pytest.mark.parametrize(
    "page, blocks",
    [
        ("<p>a<p>b</p>c", ["a", "b", "c"]), ("<p><b>x  y<br>z</b><p>w", ["x y z", "w"]), ("a &amp; b &lt;i&gt; &copy; &#233;", ["a & b <i> © é"]),
        ("<ul><li>one<li>two<ul><li>deep</ul></ul>", ["one", "two", "deep"]), ("<script>var t='<p>no</p>';</script>yes", ["yes"]),
        ("<style>p{}</style><!-- <p>no</p> -->x<!-- never closed <p>y", ["x"]), ("<head><title>T</title></head><body>b", ["b"]), ("<head><title>T</title><body>b", ["b"]),
        ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]), ("a<div>b<span>c</span> d</div>e", ["a", "bc d", "e"]),
        ("1 < 2 and <3", ["1 < 2 and <3"]), ("<div title='a > b'>x</div>", ["x"]), ("<textarea>no</textarea><button>no</button>ok", ["ok"]),
        ("</p></div>x", ["x"]), ("<p>un<wbr>broken</p>", ["unbroken"]), ("<noscript><p>no</p></noscript>y", ["y"]), ("", []), (None, []), ("   ", []), ("<", ["<"]),
        ("<p>a  b</p>", ["a b"]), ("<select><option>no<option>no2</select>z", ["z"]),
    ],
)
def test_blocks(page, blocks):
    assert texts(page) == blocks


PAGE = """<!DOCTYPE html><html><head><title>T</title></head><body class="page">
<header class="site-header"><h1>My Site</h1><nav><a href=/>Home</a></nav></header>
<div id="cookie-notice"><p>We use cookies to improve. Accept please, by clicking here.</p></div>
<div class="wrapper"><div class="left"><ul class="menu"><li><a>One</a><li><a>Two</a></ul></div>
<div id="content"><h2>Title of the piece</h2><p>First paragraph, with <a href=x>a link</a> &amp; more text; it is long enough.</p><p>Second.
<p>Third   paragraph &lt;b&gt; is here.<blockquote>Quoted words, said by someone.</blockquote>
<ul><li>An item of the list that is content<li>Another item</ul><div class="ad">Buy now!</div><p>After the advert the text continues.</p></div>
<div class="comments"><p>Great article, I liked this very much. Thank you, sir.</p></div></div>
<form><p>Subscribe to our newsletter</p><input></form><p class="notice">Notice: this site, as is, may change.</p>
<aside><p>Related: a long teaser text about something else, that reads like prose.</p></aside><footer>&copy; 2020</footer></body></html>"""
CONTENT = [
    "Title of the piece", "First paragraph, with a link & more text; it is long enough.", "Second.", "Third paragraph <b> is here.",
    "Quoted words, said by someone.", "An item of the list that is content", "Another item", "After the advert the text continues.",
]


def test_page():
    assert main_text(PAGE, PRIOR).split("\n") == CONTENT


def test_page_without_hints():
    """Plain elements only: prose stays, lists of links go."""
    prose = "".join(f"<p>This is paragraph {n} of the text, and it says a few things about the matter at hand.</p>" for n in range(6))
    links = "".join(f"<li><a href='/{n}'>Link {n}</a></li>" for n in range(8))
    page = f"<body><div><ul>{links}</ul></div><div>{prose[:200]}{prose[200:]}</div><div><a>Contact</a> <a>Imprint</a></div></body>"
    found = main_text(page, PRIOR).split("\n")
    assert len(found) == 6 and all(line.startswith("This is paragraph") for line in found)


def cost(gain, edges, label):
    return sum(max(0, -g) if l else max(0, g) for g, l in zip(gain, label)) + sum(w for a, b, w in edges if label[a] != label[b])


@pytest.mark.parametrize("seed", range(30))
def test_cut_is_minimal(seed):
    dice = random.Random(seed)
    n = dice.randrange(1, 11)
    gain = [dice.choice([-5, -1, 0.3, 0.6, 1, 4]) * dice.random() for _ in range(n)]
    edges = [(a, b, dice.random() * dice.choice([0.2, 1, 3])) for a in range(n) for b in range(a + 1, n) if dice.random() < 0.5]
    best = min(cost(gain, edges, label) for label in itertools.product([False, True], repeat=n))
    assert cost(gain, edges, minimum_cut(gain, edges)) == pytest.approx(best)


def test_smoothness_decides_weak_blocks():
    edges = [(0, 1, 0.8), (1, 2, 0.8)]
    assert minimum_cut([3.0, -0.5, 3.0], edges) == [True, True, True]
    assert minimum_cut([3.0, -2.0, 3.0], edges) == [True, False, True]
    assert minimum_cut([-3.0, 0.5, -3.0], edges) == [False, False, False]


def test_edges():
    elements, blocks = parse("<div><p>a</p><p>b</p><div><p>x</p></div><p>c</p></div>")
    found = {(a, b): w for a, b, w in edges_of(elements, blocks)}
    assert set(found) == {(0, 1), (1, 2), (2, 3), (1, 3)}
    assert found[0, 1] > found[1, 2]


def test_innermost_hint_counts():
    elements, blocks = parse('<article><p>a</p><div class="comments"><p>b</p></div><header><h1>t</h1></header></article><nav><p>c</p></nav><p>d</p>')
    said = hints(elements)
    assert [said[block.element] for block in blocks] == [1, -1, 1, -1, 0]


@pytest.mark.parametrize(
    "page, said",
    [
        ('<div class="comments"><div class="body">x</div></div>', -1), ("<aside><article>x</article></aside>", -1), ("<form><main>x</main></form>", 1),
        ('<form class="search"><div class="content">x</div></form>', 1), ('<div class="wrap with-sidebar"><div class="entry">x</div></div>', 1),
        ('<div class="with-sidebar">x</div>', 0), ('<footer><div class="text-center">x</div></footer>', -1), ('<div class="text-center">x</div>', 0),
        ('<div id="post-comments">x</div>', -1), ('<section role="contentinfo">x</section>', -1), ("<p>x</p>", 0),
    ],
)
def test_what_elements_say(page, said):
    elements, blocks = parse(page)
    assert hints(elements)[blocks[0].element] == said


def test_many_blocks():
    page = "<article>" + "".join(f"<p>Line {n} of a very long article.</p>" for n in range(20_000)) + "</article>"
    assert main_text(page, PRIOR).count("\n") == 19_999
    weak = "".join(f"<p>w{n % 7} x</p><p>Longer text number {n}, that counts.</p>" for n in range(3000))
    assert len(main_text(weak, PRIOR)) > 0


def test_fit_is_drawn_to_the_prior():
    assert (fitted(np.empty((0, len(PRIOR))), np.empty(0)) == PRIOR).all()
    rows = np.tile(np.eye(len(PRIOR))[0], (400, 1))
    assert fitted(rows, np.ones(400))[0] > PRIOR[0] and fitted(rows, -np.ones(400))[0] < PRIOR[0]


def test_pages(spark):
    """The paragraphs of the article of every page, found by hand."""
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    weights = learn(pages)
    found = {row.page_id: row for row in extracted(pages, weights).collect()}
    for row in pages.collect():
        article = re.search(r"<article>(.*?)</article>", row.html, re.S)[1]
        plain = [html.unescape(re.sub(r"<[^>]+>", " ", part)) for part in re.split(r"</?p>|</?h1>", article)]
        expected = "\n".join(text for text in (" ".join(part.split()) for part in plain) if text)
        assert found[row.page_id].text == expected and found[row.page_id].n_chars == len(expected)
    assert (learn(pages.repartition(5)) == weights).all()


def test_awkward_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "v", PAGE), (3, "w", PAGE), (3, "w", PAGE), (4, "x", "<" * 5000), (5, "y", "<div>" * 3000 + "deep text, here.")]
    pages = spark.createDataFrame([(*row, "own", "own") for row in rows], "page_id bigint, url string, html string, text string, n_chars string")
    found = extracted(pages, learn(pages)).collect()
    assert len(found) == len(rows)
    by_id = {row.page_id: row for row in found}
    assert (by_id[1].text, by_id[1].n_chars, by_id[2].text, by_id[2].url) == ("", 0, "", None)
    assert by_id[3].text == by_id[None].text == "\n".join(CONTENT)
    none = pages.limit(0)
    assert extracted(none, learn(none)).count() == 0


def test_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(html_text, "SAMPLE_PAGES", 10)
    monkeypatch.setattr(html_text, "SAMPLE_BLOCKS", 7)
    seen = []
    monkeypatch.setattr(html_text, "fitted", lambda rows, labels: seen.append(len(rows)) or PRIOR)
    learn(spark.read.parquet(f"{SF_DIR}/pages.parquet").withColumn("extra", F.lit(1)))
    assert seen == [7]


LONG = "This is a paragraph of the article, and it says a few things about the matter at hand."


@pytest.mark.parametrize(
    "page",
    [
        '<div class="content-sidebar-wrap"><main class="content">{}</main></div>', '<div class="wrapper sidebar-right">{}</div>',
        '<div class="post category-social">{}</div>', '<div id="legal"><article>{}</article></div>', '<div class="social"><main>{}</main></div>',
        '<div id="legal"><div class="content">{}</div></div>', '<div id="sidebar-right"><article>{}</article></div>',
    ],
)
def test_a_boilerplate_word_of_a_wrapper_does_not_lose_the_article(page):
    page = page.format(f"<p>{LONG}</p><p>{LONG}</p>")
    assert main_text(f"<body>{page}<footer><p>Imprint</p></footer></body>", PRIOR) == f"{LONG}\n{LONG}"


@pytest.mark.parametrize(
    "part",
    [
        '<div id="comments"><article class="comment-body"><p>Nice, thank you.</p></article></div>', '<div class="comments-area"><div class="comment-list"><p>Nice, thanks.</p></div></div>',
        '<aside><article><p>{}</p></article></aside>', '<nav><main><p>{}</p></main></nav>', '<div class="related"><article><a>Read this one</a></article></div>',
    ],
)
def test_boilerplate_besides_an_article_stays_out(part):
    part = part.format(LONG)
    assert main_text(f"<body><article><p>{LONG}</p></article>{part}</body>", PRIOR) == LONG
    assert main_text(f"<body><article><p>{LONG}</p>{part}</article></body>", PRIOR) == LONG


def test_text_and_neighbours_outweigh_a_mark():
    long = " ".join([LONG] * 9)
    page = f'<article><p>{long}</p><div class="promo"><p>{long}</p></div><p>{long}</p></article>'
    assert main_text(page, PRIOR).count("\n") == 2
    assert main_text(page.replace(f'promo"><p>{long}', 'promo"><p>Buy now!'), PRIOR).count("\n") == 1


@pytest.mark.parametrize(
    "page",
    [
        "<a " * 100_000, "<a " * 100_000 + ">", "<p x='" * 50_000, '<p x="' * 50_000 + ">", "<" * 300_000, "</" * 150_000, "<!-- " * 60_000, "<p a=b c " * 30_000,
        "<x>" * 60_000 + "</y>" * 20_000, "<x>" * 60_000 + "<td>" * 5_000, "<script>" + "</script " * 30_000, "<b x=" * 60_000 + "'>",
    ],
)
def test_spoiled_pages_are_read_in_one_go(page):
    start = time.perf_counter()
    parse(page)
    assert time.perf_counter() - start < 2


@pytest.mark.parametrize(
    "page, texts",
    [
        ("<p data-x=don't>One.</p><p>It's two.</p><p>Three isn't.</p>", ["One.", "It's two.", "Three isn't."]),
        ('<p title="a > b" class=x>One.</p><p title=\'it"s\'>Two.</p>', ["One.", "Two."]), ("<p title='it's'>One.</p>", ["One."]),
        ("<p class=\"open>One.</p><p>Two.</p>", ["One.", "Two."]), ("<p =x a=>One.</p>", ["One."]), ("<p/>One.<p / a = 'b' >Two.", ["One.", "Two."]),
        ("<p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> it is.</p>", ["So x=2 it is."]), ("<p>One. <a href='x", ["One. <a href='x"]),
        ("<script>a</scripts>b</script >c", ["c"]), ("<p>1 <2> 3 </3> <_> 4</p>", ["1 <2> 3 </3> <_> 4"]),
    ],
)
def test_tags_as_written(page, texts):
    assert [block.text for block in parse(page)[1]] == texts


def test_marks_are_read_from_attributes_only():
    elements, _ = parse("<div title='x class=ad id=nav' class=Content class=other>x</div><div style='display: none'>y</div><div data-hidden=1>z</div>")
    assert [element.marks for element in elements[1:]] == ["content", " hidden", ""]
