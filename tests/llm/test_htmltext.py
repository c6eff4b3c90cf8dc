import itertools
import random
import time

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import htmltext
from ledgerlens.llm.htmltext import extract

LONG = "This is the first paragraph of the article, with enough words to look like one."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("just  words\n here", "just words here"),
        (f"<article><h1>A &amp; B</h1><p>{LONG}</p></article>", f"A & B {LONG}"),
        (f"<body><nav><a href=x>Home</a></nav><article><p>{LONG}<p>Be.</article><footer>&copy; me</footer>", f"{LONG} Be."),
        (f"<article><p>one<b>two</b> <i>x</i>\n y<br>z</p><p>{LONG}</p><script>var a='<p>no</p>'</script></article>", f"onetwo x y z {LONG}"),
        (f"<main><p>{LONG}</p><!-- <p>no</p> --><style>p{{}}</style><p>caf&eacute; &#8364; &lt;b&gt;</p></main>", f"{LONG} café € <b>"),
        (f"<body><header><h1>Site</h1></header><article><p>{LONG}</p></article><section class='comments'><div class=comment><p>I think so too, this is quite a long comment.</p></div></section><aside><p>Read this too</p></aside></body>", LONG),
        (f"<div id=cookie-banner><p>We use cookies.</p></div><div class='post-content'><h2>T</h2><p>{LONG}</p><ul><li>one<li>two</ul></div><form><label>Mail</label><input></form>", f"T {LONG} one two"),
        (f"<article><table><tr><td>a<td>b</table><p>{LONG}</p></article>", f"a b {LONG}"),
    ],
)
def test_pages(page, text):
    assert extract(page) == text


def test_held_out_layouts():
    """Layouts that the model is not trained on, filled in many ways."""
    rng = random.Random(9)
    say = lambda: " ".join(rng.choices("red stone bridge over cold green water near town".split(), k=rng.randint(4, 30))) + "."
    right = total = 0
    for wrap, extra in itertools.product(("article", 'div class="entry"', "main", 'section id="article-body"'), ('<div class="sidebar"><p>{}</p></div>', "<aside><p>{}</p></aside>", '<div id="comments"><div class="comment"><p>{}</p></div></div>', '<div class="advert">{}</div>', '<div class="notice"><p>{}</p></div>')):
        for _ in range(5):
            body = [say() for _ in range(rng.randint(1, 6))]
            page = f"<html><body><nav><ul><li><a href=1>{say()}</a></li></ul></nav><{wrap}><h1>{body[0]}</h1>" + "".join(f"<p>{b}</p>" for b in body[1:]) + f"</{wrap.split()[0]}>" + extra.format(say()) + f"<footer><p>{say()}</p></footer></body></html>"
            total += 1
            right += extract(page) == " ".join(body)
    assert right / total > 0.95


def brute_marginals(model, nodes, blocks):
    """By summing over all labellings."""
    n, total, ones = len(nodes), 0.0, [0.0] * len(nodes)
    looks, edges = model.look(nodes, blocks), [None, *(model.edge(x) for x in nodes[1:])]
    for rest in itertools.product(htmltext.LABELS, repeat=n - 1):
        y, score = (htmltext.WRAPPER, *rest), 1.0
        for i, node in enumerate(nodes):
            score *= looks[i][y[i]] * (edges[i][y[node.parent]][y[i]] if i else 1.0)
        total += score
        for i in range(n):
            ones[i] += score * (y[i] == htmltext.CONTENT)
    return [x / total for x in ones]


def test_messages_against_enumeration():
    model = htmltext.trained()
    for page in (f"<div><p>{LONG}</p><ul><li><a>x</a></ul></div><div class=post><p>short</p></div>", f"<body><article><header>h</header><p>{LONG}</article><footer>f</footer>"):
        nodes, pieces = htmltext.parse(page)
        blocks = ["".join(b) for b in pieces]
        assert model.marginals(nodes, blocks)[1:] == pytest.approx(brute_marginals(model, nodes, blocks)[1:], abs=1e-6)


def test_table(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "v", f"<article><p>{LONG}</p></article>"), (3, "w", "<p>" * 3000 + "deep"), (3, "w", "<div>" * 3000 + "x" * 100_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = htmltext.extract_pages(pages).collect()
    assert [(r["page_id"], r["url"], r["n_chars"]) for r in got[:3]] == [(1, "u", 0), (2, None, 0), (None, "v", len(LONG))]
    assert len(got) == 5
    assert htmltext.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_text_of_any_element_within_the_article():
    page = "<html><body><nav><a href=x>Home</a></nav><article><h1>On sums</h1><p>We write <math><mi>x</mi><mo>=</mo><mn>2</mn></math> here, <noscript>without scripts</noscript> and <object>in an object</object> of a longer text.</p><p>Then <svg><text>drawn words</text></svg> follow, <audio>heard</audio> or <video>seen</video>, <span/>all of it kept in the article of this page.</p></article><script>var no = 1;</script></body></html>"
    got = htmltext.extract(page)
    for words in ("We write x = 2 here, without scripts and in an object of a longer text.", "Then drawn words follow, heard or seen, all of it kept"):
        assert words in got
    assert "Home" not in got and "var no" not in got


@pytest.mark.parametrize("mark", ["<a ", "<a", "<", '<a ">" ', "<a href='", '<p a="', "<div>", "</b>", "<i><div><b>", "<li><div>", "<svg/>", "<!", "<!-", "<a b=", "</script "])
def test_long_pages_of_one_mark_take_time_in_proportion(mark):
    page = mark * (1_000_000 // len(mark))
    began = time.process_time()
    htmltext.parse(page)
    htmltext.parse("<p " + "a" * 1_000_000 + ">")
    assert time.process_time() - began < 6


@pytest.mark.parametrize("depth", [1, 100, 300, 2000])
def test_wrappers_around_text_do_not_lose_it(depth):
    """Plain boxes, boxes with a hint and other elements, around a paragraph and the whole article."""
    deep = "<div>" * depth + f"<p>{LONG}</p>" + "</div>" * depth
    assert extract(f"<body><nav><a href=x>Home</a></nav><article>{deep}<p>{LONG}</p></article></body>") == f"{LONG} {LONG}"
    around = "<div class=content>" * depth + f"<article><p>{LONG}</p></article>" + "</div>" * depth
    assert extract(f"<body><nav><a href=x>Home</a></nav>{around}<footer>us</footer></body>") == LONG


def test_an_element_far_below_still_ends_its_like():
    page = "<table><tr><td>" + "<div>" * 1000 + f"{LONG}<td>two"
    assert [len(n.blocks) for n in htmltext.parse(page)[0] if n.tag == "td"] == [0, 1]


def test_quotes_hide_the_end_of_a_tag():
    nodes, blocks = htmltext.parse("<p title='a > b'>one</p><p data-x=\"'\">two</p><p title='open>three</p>")
    assert ["".join(b) for b in blocks] == ["one", "two", "three"]
    assert [n.tag for n in nodes] == ["#root", "p", "p", "p"]
