"""Main text: parsing, the cut against all labellings, and whole pages."""

import html
import itertools
import random
import re

import pytest

from sparktally.llm import html_cut

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head>
<body class="post"><header><p>Site header with a few words.</p></header>
<nav><ul><li><a href="/x">Menu</a></li><li>More</ul></nav><!-- <p>no</p> -->
<div class="cookie-notice">We use cookies and many other things, please agree to all of them.</div>
<article><h1>A&nbsp;title &amp; more</h1><p><b>First
   block<br>goes on. <a href="/y">A link</a>, ok.<p>Short.</p>
<div class="ad">Buy this now, it is the best thing that you can buy today.</div>
<aside>Related things</aside><ul><li>one<li>two</ul>
<form><label>Name</label><input><button>Send</button></form>
<pre>  kept   text </pre><table><tr><td>cell 1<td>cell 2</table>
<section id="comments"><p>A reader says this is a very good article, thank you.</p></section></article>
<footer>&copy; someone</footer></body></html>"""


def test_page_by_hand():
    assert html_cut.main_text(PAGE).split("\n") == [
        "A title & more", "First block goes on. A link, ok.", "Short.", "one", "two", "kept text", "cell 1", "cell 2"]


def test_class_names():
    page = ("<div class='site-header'><p>Name of the site and more words.</p></div>"
            "<p>Please agree to everything that we ask for, it is a long and dull text, but you have no choice.</p>"
            "<div id=main class='content has-sidebar'><p>Text one.</p><div class=article-footer>x</div>"
            "<p data-class=ad>Text two.</p><p class='cookie-warning'>w</p></div><div class=sidebar>side</div>")
    assert html_cut.main_text(page) == "Text one.\nText two."


def test_broken_markup():
    assert html_cut.main_text("") == "" and html_cut.main_text("<p") == "" and html_cut.main_text("<!-- open") == ""
    assert html_cut.main_text("<article><p>one <b>two<p>three</article><p class='ad'>x") == "one two\nthree"
    assert html_cut.main_text("<article>1 < 2 &lt; 3 &#65; &bogus; </article>") == "1 < 2 < 3 A &bogus;"
    assert html_cut.main_text("<article><p>a</b></i></div>b<script>c") == "ab"
    assert html_cut.main_text("<article><p title='>'>a</p></article>") == "a"
    deep = "<div>" * 5000 + "<article><p>deep text.</p></article>"
    assert html_cut.main_text(deep) == "deep text."
    assert html_cut.main_text("<b>" * 40_000 + "</i>" * 40_000 + "<article><p>deep text.</p></article>") == "deep text."


def test_page_without_article_element():
    body = "".join(f"<p>{'Sentences of the main text go on and on. ' * 8}</p>" for _ in range(3))
    page = f"<div id=menu><a href=x>Home</a></div><div>{body}</div><div><a href=a>One</a> <a href=b>Two</a></div>"
    assert len(html_cut.main_text(page).split("\n")) == 3


LONG = "Sentences of the main text go on and on. " * 8
OUTER = (f"<div class='wrap'><h1>A title</h1><p>{LONG}</p><p>{LONG}</p></div>", f"A title\n{LONG.strip()}\n{LONG.strip()}")


@pytest.mark.parametrize("around", [
    "<footer><div class='content'><p>(c) site</p></div></footer>",
    "<div class='cookie-bar'><div class='content'><p>We use cookies.</p></div></div>",
    "<aside><article><p>Another one.</p></article></aside>", "<div class=ad><div class=story>Buy</div></div>"])
def test_content_class_inside_boilerplate(around):
    page, text = OUTER
    assert html_cut.main_text(page + around) == text and html_cut.main_text(around + page) == text


def test_boilerplate_inside_content_is_no_content():
    page, text = OUTER
    assert html_cut.main_text(page + "<div class=content><footer><p>(c) site</p></footer></div>") == text


TEXT = f"A title\n{LONG.strip()}\nShort."
INNER = f"<h1>A title</h1><p>{LONG}</p><p>Short.</p>"


@pytest.mark.parametrize("names", ["class='post category-legal tag-privacy'", "class='category-social-media'",
                                   "class='tag-search tag-cookies'", "class='story promo'", "class='legal'", "id=privacy-policy"])
def test_article_whatever_its_classes(names):
    around = "<nav><a href=x>Home</a></nav>{}<div class='widget'>Other</div><footer>(c) site</footer>"
    assert html_cut.main_text(around.format(f"<article {names}>{INNER}</article>")) == TEXT
    assert html_cut.main_text(around.format(f"<main><article {names}>{INNER}</article></main>")) == TEXT
    assert html_cut.main_text(around.format(f"<main {names}>{INNER}</main>")) == TEXT


@pytest.mark.parametrize("names", ["class='layout sidebar-right'", "class='sidebar-right'", "class='page widget-area'",
                                   "id=page-social", "class='fixed-header'", "class='wrap cookies'"])
def test_class_word_on_a_wrapper(names):
    beside = "<div class='cookie-bar'>We use cookies.</div><div class=sidebar><a href=x>One</a></div>"
    for inner in (INNER, f"<article>{INNER}</article>", f"<div class=search>{INNER}</div>"):
        assert html_cut.main_text(f"<div {names}>{inner}{beside}</div>{beside}<footer>(c) site</footer>") == TEXT


def test_claims_stand_beside_content():
    comments = f"<div class='comments'><p>{LONG}</p><article class='comment-body'><p>{LONG}</p></article></div>"
    related = f"<div class='related'><article class='post'><p>{LONG}</p></article></div>"
    assert html_cut.main_text(f"<article>{INNER}</article>{comments}{related}<article class='ad'>Buy</article>") == TEXT
    assert html_cut.main_text(f"<div>{INNER}{comments}</div>{related}<div class='widget post'>Popular</div>") == TEXT
    assert html_cut.main_text(f"<ul class='category-menu'><li>One</ul><article>{INNER}</article>") == TEXT
    assert "Sentences" not in html_cut.main_text(f"<div class='cookie-consent'><p>{LONG}</p><p>{LONG}</p></div>Short.")


ITEMS = ["milk", "two eggs", "a cup of flour", "some salt", "butter", "an apple"]
LIST = "<ul>" + "".join(f"<li>{x}</li>" for x in ITEMS) + "</ul>"
TABLE = "<table><tr><th>what</th><th>how much</th></tr><tr><td>milk</td><td>1 l</td></tr></table>"


@pytest.mark.parametrize("whole,inner", [(LIST, ITEMS), (TABLE, ["what", "how much", "milk", "1 l"]),
                                         (LIST.replace("ul", "ol"), ITEMS), (LIST * 2, ITEMS * 2),
                                         (LIST.replace("two eggs", "<a href=x>two eggs</a>"), ITEMS)])
def test_lists_and_tables_stay_with_their_text(whole, inner):
    text = "\n".join(inner)
    assert html_cut.main_text(f"<div><h1>T</h1><p>{LONG}</p>{whole}<p>{LONG}</p></div>") == (
        f"T\n{LONG.strip()}\n{text}\n{LONG.strip()}")
    assert html_cut.main_text(f"<div><h1>T</h1><p>{LONG}</p>{whole}</div>") == f"T\n{LONG.strip()}\n{text}"
    menu = "<ul>" + "<li><a href=x>Somewhere else</a></li>" * 5 + "</ul>"
    assert html_cut.main_text(f"{menu}<div><p>{LONG}</p>{whole}</div>{menu}") == f"{LONG.strip()}\n{text}"


def test_the_only_text_of_a_page():
    assert html_cut.main_text("<div>Hello world</div>") == "Hello world"
    assert html_cut.main_text("<div>Hello world</div><div><a href=x>Home</a></div>") == "Hello world"
    assert html_cut.main_text("<nav>Hello world</nav>") == html_cut.main_text("<div><a href=x>Home</a></div>") == ""


@pytest.mark.parametrize("comments", [
    f"<div class='thread'><p>{LONG}</p></div>", f"<article><p>{LONG}</p></article>" * 3,
    f"<div class='user-feedback'><p>{LONG}</p></div>", f"<section class='thread'><article><p>{LONG}</p></article></section>"])
def test_comments_inside_an_article(comments):
    inner = f"<h1>A title</h1><p>{LONG}</p><p>{LONG}</p>"
    assert html_cut.main_text(f"<article>{inner}{comments}</article>") == OUTER[1]


def test_an_article_around_the_article():
    assert html_cut.main_text(f"<article class=page><article>{INNER}</article></article>") == TEXT


LINKS = "<div><a href=x>Home</a> <a href=y>About the site</a></div>"


@pytest.mark.parametrize("page,text", [
    # a short subheading between paragraphs
    (f"<div><p>{LONG}</p><h2>Part two</h2><p>{LONG}</p></div>", f"{LONG.strip()}\nPart two\n{LONG.strip()}"),
    # a line that is a link, in a list of the text
    (f"<div><p>{LONG}</p><ul><li>milk</li><li><a href=x>two eggs</a></li><li>some salt</li></ul><p>{LONG}</p></div>",
     f"{LONG.strip()}\nmilk\ntwo eggs\nsome salt\n{LONG.strip()}"),
    # a caption without a full stop
    (f"<div><p>{LONG}</p><div>A view of the lake</div><p>{LONG}</p></div>", f"{LONG.strip()}\nA view of the lake\n{LONG.strip()}"),
    # a line of words among links
    (f"<div><p>{LONG}</p><p>{LONG}</p></div><div>{LINKS}<div>All that is here belongs to the owner of the site and to some friends"
     f"</div>{LINKS}</div>", f"{LONG.strip()}\n{LONG.strip()}"),
])
def test_the_cut_decides_where_costs_alone_are_wrong(page, text):
    blocks = html_cut.blocks_of(page)
    alone = "\n".join(b.text for b, cost in zip(blocks, html_cut.costs_of(blocks)) if cost <= 0)
    assert alone != text and html_cut.main_text(page) == text


def test_a_very_long_page():
    page = f"<div>{'<p>Some words of a long page.</p>' * 30_000}</div><div>{LINKS * 1000}</div>"
    assert html_cut.main_text(page).count("\n") == 29_999


def test_formulas_and_fallback_text():
    math = "<math><semantics><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></semantics></math>"
    page = f"<article><p>Let {math} be. <object data=a><param name=b>A chart.</object></p></article>"
    assert html_cut.main_text(page) == "Let x=1 be. A chart."


def test_many_claims():
    page = "<div class=ad>" * 20_000 + "x" + "</div>" * 20_000 + "<div class=ad>x</div>" * 5_000 + f"<article>{INNER}"
    assert html_cut.main_text(page) == TEXT


def total(costs, edges, away):
    return (sum(max(c, 0) for c, x in zip(costs, away) if not x) + sum(max(-c, 0) for c, x in zip(costs, away) if x)
            + sum(w for a, b, w in edges if away[a] != away[b]))


@pytest.mark.parametrize("seed", range(60))
def test_cut_is_least_of_all_labellings(seed):
    rng = random.Random(seed)
    n = rng.randint(1, 9)
    costs = [rng.choice([-3, -1.5, -0.5, 0, 0.5, 1, 2.5]) for _ in range(n)]
    edges = [(i, i + 1, rng.choice([0.5, 1.0, 2.0])) for i in range(n - 1)]
    edges += [(a, b, 1.0) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.25]
    got = html_cut.minimum_cut(costs, edges)
    best = min(total(costs, edges, x) for x in itertools.product([False, True], repeat=n))
    assert total(costs, edges, got) == pytest.approx(best)


def test_long_chain_of_undecided_blocks():
    n = 3000
    costs = [0.4 if i % 2 else -0.4 for i in range(n - 1)] + [3.0]
    away = html_cut.minimum_cut(costs, [(i, i + 1, 1.0) for i in range(n - 1)])
    assert away[-1] and len(set(away)) <= 2


def test_shared_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    for r in html_cut.extract(pages).collect():
        inner = re.search("<article>(.*?)</article>", source[r.page_id], re.S)[1]
        parts = re.split("</?(?:p|h1)>", inner.replace("<br>", " ").replace("<b>", "").replace("</b>", ""))
        parts = [" ".join(html.unescape(p).split()) for p in parts]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)


def test_awkward_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", PAGE), (3, "u", "plain text only"), (3, "u", "plain text only")]
    pages = spark.createDataFrame([(*r, "own") for r in rows], "page_id long, url string, html string, text string")
    got = html_cut.extract(pages).collect()
    assert len(got) == 5 and {r.text for r in got if r.page_id in (1, 2)} == {""}
    assert html_cut.extract(pages.limit(0)).count() == 0
