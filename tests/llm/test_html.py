from __future__ import annotations

import pytest

from pairforge.llm.html_text import extract_text, main_text

LONG = "This sentence is long enough to be a part of the text of an article, so that sums rise over it."


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("   \n ", ""), ("plain words only", "plain words only"),
    ("<article><h1>T</h1><p>a</p><p>b</p></article>", "T a b"),
    ("<article><p>fo<b>o</b> bar<br>baz<i>!</i></article><footer>&copy; x</footer>", "foo bar baz!"),
    ("<body><nav><ul><li><a href=/x>x</a></ul></nav><article><p>one<p>two &amp;&#233;&eacute; &lt;p&gt;</article>", "one two &éé <p>"),
    ("<article><p>a</p><aside>side</aside><p>b</p><div class='share-bar social'>s</div><p>c</p></article>", "a b c"),
    ("<article><p>a</p><form><p>f</p><input></form><section id=comments><p>reader</p></section></article><p>after", "a"),
    ("<header>site</header><main><header><h1>Head</h1></header><p>a</p></main>", "Head a"),
    ("<div class='page-header'><article><p>a</p></article></div>", "a"),
    ("<article class=post><p>a</p></article><div class=comments><article class=comment><p>r</p></article></div>", "a"),
    ("<article><script>var t='</p>';<b></script><style>p{}</style><!-- <p>no --><p>a > b</p><p title=\"x > y\">c</p></article>", "a > b c"),
    ("<article><p>a</p><!-- open <p>b", "a"), ("<article><p>a</p><a href='cut", "a"), ("<article><p>a &am", "a &am"),
    ("<article><b><p>x</p></article><footer>no</footer>", "x"), ("</div></p><article>a</i></article>", "a"),
    ("<article><p>a\n\t b&nbsp; c</p><p hidden>no</p><p style='display: none'>no</p></article>", "a b c"),
    ("<ARTICLE><P>A</P></ARTICLE><NAV>n</NAV>", "A"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a b c d"),
    ("<article><p>a</p><div role=dialog>We use cookies</div><button>ok</button></article>", "a"),
    ("<article><textarea>t</textarea><p>a</p><noscript>n</noscript><iframe>i</iframe><svg><text>s</text></svg></article>", "a"),
])
def test_cases(page, text):
    assert main_text(page) == text


def test_distribution_decides_without_an_article():
    menu = "".join(f"<div><a href=/{i}>Menu {i}</a></div>" for i in range(6))
    page = f"<body>{menu}<p>By me.</p><p>{LONG}</p><p>Short.</p><p>{LONG}</p>{menu}<div>tiny</div></body>"
    assert main_text(page) == f"By me. {LONG} Short. {LONG}"


@pytest.mark.parametrize("page,text", [
    # The sums decide around a declared article too: its lines weigh more, and text beside it that surges is kept.
    (f"<article><p>{LONG}</p><p>a</p></article><nav>n</nav><nav>n</nav><nav>n</nav><div>tiny</div>", f"{LONG} a"),
    (f"<article><p>{LONG}</p><p>a</p></article><nav>n</nav><nav>n</nav><nav>n</nav><div>{LONG}</div>", f"{LONG} a {LONG}"),
    (f"<div><p>{LONG}</p><p>{LONG}</p></div><article><p>Teaser</p></article>", f"{LONG} {LONG} Teaser"),
])
def test_distribution_decides_beside_an_article(page, text):
    assert main_text(page) == text


ADVERTS = "<div class=ad>x</div>" * 3


@pytest.mark.parametrize("page,text", [
    # Teasers in articles, beside a body in a plain element.
    (f"<div><p>{LONG}</p><p>{LONG}</p></div><div class=related><article><p>Teaser</p></article></div>", f"{LONG} {LONG}"),
    (f"<div class='related sidebar'><article><p>Teaser.</p></article></div><div><p>{LONG}</p></div>", LONG),
    # Wrappers with a telling class.
    (f"<div class='content no-sidebar'><p>{LONG}</p></div>", LONG),
    (f"<div class='content-sidebar'><p>{LONG}</p><div class=sidebar>Side.</div></div><p>By me.</p>", f"{LONG} By me."),
    (f"<form><p>{LONG}</p><p>Short.</p></form>", f"{LONG} Short."),
    (f"<p>{LONG}</p><div class=comments><p>{LONG}</p><p>{LONG}</p></div>", LONG),
    (f"<article><p>a</p></article><div class=ad>{LONG}</div>", "a"), (f"<article></article><div class=ad>{LONG}</div>", ""),
    # Short stretches.
    (f"<p>{LONG}</p>{ADVERTS}<p>The end.</p>", f"{LONG} The end."),
    (f"<h1>Title</h1>{ADVERTS}<p>{LONG}</p>{ADVERTS}<div>mid</div>{ADVERTS}<p>{LONG}</p>{ADVERTS}<div>tiny</div>", f"Title {LONG} mid {LONG}"),
    # Formulas.
    ("<article><p>where <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> holds</p></article>", "where x=2 holds"),
])
def test_text_is_not_lost(page, text):
    assert main_text(page) == text


def test_long_pages_are_kept_whole():
    words = [f"w{i}" for i in range(200_000)]
    page = "<article>" + "".join(f"<p>{' '.join(words[i : i + 50])}</p>" for i in range(0, len(words), 50)) + "</article>"
    assert main_text(page).split() == words


def test_broken_markup_stays_linear():
    assert main_text("<article>" + "<a href='" * 20_000) == ""
    assert main_text("<article>" + "<p>x" * 20_000).count("x") == 20_000
    assert main_text("<" * 50_000).count("<") == 50_000
    assert main_text("<div class=ad>" * 20_000 + "x") == ""


def test_rows(spark):
    schema = "page_id bigint, url string, html string, text string"
    rows = [(1, "u", "<article>é</article>", "own"), (1, "u", "<article>é</article>", None), (None, None, None, "own")]
    pages = spark.createDataFrame(rows, schema)
    found = sorted((tuple(r) for r in extract_text(pages).collect()), key=str)
    assert found == sorted([(1, "u", "é", 1), (1, "u", "é", 1), (None, None, "", 0)], key=str)
    assert extract_text(pages.where("false")).collect() == []


def test_all_pages_hold_their_article(spark):
    """Against the markup of the given pages: the text between the article tags, and nothing of menus, adverts and footers."""
    import html
    import re

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    texts = {r.page_id: r.text for r in extract_text(pages).collect()}
    for page in pages.collect():
        inner = re.search(r"<article>(.*)</article>", page.html, re.S).group(1)
        blocks = re.split(r"</?(?:p|h1|br)>", inner.replace("<b>", "").replace("</b>", ""))
        expected = " ".join(w for b in blocks for w in html.unescape(b).split())
        assert texts[page.page_id] == expected
