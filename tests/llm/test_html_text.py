"""HTML extraction: the article blocks of the pages, and layouts of other kinds."""

import html
import re

import pytest

from inkspring.llm import html_text as h
from inkspring.llm.common import table


@pytest.fixture(scope="module")
def weights():
    return h.Weights(h.labelled_pages())


def brute(page):
    """For pages with one <article> of plain blocks."""
    a = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)[1]
    return "\n\n".join(x for x in (" ".join(html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in re.split(r"</?(?:h1|p)>", a.replace("<br>", " "))) if x)


def test_pages(spark, sf):
    pages = {r["page_id"]: r["html"] for r in table(spark, "/root/testdata/sf0.01", "pages").collect()}
    got = h.extract(table(spark, "/root/testdata/sf0.01", "pages")).collect()
    assert len(got) == len(pages)
    wrong = [r["page_id"] for r in got if r["text"] != brute(pages[r["page_id"]])]
    assert not wrong and all(r["n_chars"] == len(r["text"]) for r in got)


LONG = "A sentence of the article that runs on for quite a few words before it ends."


@pytest.mark.parametrize(
    "page, want",
    [
        (f"<html><body><div class='menu'><a href=/>Home</a> <a href=/a>About us</a></div><div class='content'><h1>Title</h1><p>{LONG}</p><p>Short.</p></div><div id='comments'><p>{LONG} I disagree.</p></div></body></html>", ["Title", LONG, "Short."]),
        (f"<body><header><h1>Site name</h1></header><main><h1>T</h1><p>{LONG}</p><aside><p>{LONG} Aside.</p></aside><p>{LONG}</p><div class='ad-banner'>{LONG}</div><p>End.</p></main><footer>{LONG}</footer></body>", ["T", LONG, LONG, "End."]),
        (f"<article><header><h1>Head</h1></header><p>{LONG}<br>next &amp; last&nbsp;&eacute;&#x41;</p><section class='comments'><article><p>{LONG}</p></article></section></article>", ["Head", f"{LONG} next & last éA"]),
        (f"<div class='cookie-notice'>{LONG}</div><article><p>{LONG}<form>{LONG}</form><script>var a = '<p>{LONG}</p>';</script><style>p {{}}</style><p>x < y</article><div class=sidebar>{LONG}</div>", [LONG, "x < y"]),
        (f"<p>{LONG}</p><p>{LONG}</p>", [LONG, LONG]),
        (f"<nav><ul><li><a>One</a><li><a>Two</a></ul></nav><article><p>{LONG}</p><ul><li>first</li><li>second</li></ul><p>Tail", [LONG, "first", "second", "Tail"]),
    ],
)
def test_layouts(weights, page, want):
    assert weights.extract(page) == "\n\n".join(want)


def test_odd_pages(spark, weights):
    rows = [(1, None, None), (2, "u", ""), (3, "u", "plain words only"), (4, "u", "<nav><a>x</a></nav>"), (5, "u", "<article>a<!-- no end"), (6, "u", "<b>" * 20_000 + "word</i>" * 20_000), (7, "u", "<p title=\"a>b\">ok</p><p title='open>x"), (8, "u", "<article>" + "<p>word word</p>" * 30_000)]
    got = {r["page_id"]: r["text"] for r in h.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1] == got[2] == got[4] == "" and got[3] == "plain words only" and got[5] == "a"
    assert got[7].startswith("ok") and got[8].count("\n\n") == 29_999
    assert h.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize(
    "page",
    [
        f"<article><p>{LONG}</p><svg width='9' viewBox='0 0 1 1'/><p>{LONG}</p><math/><p>{LONG}</p></article>",
        f"<article><p>{LONG}</p><video-js id=v></video-js><p>{LONG}</p><button-group><i></i></button-group><p>{LONG}</p></article>",
        f"<html><body class='has-sidebar'><div class='content'><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div></body></html>",
        f"<html class='cookie-notice'><body class='sidebar'><article class='post with-comments'><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></article></body></html>",
        f"<body><div class='content with-sidebar'><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div><div class='main-nav'>{LONG}</div></body>",
        f"<body><div id='content' class='sidebar-right'><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div><div class='footer container'>{LONG}</div></body>",
        f"<body><main class='no-header sidebar'><p>{LONG}</p><p>{LONG}</p><svg><text>{LONG}</text></svg><p>{LONG}</p></main><div class='sidebar wide'>{LONG * 9}</div></body>",
    ],
)
def test_article_text_is_kept(weights, page):
    assert weights.extract(page) == "\n\n".join([LONG] * 3)


@pytest.mark.parametrize(
    "page",
    [
        "<body class='has-sidebar'><div class='content'>{}</div></body>",
        "<body class='sidebar'><article class='post tags-python share-on'>{}</article></body>",
        "<form id='aspnetForm'><div>{}</div></form>",
        "<form id='aspnetForm' method=post><div class='nav'><a href=/>Home</a></div><article>{}</article></form>",
        "<article>{}</article><div class='rail'><p>LONG</p></div>",
        "<article>{}<div class='teaser'><p>LONG</p></div></article>",
        "<article>{}</article><div id='kommentare'><p>LONG</p><p>LONG</p></div>",
        "<div class='content'>{}</div><div class='kommentare'><p>LONG</p></div>",
        "<div class='sticky-bar'>LONG</div><div class='content'>{}</div><div class='outbrain'><p>LONG</p></div>",
        "<div class='content'>{}</div><div>&copy; 2024 Example Ltd. All rights reserved. <a href=/i>Imprint</a></div>",
        "<article>{}</article><div>Example Ltd, Some Street 5, Some Town <a href=/i>Imprint</a> <a href=/c>Contact</a></div>",
        "<div>{}</div><div>Example Ltd, Some Street 5, Some Town <a href=/i>Imprint</a> <a href=/c>Contact</a></div>",
    ],
)
def test_more_layouts(weights, page):
    body = f"<p>{LONG}</p>" * 3
    assert weights.extract(page.replace("LONG", LONG).replace("{}", body)) == "\n\n".join([LONG] * 3)


def _words_of(pieces, own):
    return "".join(p for p, c in pieces if c or not own).count("word")


def test_layouts_held_out_of_training(weights):
    """Pages of other seeds; a third version whose part names were never seen must still lose most of its noise."""
    off = found = extra = want = 0
    for pieces in h.labelled_pages(150, 991):
        got, right = weights.extract("".join(p for p, _ in pieces)).count("word"), _words_of(pieces, True)
        off += abs(got - right) > 0.1 * right
        want += right
        found += min(got, right)
        extra += max(0, got - right)
    assert off <= 0.2 * 150 and found >= 0.95 * want and extra <= 0.05 * want


def test_unseen_names(weights):
    pages = [[(re.sub("class='[^']*'|id='[^']*'", "class='zq17'", p), c) for p, c in pieces] for pieces in h.labelled_pages(100, 992)]
    found = extra = want = 0
    for pieces in pages:
        got, right = weights.extract("".join(p for p, _ in pieces)).count("word"), _words_of(pieces, True)
        want += right
        found += min(got, right)
        extra += max(0, got - right)
    assert found >= 0.9 * want and extra <= 0.35 * want


def brute_region(gains):
    best = (0.0, 0, 0, 0)
    for i in range(len(gains)):
        for j in range(i + 1, len(gains) + 1):
            s = sum(gains[i:j])
            if s > best[0] + 1e-9:
                best = (s, i, j, 0)
    return best[1:3]


def test_scan_is_the_best_run():
    import random

    rng = random.Random(3)
    for _ in range(60):
        g = [rng.uniform(-3, 3) for _ in range(rng.randint(0, 25))]
        a, b = h.Weights.region(g)
        x, y = brute_region(g)
        assert abs(sum(g[a:b]) - sum(g[x:y])) < 1e-6


def test_scan_is_needed(weights, monkeypatch):
    """Without the region, text beside it would stay on pages of several layouts."""
    pages = ["".join(p for p, _ in pieces) for pieces in h.labelled_pages(80, 993)]
    with_scan = [weights.extract(p) for p in pages]
    monkeypatch.setattr(h.Weights, "region", staticmethod(lambda gains: (0, len(gains))))
    changed = sum(weights.extract(p) != t for p, t in zip(pages, with_scan, strict=True))
    print("changed", changed)
    assert changed >= 8


BODY = [("h1", "A title"), ("p", LONG), ("p", "Short."), ("li", "first"), ("blockquote", f"{LONG} Twice."), ("p", LONG)]


@pytest.mark.parametrize("layout", range(3))
def test_brute_version_of_three_layouts(weights, layout):
    """The blocks of the content are joined plainly; everything around them is noise of that layout."""
    inside = "".join(f"<ul><li>{t}</li></ul>" if k == "li" else f"<{k}>{t}</{k}>" for k, t in BODY)
    noise = f"<ul>{'<li><a href=/x>Link here</a></li>' * 6}</ul>"
    page = [
        f"<html><body><nav>{noise}</nav><main>{inside}</main><aside><p>{LONG}</p></aside><footer><p>{LONG}</p></footer></body></html>",
        f"<body><div id='header'>{noise}</div><div id='wrapper'><div class='post-content'>{inside}</div><div class='sidebar'>{noise}<p>{LONG}</p></div></div><div id='footer'>{noise}</div></body>",
        f"<table><tr><td class='menu'>{noise}</td><td><div class='text'>{inside}</div></td></tr></table><div id='comments'><div class='comment'><p>{LONG}</p></div><div class='comment'><p>{LONG}</p></div></div>",
    ][layout]
    assert weights.extract(page) == "\n\n".join(t for _, t in BODY)


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "u", "<p>a few words here</p>", "t", 5), (1, "u", "<p>a few words here</p>", "t", 5)], "page_id long, url string, html string, text string, n_chars int")
    assert [tuple(r) for r in h.extract(df).collect()] == [(1, "u", "a few words here", 16)] * 2


A = LONG
B = "Another paragraph says something else, at about the same length, and then it stops."
E80 = " ".join(["plain words of a text"] * 16) + "."
E32 = " ".join(["plain words of it"] * 8) + "."
NOISE = "<ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li><li><a href=/c>About us</a></li></ul>"
BY_HAND = [
    ('links and a short paragraph', "<article><h1>Title</h1><p>Body one two three four.</p><p>Second paragraph <a href=y>link text</a> end.</p></article>",["Title","Body one two three four.","Second paragraph link text end."]),
    ('the same within a page', f"<html><body><nav>{NOISE}</nav><article><h1>Title</h1><p>Body one two three four.</p><p>Second paragraph <a href=y>link text</a> end.</p></article><footer>Imprint</footer></body></html>",["Title","Body one two three four.","Second paragraph link text end."]),
    ('a last paragraph that is a link', f"<article><h1>Title</h1><p>{A}</p><p><a href=x>Full report of the commission</a></p></article>",["Title",A,"Full report of the commission"]),
    ('the same in a div', f"<body><div class=nav>{NOISE}</div><div class=content><h1>Title</h1><p>{A}</p><p>{B}</p><p><a href=x>Full report of the commission</a></p></div><div class=footer>Imprint <a href=/i>Contact</a></div></body>",["Title",A,B,"Full report of the commission"]),
    ('layout class', f"<div class='sidebar-layout'><div class='main-col'><h1>Title</h1><p>{E80}</p></div></div>",["Title",E80]),
    ('layout class, short', f"<div class='sidebar-layout'><div class='main-col'><p>{E32}</p></div></div>",[E32]),
    ('layout class and a sidebar', f"<body><div class='sidebar-layout'><div class='main-col'><h1>Title</h1><p>{E80}</p><p>{A}</p></div><div class='sidebar'><p>{B}</p>{NOISE}</div></div></body>",["Title",E80,A]),
    ('class that ends in notice', f"<article><h1>Title</h1><p>{A}</p><div class='recipe-notice'><p>{B}</p></div><p>{A}</p></article>",["Title",A,B,A]),
    ('table layout', f"<table><tr><td><a href=/>Home</a> <a href=/n>News</a></td><td><h1>Title</h1><p>{A}</p><p>{B}</p></td></tr></table>",["Title",A,B]),
    ('table layout, lines', f"<table width=100%><tr><td><a href=/>Home</a><br><a href=/n>News</a><br><a href=/k>Contact</a></td><td><p>{A}</p><p>{B}</p><p>{A}</p></td></tr></table>",[A,B,A]),
    ('source at the end', f"<article><h1>Title</h1>{''.join(f'<p>{A}</p><p>{B}</p>' for _ in range(6))}<p>Source: <a href=y>the report of the commission</a></p></article>",["Title"]+[A,B]*6+["Source: the report of the commission"]),
    ('source at the end of main', f"<body><header><h2>Site</h2>{NOISE}</header><main><h1>Title</h1>{''.join(f'<p>{A}</p><p>{B}</p>' for _ in range(6))}<p>Source: <a href=y>the report of the commission</a></p></main><footer><p>&copy; 2024 Site</p></footer></body>",["Title"]+[A,B]*6+["Source: the report of the commission"]),
    ('blog', f"<body><div id=page class='hfeed site'><header id=masthead class=site-header><h1 class=site-title><a href=/>My blog</a></h1></header><div id=content class=site-content><div id=primary class=content-area><main id=main class=site-main><article id=post-12 class='post type-post has-post-thumbnail'><header class=entry-header><h1 class=entry-title>Title</h1></header><div class=entry-content><p>{A}</p><p>{B}</p><blockquote>{A}</blockquote><p>{B}</p></div></article></main></div><aside id=secondary class=widget-area><section class=widget><h2>Recent</h2>{NOISE}</section></aside></div><footer id=colophon class=site-footer><p>Proudly powered</p></footer></div></body>",["Title",A,B,A,B]),
    ('news', f"<body><div class=topbar>{NOISE}</div><div class=container><div class=row><div class='col-md-8'><h1>Title</h1><div class='article-body'><p>{A}</p><div class='ad-slot'>Buy this thing now</div><p>{B}</p><p>{A}</p></div><div class='share-buttons'><a href=#>Share</a> <a href=#>Tweet</a></div><div id='comments-section'><div class=comment><b>Joe</b><p>{B}</p></div><div class=comment><b>Ann</b><p>{A}</p></div></div></div><div class='col-md-4 sidebar'><h3>Most read</h3>{NOISE}</div></div></div><div class='cookie-banner'>{B} <button>OK</button></div></body>",["Title",A,B,A]),
    ('doc', f"<body><div class='navbar'>{NOISE}</div><div class='toc'>{NOISE}</div><div role=main class=document><h1>Title</h1><p>{A}</p><h2>Install</h2><pre>pip install x</pre><p>{B}</p><ul><li>First point of it</li><li>Second point</li></ul></div><div class=footer>Built with x.</div></body>",["Title",A,"Install","pip install x",B,"First point of it","Second point"]),
    ('plain', f"<html><body><h1>Title</h1><p>{A}</p><p>{B}</p><p>Short.</p></body></html>",["Title",A,B,"Short."]),
    ('wiki', f"<body><div id=mw-navigation>{NOISE}</div><div id=content class=mw-body><h1 id=firstHeading>Title</h1><div id=mw-content-text><p>{A} <a href=/w>term</a> and <a href=/v>other term</a> too.</p><p>{B}</p><ul><li><a href=/q>First thing</a> – a description of the first thing</li><li><a href=/r>Second thing</a> – a description of the second</li></ul></div></div><div id=footer>{NOISE}</div></body>",["Title",A+" term and other term too.",B,"First thing – a description of the first thing","Second thing – a description of the second"]),
    ('forum', f"<body><div class=header>{NOISE}</div><div class=post-content><h1>Title</h1><p>{A}</p><p>{B}</p></div><div class=replies><div class=reply><p>{A}</p></div><div class=reply><p>{B}</p></div></div></body>",["Title",A,B]),
    ('notice', f"<body><div class=notice>{A}</div><article><h1>Title</h1><p>{A}</p><p>{B}</p></article></body>",["Title",A,B]),
    ('newsletter', f"<article><h1>Title</h1><p>{A}</p><div class='newsletter-signup'><p>Get our newsletter every week.</p><form><input></form></div><p>{B}</p><p>{A}</p></article>",["Title",A,B,A]),
    ('related', f"<article><h1>Title</h1><p>{A}</p><p>{B}</p><aside class=related><h3>Related</h3>{NOISE}</aside></article>",["Title",A,B]),
    ('navlist', f"<div>{NOISE}</div><div><h1>Title</h1><p>{A}</p><p>{B}</p><p>{A}</p></div>",["Title",A,B,A]),
    ('short', f"<body><nav>{NOISE}</nav><article><h1>Title</h1><p>Just this.</p></article><footer><p>{B}</p></footer></body>",["Title","Just this."]),
    ('datatable', f"<article><h1>Title</h1><p>{A}</p><table><tr><th>Year</th><th>Count</th></tr><tr><td>1999</td><td>12</td></tr></table><p>{B}</p></article>",["Title",A,"Year","Count","1999","12",B]),
    ('links in text', f"<body><div id=menu>{NOISE}</div><div id=text><h1>Title</h1><p><a href=1>One</a> says that <a href=2>two</a> and <a href=3>three</a>.</p><p>{A}</p><p><a href=4>{B}</a></p></div></body>",["Title","One says that two and three.",A,B]),
    ('commentsfr', f"<div class=contenu><h1>Titre</h1><p>{A}</p><p>{B}</p></div><div class=commentaires><p>{A}</p><p>{B}</p></div>",["Titre",A,B]),
    ('alert in', f"<main><div class='alert'>Please log in to continue reading.</div><h1>Title</h1><p>{A}</p><p>{B}</p></main>",["Title",A,B]),
]


@pytest.mark.parametrize("name, page, want", BY_HAND, ids=[c[0] for c in BY_HAND])
def test_pages_by_hand(weights, name, page, want):
    """Layouts outside of the generator: links at the end, layout classes named after one part, tables, blogs, news."""
    assert weights.extract(page) == "\n\n".join(want)


def test_share_of_words_found(weights):
    """On held-out pages, with names and without."""
    for names, most in ((True, 0.03), (False, 0.08)):
        found = extra = want = 0
        for pieces in h.labelled_pages(150, 994):
            if not names:
                pieces = [(re.sub("class='[^']*'|id='[^']*'", "class='zq17'", p), c) for p, c in pieces]
            got, right = weights.extract("".join(p for p, _ in pieces)).count("word"), _words_of(pieces, True)
            want += right
            found += min(got, right)
            extra += max(0, got - right)
        print(names, found / want, extra / want)
        assert found >= 0.98 * want and extra <= most * want
