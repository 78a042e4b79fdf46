from __future__ import annotations

import html
import random
import re

from meterfold.llm import html_template

PAGES = "page_id long, url string, html string"

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>x</p>";</script></head>
<body class="sidebar-left"><header><a href="/">Site</a></header><div id="cookie-notice">Cookies!</div><main>
<article class="post has-sidebar"><header><h1>Head &amp; all</h1></header><p>One<b>two</b>
   three<br>four</p><div class="share">share me</div><ul><li>a<li>b</ul><blockquote>Q<p>R</blockquote>
<form>f<input name=x></form><!-- hidden --><section class="comments"><p>nice</p></section></article>
<article class="comment"><p>a long long long long long comment of a reader</p></article>
<aside>side</aside></main><footer>foot</footer></body></html>"""


def texts(page):
    return [t for t, _ in html_template.read_page(page)]


def test_article_of_a_page():
    assert texts(PAGE) == ["Head & all", "Onetwo three four", "a", "b", "Q", "R"]


def test_odd_pages():
    assert texts(None) == texts("") == texts("<script>x") == []
    assert texts("plain &eacute; &#8212; &lt;b&gt;") == ["plain é — <b>"]
    assert texts("<p>a<p>b <i>c</p></i></div>d<") == ["a", "b c", "d"]
    assert texts("<article><p>cut in a tag <a href=\"x") == ["cut in a tag"]
    assert texts("<table><tr><td>1<td>2<tr><td>3</table>") == ["1", "2", "3"]
    assert len(texts("<div>" * 3000 + "deep")) == 1


def test_names_of_wrappers_and_headings():
    story = "<article><h1>Title</h1><p>Story.</p></article>"
    want = ["Title", "Story."]
    for around in ('div id="content-sidebar-wrap"', 'div class="layout has-sidebar"', 'div class="sidebar"', "form", 'section role="search"'):
        tag = around.split()[0]
        assert texts(f"<body><div>Brand bar</div><{around}>{story}</{tag}></body>") == want, around
        assert texts(f"<body><{around}><main>{story[9:-10]}</main></{tag}></body>") == want, around
        assert texts(f"<body><{around}>{story[9:-10]}</{tag}></body>") == want, around
    inside = [
        '<h2 id="related-work">A</h2>', '<section id="search-engines"><h2>A</h2></section>', '<div class="article-header"><h1>A</h1></div>',
        '<p id="notice">A</p>', '<div class="header"><h1>A</h1></div>', '<h2 class="banner">A</h2>',
    ]
    for part in inside:
        assert texts(f"<article>{part}<p>Story.</p></article>") == ["A", "Story."], part
    assert texts('<form action="/"><a href="/">Home</a><div><h2>A</h2><p>A long story.</p></div></form><p>x</p>') == ["Home", "A", "A long story.", "x"]
    assert texts("<main><header><h1>Title</h1></header><p>x</p><article><p>Story.</p></article></main>") == want
    assert texts("<h1>Site</h1><main><h1>Other</h1><article><h1>Title</h1><p>Story.</p></article></main>") == want


def test_parts_of_the_site_still_go():
    story = "<article><h1>Title</h1><p>Story.%s</p>%s</article>"
    want = ["Title", "Story."]
    links = '<div class="related-posts"><a href="/1">One more story</a> <a href="/2">Another one</a></div>'
    more = "<p>longer longer longer longer longer</p>"
    for inner, after in (
        ("<span class=share>share</span>", ""), ("", links), ("", '<div id="cookie-notice">Cookies!</div>'), ("", "<form>Sign up</form>"),
        ("", f"<nav>{more}</nav>"), ("", f'<section class="comments">{more}</section>'), ("", '<p class="ad">Buy</p>'),
    ):
        assert texts(story % (inner, after)) == want, after
    for outside in (f'<div class="comments"><article>{more}</article></div>', f"<aside><article>{more}</article></aside>", f'<article id="comment-7">{more}</article>'):
        assert texts(f"<main>{story % ('', '')}</main>{outside}") == want, outside
    assert texts(f"<nav>{more}</nav><div class=ad>Buy</div><article></article>") == []


def test_repeated_subtrees_go_and_shared_passages_stay(spark):
    def page(i, extra=""):
        return f"<body><div>Brand bar</div><article><p>Text {i} here</p><p>Shared passage</p>{extra}<div>Read on</div></article></body>"

    rows = [(i, f"http://h.org/{i}", page(i)) for i in range(6)]
    rows += [(20 + i, f"http://few.org/{i}", page(i)) for i in range(3)]
    rows += [(30 + i, "http://copies.org/", page(1)) for i in range(9)]
    rows += [(40 + i, f"https://bare.org/{i}", f"<div>Brand bar</div><div><p>Own {i}</p></div>") for i in range(6)]
    found = html_template.main_text(spark.createDataFrame([(*r, 1) for r in rows], PAGES + ", host int").repartition(4))
    got = {r["page_id"]: r["text"] for r in found.collect()}
    assert got[0] == "Text 0 here\n\nShared passage"
    assert got[20] == "Text 0 here\n\nShared passage\n\nRead on"
    assert got[30] == "Text 1 here\n\nShared passage\n\nRead on"  # one article, however often it is there
    assert got[43] == "Own 3" and len(got) == len(rows)


def test_settled_pages_never_change():
    """Whatever subtrees are template, a page called settled keeps its article."""
    inside = ["<p>One story.</p>", "<div><p>In a box</p></div>", "<ul><li>x</ul>", "<h1>Title</h1>"]
    outside = ["<nav><a href=/>Home</a></nav>", "<div>Brand</div>", "<div class=ad>Buy</div>", "<form><p>Sign</p></form>", "<p>loose</p>"]
    rng, seen = random.Random(3), [0, 0]
    for _ in range(4000):
        parts = rng.choices(outside, k=rng.randint(0, 3))
        for tag in rng.choices(("article", "main", "div class=sidebar", "section"), k=rng.randint(0, 2)):
            parts.append(f"<{tag}>{''.join(rng.choices(inside + outside, k=rng.randint(0, 3)))}</{tag.split()[0]}>")
        rng.shuffle(parts)
        page = html_template.opened("".join(parts))
        names = sorted({h for hs in page.around for h in hs})
        seen[page.settled()] += 1
        if page.settled():
            for k in range(6):
                template = frozenset(rng.sample(names, rng.randint(0, len(names)))) if k else frozenset(names)
                assert page.article(template) == page.article(), parts
    assert min(seen) > 20


def test_articles_side_by_side():
    two = "<article><h1>First</h1><p>A long first story.</p></article><article><h2>Second</h2><p>Short.</p></article>"
    want = ["First", "A long first story.", "Second", "Short."]
    assert texts(f"<main>{two}</main>") == texts(f"<body><nav>x</nav>{two}</body>") == want
    assert texts(f"<main>{two}<article class=comment><p>Nice</p></article></main>") == want
    teaser = "<section><article><p>Read this as well</p></article></section>"
    assert texts(f"<main>{two}{teaser}</main>") == want


def test_menus_that_differ_in_wording(spark):
    """Neither named nor of the same words: lists of links above the text recur in their make."""

    def page(i, lists=True):
        links = "".join(f'<li><a href="/{i}{k}">Link {i * k}</a>' for k in range(2 + i % 3))
        top = f'<div class="row"><ul>{links}</ul></div>' if lists else ""
        sources = f'<ul><li><a href="/s{i}">Source {i}</a></ul>'
        return f"<body>{top}<div>Same words</div><div><h1>Title {i}</h1><p>Own {i}</p>{sources}</div></body>"

    rows = [(i, f"http://h.org/{i}", page(i)) for i in range(6)] + [(10 + i, f"http://few.org/{i}", page(i)) for i in range(4)]
    frame = spark.createDataFrame(rows, PAGES).repartition(3)
    for names in (True, False):
        got = {r["page_id"]: r["text"] for r in html_template.main_text(frame, names=names).collect()}
        assert [got[i] for i in range(6)] == [f"Title {i}\n\nOwn {i}\n\nSource {i}" for i in range(6)]
        assert got[11] == "Link 0\n\nLink 1\n\nLink 2\n\nSame words\n\nTitle 1\n\nOwn 1\n\nSource 1"


def test_wrappers_of_named_parts_are_no_template(spark):
    """What is left out by name is not in the name of the subtree around it."""
    rows = [(i, f"http://h.org/{i}", f'<div><form><div><p>Story {i}</p></div></form></div>') for i in range(8)]
    found = html_template.main_text(spark.createDataFrame(rows, PAGES))
    assert {r["page_id"]: r["text"] for r in found.collect()} == {i: f"Story {i}" for i in range(8)}


def test_counts_alone_on_the_given_pages(spark):
    """Without names the given pages come out the same: menus go by their make, the rest is outside the article."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    named, counted = (
        {r["page_id"]: r["text"] for r in html_template.main_text(pages, names=names).collect()} for names in (True, False)
    )
    assert counted == named


def test_odd_rows(spark):
    rows = [(1, None, None), (None, "http://a.b/", "<p>x"), (2, "", ""), (3, "no url", PAGE), (3, "no url", PAGE)]
    found = html_template.main_text(spark.createDataFrame(rows, PAGES)).collect()
    assert len(found) == 5 and sorted(r["n_chars"] for r in found) == sorted([0, 1, 0, *[len("\n\n".join(texts(PAGE)))] * 2])
    assert html_template.main_text(spark.createDataFrame([], PAGES)).count() == 0


def test_given_pages_against_plain_patterns(spark):
    """The given pages have one article element of headings and paragraphs."""

    def plain(page):
        body = re.sub(r"<[^<>]*\Z", "", re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)[1])
        parts = re.split(r"</?(?:p|h1)>", body)
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", p.replace("<br>", " "))).split()) for p in parts]
        return "\n\n".join(p for p in parts if p)

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    found = {r["page_id"]: r["text"] for r in html_template.main_text(pages).collect()}
    for r in pages.collect():
        assert found[r["page_id"]] == plain(r["html"])
