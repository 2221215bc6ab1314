"""HTML code on literal pages: cleaning, emphasis, selectors, sections, candidates, main text and headers."""

import pytest

from pressmill.operators import pages
from pressmill.html import article, candidates, clean, dom, sections

PAGE = """<!DOCTYPE html><html lang="fr"><head><title>A title of the page</title><meta name="description" content="What the page is about, in short">
<script>var ctx = {"article": {"title": "From &lt;b&gt;script&lt;/b&gt;", "n": 3}}; var x="</p>";</script><style>p{}</style></head>
<body class="home 12"><nav id="menu"><a href="/a">A</a></nav><!-- note --><header><p>short</p></header>
<article class="article-content"><header><h1 class="title">The headline of it</h1></header><p>First <b>bold text</b> here.<br>Second line</p><p>Third <i>para</i>graph with <a href="/x">link</a></p>
<blockquote>Said so
twice</blockquote><div class="sidebar">no</div></article><p class="author">Ann Author</p><footer>end</footer></body></html>"""


def test_strip_irrelevant():
    out = clean.strip_irrelevant("<html><head><script>x()</script><style>s</style></head><body><noscript>n</noscript><iframe></iframe>Hello World!</body></html>")
    assert not any(t in out for t in ("<script", "<style", "<noscript", "<iframe")) and "Hello World!" in out
    out = clean.strip_irrelevant('<div></div><span id="x"></span><p>Text</p>')
    assert "<div>" not in out and '<span id="x"></span>' in out
    out = clean.strip_irrelevant('<p id="a" class="b" style="c" data-x="d">T</p>')
    assert out == '<p id="a" class="b">T</p>'
    assert "Text" in clean.strip_irrelevant("<html><body><p>Text</p></body></html>")


def test_tree():
    root = dom.parse("<p><b>a<br>b<p>c</p></x>d &amp; e")
    assert str(root) == "<p><b>a<br/>b<p>c</p>d &amp; e</b></p>"
    assert root.text() == "abcd & e" and root.text(strip=True, between="|") == "a|b|c|d & e"
    assert str(dom.parse("<img src='a'/><i/>x")) == '<img src="a"/><i></i>x'
    assert dom.parse("<script>if (a<b) {}</script>t").text() == "t"


@pytest.mark.parametrize(
    "selector, n",
    [("p", 4), (".title", 1), ("#menu a", 1), ("article h1", 1), ('h1[class*="it"]', 1), ('meta[name="description"]', 1), ("h1, .author", 2), ("[href]", 2), (".home.12", 1), ("nav p", 0)],
)
def test_selectors(selector, n):
    assert len(dom.select(dom.parse(PAGE), selector)) == n


def test_clean():
    out = clean.clean(PAGE)
    assert all(t not in out for t in ("<script", "<nav", "note", "short", "sidebar", "end", "class=")) and 'href="/x"' in out and "The headline of it" in out
    light = clean.clean_lightly(PAGE.replace("<article", '<article style="x"'))
    assert 'class="sidebar"' in light and "style=" not in light and "<nav" not in light and "note" not in light


def test_marked():
    assert clean.marked("<p>a <b> x <i>y</i></b> c</p>") == "<p>a**x y**c</p>"
    assert clean.marked("<p>a<code>z</code></p>") == "<p>a`z`</p>"
    assert "&gt; Said so\n&gt; twice\n" in clean.marked(PAGE)
    assert clean.marked("<b></b><p>t</p>") == "<b></b><p>t</p>"


def test_sections():
    root = dom.parse(PAGE)
    assert sections.from_script(root, "ctx.article.title") == "From script" and sections.from_script(root, "ctx.article.n") == ""
    assert sections.first_text(root, ["nav b", "js:ctx.none", 'meta[name="description"]']) == "What the page is about, in short"
    rules = {
        "custom_content_sections": {
            "enabled": True,
            "sections": [
                {"name": "b", "selectors": [".author"], "format": "*{content}*", "order": 2, "processing": {"clean_patterns": ["^Ann "]}},
                {"name": "title", "selectors": [".none"], "order": 1, "format": "# {content}"},
                {"name": "c", "selectors": [".title"]},
            ],
            "processing_options": {"max_section_length": 8},
        }
    }
    assert sections.sections(root, rules, "Of its slug") == "# Of its...\n\n*Author*\n\nThe..."
    assert sections.sections(root, {}) == ""


def test_candidates(spark):
    rows = [(1, PAGE), (2, "<p>și acum</p>"), (3, "<p>xyz</p><p>xyz</p>"), (4, "<p>again</p><i>once only</i><p>again</p><b>other</b><!--other-->"), (5, None), (6, "<h1 class='Title x'>A heading of some length</h1>" * 7)]
    found = {r.i: r for r in pages.analysed(spark.createDataFrame(rows, "i int, html string")).collect()}
    page = found[1]
    assert page.titles[0][:2] == (".title", 3.8) and page.authors[0][0] == ".author" and page.language == "fr"
    assert tuple(page.subtitles[0]) == ('meta[name="description"]', 1.0, "What the page is about, in short")
    assert "#menu" in page.removable and ".sidebar" in page.removable and "home" in page.classes
    assert found[2].language == "ro" and found[3].language == found[5].language == "en"
    assert found[4].repeated == ["other", "again"] and found[3].repeated == found[5].repeated == []
    assert len(found[6].titles) == 5 and {t.selector for t in found[6].titles} == {".Title.x"} and found[6].titles[0].score == 2.8
    assert found[5].titles == [] and found[5].text_chars == 0
    assert candidates.selector_of(dom.parse('<i class="1 2">').children[0]) == "i"


def test_main_text_and_headers():
    assert article.main_text(clean.clean("<p>no</p><article><h1>Head</h1><p>" + "long text " * 20 + "</p></article>")).startswith("Head\n\nlong text")
    dense = "<div><a href='x'>link link</a></div><div><p>" + "words here " * 30 + "</p><p>more</p></div>"
    assert article.main_text(dense).endswith("more")
    known = article.headers_of("<h1>Main head</h1><h3>Third one</h3><h2>no</h2>")
    assert known == {"Main head": 1, "Third one": 3}
    text = article.with_headers("Main head\nThis line is content and ends here.\nThird one\nEnds.\nLooks like one\nAnd content follows here.", known)
    assert text == "# Main head\n===========\nThis line is content and ends here.\n\n### Third one\nEnds.\n\n## Looks like one\n-----------------\nAnd content follows here."
    assert article.paragraph_spaced("\n a \nb\n\nc") == "a\n\nb\n\n\nc"


def test_selectors_by_an_index_of_the_page():
    from pressmill.html import candidates

    page = dom.parse('<div class="title lead"><h1 class="big-title">a</h1></div><article class="content Content"><h1 rel="author">b</h1><p class="author by-author">c</p></article><meta name="description" content="d"><main><h2 class="x">e</h2></main>')
    found = dom.index(list(page.elements()))
    for selector in [s for kind in candidates.KINDS.values() for s, _ in kind] + ["#none", "[rel]", ".content.Content", "div > h1".replace(" >", "")]:
        assert dom.select_indexed(found, selector) == dom.select(page, selector)
