"""Main text: pages built around known articles, the tables' pages against a plain reading, and damaged pages."""

import html
import random
import re

import pytest

from pressmill.llm import main_text
from pressmill.llm.page_tree import parse

WORDS = "the river rose over its banks after rain and people of small towns near it left their homes while boats came".split()


def sentence(draw, least=6, most=18):
    words = [draw.choice(WORDS) for _ in range(draw.randint(least, most))]
    for i in range(3, len(words) - 1, 5):
        words[i] += ","
    return " ".join(words).capitalize() + "."


def paragraph(draw):
    return " ".join(sentence(draw) for _ in range(draw.randint(2, 6)))


BEFORE = [
    '<nav><ul><li><a href="/a">Home</a><li><a href="/b">World</a></ul></nav>', '<header><h2>The Daily Paper</h2><p>All the news, always, everywhere, for everyone who reads.</p></header>',
    '<div id="cookie-banner"><p>We use cookies, partners, and more cookies, to make this page better for you, always.</p></div>',
    '<div class="top-ad">Buy now, pay later, and be happy with the thing that you have bought here.</div>', '<div role="alert">Our office is closed today, tomorrow, and the day after, as we are sorry to say.</div>',
    '<form><label>Search our pages, all of them, and find what you are looking for</label><input><button>Go</button></form>', "<script>var x = '<p>no, not this, never</p>';</script><style>p { color: red }</style>",
    '<div class="siteHeader"><a href="/">Start</a> <a href="/x">Sport</a> <a href="/y">Culture</a></div>', '<ul class="breadcrumbs"><li><a href="/">Home</a><li><a href="/n">News</a></ul>',
]
AFTER = [
    '<section id="comments"><article class="comment"><p>I think, and I say so, that this is wrong, all of it, from the start to the very end, really.</p><p>Me too, my friend, me too, and more than once, I must say.</p></article></section>',
    '<div class="related-posts"><h3>Related</h3><ul><li><a href="/1">Another story</a><li><a href="/2">Yet another story</a></ul></div>',
    '<aside><h3>Most read</h3><p>Something else, that many have read, and liked, and shared with others today.</p></aside>', '<footer><p>&copy; 2024, all rights reserved, by the paper, its owners, and nobody else.</p></footer>',
    '<div class="newsletterSignup"><p>Subscribe to our letters, which are free, weekly, and quite good, as they say.</p></div>', '<div class="share-buttons"><a href="#">Tell a friend</a><a href="#">Post</a><a href="#">Mail</a></div>',
    '<div style="display: none"><p>Hidden words, that nobody sees, or should see, in any case, at all.</p></div>', '<div class="sidebar"><div class="widget"><p>Weather, traffic, markets, all of it, in one place for you.</p></div></div>',
]
WRAPS = [
    ("<article>", "</article>"), ('<main><article class="post">', "</article></main>"), ('<div class="page"><div class="article-body">', "</div></div>"), ('<div id="wrap"><div id="content">', "</div></div>"),
    ('<main><div class="story">', "</div></main>"), ("<table><tr><td>", "</td></tr></table>"), ('<div class="layout with-sidebar"><section><div>', "</div></section></div>"),
]


def built(seed):
    """A page and its text."""
    draw = random.Random(seed)
    blocks, markup = [], []
    for _ in range(draw.randint(3, 9)):
        kind = draw.choice(["p", "p", "p", "open p", "h2", "list", "quote"])
        text = paragraph(draw)
        if kind in ("p", "open p"):
            words = text.split()
            words[1] = f"<b>{words[1]}</b>"
            words[3] = f'<a href="/l?a=1&amp;b=2">{words[3]}</a>'
            text += " café & more"
            inner = draw.choice([" ", "\n  ", "<br>", "&nbsp;"]).join([" ".join(words), draw.choice(["caf&eacute;", "caf&#233;", "café"]) + " &amp; more"])
            markup.append(f"<p>{inner}" + ("</p>" if kind == "p" else ""))
            blocks.append(text)
        elif kind == "h2":
            markup.append(f"<h2>{words_of(text, 4)}</h2>")
            blocks.append(words_of(text, 4))
        elif kind == "list":
            items = [sentence(draw) for _ in range(3)]
            markup.append("<ul>" + "".join(f"<li>{x}" for x in items) + "</ul>")
            blocks += items
        else:
            markup.append(f"<blockquote><p>{text}</p></blockquote>")
            blocks.append(text)
    last = paragraph(draw)
    opening, closing = draw.choice(WRAPS)
    before, after = (draw.sample(x, draw.randint(1, 4)) for x in (BEFORE, AFTER))
    page = f'<!DOCTYPE html><html lang="en"><head><title>A page, with a title</title></head><body class="has-sidebar">{"".join(before)}{opening}{"".join(markup)}<p>{last}</p>{closing}{"".join(after)}</body></html>'
    return page, "\n".join([*blocks, last])


def words_of(text, n):
    return " ".join(text.split()[:n])


@pytest.mark.parametrize("seed", range(150))
def test_built_pages(seed):
    page, want = built(seed)
    assert main_text.main_text(page) == want


def plain(page):
    """The article element's blocks, for the pages of the tables."""
    body = re.sub(r"<[^>]*\Z", "", page[page.index("<article>") + 9 :].split("</article>")[0])
    parts = re.split(r"</?(?:p|h1|footer|body|html)\b[^>]*>", body.replace("<br>", " "))
    return "\n".join(x for x in (" ".join(html.unescape(re.sub("<[^>]*>", "", p)).split()) for p in parts) if x)


def test_query(spark, medium):
    pages = {r[0]: (r[1], r[2]) for r in spark.read.parquet(f"{medium}/pages.parquet").select("page_id", "url", "html").collect()}
    got = main_text.op13_main_text(spark, medium).collect()
    assert len(got) == len(pages)
    for row in got:
        assert (row["url"], row["text"]) == (pages[row["page_id"]][0], plain(pages[row["page_id"]][1]))
        assert row["n_chars"] == len(row["text"])


def test_edges(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "just words, and more of them, without any markup at all", "a"), (4, "<nav><a href=x>Menu</a></nav>", "a"), (4, "<nav><a href=x>Menu</a></nav>", "a"), (5, "<", "b"), (6, "<p>Short</p>", None)]
    table = spark.createDataFrame(rows, "page_id long, html string, _html string")
    out = main_text.extracted(table)
    assert out.columns == ["page_id", "_html", "text", "n_chars"]
    assert sorted((r[0], r[2], r[3]) for r in out.collect()) == [(1, "", 0), (2, "", 0), (3, rows[2][1], 55), (4, "", 0), (4, "", 0), (5, "<", 1), (6, "Short", 5)]
    assert main_text.extracted(table.limit(0)).collect() == []


def test_damaged_pages():
    page, _ = built(3)
    for end in range(0, len(page), 7):
        main_text.main_text(page[:end])
        main_text.main_text(page[end:])
    assert main_text.main_text("<article><p>Whole words, quite a few of them, in one place.</p><p>cut <a href='x") == "Whole words, quite a few of them, in one place.\ncut"
    assert main_text.main_text('<p title="a > b">Some text, long enough to count here, surely.</p>') == "Some text, long enough to count here, surely."
    assert main_text.main_text("<p>It's a 'quoted' word, isn't it, or is it not, a < b.<p>Don't stop here, it is not over yet.") == "It's a 'quoted' word, isn't it, or is it not, a < b.\nDon't stop here, it is not over yet."


def test_deep_and_long_pages():
    deep = "<div>" * 50_000 + "<p>At the bottom, far below, there is a text, at last.</p>" + "</div>" * 50_000
    assert main_text.main_text(deep) == "At the bottom, far below, there is a text, at last."
    text = "Words, and more words, and yet more of them. " * 40
    many = "<article>" + f"<p>{text}</p>" * 2000 + "</article>"
    assert main_text.main_text(many) == "\n".join([text.strip()] * 2000)
    assert main_text.main_text("</b>" * 100_000 + "<li>" * 100_000 + "one item that is long enough") == "one item that is long enough"


def test_tree():
    tree = parse("<p>a<p>b<ul><li>c<li>d</ul><table><tr><td>e<td>f</table></p>g<b>h<i>i</b>j</i>")
    shown = [(tree.tags[i] or tree.texts[i], tree.tags[tree.parents[i]]) for i in range(1, len(tree.tags))]
    assert shown == [("p", ""), ("a", "p"), ("p", ""), ("b", "p"), ("ul", ""), ("li", "ul"), ("c", "li"), ("li", "ul"), ("d", "li"), ("table", ""), ("tr", "table"), ("td", "tr"), ("e", "td"), ("td", "tr"), ("f", "td"), ("g", ""), ("b", ""), ("h", "b"), ("i", "b"), ("i", "i"), ("j", "")]
    for i in range(1, len(tree.tags)):
        assert tree.parents[i] < i < tree.ends[i] <= tree.ends[tree.parents[i]]


def test_links_and_menus():
    lines = "<p>First part, of the article, which is long, and has commas.</p><p>Second part, of the article, which is long, too.</p>"
    menu = "<ul><li><a href=1>One</a></li><li><a href=2>Two</a></li><li><a href=3>Three</a></li></ul>"
    kept = '<p><a href="/s">Source</a></p>'
    text = main_text.main_text(f"<body><div>{lines}{menu}{kept}</div></body>")
    assert text.split("\n")[-1] == "Source" and "One" not in text
