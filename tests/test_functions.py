"""Column functions on literal rows, and the quirks that are kept on purpose."""

import pytest
from pyspark.sql import functions as F

from pressmill.functions import text, urls


def one(spark, column, **values):
    frame = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return frame.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "url, reason, article_id",
    [
        ("https://www.lemonde.fr/idees/article/2025/08/21/title_6632905_3232.html", "passed all filters", "6632905"),
        ("https://www.lemonde.fr/guides-d-achat/article/2025/05/28/best-chargers.html", "matches skip pattern: /guide", "2025"),
        ("https://www.lemonde.fr/economie.html", "appears to be category page", None),
        ("https://www.bzi.ro/stire-important-news-123456", "passed all filters", "123456"),
        ("https://www.bzi.ro/contact", "matches skip pattern: /contact", None),
        ("https://www.digi24.ro/stiri/actualitate/politics/article-567890.html", "passed all filters", "567890"),
        ("https://a.com/x/y%23z", "matches skip pattern: #", None),
        ("https://a.com/x/y#part", "passed all filters", None),
        ("https://a.com/x/a b+c?UTM_=1", "matches skip pattern: ?utm_", None), ("https://a.com/x/a b+c?u=1", "passed all filters", None),
        ("https://a.com/x/y?utm_source=1", "matches skip pattern: ?utm_", None),
        ("https://a.com/x/y.json", "file extension .json", None),
        ("https://a.fr/x/boutique/1", "matches skip pattern: /boutique/", None),
        ("https://a.de/x/boutique/1", "passed all filters", None),
        (None, "error parsing URL", None),
    ],
)
def test_urls(spark, url, reason, article_id):
    assert urls.with_skip_reason(spark.createDataFrame([(url,)], "url string")).first().reason == reason
    assert one(spark, urls.article_id(F.col("u")), u=url) == article_id


def test_domain_rules(spark):
    rules = spark.createDataFrame([("a.com", ["/own"], True, False), ("b.com", [], True, True), ("c.com", [], False, False)], "domain string, additional_skip_patterns array<string>, require_article_id boolean, allow_no_id_pages boolean")
    links = spark.createDataFrame([(d, f"https://{d}{p}") for d in ("a.com", "b.com", "c.com", "d.com") for p in ("/x/own", "/x/y", "/x/y-1234567")], "domain string, url string")
    got = {r.url: r.reason for r in urls.with_skip_reason(urls.with_rules(links, rules), rules="rules").collect()}
    assert got["https://a.com/x/own"] == "matches domain-specific pattern: /own" and got["https://a.com/x/y"] == "no article ID found"
    assert {v for k, v in got.items() if "a.com" not in k or "123" in k} == {"passed all filters"}


@pytest.mark.parametrize(
    "link, want",
    [("/p?q#f", "https://h.com/p?q#f"), ("//o.com/x", "https://o.com/x"), ("https://x.y/z", "https://x.y/z"), ("n.html", "https://h.com/a/n.html"), ("?q", "https://h.com/a/b?q"), ("#f", "https://h.com/a/b?k=1#f"), ("", "https://h.com/a/b?k=1")],
)
def test_resolved(spark, link, want):
    from urllib.parse import urljoin

    assert one(spark, urls.resolved(F.col("l"), F.lit("https://h.com/a/b?k=1")), l=link) == want == urljoin("https://h.com/a/b?k=1", link)


def test_page_links(spark):
    html = """<a href="/b">x</a><A class='k' HREF='/a?q=1#f'>y</A><a href="https://o.com/z">z</a><a href="/b">x</a><a>none</a><a href="https://h.com/c">c</a>"""
    assert one(spark, urls.page_links(F.col("h"), F.lit("https://h.com/")), h=html) == ["/a?q=1#f", "/b", "/c"]


@pytest.mark.parametrize(
    "path, want",
    [("/", None), ("--><!--x", None), ("/x/story-12", "story-12.html"), ("/x/a?b&c", "a_b_c.html"), ("/news/77", "article_77.html"), ("/x/77", "e0a1bb1ab7.html"), ("/x/y.html", "y.html")],
)
def test_storage_name(spark, path, want):
    import hashlib

    if path == "/x/77":
        want = hashlib.md5(path.encode()).hexdigest()[:10] + ".html"
    assert one(spark, urls.storage_name(F.col("p"), F.concat(F.lit("https://h.com"), F.col("p"))), p=path) == want


def test_slugs(spark):
    assert one(spark, urls.slug_title(F.col("s"), "fr"), s="le-chat-de-la-voisine-et-moi") == "Le Chat de la Voisine et moi"
    assert one(spark, urls.slug_title(F.col("s"), "en"), s="the-cat-of-a-friend") == "The Cat of a Friend"
    assert one(spark, urls.url_title(F.col("u"), F.lit("www.bzi.ro")), u="https://www.bzi.ro/x/un-titlu-lung-12345") == "Un Titlu Lung"
    assert one(spark, urls.url_title(F.col("u"), F.lit("other.com")), u="https://other.com/a-1") == ""


FRENCH = "\n    Nous écrivons pour exprimer notre inquiétude.\n    \n    Lire aussi la tribune | Article réservé à nos abonnés\n    \n    La suite du texte.\n"
ROMANIAN = "\n    Acesta este un articol.\n    \n    Citește și: Alt articol\n    \n    Conținutul continuă aici.\n    \n    Restul articolului este rezervat abonaților.\n"


def test_clean(spark):
    # a teaser that names the paywall cuts the text, and a notice spelled otherwise does not
    assert one(spark, text.cleaned(F.col("t"), F.lit("french")), t=FRENCH) == "Nous écrivons pour exprimer notre inquiétude."
    assert len([x for x in one(spark, text.cleaned(F.col("t"), F.lit("romanian")), t=ROMANIAN).split("\n") if x]) == 3
    assert one(spark, text.cleaned(F.col("t"), F.lit("english")), t="Keep this \n#tag alone\nabc\n1.5% of it\nSee www.x.com\n\n\n\n\nEnd line") == "Keep this\n\nEnd line"
    assert one(spark, text.cleaned_by_rules(F.col("t"), F.lit("x.ro"), {"x.ro": ["^drop.*$", "Subscribe.*"]}), t="drop me\nkeep this line") == "keep this line"


def test_repair_and_paragraphs(spark):
    assert one(spark, text.markdown_repaired(F.col("t")), t="a**\nb ** ** c*** d``e  f\n\n\n\ng") == "a **b c** de f\n\ng"
    assert one(spark, text.paragraphs(F.col("t")), t="One.\nTwo\nthree.\nFour!\n- item.\n# head") == "One.\n\nTwo\nthree.\n\nFour!\n- item.\n# head"


def test_enrichment(spark):
    t = "Jean Dupont a visité Le Havre et les états-unis avec M. Martin de Renault SA. L'ONU et l'Élysée."
    assert one(spark, text.persons(F.col("t")), t=t) == ["Jean Dupont", "Le Havre", "M. Martin", "Renault SA"][:2] + ["M. Martin"]
    assert one(spark, text.locations(F.col("t")), t=t) == ["Le havre", "États-unis"]
    assert one(spark, text.organizations(F.col("t")), t=t) == ["ONU", "Renault SA", "Élysée"]
    assert one(spark, text.sentiment(F.col("t")), t="crise et guerre, progrès") == "negative"
    assert one(spark, F.round(text.importance(F.col("t"), F.lit("URGENT: x")), 2), t="gouvernement " * 120 + "test") == 0.55
    assert one(spark, text.geographic_scope(F.col("t"), F.lit(0)), t="La France international") == "international"
    assert one(spark, text.geographic_scope(F.col("t"), F.lit(3)), t="x") == "international"
    assert one(spark, text.summary(F.col("t")), t="a. b. c. d") == "a.  b.  c."
    assert one(spark, text.topic_label(text.topic(F.col("t"))), t="/cati-bani-a-dat-romania-5334542") == "Domeniu: economic (scor: 0.75)"
    assert one(spark, text.category(F.col("t")), t="Domeniu: sanatate (scor: 0.75)") == "health"
    assert one(spark, text.complexity(F.col("t")), t="One two. Three four five.") == pytest.approx((5 / 3 / 20 + 1) / 2)
    assert one(spark, text.readable_bytes(F.lit(1536)), t="") == "1.5 KB"
    assert one(spark, text.overlap(F.col("t"), F.lit("a b c d e")), t="A B x C") == 0.75


def test_empty_text_columns(spark):
    for make in (text.sentiment, text.complexity, text.summary, text.content_type, text.persons, text.markdown_repaired, text.paragraphs):
        one(spark, make(F.col("t")), t="")
        assert one(spark, make(F.col("t")), t=None) in (None, [], "neutral", "news_article", 0.0, 1.0)
