"""Extraction: pages of any depth, and what is carried from step to step."""

from pyspark.sql import functions as F

from pressmill.html import article, clean, dom
from pressmill.operators import pages
from pressmill.plans.html_queries import QUERIES


def test_pages_of_any_depth(spark):
    words = " ".join(f"word{i}" for i in range(60))
    page = "<html><head><title>A title here</title></head><body><article><h1>A heading of it</h1>" + f"<p><b>{words}. <br>" * 1500 + "</article></body></html>"
    root = dom.parse(page)
    assert str(dom.parse(str(root))) == str(root) and root.text().count("word59") == 1500
    assert article.main_text(clean.clean(page)).count("word7 ") == 1500
    rows = spark.createDataFrame([(1, "d", "https://d/a-b-c", page)], "i int, domain string, url string, html string")
    for method in ("dense", "light"):
        got = pages.extracted(rows, method=method, now=F.lit("2024-01-01").cast("timestamp")).first()
        assert got.title == "A title here" and got.skip_type == "repetitive_content"
    best = pages.analysed(rows).first()
    assert best.titles[0].text == "A heading of it" and best.text_chars > 1500 * len(words)


def test_first_string_tells_of_text():
    root = dom.parse("<p> <i> </i><script>x</script><!-- c --></p><div><b>\n</b>t</div>")
    assert [e.has_text() for e in root.elements()] == [bool(e.text(strip=True)) for e in root.elements()]


def test_gates_format_no_text(spark, small):
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    gates, whole = plan(QUERIES["extract_gates"](spark, small)), plan(QUERIES["extract_articles"](spark, small))
    assert gates.count("MapInArrow") == 1 and whole.count("MapInArrow") == 2
    # html enters the first step and leaves none
    assert not any("html#" in line.split("), [", 1)[-1].replace("cleaned_html#", "") for line in (gates + whole).splitlines() if "MapInArrow" in line)


def test_no_text_goes_through_the_driver(spark, small):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    try:
        out = QUERIES["extract_articles_light"](spark, small)
        assert out.count() == 50 and "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
