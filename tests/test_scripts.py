"""Script objects by path against the tree's reading of them, and each edge case."""

import html
import json
import random

import pytest
from pyspark.sql import functions as F

from pressmill.functions import scripts
from pressmill.html import dom, sections


def values(spark, pages, path):
    table = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    return [r[0] for r in table.orderBy("i").select(scripts.script_text(F.col("html"), path)).collect()]


def page(*bodies):
    return "<html>" + "".join(f"<script>{b}</script><p>x</p>" for b in bodies) + "</html>"


def test_like_the_tree(spark):
    draw = random.Random(3)
    text = lambda: draw.choice(["plain", "", "a &amp; b", "<b>bold</b> and&nbsp;<i>more</i>", "&lt;p&gt;in&lt;/p&gt;", "&#233;&#x1F642;&bogus; &", 'say "x"', "é\n two ", "<!-- c -->y<style>no</style>z"])

    def value(depth=0):
        kind = draw.randint(0, 5)
        return text() if kind < 2 or depth > 2 else draw.choice([5, None, True, 1.5]) if kind == 2 else {k: value(depth + 1) for k in draw.sample(["a", "b", "x y", "c-d"], 2)}

    def body():
        obj = json.dumps({"a": value(), "b": {"a": text(), "c-d": value(1)}})
        return draw.choice(["var v = {};", "window.v = {};", "v={};", "var w = {};", "let v = {}", "var v = {}};", "vv = {};"]).replace("{}", obj, 1).replace("</", "<\\/")

    pages = [page(*(body() for _ in range(draw.randint(0, 3)))) for _ in range(150)]
    for path in ("v.a", "v.b.a", "v.b.c-d", "v.a.b"):
        want = [sections.from_script(dom.parse(p), path) for p in pages]
        assert values(spark, pages, path) == want
    assert sum(map(bool, values(spark, pages, "v.b.a"))) > 20


def test_lists_and_missing_steps(spark):
    pages = [page('var v = {"l": [{"t": "one"}, {"t": ["two", "three"]}], "n": 7, "o": {}};'), None, "", page("var v = [1];", 'v = {"n": "second"};')]
    assert values(spark, pages, "v.l[0].t") == ["one", "", "", ""]
    assert values(spark, pages, "v.l[1].t[1]") == ["three", "", "", ""]
    assert values(spark, pages, "v.l[9].t") == values(spark, pages, "v.o.x.y") == ["", "", "", ""]
    assert values(spark, pages, "v.n") == ["", "", "", "second"]
    for bad in ("v", "v.", "v.a[x]", "v.a['b']"):
        with pytest.raises(ValueError):
            scripts.script_text(F.lit(""), bad)


def test_unescaped(spark):
    texts = ["no reference", "&lt;&amp;&eacute;&#8364;&#x20ac;&#X41;", "&amp;amp;", "&unknown; &; & &&amp", "&#0;&#55296;&#9999999;"]
    got = [r[0] for r in spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i").select(scripts.unescaped(F.col("t"))).collect()]
    assert got[:3] == [html.unescape(t) for t in texts[:3]] and got[3:] == ["&unknown; &; & &&amp", "&#0;&#55296;&#9999999;"]


def test_a_page_is_searched_once_for_a_path(spark):
    from pyspark.sql import functions as F

    from pressmill.functions import scripts

    plan = spark.range(1).select(F.col("id").cast("string").alias("html")).select(scripts.script_text(F.col("html"), "state.a.b"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_extract_all(html#") == 1
