"""Selectors as joins against the tree's own selector engine and the analysis made from it."""

import random

import pytest
from pyspark.sql import functions as F

from pressmill.html import dom
from pressmill.operators import elements, pages
from pressmill.plans.element_queries import varied_pages

SELECTORS = [
    "p", "div p", ".a", ".a .b", "#x", "div#x.a", "[rel]", '[rel="me you"]', '[class*="b"]', "[class^=a]", "[class$='c']", "[rel~=you]", "p, h1", ".a div .b", "*", "div div div", "section [rel] p, .c",
]


def invented(seed):
    draw = random.Random(seed)

    def tree(depth):
        if depth > 5 or draw.random() < 0.2:
            return draw.choice(["text", " ", "<br>", "<script>no</script>", "<!-- c -->", "<template><p>t</p></template>"])
        name = draw.choice(["div", "p", "section", "h1"])
        attrs = draw.choice(["", ' class="a"', ' class="b a"', ' class="c"', ' id="x"', ' class="b c" rel="me you"', ' rel=""', ' class="" id=""'])
        return f"<{name}{attrs}>{''.join(tree(depth + 1) for _ in range(draw.randint(0, 4)))}" + draw.choice([f"</{name}>"] * 5 + [""])

    return "".join(tree(0) for _ in range(4))


@pytest.fixture(scope="module")
def trees(spark):
    rows = [(i, invented(i)) for i in range(60)] + [(60, None), (61, ""), (62, "<p>"), (62, "<p>")]
    return rows, elements.parsed(spark.createDataFrame(rows, "page_id long, html string")).cache()


def test_matches(trees):
    rows, parsed = trees
    found = elements.matches(elements.element_rows(parsed), SELECTORS).groupBy("page_id", "nth").count().collect()
    got = {(r[0], r[1]): r[2] for r in found}
    for page_id, html in rows[:-2]:
        root = dom.parse(html or "")
        for nth, selector in enumerate(SELECTORS):
            assert got.get((page_id, nth), 0) == len(dom.select(root, selector)), (html, selector)


def test_texts(trees):
    rows, parsed = trees
    every = elements.element_rows(parsed).where("page_id < 60")
    got = {(r[0], r[1]): r[2] for r in elements.texts(every, elements.string_rows(parsed)).collect()}
    for page_id, html in rows[:60]:
        numbers = {id(e): n for e, n in numbered(dom.parse(html))}
        assert numbers
        for e, n in numbered(dom.parse(html)):
            assert got.get((page_id, n), "") == e.text(strip=True)


def numbered(root):
    out, number, stack = [], 0, [iter(root.children)]
    while stack:
        for child in stack[-1]:
            if not isinstance(child, dom.Comment):
                number += 1
            if isinstance(child, dom.Element):
                out.append((child, number))
                stack.append(iter(child.children))
                break
        else:
            stack.pop()
    return out


def test_children_only(spark):
    page = '<div class="a"><p>one</p><section><p>two</p></section></div><p>three</p>'
    rows = elements.element_rows(elements.parsed(spark.createDataFrame([(1, page)], "page_id long, html string")))
    count = lambda css: elements.matches(rows, [css]).count()
    assert [count(c) for c in ("div p", "div > p", ".a>section > p", "div > section p", "section > p", "p")] == [2, 1, 1, 1, 1, 3]
    for bad in ("", "> p", "p[", "p:first-child"):
        with pytest.raises(ValueError):
            elements.matches(rows, [bad])


def test_like_the_analysis(spark, medium):
    varied = varied_pages(spark, medium)
    trees = elements.parsed(varied).cache()
    rows, strings = elements.element_rows(trees), elements.string_rows(trees)
    analysis = pages.analysed(varied).drop("html").cache()
    each = None
    for kind in ("titles", "subtitles", "authors", "contents"):
        own = analysis.select("page_id", F.lit(kind).alias("kind"), F.posexplode(kind).alias("i", "c")).select("page_id", "kind", (F.col("i") + 1).alias("rank"), "c.selector", "c.score", "c.text")
        each = own if each is None else each.unionByName(own)
    want = sorted(map(tuple, each.collect()))
    assert len({r[2] for r in want}) > 3 and len({r[3] for r in want}) > 20
    assert sorted(map(tuple, elements.ranked_candidates(rows, strings).select("page_id", "kind", "rank", "selector", "score", "text").collect())) == want
    gone = sorted((r[0], i + 1, s) for r in analysis.select("page_id", "removable").collect() for i, s in enumerate(r[1]))
    assert sorted(map(tuple, elements.removable(rows).collect())) == gone
    totals = elements.totals(elements.ranked_candidates(rows, strings), varied)
    assert sorted(map(tuple, totals.select("site", "kind", "selector", "score", "rank").collect())) == sorted(map(tuple, pages.selector_scores(analysis, "site").select("site", "kind", "selector", "score", "rank").collect()))


def test_plan(spark, small):
    """Chains are semi joins on the page and an interval; nothing is a nested loop or a product."""
    trees = elements.parsed(varied_pages(spark, small))
    plan = elements.ranked_candidates(elements.element_rows(trees), elements.string_rows(trees))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "LeftSemi" in plan
