"""A heading cut within a reference counts as HTML reads it: `&amp</h1>` is one character, as in html.unescape, which the SQL of the score queries leaves as four."""

from pressmill.operators import elements, pages


def test_threshold_counts_cut_references_once(spark):
    head = "A heading that is cut &amp"
    html = lambda chars: f"<html><body><article><h1>{head}</h1><p>{'x' * (chars - len(head) + 3)}</p></article></body></html>"
    rows = spark.createDataFrame([(n, "a", html(n)) for n in (200, 201)], "page_id bigint, site string, html string")
    trees = elements.parsed(rows).cache()
    ranked = elements.ranked_candidates(elements.element_rows(trees), elements.string_rows(trees))
    assert [r.page_id for r in ranked.where("kind = 'contents'").collect()] == [201]
    scores, totals = pages.selector_scores(pages.analysed(rows), "site"), elements.totals(ranked, rows)
    for found in (scores, totals):
        assert [(r.selector, r.score) for r in found.where("kind = 'contents'").collect()] == [("article", 1.506)]
