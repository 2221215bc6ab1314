"""Queries over rows of elements: selectors as joins, on pages whose elements vary by page. The SQL cuts pages into tags itself and derives all from these."""

from pyspark.sql import functions as F

from ..functions import urls
from ..html import candidates, nodes
from ..operators import blocks, elements, pages
from ..scratch import stored
from .tables import spread_out, table

#: What varies: an element of the tables' pages, the divisor of the page id, and what stands there for each remainder. N is the page id.
VARIED = [
    ("<article>", 4, ['<article class="article-content">', '<main><article class="post-content content 7" id="story-N">', '<div class="Article-Wrap"><article data-kind="news">', "<article>"]),
    ("<h1>", 5, ['<h1 class="entry-title">', '<div class="headline"><h1>', '<h1 class="article-headline big">', '<h1 id="top">', "<h1>"]),
    ("</h1>", 5, ["</h1>", "</h1></div>", "</h1>", "</h1>", "</h1>"]),
    ("</h1>", 3, ['</h1><h2 class="subtitle">A second line for page N of them</h2><a rel="author" class="Author link" href="/w">Writer N</a>', '</h1><h2 class="deck lead">Another line for page N here</h2><span class="byline by-author">By Writer N</span>', "</h1>"]),
    ('<meta charset="utf-8">', 2, ['<meta charset="utf-8"><meta name="description" content="What page N has to say about it">', '<meta charset="utf-8">']),
    ('<div class="ad">', 3, ['<div class="ad">', '<div class="Sidebar ad-slot 12" id="ads-N">', '<div class="promo"><div class="social share">']),
    ("<nav>", 2, ['<nav class="menu main-menu" id="Navigation">', "<nav>"]),
]


def varied_pages(spark, sf_dir):
    """page_id, site, html: the tables' pages with classes, ids and elements that differ from page to page."""
    html = F.col("html")
    for old, by, new in VARIED:
        made = F.element_at(F.array(*map(F.lit, new)), (F.pmod("page_id", F.lit(by)) + 1).cast("int"))
        html = F.replace(html, F.lit(old), F.replace(made, F.lit("N"), F.col("page_id").cast("string")))
    return table(spark, sf_dir, "pages").select("page_id", urls.bare_domain(urls.part(F.col("url"), "netloc")).alias("site"), html.alias("html"))


def _trees(spark, sf_dir):
    trees = stored(elements.parsed(spread_out(varied_pages(spark, sf_dir))))
    return elements.element_rows(trees), elements.string_rows(trees)


def element_candidates(spark, sf_dir):
    return elements.ranked_candidates(*_trees(spark, sf_dir))


def element_selector_scores(spark, sf_dir):
    """The ten best selectors of each kind of each site."""
    return elements.totals(elements.ranked_candidates(*_trees(spark, sf_dir)), varied_pages(spark, sf_dir))


def element_removable(spark, sf_dir):
    return elements.removable(_trees(spark, sf_dir)[0])


def element_names(spark, sf_dir):
    """The five most frequent classes and ids of each site."""
    found = _trees(spark, sf_dir)[0].join(varied_pages(spark, sf_dir).select("page_id", "site"), "page_id")
    named = found.select("site", F.explode(F.concat(F.transform("classes", lambda c: F.concat(F.lit("."), c)), F.filter(F.array(F.concat(F.lit("#"), "id")), lambda i: i.isNotNull()))).alias("name"))
    return pages.most_common(named.select("site", F.array("name").alias("names")), "site", "names", 5).withColumnRenamed("value", "name")


#: Sections of a page, the selectors of each in order.
SECTIONS = {
    "title": ["h1.article-headline", ".headline > h1", "article h1", "h1"],
    "lead": [".subtitle", "h2[class^=deck]", 'meta[name="description"]'],
    "author": ['[rel="author"]', "article > span[class~=by-author], .author-box"],
}


def element_sections(spark, sf_dir):
    """The text of the first selector of each section that finds some."""
    return elements.first_texts(*_trees(spark, sf_dir), SECTIONS)


def page_blocks(spark, sf_dir):
    """The blocks of text of each page, with their words, and what they are worth."""
    from pyspark.sql import Window

    rows = blocks.block_rows(_trees(spark, sf_dir)[1])
    order = Window.partitionBy("page_id").orderBy("block")
    return rows.select("page_id", F.row_number().over(order).alias("nth"), "text", "words", "linked_words", blocks.worth(order).alias("worth"))


def dense_texts(spark, sf_dir):
    """The main text of each page by the best run of its blocks."""
    return blocks.main_texts(_trees(spark, sf_dir)[1])


QUERIES = {f.__name__: f for f in (element_candidates, element_selector_scores, element_removable, element_names, element_sections, page_blocks, dense_texts)}


def _varied_sql() -> str:
    html = "html"
    for old, by, new in VARIED:
        html = f"replace({html}, '{old}', replace(" + "CASE page_id % " + f"{by} " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(new)) + " END, 'N', page_id::VARCHAR))"
    return html


_DECODED = "tok"
for _name, _character in {"&copy;": "©", "&middot;": "·", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&amp;": "&"}.items():
    _DECODED = f"replace({_DECODED}, '{_name}', '{_character}')"
#: Tags and strings of the pages by position. An element ends at its first end tag behind it, or else where the body or the page does.
TOKENS = rf"""
v AS (SELECT page_id, regexp_replace(regexp_extract(url, '://([^/?#]*)', 1), '^www\.', '') AS site, {_varied_sql()} AS html FROM pages),
k AS (SELECT page_id, regexp_extract_all(regexp_replace(regexp_replace(html, '(?s)<(?:script|style)>.*?</(?:script|style)>', '', 'g'), '(?s)<!--.*?-->', '', 'g'), '<[^>]*>|<|[^<]+') AS ts FROM v),
t AS MATERIALIZED (SELECT page_id, unnest(range(1, len(ts) + 1)) AS i, unnest(ts) AS tok FROM k),
x AS MATERIALIZED (SELECT page_id, i, {_DECODED} AS raw, trim({_DECODED}, chr(32) || chr(9) || chr(10) || chr(13)) AS text FROM t WHERE NOT regexp_matches(tok, '^<[a-zA-Z/!]')),
e0 AS (SELECT page_id, i, regexp_extract(tok, '^<([a-z][a-z0-9]*)', 1) AS name, regexp_extract(tok, '\sid="([^"]*)"', 1) AS id, list_filter(string_split(regexp_extract(tok, '\sclass="([^"]*)"', 1), ' '), lambda c: c <> '') AS cs,
       regexp_extract(tok, '\sclass="([^"]*)"', 1) AS class, regexp_extract(tok, '\srel="([^"]*)"', 1) AS rel, regexp_extract(tok, '\sname="([^"]*)"', 1) AS meta, regexp_extract(tok, '\scontent="([^"]*)"', 1) AS content
       FROM t WHERE regexp_matches(tok, '^<[a-z]')),
e AS MATERIALIZED (SELECT e0.*, coalesce((SELECT min(t.i) FROM t WHERE t.page_id = e0.page_id AND t.i > e0.i AND t.tok = '</' || e0.name || '>'),
       (SELECT min(t.i) FROM t WHERE t.page_id = e0.page_id AND t.i > e0.i AND t.tok = '</body>'), 1000000) AS last FROM e0),
own AS MATERIALIZED (SELECT *, CASE WHEN id <> '' THEN '#' || id WHEN len(list_filter(cs, lambda c: NOT regexp_full_match(c, '\d+'))) > 0
       THEN '.' || array_to_string(list_filter(cs, lambda c: NOT regexp_full_match(c, '\d+')), '.') ELSE name END AS selector FROM e),
"""


def _sql_test(css: str, e: str) -> str:
    """A selector of the fixed lists as a condition on a row of elements."""
    if " " in css and "[" not in css.split(" ")[1]:
        outer, inner = css.rsplit(" ", 1)
        return f"({_sql_test(inner, e)} AND EXISTS (SELECT 1 FROM own o WHERE o.page_id = {e}.page_id AND o.i < {e}.i AND {e}.i <= o.last AND {_sql_test(outer, 'o')}))"
    tag, _, rest = css.partition("[")
    tests = []
    if tag.startswith("."):
        tests.append(f"list_contains({e}.cs, '{tag[1:]}')")
    elif tag:
        tests.append(f"{e}.name = '{tag}'")
    if rest:
        attribute, value = rest.rstrip("]").replace('"', "").split("=")
        column = {"class*": "class", "rel": "rel", "name": "meta"}[attribute]
        tests.append(f"contains({e}.{column}, '{value}')" if attribute.endswith("*") else f"{e}.{column} = '{value}'")
    return "(" + " AND ".join(tests) + ")"


def _candidates_sql() -> str:
    every = [(kind, nth, css, weight) for kind, weights in candidates.KINDS.items() for nth, (css, weight) in enumerate(weights)]
    hits = "\n UNION ALL ".join(f"SELECT own.*, '{kind}' AS kind, {nth} AS nth, {weight}::DOUBLE AS weight, '{css}' AS css FROM own WHERE {_sql_test(css, 'own')}" for kind, nth, css, weight in every)
    return f"""{TOKENS}
h AS MATERIALIZED ({hits}),
span AS (SELECT DISTINCT page_id, i, last FROM h),
tx AS MATERIALIZED (SELECT s.page_id, s.i, string_agg(x.text, '' ORDER BY x.i) AS text FROM span s JOIN x ON x.page_id = s.page_id AND x.i > s.i AND x.i <= s.last WHERE x.text <> '' GROUP BY s.page_id, s.i),
r AS (SELECT h.page_id, h.kind, h.nth, h.i, h.name = 'meta' AS is_meta, CASE WHEN h.name = 'meta' THEN h.css ELSE h.selector END AS selector, h.weight, lower(h.class) AS names, h.name, CASE WHEN h.name = 'meta' THEN h.content ELSE coalesce(tx.text, '') END AS text
      FROM h LEFT JOIN tx ON tx.page_id = h.page_id AND tx.i = h.i),
sc AS (SELECT *, weight + CASE WHEN is_meta THEN 0 WHEN kind = 'titles' THEN contains(names, 'title')::INT * 0.5::DOUBLE + (name = 'h1')::INT * 0.3::DOUBLE
       WHEN kind = 'subtitles' THEN contains(names, 'subtitle')::INT * 0.5::DOUBLE WHEN kind = 'contents' THEN least(len(regexp_extract_all(text, '\\S+'))::DOUBLE / 1000, 2.0::DOUBLE) ELSE 0 END AS score
       FROM r WHERE CASE kind WHEN 'titles' THEN length(text) > 10 WHEN 'subtitles' THEN CASE WHEN is_meta THEN length(text) > 20 ELSE length(text) BETWEEN 20 AND 300 END WHEN 'authors' THEN length(text) BETWEEN 3 AND 100 ELSE length(text) > 200 END),
ranked AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY page_id, kind ORDER BY score DESC, nth, i) AS rank FROM sc QUALIFY rank <= 5)
"""


_BLOCKS = r"""
bt AS (SELECT page_id, i, tok, regexp_extract(tok, '^</?([a-z][a-z0-9]*)', 1) AS name FROM t),
bn AS (SELECT *, sum((list_contains(@, name))::INT) OVER w AS block, sum(CASE WHEN name <> 'a' THEN 0 WHEN tok[2] = '/' THEN -1 ELSE 1 END) OVER w > 0 AS linked FROM bt WINDOW w AS (PARTITION BY page_id ORDER BY i)),
bs AS (SELECT page_id, block, i, linked, CASE WHEN tok = '<br>' THEN chr(10) ELSE # END AS s FROM bn WHERE tok = '<br>' OR name = '' AND NOT regexp_matches(tok, '^<[/!]')),
bw AS (SELECT page_id, block, trim(regexp_replace(string_agg(s, '' ORDER BY i), '\s+', ' ', 'g')) AS text, sum(CASE WHEN linked THEN len(regexp_extract_all(s, '\S+')) ELSE 0 END)::BIGINT AS linked_words FROM bs GROUP BY page_id, block),
b AS MATERIALIZED (SELECT page_id, block, text, len(regexp_extract_all(text, '\S+'))::INT AS words, linked_words FROM bw WHERE text <> ''),
v1 AS (SELECT *, floor(1000.0::DOUBLE * words * (1.0::DOUBLE - 2.0::DOUBLE * sum(linked_words) OVER f / sum(words) OVER f)
       * least(sum(words) OVER f / sum(ceil(length(text) / 80.0::DOUBLE)) OVER f / 13, 1.0::DOUBLE))::BIGINT - 15000 AS worth FROM b
       WINDOW f AS (PARTITION BY page_id ORDER BY block ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)),
v2 AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY block) AS nth FROM v1),
runs AS (SELECT x.page_id, x.nth AS first, y.nth AS last, sum(z.worth) AS total FROM v2 x JOIN v2 y ON y.page_id = x.page_id AND y.nth >= x.nth JOIN v2 z ON z.page_id = x.page_id AND z.nth BETWEEN x.nth AND y.nth GROUP BY ALL),
best AS (SELECT * FROM runs WHERE total > 0 QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY total DESC, last, first) = 1)
""".replace("@", str(sorted(nodes.BLOCKS))).replace("#", _DECODED)
_REMOVED = " OR ".join(f"contains(lower(own.class) || ' ' || lower(own.id), '{word}')" for word in candidates.REMOVABLE)
SQL = {
    "element_candidates": f"WITH {_candidates_sql()} SELECT page_id, kind, rank::INT AS rank, selector, score, substr(text, 1, 150) AS text FROM ranked",
    "element_selector_scores": f"""WITH {_candidates_sql()}, tot AS (SELECT v.site, r.kind, r.selector, sum(r.score::DECIMAL(20, 6))::DOUBLE AS score FROM ranked r JOIN v USING (page_id) GROUP BY ALL)
        SELECT site, kind, selector, score, row_number() OVER (PARTITION BY site, kind ORDER BY score DESC, selector)::INT AS rank FROM tot QUALIFY rank <= 10""",
    "page_blocks": f"WITH {TOKENS} {_BLOCKS} SELECT page_id, nth::INT AS nth, text, words, linked_words, worth FROM v2",
    "dense_texts": f"WITH {TOKENS} {_BLOCKS} SELECT page_id, count(*)::INT AS n_blocks, string_agg(text, chr(10) || chr(10) ORDER BY nth) AS text FROM v2 JOIN best USING (page_id) WHERE nth BETWEEN first AND last GROUP BY page_id",
    "element_removable": f"""WITH {TOKENS} f AS (SELECT page_id, selector, min(i) AS first FROM own WHERE {_REMOVED} GROUP BY ALL)
        SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY first)::INT AS rank, selector FROM f QUALIFY rank <= 20""",
    "element_names": f"""WITH {TOKENS} n AS (SELECT page_id, '.' || unnest(cs) AS name FROM own UNION ALL SELECT page_id, '#' || id FROM own WHERE id <> ''),
        c AS (SELECT v.site, n.name, count(*) AS n FROM n JOIN v USING (page_id) GROUP BY ALL)
        SELECT site, name, n, row_number() OVER (PARTITION BY site ORDER BY n DESC, name)::INT AS rank FROM c QUALIFY rank <= 5""",
    "element_sections": f"""WITH {TOKENS}
        h AS (SELECT own.*, 'title' AS section, 0 AS nth FROM own WHERE name = 'h1' AND list_contains(cs, 'article-headline')
          UNION ALL SELECT own.*, 'title', 1 FROM own WHERE name = 'h1' AND EXISTS (SELECT 1 FROM own o WHERE o.page_id = own.page_id AND o.i = own.i - 1 AND list_contains(o.cs, 'headline'))
          UNION ALL SELECT own.*, 'title', 2 FROM own WHERE name = 'h1' AND EXISTS (SELECT 1 FROM own o WHERE o.page_id = own.page_id AND o.i < own.i AND own.i <= o.last AND o.name = 'article')
          UNION ALL SELECT own.*, 'title', 3 FROM own WHERE name = 'h1'
          UNION ALL SELECT own.*, 'lead', 0 FROM own WHERE list_contains(cs, 'subtitle')
          UNION ALL SELECT own.*, 'lead', 1 FROM own WHERE name = 'h2' AND starts_with(class, 'deck')
          UNION ALL SELECT own.*, 'lead', 2 FROM own WHERE name = 'meta' AND meta = 'description'
          UNION ALL SELECT own.*, 'author', 0 FROM own WHERE rel = 'author'
          UNION ALL SELECT own.*, 'author', 1 FROM own WHERE name = 'span' AND list_contains(cs, 'by-author')
            AND (SELECT arg_max(o.name, o.i) FROM own o WHERE o.page_id = own.page_id AND o.i < own.i AND own.i <= o.last AND o.name NOT IN ('meta', 'br')) = 'article'),
        tx AS (SELECT h.page_id, h.section, h.nth, h.i, CASE WHEN h.name = 'meta' THEN trim(any_value(h.content)) ELSE coalesce(string_agg(x.text, '' ORDER BY x.i) FILTER (WHERE x.text <> ''), '') END AS text
          FROM h LEFT JOIN x ON x.page_id = h.page_id AND x.i > h.i AND x.i <= h.last GROUP BY h.page_id, h.section, h.nth, h.i, h.name)
        SELECT page_id, section AS name, text FROM tx WHERE length(text) > 3 QUALIFY row_number() OVER (PARTITION BY page_id, section ORDER BY nth, i) = 1""",
}
