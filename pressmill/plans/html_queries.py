"""Queries over page HTML: cleaning, analysis of sample pages, rules of sites, extraction and feeds."""

import re
from functools import reduce

from pyspark.sql import functions as F

from ..functions import urls
from ..html import candidates
from ..operators import onboarding, pages
from ..scratch import stored
from .element_queries import SQL as _ELEMENT_SQL
from .element_queries import TOKENS, varied_pages
from .tables import spread_out, table


def _pages(spark, sf_dir):
    return spread_out(table(spark, sf_dir, "pages").withColumn("site", urls.bare_domain(urls.part(F.col("url"), "netloc"))))


def _rewritten(how):
    return lambda spark, sf_dir: pages.rewritten(_pages(spark, sf_dir), how).select("page_id", "html")


def _analysis(spark, sf_dir):
    return pages.analysed(_pages(spark, sf_dir)).drop("html")


def _varied_analysis(spark, sf_dir):
    """The same of pages whose classes, ids and elements differ from page to page."""
    return pages.analysed(spread_out(varied_pages(spark, sf_dir))).drop("html")


def html_candidates(spark, sf_dir):
    """The best selectors of each kind on each page."""
    found = _varied_analysis(spark, sf_dir)
    kinds = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(k).alias("found")) for k in candidates.KINDS))).alias("k")
    each = found.select("page_id", kinds).select("page_id", F.col("k.kind").alias("kind"), F.posexplode("k.found").alias("i", "c"))
    return each.select("page_id", "kind", (F.col("i") + 1).alias("rank"), "c.selector", "c.score", "c.text")


def html_page_parts(spark, sf_dir):
    """Size of the text, parts to remove and how many classes and ids each page has."""
    return _varied_analysis(spark, sf_dir).select("page_id", "text_chars", "text_words", F.array_join("removable", " ").alias("removable"), F.size("classes").alias("n_classes"), F.size("ids").alias("n_ids"))


def html_kept_tags(spark, sf_dir):
    """Elements that each way of cleaning leaves, by page and tag."""
    counts = None
    for how in ("strip", "clean", "light"):
        tags = F.explode(F.regexp_extract_all("html", F.lit("<([a-z][a-z0-9]*)"), F.lit(1))).alias("tag")
        own = pages.rewritten(_pages(spark, sf_dir), how).select("page_id", F.lit(how).alias("how"), tags)
        counts = own if counts is None else counts.unionByName(own)
    return counts.groupBy("page_id", "how", "tag").agg(F.count("*").alias("n"))


def site_rules(spark, sf_dir):
    """The proposed rules of each site as columns, read back from their YAML."""
    rules = onboarding.site_rules(stored(_varied_analysis(spark, sf_dir)), "site", "page_id")
    line = lambda key: F.regexp_extract("config", rf"(?m)^{key}: (.*)$", 1)
    listed = lambda key: F.array_join(F.regexp_extract_all(F.regexp_extract("config", rf"(?m)^{key}:\n((?:- .*\n)+)", 1), F.lit(r"(?m)^- (.*)$"), F.lit(1)), " ")
    unquoted = lambda c: F.regexp_replace(c, "(?m)^'(.*)'$", "$1")
    return rules.select(
        "site", "language", line("domain").alias("domain"), unquoted(line("title_selector")).alias("title_selector"), F.replace(listed("article_selectors"), F.lit("'"), F.lit("")).alias("article_selectors"),
        F.replace(listed("remove_selectors"), F.lit("'"), F.lit("")).alias("remove_selectors"), unquoted(line("author_selector")).alias("author_selector"),
    )


def page_language(spark, sf_dir):
    return _analysis(spark, sf_dir).select("page_id", "language")


def selector_scores(spark, sf_dir):
    return pages.selector_scores(_varied_analysis(spark, sf_dir), "site")


def site_classes(spark, sf_dir):
    """The ten most frequent classes of each site."""
    return pages.most_common(_varied_analysis(spark, sf_dir), "site", "classes", 10)


def repeated_texts(spark, sf_dir):
    """Short texts that pages of a site repeat."""
    return pages.most_common(_analysis(spark, sf_dir), "site", "repeated", 5)


def site_validation(spark, sf_dir):
    return pages.validated(_analysis(spark, sf_dir), "site")


def onboard_config(spark, sf_dir):
    return onboarding.site_rules(stored(_analysis(spark, sf_dir)), "site", "page_id")


def page_lang_attr(spark, sf_dir):
    """Language by the page's lang attribute, as far as it names a known one."""
    lang = F.lower(F.substring(F.regexp_extract("html", r"""(?i)<html[^>]*\blang=["']?([a-zA-Z-]+)""", 1), 1, 2))
    return table(spark, sf_dir, "pages").select("page_id", F.when(lang.isin("en", "fr", "ro", "es", "de", "it"), lang).alias("language"))


def page_titles_regex(spark, sf_dir):
    title = F.regexp_extract("html", r"(?is)<h1[^>]*>(.*?)</h1>", 1)
    return table(spark, sf_dir, "pages").select("page_id", F.btrim(F.regexp_replace(title, r"<[^>]*>", "")).alias("title"))


def _with_domain(spark, sf_dir):
    return _pages(spark, sf_dir).withColumn("domain", urls.part(F.col("url"), "netloc"))


def _articles(spark, sf_dir, method="dense"):
    return pages.extracted(_with_domain(spark, sf_dir), method=method, now=F.lit("2024-01-31 12:00:00").cast("timestamp"))


def extract_articles(spark, sf_dir):
    return _articles(spark, sf_dir).select("page_id", "skip_type", "title", "content_length", "markdown")


def extract_articles_light(spark, sf_dir):
    return _articles(spark, sf_dir, "light").select("page_id", "skip_type", "title", "content_length", "markdown")


def extract_gates(spark, sf_dir):
    """Outcomes of all pages; no text is formatted for them."""
    return pages.gated(_with_domain(spark, sf_dir)).groupBy(F.coalesce("skip_type", F.lit("success")).alias("outcome")).agg(F.count("*").alias("n"))


QUERIES = {f"html_{name}": _rewritten(how) for name, how in (("strip", "strip"), ("clean", "clean"), ("light_clean", "light"), ("markdown", "marked"))} | {
    f.__name__: f
    for f in (html_candidates, html_page_parts, html_kept_tags, site_rules, page_language, selector_scores, site_classes, repeated_texts, site_validation, onboard_config, page_lang_attr, page_titles_regex, extract_articles, extract_articles_light, extract_gates)
}
#: Pages of the tables in SQL: without scripts and styles (whose text is no text), without comments, entities as characters.
_PAGES = r"""
p0 AS (SELECT page_id, html, regexp_replace(regexp_extract(url, '://([^/?#]*)', 1), '^www\.', '') AS site, lower(substr(regexp_extract(html, '(?i)<html[^>]*\blang=["'']?([a-zA-Z-]+)', 1), 1, 2)) AS lang,
    regexp_replace(regexp_replace(html, '(?s)<(?:script|style)>.*?</(?:script|style)>', '', 'g'), '(?s)<!--.*?-->', '', 'g') AS bare FROM pages),
p1 AS (SELECT *, @regexp_replace(bare, '<[^>]*>', chr(1), 'g')@ AS marked,
    @trim(regexp_extract(bare, '(?s)<h1>(.*?)</h1>', 1))@ AS h1, @regexp_replace(regexp_extract(bare, '(?s)<article>(.*?)</article>', 1), '\s*<[^>]*>\s*', '', 'g')@ AS body FROM p0),
p AS (SELECT *, replace(marked, chr(1), '') AS page_text FROM p1),
a AS (SELECT *, CASE WHEN lang IN ('en', 'fr', 'ro', 'es', 'de', 'it') THEN lang WHEN regexp_matches(lower(substr(page_text, 1, 1000)), 'le |la |les |des |une |par ') THEN 'fr'
    WHEN regexp_matches(lower(substr(page_text, 1, 1000)), 'și |în |de |cu |pe |sau ') THEN 'ro' ELSE 'en' END AS language FROM p),
c AS (SELECT page_id, site, 'titles' AS kind, 'h1' AS selector, 2.0::DOUBLE + 0.3::DOUBLE AS score, h1 AS text FROM p WHERE length(h1) > 10
    UNION ALL SELECT page_id, site, 'contents', 'article', 1.5::DOUBLE + least(len(regexp_extract_all(body, '\S+'))::DOUBLE / 1000, 2.0::DOUBLE), body FROM p WHERE length(body) > 200),
s0 AS (SELECT page_id, site, trim(unnest(string_split(marked, chr(1)))) AS value FROM p),
s1 AS (SELECT page_id, site, value FROM s0 WHERE length(value) BETWEEN 5 AND 100 GROUP BY 1, 2, 3 HAVING count(*) > 1),
rep AS (SELECT site, value, count(*) AS n, row_number() OVER (PARTITION BY site ORDER BY count(*) DESC, value) AS rank FROM s1 GROUP BY site, value),
lg AS (SELECT site, language, row_number() OVER (PARTITION BY site ORDER BY count(*) DESC, min(page_id)) AS k FROM a GROUP BY site, language)
"""
_ENTITIES = {"&copy;": "©", "&middot;": "·", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&amp;": "&"}
#: What stands between two at signs, with its entities as characters.
_PAGES = re.sub(r"@([^@]+)@", lambda m: reduce(lambda x, e: f"replace({x}, '{e[0]}', '{e[1]}')", _ENTITIES.items(), m[1]), _PAGES)
_TAGS = r"t AS (SELECT page_id, unnest(regexp_extract_all(regexp_replace(html, '(?s)<(?:script|style)>.*?</(?:script|style)>', '', 'g'), '<([a-z][a-z0-9]*)', 1)) AS tag FROM pages)"
#: Elements of the tables' pages that are gone: in strip those without content and attributes, in both others what is no content and what it holds.
_GONE = {"strip": ["br", "meta"], "clean": ["head", "meta", "title", "nav", "ul", "li", "a", "footer"], "light": ["meta", "title", "nav", "ul", "li", "a", "footer"]}
_LISTED = "(SELECT site, string_agg(selector, ' ' ORDER BY first) AS {name} FROM (SELECT site, selector, min(pos) AS first FROM ({rows}) GROUP BY site, selector QUALIFY row_number() OVER (PARTITION BY site ORDER BY min(pos)) <= {most}) GROUP BY site)"


def _listed_sql(name: str, own: str, others: list[str], most: int) -> str:
    """A site's own selectors (site, selector, pos) and those that all sites have behind them, each once, as text."""
    fixed = " UNION ALL ".join(f"SELECT site, '{x}', {1000 + i} FROM sites" for i, x in enumerate(others))
    return _LISTED.format(name=name, rows=f"{own} UNION ALL {fixed}", most=most)


_REMOVED = _ELEMENT_SQL["element_removable"]
_SCORES = _ELEMENT_SQL["element_selector_scores"]
SQL = {
    "html_candidates": _ELEMENT_SQL["element_candidates"],
    "selector_scores": _SCORES,
    "html_page_parts": f"""WITH {TOKENS} r AS (SELECT page_id, string_agg(selector, ' ' ORDER BY rank) AS removable FROM ({_REMOVED}) GROUP BY page_id),
        c AS (SELECT page_id, sum(len(cs)) AS n_classes, count(*) FILTER (WHERE id <> '') AS n_ids FROM own GROUP BY page_id), x2 AS (SELECT page_id, string_agg(raw, '' ORDER BY i) AS page_text FROM x GROUP BY page_id)
        SELECT page_id, length(page_text)::INT AS text_chars, len(regexp_extract_all(page_text, '\\S+'))::INT AS text_words, coalesce(removable, '') AS removable, n_classes::INT AS n_classes, n_ids::INT AS n_ids FROM x2 JOIN c USING (page_id) LEFT JOIN r USING (page_id)""",
    "site_classes": f"""WITH {TOKENS} n AS (SELECT page_id, unnest(cs) AS value FROM own), c AS (SELECT v.site, value, count(*) AS n FROM n JOIN v USING (page_id) GROUP BY ALL)
        SELECT site, value, n, row_number() OVER (PARTITION BY site ORDER BY n DESC, value)::INT AS rank FROM c QUALIFY rank <= 10""",
    "site_rules": f"""WITH {_PAGES}, sites AS (SELECT DISTINCT site FROM p), sc AS MATERIALIZED ({_SCORES}), rm AS MATERIALIZED (SELECT DISTINCT site, selector FROM ({_REMOVED}) JOIN p USING (page_id)),
        rr AS (SELECT site, selector, row_number() OVER (PARTITION BY site ORDER BY selector) AS pos FROM rm QUALIFY pos <= 20)
        SELECT lg.site, language, CASE WHEN starts_with(lg.site, 'www.') THEN lg.site ELSE 'www.' || lg.site END AS domain,
        coalesce((SELECT selector FROM sc WHERE sc.site = lg.site AND kind = 'titles' AND rank = 1), 'h1') AS title_selector, article_selectors, remove_selectors,
        coalesce((SELECT selector FROM sc WHERE sc.site = lg.site AND kind = 'authors' AND rank = 1), '{onboarding.AUTHOR_SELECTOR}') AS author_selector
        FROM lg JOIN {_listed_sql("article_selectors", "SELECT site, selector, rank AS pos FROM sc WHERE kind = 'contents' AND rank <= 5", onboarding.ARTICLE_FALLBACKS, 10)} USING (site)
        JOIN {_listed_sql("remove_selectors", "SELECT site, selector, pos FROM rr WHERE pos <= 15", onboarding.COMMON_REMOVED, 1000)} USING (site) WHERE k = 1""",
    "page_lang_attr": """SELECT page_id, CASE WHEN lang IN ('en', 'fr', 'ro', 'es', 'de', 'it') THEN lang END AS language FROM
        (SELECT page_id, lower(substr(regexp_extract(html, '(?i)<html[^>]*\\blang=["'']?([a-zA-Z-]+)', 1), 1, 2)) AS lang FROM pages)""",
    "page_titles_regex": "SELECT page_id, trim(regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]*>', '', 'g')) AS title FROM pages",
    "page_language": f"WITH {_PAGES} SELECT page_id, language FROM a",
    "html_kept_tags": f"WITH {_TAGS} " + " UNION ALL ".join(f"SELECT page_id, '{how}' AS how, tag, count(*) AS n FROM t WHERE NOT list_contains({gone}, tag) GROUP BY page_id, tag" for how, gone in _GONE.items()),
    "repeated_texts": f"WITH {_PAGES} SELECT site, value, n, rank FROM rep WHERE rank <= 5",
    "site_validation": f"""WITH {_PAGES} SELECT site, count(*) AS pages, count(*) FILTER (WHERE length(page_text) > 500) AS successful, count(*) FILTER (WHERE length(page_text) <= 500) AS failed,
        coalesce(avg(len(regexp_extract_all(page_text, '\\S+'))) FILTER (WHERE length(page_text) > 500), 0.0::DOUBLE) AS average_words FROM p GROUP BY site""",
}
