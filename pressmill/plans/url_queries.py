"""Queries over page URLs and links."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import fixed, urls
from ..operators import containment, phrase_counts
from ..operators.ledger import new_links
from .tables import LINKS_SQL, links, page_urls, spread_out, sql_list, table


def url_parts(spark, sf_dir):
    return page_urls(spark, sf_dir).select("page_id", *(urls.part(F.col("url"), p).alias(p) for p in ("scheme", "netloc", "path", "query", "fragment")))


def url_language(spark, sf_dir):
    return page_urls(spark, sf_dir).select("page_id", urls.domain_language(F.lower(urls.part(F.col("url"), "netloc"))).alias("language"))


def url_skip_reason(spark, sf_dir):
    return urls.with_skip_reason(page_urls(spark, sf_dir)).select("page_id", "reason")


def link_skip_reason(spark, sf_dir):
    return urls.with_skip_reason(links(spark, sf_dir)).select("page_id", "path", "reason")


def url_filter_reasons(spark, sf_dir):
    """Links left out by reason, and their total."""
    left_out = link_skip_reason(spark, sf_dir).where("reason <> 'passed all filters'")
    return left_out.groupBy("reason").agg(F.count("*").alias("n")).withColumn("total_skipped", F.sum("n").over(Window.partitionBy()))


#: Filter rules, dealt to hosts by the length of their names: patterns, whether an article id is asked for, whether pages without one pass.
RULES = [(1, ["/en/1", "/d"], False, False), (2, [], True, False), (3, ["/e"], True, True)]


def link_reasons_by_rules(spark, sf_dir):
    """Link filtering with rules for every host."""
    found = links(spark, sf_dir)
    numbered = found.select("domain").distinct().withColumn("i", F.length("domain") % 3 + 1)
    rules = spark.createDataFrame(RULES, "i int, additional_skip_patterns array<string>, require_article_id boolean, allow_no_id_pages boolean")
    return urls.with_skip_reason(urls.with_rules(found, numbered.join(rules, "i")), rules="rules").select("page_id", "path", "reason")


def url_kept(spark, sf_dir):
    """Kept pages by host."""
    kept = urls.with_skip_reason(page_urls(spark, sf_dir)).where("reason = 'passed all filters'")
    return kept.groupBy(urls.part(F.col("url"), "netloc").alias("host")).agg(F.count("*").alias("pages"))


def url_category_pages(spark, sf_dir):
    return links(spark, sf_dir).where(urls.is_category_page(F.lower(urls.percent_decoded(urls.part(F.col("url"), "path"))))).groupBy("path").agg(F.count("*").alias("n"))


def url_article_id(spark, sf_dir):
    return links(spark, sf_dir).select("page_id", "path", urls.article_id(F.col("url")).alias("article_id"), urls.has_article_id(F.col("url")).alias("has_id"))


def url_storage_name(spark, sf_dir):
    return links(spark, sf_dir).select("page_id", "path", urls.storage_name(F.col("path"), F.col("url")).alias("name"))


def url_reconstruct(spark, sf_dir):
    name = urls.storage_name(F.col("path"), F.col("url"))
    return links(spark, sf_dir).select("page_id", "path", urls.url_of_file(urls.full_domain(F.col("domain")), name).alias("rebuilt"))


def slug_titles(spark, sf_dir):
    """A slug of the words of each document as a title in each style."""
    docs = table(spark, sf_dir, "documents").withColumn("text", F.coalesce("text", F.lit("")))
    slug = F.array_join(F.regexp_extract_all(F.lower("text"), F.lit(r"[a-zà-ÿ]+"), F.lit(0)), "-")
    return docs.select("doc_id", *(urls.slug_title(slug, k).alias(k) for k in ("fr", "ro", "en")))


def page_links(spark, sf_dir):
    return links(spark, sf_dir).select("page_id", "domain", "path")


def page_link_counts(spark, sf_dir):
    """Links per host: on pages, distinct, and distinct ones kept by the filter."""
    found = urls.with_skip_reason(links(spark, sf_dir)).withColumn("kept", F.col("reason") == "passed all filters")
    return found.groupBy("domain").agg(F.count("*").alias("found"), F.count_distinct("path").alias("distinct_paths"), F.count_distinct(F.when(F.col("kept"), F.col("path"))).alias("kept_paths"))


def links_found(spark, sf_dir):
    """Links by domain in a second pass over pages: found, new since the first pass of the month, and old."""
    found = links(spark, sf_dir).withColumn("month", F.lit("2024-01"))
    first = found.where("page_id % 2 = 0").select("month", "domain", "path").distinct()
    second = found.where("page_id % 2 = 1").select("month", "domain", "path").distinct()
    fresh = new_links(second, first).groupBy("domain").agg(F.count("*").alias("new"))
    total = second.groupBy("domain").agg(F.count("*").alias("found"))
    new = F.coalesce("new", F.lit(0)).cast("long")
    return total.join(fresh, "domain", "left").select("domain", "found", new.alias("new"), (F.col("found") - new).alias("old"))


def _words(spark, sf_dir):
    """All distinct words of the documents as patterns."""
    words = F.explode(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"[a-z]+"), F.lit(0)))
    return table(spark, sf_dir, "documents").select(words.alias("pattern")).distinct()


def url_contained_words(spark, sf_dir):
    """How many of the documents' words stand in each link, and the first of them."""
    found = links(spark, sf_dir).select(F.lower("url").alias("text")).distinct().withColumn("url", F.col("text"))
    return containment.first_contained(found, _words(spark, sf_dir), "url", "pattern").select("url", F.col("pattern").alias("first"), "n")


def doc_contained_phrases(spark, sf_dir):
    """Ten pieces of each document, of several lengths and places, as patterns: how many documents hold each."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # pieces are cut before they become rows, each of which would carry the whole text
    cut = docs.select(F.explode(F.expr("transform(sequence(0, 9), k -> substring(text, cast(1 + (char_length(text) * k) div 10 as int), cast(3 + (doc_id * 7 + k * 5) % 23 as int)))")).alias("pattern"))
    return phrase_counts.counted(spread_out(docs), cut, "doc_id")


QUERIES = {
    f.__name__: f
    for f in (
        url_parts, url_language, url_skip_reason, link_skip_reason, url_filter_reasons, link_reasons_by_rules, url_kept, url_category_pages, url_article_id, url_storage_name, url_reconstruct, slug_titles,
        page_links, page_link_counts, links_found, url_contained_words, doc_contained_phrases,
    )
}

_SPLIT = r"""regexp_extract({u}, '^(?:([a-zA-Z][a-zA-Z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$', {n})"""


def _part(u, n):
    return _SPLIT.format(u=u, n=n)


def _reason(source, keep):
    """SQL of the filter decision over a CTE with a url column; columns: keep, reason."""
    languages = " ".join(f"WHEN ends_with(host, '{s}') THEN '{name}'" for s, name in fixed.SUFFIX_LANGUAGE)
    own = " ".join(f"WHEN '{name}' THEN {sql_list(parts)}" for name, parts in fixed.SKIP_BY_LANGUAGE.items())
    category = "(?i)" + "|".join(fixed.CATEGORY_PAGE)
    return f"""
p0 AS (SELECT {keep}, lower({_part("url", 2)}) AS host, lower(url_decode(regexp_replace({_part("url", 3)}, ';[^/]*$', ''))) AS path, lower({_part("url", 4)}) AS query FROM {source}),
p1 AS (SELECT *, CASE WHEN query <> '' THEN path || '?' || query ELSE path END AS full_path, CASE {languages} ELSE 'common' END AS language FROM p0),
p2 AS (SELECT *, list_filter({sql_list(fixed.SKIP_COMMON)}, lambda x: contains(full_path, x))[1] AS common_hit,
          list_filter(CASE language {own} ELSE [] END, lambda x: contains(full_path, x))[1] AS own_hit,
          list_filter({sql_list(fixed.SKIP_EXTENSIONS)}, lambda x: ends_with(path, x))[1] AS extension FROM p1),
reasons AS (SELECT {keep}, CASE WHEN common_hit IS NOT NULL THEN 'matches skip pattern: ' || common_hit WHEN own_hit IS NOT NULL THEN 'matches skip pattern: ' || own_hit
          WHEN regexp_matches(path, '{category}') THEN 'appears to be category page' WHEN extension IS NOT NULL THEN 'file extension ' || extension
          ELSE 'passed all filters' END AS reason FROM p2)"""


def _id(u, patterns):
    return "coalesce(" + ", ".join(f"nullif(regexp_extract({u}, '{p}', 1), '')" for p in patterns) + ")"


_CLEAN = "trim(path, '/')"
_LAST = f"replace(replace(replace(regexp_extract({_CLEAN}, '([^/]*)$', 1), '?', '_'), '#', '_'), '&', '_')"
_NAME = f"""CASE WHEN {_CLEAN} IN ({sql_list(fixed.INVALID_PATHS)[1:-1]}) OR starts_with({_CLEAN}, '-->') OR starts_with({_CLEAN}, '<!--') THEN NULL
 ELSE regexp_replace((CASE WHEN {_LAST} = '' OR regexp_matches({_LAST}, '^[0-9]+$')
      THEN coalesce('article_' || {_id("url", fixed.FETCHER_ARTICLE_ID)}, substr(md5(path), 1, 10)) ELSE {_LAST} END), '(\\.html)?$', '.html') END""".replace("\\\\", "\\")


def _title(language):
    small = sql_list(fixed.SLUG_SMALL_WORDS[language])
    rest = "CASE WHEN length(w) > 3 THEN upper(w[1]) || lower(w[2:]) ELSE lower(w) END" if language != "en" else "upper(w[1]) || lower(w[2:])"
    return f"list_aggregate(list_transform(ws, lambda w, i: CASE WHEN i = 1 THEN upper(w[1]) || lower(w[2:]) WHEN list_contains({small}, lower(w)) THEN lower(w) ELSE {rest} END), 'string_agg', ' ')"


SQL = {
    "url_contained_words": f"""WITH {LINKS_SQL}, u AS (SELECT DISTINCT lower(url) AS url FROM links), w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(coalesce(text, '')), '[a-z]+')) AS word FROM documents)
        SELECT url, min(word) AS first, count(*) AS n FROM u JOIN w ON contains(url, word) GROUP BY url""",
    "doc_contained_phrases": """WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        p AS (SELECT DISTINCT substr(text, 1 + (length(text) * k) // 10, 3 + (doc_id * 7 + k * 5) % 23) AS pattern FROM d, range(10) r(k))
        SELECT pattern, count(*) AS n, min(doc_id) AS first FROM p JOIN d ON contains(d.text, pattern) WHERE pattern <> '' GROUP BY pattern""",
    "url_parts": f"SELECT page_id, lower({_part('url', 1)}) AS scheme, {_part('url', 2)} AS netloc, regexp_replace({_part('url', 3)}, ';[^/]*$', '') AS path, {_part('url', 4)} AS query, {_part('url', 5)} AS fragment FROM pages",
    "url_language": "SELECT page_id, CASE WHEN h LIKE '%.ro' THEN 'romanian' WHEN h LIKE '%.fr' THEN 'french' WHEN h LIKE '%.com' OR h LIKE '%.org' OR h LIKE '%.net' OR h LIKE '%.uk' OR h LIKE '%.us' THEN 'english' ELSE 'common' END AS language FROM (SELECT page_id, lower(regexp_extract(url, '://([^/?#]*)', 1)) AS h FROM pages)",
    "url_skip_reason": f"WITH {_reason('pages', 'page_id')} SELECT * FROM reasons",
    "link_skip_reason": f"WITH {LINKS_SQL}, {_reason('links', 'page_id, path')}".replace("SELECT page_id, path, lower", "SELECT page_id, path AS link, lower").replace("SELECT page_id, path, CASE WHEN common", "SELECT page_id, link AS path, CASE WHEN common") + " SELECT * FROM reasons",
    "url_kept": f"WITH {_reason('pages', 'url')} SELECT regexp_extract(url, '://([^/?#]*)', 1) AS host, count(*) AS pages FROM reasons WHERE reason = 'passed all filters' GROUP BY 1",
    "url_category_pages": f"WITH {LINKS_SQL} SELECT path, count(*) AS n FROM links WHERE regexp_matches(lower(regexp_extract(path, '^[^?#]*', 0)), '{'|'.join(fixed.CATEGORY_PAGE)}') GROUP BY path",
    "url_article_id": f"WITH {LINKS_SQL} SELECT page_id, path, {_id('url', fixed.ARTICLE_ID)} AS article_id, {_id('url', fixed.ARTICLE_ID)} IS NOT NULL AS has_id FROM links",
    "url_storage_name": f"WITH {LINKS_SQL} SELECT page_id, path, {_NAME} AS name FROM links",
    "url_reconstruct": f"WITH {LINKS_SQL}, n AS (SELECT page_id, domain, path, {_NAME} AS name FROM links) SELECT page_id, path, 'https://' || CASE WHEN starts_with(domain, 'www.') THEN domain ELSE 'www.' || domain END || '/' || CASE WHEN name = 'index.html' THEN '' ELSE replace(replace(name, '.html', ''), '_', '/') END AS rebuilt FROM n",
    "slug_titles": "WITH s AS (SELECT doc_id, string_split(array_to_string(regexp_extract_all(lower(coalesce(text, '')), '[a-zà-ÿ]+'), '-'), '-') AS ws FROM documents) SELECT doc_id, "
    + ", ".join(f"{_title(k)} AS {k}" for k in ("fr", "ro", "en")) + " FROM s",
    "page_links": f"WITH {LINKS_SQL} SELECT page_id, domain, path FROM links",
    "links_found": f"WITH {LINKS_SQL}, a AS (SELECT DISTINCT domain, path FROM links WHERE page_id % 2 = 0), b AS (SELECT DISTINCT domain, path FROM links WHERE page_id % 2 = 1) "
    "SELECT domain, count(*) AS found, count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.domain = b.domain AND a.path = b.path)) AS new, count(*) FILTER (WHERE EXISTS (SELECT 1 FROM a WHERE a.domain = b.domain AND a.path = b.path)) AS old FROM b GROUP BY domain",
}
SQL["url_filter_reasons"] = SQL["link_skip_reason"].removesuffix(" SELECT * FROM reasons") + " SELECT reason, count(*) AS n, sum(count(*)) OVER ()::BIGINT AS total_skipped FROM reasons WHERE reason <> 'passed all filters' GROUP BY reason"
SQL["page_link_counts"] = (
    SQL["link_skip_reason"].removesuffix(" SELECT * FROM reasons")
    + " SELECT l.domain, count(*) AS found, count(DISTINCT l.path) AS distinct_paths, count(DISTINCT CASE WHEN reason = 'passed all filters' THEN l.path END) AS kept_paths FROM links l JOIN reasons r ON l.page_id = r.page_id AND l.path = r.path GROUP BY l.domain"
)
SQL["url_filter_reasons"] = SQL["url_filter_reasons"].replace("sum(count(*)) OVER ()::BIGINT", "CAST(sum(count(*)) OVER () AS BIGINT)")
SQL["link_reasons_by_rules"] = (
    SQL["link_skip_reason"].removesuffix(" SELECT * FROM reasons")
    + f""", h AS (SELECT DISTINCT domain, length(domain) % 3 + 1 AS i FROM links),
    j AS (SELECT r.page_id, r.path, r.reason, h.i, l.url, lower(url_decode(l.path)) AS full_path FROM reasons r JOIN links l ON r.page_id = l.page_id AND r.path = l.path JOIN h ON l.domain = h.domain),
    k AS (SELECT *, list_filter(CASE i WHEN 1 THEN {sql_list(RULES[0][1])} WHEN 3 THEN {sql_list(RULES[2][1])} ELSE [] END, lambda x: contains(full_path, x))[1] AS own FROM j)
    SELECT page_id, path, CASE WHEN starts_with(reason, 'matches skip pattern') THEN reason WHEN own IS NOT NULL THEN 'matches domain-specific pattern: ' || own
        WHEN i = 2 AND {_id("url", fixed.ARTICLE_ID)} IS NULL THEN 'no article ID found' ELSE reason END AS reason FROM k"""
)
