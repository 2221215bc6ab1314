"""URL functions: decomposition, links, filtering, article ids, names and titles. All are column expressions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fixed
from .rx import FLAGS, capitalize, first_contained, let

_PARTS = r"(?s)^(?:([a-zA-Z][a-zA-Z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def part(url: Column, which: str) -> Column:
    """scheme, netloc, path, query or fragment; never fails, and is empty where absent."""
    number = ["scheme", "netloc", "path", "query", "fragment"].index(which) + 1
    found = F.regexp_extract(F.translate(url, "\t\r\n", ""), _PARTS, number)
    if which == "path":
        return F.regexp_replace(found, r";[^/]*$", "")
    return F.lower(found) if which == "scheme" else found


def percent_decoded(text: Column) -> Column:
    """Decodes %XX and leaves a plus sign; what cannot be decoded stays."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def filter_text(url: Column) -> Column:
    """What skip patterns are looked up in: decoded path and query, in lower case, without fragment."""
    path, query = F.lower(percent_decoded(part(url, "path"))), F.lower(part(url, "query"))
    return F.when(query != "", F.concat(path, F.lit("?"), query)).otherwise(path)


def domain_language(domain: Column) -> Column:
    found = F.lit("common")
    for suffix, language in reversed(fixed.SUFFIX_LANGUAGE):
        found = F.when(F.endswith(domain, F.lit(suffix)), language).otherwise(found)
    return found


def has_article_id(url: Column) -> Column:
    return F.coalesce(F.regexp_like(url, F.lit(FLAGS + "|".join(fixed.ARTICLE_ID))), F.lit(False))


def article_id(url: Column, patterns: list[str] = fixed.ARTICLE_ID) -> Column:
    """The id that the first matching pattern captures; null if none matches."""
    return F.coalesce(*(F.nullif(F.regexp_extract(url, FLAGS + p, 1), F.lit("")) for p in patterns))


def is_category_page(path: Column) -> Column:
    clean = F.regexp_extract(path, r"(?s)^[^?#]*", 0)
    return F.regexp_like(clean, F.lit("(?iuUd)" + "|".join(fixed.CATEGORY_PAGE)))


def _reason(url: Column, text: Column, path: Column, language: Column, rules: Column | None) -> Column:
    said = lambda p: F.lit(f"matches skip pattern: {p}")
    by_language = lambda x: [F.when(x["language"] == name, first_contained(x["text"], parts, said)) for name, parts in fixed.SKIP_BY_LANGUAGE.items()]
    listed = let(F.struct(text.alias("text"), language.alias("language")), lambda x: F.coalesce(first_contained(x["text"], fixed.SKIP_COMMON, said), *by_language(x)))
    tests = [F.when(url.isNull(), "error parsing URL"), listed]
    if rules is not None:
        own = F.get(F.filter(rules["additional_skip_patterns"], lambda p: F.contains(text, p)), F.lit(0))
        tests.append(F.when(own.isNotNull(), F.concat(F.lit("matches domain-specific pattern: "), own)))
        wanted = F.coalesce(rules["require_article_id"], F.lit(False)) & ~F.coalesce(rules["allow_no_id_pages"], F.lit(False))
        tests.append(F.when(wanted & ~has_article_id(url), "no article ID found"))
    extensions = lambda p: [F.when(F.endswith(p, F.lit(e)), f"file extension {e}") for e in fixed.SKIP_EXTENSIONS]
    tests.append(let(path, lambda p: F.coalesce(F.when(is_category_page(p), "appears to be category page"), *extensions(p))))
    return F.coalesce(*tests, F.lit("passed all filters"))


def with_skip_reason(links: DataFrame, url: str = "url", rules: str | None = None) -> DataFrame:
    """links with reason: why a URL is left out, by the first test that says so; `passed all filters` otherwise.

    rules: a struct column with additional_skip_patterns, require_article_id, allow_no_id_pages, or null in it.
    What many tests share is computed once, which keeps the plan small where the reason is filtered by.
    """
    u = F.col(url)
    shared = {"_path": F.lower(percent_decoded(part(u, "path"))), "_query": F.lower(part(u, "query")), "_language": domain_language(F.lower(part(u, "netloc")))}
    text = F.when(F.col("_query") != "", F.concat("_path", F.lit("?"), "_query")).otherwise(F.col("_path"))
    rows = links.withColumns(shared).withColumn("_text", text)
    reason = _reason(u, F.col("_text"), F.col("_path"), F.col("_language"), None if rules is None else F.col(rules))
    return rows.withColumn("reason", reason).drop("_path", "_query", "_language", "_text")


def storage_name(path: Column, url: Column) -> Column:
    """File name for a link's page; null for paths that are none."""
    clean = F.btrim(path, F.lit("/"))
    invalid = clean.isin(fixed.INVALID_PATHS) | F.startswith(clean, F.lit("-->")) | F.startswith(clean, F.lit("<!--"))
    name = F.translate(F.regexp_extract(clean, r"(?s)([^/]*)$", 1), "?#&", "___")
    fallback = F.coalesce(F.concat(F.lit("article_"), article_id(url, fixed.FETCHER_ARTICLE_ID)), F.substring(F.md5(path.cast("binary")), 1, 10))
    name = F.when((name == "") | F.regexp_like(name, F.lit(r"(?U)^\d+\z")), fallback).otherwise(name)
    return F.when(~invalid, F.when(F.endswith(name, F.lit(".html")), name).otherwise(F.concat(name, F.lit(".html"))))


def full_domain(domain: Column) -> Column:
    """With www. in front."""
    return F.when((domain == "") | F.startswith(domain, F.lit("www.")), domain).otherwise(F.concat(F.lit("www."), domain))


def bare_domain(host: Column) -> Column:
    return F.regexp_replace(F.lower(host), r"^www\.", "")


def url_of_file(domain: Column, name: Column) -> Column:
    """The page a stored file came from; underscores all become slashes, as the store lost which were which."""
    path = F.translate(F.replace(name, F.lit(".html"), F.lit("")), "_", "/")
    return F.concat(F.lit("https://"), domain, F.lit("/"), F.when(name == "index.html", "").otherwise(path))


def slug_title(slug: Column, language: str) -> Column:
    small = fixed.SLUG_SMALL_WORDS[language]

    def word(w, i):
        lower = F.lower(w)
        rest = F.when(F.char_length(w) > 3, capitalize(w)).otherwise(lower) if language in ("fr", "ro") else capitalize(w)
        return F.when(i == 0, capitalize(w)).when(lower.isin(small), lower).otherwise(rest)

    return F.array_join(F.transform(F.split(slug, "-"), word), " ")


def url_title(url: Column, domain: Column) -> Column:
    """A title read from the URL's slug, for the sites whose form is known; else empty."""
    path, found = part(url, "path"), F.lit("")
    for name, (pattern, language) in fixed.SLUG_IN_PATH.items():
        slug = F.regexp_extract(path, "(?U)" + pattern, 1)
        found = F.when(domain == name, F.when(slug != "", slug_title(slug, language)).otherwise("")).otherwise(found)
    return found


def _without_dots(url: Column) -> Column:
    """The URL with . and .. segments of its path worked out; they are rare, so most URLs pass as they are."""

    def worked_out(u):
        segments = F.split(part(u, "path"), "/")
        empty = F.array().cast("array<string>")
        up = lambda kept: F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(1)))
        kept = F.aggregate(segments, empty, lambda a, x: F.when(x == "..", up(a)).when(x == ".", a).otherwise(F.concat(a, F.array(x))))
        end = F.when(F.element_at(segments, -1).isin(".", ".."), "/").otherwise("")
        rest = F.regexp_extract(u, r"(?s)[?#].*$", 0)
        return F.concat(part(u, "scheme"), F.lit("://"), part(u, "netloc"), F.array_join(kept, "/"), end, rest)

    return let(url, lambda u: F.when(F.regexp_like(u, F.lit(r"^[^?#]*/\.{1,2}(?:[/?#]|$)")), worked_out(u)).otherwise(u))


def resolved(link: Column, base: Column) -> Column:
    """The link relative to its page's URL: absolute, //host, /path, ?query, #fragment or a name beside the page."""
    scheme, netloc, path, query = (part(base, p) for p in ("scheme", "netloc", "path", "query"))
    root = F.concat(scheme, F.lit("://"), netloc)
    folder = F.regexp_extract(path, r"^(.*/)?", 0)
    beside = F.concat(root, F.when(folder == "", "/").otherwise(folder), link)
    with_query = F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")
    return (
        F.when(F.regexp_like(link, F.lit(r"^[a-zA-Z][a-zA-Z0-9+.\-]*:")), link)
        .when(F.startswith(link, F.lit("//")), F.concat(scheme, F.lit(":"), link))
        .when(F.startswith(link, F.lit("/")), _without_dots(F.concat(root, link)))
        .when(link == "", F.concat(root, path, with_query))
        .when(F.startswith(link, F.lit("#")), F.concat(root, path, with_query, link))
        .when(F.startswith(link, F.lit("?")), F.concat(root, path, link))
        .otherwise(_without_dots(beside))
    )


def page_links(html: Column, base: Column) -> Column:
    """Distinct same-host links of a page as path, query and fragment, sorted."""
    found = F.regexp_extract_all(html, F.lit(r"""(?iud)<a [^>]*href=["'](.*?)["']"""), F.lit(1))
    full = F.transform(found, lambda x: resolved(x, base))
    own = F.filter(full, lambda x: part(x, "netloc") == part(base, "netloc"))

    def local(x):
        query, fragment = part(x, "query"), part(x, "fragment")
        return F.concat(part(x, "path"), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""), F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(""))

    return F.array_sort(F.array_distinct(F.transform(own, local)))


def with_rules(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """pages with `rules`, the struct of their domain's filters or null; domain rules are one row per site."""
    own = rules.select(F.col("domain"), F.struct("additional_skip_patterns", "require_article_id", "allow_no_id_pages").alias("rules"))
    return pages.join(own, "domain", "left")
