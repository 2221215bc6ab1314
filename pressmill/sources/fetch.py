"""Pages from the network behind one small interface, and the discovery of article URLs of a site.

A fetcher is any picklable callable url -> (status, content type, text) or None, or a table of answers (url, status, content_type, html), which is
joined. HttpFetcher asks the network; Polite makes any callable wait between two requests to one host.
"""

import re
import time
from collections.abc import Callable
from urllib.error import HTTPError
from urllib.parse import urljoin
from urllib.request import Request, urlopen
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import urls
from ..functions.rx import contains_any
from ..scratch import stored

Fetcher = Callable[[str], tuple[int, str, str] | None] | DataFrame
# Paths that are tried, what no article URL holds, and what articles' URLs look like.
FEED_PATHS = ["/rss", "/rss.xml", "/feed", "/feed.xml", "/feeds", "/index.xml", "/atom.xml", "/rss/news", "/feeds/all"]
SITEMAP_PATHS = ["/sitemap.xml", "/sitemap_index.xml", "/sitemaps.xml"]
NO_ARTICLE = ["/tag/", "/category/", "/author/", "/search/", "/page/", "/contact", "/about", "/privacy", "/terms", "/login", "/register", "/admin", "/wp-", "/feed", ".xml", ".json", "#", "?", "/comments"]
ARTICLE_FORMS = [r"/\d{4}/", "/news/", "/article/", "/post/", "/story/", r"-\d+$", r"-\d+\.html$"]
FEED_ENTRIES, INDEXED_SITEMAPS, PER_SITEMAP, SITEMAP_URLS, CRAWLED = 20, 5, 10, 50, 30
PAGE = "status int, content_type string, html string"
USER_AGENT = "Mozilla/5.0 (compatible; pressmill)"


class HttpFetcher:
    """Answers from the network. Failures give None, or raise if so asked; delay is what each task waits after a request."""

    def __init__(self, user_agent: str = USER_AGENT, timeout: float = 30.0, delay: float = 0.0, raises: bool = False):
        self.user_agent, self.timeout, self.delay, self.raises = user_agent, timeout, delay, raises

    def __call__(self, url: str) -> tuple[int, str, str] | None:
        if not url.lower().startswith(("http://", "https://")):
            if self.raises:
                raise ValueError(f"no web address: {url}")
            return None
        try:
            with urlopen(Request(url, headers={"User-Agent": self.user_agent}), timeout=self.timeout) as answer:
                text = answer.read().decode(answer.headers.get_content_charset() or "utf-8", errors="replace")
                return answer.status, answer.headers.get("Content-Type", ""), text
        except HTTPError as error:
            if self.raises:
                raise
            return error.code, error.headers.get("Content-Type", ""), ""
        except (OSError, ValueError):
            if self.raises:
                raise
            return None
        finally:
            if self.delay:
                time.sleep(self.delay)


class Polite:
    """A fetcher that waits until `seconds` have passed since it last asked the same host; other hosts are not held up.

    It knows of the requests of its own task only, so fetched() deals each host's links to one task.
    """

    def __init__(self, fetch: Callable[[str], tuple[int, str, str] | None], seconds: float):
        self.fetch, self.seconds, self.asked = fetch, seconds, {}

    def __call__(self, url: str) -> tuple[int, str, str] | None:
        host = url.partition("://")[2].partition("/")[0].lower()
        wait = self.asked.get(host, float("-inf")) + self.seconds - time.monotonic()
        if wait > 0:
            time.sleep(wait)
        try:
            return self.fetch(url)
        finally:
            self.asked[host] = time.monotonic()


def fetched(links: DataFrame, fetch: Fetcher) -> DataFrame:
    """links (url, ...) with status, content_type and html; null where the fetcher has nothing.

    Of several answers to one url in a table the least counts. A Polite fetcher gets all links of a host in one task, in an order that mixes hosts.
    """
    if isinstance(fetch, DataFrame):
        answers = fetch.groupBy("url").agg(F.min(F.struct("status", "content_type", "html")).alias("_a"))
        return links.join(answers, "url", "left").select(*links.columns, F.col("_a.status").cast("int").alias("status"), "_a.content_type", "_a.html")
    if isinstance(fetch, Polite):
        links = links.repartition(F.lower(urls.part(F.col("url"), "netloc"))).sortWithinPartitions(F.xxhash64("url"))
    schema = T.StructType([*links.schema, *T._parse_datatype_string(PAGE)])

    def run(batches):
        for batch in batches:
            found = [fetch(u) or (None, None, None) for u in batch["url"]]
            status, kind, html = zip(*found) if found else ((), (), ())
            yield batch.assign(status=pd.array(status, dtype="Int32"), content_type=list(kind), html=list(html))

    return links.mapInPandas(run, schema)


def cached(links: DataFrame, cache: DataFrame, fetch: Fetcher, now: Column, max_age: str | None = None) -> DataFrame:
    """host, url, html, fetched_at: from the cache (host, html, fetched_at) where it is younger than max_age, else fetched.

    Without max_age a cached page never ages.
    """
    latest = cache.groupBy("host").agg(F.max_by("html", "fetched_at").alias("html"), F.max("fetched_at").alias("fetched_at"))
    fresh = latest if max_age is None else latest.where(F.col("fetched_at") > now - F.expr(f"INTERVAL {max_age}"))
    hosted = links.withColumn("host", urls.part(F.col("url"), "netloc"))
    hits = hosted.join(fresh, "host")
    misses = fetched(hosted.join(fresh, "host", "left_anti"), fetch).where("status = 200").select(*hosted.columns, "html").withColumn("fetched_at", now)
    return hits.select("host", "url", "html", "fetched_at").unionByName(misses.select("host", "url", "html", "fetched_at"))


def probes(sites: DataFrame, paths: list[str]) -> DataFrame:
    """site, url: each site's base URL with each path."""
    return sites.select("site", F.explode(F.transform(F.array(*map(F.lit, paths)), lambda p: urls.resolved(p, F.col("base")))).alias("url"))


def feeds(sites: DataFrame, fetch: Fetcher) -> DataFrame:
    """site, url, html of the paths that answer with XML or what begins like a feed."""
    head = F.substring("html", 1, 1000)
    is_feed = F.contains(F.lower(F.coalesce("content_type", F.lit(""))), F.lit("xml")) | contains_any(head, ["<rss", "<feed", "<atom"])
    return fetched(probes(sites, FEED_PATHS), fetch).where((F.col("status") == 200) & is_feed).select("site", "url", "html")


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def feed_links(xml: str) -> list[str]:
    """Links of the first entries of an RSS or Atom document."""
    try:
        root = ElementTree.fromstring(xml.strip())
    except ElementTree.ParseError:
        return []
    entries = [e for e in root.iter() if _local(e.tag) in ("item", "entry")][:FEED_ENTRIES]
    found = []
    for entry in entries:
        for child in entry:
            if _local(child.tag) == "link" and ((child.text or "").strip() or child.get("href")):
                found.append((child.text or "").strip() or child.get("href"))
                break
    return found


def sitemap_links(xml: str) -> tuple[list[str], list[str]]:
    """Sitemaps that an index names, and pages."""
    try:
        root = ElementTree.fromstring(xml.strip())
    except ElementTree.ParseError:
        return [], []

    def of(kind, most):
        tags = [e for e in root.iter() if _local(e.tag) == kind][:most]
        return [loc.text.strip() for e in tags for loc in e if _local(loc.tag) == "loc" and loc.text][:most]

    return of("sitemap", INDEXED_SITEMAPS), of("url", SITEMAP_URLS)


def _xml_links(pages: DataFrame, read: Callable[[str], list[str]], name: str = "link") -> DataFrame:
    def run(batches):
        for batch in batches:
            rows = [(s, link) for s, html in zip(batch["site"], batch["html"]) for link in read(html or "")]
            yield pd.DataFrame(rows, columns=["site", name])

    return pages.select("site", "html").mapInPandas(run, f"site string, {name} string")


def sitemaps(sites: DataFrame, fetch: Fetcher) -> DataFrame:
    """site, url of sitemaps: those robots.txt names and the usual paths that answer with XML."""
    robots = fetched(probes(sites, ["/robots.txt"]), fetch).where("status = 200")
    lines = robots.select("site", F.explode(F.split("html", "\n")).alias("line"))
    named = lines.where(F.startswith(F.lower("line"), F.lit("sitemap:"))).select("site", F.btrim(F.regexp_replace("line", r"(?i)^sitemap:", ""), F.lit(" \t\r")).alias("url"))
    usual = fetched(probes(sites, SITEMAP_PATHS), fetch).where((F.col("status") == 200) & F.contains(F.lower("content_type"), F.lit("xml"))).select("site", "url")
    return named.unionByName(usual).distinct()


def sitemap_pages(maps: DataFrame, fetch: Fetcher) -> DataFrame:
    """site, link of pages in sitemaps and, one level down, in the sitemaps that an index names."""
    first = stored(fetched(maps, fetch).where("status = 200"))  # read twice, fetched once
    below = _xml_links(first, lambda x: sitemap_links(x)[0], "url")
    second = fetched(below, fetch).where("status = 200")
    return _xml_links(first, lambda x: sitemap_links(x)[1]).unionByName(_xml_links(second, lambda x: sitemap_links(x)[1][:PER_SITEMAP]))


def looks_like_article(url: Column, site: Column) -> Column:
    """Of the site, without what other pages' URLs hold, and either of an article's form or at least two segments deep."""
    form = F.regexp_like(url, F.lit("(?U)" + "|".join(ARTICLE_FORMS)))
    deep = F.size(F.split(F.btrim(urls.part(url, "path"), F.lit("/")), "/")) >= 2
    return F.contains(F.lower(urls.part(url, "netloc")), site) & ~contains_any(F.lower(url), NO_ARTICLE) & (form | deep)


def crawled(homes: DataFrame) -> DataFrame:
    """site, link: links on homepages (site, base, html) that look like articles, the first ones in order."""
    found = F.regexp_extract_all("html", F.lit(r"""(?is)<a\s[^>]*?href=["']([^"']*)["']"""), F.lit(1))
    full = F.transform(F.filter(found, lambda x: F.regexp_like(x, F.lit("^(/|http)"))), lambda x: urls.resolved(x, F.col("base")))
    own = F.filter(F.array_sort(F.array_distinct(full)), lambda x: looks_like_article(x, F.col("site")))
    return homes.select("site", F.explode(F.slice(own, 1, CRAWLED)).alias("link"))


def article_sample(sites: DataFrame, fetch: Fetcher, size: int) -> DataFrame:
    """site, url: up to size article URLs per site from feeds and sitemaps, and from its homepage if these give fewer. In order of URL."""
    from pyspark.sql import Window

    listed = stored(_xml_links(feeds(sites, fetch), feed_links).unionByName(sitemap_pages(sitemaps(sites, fetch), fetch)).distinct())
    few = sites.join(listed.groupBy("site").agg(F.count("*").alias("n")), "site", "left").where(F.coalesce("n", F.lit(0)) < size).drop("n")
    homes = fetched(few.withColumn("url", F.col("base")), fetch).where("status = 200")
    every = listed.unionByName(crawled(homes)).distinct().where(looks_like_article(F.col("link"), F.col("site")))
    order = Window.partitionBy("site").orderBy("link")
    return every.withColumn("i", F.row_number().over(order)).where(F.col("i") <= size).select("site", F.col("link").alias("url"))


def absolute(base: str, link: str) -> str:
    """urljoin for the driver's own use; tables use urls.resolved."""
    return urljoin(base, re.sub(r"[\t\r\n]", "", link))
