"""Readers, writers, discovery and streams on small folders; no network."""

import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from pressmill.operators import ledger, monitor, pages, retention
from pressmill.sources import fetch, files, sinks
from pressmill.streaming import incremental

NOW = "2024-03-15 10:20:00"


def now():
    return F.lit(NOW).cast("timestamp")


def test_sites_and_link_log(spark, tmp_path):
    (tmp_path / "sites.csv").write_text("link,city,country\nhttps://a.com , X,Y\nhttps://b.com\n\n")
    assert [tuple(r) for r in files.sites(spark, f"{tmp_path}/sites.csv").collect()] == [("https://a.com", "X", "Y"), ("https://b.com", "", "")]
    assert files.sites(spark, f"{tmp_path}/none.csv").count() == 0
    (tmp_path / "logs/2025-09").mkdir(parents=True)
    (tmp_path / "logs/2025-09/a.com.csv").write_text("2025-09-06: 07:21,/x\n2025-09-06: 07:22,/y\nshort\n")
    (tmp_path / "logs/2025-09/summary.csv").write_text("x,/z\n")
    log = files.link_log(spark, f"{tmp_path}/logs")
    assert sorted((r.month, r.domain, r.path) for r in log.collect()) == [("2025-09", "a.com", "/x"), ("2025-09", "a.com", "/y")]
    assert str(log.select(files.seen_time(F.col("seen_at"))).orderBy("path").first()[0]) == "2025-09-06 07:21:00"
    found = spark.createDataFrame([("2025-09", "a.com", "/x"), ("2025-10", "a.com", "/x"), ("2025-09", "a.com", "/n")], "month string, domain string, path string")
    new = ledger.new_links(found, log)
    assert sorted((r.month, r.path) for r in new.collect()) == [("2025-09", "/n"), ("2025-10", "/x")]
    sinks.append_links(new, f"{tmp_path}/out", now())
    assert spark.read.csv(f"{tmp_path}/out").count() == 2


def test_pages_metadata_rules(spark, tmp_path):
    raw = tmp_path / "content/2025-09/www.a.com/raw"
    raw.mkdir(parents=True)
    (raw / "one.html").write_bytes("<p>é".encode() + b"\xff</p>")
    got = files.html_files(spark, f"{tmp_path}/content").collect()
    assert [tuple(r) for r in got] == [("www.a.com", "2025-09", "one.html", "<p>é</p>")]
    meta = tmp_path / "content/2025-09/www.a.com/metadata"
    meta.mkdir()
    (meta / "one.yaml").write_text("title: T\nimportance_score: 0.5\ncategories: [politic]\nother: 1\n")
    (meta / "bad.yaml").write_text("{:")
    rows = files.metadata(spark, f"{tmp_path}/content").collect()
    assert [(r.title, r.importance_score, r.categories, r._month, r._domain) for r in rows] == [("T", 0.5, ["politic"], "2025-09", "www.a.com")]
    (tmp_path / "rules").mkdir()
    (tmp_path / "rules/www.a.com.yaml").write_text("language: fr\ncontent_filters: {require_article_id: true, additional_skip_patterns: [/x]}\ncleanup_patterns: {a: [b], c: [d, e]}\n")
    (tmp_path / "rules/www.b.com.yaml").write_text("{:")
    rows = {r.domain: r for r in files.rules(spark, f"{tmp_path}/rules").collect()}
    assert rows["www.a.com"].cleanup_patterns == ["b", "d", "e"] and rows["www.a.com"].require_article_id and rows["www.b.com"].additional_skip_patterns == []
    assert files.rules(spark, f"{tmp_path}/none").count() == 0 and files.settings("a: 1") == {"a": 1} and files.settings("{:") == {}


def test_extraction_with_rules(spark):
    body = "".join(f"<p>Paragraph number {i} says something of its own, at length and in words.</p>" for i in range(8))
    html = f"<html><head><title>The page</title></head><body><article><h1>Head line</h1>{body}<p>Subscribe to our list</p></article><p class='author'>Ann B</p></body></html>"
    rows = [("www.a.com", "https://www.a.com/x", html), ("www.b.com", "https://www.b.com/y", html), ("www.a.com", "u", "<p>tiny</p>"), ("www.a.com", "v", None), ("www.a.com", "w", "<p>" + "same " * 500 + "</p>")]
    rules = {"www.a.com": {"cleanup_patterns": {"x": ["^Subscribe.*$"]}, "custom_content_sections": {"enabled": True, "sections": [{"name": "a", "selectors": [".author"], "format": "*By {content}*"}]}}}
    frame = spark.createDataFrame(rows, "domain string, url string, html string")
    got = {r.url: r for r in pages.extracted(frame, rules, now=now()).collect()}
    a, b = got["https://www.a.com/x"], got["https://www.b.com/y"]
    assert a.markdown.startswith("*By Ann B*") and "Subscribe" not in a.markdown and "# Head line" in a.markdown
    assert b.markdown.startswith("# Head line") and "Subscribe" in b.markdown and b.title == "The page" and b.content_length == len(b.markdown)
    assert got["u"].skip_type == got["v"].skip_type == "html_too_small" and got["w"].skip_type == "repetitive_content" and got["w"].markdown is None


WEB = {
    "https://a.com/rss.xml": (200, "text/html", "<rss><channel><item><link>https://a.com/news/one-1</link></item><item><link>https://a.com/tag/x</link></item></channel></rss>"),
    "https://a.com/robots.txt": (200, "text/plain", "User-agent: *\nSitemap: https://a.com/map.xml\n"),
    "https://a.com/map.xml": (200, "text/xml", "<sitemapindex xmlns='http://s'><sitemap><loc>https://a.com/sub.xml</loc></sitemap></sitemapindex>"),
    "https://a.com/sub.xml": (200, "text/xml", "<urlset><url><loc>https://a.com/2024/deep</loc></url><url><loc>https://b.com/2024/other</loc></url></urlset>"),
    "https://b.com": (200, "text/html", '<a href="/news/b-2">x</a><a href="/flat">x</a><a href="mailto:x">x</a><a href="https://b.com/2024/home">x</a>'),
}


def test_discovery(spark):
    sites = spark.createDataFrame([("a.com", "https://a.com"), ("b.com", "https://b.com")], "site string, base string")
    got = sorted(tuple(r) for r in fetch.article_sample(sites, WEB.get, 2).collect())
    assert got == [("a.com", "https://a.com/2024/deep"), ("a.com", "https://a.com/news/one-1"), ("b.com", "https://b.com/2024/home"), ("b.com", "https://b.com/news/b-2")]
    assert fetch.feed_links("<feed xmlns='http://www.w3.org/2005/Atom'><entry><link href='u'/></entry></feed>") == ["u"] and fetch.feed_links("no xml") == []


def test_cache(spark):
    cache = spark.createDataFrame([("a.com", "old", "2024-03-15 10:14:00"), ("b.com", "new", "2024-03-15 10:16:00")], "host string, html string, t string").select("host", "html", F.col("t").cast("timestamp").alias("fetched_at"))
    links = spark.createDataFrame([("https://a.com",), ("https://b.com",), ("https://c.com",)], "url string")
    web = {"https://a.com": (200, "", "fetched"), "https://c.com": (404, "", "x")}
    aged = {r.host: r.html for r in fetch.cached(links, cache, web.get, now(), "5 minutes").collect()}
    assert aged == {"a.com": "fetched", "b.com": "new"}
    assert {r.host: r.html for r in fetch.cached(links, cache, web.get, now()).collect()} == {"a.com": "old", "b.com": "new"}


def test_writers(spark, tmp_path):
    rows = spark.createDataFrame([("2024-01", "a", "f", "u1", "x", 1), ("2024-01", "a", "f", "u2", "y", 2)], "month string, domain string, file_name string, url string, html string, fetched_at int")
    sinks.write_pages(rows, f"{tmp_path}/pages")
    assert [r.html for r in spark.read.parquet(f"{tmp_path}/pages").collect()] == ["y"]
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, v int, w string")
    new = spark.createDataFrame([("a", 9, 0.5)], "k string, v int, s double")
    assert sorted(tuple(r) for r in sinks.merged(old, new, "k").collect()) == [("a", 9, "x", 0.5), ("b", 2, "y", None)]
    assert sinks.archive_month(spark, f"{tmp_path}/pages", f"{tmp_path}/archive", "2024-01")["status"] == "archived"
    assert not (tmp_path / "pages/month=2024-01").exists() and spark.read.parquet(f"{tmp_path}/archive").count() == 1
    assert sinks.archive_month(spark, f"{tmp_path}/pages", f"{tmp_path}/archive", "2023-01")["status"] == "error"
    skips = spark.createDataFrame([("2024-01-02T03:04:05", "f", "d", "html_too_small", "r", {"k": "v"})], files.SKIP_LOG)
    assert sinks.readable_skips(skips).first().value == "[2024-01-02 03:04:05] HTML_TOO_SMALL: f\n  Domain: d\n  Reason: r\n  k: v\n"
    sinks.write_skips(skips, f"{tmp_path}/skips")
    assert files.skip_log(spark, f"{tmp_path}/skips").count() == 1
    assert sinks.summary_line({"found": 2}, "links", "now", 1.5) == "now | links | found: 2 | time: 1.50s"


def test_feeds(spark):
    from pressmill.operators.articles import feed_rows

    rows = [(i, "s", f"T & {i}", f"https://x/{i}", s, t, ["politic"], d) for i, (s, t, d) in enumerate([(0.4, "2024-01-02", "2024-01-05"), (0.9, "2024-01-01", "bad"), (0.39, "2024-01-03", None), (None, "2024", None), (0.4, "2024-01-03", None)])]
    frame = spark.createDataFrame(rows, "id int, site string, title string, url string, importance_score double, extracted_at string, categories array<string>, date string").withColumn("ai_processed_at", F.lit(None).cast("string"))
    ranked = feed_rows(frame, "site", "id")
    # the least important first, and of equal ones the newest
    assert [r.id for r in ranked.orderBy("rank").collect()] == [4, 0, 1]
    assert [r.id for r in feed_rows(frame, "site", "id", best_first=True).orderBy("rank").collect()] == [1, 4, 0]
    row = sinks.feeds(ranked, "site", now()).first()
    root = ET.fromstring(row.xml.encode())
    assert row.article_count == 3 and [i.findtext("title") for i in root.iter("item")] == ["T & 4", "T & 0", "T & 1"]
    assert [i.findtext("pubDate") for i in root.iter("item")] == ["Fri, 15 Mar 2024 10:20:00 ", "Fri, 05 Jan 2024 00:00:00 ", "Fri, 15 Mar 2024 10:20:00 "]


def test_ledger_monitor_retention(spark):
    rows = spark.createDataFrame([("s", "a", "error", "2024-03-01"), ("s", "a", "success", "2024-03-02"), ("s", "b", "error", "2024-01-01"), ("s", "c", "skipped", None)], "stage string, key string, status string, t string").withColumn("ts", F.col("t").cast("timestamp")).drop("t")
    assert sorted((r.key, r.status) for r in ledger.latest(rows).collect()) == [("a", "success"), ("b", "error"), ("c", "skipped")]
    work = spark.createDataFrame([("a",), ("b",), ("d",)], "key string")
    assert sorted(r.key for r in ledger.not_done(work, rows).collect()) == ["b", "d"]
    assert sorted(r.key for r in retention.kept_ledger(rows, now()).collect()) == ["a", "a", "c"]
    months = spark.createDataFrame([("2024-01",), ("2024-02",), ("x",)], "month string")
    assert [r.month for r in retention.old_months(months, now()).collect()] == ["2024-01"]
    assert monitor.storage_alert(95, 100).startswith("CRITICAL") and monitor.storage_alert(85, 100).startswith("WARNING") and monitor.storage_alert(5, 100) is None
    sent = []
    assert not monitor.send(["x"], lambda *a: sent.append(a), {}) and monitor.send(["x"], lambda *a: sent.append(a), {"email": {"enabled": True}}) and len(sent) == 1
    assert monitor.ping(["u"], lambda u: False, {"health_checks": {"enabled": True}}) and not monitor.ping(["u"], lambda u: False, {})
    items = spark.createDataFrame([(1, "success"), (2, "error"), (3, "success"), (4, "success")], "i int, status string")
    assert [r.i for r in ledger.limit_successes(items, 2, "i").orderBy("i").collect()] == [1, 2, 3]
    assert ledger.limit_successes(items, 9, "i").count() == 4


def test_staged_stream_retries_failures_only(spark, tmp_path):
    table = incremental.LedgerTable(spark, f"file://{tmp_path}/ledger")
    seen = []

    def work(rows):
        rows = rows.withColumn("status", F.when(F.col("key") == "bad", "error").otherwise("success")).withColumn("reason", F.lit(None).cast("string"))
        seen.append(sorted(r.key for r in rows.collect()))
        return rows

    for keys in (["a", "bad"], ["a", "bad", "c"]):
        spark.createDataFrame([(k,) for k in keys], "key string").coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
        incremental.staged(incremental.arriving(spark, f"file://{tmp_path}/in", "key string"), "s", work, table, f"file://{tmp_path}/out", f"file://{tmp_path}/cp").awaitTermination()
    assert seen == [["a", "bad"], ["bad", "c"]]
    assert sorted((r.key, r.status) for r in table.read().collect()) == [("a", "success"), ("bad", "error"), ("c", "success")]
    assert sorted(r.key for r in spark.read.parquet(f"file://{tmp_path}/out").collect()) == ["a", "c"]


@pytest.mark.parametrize("kind", ["links", "outcomes"])
def test_streams(spark, tmp_path, kind):
    if kind == "links":
        rows = [("https://h.com/", '<a href="/x">1</a><a href="/y">2</a>', "2024-01-05 10:00:00"), ("https://h.com/", '<a href="/x">1</a>', "2024-01-06 10:00:00"), ("https://h.com/", '<a href="/x">1</a>', "2024-02-01 10:00:00")]
        frame = spark.createDataFrame(rows, "url string, html string, t string").select("url", "html", F.col("t").cast("timestamp").alias("seen_at"))
        make, want = incremental.new_links, [("2024-01", "/x"), ("2024-01", "/y"), ("2024-02", "/x")]
    else:
        rows = [("s", "success", "2024-01-05 10:05:00"), ("s", "error", "2024-01-05 10:15:00"), ("s", "success", "2024-01-05 20:15:00")]
        frame = spark.createDataFrame(rows, "stage string, status string, t string").select("stage", "status", F.col("t").cast("timestamp").alias("ts"))
        make, want = incremental.outcomes, [("s", 50.0)]
    frame.coalesce(1).write.parquet(f"file://{tmp_path}/in")
    stream = make(incremental.arriving(spark, f"file://{tmp_path}/in", frame.schema))
    query = stream.writeStream.format("memory").queryName(f"q_{kind}").option("checkpointLocation", f"file://{tmp_path}/cp").trigger(availableNow=True).start()
    query.awaitTermination()
    got = spark.table(f"q_{kind}")
    assert sorted(((r.month, r.path) for r in got.collect()) if kind == "links" else ((r.stage, r.rate) for r in got.collect())) == want


def test_http_fetcher():
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer
    from urllib.error import HTTPError

    seen = []

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            seen.append(self.headers["User-Agent"])
            self.send_response(200 if self.path == "/ok" else 404)
            self.send_header("Content-Type", "text/html; charset=latin-1")
            self.end_headers()
            self.wfile.write("é".encode("latin-1"))

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    get, strict = fetch.HttpFetcher("agent x", timeout=5), fetch.HttpFetcher("agent x", timeout=5, raises=True)
    assert get(f"{base}/ok") == (200, "text/html; charset=latin-1", "é") and seen == ["agent x"]
    assert get(f"{base}/none")[0] == 404 and get("file:///etc/hosts") is None
    with pytest.raises(HTTPError):
        strict(f"{base}/none")
    server.shutdown()
    server.server_close()
    assert get(f"{base}/ok") is None
    for bad in (f"{base}/ok", "nowhere"):
        with pytest.raises((OSError, ValueError)):
            strict(bad)


def test_limited_fetching_stops(spark):
    """No more is fetched from a domain than until its limit of successes is reached."""
    from pressmill.operators import runs

    asked = spark.sparkContext.accumulator(0)

    def get(url):
        asked.add(1)
        return (404 if url.endswith("3") else 200, "", url)

    links = spark.createDataFrame([("2024-03", f"www.{d}.com", f"/news/item-12345{i}") for d in "ab" for i in range(9)], "month string, domain string, path string")
    ledger_rows = spark.createDataFrame([], files.LEDGER)
    rules = spark.createDataFrame([], "domain string, additional_skip_patterns array<string>, require_article_id boolean, allow_no_id_pages boolean")
    done = runs.fetch_pages(links, ledger_rows, rules, get, now(), limit=5).collect()
    assert sorted((r.domain[4], r.path[-1], r.status) for r in done) == [(d, str(i), "error" if i == 3 else "success") for d in "ab" for i in range(6)] and asked.value == 12
