"""Whole runs and pluggable models on literal tables."""

from pyspark.sql import functions as F

from pressmill.functions import models
from pressmill.operators import runs
from pressmill.sources.files import LEDGER

NOW = "2024-03-15 10:20:00"


class Loud:
    def summarize(self, texts, max_length, min_length):
        return [t[:max_length].upper() for t in texts]

    def classify(self, texts, labels):
        return [(labels[len(t) % len(labels)], 0.5) for t in texts]


def test_models(spark):
    frame = spark.createDataFrame([("some text", "/a-b-12"), (None, None)], "t string, p string")
    assert [r.x for r in frame.select(models.summary(F.col("t"), Loud, 4, 1).alias("x")).collect()] == ["SOME", ""]
    got = frame.select(models.topic(F.col("p"), Loud).alias("x"), models.content_type(F.col("t"), F.col("p"), Loud).alias("y")).first()
    assert got.x.label == models.TOPICS[3] and got.y.label in models.TYPES


def test_discover_and_fetch(spark):
    now = F.lit(NOW).cast("timestamp")
    web = {
        "https://a.com": (200, "", '<a href="/news/x-1234567">1</a><a href="/contact">2</a><a href="/news/y-7654321">3</a><a href="/old/1234567">4</a>'),
        "https://a.com/news/x-1234567": (200, "", "<p>x</p>"),
    }
    sites = spark.createDataFrame([("https://a.com",)], "link string")
    cache = spark.createDataFrame([], "host string, html string, fetched_at timestamp")
    log = spark.createDataFrame([("2024-03", "a.com", "/old/1234567")], "month string, domain string, path string")
    new = runs.discover_links(sites, cache, log, web.get, now)
    assert sorted(r.path for r in new.collect()) == ["/contact", "/news/x-1234567", "/news/y-7654321"]
    assert [tuple(r) for r in runs.links_summary(new.unionByName(log), new).collect()] == [("a.com", 4, 3, 1)]
    ledger = spark.createDataFrame([("fetch", "2024-03:a.com:/none", "success", None, None, None, None)], LEDGER)
    rules = spark.createDataFrame([], "domain string, additional_skip_patterns array<string>, require_article_id boolean, allow_no_id_pages boolean")
    links = new.unionByName(spark.createDataFrame([("2024-03", "a.com", "/none"), ("2024-03", "a.com", "/")], new.schema))
    done = runs.fetch_pages(links, ledger, rules, web.get, now)
    got = {r.path: (r.status, r.reason, r.html) for r in done.collect()}
    assert got == {
        "/news/x-1234567": ("success", None, "<p>x</p>"), "/news/y-7654321": ("error", "Download failed", None), "/contact": ("filtered", "matches skip pattern: /contact", None), "/": ("filtered", "invalid path", None),
    }
    assert tuple(runs.counters(done).first()) == (4, 1, 1, 0, 2)
    assert sum(r.status == "success" for r in runs.fetch_pages(links, ledger, rules, lambda u: (200, "", u), now, limit=1).collect()) == 1


def test_retention_run(spark):
    now = F.lit(NOW).cast("timestamp")
    months = spark.createDataFrame([("2023-01",), ("2024-01",), ("2024-03",)], "month string")
    cache = spark.createDataFrame([("a", "2024-03-01 00:00:00"), ("b", "2024-03-14 00:00:00")], "host string, t string").select("host", F.col("t").cast("timestamp").alias("modified_at"))
    ledger = spark.createDataFrame([("archive", "content:2023-01", "archived", None, None, None, None)], LEDGER)
    plan = runs.cleaned_up(months, cache, months, ledger, now)
    assert [r.month for r in plan["archive"].collect()] == ["2024-01"] and [r.host for r in plan["drop_cache"].collect()] == ["a"]
    assert [r.month for r in plan["drop_logs"].collect()] == ["2023-01"] and plan["keep_ledger"].count() == 1
