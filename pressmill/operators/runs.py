"""Whole runs: link discovery, fetching, feeds and retention, each one plan over tables."""

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions import urls
from ..sources import fetch as web
from ..sources import sinks
from ..scratch import stored
from . import articles, onboarding, pages, retention
from .ledger import new_links, not_done


def discover_links(sites: DataFrame, cache: DataFrame, log: DataFrame, fetch: web.Fetcher, now: Column) -> DataFrame:
    """month, domain, path of links on the sites' homepages (link) that this month's log lacks."""
    homes = web.cached(sites.select(F.col("link").alias("url")), cache, fetch, now, "5 minutes")
    found = homes.select(F.date_format(now, "yyyy-MM").alias("month"), F.col("host").alias("domain"), F.explode(urls.page_links(F.col("html"), F.col("url"))).alias("path"))
    return new_links(found, log)


def links_summary(found: DataFrame, new: DataFrame) -> DataFrame:
    """domain, found, new, old."""
    fresh = new.groupBy("domain").agg(F.count("*").alias("new"))
    total = found.groupBy("domain").agg(F.count("*").alias("found"))
    n = F.coalesce("new", F.lit(0)).cast("long")
    return total.join(fresh, "domain", "left").select("domain", "found", n.alias("new"), (F.col("found") - n).alias("old"))


def fetch_pages(links: DataFrame, ledger: DataFrame, rules: DataFrame, fetch: web.Fetcher, now: Column, limit: int | None = None) -> DataFrame:
    """links (month, domain, path) not done before, with status and reason, and html and file_name of those fetched.

    What the path or the filters rule out is never fetched. limit: successes per domain.
    """
    keyed = links.withColumns({"key": F.concat_ws(":", "month", "domain", "path"), "url": F.concat(F.lit("https://"), F.col("domain"), F.col("path"))})
    todo = urls.with_skip_reason(urls.with_rules(not_done(keyed, ledger), rules), rules="rules").drop("rules")
    todo = todo.withColumn("file_name", urls.storage_name(F.col("path"), F.col("url")))
    good = (F.col("reason") == "passed all filters") & F.col("file_name").isNotNull()
    reason = F.when(F.col("file_name").isNull(), "invalid path").otherwise(F.col("reason"))
    left_out = todo.where(~good).withColumns({"status": F.lit("filtered"), "reason": reason, "html": F.lit(None).cast("string")})
    wanted = todo.where(good).drop("reason")
    done = _answers(wanted, fetch) if limit is None else _answers_until(wanted, fetch, limit)
    return done.unionByName(left_out).withColumn("fetched_at", now)


def _answers(wanted: DataFrame, fetch: web.Fetcher) -> DataFrame:
    answers = web.fetched(wanted, fetch).drop("content_type")
    ok = (F.col("status") == 200) & F.col("html").isNotNull()
    return answers.withColumns({"ok": ok, "html": F.when(ok, F.col("html"))}).withColumns({"status": F.when(F.col("ok"), "success").otherwise("error"), "reason": F.when(~F.col("ok"), "Download failed")}).drop("ok")


def _answers_until(wanted: DataFrame, fetch: web.Fetcher, limit: int) -> DataFrame:
    """Answers in order of the path until each domain has `limit` successes.

    Each round fetches from a domain as many as it lacks, so nothing is fetched that the limit rules out.
    """
    queue = stored(wanted.withColumn("_nth", F.row_number().over(Window.partitionBy("domain").orderBy("path"))))
    state = queue.groupBy("domain").agg(F.lit(0).alias("_upto"), F.lit(0).alias("_got"))
    done = None
    while True:
        lacking = F.col("_nth").between(F.col("_upto") + 1, F.col("_upto") + limit - F.col("_got"))
        turn = stored(_answers(queue.join(state, "domain").where(lacking).drop("_upto", "_got"), fetch))
        if turn.isEmpty():
            return (turn if done is None else done).drop("_nth")
        done = turn if done is None else done.unionByName(turn)
        state = stored(done.groupBy("domain").agg(F.max("_nth").alias("_upto"), F.count_if(F.col("status") == "success").cast("int").alias("_got")))


def onboard(sites: DataFrame, fetch: web.Fetcher, now: Column, folder: str, sample: int = 8) -> DataFrame:
    """From site URLs (site, base) to saved rules and reports: finds articles, analyses them, proposes rules and validates these.

    Writes {folder}/rules (one YAML document per site, file names without `www.`) and {folder}/report (JSON), and returns the
    report. A site without articles has a report only.
    """
    urls_found = stored(web.article_sample(sites, fetch, sample))
    answers = web.fetched(urls_found, fetch).where((F.col("status") == 200) & F.col("html").isNotNull())
    parsed = stored(pages.analysed(answers.select("site", "url", "html")).drop("html"))
    rules = stored(onboarding.site_rules(parsed, "site", "url"))
    report = stored(onboarding.report(sites, urls_found, parsed, rules, now))
    onboarding.save(rules, report, folder)
    return report


def website_feeds(analysed: DataFrame, site: str, ties: str, now: Column) -> DataFrame:
    return sinks.feeds(articles.feed_rows(analysed, site, ties), site, now)


def category_feeds(analysed: DataFrame, ties: str, now: Column) -> DataFrame:
    return sinks.feeds(articles.feed_rows(articles.by_category(analysed), "category", ties), "category", now, by_category=True)


def _counts() -> list[Column]:
    return [F.count("*").alias("total"), *(F.count_if(F.col("status") == s).alias(s) for s in ("success", "error", "skipped", "filtered"))]


def counters(done: DataFrame) -> DataFrame:
    """One row: items in all and by status. For rows that are a table already; a run that is still to be worked out is counted by written()."""
    return done.agg(*_counts())


def written(done: DataFrame, path: str, *partition_by: str, mode: str = "append") -> dict[str, int]:
    """Writes a run's rows as Parquet and returns its counters, which the writing tasks add up: the run is worked out once."""
    seen = Observation()
    done.observe(seen, *_counts()).write.mode(mode).partitionBy(*partition_by).parquet(path)
    return seen.get


def cleaned_up(months: DataFrame, cache: DataFrame, log_months: DataFrame, ledger: DataFrame, now: Column) -> dict[str, DataFrame]:
    """What a retention run archives, drops and keeps."""
    return {
        "archive": retention.to_archive(months, ledger, now),
        "drop_cache": retention.stale_cache(cache, now),
        "drop_logs": retention.old_months(log_months, now, retention.LOG_DAYS),
        "keep_ledger": retention.kept_ledger(ledger, now),
    }
