"""Round trips: tables written by the sinks into a scratch folder and read back by the readers."""

from pyspark.sql import functions as F

from ..functions import urls
from ..scratch import scratch_dir
from ..sources import files, sinks
from . import text_queries
from .tables import LINKS_SQL, links, table
from .url_queries import _NAME

NOW = "2024-03-15 10:20:00"


def _now():
    return F.lit(NOW).cast("timestamp")


def io_sites(spark, sf_dir):
    """Suppliers as a site list in CSV, some rows short or blank, as the reader returns it."""
    path = scratch_dir(spark)
    nation = table(spark, sf_dir, "nation")
    rows = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    link = F.when(F.col("s_suppkey") % 7 != 0, F.concat(F.lit(" https://"), F.lower(F.translate("s_name", "#", "")), F.lit(".com")))
    rows.select(link.alias("link"), F.when(F.col("s_suppkey") % 3 != 0, F.col("n_name")).alias("city"), F.lit("X ").alias("country")).write.option("header", True).csv(path)
    return files.sites(spark, path)


def io_link_log(spark, sf_dir):
    """New links of two runs of one month, appended to the log by month and domain."""
    path = scratch_dir(spark)
    found = links(spark, sf_dir).withColumn("month", F.lit("2024-03")).select("page_id", "month", "domain", "path")
    for turn in (0, 1):
        sinks.append_links(found.where(F.col("page_id") % 2 == turn).select("month", "domain", "path").distinct(), path, _now())
    return spark.read.schema("seen_at string, path string, month string, domain string").csv(path).groupBy("month", "domain", "seen_at").agg(F.count("*").alias("n"), F.count_distinct("path").alias("paths"))


def io_pages(spark, sf_dir):
    """Links stored as pages: of those with one name at a domain the last fetched stays."""
    path = scratch_dir(spark)
    found = links(spark, sf_dir).withColumns({"file_name": urls.storage_name(F.col("path"), F.col("url")), "month": F.lit("2024-03"), "fetched_at": F.timestamp_seconds("page_id")})
    sinks.write_pages(found.where("file_name is not null").select("month", "domain", "file_name", "url", "page_id", "fetched_at"), path)
    return spark.read.parquet(path).select("domain", "file_name", "page_id")


def io_articles(spark, sf_dir):
    """Documents as articles by month and domain, one month written twice."""
    path = scratch_dir(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("source", F.lit("none")).alias("domain"), F.length("text").alias("chars"), F.concat(F.lit("2024-0"), (F.col("doc_id") % 3 + 1).cast("string")).alias("month"))
    sinks.write_articles(docs, path)
    sinks.write_articles(docs.where("month = '2024-02'").withColumn("chars", -F.col("chars")), path)
    back = spark.read.parquet(path)
    return back.groupBy("month", "domain").agg(F.count("*").alias("n"), F.sum("chars").alias("chars"))


def _skips(spark, sf_dir):
    events = table(spark, sf_dir, "events").where("event_type = 'error'")
    return events.select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), F.concat(F.lit("raw/"), F.col("event_id"), F.lit(".html")).alias("file_path"), F.concat(F.lit("site"), F.col("user_id") % 5).alias("domain"),
        F.lit("html_too_small").alias("skip_type"), F.concat(F.lit("HTML file too small ("), F.length("props"), F.lit(" chars)")).alias("reason"), F.create_map(F.lit("size"), F.length("props").cast("string")).alias("details"),
    )


def io_skip_log(spark, sf_dir):
    """Rejected items written as JSON lines by month and read back."""
    path = scratch_dir(spark)
    sinks.write_skips(_skips(spark, sf_dir), path)
    return files.skip_log(spark, path).select("timestamp", "file_path", "domain", "skip_type", "reason", F.col("details")["size"].alias("size"))


def io_skip_lines(spark, sf_dir):
    """The same for people."""
    return sinks.readable_skips(_skips(spark, sf_dir))


def io_ledger(spark, sf_dir):
    """A ledger of January's first half, updated with the second half, written and read back."""
    from .status_queries import _ledger

    path = scratch_dir(spark)
    rows = _ledger(spark, sf_dir).withColumns({"error": F.lit(None).cast("string"), "attrs": F.lit(None).cast("map<string,string>"), "status": F.concat_ws(" ", "status", "event_id")}).drop("event_id")
    sinks.write_ledger(sinks.update_ledger(rows.where("ts < '2024-01-16'"), rows.where("ts >= '2024-01-16'")), path)
    return files.ledger(spark, path).select("stage", "key", "status", "reason", "ts")


def io_merged(spark, sf_dir):
    """Metadata of documents with the analysis of every third one laid over it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("language"), F.lit("old").alias("summary"), "source")
    new = table(spark, sf_dir, "documents").where("doc_id % 3 = 0").select("doc_id", F.concat(F.lit("new "), F.col("n_chars")).alias("summary"), (F.col("n_chars") / 10).alias("score"))
    return sinks.merged(docs, new, "doc_id")


def io_with_markdown(spark, sf_dir):
    """Metadata of those articles whose text is there."""
    docs = table(spark, sf_dir, "documents")
    return files.with_markdown(docs.select("doc_id", "source"), docs.where("text <> '' and doc_id % 4 <> 1").select("doc_id", F.length("text").alias("chars")), "doc_id")


def io_archive(spark, sf_dir):
    """Months of articles: those before 2024-03 archived, with what stays where."""
    path, archive = scratch_dir(spark), scratch_dir(spark)
    io = table(spark, sf_dir, "events").select("event_id", "user_id", F.date_format(F.add_months("ts", (F.col("event_id") % 4).cast("int")), "yyyy-MM").alias("month"))
    io.write.partitionBy("month").parquet(path)
    done = [sinks.archive_month(spark, path, archive, month) for month in ("2024-01", "2024-02")]
    told = spark.createDataFrame([(d["month"], d["status"], d.get("rows")) for d in done], "month string, status string, told long")
    places = [spark.read.parquet(p).select(F.lit(where).alias("place"), "month", "user_id") for where, p in (("archive", archive), ("content", path))]
    kept = places[0].unionByName(places[1]).groupBy("place", F.col("month").cast("string").alias("month")).agg(F.count("*").alias("n"), F.sum("user_id").alias("users"))
    return kept.join(told, "month", "left")


def io_summary(spark, sf_dir):
    """The summary line of a run, as the log has it."""
    from ..operators.runs import counters
    from .status_queries import _ledger

    path = scratch_dir(spark)
    counts = counters(_ledger(spark, sf_dir))
    sinks.write_summary(counts, path, "fetch", _now(), 1.5)
    sinks.write_summary(counts, path, "again", _now(), 0.25)
    return spark.read.text(path)


def io_feed_items(spark, sf_dir):
    """Titles, links and dates of the items in the sites' feeds, read from the XML."""
    from .status_queries import feed_documents

    item = F.explode(F.regexp_extract_all("xml", F.lit(r"(?s)<item>(.*?)</item>"), F.lit(1))).alias("item")
    tag = lambda name: F.regexp_extract("item", rf"<{name}>([^<]*)</{name}>", 1)
    rows = feed_documents(spark, sf_dir).select("site", "article_count", item)
    return rows.select("site", "article_count", tag("importance").cast("double").alias("importance"), tag("pubDate").alias("date"), tag("sentiment").alias("sentiment"))


QUERIES = {f.__name__: f for f in (io_sites, io_link_log, io_pages, io_articles, io_skip_log, io_skip_lines, io_ledger, io_merged, io_with_markdown, io_archive, io_summary, io_feed_items)}

_SKIPS = """sk AS (SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S') AS timestamp, 'raw/' || event_id || '.html' AS file_path, 'site' || (user_id % 5) AS domain, 'html_too_small' AS skip_type,
    'HTML file too small (' || length(props) || ' chars)' AS reason, length(props)::VARCHAR AS size FROM events WHERE event_type = 'error')"""


def _sql() -> dict[str, str]:
    from .status_queries import _LEDGER

    return {
        "io_sites": """SELECT 'https://' || lower(replace(s_name, '#', '')) || '.com' AS link, CASE WHEN s_suppkey % 3 <> 0 THEN n_name ELSE '' END AS city, 'X' AS country
            FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 7 <> 0""",
        "io_link_log": f"""WITH {LINKS_SQL}, t AS (SELECT DISTINCT page_id % 2 AS turn, domain, path FROM links)
            SELECT '2024-03' AS month, domain, '2024-03-15: 10:20' AS seen_at, count(*) AS n, count(DISTINCT path) AS paths FROM t GROUP BY domain""",
        "io_pages": f"""WITH {LINKS_SQL}, n AS (SELECT domain, url, page_id, {_NAME} AS file_name FROM links),
            r AS (SELECT *, row_number() OVER (PARTITION BY domain, file_name ORDER BY page_id DESC, url DESC) AS k FROM n WHERE file_name IS NOT NULL) SELECT domain, file_name, page_id FROM r WHERE k = 1""",
        "io_articles": """SELECT '2024-0' || (doc_id % 3 + 1) AS month, coalesce(source, 'none') AS domain, count(*) AS n, sum(CASE WHEN doc_id % 3 = 1 THEN -length(text) ELSE length(text) END)::BIGINT AS chars FROM documents GROUP BY 1, 2""",
        "io_skip_log": f"WITH {_SKIPS} SELECT * FROM sk",
        "io_skip_lines": f"""WITH {_SKIPS} SELECT '[' || replace(timestamp, 'T', ' ') || '] HTML_TOO_SMALL: ' || file_path || chr(10) || '  Domain: ' || domain || chr(10) || '  Reason: ' || reason || chr(10) || '  size: ' || size || chr(10) AS value FROM sk""",
        "io_ledger": f"""WITH {_LEDGER}, s AS (SELECT stage, key, status || ' ' || event_id AS status, reason, ts FROM led),
            r AS (SELECT *, row_number() OVER (PARTITION BY stage, key ORDER BY ts DESC, status DESC) AS n FROM s) SELECT stage, key, status, reason, ts FROM r WHERE n = 1""",
        "io_merged": "SELECT doc_id, lang AS language, CASE WHEN doc_id % 3 = 0 THEN 'new ' || n_chars ELSE 'old' END AS summary, source, CASE WHEN doc_id % 3 = 0 THEN n_chars::DOUBLE / 10 END AS score FROM documents",
        "io_with_markdown": "SELECT doc_id, source, length(text)::INT AS chars FROM documents WHERE text <> '' AND doc_id % 4 <> 1",
        "io_archive": """WITH m AS (SELECT user_id, strftime(ts + to_months((event_id % 4)::INT), '%Y-%m') AS month FROM events),
            n AS (SELECT month, count(*) AS n, sum(user_id)::BIGINT AS users FROM m GROUP BY month)
            SELECT month, CASE WHEN month < '2024-03' THEN 'archive' ELSE 'content' END AS place, n, users, CASE WHEN month < '2024-03' THEN 'archived' END AS status, CASE WHEN month < '2024-03' THEN n END AS told FROM n""",
        "io_summary": f"""WITH {_LEDGER}, c AS (SELECT 'total: ' || count(*) || ' | success: ' || count(*) FILTER (WHERE status = 'success') || ' | error: ' || count(*) FILTER (WHERE status = 'error') || ' | skipped: ' || count(*) FILTER (WHERE status = 'skipped')
            || ' | filtered: ' || count(*) FILTER (WHERE status = 'filtered') AS counts FROM led), t AS (SELECT 'fetch' AS stage, '1.50s' AS took UNION ALL SELECT 'again', '0.25s')
            SELECT '2024-03-15 10:20:00 | ' || stage || ' | ' || counts || ' | time: ' || took AS value FROM c, t""",
        "io_feed_items": f"""WITH {text_queries._ARTICLES}, r AS (SELECT source AS site, importance_score, extracted_at, {text_queries._SENTIMENT} AS sentiment, row_number() OVER (PARTITION BY source ORDER BY importance_score, extracted_at DESC, doc_id) AS rank
            FROM g WHERE long_enough AND importance_score >= 0.4)
            SELECT site, count(*) OVER (PARTITION BY site)::INT AS article_count, importance_score AS importance, strftime(strptime(extracted_at, '%Y-%m-%dT%H:%M:%S'), '%a, %d %b %Y %H:%M:%S ') AS date, sentiment FROM r WHERE rank <= 10""",
    }


SQL = _sql()