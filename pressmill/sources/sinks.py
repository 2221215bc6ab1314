"""Writers: link logs, pages, article tables, ledgers, logs, feeds and archives."""

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..operators.ledger import latest
from .files import LEDGER_TIME

FEED_ITEM = ("title", "url", "summary", "content_length", "date", "author", "categories", "importance_score", "sentiment")


def append_links(new: DataFrame, path: str, now: Column) -> None:
    """New links (month, domain, path) with one time for all, as CSV by month and domain."""
    rows = new.select(F.date_format(now, "yyyy-MM-dd: HH:mm").alias("seen_at"), "path", "month", "domain")
    rows.write.mode("append").partitionBy("month", "domain").csv(path)


def write_pages(pages: DataFrame, path: str) -> None:
    """Pages by month and domain; of those with one file name the last fetched stays."""
    last = Window.partitionBy("month", "domain", "file_name").orderBy(F.desc("fetched_at"), F.desc("url"))
    kept = pages.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")
    kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month", "domain").parquet(path)


def write_articles(articles: DataFrame, path: str) -> None:
    """Markdown, metadata and, if there, cleaned HTML as one table by month and domain."""
    articles.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month", "domain").parquet(path)


def merged(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Old records with the columns of new ones over them where the key has one."""
    fresh = new.select(key, F.struct(*(c for c in new.columns if c != key)).alias("_new"))
    has = F.col("_new").isNotNull()
    both = old.join(fresh, key, "left")
    names = [c for c in old.columns if c != key] + [c for c in new.columns if c not in old.columns]
    value = lambda c: F.when(has, F.col("_new").getField(c)).otherwise(old[c] if c in old.columns else None) if c in new.columns else old[c]
    return both.select(key, *(value(c).alias(c) for c in names))


def update_ledger(old: DataFrame, run: DataFrame) -> DataFrame:
    """The ledger after a run: the last row of each stage and key. Write it to a new place and switch, as it reads the old one."""
    return latest(old.unionByName(run, allowMissingColumns=True))


def write_ledger(ledger: DataFrame, path: str) -> None:
    """A ledger as JSON lines, times to the microsecond, as files.ledger reads it."""
    ledger.withColumn("ts", F.col("ts").cast("timestamp")).write.mode("overwrite").option("timestampFormat", LEDGER_TIME).json(path)


def write_skips(skipped: DataFrame, path: str) -> None:
    """Rejected rows as JSON lines by month."""
    skipped.withColumn("month", F.substring("timestamp", 1, 7)).write.mode("append").partitionBy("month").json(path)


def readable_skips(skipped: DataFrame) -> DataFrame:
    """The same as lines for people."""
    details = F.array_join(F.transform(F.map_entries("details"), lambda e: F.concat(F.lit("  "), e["key"], F.lit(": "), e["value"], F.lit("\n"))), "")
    head = F.concat(F.lit("["), F.translate(F.substring("timestamp", 1, 19), "T", " "), F.lit("] "), F.upper("skip_type"), F.lit(": "), F.col("file_path"))
    return skipped.select(F.concat(head, F.lit("\n  Domain: "), F.col("domain"), F.lit("\n  Reason: "), F.col("reason"), F.lit("\n"), F.coalesce(details, F.lit(""))).alias("value"))


def summary_line(counters: dict[str, int], stage: str, run_at: str, elapsed: float) -> str:
    return " | ".join([run_at, stage, *(f"{k}: {v}" for k, v in counters.items()), f"time: {elapsed:.2f}s"])


def write_summary(counts: DataFrame, path: str, stage: str, run_at: Column, seconds: float) -> None:
    """Appends the counters of a run (one row) to the summary log, as a line of the form of summary_line."""
    parts = [F.date_format(run_at, "yyyy-MM-dd HH:mm:ss"), F.lit(stage), *(F.concat(F.lit(f"{c}: "), F.col(c).cast("string")) for c in counts.columns), F.lit(f"time: {seconds:.2f}s")]
    counts.select(F.concat_ws(" | ", *parts).alias("value")).coalesce(1).write.mode("append").text(path)


def _item(row: dict, date: str) -> str:
    from xml.sax.saxutils import escape

    tag = lambda name, value: f"      <{name}>{escape(str(value))}</{name}>\n" if value not in (None, "") else f"      <{name}/>\n"
    about = row["summary"] or (f"Article with {row['content_length']} words" if row["content_length"] is not None else "")
    out = tag("title", "Untitled" if row["title"] is None else row["title"]) + tag("link", row["url"]) + tag("guid", row["url"]) + tag("description", about) + tag("pubDate", date)
    out += tag("dc:creator", row["author"]) if row["author"] else ""
    out += "".join(tag("category", c) for c in row["categories"] or [])
    out += tag("importance", row["importance_score"]) if row["importance_score"] is not None else ""
    out += tag("sentiment", row["sentiment"]) if row["sentiment"] is not None else ""
    return f"    <item>\n{out}    </item>\n"


def feed_xml(title: str, link: str, about: str, items: list[dict], dates: list[str], built: str) -> str:
    """An RSS 2.0 document; items carry FEED_ITEM."""
    from xml.sax.saxutils import escape, quoteattr

    head = f"    <title>{escape(title)}</title>\n    <link>{escape(link)}</link>\n    <description>{escape(about)}</description>\n    <language>ro</language>\n"
    head += f"    <lastBuildDate>{built}</lastBuildDate>\n    <generator>News Processing Pipeline</generator>\n"
    head += f"    <atom:link href={quoteattr(link + '/rss.xml')} rel=\"self\" type=\"application/rss+xml\"/>\n"
    body = "".join(_item(i, d) for i, d in zip(items, dates))
    return (
        '<?xml version="1.0" encoding="UTF-8"?>\n<rss version="2.0" xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:atom="http://www.w3.org/2005/Atom">\n'
        f"  <channel>\n{head}{body}  </channel>\n</rss>\n"
    )


def feeds(rows: DataFrame, feed: str, now: Column, by_category: bool = False) -> DataFrame:
    """feed, article_count, xml from ranked articles (see articles.feed_rows): at most ten items meet per feed."""
    have = set(rows.columns)
    own = F.struct("rank", *(F.col(c) if c in have else F.lit(None).cast("string" if c != "content_length" else "int").alias(c) for c in FEED_ITEM), text.rss_date(F.col("date") if "date" in have else F.lit(None).cast("string"), now).alias("pub_date"))
    grouped = rows.groupBy(feed).agg(F.array_sort(F.collect_list(own)).alias("items")).withColumn("built", F.concat(F.date_format(now, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" ")))

    @F.pandas_udf("string")
    def render(name: pd.Series, items: pd.Series, built: pd.Series) -> pd.Series:
        made = []
        for n, rows_, b in zip(name, items, built):
            rows_ = [dict(r) for r in rows_]
            for r in rows_:
                r["categories"] = list(r["categories"]) if r["categories"] is not None and not isinstance(r["categories"], str) else None
            if by_category:
                parts = (f"News Category: {n.title()}", "https://news.local", f"Latest news articles in category: {n}")
            else:
                parts = (f"News from {n}", f"https://{n}", f"Latest news articles from {n} (filtered by importance)")
            made.append(feed_xml(*parts, rows_, [r["pub_date"] for r in rows_], b))
        return pd.Series(made)

    return grouped.select(feed, F.size("items").alias("article_count"), render(F.col(feed), F.col("items"), F.col("built")).alias("xml"))


def archive_month(spark, path: str, archive: str, month: str) -> dict:
    """Compacts one month of a table by month to zstd files in the archive, compares counts, and only then drops the month.

    On any failure the partial archive goes and the month stays.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    source, target = f"{path}/month={month}", f"{archive}/month={month}"
    files = hadoop(target).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        rows = spark.read.parquet(source)
        size = files.getContentSummary(hadoop(source)).getLength()
        rows.write.option("compression", "zstd").mode("overwrite").parquet(target)
        n, kept = rows.count(), spark.read.parquet(target).count()
        if n != kept:
            raise ValueError(f"archive of {month} has {kept} of {n} rows")
    except Exception as error:
        files.delete(hadoop(target), True)
        return {"month": month, "status": "error", "error": str(error)[:500]}
    files.delete(hadoop(source), True)
    return {"month": month, "status": "archived", "rows": n, "bytes": size}
