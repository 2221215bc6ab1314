"""The tables of a folder, and the columns that queries derive from them in one way."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_out(rows: DataFrame) -> DataFrame:
    """A table of fewer partitions than there are cores, dealt to all of them, where work per row is what costs; larger ones as they are."""
    wanted = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(wanted) if rows.rdd.getNumPartitions() < wanted else rows


def page_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", "url")


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, domain, path, url: every distinct same-host link of every page."""
    pages = table(spark, sf_dir, "pages")
    found = pages.select("page_id", urls.part(F.col("url"), "netloc").alias("domain"), F.explode(urls.page_links(F.col("html"), F.col("url"))).alias("path"))
    return found.withColumn("url", F.concat(F.lit("https://"), F.col("domain"), F.col("path")))


#: The same in SQL, for pages whose links all start with a slash.
LINKS_SQL = r"""
l0 AS (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS domain,
          unnest(regexp_extract_all(html, '(?i)<a [^>]*href=["''](/[^"''\n]*)["'']', 1)) AS path FROM pages),
links AS (SELECT DISTINCT page_id, domain, regexp_replace(path, '[?#]$', '') AS path, 'https://' || domain || regexp_replace(path, '[?#]$', '') AS url FROM l0)
"""


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"
