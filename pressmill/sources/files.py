"""Readers of the files that sites, links, pages, metadata, rules and ledgers are kept in. All return tables with fixed columns."""

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rx import strip

SITES = "link string, city string, country string"
LINK_LOG = "seen_at string, path string"
LEDGER = "stage string, key string, status string, reason string, error string, ts timestamp, attrs map<string,string>"
LEDGER_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
SKIP_LOG = "timestamp string, file_path string, domain string, skip_type string, reason string, details map<string,string>"
METADATA = (
    "title string, author string, date string, url string, extracted_at string, source_file string, markdown_file string, content_length int, extraction_method string, cleaned_html_saved boolean, "
    "custom_sections_found boolean, cleaned_html_file string, summary string, sentiment string, content_type string, geographic_scope string, ai_processed_at string, "
    "entities struct<persons:array<string>,locations:array<string>,organizations:array<string>>, categories array<string>, importance_score double, content_type_confidence double, "
    "complexity_score double, language string, word_count int, extraction_confidence double"
)
RULES = "domain string, language string, additional_skip_patterns array<string>, require_article_id boolean, allow_no_id_pages boolean, cleanup_patterns array<string>, document string"


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs
    found = hadoop.Path(path)
    return bool(found.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(found))


def _or_empty(spark: SparkSession, path: str, schema: str, read) -> DataFrame:
    return read() if _exists(spark, path) else spark.createDataFrame([], schema)


def sites(spark: SparkSession, path: str) -> DataFrame:
    """link, city, country of a CSV file with a header; short rows are filled with empty texts, a missing file is empty."""
    rows = _or_empty(spark, path, SITES, lambda: spark.read.schema(SITES).csv(path, header=True, mode="PERMISSIVE", enforceSchema=True))
    return rows.where("link is not null").select(*(strip(F.coalesce(c, F.lit(""))).alias(c) for c in ("link", "city", "country")))


def link_log(spark: SparkSession, path: str) -> DataFrame:
    """seen_at, path, month, domain of logs at {path}/{month}/{domain}.csv; rows of fewer than two fields and summaries are left out."""
    empty = f"{LINK_LOG}, month string, domain string"
    glob = f"{path}/*/*.csv"

    def read():
        rows = spark.read.schema(LINK_LOG).csv(glob, mode="PERMISSIVE").withColumn("_file", F.col("_metadata.file_path"))
        named = rows.withColumns({"month": F.regexp_extract("_file", r"([^/]+)/[^/]+$", 1), "domain": F.regexp_extract("_file", r"([^/]+)\.csv$", 1)})
        return named.where("path is not null and domain not like 'summary%'").drop("_file")

    return _or_empty(spark, glob, empty, read)


def seen_time(seen_at):
    return F.try_to_timestamp(seen_at, F.lit("yyyy-MM-dd: HH:mm"))


def html_files(spark: SparkSession, path: str) -> DataFrame:
    """domain, month, file_name, html of pages below a folder whose name holds `raw`; bytes that are no UTF-8 are dropped."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.html").load(path)
    relative = F.regexp_replace("path", r"^[a-z]+:/+", "/")
    parts = F.split(relative, "/")
    domain = F.get(F.filter(parts, lambda p: F.startswith(p, F.lit("www.")) | (F.contains(p, F.lit(".")) & ~F.endswith(p, F.lit(".html")))), F.lit(0))
    named = files.select(
        "content",
        domain.alias("domain"),
        F.get(F.filter(parts, lambda p: F.regexp_like(p, F.lit(r"^\d{4}-\d{2}$"))), F.lit(0)).alias("month"),
        F.element_at(parts, -1).alias("file_name"),
        F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), "/").alias("folder"),
    ).where("folder like '%raw%' and domain is not null")

    @F.pandas_udf("string")
    def decoded(content):
        return content.map(lambda b: b.decode("utf-8", errors="ignore"))

    return named.select("domain", "month", "file_name", decoded("content").alias("html"))


def metadata(spark: SparkSession, path: str) -> DataFrame:
    """Records of YAML files at {path}/{month}/{domain}/metadata/*.yaml with _month, _domain and _metadata_file; broken ones are left out."""
    import json

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.yaml").load(path)

    @F.pandas_udf("string")
    def as_json(content):
        def one(b):
            try:
                record = yaml.safe_load(b.decode("utf-8"))
            except (yaml.YAMLError, UnicodeDecodeError):
                return None
            return json.dumps(record, default=str) if isinstance(record, dict) else None

        return content.map(one)

    place = F.regexp_extract_all("path", F.lit(r"([^/]+)/([^/]+)/metadata/[^/]+$"), F.lit(0))
    rows = files.where(F.size(place) > 0).select(F.col("path").alias("_metadata_file"), as_json("content").alias("record"))
    found = rows.where("record is not null").withColumns(
        {"r": F.from_json("record", METADATA), "_month": F.regexp_extract("_metadata_file", r"([^/]+)/[^/]+/metadata/[^/]+$", 1), "_domain": F.regexp_extract("_metadata_file", r"([^/]+)/metadata/[^/]+$", 1)}
    )
    return found.select("r.*", "_month", "_domain", "_metadata_file")


def with_markdown(metadata_rows: DataFrame, markdown: DataFrame, key: str) -> DataFrame:
    """Metadata of articles whose text is there too."""
    return metadata_rows.join(markdown, key)


def rule_documents(texts: dict[str, str]) -> dict[str, dict]:
    """Rules by domain from YAML documents by domain; empty and broken ones give no rules."""
    out = {}
    for domain, text in texts.items():
        try:
            found = yaml.safe_load(text)
        except yaml.YAMLError:
            found = None
        out[domain] = found if isinstance(found, dict) else {}
    return out


def rules(spark: SparkSession, path: str) -> DataFrame:
    """One row per rules file {path}/{domain}.yaml, with the filters and cleanup patterns as columns and all of it as YAML."""
    if not _exists(spark, f"{path}/*.yaml"):
        return spark.createDataFrame([], RULES)
    files = spark.read.text(f"{path}/*.yaml", wholetext=True).select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.yaml$", 1).alias("domain"), "value")

    def parsed(batches):
        import pandas as pd

        for batch in batches:
            rows = []
            for domain, text in zip(batch["domain"], batch["value"]):
                found = rule_documents({domain: text})[domain]
                own = found.get("content_filters") or {}
                patterns = [p for group in (found.get("cleanup_patterns") or {}).values() for p in group or []]
                rows.append((domain, found.get("language"), own.get("additional_skip_patterns") or [], bool(own.get("require_article_id")), bool(own.get("allow_no_id_pages")), patterns, text))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in RULES.split(", ")])

    return files.mapInPandas(parsed, RULES)


def ledger(spark: SparkSession, path: str) -> DataFrame:
    return _or_empty(spark, path, LEDGER, lambda: spark.read.schema(LEDGER).option("timestampFormat", LEDGER_TIME).json(path))


def skip_log(spark: SparkSession, path: str) -> DataFrame:
    return _or_empty(spark, path, SKIP_LOG, lambda: spark.read.schema(SKIP_LOG).json(path))


def settings(text: str) -> dict:
    """A monitoring configuration; an unreadable one is empty."""
    try:
        found = yaml.safe_load(text)
    except yaml.YAMLError:
        return {}
    return found if isinstance(found, dict) else {}


