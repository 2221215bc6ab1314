"""Queries over events as the pipeline's ledger and logs: success, reasons, errors, retention, sizes, feeds as documents."""

from pyspark.sql import functions as F

from ..functions import text
from ..operators import articles, ledger, monitor, retention
from ..sources import sinks
from . import text_queries
from .tables import table

NOW = "2024-03-15 00:00:00"
#: What each type of event stands for in a ledger.
STATUS = {"view": "success", "click": "success", "error": "error", "signup": "skipped", "purchase": "success"}


def _ledger(spark, sf_dir):
    status = F.lit(None).cast("string")
    for kind, name in STATUS.items():
        status = F.when(F.col("event_type") == kind, name).otherwise(status)
    stage = F.element_at(F.array(F.lit("fetch"), F.lit("extract"), F.lit("analyze")), (F.col("user_id") % 3 + 1).cast("int"))
    reason = F.when((F.col("event_type") == "signup") | (F.col("event_id") % 2 == 0), F.concat(F.lit("reason "), (F.col("event_id") % 4).cast("string")))
    return table(spark, sf_dir, "events").select(stage.alias("stage"), F.concat_ws("-", "user_id", F.col("event_id") % 97).alias("key"), status.alias("status"), reason.alias("reason"), "ts", "event_id")


def _logs(spark, sf_dir):
    errors = table(spark, sf_dir, "events").where("event_type = 'error'")
    return errors.select(F.concat(F.lit("component"), (F.col("user_id") % 7).cast("string")).alias("component"), F.when(F.col("event_id") % 5 == 0, F.lit(" ")).otherwise(F.col("props")).alias("line"))


def _thresholds(spark):
    return spark.createDataFrame([(f"component{i}", 20 * i) for i in range(7)], "component string, threshold int")


def status_success_rate(spark, sf_dir):
    return ledger.success_rate(_ledger(spark, sf_dir), "stage")


def status_reasons(spark, sf_dir):
    return ledger.reasons(_ledger(spark, sf_dir))


def status_latest(spark, sf_dir):
    """The ledger with one row per stage and key."""
    rows = _ledger(spark, sf_dir).withColumn("status", F.concat_ws(" ", "status", "event_id")).drop("event_id")
    return ledger.latest(rows)


def items_to_do(spark, sf_dir):
    """Items of the second half of the month that no success of the first half covers."""
    rows = _ledger(spark, sf_dir)
    work = rows.where("ts >= '2024-01-16'").select("key").distinct()
    return ledger.not_done(work, rows.where("ts < '2024-01-16'"))


def successes_by_stage(spark, sf_dir):
    """Items up to the fifth success of each stage, in order of time."""
    return ledger.limit_successes(_ledger(spark, sf_dir), 5, "event_id", "stage").select("stage", "event_id", "status")


def error_counts(spark, sf_dir):
    return ledger.error_counts(_logs(spark, sf_dir))


def error_alerts(spark, sf_dir):
    return ledger.error_alerts(ledger.error_counts(_logs(spark, sf_dir)), _thresholds(spark))


def monitor_alerts(spark, sf_dir):
    return monitor.alerts(_ledger(spark, sf_dir), _logs(spark, sf_dir), _thresholds(spark))


def _files(spark, sf_dir):
    return table(spark, sf_dir, "events").select(F.date_format(F.date_sub(F.col("ts").cast("date"), (F.col("event_id") % 8 * 30).cast("int")), "yyyy-MM").alias("month"), F.length("props").alias("length"))


def retention_months(spark, sf_dir):
    """Months old enough to archive on a fixed day that are not archived yet (June is)."""
    done = spark.createDataFrame([("content:2023-06", "archived"), ("content:2023-07", "error")], "key string, status string")
    return retention.to_archive(_files(spark, sf_dir).select("month").distinct(), done, F.lit(NOW).cast("timestamp")).select("month")


def month_sizes(spark, sf_dir):
    sized = retention.sizes(_files(spark, sf_dir), "month")
    return sized.withColumn("readable", text.readable_bytes(F.col("bytes")))


def feed_documents(spark, sf_dir):
    """Each site's feed as RSS."""
    rows = articles.feed_rows(text_queries._scored(spark, sf_dir), "site", "doc_id").withColumn("date", F.col("extracted_at"))
    return sinks.feeds(rows, "site", F.lit(NOW).cast("timestamp"))


def category_documents(spark, sf_dir):
    rows = articles.feed_rows(articles.by_category(text_queries._scored(spark, sf_dir)), "category", "doc_id").withColumn("date", F.col("extracted_at"))
    return sinks.feeds(rows, "category", F.lit(NOW).cast("timestamp"), by_category=True)


def pub_dates(spark, sf_dir):
    """Dates of events in four forms and one that is none, as feeds show them."""
    forms = F.array(*(F.date_format("ts", f) for f in ("yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")), F.lit("yesterday"))
    rows = table(spark, sf_dir, "events").select("event_id", F.get(forms, (F.col("event_id") % 5).cast("int")).alias("date"))
    return rows.select("event_id", text.rss_date(F.col("date"), F.lit(NOW).cast("timestamp")).alias("pub_date"))


QUERIES = {
    f.__name__: f
    for f in (
        status_success_rate, status_reasons, status_latest, items_to_do, successes_by_stage, error_counts, error_alerts, monitor_alerts, retention_months, month_sizes, feed_documents, category_documents, pub_dates,
    )
}

_LEDGER = f"""led AS (SELECT ['fetch', 'extract', 'analyze'][(user_id % 3 + 1)::INT] AS stage, user_id || '-' || event_id % 97 AS key,
    CASE event_type {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STATUS.items())} END AS status,
    CASE WHEN event_type = 'signup' OR event_id % 2 = 0 THEN 'reason ' || (event_id % 4) END AS reason, ts, event_id FROM events)"""
_LOGS = "logs AS (SELECT 'component' || (user_id % 7) AS component, CASE WHEN event_id % 5 = 0 THEN ' ' ELSE props END AS line FROM events WHERE event_type = 'error'), counts AS (SELECT component, count(*) FILTER (WHERE regexp_matches(line, '\\S')) AS errors FROM logs GROUP BY component)"
_FILES = "files AS (SELECT strftime(ts::DATE - (event_id % 8 * 30)::INT, '%Y-%m') AS month, length(props) AS length FROM events)"
_RATES = "rates AS (SELECT stage, count(*) FILTER (WHERE status = 'success') AS success, count(*) FILTER (WHERE status = 'error') AS error FROM led GROUP BY stage), full_rates AS (SELECT *, success + error AS total, CASE WHEN success + error = 0 THEN 0.0::DOUBLE ELSE success::DOUBLE / (success + error) * 100 END AS rate FROM rates)"
SQL = {
    "status_success_rate": f"WITH {_LEDGER}, {_RATES} SELECT *, rate < 80 AND total > 10 AS alert FROM full_rates",
    "status_reasons": f"WITH {_LEDGER} SELECT status || ':' || coalesce(reason, 'unknown') AS reason, count(*) AS n FROM led WHERE status IN ('skipped', 'error') GROUP BY 1",
    "status_latest": f"WITH {_LEDGER}, s AS (SELECT stage, key, status || ' ' || event_id AS status, reason, ts FROM led), r AS (SELECT *, row_number() OVER (PARTITION BY stage, key ORDER BY ts DESC, status DESC) AS n FROM s) SELECT stage, key, status, reason, ts FROM r WHERE n = 1",
    "items_to_do": f"WITH {_LEDGER} SELECT DISTINCT key FROM led a WHERE ts >= '2024-01-16' AND NOT EXISTS (SELECT 1 FROM led b WHERE b.key = a.key AND b.status = 'success' AND b.ts < '2024-01-16')",
    "successes_by_stage": f"WITH {_LEDGER}, c AS (SELECT stage, event_id, status, coalesce(sum((status = 'success')::INT) OVER (PARTITION BY stage ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM led) SELECT stage, event_id, status FROM c WHERE before < 5",
    "error_counts": f"WITH {_LOGS} SELECT * FROM counts",
    "error_alerts": f"WITH {_LOGS} SELECT component, errors, (20 * substr(component, 10)::INT)::INT AS threshold FROM counts WHERE errors >= 20 * substr(component, 10)::INT",
    "monitor_alerts": f"WITH {_LEDGER}, {_RATES}, {_LOGS} SELECT printf('ALERT: %s success rate is %.1f%%', stage, rate) AS alert FROM full_rates WHERE rate < 80 AND total > 10 UNION ALL SELECT 'ALERT: ' || component || ' has ' || errors || ' recent errors' FROM counts WHERE errors >= 20 * substr(component, 10)::INT",
    "retention_months": f"WITH {_FILES} SELECT DISTINCT month FROM files WHERE strptime(month, '%Y-%m') <= TIMESTAMP '{NOW}' - INTERVAL 60 DAY AND month <> '2023-06'",
    "month_sizes": f"WITH {_FILES}, s AS (SELECT month, count(*) AS files, sum(length)::BIGINT AS bytes FROM files GROUP BY month) SELECT *, CASE WHEN bytes < 1024 THEN printf('%.1f B', bytes::DOUBLE) WHEN bytes < 1048576 THEN printf('%.1f KB', bytes / 1024.0::DOUBLE) ELSE printf('%.1f MB', bytes / 1048576.0::DOUBLE) END AS readable FROM s",
    "pub_dates": f"SELECT event_id, strftime(CASE event_id % 5 WHEN 3 THEN date_trunc('day', ts) WHEN 4 THEN TIMESTAMP '{NOW}' ELSE ts END, '%a, %d %b %Y %H:%M:%S ') AS pub_date FROM events",
}
