"""What is old enough to archive or drop. `now` is a parameter everywhere, so that runs can be repeated."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ledger import not_done

CONTENT_DAYS, CACHE_DAYS, LOG_DAYS, LEDGER_DAYS = 60, 7, 365, 30


def _before(now: Column, days: int) -> Column:
    return now - F.make_dt_interval(F.lit(days))


def old_months(months: DataFrame, now: Column, days: int = CONTENT_DAYS) -> DataFrame:
    """Rows whose month (yyyy-MM) began at or before the cut-off; names that are no months are left alone."""
    return months.where(F.try_to_timestamp("month", F.lit("yyyy-MM")) <= _before(now, days))


def to_archive(months: DataFrame, ledger: DataFrame, now: Column, days: int = CONTENT_DAYS) -> DataFrame:
    """Old months that no run has archived."""
    keyed = old_months(months, now, days).withColumn("key", F.concat(F.lit("content:"), F.col("month")))
    return not_done(keyed, ledger, done="archived")


def stale_cache(files: DataFrame, now: Column, days: int = CACHE_DAYS) -> DataFrame:
    """Cached pages (modified_at) older than the cut-off."""
    return files.where(F.col("modified_at") < _before(now, days))


def kept_ledger(ledger: DataFrame, now: Column, days: int = LEDGER_DAYS) -> DataFrame:
    """Ledger rows from the cut-off on; those without a time stay."""
    return ledger.where(F.col("ts").isNull() | (F.col("ts") >= _before(now, days)))


def sizes(files: DataFrame, *by: str) -> DataFrame:
    """Files and bytes by group; files: length and what it is grouped by."""
    return files.groupBy(*by).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
