"""What has been done already: link logs and status ledgers, as joins and counts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import stored


def new_links(found: DataFrame, log: DataFrame) -> DataFrame:
    """Links that this month's log does not hold; a link is new again next month."""
    return found.join(log.select("month", "domain", "path").distinct(), ["month", "domain", "path"], "left_anti")


def not_done(work: DataFrame, ledger: DataFrame, key: str = "key", done: str = "success") -> DataFrame:
    """Work whose key the ledger does not hold with the done status; failed, skipped and filtered items are tried again."""
    return work.join(ledger.where(F.col("status") == done).select(key).distinct(), key, "left_anti")


def latest(ledger: DataFrame) -> DataFrame:
    """One row per stage and key: the last one written."""
    columns = F.struct(*(c for c in ledger.columns if c not in ("stage", "key")))
    return ledger.groupBy("stage", "key").agg(F.max_by(columns, F.struct("ts", "status")).alias("row")).select("stage", "key", "row.*")


def limit_successes(work: DataFrame, limit: int, order: str, per: str | None = None) -> DataFrame:
    """The first `limit` items that ended well (per domain or in all), with every other item that comes before the last of them."""
    from pyspark.sql import Window

    if per is None:
        # only the last of the wanted successes is looked up, so that not all items meet in one window
        rows = stored(work)
        head = rows.where("status = 'success'").orderBy(order).limit(limit).agg(F.count("*"), F.max(order)).first()
        return rows if head[0] < limit else rows.where(F.col(order) <= F.lit(head[1]))
    before = Window.partitionBy(per).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    counted = work.withColumn("_before", F.coalesce(F.sum((F.col("status") == "success").cast("int")).over(before), F.lit(0)))
    return counted.where(F.col("_before") < limit).drop("_before")


def success_rate(ledger: DataFrame, *by: str) -> DataFrame:
    """success, error, total, rate (percent; 0 of none) and whether it calls for an alert (below 80 with over 10 items)."""
    good, bad = F.count_if(F.col("status") == "success"), F.count_if(F.col("status") == "error")
    out = ledger.groupBy(*by).agg(good.alias("success"), bad.alias("error")).withColumn("total", F.col("success") + F.col("error"))
    rate = F.coalesce(F.try_divide(F.col("success"), F.col("total")) * 100, F.lit(0.0))
    return out.withColumn("rate", rate).withColumn("alert", (rate < 80) & (F.col("total") > 10))


def reasons(ledger: DataFrame) -> DataFrame:
    """Skipped and failed items by `status:reason`."""
    off = ledger.where(F.col("status").isin("skipped", "error"))
    return off.groupBy(F.concat_ws(":", "status", F.coalesce("reason", F.lit("unknown"))).alias("reason")).agg(F.count("*").alias("n"))


def error_counts(log_lines: DataFrame) -> DataFrame:
    """Non-empty error lines by component; log_lines: component, line."""
    return log_lines.groupBy("component").agg(F.count_if(F.regexp_like("line", F.lit(r"\S"))).alias("errors"))


def error_alerts(counts: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Components with at least as many errors as their threshold."""
    return counts.join(thresholds, "component").where("errors >= threshold")
