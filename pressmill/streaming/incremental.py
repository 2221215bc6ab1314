"""Stages as streams: what has arrived since the last run, with state in checkpoints and ledgers."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import urls
from ..operators.ledger import latest, not_done
from ..sources.files import LEDGER, _or_empty


def arriving(spark: SparkSession, path: str, schema, files_per_batch: int = 1000) -> DataFrame:
    """New Parquet files below a folder, a bounded number per batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def new_links(pages: DataFrame, lateness: str = "40 days") -> DataFrame:
    """month, domain, path, seen_at of each link the first time it is seen in a month; pages: url, html, seen_at.

    State for a month is dropped once the watermark has passed it.
    """
    found = pages.withWatermark("seen_at", lateness).select(
        F.date_trunc("month", "seen_at").alias("month_start"), urls.part(F.col("url"), "netloc").alias("domain"), F.explode(urls.page_links(F.col("html"), F.col("url"))).alias("path"), "seen_at"
    )
    first = found.dropDuplicatesWithinWatermark(["month_start", "domain", "path"])
    return first.select(F.date_format("month_start", "yyyy-MM").alias("month"), "domain", "path", "seen_at")


def outcomes(ledger: DataFrame, every: str = "1 hour", lateness: str = "2 hours") -> DataFrame:
    """Successes, errors and rate by stage and time window, each window once it is over."""
    good, bad = F.count_if(F.col("status") == "success"), F.count_if(F.col("status") == "error")
    counts = ledger.withWatermark("ts", lateness).groupBy(F.window("ts", every).alias("w"), "stage").agg(good.alias("success"), bad.alias("error"))
    rate = F.coalesce(F.try_divide(F.col("success"), F.col("success") + F.col("error")) * 100, F.lit(0.0))
    return counts.select(F.col("w.start").alias("start"), "stage", "success", "error", rate.alias("rate"))


class LedgerTable:
    """A ledger as a table by stage that is only ever added to; what counts for a key is the row last written.

    A batch writes its own outcomes and nothing else. compact() writes the latest rows to a new table, for use between runs.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _rows(self) -> DataFrame:
        return _or_empty(self.spark, f"{self.path}/stage=*", LEDGER, lambda: self.spark.read.schema(LEDGER).parquet(self.path))

    def read(self, stage: str | None = None) -> DataFrame:
        """The last row of each stage and key; of one stage only its own folder is read."""
        rows = self._rows()
        return latest(rows if stage is None else rows.where(F.col("stage") == stage))

    def not_done(self, work: DataFrame, stage: str) -> DataFrame:
        return not_done(work, self.read(stage))

    def update(self, run: DataFrame) -> None:
        run.write.mode("append").partitionBy("stage").parquet(self.path)

    def compact(self, path: str) -> "LedgerTable":
        smaller = LedgerTable(self.spark, path)
        smaller.update(self.read())
        return smaller


def staged(source: DataFrame, stage: str, work: Callable[[DataFrame], DataFrame], ledger, out: str, checkpoint: str) -> StreamingQuery:
    """Runs `work` on what has arrived and is not done, until all of it is read.

    source: key and whatever work needs. work returns its rows with key, status and reason (and error); successes are written
    to `out`, and every outcome to the ledger, a LedgerTable or a BucketedLedger. Items that failed are tried again when they arrive again;
    a checkpoint alone would not do that, nor spare an item that another run has done.
    """

    def batch(rows: DataFrame, number: int) -> None:
        todo = ledger.not_done(rows, stage)
        done = work(todo).persist()
        try:
            done.where("status = 'success'").write.mode("overwrite").parquet(f"{out}/batch={number}")
            have = {c: F.col(c) if c in done.columns else F.lit(None).cast("string") for c in ("reason", "error")}
            ledger.update(
                done.select(F.lit(stage).alias("stage"), "key", "status", *(v.alias(c) for c, v in have.items()), F.current_timestamp().alias("ts"), F.lit(None).cast("map<string,string>").alias("attrs"))
            )
        finally:
            done.unpersist()

    return source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
