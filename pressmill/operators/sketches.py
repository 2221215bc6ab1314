"""Monthly sketches that merge: how many distinct values each group has had, and which are the most frequent, without a rescan of old months.

A month is worked out once, into one row per group with a HyperLogLog sketch of its values and a top-k summary; longer spans are unions of these
rows. Counts of distinct values err by about 1.04 / sqrt(2 ** lg_k) (one standard deviation); of values, a summary's
counts are exact as long as a group has fewer distinct values than it tracks. The exact counts (ledger, pages.most_common) stay the default elsewhere.

Where values are too many for a summary, a month can be kept as its counts of values instead (`monthly_values`), a row for each value: these add up
over months, exactly, however many values there are.

Edge cases: null values count in neither; a group of nulls only has an estimate of 0 and no values. A month that is written again replaces its
rows and no others. An empty table gives none.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LG_K, TRACKED = 14, 10_000


def monthly(rows: DataFrame, group: str, value: str, month: str = "month", lg_k: int = LG_K, tracked: int = TRACKED) -> DataFrame:
    """month, group, rows, distinct (sketch) and frequent (summary) of a column of texts."""
    shown = rows.select(F.col(month).alias("month"), F.col(group), F.col(value).cast("string").alias("_value"))
    frequent = F.expr(f"approx_top_k_accumulate(_value, {int(tracked)}) FILTER (WHERE _value IS NOT NULL)")
    return shown.groupBy("month", group).agg(F.count("_value").alias("rows"), F.hll_sketch_agg("_value", F.lit(lg_k)).alias("distinct"), frequent.alias("frequent"))


def add_months(sketches: DataFrame, path: str) -> None:
    """Writes the months at hand below a folder, each in place of what the folder has of it."""
    sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)


def stored_months(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """The months of a folder from first to last; others are not read."""
    rows = spark.read.parquet(path)
    month = F.col("month").cast("string")
    return rows.where((month >= first if first else F.lit(True)) & (month <= last if last else F.lit(True)))


def distinct_values(sketches: DataFrame, group: str) -> DataFrame:
    """group, rows, n: the rows, and about how many distinct values they hold, over all months given."""
    return sketches.groupBy(group).agg(F.sum("rows").alias("rows"), F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("n"))


def most_frequent(sketches: DataFrame, group: str, most: int = 10, tracked: int = TRACKED) -> DataFrame:
    """group, rank, value, n: the most frequent values over all months given; ties in order of the value."""
    merged = sketches.groupBy(group).agg(F.expr(f"approx_top_k_combine(frequent, {int(tracked)})").alias("_s"))
    # more than asked for, as equal counts come in no order
    found = merged.select(group, F.inline(F.expr(f"approx_top_k_estimate(_s, {max(most, int(tracked) // 10)})")).alias("value", "n"))
    order = Window.partitionBy(group).orderBy(F.desc("n"), "value")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most).select(group, "rank", "value", "n")


def monthly_values(rows: DataFrame, group: str, value: str, month: str = "month") -> DataFrame:
    """month, group, value, n: how often a group has each value in a month; null values are left out. `add_months` stores these as well."""
    shown = rows.select(F.col(month).alias("month"), F.col(group), F.col(value).cast("string").alias("value")).where("value is not null")
    return shown.groupBy("month", group, "value").agg(F.count("*").alias("n"))


def most_frequent_values(counts: DataFrame, group: str, most: int = 10) -> DataFrame:
    """group, rank, value, n: the most frequent values over all months given, exactly; ties in order of the value."""
    total = counts.groupBy(group, "value").agg(F.sum("n").alias("n"))
    order = Window.partitionBy(group).orderBy(F.desc("n"), "value")
    return total.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most).select(group, "rank", "value", "n")
