"""What several operators of this subpackage share: scratch tables and column clean-up."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..scratch import drop_stored, scratch_dir, stored

__all__ = ["LOWER", "NULL_ID", "SPACES", "UPPER", "ascii_lower", "drop_stored", "running_sums", "scratch_dir", "shuffle_partitions", "stored"]

#: Stands for a null doc_id inside an operator: such rows sort before every real document.
NULL_ID = -(2**63)
#: ASCII white space, as the contracts name it.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(col):
    """A-Z to a-z and nothing else; lower() does just that where all is ASCII, and much faster."""
    return F.when(F.octet_length(col) == F.char_length(col), F.lower(col)).otherwise(F.translate(col, UPPER, LOWER))


def running_sums(rows: DataFrame, order: list[Column], **sums: Column) -> DataFrame:
    """rows with, by name, the sum of a column over all rows before this one (null or 0 at the first); no two rows may tie.

    Rows are dealt in ranges of the order; each range sums its own, and one row per range says where it starts.
    """
    ranges = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *order)
    dealt = stored(ranges.withColumns({f"_{name}": value for name, value in sums.items()} | {"_range": F.spark_partition_id()}))
    earlier, before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("_range").agg(*(F.sum(f"_{name}").alias(f"_{name}") for name in sums))
    starts = starts.select(F.col("_range").alias("_at"), *(F.coalesce(F.sum(f"_{name}").over(earlier), F.lit(0)).alias(f"_from_{name}") for name in sums))
    joined = dealt.join(starts, F.col("_range") == F.col("_at"))
    return joined.select(*rows.columns, *((F.col(f"_from_{name}") + F.coalesce(F.sum(f"_{name}").over(before), F.lit(0))).alias(name) for name in sums))
