"""Tables on the way: in the folder that the driver and all executors share."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """A new path in the folder all executors share, spark.checkpoint.dir; only a local session may leave that unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{_own_folder(base, spark)}/{uuid.uuid4().hex}"


def _own_folder(base: str, spark: SparkSession) -> str:
    return f"{base.rstrip('/')}/pressmill-{spark.conf.get('spark.app.id', 'app')}"


def drop_stored(spark: SparkSession) -> None:
    """Removes all tables that this application has stored; call it when the results are written, which may read them."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        folder = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(base, spark))
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stored(df: DataFrame, *partition_by: str) -> DataFrame:
    """The rows as a table in the shared folder: cuts lineage and survives lost executors."""
    spark, path = df.sparkSession, scratch_dir(df.sparkSession)
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
