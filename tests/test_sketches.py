"""Monthly sketches: error bounds, merging without old rows, and replaced months."""

import pytest
from pyspark.sql import functions as F

from pressmill.operators import sketches
from pressmill.scratch import scratch_dir


@pytest.fixture(scope="module")
def rows(spark):
    ids = spark.range(60_000)
    return ids.select(
        F.concat(F.lit("2024-0"), (F.col("id") % 3 + 1).cast("string")).alias("month"), F.concat(F.lit("site"), (F.col("id") % 4).cast("string")).alias("domain"), F.concat(F.lit("/p/"), (F.col("id") * 7919 % 9000).cast("string")).alias("path")
    ).cache()


def test_distinct_values_over_months(spark, rows):
    path = scratch_dir(spark)
    for month in ("2024-01", "2024-02", "2024-03"):
        sketches.add_months(sketches.monthly(rows.where(F.col("month") == month), "domain", "path"), path)
    exact = {r[0]: (r[1], r[2]) for r in rows.groupBy("domain").agg(F.count("*"), F.countDistinct("path")).collect()}
    for r in sketches.distinct_values(sketches.stored_months(spark, path), "domain").collect():
        assert r["rows"] == exact[r["domain"]][0] and abs(r["n"] - exact[r["domain"]][1]) <= 0.03 * exact[r["domain"]][1]
    # old months are read as sketches only, and one month as one folder
    one = sketches.stored_months(spark, path, "2024-02", "2024-02")
    assert len(one.inputFiles()) >= 1 and {r[0] for r in one.select("month").distinct().collect()} == {"2024-02"}
    plan = sketches.distinct_values(one, "domain")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "path#" not in plan
    # a month written again replaces itself and nothing else
    again = spark.createDataFrame([("2024-02", "site0", "/only")], rows.schema)
    sketches.add_months(sketches.monthly(again, "domain", "path"), path)
    assert [(r["rows"], r["n"]) for r in sketches.distinct_values(sketches.stored_months(spark, path, "2024-02", "2024-02"), "domain").collect()] == [(1, 1)]
    assert sketches.stored_months(spark, path).select("month").distinct().count() == 3


def test_most_frequent(spark):
    data = [("2024-01", "a", v) for v in ["x"] * 5 + ["y"] * 3 + ["z"]] + [("2024-02", "a", v) for v in ["y"] * 4 + ["z"] * 3] + [("2024-02", "b", "q"), ("2024-02", "b", None), ("2024-02", "c", None)]
    table = spark.createDataFrame(data, "month string, domain string, path string")
    made = sketches.monthly(table, "domain", "path", tracked=100)
    got = [tuple(r) for r in sketches.most_frequent(made, "domain", 2, tracked=100).orderBy("domain", "rank").collect() if r["value"] is not None]
    assert got == [("a", 1, "y", 7), ("a", 2, "x", 5), ("b", 1, "q", 1)]
    n = {r["domain"]: (r["rows"], r["n"]) for r in sketches.distinct_values(made, "domain").collect()}
    assert n == {"a": (16, 3), "b": (1, 1), "c": (0, 0)}
    assert sketches.monthly(table.limit(0), "domain", "path").count() == 0


def test_more_values_than_a_summary_tracks(spark, tmp_path):
    from pressmill.plans.run_queries import QUERIES, SQL

    from .oracle import agree

    rows = spark.range(90_000).union(spark.range(0, 90_000, 7)).union(spark.range(0, 90_000, 77)).select(F.col("id").alias("user_id"), F.lit("view").alias("event_type"), F.timestamp_seconds(F.col("id") * 20 + 1_704_067_200).alias("ts"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/made")
    next(tmp_path.glob("made/*.parquet")).rename(tmp_path / "events.parquet")
    agree(spark, str(tmp_path), QUERIES["sketch_frequent"], SQL["sketch_frequent"])
