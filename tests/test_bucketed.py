"""A ledger in buckets: plans without exchanges of it, merging levels, and what breaks off half-way."""

import pytest
from pyspark.sql import functions as F

from pressmill.scratch import scratch_dir
from pressmill.streaming.bucketed import BucketedLedger


def outcomes(spark, rows):
    """rows: key, status, day."""
    table = spark.createDataFrame(rows, "key string, status string, day int")
    empty = {c: F.lit(None).cast("string") for c in ("reason", "error")}
    return table.select(F.lit("s").alias("stage"), "key", "status", *(v.alias(c) for c, v in empty.items()), F.timestamp_seconds(F.col("day") * 86400).alias("ts"), F.lit(None).cast("map<string,string>").alias("attrs"))


@pytest.fixture
def ledger(spark):
    return BucketedLedger(spark, scratch_dir(spark), buckets=4)


def last(ledger):
    return sorted((r["key"], r["status"]) for r in ledger.read().collect())


def test_no_exchange_of_the_ledger(spark, ledger):
    ledger.update(outcomes(spark, [(f"k{i}", "success" if i % 3 else "error", 1) for i in range(200)]))
    ledger.update(outcomes(spark, [(f"k{i}", "success", 2) for i in range(0, 30, 3)]))
    assert len(ledger.levels()) == 2
    todo = ledger.not_done(spark.range(300).select(F.concat(F.lit("k"), "id").alias("key")))
    plan = todo._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastExchange" not in plan and plan.count("Bucketed: true") == 2
    assert {r["key"] for r in todo.collect()} == {f"k{i}" for i in range(300) if i >= 200 or i % 3 == 0 and i >= 30}
    read = ledger.read()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in read and read.count("Bucketed: true") == 2


def test_levels_merge_as_they_grow(spark, ledger):
    sizes, want = [], {}
    for turn in range(9):
        rows = [(f"k{(turn * 7 + i) % 50}", f"turn {turn}", turn) for i in range(10)]
        ledger.update(outcomes(spark, [*rows, rows[0]]))
        want.update({k: s for k, s, _ in rows})
        sizes.append([n for _, n in ledger._listed()[1]])
        assert last(ledger) == sorted(want.items())
    assert max(map(len, sizes)) <= 3 and all(a > b * 0.5 for levels in sizes for a, b in zip(levels, levels[1:]))


def test_another_session_and_broken_updates(spark, ledger):
    assert last(ledger) == [] and ledger.not_done(spark.createDataFrame([("a",)], "key string")).count() == 1
    ledger.update(outcomes(spark, []))
    ledger.update(outcomes(spark, [("a", "success", 1), ("a", "error", 0), (None, "error", 1)]))
    # a level that no list names does not count
    ledger._write(outcomes(spark, [("b", "success", 5)]))
    for name in [t.name for t in spark.catalog.listTables() if t.name.startswith("ledger_")]:
        spark.sql(f"DROP TABLE {name}")
    again = BucketedLedger(spark, ledger.path, buckets=4)
    assert sorted((r["key"] or "", r["status"]) for r in again.read().collect()) == [("", "error"), ("a", "success")]
    assert again.vacuum() == 2  # the unlisted one and that of the empty run
    assert {r["key"] for r in again.not_done(spark.createDataFrame([("a",), ("b",), (None,)], "key string")).collect()} == {"b", None}
