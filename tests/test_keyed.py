"""State by key: attempts until success, months, forgetting, and timers that free what is forgotten."""

import datetime as dt

from pressmill.scratch import scratch_dir
from pressmill.streaming import incremental, keyed

SCHEMA = "domain string, path string, ts timestamp, status string"


def day(n, month=1, hour=0):
    return dt.datetime(2024, month, n, hour)


def run(spark, arrivals, lateness="40 days", keep_days=30):
    folder, out, checkpoint = (scratch_dir(spark) for _ in range(3))
    for rows in arrivals:
        table = spark.createDataFrame(rows, SCHEMA)
        table.coalesce(1).write.mode("append").parquet(folder)
        keyed.started(keyed.attempts(incremental.arriving(spark, folder, table.schema), ["domain", "path"], lateness, keep_days), out, checkpoint).awaitTermination()
    return checkpoint, sorted((r["domain"] or "", r["path"], r["ts"], r["status"], r["attempt"]) for r in spark.read.parquet(out).collect())


def test_attempts(spark):
    arrivals = [
        [("a", "/x", day(1), "error"), ("b", "/x", day(1), "success"), (None, "/x", day(1), "error")],
        [("a", "/x", day(3), "success"), ("a", "/x", day(2), "error"), ("b", "/x", day(2), "error")],
        [("a", "/x", day(9), "error"), ("b", "/x", day(31), "error"), ("b", "/x", day(1, 2), "success"), (None, "/x", day(5), "success")],
    ]
    _, got = run(spark, arrivals)
    assert got == [
        ("", "/x", day(1), "error", 1), ("", "/x", day(5), "success", 2),
        ("a", "/x", day(1), "error", 1), ("a", "/x", day(2), "error", 2), ("a", "/x", day(3), "success", 3), ("a", "/x", day(9), "already_done", 3),
        ("b", "/x", day(1), "success", 1), ("b", "/x", day(2), "already_done", 1), ("b", "/x", day(31), "error", 1), ("b", "/x", day(1, 2), "success", 1),
    ]


def test_timers_free_the_state(spark):
    # the second arrival moves the watermark past the first key's time
    checkpoint, got = run(spark, [[("a", "/x", day(1), "error")], [("b", "/y", day(20), "error")], [("b", "/z", day(21), "error")]], lateness="1 day", keep_days=5)
    assert [r[4] for r in got] == [1, 1, 1]
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "known").load()
    assert {r[0][1] for r in state.select("key").collect()} == {"/y", "/z"}
