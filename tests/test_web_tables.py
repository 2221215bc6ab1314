"""Fetching from tables and politely, and counters that a run's own writing adds up."""

import time

from pyspark.sql import functions as F

from pressmill.operators import pages, runs
from pressmill.scratch import scratch_dir
from pressmill.sources import fetch as web


def test_answers_from_a_table(spark):
    links = spark.createDataFrame([("http://a/1", 1), ("http://a/2", 2), (None, 3), ("http://a/1", 1)], "url string, n int")
    answers = spark.createDataFrame([("http://a/1", 200, "text/html", "b"), ("http://a/1", 200, "text/html", "a"), ("http://b", 404, None, None), (None, 200, "x", "y")], "url string, status int, content_type string, html string")
    got = sorted((r["n"], r["status"], r["html"]) for r in web.fetched(links, answers).collect())
    assert got == [(1, 200, "a"), (1, 200, "a"), (2, None, None), (3, None, None)]
    assert web.fetched(links, answers).columns == web.fetched(links, lambda u: None).columns


def stamped(url):
    began = time.time()
    time.sleep(0.01)
    return 200, "text/plain", f"{began}"


def test_one_host_is_asked_with_pauses(spark):
    links = spark.createDataFrame([(f"http://{'Hot' if i % 2 else 'hot'}.example/{i}",) for i in range(6)] + [(f"http://h{i}.example/",) for i in range(12)], "url string").repartition(6)
    rows = web.fetched(links, web.Polite(stamped, 0.2)).collect()
    assert len(rows) == 18
    hot = sorted(float(r["html"]) for r in rows if "hot" in r["url"].lower())
    assert all(b - a > 0.19 for a, b in zip(hot, hot[1:]))


def test_counters_come_with_the_run(spark):
    evaluated = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            evaluated.add(batch.num_rows)
            yield batch

    rows = spark.createDataFrame([(i, s) for i, s in enumerate(["success", "error", "filtered", "skipped", "success", None])], "n int, status string")
    path = scratch_dir(spark)
    seen = runs.written(rows.mapInArrow(count, rows.schema), path, "status")
    assert evaluated.value == 6
    assert seen == {"total": 6, "success": 2, "error": 1, "skipped": 1, "filtered": 1} == runs.counters(spark.read.parquet(path)).first().asDict()
    assert runs.written(rows.where(F.lit(False)), path)["total"] == 0


def test_repeated_texts_bind_their_arrays(spark):
    rows = spark.createDataFrame([(1, "s", "<p>often here</p>" * 3 + "<p>twice</p><b>once only</b><p>twice</p><i>abc</i><i>abc</i>")], "page_id int, site string, html string")
    found = pages.analysed(rows).select("repeated")
    assert found._jdf.queryExecution().analyzed().toString().count("array_sort(transform(filter(strings") == 1
    assert found.first()["repeated"] == ["often here", "twice"]
