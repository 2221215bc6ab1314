"""Main text by density: runs against all runs tried one by one, and a page whose two extraction methods differ."""

import random

from pyspark.sql import functions as F

from pressmill.operators import blocks, elements, pages

LONG = "Plain words of a long paragraph that goes on and on without any link in it so that it is worth a lot more than it costs. " * 3


def strings_of(spark, rows):
    return elements.string_rows(elements.parsed(spark.createDataFrame(rows, "page_id long, html string")))


def test_best_run_is_the_best_of_all(spark):
    draw = random.Random(4)
    rows = []
    for page in range(60):
        for n in range(draw.randint(1, 12)):
            words = draw.choice([1, 2, 5, 20, 40, 90])
            rows.append((page, n * 3 + draw.randint(0, 2), " ".join(["word"] * words), words, draw.choice([0, 0, words, words // 2])))
    table = spark.createDataFrame(rows, "page_id long, block int, text string, words int, linked_words int").cache()
    from pyspark.sql import Window

    worth = {}
    for page, block, w in table.select("page_id", "block", blocks.worth(Window.partitionBy("page_id").orderBy("block"))).collect():
        worth.setdefault(page, []).append((block, w))
    want = []
    for page, own in worth.items():
        own.sort()
        runs = [(-sum(w for _, w in own[i : j + 1]), own[j][0], own[i][0]) for i in range(len(own)) for j in range(i, len(own))]
        total, last, first = min(runs)
        want += [(page, b) for b, _ in own if total < 0 and first <= b <= last]
    assert sorted(map(tuple, blocks.best_runs(table).select("page_id", "block").collect())) == sorted(want)
    assert len({p for p, _ in want}) > 20


def test_blocks(spark):
    page = "<title>t</title><div>a <b>bold</b> <a href=x>two links</a><p>next<br>line &amp; more<script>no</script></p>tail</div><ul><li><a>one</a><li>two</ul>"
    got = [tuple(r) for r in blocks.block_rows(strings_of(spark, [(1, page), (2, None), (3, " "), (4, "<style>x</style>")])).orderBy("page_id", "block").select("text", "words", "linked_words").collect()]
    assert got == [("t", 1, 0), ("a bold two links", 4, 2), ("next line & more", 4, 0), ("tail", 1, 0), ("one", 1, 1), ("two", 1, 0)]
    assert blocks.main_texts(strings_of(spark, [(1, page), (2, None)])).count() == 0


def test_links_and_short_lines_end_a_run(spark):
    links = "".join(f'<li><a href="/{i}">A headline of another story that one might read {i}</a></li>' for i in range(6))
    page = f"<ul>{links}</ul><div><h1>Head</h1><p>{LONG}</p><p>Short one.</p><p>{LONG}</p></div><ul>{links}</ul><footer>Imprint</footer>"
    got = blocks.main_texts(strings_of(spark, [(1, page)])).collect()
    assert [tuple(r) for r in got] == [(1, 3, f"{LONG.strip()}\n\nShort one.\n\n{LONG.strip()}")]


def test_methods_differ(spark):
    # the article element holds less than what stands beside it
    page = f"<html><body><article><p>{LONG[:150]}</p></article><div><p>{LONG}</p></div><div><p>{LONG}</p></div></body></html>"
    table = spark.createDataFrame([("a.example", "http://a.example/1", page, 7)], "domain string, url string, html string, note int")
    one, two = (pages.extracted(table, method=m, now=F.lit("2024-01-01").cast("timestamp")).collect()[0] for m in ("dense", "light"))
    assert one["note"] == two["note"] == 7 and one["extraction_method"] == "dense" and two["extraction_method"] == "light"
    assert one["markdown"].count("Plain words") == 2 and two["markdown"].count("Plain words") == 8
