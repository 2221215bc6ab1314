"""Properties over generated values, many in one Spark job each."""

import random
from urllib.parse import unquote, urljoin, urlparse

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pressmill.functions import text, urls
from pressmill.functions.rx import strip, word_count
from pressmill.html import clean, dom

LETTERS = "ab1 /.-_?#&=%+;:é\t"


def generated(n, size, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choices(LETTERS, k=rnd.randint(0, size))) for _ in range(n)]


@pytest.fixture(scope="module")
def strings(spark):
    values = [*generated(400, 25, 1), *(f"https://h.com/{x}" for x in generated(400, 25, 2))]
    return values, spark.createDataFrame([(v,) for v in values], "s string").repartition(2)


def test_url_parts_like_the_standard_library(strings):
    values, frame = strings
    got = {r.s: r for r in frame.select("s", *(urls.part(F.col("s"), p).alias(p) for p in ("netloc", "path", "query", "fragment"))).collect()}
    for v in values:
        if not v.startswith("https://"):
            continue
        want = urlparse(v)
        assert (got[v].netloc, got[v].path, got[v].query, got[v].fragment) == (want.netloc, want.path, want.query, want.fragment), v


def test_reasons_are_never_null(strings):
    values, frame = strings
    assert urls.with_skip_reason(frame, "s").where("reason is null").count() == 0


def test_decoding_words_and_stripping(strings):
    values, frame = strings
    for r in frame.select("s", urls.percent_decoded(F.col("s")).alias("d"), word_count(F.col("s")).alias("n"), strip(F.col("s")).alias("t")).collect():
        assert r.n == len(r.s.split()) and r.t == r.s.strip()
        if "%" not in r.s:
            assert r.d == unquote(r.s)


def test_resolving_like_the_standard_library(strings):
    values, frame = strings
    links = [v for v in values if not v.startswith("https") and ":" not in v and ";" not in v and "//" not in v and v == v.strip() and "\t" not in v and not v.endswith(("?", "#"))]
    links += ["../x", "./x", "..", ".", "c/../../d?q#f", "/a/./b/../c", "../../../x", "x/..", "/.."]
    frame = frame.union(frame.sparkSession.createDataFrame([(x,) for x in links[-9:]], "s string"))
    rows = frame.where(F.col("s").isin(links)).select("s", urls.resolved(F.col("s"), F.lit("https://h.com/a/b")).alias("r")).collect()
    for r in rows:
        if "?#" not in r.s:
            assert r.r == urljoin("https://h.com/a/b", r.s), r.s


def test_finished_texts_have_no_short_lines(spark):
    values = generated(300, 60, 5)
    rows = spark.createDataFrame([(v.replace("/", "\n"),) for v in values], "s string").select(text.finished(F.col("s")).alias("t")).collect()
    assert all(len(x) > 3 or x == "" for r in rows for x in r.t.split("\n"))


@given(st.lists(st.sampled_from(["<p>", "</p>", "<b>", "</b>", "<br>", "<div class='ad-x'>", "</div>", "text", " & ", "<!-- c -->", "<script>", "</script>", "<i", "é"]), max_size=30))
@settings(max_examples=200, deadline=None)
def test_any_markup_is_parsed(parts):
    html = "".join(parts)
    tree = str(dom.parse(html))
    assert str(dom.parse(tree)) == tree
    for work in (clean.strip_irrelevant, clean.clean, clean.clean_lightly, clean.marked):
        assert isinstance(work(html), str)
