"""Containment by grams against trying every pattern on every text."""

import random

from pressmill.operators import containment


def pairs(spark, texts, patterns, **how):
    t = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(3)
    p = spark.createDataFrame(list(enumerate(patterns)), "nth int, pattern string").repartition(2)
    out = containment.contained(t, p, **how)
    assert out.columns == ["id", "nth", "pattern"]
    return sorted((r["id"], r["nth"]) for r in out.collect())


def tried(texts, patterns):
    return [(i, n) for i, t in enumerate(texts) for n, p in enumerate(patterns) if t and p and p in t]


def test_all_pairs(spark):
    draw = random.Random(1)
    word = lambda n: "".join(draw.choice("abAé ✓🙂?") for _ in range(n))
    texts = [word(draw.randint(0, 60)) for _ in range(150)] + [None, "", "abc", "abc", "x" * 30_000 + "needle"]
    patterns = [word(draw.randint(1, 9)) for _ in range(200)] + [None, "", "a", "abc", "needle", "abc", "xxxx", "not there"]
    want = tried(texts, patterns)
    assert pairs(spark, texts, patterns) == want and len(want) > 1000
    assert pairs(spark, texts, patterns, size=2) == want
    assert pairs(spark, [], patterns) == pairs(spark, texts[:5], []) == []


def test_one_text_in_a_third_of_the_rows(spark):
    texts = ["the same line everywhere"] * 60 + [f"other line {i}" for i in range(120)]
    patterns = ["same line", "line", "other line 7", "everywhere", "ever where"]
    assert pairs(spark, texts, patterns) == tried(texts, patterns)


def test_no_pair_of_all(spark):
    t = spark.createDataFrame([(1, "abcdef")], "id int, text string")
    p = spark.createDataFrame([(1, "bcde")], "nth int, pattern string")
    plan = containment.contained(t, p)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
