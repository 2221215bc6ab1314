"""What cleaning names once in its plan, and that what lines are ruled out by is part of every match."""

import random
import re
import sys

from pyspark.sql import functions as F

from pressmill.functions import fixed, rx, text
from pressmill.plans.text_queries import QUERIES


def test_own_patterns_stand_once_in_the_plan(spark):
    rows = spark.range(3).select(F.lit("the line\nsinging and more of it").alias("text"), F.concat(F.lit("site"), "id").alias("domain"))
    cleaned = rows.select(text.cleaned_by_rules(F.col("text"), F.col("domain"), {"site1": ["ing$", "and|of"]}).alias("c"))
    assert cleaned._jdf.queryExecution().analyzed().toString().count("ing$") == 1
    assert [r["c"] for r in cleaned.collect()] == ["the line\nsinging and more of it", "the line\nsinging more it", "the line\nsinging and more of it"]


def test_lines_ruled_out_have_no_match(spark):
    every = [p for lists in (*fixed.PAYWALL.values(), *fixed.DROPPED_LINES.values(), fixed.DROPPED_EVERYWHERE) for p in lists]
    assert all(rx.telling_parts(p) for p in every)
    assert rx.telling_parts(r"a+b?c[de]f\.x|y") is None and rx.telling_parts(r"\d[|>]") == ["|", ">"] and rx.telling_parts(r"^Ab?cd+\.e(xyz)$") == ["cd"]
    # each letter of the parts in each form that matches it in any case
    letters = sorted({c for p in every for part in rx.telling_parts(p) for c in part if c.isalpha()})
    rows = spark.range(1, sys.maxunicode + 1).where("id not between 55296 and 57343")
    made = rows.select(F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("t"))
    lower = F.lower("t")
    lost = F.lit(False)
    for c in letters:
        lost = lost | (F.regexp_like("t", F.lit(rx.IGNORE_CASE + re.escape(c))) & ~rx.contains_any(lower, [c, *rx.ODD_CASES]))
    assert made.where(lost).count() == 0


def test_strip_takes_what_the_class_takes(spark):
    made = spark.range(1, 0x3100).select(F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c")).select("c", F.concat("c", F.lit("a"), "c", F.lit("b"), "c").alias("t"))
    assert made.where(rx.strip(F.col("t")) != F.regexp_replace("t", rf"(?Ud)\A{rx.SPACE}+|{rx.SPACE}+\z", "")).count() == 0


def test_analysis_lowers_a_text_once(spark, small):
    plan = QUERIES["article_enriched"](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.count("lower(content#") <= 2


def test_guards_of_names_keep_odd_letters(spark):
    texts = ["PARIſ et parıs, İnde", "à NÎMES", "Foo GmbH", "Bar SARL et ONU", "rien", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    names = lambda lists, flags: [flags + text._names(n) for n in lists]
    plain = lambda patterns: F.flatten(F.array(*(F.regexp_extract_all("text", F.lit(p), F.lit(0)) for p in patterns)))
    want_places = F.array_sort(F.array_distinct(F.transform(plain(names(fixed.LOCATIONS, rx.IGNORE_CASE)), rx.capitalize)))
    want_orgs = F.array_sort(F.array_distinct(plain([*names(fixed.ORGANIZATIONS, rx.FLAGS), rx.FLAGS + fixed.COMPANY])))
    got = rows.select("id", text.locations(F.col("text")), text.organizations(F.col("text")), want_places, want_orgs).collect()
    assert all(r[1] == r[3] and r[2] == r[4] for r in got) and sum(len(r[1] or []) for r in got) >= 2


def test_a_pattern_waits_for_its_own_part(spark):
    own = dict(rx.guarded(fixed.DROPPED_LINES["romanian"]))
    # a line that holds "de" somewhere is not tried with any pattern
    assert own[("^de",)] == [r"^De\s+[A-Z][a-z]+\s+[A-Z][a-z]+.*$"] and ("de",) not in own and len(own[("distribuie ",)]) == 3
    assert rx.guarded(["plain", r"a|b"]) is None
    words = ["De", "de", "Ion", "Pop", "Home", "home", "|", ">", "Distribuıe", "distribuie pe Facebook", "50.5%", "remaining", "ſponsored Content", "Par Ann Lee", "#tag", "@me", "Article", "Sign up newsletter", "Read more", "x"]
    draw = random.Random(3)
    rows = spark.createDataFrame([(" ".join(draw.choice(words) for _ in range(draw.randint(1, 4))),) for _ in range(4000)], "t string")
    for patterns in (*fixed.PAYWALL.values(), *fixed.DROPPED_LINES.values(), fixed.DROPPED_EVERYWHERE):
        want = F.regexp_like("t", F.lit(rx.IGNORE_CASE + rx.any_of(patterns)))
        for odd in (None, rx.has_odd_case(F.lower("t"))):
            assert rows.where(want != rx.like_any(F.col("t"), F.lower("t"), patterns, odd)).take(3) == []
