"""Faster patterns of the Markdown repairs and paragraph breaks against the plain ones, on texts of few characters in all orders."""

import random

from pyspark.sql import functions as F

from pressmill.functions import fixed, text
from pressmill.functions.rx import FLAGS, lines, strip

PLAIN = [
    (r"(\w)\*\*[ \t]*\n[ \t]*(\w)", "$1**$2"), (r"(\w)[ \t]*\n[ \t]*\*\*(\w)", "$1**$2"), (r"(\w)\*[ \t]*\n[ \t]*(\w)", "$1*$2"), (r"(\w)[ \t]*\n[ \t]*\*(?!\*)(\w)", "$1*$2"),
    (r"(\w)`[ \t]*\n[ \t]*(\w)", "$1`$2"), (r"(\w)[ \t]*\n[ \t]*`(\w)", "$1`$2"), (r"\*\*\s*\*\*", ""), (r"(?<!\*)\*\s+\*(?!\*)", ""), ("``", ""), (r"\*{3,}", "**"),
    (r"(\w)(\*\*\w)", "$1 $2"), (r"(\w)(\*(?!\*)\w)", "$1 $2"), (r"[ \t]{2,}", " "), (r"\n{3,}", "\n\n"), (r"[ \t]+\n", "\n"),
]


def made(spark, letters, seed, n=30000):
    draw = random.Random(seed)
    return spark.createDataFrame([(i, "".join(draw.choice(letters) for _ in range(draw.randint(0, 14)))) for i in range(n)], "id int, t string").repartition(8)


def test_each_repair_is_the_plain_one(spark):
    rows = made(spark, ["a", "é", "\U0001d400", "\U0001f600", "*", "**", "*", "`", "\n", " ", "\t", "-", "a*a", "a**\na", "a\n**a"], 1)
    both = rows.select("t", F.array(*(F.struct(F.regexp_replace("t", FLAGS + p, to).alias("want"), F.regexp_replace("t", FLAGS + q, made).alias("got")) for (p, to), (q, made) in zip(PLAIN, fixed.MARKDOWN_REPAIRS))).alias("b"))
    changed = both.select(*(F.count_if(F.get("b", i)["want"] != F.col("t")) for i in range(len(PLAIN)))).first()
    assert all(n > 20 for n in changed)
    assert both.where(F.exists("b", lambda x: x["want"] != x["got"])).take(3) == []


def test_repairs_and_breaks_as_a_whole(spark):
    rows = made(spark, ["a", "B", "Ǆ", "\U0001d400", ".", '"', "?", "#", "1.", "*", "**", "`", "\n", "\n\n", " ", "\x85"], 2)
    want = F.col("t")
    for pattern, to in PLAIN:
        want = F.regexp_replace(want, FLAGS + pattern, to)

    def spaced(all_lines):
        def one(line, i):
            here, after = strip(line), strip(F.coalesce(F.get(all_lines, i + 1), F.lit("")))
            starts = F.regexp_like(after, F.lit(r"""\A["\p{Lu}\p{Lt}]""")) & ~F.regexp_like(after, F.lit(r"\A(?:[#>\-*]|[123]\.)"))
            return F.when(F.regexp_like(here, F.lit(r"""[.!?"]\z""")) & starts, F.concat(line, F.lit("\n"))).otherwise(line)

        return F.transform(all_lines, one)

    both = rows.select("t", want.alias("want"), text.markdown_repaired(F.col("t")).alias("got")).withColumn("broken", F.array_join(spaced(lines(F.col("got"))), "\n"))
    assert both.where("want <> got").take(3) == []
    assert both.where("broken <> got").count() > 500 and both.where(text.paragraphs(F.col("got")) != F.col("broken")).take(3) == []
    assert rows.select(text.paragraphs(text.markdown_repaired(F.lit(None).cast("string")))).first()[0] is None


def test_most_repairs_wait_for_their_marker(spark):
    plan = spark.range(1).select(text.markdown_repaired(F.concat(F.lit("x"), "id")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("contains(") >= 11
