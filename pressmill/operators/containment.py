"""Which of very many patterns stand in which texts, by an index of the patterns' grams instead of a plan that names them.

A pattern can stand only where each of its grams stands, so it is looked up by the one that fewest texts hold: an equi-join of the texts' distinct
grams with one gram per pattern, and `contains` on what meets. Patterns shorter than a gram are grams of their own length. No text meets a
pattern without a gram in common, patterns may be as many as texts, and nothing is broadcast by hint.

Edge cases: null and empty texts hold nothing; null and empty patterns stand nowhere; repeated rows of either side give their pairs each.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import stored

GRAM = 4


def grams(text, size: int):
    """The distinct grams of a text, by one pass of a pattern that looks ahead at each place; a substring for each would walk the text anew."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1)))


def contained(texts: DataFrame, patterns: DataFrame, text: str = "text", pattern: str = "pattern", size: int = GRAM) -> DataFrame:
    """The texts' columns but the text, with those of each pattern that stands in it. No column may have the same name on both sides."""
    rows = texts.where(F.char_length(text) > 0).withColumn("_t", F.monotonically_increasing_id())
    rows = stored(rows)
    own = stored(patterns.where(F.char_length(pattern) > 0).withColumn("_p", F.monotonically_increasing_id()))
    short = [r[0] for r in own.select(F.char_length(pattern).alias("n")).where(F.col("n") < size).distinct().collect()]
    of = lambda n: rows.select("_t", F.explode(grams(F.col(text), n)).alias("_gram"))
    pieces = own.where(F.char_length(pattern) >= size).select("_p", F.explode(grams(F.col(pattern), size)).alias("_gram"))
    wanted = pieces.select("_gram").distinct()
    held = of(size).join(wanted, "_gram", "left_semi").groupBy("_gram").agg(F.count("*").alias("_n"))
    # a pattern with a gram that no text holds stands nowhere
    rarest = pieces.join(held, "_gram", "left").groupBy("_p").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_gram").alias("gram"))).alias("r"))
    index = rarest.where("r.n > 0").select("_p", F.col("r.gram").alias("_gram"))
    pairs = of(size).join(index, "_gram").select("_t", "_p")
    for n in sorted(short):
        pairs = pairs.unionByName(of(n).join(own.where(F.char_length(pattern) == n).select("_p", F.col(pattern).alias("_gram")), "_gram").select("_t", "_p"))
    met = pairs.join(own, "_p").join(rows, "_t").where(F.contains(F.col(text), F.col(pattern)))
    return met.select(*(c for c in texts.columns if c != text), *patterns.columns)


def first_contained(texts: DataFrame, patterns: DataFrame, key: str, order: str, text: str = "text", pattern: str = "pattern") -> DataFrame:
    """key, pattern, n: for each key with any, the first of its patterns and how many there are."""
    found = contained(texts, patterns, text, pattern)
    return found.groupBy(key).agg(F.min_by(pattern, order).alias("pattern"), F.count("*").alias("n"))
