"""Main text by density: a page's blocks of text as rows, of which the best run in page order is the article.

A block is worth its words, less where it and its neighbours hold links or short lines, and costs COST words; long plain
paragraphs gain, menus and captions lose. The run of blocks with the largest sum is found by windows over the page: the sum up to a block
less the least sum before a run could begin. All windows and the final grouping share one exchange by page.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rx import SPACE, strip, word_count

#: A line has so many characters, and so many words where it is full; a block costs so many words.
LINE_CHARS, LINE_WORDS, COST = 80, 13, 15


def block_rows(strings: DataFrame, key: str = "page_id") -> DataFrame:
    """key, block, text, words, linked_words: what stands between two boundaries of blocks; hidden and blank text has no row."""
    shown = strings.where("hidden = 0").select(key, "block", "at", "text", F.when(F.col("linked"), word_count(F.col("text"))).otherwise(0).alias("linked_words"))
    found = shown.groupBy(key, "block").agg(F.sort_array(F.collect_list(F.struct("at", "text"))).alias("parts"), F.sum("linked_words").alias("linked_words"))
    text = strip(F.regexp_replace(F.array_join(F.transform("parts", lambda p: p["text"]), ""), rf"(?Ud){SPACE}+", " "))
    return found.select(key, "block", text.alias("text"), "linked_words").where("text <> ''").withColumn("words", word_count(F.col("text"))).select(key, "block", "text", "words", "linked_words")


def worth(order) -> Column:
    """A block's thousandths of a word: its words, by the density of text and links in it and its neighbours, less the cost of a block."""
    around = order.rowsBetween(-1, 1)
    lines = F.ceil(F.char_length("text") / F.lit(LINE_CHARS))
    full = F.least(F.sum("words").over(around) / F.sum(lines).over(around) / F.lit(LINE_WORDS), F.lit(1.0))
    plain = F.lit(1.0) - F.lit(2.0) * F.sum("linked_words").over(around) / F.sum("words").over(around)
    return F.floor(F.lit(1000.0) * F.col("words") * plain * full).cast("long") - F.lit(1000 * COST)


def best_runs(blocks: DataFrame, key: str = "page_id") -> DataFrame:
    """The blocks of each page's best run, of equal ones the first and longest; a page whose blocks are all worth less than they cost has none."""
    page, order = Window.partitionBy(key), Window.partitionBy(key).orderBy("block")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = blocks.withColumn("_worth", worth(order)).withColumn("_sum", F.sum("_worth").over(upto)).withColumn("_before", F.col("_sum") - F.col("_worth"))
    rows = rows.withColumn("_least", F.min("_before").over(upto)).withColumn("_gain", F.col("_sum") - F.col("_least"))
    rows = rows.withColumn("_best", F.max("_gain").over(page)).withColumn("_end", F.min(F.when(F.col("_gain") == F.col("_best"), F.col("block"))).over(page))
    rows = rows.withColumn("_from", F.max(F.when(F.col("block") == F.col("_end"), F.col("_least"))).over(page))
    rows = rows.withColumn("_start", F.min(F.when((F.col("_before") == F.col("_from")) & (F.col("block") <= F.col("_end")), F.col("block"))).over(page))
    return rows.where((F.col("_best") > 0) & F.col("block").between(F.col("_start"), F.col("_end"))).select(blocks.columns)


def main_texts(strings: DataFrame, key: str = "page_id", between: str = "\n\n") -> DataFrame:
    """key, n_blocks, text: the best run of each page as one text; pages without one have no row."""
    kept = best_runs(block_rows(strings, key), key).groupBy(key).agg(F.sort_array(F.collect_list(F.struct("block", "text"))).alias("run"))
    return kept.select(key, F.size("run").alias("n_blocks"), F.array_join(F.transform("run", lambda b: b["text"]), between).alias("text"))
