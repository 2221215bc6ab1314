"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source gets a share of the mix by its weight, at most max_epochs times its own size (what
is cut off is shared out again by weight). A source is taken as whole epochs first; the rest of
its target is filled with documents in order of exponential keys -ln(u)/quality, u being a hash
of doc_id. The prefix sums are taken in two levels: sizes by key bucket, then, only within the
one bucket where a source's budget ends, by document. So a source with a third of all rows never
meets in one task, nor do the sources themselves, and all of it runs in DataFrame functions.

Edge cases: null text has size 0; a null source is a source of its own, last in order; a null
doc_id is hashed as the empty string; rows that repeat are each a document, and are taken equally often. A source of size 0
has target 0. A null or NaN quality counts as 1; documents of a quality of 0 or less come after all others of
their source, among themselves as if their quality were 1. Extra columns are kept unless they carry a name of the result.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import running_sums, stored

#: Buckets of the sampling keys within a source; the last prefix sum covers one of them.
BUCKETS = 4096
WEIGHTS = (3, 1, 2)
#: Quality weight of a document labelled 0, and what a label of 1 adds; without a label the weight is 1.
LABEL_BASE, LABEL_GAIN = 0.5, 1.0


def word_count(text: Column) -> Column:
    """Words between ASCII white space, without an array per text: each word's first character counts."""
    ascii_ws = r"[^\x20\x09-\x0D]+"
    return F.coalesce(F.regexp_count(text, F.lit(ascii_ws)), F.lit(0)).cast("long")


def sampling_key(doc_id: Column, quality: Column) -> Column:
    """Exponential with rate quality; ascending order samples without replacement by quality."""
    digits = F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 13), 16, 10).cast("long")
    return -F.log((digits + F.lit(0.5)) / F.lit(float(2**52))) / F.when(quality > 0, quality).otherwise(F.lit(1.0))


def quality_weights(labels: DataFrame) -> DataFrame:
    """doc_id, quality: the weight that a document's labels (0 to 1) give it, their mean where there are several."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    return rows.groupBy("doc_id").agg((F.lit(LABEL_BASE) + F.lit(LABEL_GAIN) * F.avg("quality")).alias("quality"))


def source_targets(sizes: DataFrame, epochs_of_all: float = 1.5, max_epochs: float = 2.0, weights=WEIGHTS) -> DataFrame:
    """source, source_size, target from a table (source, source_size) of one row per source.

    Water filling: in ascending order of cap/weight the first source that its cap does not bind, given what the
    sources before it take at their caps, fixes the level. Later ones cannot: once caps exceed the total, the
    level computed from them is negative.
    """
    by_name = F.col("source").asc_nulls_last()
    turn = F.col("nth") % len(weights) + 1
    named = running_sums(sizes, [by_name], nth=F.lit(1)).withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int")))
    ranked = stored(named.select("source", "source_size", "weight", (F.lit(max_epochs) * F.col("source_size")).alias("cap")).withColumn("ratio", F.col("cap") / F.col("weight")))
    total, weight = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
    filled = running_sums(ranked, [F.col("ratio"), by_name], rank=F.lit(1), capped=F.col("cap"), weighed=F.col("weight"))
    level = (F.lit(float(epochs_of_all) * total) - F.coalesce("capped", F.lit(0.0))) / (F.lit(float(weight)) - F.coalesce("weighed", F.lit(0.0)))
    fixed = filled.select("rank", "ratio", level.alias("level")).where(F.col("level") <= F.col("ratio")).agg(F.min_by("level", "rank")).first()[0]
    return ranked.select("source", "source_size", F.least("cap", F.lit(float("inf") if fixed is None else fixed) * F.col("weight")).alias("target"))


def mix_sources(docs: DataFrame, epochs_of_all: float = 1.5, max_epochs: float = 2.0, weights=WEIGHTS, quality: DataFrame | None = None, buckets: int = BUCKETS) -> DataFrame:
    """All rows of docs with size, source_size, target, copies (how often the mix takes the row) and taken.

    quality is a table (doc_id, quality) of one row per doc_id at most.
    """
    made = {"size", "source_size", "target", "copies", "taken", "before", "left", "epochs", "extra", "_key", "_bucket", "_tie", "_turn", "_s", "_q", "_d", "_cut"}
    extra = [c for c in docs.columns if c not in made]
    rows = docs.select(*extra, word_count(docs["text"]).alias("size"), F.xxhash64(docs["text"]).alias("_tie"))
    if quality is None:
        rows = rows.withColumn("_q", F.lit(1.0))
    else:
        known = quality.select(F.col("doc_id").alias("_d"), F.col("quality").cast("double").alias("_q"))
        # one plan at every size: labels may be as many as documents
        rows = rows.join(known.hint("merge"), rows["doc_id"] == known["_d"], "left").drop("_d").withColumn("_q", F.coalesce(F.nanvl("_q", F.lit(1.0)), F.lit(1.0)))
    rows = rows.withColumn("_key", sampling_key(F.col("doc_id"), F.col("_q")))
    # documents of no quality have buckets of their own behind the others
    behind = F.when(F.col("_q") > 0, 0).otherwise(buckets)
    rows = rows.withColumn("_bucket", F.floor(F.col("_key") / (1 + F.col("_key")) * buckets).cast("int") + behind).drop("_q")

    # at most twice `buckets` rows per source, and one per source below: few files hold them at any input size
    keys = stored(rows.select("source", "doc_id", "size", "_key", "_bucket", "_tie"))
    sums = stored(keys.groupBy("source", "_bucket").agg(F.sum("size").alias("sum")).coalesce(32))
    targets = source_targets(sums.groupBy("source").agg(F.sum("sum").alias("source_size")), epochs_of_all, max_epochs, weights)
    epochs = F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0))
    upto = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    lasts = (
        sums.withColumn("before", F.coalesce(F.sum("sum").over(upto), F.lit(0)))
        .join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
        .withColumn("epochs", epochs)
        .withColumn("left", F.col("target") - F.col("epochs") * F.col("source_size"))
        .groupBy("source", "source_size", "target", "epochs", "left")
        # the bucket where the budget ends: the last one that starts below it
        .agg(F.max_by("before", F.when(F.col("before") < F.col("left"), F.col("_bucket"))).alias("before"), F.max(F.when(F.col("before") < F.col("left"), F.col("_bucket"))).alias("_turn"))
        .withColumnRenamed("source", "_s")
    )
    lasts = stored(lasts.coalesce(4))
    # in that bucket documents of one place in the order go together; the last ones in are those whose middle the budget reaches
    place = F.struct("_key", "doc_id", "size", "_tie")
    inside = keys.join(lasts, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_turn")))
    alike = inside.groupBy("_s", "before", "left", place.alias("_place")).agg(F.sum("size").alias("sum"))
    running = Window.partitionBy("_s").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    middle = F.col("before") + F.sum("sum").over(running) - F.col("sum") / 2
    cuts = alike.withColumn("_in", middle <= F.col("left")).where("_in").groupBy("_s").agg(F.max("_place").alias("_cut"))
    ends = stored(lasts.join(cuts.withColumnRenamed("_s", "_c"), F.col("_s").eqNullSafe(F.col("_c")), "left").drop("_c").coalesce(4))
    within = (F.col("_bucket") < F.col("_turn")) | ((F.col("_bucket") == F.col("_turn")) & F.coalesce(place <= F.col("_cut"), F.lit(False)))
    copies = F.col("epochs") + F.coalesce(within, F.lit(False)).cast("long")
    chosen = rows.join(ends, F.col("source").eqNullSafe(F.col("_s"))).withColumn("copies", copies)
    return chosen.select(*extra, "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def labelled_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_weights(spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op10_mix_sources(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return mix_sources(docs, quality=labelled_quality(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


#: Targets by another way than above: the highest ratio at which all sources, filled to it, stay within the total, tells the capped ones.
SQL = r"""
WITH q AS (SELECT doc_id, 0.5::DOUBLE + avg(quality) AS quality FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
        -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE) / coalesce(q.quality, 1.0::DOUBLE) AS key
      FROM documents LEFT JOIN q USING (doc_id)),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3.0::DOUBLE, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight, 2.0::DOUBLE * source_size AS cap FROM s),
g AS (SELECT 1.5::DOUBLE * sum(source_size)::DOUBLE AS total FROM s),
r AS (SELECT a.cap / a.weight AS ratio, sum(least(b.cap, b.weight * (a.cap / a.weight))) AS filled FROM w a CROSS JOIN w b GROUP BY 1),
c AS (SELECT coalesce(max(ratio), -1) AS ratio FROM r, g WHERE filled <= total),
f AS (SELECT (any_value(total) - coalesce(sum(cap) FILTER (WHERE cap / weight <= ratio), 0)) / sum(weight) FILTER (WHERE cap / weight > ratio) AS level FROM w, c, g),
t AS (SELECT source, source_size, CASE WHEN cap / weight <= ratio THEN cap ELSE weight * level END AS target FROM w, c, f),
e AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size) END AS epochs FROM t),
p AS (SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
        sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS upto
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       CAST((epochs + CASE WHEN rest > 0 AND upto - size / 2.0::DOUBLE <= rest THEN 1 ELSE 0 END) * size AS BIGINT) AS taken FROM p
"""
