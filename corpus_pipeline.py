"""A corpus pipeline over the documents table: five stages, each one operator of pressmill.llm.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps with their columns; the
last one adds what the mix takes of each. Columns an operator does not use travel in one struct, so that names in
the table cannot clash with the operator's own.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.llm.common import NULL_ID, stored
from pressmill.llm.decontaminate import contaminated
from pressmill.llm.language import detect_language, fold, labelled_sample
from pressmill.llm.line_dedup import line_dedup
from pressmill.llm.mixing import labelled_quality, mix_sources
from pressmill.llm.simhash import near_copy_groups

#: Near copies share this much of their five-word shingles.
SHINGLE, SIMILARITY = 5, 0.8


def _packed(docs: DataFrame, *used: str) -> DataFrame:
    """The used columns by name and all others in one column _row, which is null-safe for any of them."""
    return docs.select(F.struct(F.lit(0).alias("_"), *(c for c in docs.columns if c not in used)).alias("_row"), *used)


def _unpacked(docs: DataFrame, like: DataFrame, **new) -> DataFrame:
    """The columns of `like` again, from _row or by name; new ones replace them."""
    return docs.select(*(new[c] if c in new else docs[c] if c in docs.columns else F.col("_row").getField(c) for c in like.columns)).toDF(*like.columns)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without a letter are rejected."""
    sample = labelled_sample(docs.where(fold(docs["doc_id"], 4) != 2))
    return _unpacked(detect_language(_packed(docs, "text"), sample).where(F.col("lang_pred") != "und"), docs)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; lines of 40 characters that five documents share stay in one of them."""
    cut = line_dedup(_packed(docs, "doc_id", "text"))
    text = F.when(F.col("text").isNotNull(), F.col("kept_text"))
    return _unpacked(cut, docs, text=text, n_chars=F.char_length(text).cast("long"))


def _keyed(docs: DataFrame) -> DataFrame:
    """Whole rows as _row with their doc_id, in which null has a value, as _id and the hash of their text as _sig."""
    return docs.select(F.struct(F.lit(0).alias("_"), *docs.columns).alias("_row"), F.coalesce("doc_id", F.lit(NULL_ID)).alias("_id"), F.xxhash64("text").alias("_sig"))


def _rows(packed: DataFrame, like: DataFrame) -> DataFrame:
    return packed.select(*(F.col("_row").getField(c).alias(c) for c in like.columns))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of least doc_id and hash of its text; one of rows that repeat both."""
    groups = near_copy_groups(docs.select("doc_id", "text"), SIMILARITY, SHINGLE)
    gone = groups.where("node <> head or sig <> head_sig").select(F.col("node").alias("_id"), F.col("sig").alias("_sig")).distinct()
    key = ["_id", "_sig"]
    kept = _keyed(docs).join(stored(gone), key, "left_anti")
    again = stored(kept.groupBy(key).count().where("count > 1").select(key))
    repeated = kept.join(again, key, "left_semi").dropDuplicates(key)
    return _rows(kept.join(again, key, "left_anti").select(repeated.columns).unionByName(repeated), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; rows are told apart by doc_id and text."""
    key = F.xxhash64("doc_id", "text")
    found = contaminated(docs.select(key.alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    gone = stored(found.select(F.col("doc_id").alias("_gone")).distinct())
    rows = _keyed(docs).withColumn("_key", F.xxhash64("_row.doc_id", "_row.text"))
    return _rows(rows.join(gone, F.col("_key") == F.col("_gone"), "left_anti"), docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with size, source_size, target, copies and taken."""
    return mix_sources(docs, quality=labelled_quality(spark, sf_dir)).where(F.col("copies") > 0)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_shared_lines),
    ("simhash_near_dedup", keep_one_of_near_copies),
    ("decontamination", drop_contaminated),
    ("source_mixing", mix),
]
#: Language identification, SimHash linking and edit matching are beyond SQL; tests hold run() against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
