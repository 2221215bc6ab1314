"""Line deduplication: lines that many documents share stay in one document only.

1. Hashes of the long lines, with document and position, are a table. They are dealt in ranges of hash and slice
   (a part of the documents) and sorted by document, largest first, and position. One pass over each range
   streams the first occurrence per hash, slice and document: the first of all names the slice's largest document, and
   their number counts its documents. So a line that a third of all rows hold is spread over SLICES groups.
2. The slices of a hash are added up; hashes of enough documents are the index.
3. An equi-join takes the index back to the line table. Per document it gives a keep bitmap in run-length
   form, the first and last line of each dropped run; no text is shuffled but for the last join, which cuts.

Everything runs in DataFrame functions.

Edge cases: null or empty text is one empty line. Repeated rows with one doc_id count as one
document. A null doc_id is a document smaller than all others. Extra columns are kept by line_dedup unless they
carry a name of the result. An empty table gives an empty result.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import NULL_ID, SPACES, ascii_lower, shuffle_partitions, stored

#: Parts of the documents that a hash is counted in on its own.
SLICES = 256


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """h1, h2, _id, _sig, pos: the long lines' keys as 128-bit hashes, and where they stand."""
    text = F.coalesce(docs["text"], F.lit(""))
    numbered = docs.select(F.coalesce(docs["doc_id"], F.lit(NULL_ID)).alias("_id"), F.xxhash64(text).alias("_sig"), text.alias("_text"))
    lines = numbered.select("_id", "_sig", F.posexplode(F.split("_text", "\n")).alias("pos", "line"))
    keys = lines.where(F.char_length("line") >= min_chars).withColumn("key", line_key(F.col("line"))).where(F.char_length("key") >= min_chars)
    return keys.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"), "_id", "_sig", "pos")


def shared_lines(hashes: DataFrame, min_docs: int = 5, slices: int = SLICES) -> DataFrame:
    """h1, h2, keeper: the keys that at least min_docs documents hold, and the largest of these."""
    key = ["h1", "h2", "slice"]
    sliced = hashes.select("h1", "h2", F.pmod(F.xxhash64("_id"), F.lit(slices)).cast("int").alias("slice"), "_id", "pos")
    latest = [*key, F.col("_id").desc(), "pos"]
    ranges = sliced.repartitionByRange(shuffle_partitions(hashes.sparkSession), *key).sortWithinPartitions(*latest)
    before = F.lag("_id").over(Window.partitionBy(*key).orderBy(F.col("_id").desc(), "pos"))
    firsts = ranges.withColumn("before", before).where(F.col("before").isNull() | (F.col("before") != F.col("_id")))
    per_slice = firsts.groupBy(*key).agg(F.count("*").alias("n"), F.max("_id").alias("last"))
    return per_slice.groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.max("last").alias("keeper")).where(F.col("n") >= min_docs).select("h1", "h2", "keeper")


def line_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """_id, _sig, starts, stops: for each document that loses lines, the first and last number of each run of lines that go."""
    hashes = stored(line_hashes(docs, min_chars))
    lost = hashes.join(stored(shared_lines(hashes, min_docs)), ["h1", "h2"]).where(F.col("_id") < F.col("keeper"))
    gone = lost.groupBy("_id", "_sig").agg(F.sort_array(F.collect_set("pos")).alias("gone"))
    starts = F.filter("gone", lambda p, i: (i == 0) | (F.get("gone", i - 1) != p - 1))
    stops = F.filter("gone", lambda p, i: (i == F.size("gone") - 1) | (F.get("gone", i + 1) != p + 1))
    return gone.select("_id", "_sig", starts.alias("starts"), stops.alias("stops"))


def line_dedup(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """All rows of docs with n_lines, n_dropped and kept_text; other columns as they came."""
    made = {"_id", "_sig", "_text", "starts", "stops", "n_lines", "n_dropped", "kept_text"}
    extra = [c for c in docs.columns if c not in made]
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(*extra, F.coalesce(docs["doc_id"], F.lit(NULL_ID)).alias("_id"), F.xxhash64(text).alias("_sig"), text.alias("_text"))
    lines = F.split("_text", "\n")
    dropped = F.aggregate(F.arrays_zip("starts", "stops"), F.lit(0), lambda n, run: n + run["stops"] - run["starts"] + 1)
    # the lines between two dropped runs, which are few; the last stretch ends with the text
    after = lambda i: F.coalesce(F.get("stops", i - 1) + 1, F.lit(0))
    kept = F.flatten(F.transform(F.sequence(F.lit(0), F.size("starts")), lambda i: F.slice(lines, after(i) + 1, F.coalesce(F.get("starts", i), F.size(lines)) - after(i))))
    return rows.join(line_bitmaps(docs, min_chars, min_docs), ["_id", "_sig"], "left").select(
        *extra,
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(dropped, F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("starts").isNull(), F.col("_text")).otherwise(F.array_join(kept, "\n")).alias("kept_text"),
    )


def op8_line_dedup(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return line_dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS pos, ls FROM d),
k AS (SELECT doc_id, pos, ls[pos] AS line,
        translate(trim(ls[pos], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.doc_id, k.pos, k.line, s.keeper IS NOT NULL AND k.doc_id < s.keeper AS gone FROM k LEFT JOIN s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
