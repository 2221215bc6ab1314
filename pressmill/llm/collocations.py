"""Collocations: phrases of two or three words, scored by how much of their parts' occurrences they take up.

1. Tasks cut texts into pieces and words and write them down as chunks of one language: the distinct words with their counts, and
   the text as numbers of those words. Spark adds up the counts; words of enough occurrences are the dictionary. A
   word's id is the sum of the counts of all words before it, so that ids are also places on a line as long as the text.
2. A chunk's distinct words meet the dictionary in a join and come back as one list per chunk. Pieces break at
   other words. A chunk sorts its n-grams and sends each once, with its count, as a key of six bytes per id. Keys are dealt in ranges of
   the line: what starts with a frequent word is spread by its second word, and the number of ranges grows with the text.
3. A range sorts its keys by 16-bit digits, counts runs and keeps those of enough occurrences.
4. Scores, containment and ranks are joins and windows over the phrases that are left. Products are decimals of 38 digits.

No word or n-gram meets in one task more than once per chunk, however frequent it is. Ids reach 2**48.

Edge cases: null or empty text has no words. Null language is `und`, together with a language of that name. Repeated rows count each.
A language without candidates has no rows, as has an empty table. Extra columns are ignored, and a null doc_id is as good as any.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import running_sums, stored
from .words import LOWER

#: Bytes of text that a task holds before it writes chunks, and n-grams of a range.
CHUNK_BYTES = 8_000_000
PER_RANGE = 2_000_000
ID_BYTES = 6
CHUNKS = "chunk long, lang string, words array<binary>, counts array<long>, tokens long, numbers binary"
COUNTED = "ids array<long>, a long"
#: Of each byte: 0 word, 1 between words, 2 between pieces.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2


def encoded(data: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of a text, most frequent first, their counts, and the text as numbers of words from 1, with 0 between pieces."""
    kind = _KIND[data]
    inside = kind == 0
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(LOWER[data[inside]]))])
    found = words.dictionary_encode()
    numbers = found.indices.to_numpy(zero_copy_only=False)
    counts = np.bincount(numbers, minlength=len(found.dictionary))
    order = np.argsort(-counts, kind="stable")
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(1, len(order) + 1)
    cuts = np.cumsum(kind == 2)[starts]
    fresh = np.diff(cuts, prepend=-1) != 0
    out = np.zeros(len(starts) + int(fresh.sum()), dtype=np.uint16 if len(order) < 1 << 16 else np.uint32)
    out[np.arange(len(starts)) + np.cumsum(fresh)] = rank[numbers]
    return found.dictionary.take(pa.array(order)), counts[order], out


def _portions(text: bytes, limit: int):
    """A very long text in parts that end where a piece ends."""
    at = 0
    while len(text) - at > limit:
        breaks = np.flatnonzero(_KIND[np.frombuffer(text, dtype=np.uint8, count=limit, offset=at)] == 2)
        if not len(breaks):
            later = np.flatnonzero(_KIND[np.frombuffer(text, dtype=np.uint8, offset=at + limit)] == 2)
            if not len(later):
                break
            end = at + limit + int(later[0])
        else:
            end = at + int(breaks[-1])
        yield text[at : end + 1]
        at = end + 1
    yield text[at:]


def _chunks(limit: int):
    def run(batches):
        base, made = TaskContext.get().partitionId() << 32, 0
        held: dict[str, list[bytes]] = {}
        size = 0

        def flush():
            nonlocal made, size
            for lang, parts in sorted(held.items()):
                words, counts, numbers = encoded(np.frombuffer(b"\n".join(parts), dtype=np.uint8))
                if len(words):
                    row = [[base + made], [lang], [words.to_pylist()], [counts], [int(counts.sum())], [np.array([numbers.itemsize], dtype=np.uint8).tobytes() + numbers.tobytes()]]
                    kinds = (pa.int64(), pa.string(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.int64(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(row, kinds)], names=["chunk", "lang", "words", "counts", "tokens", "numbers"])
                    made += 1
            held.clear()
            size = 0

        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text")):
                for part in _portions(text.as_py(), limit):
                    held.setdefault(lang.as_py(), []).append(part)
                    size += len(part)
                    if size >= limit:
                        yield from flush()
        yield from flush()

    return run


def packed(ids: np.ndarray) -> np.ndarray:
    """Rows of ids as rows of bytes, six an id, whose order is that of the ids."""
    m, n = ids.shape
    return np.ascontiguousarray(ids.astype(">u8").view(np.uint8).reshape(m, n, 8)[:, :, 8 - ID_BYTES :].reshape(m, n * ID_BYTES))


def unpacked(keys: np.ndarray, n: int) -> np.ndarray:
    wide = np.zeros((len(keys), n, 8), dtype=np.uint8)
    wide[:, :, 8 - ID_BYTES :] = keys.reshape(len(keys), n, ID_BYTES)
    return wide.reshape(len(keys), n * 8).view(">u8").astype(np.int64)


def radix_order(keys: np.ndarray) -> np.ndarray:
    """The order of rows of bytes: a stable sort by each 16-bit digit, which numpy does by radix, from the last to the first."""
    digits = keys.view(">u2").astype(np.uint16)
    order = np.arange(len(keys))
    for column in reversed(range(digits.shape[1])):
        own = digits[:, column]
        if len(own) and (own != own[0]).any():
            order = order[np.argsort(own[order], kind="stable")]
    return order


def chunk_ngrams(numbers: np.ndarray, places: np.ndarray, longest: int):
    """For each n, the distinct n-grams of a chunk in the order of their ids, as rows of indexes into ids, with counts; and the ids and their words."""
    known = np.flatnonzero(places >= 0)
    known = known[np.argsort(places[known])]
    size = len(known) + 1
    if longest * size.bit_length() > 63:
        raise ValueError("phrases of so many words do not fit a number")
    rank = np.zeros(len(places) + 1, dtype=np.uint64)
    rank[known + 1] = np.arange(1, size)
    line = rank[numbers]
    key, good = line.copy(), line > 0
    for n in range(2, longest + 1):
        tail = line[n - 1 :]
        key = key[:-1] * np.uint64(size) + tail if len(key) else key
        good = good[:-1] & (tail > 0) if len(good) else good
        own, counts = np.unique(key[good], return_counts=True)
        rows = np.empty((len(own), n), dtype=np.int64)
        left = own
        for column in reversed(range(n)):
            left, rows[:, column] = np.divmod(left, np.uint64(size))
        yield n, rows - 1, counts, known


def _send(longest: int, total: int, ranges: int):
    def run(batches):
        for batch in batches:
            for numbers, found in zip(batch.column("numbers"), batch.column("found")):
                blob = numbers.as_py()
                width = np.uint16 if blob[0] == 2 else np.uint32
                line = np.frombuffer(blob, dtype=width, offset=1)
                pos, at, f = (np.asarray(found.values.field(i)) for i in range(3))
                places, sizes = np.full(int(line.max(initial=0)), -1, dtype=np.int64), np.zeros(int(line.max(initial=0)))
                places[pos], sizes[pos] = at, f
                for n, rows, counts, known in chunk_ngrams(line, places, longest):
                    ids, f = places[known], sizes[known]
                    where = np.zeros(len(rows))
                    for column in reversed(range(n)):
                        where = ids[rows[:, column]] + f[rows[:, column]] * (where / total)
                    dealt = np.minimum((where / total * ranges).astype(np.int64), ranges - 1)
                    keys = packed(ids[rows])
                    cuts = np.flatnonzero(np.diff(dealt, prepend=-1))
                    # column by column, which Spark's compression of shuffles makes the most of
                    made = [(n, int(dealt[lo]), np.ascontiguousarray(keys[lo:hi].T).tobytes(), counts[lo:hi].astype(np.uint32).tobytes()) for lo, hi in zip(cuts, [*cuts[1:], len(rows)])]
                    if made:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(list(x), kind) for x, kind in zip(zip(*made), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))], names=["n", "range", "keys", "counts"]
                        )

    return run


def _count(least: int):
    def run(group: pa.Table) -> pa.Table:
        n = group.column("n")[0].as_py()
        keys = np.ascontiguousarray(np.concatenate([np.frombuffer(blob, dtype=np.uint8).reshape(n * ID_BYTES, -1) for blob in group.column("keys").to_pylist()], axis=1).T)
        counts = np.frombuffer(b"".join(group.column("counts").to_pylist()), dtype=np.uint32)
        order = radix_order(keys)
        keys = keys[order]
        starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
        sums = np.add.reduceat(counts[order].astype(np.int64), starts)
        often = sums >= least
        ids = unpacked(keys[starts[often]], n)
        lists = pa.ListArray.from_arrays(np.arange(0, ids.size + 1, n, dtype=np.int32), pa.array(ids.reshape(-1)))
        return pa.table([lists, pa.array(sums[often])], names=["ids", "a"])

    return run


def frequent_phrases(docs: DataFrame, longest: int = 3, least: int = 10, chunk_bytes: int = CHUNK_BYTES, per_range: int = PER_RANGE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """lang, tokens: all words; id, lang, word, f: the dictionary; ids, a: phrases of 2 to longest words. Of the last two those with least occurrences."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    chunks = stored(texts.mapInArrow(_chunks(chunk_bytes), CHUNKS))
    sizes = chunks.groupBy("lang").agg(F.sum("tokens").alias("tokens"))
    each = chunks.select("lang", F.inline(F.arrays_zip("words", "counts")).alias("word", "n"))
    often = stored(each.groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= least))
    words = stored(running_sums(often, [F.col("lang"), F.col("word")], id=F.col("f")).select("id", "lang", "word", "f"))
    total = words.agg(F.sum("f")).first()[0] or 1
    asked = chunks.select("chunk", "lang", F.posexplode("words").alias("pos", "word")).join(words, ["lang", "word"])
    found = asked.groupBy("chunk").agg(F.collect_list(F.struct("pos", F.col("id").alias("at"), F.col("f"))).alias("found"))
    sent = chunks.select("chunk", "numbers").join(found, "chunk").select("numbers", "found")
    rows = sent.mapInArrow(_send(longest, total, -(-total // per_range)), "n int, range long, keys binary, counts binary")
    return sizes, words, stored(rows.groupBy("n", "range").applyInArrow(_count(least), COUNTED))


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, contained: int = 50, most: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of each language.

    A phrase is dropped where a longer one of at least `least` occurrences holds it and has `contained` percent of its occurrences.
    """
    sizes, words, phrases = frequent_phrases(docs, longest, least)
    parts = stored(phrases.unionByName(words.select(F.array("id").alias("ids"), F.col("f").alias("a"))))
    n = F.size("ids")
    cuts = phrases.select("ids", "a", F.explode(F.sequence(F.lit(1), n - 1)).alias("k"))
    cuts = cuts.select("*", F.slice("ids", 1, F.col("k")).alias("left"), F.slice("ids", F.col("k") + 1, n - F.col("k")).alias("right"))
    of = lambda side, name: parts.select(F.col("ids").alias(side), F.col("a").alias(name))
    both = cuts.join(of("left", "l"), "left").join(of("right", "r"), "right")
    wide = "cast({} as decimal(19, 0))"
    score = F.expr(f"(cast(1000000 as decimal(7, 0)) * ({wide.format('a')} * {wide.format('a')})) div ({wide.format('l')} * {wide.format('r')})")
    best = both.groupBy("ids", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    # every shorter phrase in a longer one, by length and start
    size, start = F.explode(F.sequence(F.lit(2), n - 1)).alias("size"), F.explode(F.sequence(F.lit(1), n - F.col("size") + 1)).alias("start")
    inner = phrases.where(n > 2).select("ids", "a", size).select("ids", "a", "size", start).select(F.expr("slice(ids, start, size)").alias("ids"), F.col("a").alias("longer"))
    left = best.join(inner.groupBy("ids").agg(F.max("longer").alias("longer")), "ids", "left").where(F.coalesce(F.col("longer") * 100 < F.col("a") * contained, F.lit(True)))
    spelt = left.select("ids", "a", "cut", F.posexplode("ids").alias("at", "id")).join(words.select("id", "lang", "word"), "id")
    spelt = spelt.groupBy("ids", "a", "cut").agg(F.first("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("at", "word"))).alias("words"))
    phrase = F.array_join(F.transform("words", lambda w: w["word"].cast("string")), " ")
    flat = spelt.select("lang", phrase.alias("phrase"), "a", "cut.l", "cut.r", "cut.score")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("long")
    top = flat.withColumn("rank", rank).where(F.col("rank") <= most)
    return top.join(sizes.select("lang", F.col("tokens").alias("n")), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark, sf_dir):
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text"))


SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0b\x0c\r]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS ws FROM p),
g AS (SELECT lang, unnest(list_transform(range(1, len(ws) + 1), lambda i: ws[i])) AS phrase, 1 AS k FROM w
      UNION ALL SELECT lang, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])), 2 FROM w
      UNION ALL SELECT lang, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])), 3 FROM w),
f AS MATERIALIZED (SELECT lang, phrase, k, count(*)::BIGINT AS a, string_split(phrase, ' ') AS ws FROM g GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
cuts AS (SELECT lang, phrase, a, ws, 1 AS cut, ws[1] AS lp, array_to_string(ws[2:], ' ') AS rp FROM f WHERE k > 1
         UNION ALL SELECT lang, phrase, a, ws, 2, array_to_string(ws[1:2], ' '), ws[3] FROM f WHERE k = 3),
scored AS (SELECT c.lang, c.phrase, c.a, c.cut, x.a AS l, y.a AS r, ((1000000::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a))::BIGINT AS score
           FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.lp JOIN f y ON y.lang = c.lang AND y.phrase = c.rp),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_ AS (SELECT lang, phrase, max(a) AS longer FROM (
           SELECT lang, array_to_string(ws[1:2], ' ') AS phrase, a FROM f WHERE k = 3
           UNION ALL SELECT lang, array_to_string(ws[2:3], ' '), a FROM f WHERE k = 3) GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN inner_ i USING (lang, phrase) WHERE i.longer IS NULL OR 100 * i.longer < 50 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
