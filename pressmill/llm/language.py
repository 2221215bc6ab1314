"""Language identification by cross-parsing entropy.

A suffix automaton of labelled text per language parses a document greedily into longest phrases
that the language's text contains (Ziv-Merhav). The language needing the fewest phrases, each
weighed with the bits that point into its text, wins. Documents are parsed whole, in pieces of PIECE
letters that start phrases of their own, so that numpy can step through all pieces of a chunk together.

The classifier is fitted on a bounded sample of labelled rows: at most SAMPLE_BYTES per language, whole
texts of up to LONGEST bytes in the order of a hash (beginnings of longer ones, if a language has no others). Only this sample
travels to the tasks.

Edge cases: null text or text without a letter gives `und` with score 0, as does a table without labelled
rows; ties go to the language first by code point. A null lang is not learned from; a null doc_id counts
as the empty string where folds are made. Repeated rows get equal answers. Extra columns are ignored.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blobs import text_chunks

SAMPLE_BYTES, LONGEST = 24_000, 12_000
PIECE = 256
_MISS = 1 << 30


def fold(doc_id: Column, n: int) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def labelled_sample(docs: DataFrame, sample_bytes: int = SAMPLE_BYTES) -> dict[str, list[str]]:
    """Texts of each language, sample_bytes together at most, from rows with text and lang."""
    size, short = F.octet_length("text"), F.octet_length("text") <= LONGEST
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("lang", "text", (F.xxhash64("text", "doc_id") / F.lit(2.0**63)).alias("at"), short.alias("short"))
    per_text = rows.groupBy("lang").agg(F.count_if("short").alias("n"), F.avg(F.when(F.col("short"), size)).alias("size"), F.count("*").alias("all")).collect()
    # of each language's rows a share is read that holds about four times what is used
    share, lone = F.lit(None), [r["lang"] for r in per_text if not r["n"]]
    for r in per_text:
        wanted = 4 * max(64, sample_bytes / r["size"]) / r["n"] if r["n"] else 64 / r["all"]
        share = F.when(F.col("lang") == r["lang"], F.lit(-1 + 2 * min(1.0, wanted))).otherwise(share)
    # a language that has long texts only is learned from their beginnings
    rows = rows.where(F.col("short") | F.col("lang").isin(*lone)).withColumn("text", F.when(F.col("short"), F.col("text")).otherwise(F.substring("text", 1, LONGEST // 4)))
    sample: dict[str, list[str]] = {}
    used: dict[str, int] = {}
    for r in sorted(rows.where(F.col("at") <= share).collect(), key=lambda r: (r["lang"], r["at"], r["text"])):
        size = len(r["text"].encode())
        if used.get(r["lang"], 0) + size <= max(sample_bytes, size if r["lang"] not in used else 0):
            sample.setdefault(r["lang"], []).append(r["text"])
            used[r["lang"]] = used.get(r["lang"], 0) + size
    return sample


def _automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton; state 0 is the start."""
    to: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in symbols:
        state = len(to)
        to.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and symbol not in to[p]:
            to[p][symbol] = state
            p = link[p]
        if p >= 0:
            q = to[p][symbol]
            if length[p] + 1 == length[q]:
                link[state] = q
            else:
                copy = len(to)
                to.append(dict(to[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and to[p].get(symbol) == q:
                    to[p][symbol] = copy
                    p = link[p]
                link[q] = link[state] = copy
        last = state
    return to


#: A worker's model, by its sample.
_models: dict = {}


def _normal(data: np.ndarray, alphabet: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of lower-cased texts with runs of non-letters as one separator (0), and the texts' new offsets."""
    symbols = alphabet[data]
    keep = symbols != 0
    keep[1:] |= symbols[:-1] != 0
    keep[offsets[offsets < len(data)]] = True  # wherever a text stands in a chunk, it begins alike
    return symbols[keep], np.append(0, np.cumsum(keep))[offsets]


def _model(sample: tuple[tuple[str, tuple[str, ...]], ...]):
    """The model of a sample, which a worker keeps for its next task; that of another sample goes before a new one is made."""
    if sample not in _models:
        _models.clear()
        _models[sample] = _made_model(sample)
    return _models[sample]


def _made_model(sample: tuple[tuple[str, tuple[str, ...]], ...]):
    """Byte alphabet, and for each language its name, bits per phrase and transition table."""
    bodies = [(lang, "\n".join(texts).lower().encode()) for lang, texts in sample]
    seen = np.unique(np.frombuffer(b"".join(b for _, b in bodies), dtype=np.uint8))
    alphabet = np.zeros(256, dtype=np.int32)
    alphabet[ord("a") : ord("z") + 1] = np.arange(1, 27)
    high = seen[seen >= 0x80]
    alphabet[0x80:] = 27 + len(high)  # bytes that no sample holds
    alphabet[high] = 27 + np.arange(len(high))
    width = 29 + len(high)  # the last symbol pads: it stays in its state
    languages = []
    for lang, body in bodies:
        data = np.frombuffer(body, dtype=np.uint8)
        symbols, _ = _normal(data, alphabet, np.array([0, len(data)]))
        to = _automaton(symbols.tolist())
        begin = np.array([to[0].get(s, 0) for s in range(width)], dtype=np.int64)
        table = np.tile((begin * width + _MISS).astype(np.int32), (len(to), 1))
        for state, moves in enumerate(to):
            for symbol, target in moves.items():
                table[state, symbol] = target * width
        table[:, width - 1] = np.arange(len(to)) * width
        languages.append((lang, float(np.log2(max(len(symbols), 2))), table.ravel()))
    return alphabet, width, languages


def phrase_bits(data: np.ndarray, offsets: np.ndarray, model) -> np.ndarray:
    """Bits of the cross-parsing of each lower-cased text (rows) with each language (columns)."""
    alphabet, width, languages = model
    symbols, bounds = _normal(data, alphabet, offsets)
    sizes = np.diff(bounds)
    pieces = -(-sizes // PIECE)
    owner = np.repeat(np.arange(len(sizes)), pieces)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = bounds[owner] + number * PIECE
    length = np.minimum(PIECE, bounds[owner + 1] - begin) if len(owner) else begin
    out = np.zeros((len(sizes), len(languages)))
    for lo in range(0, len(owner), 8192):
        part = slice(lo, lo + 8192)
        grid = begin[part][None, :] + np.arange(PIECE)[:, None]
        steps = np.where(np.arange(PIECE)[:, None] < length[part][None, :], symbols[np.minimum(grid, len(symbols) - 1)], width - 1).astype(np.int32)
        for column, (_, bits, table) in enumerate(languages):
            state = np.zeros(steps.shape[1], dtype=np.int32)
            phrases = np.ones(steps.shape[1], dtype=np.int32)
            for step in steps:
                state += step
                np.take(table, state, out=state, mode="clip")
                phrases += state >> 30
                state &= _MISS - 1
            out[:, column] += np.bincount(owner[part], weights=phrases * bits, minlength=len(sizes))
    return out


def detect_language(docs: DataFrame, sample: dict[str, list[str]]) -> DataFrame:
    """All rows of docs with lang_pred, score and bits_per_letter (null for `und`)."""
    frozen = tuple((lang, tuple(texts)) for lang, texts in sorted(sample.items()))
    taken = {"lang_pred", "score", "bits_per_letter", "_original", "_known"}
    extra = [c for c in docs.columns if c not in taken and c != "text"]
    rows_in = docs.select(*extra, "text", F.coalesce(docs["text"].rlike(r"\p{L}"), F.lit(False)).alias("_known"))
    schema = rows_in.drop("text", "_known").schema.add("text", "string").add("lang_pred", "string").add("score", "double").add("bits_per_letter", "double")

    def lowered(batches):
        for b in batches:
            text = pc.if_else(b.column("_known"), pc.utf8_lower(b.column("text")), None)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in extra), b.column("text"), text, pa.nulls(b.num_rows, pa.int64())], names=[*extra, "_original", "text", "_none"])

    def run(batches):
        for _, data, offsets, rows in text_chunks(lowered(batches), "_none"):
            known = np.asarray(rows.column("text").is_valid()) & bool(frozen)
            pred, score, rate = np.full(len(known), "und", dtype=object), np.zeros(len(known)), np.full(len(known), np.nan)
            if known.any():
                model = _model(frozen)
                bits = phrase_bits(data, offsets, model)
                best = bits.argmin(axis=1)
                least = bits.min(axis=1)
                pred[known] = np.array([lang for lang, _, _ in model[2]], dtype=object)[best[known]]
                score[known] = (1 / np.exp2(-(bits - least[:, None])).sum(axis=1))[known]
                rate[known] = (least / np.maximum(np.diff(offsets), 1))[known]
            columns = [rows.column(k) for k in extra] + [rows.column("_original"), pa.array(pred, pa.string()), pa.array(score), pa.array(rate, pa.float64(), from_pandas=True)]
            yield pa.RecordBatch.from_arrays(columns, names=[*extra, "text", "lang_pred", "score", "bits_per_letter"])
        # a worker waits for its next task with the model and nothing else
        pa.default_memory_pool().release_unused()

    return rows_in.mapInArrow(run, schema)


def op5_language_id(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    sample = labelled_sample(docs.where(fold(docs["doc_id"], 4) != 2))
    found = detect_language(docs.select("doc_id", "text"), sample)
    return found.select("doc_id", (fold(found["doc_id"], 4) == 2).alias("held_out"), "lang_pred", "score")
