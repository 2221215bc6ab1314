"""Substring removal on a compacted de Bruijn graph of word k-mers.

Edges of the graph are windows of `window` consecutive words, nodes the window - 1 words that two
windows share. A word goes if a window that covers it also starts in a document of smaller doc_id.

1. Windows travel in runs that share an anchor gram (see anchors.py); equal runs of a task's
   own documents are combined first, so a passage that a third of all documents hold arrives once per
   task. Per bucket of grams, edges found in two documents stay, each with its first source
   (document, position), and edges that follow each other in copy and source alike compact to segments.
   The windows of grams with very many contexts (see heavy_grams) are dealt out one by one, by their own hash.
2. Segments whose end node is the next one's begin node, and whose sources continue too, are joined to
   nonbranching paths: the source coordinates decide whether a path goes on or branches.
3. Paths are joined with the documents, as copies and as sources. The copies' words are cut out. Copy and source each
   hash the words that stand at their coordinates, and the totals of both sides must agree; if two different windows
   were ever taken for one, all is done again with other hashes, TRIES times at most.

Edge cases: null text has no words; texts of fewer words lose nothing; a null doc_id is smaller
than all others; rows that share a doc_id are told apart by a 64-bit hash of their text, and do not
remove each other's words; very long documents are worked on in pieces. Extra columns are ignored.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .anchors import U, Rolling, heavy_grams, mixed, runs
from .blobs import by_bucket, pack, sort_runs, text_chunks, unpack
from .common import NULL_ID, shuffle_partitions, stored
from .suffix_dedup import _blob_batch, _blobs, _tagged, text_tags
from .words import word_bounds, word_hashes

GRAM = 5
#: How often all is done with other hashes before an error; two windows out of all are alike in one try in many millions.
TRIES = 4
#: Words of a document that are worked on at once.
PIECE = 1 << 20
#: Bytes of a window's hash that travel within runs; windows dealt by their own hash carry all eight.
SHORT = 6
SEGMENT = {"doc": np.int64, "tag": np.int64, "start": np.int32, "size": np.int16, "source": np.int64, "stag": np.int64, "at": np.int32}
RUN = {"key": U, "doc": np.int64, "tag": np.int64, "start": np.int32, "size": np.int16, "turn": np.int16}
EDGE = {"print": U, "doc": np.int64, "tag": np.int64, "start": np.int32}
SEGMENTS_KIND, RUNS_KIND, EDGES_KIND = range(3)
OUT = "doc long, tag long, start int, size int, source long, stag long, at int"


def _expand(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window of each run: the run's number and the window's place in it."""
    which = np.repeat(np.arange(len(start)), size)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)


def _pieces(data: np.ndarray, offsets: np.ndarray, window: int, seed: int):
    """The hashed words of a chunk, its documents' bounds in words, and where the words begin in their document if that is cut."""
    starts, ends, bounds = word_bounds(data, offsets)
    symbols = word_hashes(data, starts, ends)
    symbols = mixed(symbols + U(seed)) if seed else symbols
    if len(symbols) <= PIECE or len(bounds) > 2:
        yield Rolling(symbols), bounds, 0
        return
    for at in range(0, len(symbols), PIECE - window + 1):
        part = symbols[at : at + PIECE]
        yield Rolling(part), np.array([0, len(part)]), at


def _keys(window: int, seed: int):
    """For heavy_grams: key and content of a chunk's runs."""

    def found(data, offsets):
        for rolling, bounds, _ in _pieces(data, offsets, window, seed):
            start, count, _, key = runs(rolling, bounds, window, GRAM)
            yield key, rolling.spans(start, start + count + window - 1)

    return found


def _map_runs(window: int, buckets: int, heavy: np.ndarray, seed: int):
    def run(batches):
        for ids, data, offsets, _ in text_chunks(batches):
            tags = text_tags(data, offsets)
            found = []
            for rolling, bounds, at in _pieces(data, offsets, window, seed):
                found += _run_blobs(rolling, bounds, at, ids, tags, window, buckets, heavy)
            if found:
                yield _blob_batch(found)

    return run


def _run_blobs(rolling, bounds, first_word, ids, tags, window, buckets, heavy) -> list:
    start, count, anchor, key = runs(rolling, bounds, window, GRAM)
    content = rolling.spans(start, start + count + window - 1)
    row = np.searchsorted(bounds, start, side="right") - 1
    columns = {"key": key, "doc": ids[row], "tag": tags[row], "start": (start - bounds[row] + first_word).astype(np.int32), "size": count.astype(np.int16), "turn": (anchor - start).astype(np.int16)}
    order, new = sort_runs(key, content)
    order = order[np.lexsort((columns["start"][order], columns["doc"][order], np.cumsum(new)))]
    later, found = _known(columns, order, new, count, buckets)
    keep = np.sort(order[~later])
    prints = rolling.grams(window)
    many = np.isin(key[keep], heavy) if len(heavy) else np.zeros(len(keep), dtype=bool)
    thin, thick = keep[~many], keep[many]
    for bucket, rows in by_bucket((key[thin] >> U(32)).astype(np.int64) % buckets):
        rows = thin[rows]
        which, shift = _expand(start[rows], count[rows])
        short = np.ascontiguousarray(prints[start[rows][which] + shift]).view(np.uint8).reshape(-1, 8)[:, :SHORT]
        found.append((bucket, RUNS_KIND, pack(RUN, rows, columns), np.ascontiguousarray(short).tobytes()))
    if len(thick):
        which, shift = _expand(start[thick], count[thick])
        edges = {"print": prints[start[thick][which] + shift], "doc": columns["doc"][thick][which], "tag": columns["tag"][thick][which], "start": (columns["start"][thick][which] + shift).astype(np.int32)}
        order, new = sort_runs(edges["print"], edges["doc"], edges["start"])
        first_print = np.append(True, edges["print"][order][1:] != edges["print"][order][:-1])
        again, more = _known(edges, order, first_print, np.ones(len(order), dtype=np.int64), buckets)
        found += more
        once = np.sort(order[~again])
        found += [(b, EDGES_KIND, pack(EDGE, once[rows], edges)) for b, rows in by_bucket((edges["print"][once] >> U(32)).astype(np.int64) % buckets)]
    return found


def _known(columns: dict, order: np.ndarray, new: np.ndarray, count: np.ndarray, buckets: int) -> tuple[np.ndarray, list]:
    """Rows in order whose group's first stands in a smaller document, and these as a blob of segments."""
    first = order[np.flatnonzero(new)][np.cumsum(new) - 1] if len(order) else order
    later = columns["doc"][order] > columns["doc"][first]
    gone, source = order[later], first[later]
    if not len(gone):
        return later, []
    made = {"doc": columns["doc"][gone], "tag": columns["tag"][gone], "start": columns["start"][gone], "size": count[gone], "source": columns["doc"][source], "stag": columns["tag"][source], "at": columns["start"][source]}
    where = int(mixed(np.array([columns["doc"][gone[0]]]).astype(U))[0] % U(buckets))
    return later, [(where, SEGMENTS_KIND, pack(SEGMENT, np.arange(len(gone)), made))]


def _judge(table: pa.Table) -> pa.Table:
    columns = unpack(RUN, _blobs(table, RUNS_KIND))
    body = np.frombuffer(b"".join(_blobs(table, RUNS_KIND, "body")), dtype=np.uint8).reshape(-1, SHORT)
    out = [unpack(SEGMENT, _blobs(table, SEGMENTS_KIND))]
    if len(body):
        order, new = sort_runs(columns["key"])
        group = np.empty(len(order), dtype=np.int64)
        group[order] = np.cumsum(new) - 1
        firsts = np.flatnonzero(new)
        docs = columns["doc"][order]
        several = np.minimum.reduceat(docs, firsts) != np.maximum.reduceat(docs, firsts)
        which, shift = _expand(columns["start"], columns["size"])
        use = several[group[which]]
        which, shift = which[use], shift[use]
        prints = np.zeros((len(which), 8), dtype=np.uint8)
        prints[:, :SHORT] = body[use]
        place, turn = columns["start"][which] + shift, columns["turn"][which] - shift
        out.append(_segments((prints.view(U).ravel(), turn, group[which]), columns["doc"][which], columns["tag"][which], place, which))
    edges = unpack(EDGE, _blobs(table, EDGES_KIND))
    if len(edges["print"]):
        out.append(_segments((edges["print"],), edges["doc"], edges["tag"], edges["start"], np.arange(len(edges["print"]))))
    both = {name: np.concatenate([np.asarray(p[name], dtype=np.int64) for p in out]) for name in SEGMENT}
    kinds = {"doc": pa.int64(), "tag": pa.int64(), "start": pa.int32(), "size": pa.int32(), "source": pa.int64(), "stag": pa.int64(), "at": pa.int32()}
    return pa.table({name: pa.array(both[name], kind) for name, kind in kinds.items()})


def _segments(keys: tuple, doc, tag, place, run) -> dict:
    """Edges alike in all keys are one; those of a document after their first one's are compacted to segments."""
    edges = np.lexsort((tag, place, doc, *keys))
    same = np.ones(max(len(edges) - 1, 0), dtype=bool)
    for key in keys:
        same &= key[edges][1:] == key[edges][:-1]
    new = np.append(True, ~same)[: len(edges)]
    first = np.empty(len(edges), dtype=np.int64)
    if len(edges):
        first[edges] = edges[np.flatnonzero(new)][np.cumsum(new) - 1]
    hit = np.flatnonzero(doc > doc[first])
    source, stag, at, own, here = doc[first[hit]], tag[first[hit]], place[first[hit]], run[hit], place[hit]
    # consecutive edges of a run whose sources continue are one segment
    on = np.zeros(len(hit), dtype=bool)
    on[1:] = (own[1:] == own[:-1]) & (here[1:] == here[:-1] + 1) & (source[1:] == source[:-1]) & (stag[1:] == stag[:-1]) & (at[1:] == at[:-1] + 1)
    begin = np.flatnonzero(~on)
    return {"doc": doc[hit][begin], "tag": tag[hit][begin], "start": here[begin], "size": np.diff(np.append(begin, len(hit))), "source": source[begin], "stag": stag[begin], "at": at[begin]}


def repeated_segments(docs: DataFrame, window: int = 13, seed: int = 0) -> DataFrame:
    buckets = 4 * shuffle_partitions(docs.sparkSession)
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    heavy = heavy_grams(texts, _keys(window, seed))
    return texts.mapInArrow(_map_runs(window, buckets, heavy, seed), "bucket int, kind int, data binary, body binary").groupBy("bucket").applyInArrow(_judge, OUT)


def repeated_paths(docs: DataFrame, window: int = 13, seed: int = 0) -> DataFrame:
    """doc, tag, start, size (windows), source, stag, at: maximal spans repeated from one earlier place."""
    places = Window.partitionBy("doc", "tag").orderBy("start", "source", "at")
    end, before = F.col("start") + F.col("size"), F.lag(F.col("start") + F.col("size")).over(places)
    goes_on = (before == F.col("start")) & (F.lag(F.col("at") + F.col("size")).over(places) == F.col("at"))
    goes_on &= (F.lag("source").over(places) == F.col("source")) & (F.lag("stag").over(places) == F.col("stag"))
    steps = repeated_segments(docs, window, seed).withColumn("end", end).withColumn("step", F.when(goes_on, 0).otherwise(1))
    numbered = steps.withColumn("path", F.sum("step").over(places.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("doc", "tag", "path").agg(
        F.min("start").alias("start"), (F.max("end") - F.min("start")).alias("size"), F.min("source").alias("source"), F.min("stag").alias("stag"), F.min("at").alias("at")
    )


def _span_sums(words: list[bytes], start, size, times, keys, window: int) -> np.ndarray:
    """Two sums, modulo 2**32, over the spans: a hash of their words, by a number that stands for the source's place, as often as told."""
    total = np.zeros(2, dtype=U)
    for a, n, m, key in zip(start.tolist(), size.tolist(), times.tolist(), keys.tolist()):
        digest = np.frombuffer(xxhash.xxh3_128_digest(b" ".join(words[a : a + n + window - 1])), dtype=U)
        total += digest * U(key | 1) * U(m)
    return (total & U(0xFFFFFFFF)).astype(np.int64)


def _place_key(source, stag, at, size) -> np.ndarray:
    return mixed(mixed(source.astype(U) + stag.astype(U) * U(0x9E3779B97F4A7C15)) + at.astype(U) * U(0xD1342543DE82EF95) + size.astype(U))


def _map_cut(window: int, with_text: bool):
    def run(batches):
        for ids, data, offsets, rows in text_chunks(batches):
            paths, asked = rows.column("paths"), rows.column("asked")
            tags = rows.column("_tag").to_numpy(zero_copy_only=False)
            n_words, n_removed, kept, sums = [], [], [], []
            for i in range(len(ids)):
                words = data[offsets[i] : offsets[i + 1]].tobytes().split()
                n_words.append(len(words))
                check, left = np.zeros(2, dtype=np.int64), words
                if asked[i].is_valid:
                    at, size, n = (asked[i].values.field(k).to_numpy() for k in ("at", "size", "n"))
                    key = _place_key(np.full(len(at), ids[i]), np.full(len(at), tags[i]), at, size)
                    check -= _span_sums(words, at, size, n, key, window)
                if paths[i].is_valid:
                    start, size, source, stag, at = (paths[i].values.field(k).to_numpy() for k in ("start", "size", "source", "stag", "at"))
                    check += _span_sums(words, start, size, np.ones_like(size), _place_key(source, stag, at, size), window)
                    marks = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(marks, start, 1)
                    np.add.at(marks, start + size + window - 1, -1)
                    left = [words[k] for k in np.flatnonzero(np.cumsum(marks[:-1]) <= 0)]
                n_removed.append(n_words[-1] - len(left))
                body = b" ".join(left)
                kept.append(body if with_text else hashlib.sha256(body).hexdigest())
                sums.append(check)
            checks = np.array(sums).reshape(-1, 2)
            yield pa.record_batch(
                [pa.array(ids, pa.int64()), pa.array(tags), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary() if with_text else pa.string()), pa.array(checks[:, 0]), pa.array(checks[:, 1])],
                names=["_doc", "_tag", "n_words", "n_removed", "kept" if with_text else "kept_sha256", "check_a", "check_b"],
            )

    return run


def remove_repeated_words(docs: DataFrame, window: int = 13, with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words (or only their SHA-256), a row for each row of docs."""
    last = "kept binary" if with_text else "kept_sha256 string"
    schema = f"_doc long, _tag long, n_words long, n_removed long, {last}, check_a long, check_b long"
    for seed in range(TRIES):
        tagged, paths = _tagged(docs.select("doc_id", "text")), stored(repeated_paths(docs, window, seed))
        cuts = paths.groupBy("doc", "tag").agg(F.collect_list(F.struct("start", "size", "source", "stag", "at")).alias("paths"))
        # however many copies a passage has, its source is asked for it once
        asked = paths.groupBy("source", "stag", "at", "size").agg(F.count("*").alias("n"))
        asked = asked.groupBy(F.col("source").alias("doc"), F.col("stag").alias("tag")).agg(F.collect_list(F.struct("at", "size", "n")).alias("asked"))
        wanted = cuts.join(asked, ["doc", "tag"], "full")
        joined = tagged.join(wanted, (tagged["_doc"] == wanted["doc"]) & (tagged["_tag"] == wanted["tag"]), "left")
        out = stored(joined.select("doc_id", F.col("text").cast("binary").alias("text"), "_tag", "paths", "asked").mapInArrow(_map_cut(window, with_text), schema))
        totals = out.groupBy("_doc", "_tag").agg(*(F.first(c).cast("decimal(20,0)").alias(c) for c in ("check_a", "check_b"))).agg(F.sum("check_a"), F.sum("check_b")).first()
        if all((x or 0) % (1 << 32) == 0 for x in totals):
            return out.select(F.when(F.col("_doc") != NULL_ID, F.col("_doc")).alias("doc_id"), "n_words", "n_removed", last.split()[0])
    raise RuntimeError("copies and their sources differ whatever the hashes")


def op2_substring_dedup(spark, sf_dir):
    return remove_repeated_words(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), with_text=False)
