"""Substring removal with a logarithmic family of sparse suffix arrays.

Every byte covered by a string of `window` bytes that also starts earlier (in a smaller doc_id, or
earlier in the same document) is removed. Suffixes are looked up at content-defined anchors (see
anchors.py), about one position in forty, which loses no match of `window` bytes.

1. Each task groups the runs of its own documents and sends only the first of equal runs on, so a
   passage that a third of all documents share arrives once per task. Per bucket of anchor grams,
   later runs equal to an earlier one (by a 128-bit print of their bytes) are spans to remove at once. A gram found
   with one content only cannot repeat. The windows of grams with very many contexts (see heavy_grams) are
   dealt out one by one, by their own 128-bit print, so that a common phrase does not meet in one task.
2. Runs that share a gram but differ somewhere are fetched as text. Per bucket they are taken in
   batches in document order: a batch gets its suffix array, sorted by the bytes themselves, is merge-scanned against
   the levels that exist, and levels of like size merge, so each suffix is merged a logarithmic number of
   times. Suffixes count as equal only if all their bytes are.
3. Spans are unioned per document and cut out.

Edge cases: null text is empty; texts shorter than the window lose nothing; a null doc_id comes
before all others; rows that share doc_id and text are one occurrence and get one result each;
rows that share doc_id but not text are told apart by a 64-bit hash, and the earlier start counts; very long
documents are worked on in pieces. Extra columns pass through.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import BYTE_SYMBOLS, U, Rolling, heavy_grams, mixed, runs
from .blobs import by_bucket, pack, sort_runs, text_chunks, unpack
from .common import NULL_ID, shuffle_partitions, stored

GRAM = 24
#: Suffixes that a batch of the index holds.
BATCH = 1 << 16
SPAN = {"doc": np.int64, "tag": np.int64, "start": np.int32, "size": np.int32}
RUN = {"key": U, "content": U, "check": U, "doc": np.int64, "tag": np.int64, "start": np.int32, "size": np.uint16}
WINDOW = {"print": U, "check": U, "doc": np.int64, "tag": np.int64, "start": np.int32}
#: Symbols of a second hash, so that a print of both has 128 bits.
CHECK_SYMBOLS = mixed(BYTE_SYMBOLS + U(0x5851F42D4C957F2D))
BLOB = "bucket int, kind int, data binary, body binary"
SPANS_KIND, RUNS_KIND, REGIONS_KIND, WINDOWS_KIND = range(4)
OUT = "doc long, tag long, start int, size int, gram long"


def _slices(data: np.ndarray, offsets: np.ndarray, limit: int = 4_000_000, overlap: int = 0):
    """The chunk in pieces that positions can be packed for; only a single giant document takes several."""
    if len(data) <= limit:
        yield 0, data, offsets
        return
    step = limit - overlap
    for at in range(0, len(data), step):
        yield at, data[at : at + limit], np.array([0, min(limit, len(data) - at)])


def _later(doc, start, first_doc, first_start):
    return (doc > first_doc) | ((doc == first_doc) & (start > first_start))


def _first_of_each(columns: dict, *keys: str):
    """Rows in order of the keys and then of appearance in the corpus; for each row its group's first; is it later than that."""
    order, _ = sort_runs(*(columns[k] for k in keys), columns["doc"], columns["start"], columns["tag"])
    same = np.ones(max(len(order) - 1, 0), dtype=bool)
    for k in keys:
        same &= columns[k][order][1:] == columns[k][order][:-1]
    new = np.append(True, ~same)[: len(order)]
    first = order[np.flatnonzero(new)][np.cumsum(new) - 1] if len(order) else order
    later = _later(columns["doc"][order], columns["start"][order], columns["doc"][first], columns["start"][first])
    return order, new, later


def _keys(window: int):
    """For heavy_grams: key and content of a chunk's runs."""

    def found(data, offsets):
        for _, piece, bounds in _slices(data, offsets, overlap=window - 1):
            rolling = Rolling(BYTE_SYMBOLS[piece])
            start, count, _, key = runs(rolling, bounds, window, GRAM)
            yield key, rolling.spans(start, start + count + window - 1)

    return found


def _map_runs(window: int, buckets: int, heavy: np.ndarray):
    def run(batches):
        for ids, data, offsets, rows in text_chunks(batches):
            tags = text_tags(data, offsets)
            found: list = []
            for at, piece, bounds in _slices(data, offsets, overlap=window - 1):
                rolling, second = Rolling(BYTE_SYMBOLS[piece]), Rolling(CHECK_SYMBOLS[piece])
                start, count, _, key = runs(rolling, bounds, window, GRAM)
                row = np.searchsorted(bounds, start, side="right") - 1
                size = count + window - 1
                columns = {"key": key, "doc": ids[row], "tag": tags[row], "start": (start + at - offsets[row]).astype(np.int32), "size": size}
                many = np.isin(key, heavy) if len(heavy) else np.zeros(len(key), dtype=bool)
                thin, thick = np.flatnonzero(~many), np.flatnonzero(many)
                whole = {name: column[thin] for name, column in columns.items()} | {"content": rolling.spans(start[thin], (start + size)[thin]), "check": second.spans(start[thin], (start + size)[thin])}
                found += _first_blobs(whole, ("key", "content", "check"), RUN, RUNS_KIND, buckets)
                if len(thick):
                    which, shift = _each_window(thick, count[thick])
                    begin = start[which] + shift
                    own = {"print": rolling.spans(begin, begin + window), "check": second.spans(begin, begin + window), "doc": columns["doc"][which], "tag": columns["tag"][which]}
                    own |= {"start": (columns["start"][which] + shift).astype(np.int32), "size": np.full(len(which), window)}
                    found += _first_blobs(own, ("print", "check"), WINDOW, WINDOWS_KIND, buckets)
            if found:
                yield _blob_batch(found)

    return run


def _each_window(runs_at: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window of each run: the run's number and the window's place in it."""
    which = np.repeat(runs_at, count)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)


def _first_blobs(columns: dict, keys: tuple, fields: dict, kind: int, buckets: int) -> list:
    """The first of each group by its first key's bucket, and later ones as spans to remove."""
    order, _, later = _first_of_each(columns, *keys)
    keep, gone = np.sort(order[~later]), np.sort(order[later])
    found = [(b, kind, pack(fields, keep[at], columns)) for b, at in by_bucket((columns[keys[0]][keep] >> U(32)).astype(np.int64) % buckets)]
    if len(gone):
        found.append((int(columns[keys[0]][gone[0]] % U(buckets)), SPANS_KIND, pack(SPAN, gone, columns)))
    return found


def _blob_batch(found: list) -> pa.RecordBatch:
    """Rows (bucket, kind, data[, body])."""
    return pa.record_batch(
        [
            pa.array([x[0] for x in found], pa.int32()),
            pa.array([x[1] for x in found], pa.int32()),
            pa.array([x[2] for x in found], pa.binary()),
            pa.array([x[3] if len(x) > 3 else None for x in found], pa.binary()),
        ],
        names=["bucket", "kind", "data", "body"],
    )


def _blobs(table: pa.Table, kind: int, name: str = "data") -> list[bytes]:
    return [b for b, k in zip(table[name].to_pylist(), table["kind"].to_pylist()) if k == kind]


def _span_table(spans: dict, gram=None) -> pa.Table:
    n = len(spans["doc"])
    return pa.table(
        {
            "doc": pa.array(spans["doc"].astype(np.int64)),
            "tag": pa.array(spans["tag"].astype(np.int64)),
            "start": pa.array(spans["start"].astype(np.int32)),
            "size": pa.array(spans["size"].astype(np.int32)),
            "gram": pa.array(gram.view(np.int64)) if gram is not None else pa.nulls(n, pa.int64()),
        }
    )


def _judge_runs(window: int):
    """Spans of runs and windows that an equal one precedes; requests (with their gram) for first runs whose gram has several contents."""

    def run(table: pa.Table) -> pa.Table:
        columns = unpack(RUN, _blobs(table, RUNS_KIND))
        order, new, later = _first_of_each(columns, "key", "content", "check")
        key = columns["key"][order]
        group = np.cumsum(np.append(True, key[1:] != key[:-1])[: len(key)]) - 1
        contents = np.bincount(group[new], minlength=1) if len(group) else np.zeros(1, dtype=int)
        ask = ~later & (contents[group] > 1) if len(group) else later
        windows = unpack(WINDOW, _blobs(table, WINDOWS_KIND))
        windows["size"] = np.full(len(windows["doc"]), window, dtype=np.int32)
        again, _, repeated = _first_of_each(windows, "print", "check")
        found = [{name: columns[name][order[later]] for name in SPAN}, _join_windows({name: windows[name][again[repeated]] for name in SPAN}), unpack(SPAN, _blobs(table, SPANS_KIND))]
        spans = {name: np.concatenate([f[name].astype(kind) for f in found]) for name, kind in SPAN.items()}
        return pa.concat_tables([_span_table(spans), _span_table({name: columns[name][order[ask]] for name in SPAN}, key[ask])])

    return run


def _map_regions(buckets: int):
    """Documents with their requests to blobs of the regions' texts."""

    def run(batches):
        for ids, data, offsets, rows in text_chunks(batches):
            asked = rows.column("asked")
            row = np.repeat(np.arange(len(ids)), np.diff(np.asarray(asked.offsets)))
            flat = asked.flatten()
            start, size, gram = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("start", "size", "gram"))
            columns = {"doc": ids[row], "tag": rows.column("tag").to_numpy(zero_copy_only=False)[row], "start": start, "size": size}
            begin, found = offsets[row] + start, []
            for bucket, at in by_bucket((gram.view(U) >> U(32)).astype(np.int64) % buckets):
                body = b"".join(data[b : b + s].tobytes() for b, s in zip(begin[at], size[at]))
                found.append((bucket, REGIONS_KIND, pack(SPAN, at, columns), body))
            if found:
                yield _blob_batch(found)

    return run


class SuffixLevels:
    """Suffix arrays of geometrically growing sizes over the suffixes of a text seen so far, each cut at `window` bytes.

    An array holds positions in the order of the bytes that stand there. Suffixes come in corpus order, so what a level holds
    is earlier.
    """

    def __init__(self, body: np.ndarray, window: int):
        padded = np.append(body, np.zeros(8, dtype=np.uint8))
        #: At each position its eight bytes as a number, in the order of the bytes.
        self.words = np.ndarray((len(body),), ">u8", padded, strides=(1,)).astype(U)
        self.steps = [*range(0, window - 8, 8), window - 8]
        self.levels: list[np.ndarray] = []

    def _word(self, at: np.ndarray) -> np.ndarray:
        return self.words[at]

    def sorted(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The order of suffixes by their bytes (of equal ones as given), and where in it a new one begins: ties go on to the next eight bytes."""
        order = np.argsort(self._word(at), kind="stable")
        word = self._word(at[order])
        new = np.append(True, word[1:] != word[:-1])[: len(order)]
        for step in self.steps[1:]:
            tied = np.flatnonzero(~(new & np.append(new[1:], True)[: len(new)]))
            if not len(tied):
                break
            group, word = np.cumsum(new)[tied], self._word(at[order[tied]] + step)
            by = np.lexsort((word, group))
            order[tied], word = order[tied][by], word[by]
            new[tied] |= np.append(True, (word[1:] != word[:-1]) | (group[1:] != group[:-1]))
        return order, new

    def _compare(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 for each pair of positions as the first suffix is less, equal or greater."""
        out, open_ = np.zeros(len(a), dtype=np.int8), np.arange(len(a))
        for step in self.steps:
            x, y = self._word(a[open_] + step), self._word(b[open_] + step)
            apart = x != y
            out[open_[apart]] = np.where(x[apart] < y[apart], -1, 1)
            open_ = open_[~apart]
            if not len(open_):
                break
        return out

    def _places(self, level: np.ndarray, at: np.ndarray) -> np.ndarray:
        """For each suffix the number of the level's suffixes that are less."""
        first, own = self._word(level), self._word(at)
        lo, hi = (np.searchsorted(first, own, side=side) for side in ("left", "right"))  # the rest only where the first eight bytes agree
        while len(open_ := np.flatnonzero(lo < hi)):
            mid = (lo[open_] + hi[open_]) // 2
            less = self._compare(level[mid], at[open_]) < 0
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]
        return lo

    def add(self, at: np.ndarray) -> np.ndarray:
        """Scans a batch (positions in corpus order) against all levels and adds it; for each suffix the position of an equal earlier one, or -1."""
        earlier, fresh = self.scan(at)
        self._insert(fresh)
        return earlier

    def scan(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What add() returns, and the suffix array of those that no level holds, each once."""
        order, new = self.sorted(at)
        first = order[new]
        once, earlier = at[first], np.full(len(first), -1, dtype=np.int64)
        for level in self.levels:
            where = np.minimum(self._places(level, once), len(level) - 1)
            hit = self._compare(level[where], once) == 0
            earlier[hit] = level[where[hit]]
        out = np.empty(len(at), dtype=np.int64)
        of = np.cumsum(new) - 1
        out[order] = np.where(earlier[of] >= 0, earlier[of], np.where(new, -1, once[of]))
        return out, once[earlier < 0]

    def merged(self, level: np.ndarray, fresh: np.ndarray) -> np.ndarray:
        return np.insert(level, self._places(level, fresh), fresh)

    def _insert(self, fresh: np.ndarray) -> None:
        while self.levels and len(self.levels[-1]) <= 2 * len(fresh):
            fresh = self.merged(self.levels.pop(), fresh)
        if len(fresh):
            self.levels.append(fresh)


def _windows_of(columns: dict, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the regions in corpus order: their region, start in the document and position in the regions' bytes."""
    order = np.lexsort((columns["tag"], columns["start"], columns["doc"]))
    begin = np.append(0, np.cumsum(columns["size"].astype(np.int64)))[:-1]
    which, shift = _each_window(order, columns["size"][order].astype(np.int64) - window + 1)
    return which, (columns["start"][which] + shift).astype(np.int32), begin[which] + shift


def _hits(columns: dict, which, starts, at, earlier, floor: int, window: int) -> dict:
    """Windows of which an equal one stands before `floor`, or at an earlier place of the regions (whose bytes begin at floor)."""
    place = np.zeros(int(at.max(initial=0)) + 1, dtype=np.int64)
    place[at] = np.arange(len(at))
    hits = np.flatnonzero(earlier >= 0)
    found = {"doc": columns["doc"][which[hits]], "tag": columns["tag"][which[hits]], "start": starts[hits], "size": np.full(len(hits), window, dtype=np.int32)}
    inside = earlier[hits] >= floor
    first = place[np.where(inside, earlier[hits] - floor, 0)]
    # regions of one place can meet here under two rows of one document: equal places are no repeats
    real = ~inside | _later(found["doc"], found["start"], columns["doc"][which[first]], starts[first])
    return {k: v[real] for k, v in found.items()}


def _repeats_in_regions(columns: dict, body: np.ndarray, window: int) -> dict:
    """Windows of the regions that an equal, earlier window precedes."""
    which, starts, at = _windows_of(columns, window)
    index, earlier = SuffixLevels(body, window), np.empty(len(at), dtype=np.int64)
    for lo in range(0, len(at), BATCH):
        earlier[lo : lo + BATCH] = index.add(at[lo : lo + BATCH])
    return _hits(columns, which, starts, at, earlier, 0, window)


def _join_windows(spans: dict) -> dict:
    """Overlapping or touching spans of a document as one, to send fewer rows on."""
    order = np.lexsort((spans["start"], spans["tag"], spans["doc"]))
    doc, tag, start = (spans[k][order] for k in ("doc", "tag", "start"))
    end = start.astype(np.int64) + spans["size"][order]
    new = np.append(True, (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (start[1:] > end[:-1]))[: len(doc)]
    firsts = np.flatnonzero(new)
    if not len(firsts):
        return spans
    ends = np.maximum.reduceat(end, firsts)
    return {"doc": doc[firsts], "tag": tag[firsts], "start": start[firsts], "size": (ends - start[firsts]).astype(np.int32)}


def _judge_regions(window: int):
    def run(table: pa.Table) -> pa.Table:
        body = np.frombuffer(b"".join(_blobs(table, REGIONS_KIND, "body")), dtype=np.uint8)
        return _span_table(_join_windows(_repeats_in_regions(unpack(SPAN, _blobs(table, REGIONS_KIND)), body, window)))

    return run


def text_tags(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The 64-bit hash of each text of a chunk, as Spark's xxhash64 makes it."""
    return np.array([xxhash.xxh64_intdigest(data[a:b].tobytes(), 42) for a, b in zip(offsets[:-1], offsets[1:])], dtype=U).astype(np.int64)


def _tagged(docs: DataFrame) -> DataFrame:
    """Texts as bytes with the 64-bit hash that tells rows of one doc_id apart, as text_tags() makes it."""
    body = F.coalesce(docs["text"], F.lit("")).cast("binary")
    return docs.withColumns({"_doc": F.coalesce(docs["doc_id"], F.lit(NULL_ID)), "_tag": F.xxhash64(body)})


def repeated_spans(docs: DataFrame, window: int = 100) -> DataFrame:
    """doc, tag, spans: for each document with repeats, the (start, size) byte spans to remove; they may overlap."""
    spark = docs.sparkSession
    buckets = 4 * shuffle_partitions(spark)
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    runs_found = texts.mapInArrow(_map_runs(window, buckets, heavy_grams(texts, _keys(window))), BLOB)
    judged = stored(runs_found.groupBy("bucket").applyInArrow(_judge_runs(window), OUT))
    asked = judged.where(F.col("gram").isNotNull()).groupBy("doc", "tag").agg(F.collect_list(F.struct("start", "size", "gram")).alias("asked"))
    tagged = _tagged(docs.select("doc_id", "text"))
    fetched = (
        tagged.join(asked, (tagged["_doc"] == asked["doc"]) & (tagged["_tag"] == asked["tag"]))
        .select(F.col("doc").alias("doc_id"), F.col("text").cast("binary").alias("text"), "tag", "asked")
    )
    more = fetched.mapInArrow(_map_regions(buckets), BLOB).groupBy("bucket").applyInArrow(_judge_regions(window), OUT)
    spans = judged.where(F.col("gram").isNull()).unionByName(more)
    return spans.groupBy("doc", "tag").agg(F.collect_list(F.struct("start", "size")).alias("spans"))


def cut(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[bytes, int, int]:
    """What is left, the number of bytes removed, and of maximal runs removed."""
    marks = np.zeros(len(data) + 1, dtype=np.int64)
    np.add.at(marks, start, 1)
    np.add.at(marks, start + size, -1)
    gone = np.cumsum(marks[:-1]) > 0
    edges = np.count_nonzero(gone[1:] & ~gone[:-1]) + (int(gone[0]) if len(gone) else 0)
    return data[~gone].tobytes(), int(gone.sum()), edges


def _map_cut(with_text: bool):
    def run(batches):
        for ids, data, offsets, rows in text_chunks(batches):
            spans = rows.column("spans")
            kept, n_removed, n_spans = [], [], []
            for i in range(len(ids)):
                body = data[offsets[i] : offsets[i + 1]]
                if spans[i].is_valid:
                    s = spans[i].values
                    left, removed, pieces = cut(body, s.field("start").to_numpy(), s.field("size").to_numpy())
                else:
                    left, removed, pieces = body.tobytes(), 0, 0
                kept.append(left if with_text else hashlib.sha256(left).hexdigest())
                n_removed.append(removed)
                n_spans.append(pieces)
            out = {"_doc": pa.array(ids, pa.int64()), "n_bytes": pa.array(np.diff(offsets), pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "n_spans": pa.array(n_spans, pa.int64())}
            yield pa.record_batch(out | ({"kept": pa.array(kept, pa.binary())} if with_text else {"kept_sha256": pa.array(kept, pa.string())}))

    return run


def remove_repeats(docs: DataFrame, window: int = 100, with_text: bool = True, spans: DataFrame | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the kept bytes (or only their SHA-256), a row for each row of docs.

    spans: what to remove, as repeated_spans or SuffixIndex.add give it; by default what repeats within docs.
    """
    tagged, spans = _tagged(docs.select("doc_id", "text")), repeated_spans(docs, window) if spans is None else spans
    joined = tagged.join(spans, (tagged["_doc"] == spans["doc"]) & (tagged["_tag"] == spans["tag"]), "left")
    last = "kept binary" if with_text else "kept_sha256 string"
    out = joined.select("doc_id", F.col("text").cast("binary").alias("text"), "spans").mapInArrow(_map_cut(with_text), f"_doc long, n_bytes long, n_removed long, n_spans long, {last}")
    doc_id = F.when(F.col("_doc") != NULL_ID, F.col("_doc")).alias("doc_id")
    return out.select(doc_id, *out.columns[1:])


def _map_all_regions(window: int, buckets: int):
    """Documents to blobs of the texts of all their runs; of equal runs of a task the first is sent and later ones are spans."""

    def run(batches):
        for ids, data, offsets, rows in text_chunks(batches):
            tags = text_tags(data, offsets)
            found: list = []
            for at, piece, bounds in _slices(data, offsets, overlap=window - 1):
                rolling, second = Rolling(BYTE_SYMBOLS[piece]), Rolling(CHECK_SYMBOLS[piece])
                start, count, _, key = runs(rolling, bounds, window, GRAM)
                row, size = np.searchsorted(bounds, start, side="right") - 1, count + window - 1
                columns = {"content": rolling.spans(start, start + size), "check": second.spans(start, start + size), "doc": ids[row], "tag": tags[row], "start": (start + at - offsets[row]).astype(np.int32), "size": size}
                order, _, later = _first_of_each(columns, "content", "check")
                keep, gone = np.sort(order[~later]), np.sort(order[later])
                for bucket, some in by_bucket((key[keep] >> U(32)).astype(np.int64) % buckets):
                    some = keep[some]
                    found.append((bucket, REGIONS_KIND, pack(SPAN, some, columns), b"".join(piece[a : a + n].tobytes() for a, n in zip(start[some], size[some]))))
                if len(gone):
                    found.append((int(key[gone[0]] % U(buckets)), SPANS_KIND, pack(SPAN, gone, columns)))
            if found:
                yield _blob_batch(found)

    return run


def _scan_levels(window: int, merging: list[int]):
    """A bucket's regions of a batch against its stored levels: spans to remove, and one new level, merged with those named."""

    def run(batch: pa.Table, stored_levels: pa.Table) -> pa.Table:
        parts = {n: (b, np.frombuffer(p, dtype=np.int32).astype(np.int64)) for n, b, p in zip(*(stored_levels[c].to_pylist() for c in ("level", "body", "places")))}
        bodies = [b for b, _ in parts.values()] + _blobs(batch, REGIONS_KIND, "body")
        begins = dict(zip(parts, np.append(0, np.cumsum([len(b) for b, _ in parts.values()])).tolist()))
        floor = sum(len(b) for b, _ in parts.values())
        body, columns = np.frombuffer(b"".join(bodies), dtype=np.uint8), unpack(SPAN, _blobs(batch, REGIONS_KIND))
        which, starts, at = _windows_of(columns, window)
        index = SuffixLevels(body, window)
        index.levels = [places + begins[n] for n, (_, places) in parts.items()]
        earlier, level = index.scan(at + floor)
        spans = [_hits(columns, which, starts, at, earlier, floor, window), unpack(SPAN, _blobs(batch, SPANS_KIND))]
        for n in merging:
            if n in parts:
                level = index.merged(parts[n][1] + begins[n], level)
        # of the bytes only those stay that a suffix of the level covers
        marks = np.zeros(len(body) + 1, dtype=np.int64)
        np.add.at(marks, level, 1)
        np.add.at(marks, level + window, -1)
        kept = np.cumsum(marks[:-1]) > 0
        places = (np.cumsum(kept) - 1)[level].astype(np.int32)
        bucket = (batch if len(batch) else stored_levels)["bucket"][0].as_py()
        found = _span_table(_join_windows({name: np.concatenate([s[name] for s in spans]).astype(SPAN[name]) for name in SPAN})).drop_columns(["gram"])
        n = len(found)
        own = pa.table({"bucket": pa.array([bucket], pa.int32()), "body": pa.array([body[kept].tobytes()], pa.binary()), "places": pa.array([places.tobytes()], pa.binary())})
        nothing = {"bucket": pa.nulls(n, pa.int32()), "body": pa.nulls(n, pa.binary()), "places": pa.nulls(n, pa.binary())}
        return pa.table({**{c: pa.concat_arrays([*found[c].chunks, pa.nulls(1, found[c].type)]) for c in found.column_names}, **{c: pa.concat_arrays([nothing[c], *own[c].chunks]) for c in own.column_names}})

    return run


class SuffixIndex:
    """Suffix arrays in tables, to which batches of documents are added one after the other, by any number of runs.

    A batch gets its suffix arrays, is merge-scanned against all levels there are, and what is new in it becomes a
    level; two levels of one rank merge to one of the next, so a suffix is merged a logarithmic number of times. Documents of
    later batches count as later, whatever their doc_id. Each step is one Spark job over the buckets of anchor grams;
    levels that were merged stay on disk until the folder is cleared.
    """

    def __init__(self, spark, folder: str, window: int = 100, buckets: int = 256):
        self.spark, self.folder, self.window, self.buckets = spark, folder.rstrip("/"), window, buckets

    def levels(self) -> list[tuple[int, str]]:
        """(rank, path) of the levels, the oldest first, as the last whole batch has left them."""
        files = self.spark._jvm.org.apache.hadoop.fs
        found = files.Path(self.folder).getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(files.Path(f"{self.folder}/state-*/_SUCCESS")) or []
        states = sorted(str(f.getPath().getParent()) for f in found)
        return [(r["rank"], r["path"]) for r in self.spark.read.parquet(states[-1]).orderBy("nth").collect()] if states else []

    def add(self, docs: DataFrame) -> DataFrame:
        """doc, tag, spans: what of these documents an earlier batch or an earlier place in this one holds; the index then holds them too."""
        levels, rank = self.levels(), 0
        merging = []
        while levels and len(merging) < len(levels) and levels[-1 - len(merging)][0] == rank:
            merging.append(len(levels) - 1 - len(merging))
            rank += 1
        schema = "bucket int, body binary, places binary, level int"
        old = self.spark.createDataFrame([], schema)
        for n, (_, path) in enumerate(levels):
            old = old.unionByName(self.spark.read.parquet(path).where("bucket is not null").select("bucket", "body", "places", F.lit(n).alias("level")))
        texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
        regions = texts.mapInArrow(_map_all_regions(self.window, self.buckets), BLOB)
        found = regions.groupBy("bucket").cogroup(old.groupBy("bucket")).applyInArrow(_scan_levels(self.window, merging), "doc long, tag long, start int, size int, bucket int, body binary, places binary")
        number = len(self.spark.read.parquet(f"{self.folder}/state-*").select("batch").distinct().collect()) if levels else 0
        path = f"{self.folder}/batch-{number:09d}"
        found.write.mode("overwrite").option("compression", "zstd").parquet(path)
        now = [x for n, x in enumerate(levels) if n not in merging] + [(rank, path)]
        self.spark.createDataFrame([(n, r, p, number) for n, (r, p) in enumerate(now)], "nth int, rank int, path string, batch int").coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/state-{number:09d}")
        return self.spark.read.parquet(path).where("doc is not null").groupBy("doc", "tag").agg(F.collect_list(F.struct("start", "size")).alias("spans"))


def op1_suffix_dedup(spark, sf_dir):
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), with_text=False)
