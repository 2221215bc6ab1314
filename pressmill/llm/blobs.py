"""Columns of many small records as one binary value, so that shuffles move few and compact rows."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import NULL_ID

#: What a task holds of the text at once, in bytes; a longer document is a chunk of its own.
CHUNK_BYTES = 2_000_000


def pack(fields: dict, rows: np.ndarray, columns: dict) -> bytes:
    """The chosen rows of the columns, one column after the other."""
    return b"".join(np.ascontiguousarray(columns[name][rows], dtype=kind).tobytes() for name, kind in fields.items())


def unpack(fields: dict, blobs: list[bytes]) -> dict:
    width = sum(np.dtype(kind).itemsize for kind in fields.values())
    parts: dict = {name: [] for name in fields}
    for blob in blobs:
        n, at = len(blob) // width, 0
        for name, kind in fields.items():
            parts[name].append(np.frombuffer(blob, dtype=kind, count=n, offset=at))
            at += n * np.dtype(kind).itemsize
    return {name: np.concatenate(parts[name]) if parts[name] else np.zeros(0, dtype=kind) for name, kind in fields.items()}


def by_bucket(buckets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket with the positions it holds, in their order."""
    order = np.argsort(buckets, kind="stable")
    ends = np.flatnonzero(np.diff(buckets[order])) + 1
    for rows in np.split(order, ends):
        if len(rows):
            yield int(buckets[rows[0]]), rows


def text_chunks(batches, id_name: str = "doc_id", limit: int = CHUNK_BYTES):
    """From Arrow batches (doc_id, text as binary, ...): ids, all bytes together, the texts' offsets, the rows' table."""
    for batch in batches:
        column = pa.array(batch.column("text")).cast(pa.large_binary()).fill_null(b"")
        ids = batch.column(id_name).fill_null(NULL_ID).to_numpy(zero_copy_only=False)
        n, (_, offsets, data) = len(column), column.buffers()
        if not n:
            continue
        offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
        data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
        i = 0
        while i < n:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
            j = min(j, n)
            yield ids[i:j], data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], batch.slice(i, j - i)
            i = j


def sort_runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by the keys (first key first), and in that order where a new value of all of them begins."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), dtype=bool)
    if len(order):
        same = np.ones(len(order) - 1, dtype=bool)
        for key in keys:
            sorted_key = key[order]
            same &= sorted_key[1:] == sorted_key[:-1]
        new[1:] = ~same
    return order, new
