"""Content-defined anchors: the sparse positions at which repeated windows are looked up.

A window is a fixed number of consecutive symbols (bytes or words) of one document; its anchor
is the leftmost of its grams with the least hash, so equal windows have equal anchors at equal
offsets wherever they stand. Consecutive windows that share an anchor form a run, and a window can
repeat only where its anchor's gram repeats. Runs, not windows, are what gets shuffled.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blobs import text_chunks

U = np.uint64
#: A gram of more contexts than this is heavy; contexts are counted on one in SAMPLED of them, by a hash.
CROWDED, SAMPLED = 4096, 64
#: The heavy grams that every task is told, at most; it bounds what travels to them, 8 bytes each.
MOST_HEAVY = 1 << 16
_MULT = 0x9E3779B97F4A7C15
_POS_BITS = 24
#: Symbols a chunk may hold: positions are packed into the low bits of gram hashes.
MAX_SYMBOLS = 1 << _POS_BITS
_powers: dict[str, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x ^= x >> U(33)
    x = x * U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(33)
    return x


#: A random symbol for each byte value.
BYTE_SYMBOLS = mixed(np.arange(1, 257, dtype=U) * U(0xD1342543DE82EF95))


def _power(n: int, inverse: bool) -> np.ndarray:
    name = "inverse" if inverse else "straight"
    if name not in _powers or len(_powers[name]) < n:
        base = np.full(max(n, 1 << 16), pow(_MULT, -1, 1 << 64) if inverse else _MULT, dtype=U)
        base[0] = 1
        _powers[name] = np.multiply.accumulate(base)
    return _powers[name][:n]


class Rolling:
    """Hashes of any spans of a symbol sequence from one prefix sum (polynomial modulo 2**64)."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self.prefix = np.zeros(n + 1, dtype=U)
        np.cumsum(symbols * _power(n, False), out=self.prefix[1:])
        self.inverse = _power(n + 1, True)

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.prefix[ends] - self.prefix[starts]) * self.inverse[starts])

    def grams(self, size: int) -> np.ndarray:
        n = len(self.prefix) - size
        return mixed((self.prefix[size:] - self.prefix[:n]) * self.inverse[:n]) if n > 0 else np.zeros(0, dtype=U)


def runs(rolling: Rolling, bounds: np.ndarray, window: int, gram: int):
    """start, count, anchor, key of the runs of windows; bounds are the documents' offsets, last one included."""
    n = len(rolling.prefix) - 1
    if n < window:
        return tuple(np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.int64, U))
    grams = rolling.grams(gram)
    least = (grams >> U(_POS_BITS) << U(_POS_BITS)) | np.arange(len(grams), dtype=U)
    width, span = window - gram + 1, 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    where = (least & U(MAX_SYMBOLS - 1)).astype(np.int64)
    broken = np.zeros(len(where) + 1, dtype=np.int32)
    inner = np.unique(bounds[1:-1])
    np.add.at(broken, np.clip(inner - window + 1, 0, len(where)), 1)
    np.add.at(broken, np.clip(inner, 0, len(where)), -1)
    valid = np.cumsum(broken[:-1]) == 0
    change = np.empty(len(where), dtype=bool)
    change[0] = True
    np.not_equal(where[1:], where[:-1], out=change[1:])
    change[1:] |= valid[1:] & ~valid[:-1]
    first = np.flatnonzero(change & valid)
    stop = np.flatnonzero(change | ~valid)
    last = np.append(stop, len(where))[np.searchsorted(stop, first, side="right")]
    anchor = where[first]
    return first, last - first, anchor, grams[anchor]


def heavy_grams(texts: DataFrame, found) -> np.ndarray:
    """Keys of the grams that stand in very many different contexts, ascending; found(data, offsets) gives (key, content) of a chunk's runs.

    It only decides how windows are dealt out: those of a heavy gram one by one, by their own hash, so that they
    do not meet in one task. Both ways find the same repeats.
    """

    def run(batches):
        for _, data, offsets, _ in text_chunks(batches):
            parts = [np.unique(np.stack([k, c])[:, c % U(SAMPLED) == 0], axis=1) for k, c in found(data, offsets)]
            pairs = np.unique(np.concatenate(parts, axis=1), axis=1) if parts else np.zeros((2, 0), dtype=U)
            yield pa.record_batch([pa.array(pairs[0].view(np.int64)), pa.array(pairs[1].view(np.int64))], names=["key", "content"])

    contexts = texts.mapInArrow(run, "key long, content long").distinct().groupBy("key").agg(F.count("*").alias("n"))
    rows = contexts.where(F.col("n") > CROWDED // SAMPLED).orderBy(F.desc("n"), "key").limit(MOST_HEAVY).select("key").collect()
    return np.sort(np.array([r["key"] for r in rows], dtype=np.int64).view(U))
