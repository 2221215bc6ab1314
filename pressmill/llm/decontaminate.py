"""Benchmark decontamination by pigeonhole edit matching.

A test item may differ from a passage in `k` edits, a share of its length. Cut into k + 1 pieces,
one piece at least must stand in the passage unchanged. An Aho-Corasick automaton of all
pieces finds these in one pass over each document, and Myers' bit-parallel distance verifies
the passage around each find. Items come to the tasks in blocks of bounded size, one after the other, each block
against all documents; documents are never shuffled.

Texts are compared case-folded and with white space as single spaces. Edge cases: null or empty texts
and items match nothing; items shorter than `min_chars` must match whole and unchanged, between word
ends; repeated rows of either table give rows each; an empty table gives an empty result. Extra columns are ignored.
"""

from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

ERROR_RATE = 0.08
MIN_CHARS = 40
#: Characters of items that a block holds about.
BLOCK_CHARS = 1_000_000
OUT = "doc_id long, item_id long, distance int, start int, end int"


def normal(text: str | None) -> str:
    return " ".join((text or "").casefold().split())


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """k + 1 parts of nearly equal length, with their offsets."""
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def best_match(item: str, text: str, masks: dict[str, int] | None = None) -> tuple[int, int]:
    """Least edit distance of the item to any substring of the text, and the end of the first such substring.

    Myers' recurrence, with one Python integer per bit vector of the item's length.
    """
    masks = masks or _masks(item)
    m = len(item)
    full, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for i, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph = minus | (full & ~(xh | plus))
        mh = plus & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph = (ph << 1) & full
        mh = (mh << 1) & full
        plus = mh | (full & ~(xv | ph))
        minus = ph & xv
        if score < best:
            best, end = score, i
    return best, end


def _masks(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


@lru_cache(maxsize=1)
def _automaton(items: tuple[tuple[int | None, str], ...], rate: float, min_chars: int):
    found: dict[str, list[tuple[int, int]]] = {}
    budgets = []
    for number, (_, item) in enumerate(items):
        budgets.append(int(len(item) * rate) if len(item) >= min_chars else 0)
        for offset, piece in pieces(item, budgets[-1]):
            found.setdefault(piece, []).append((number, offset))
    automaton = ahocorasick.Automaton()
    for piece, places in found.items():
        automaton.add_word(piece, (len(piece), places))
    automaton.make_automaton()
    return automaton, budgets, [_masks(item) for _, item in items]


def matches(text: str, items, rate: float = ERROR_RATE, min_chars: int = MIN_CHARS) -> list[tuple[int, int, int, int]]:
    """(number of the item, distance, start, end) of the best passage for each item found in a normalised text."""
    automaton, budgets, masks = _automaton(items, rate, min_chars)
    begins: dict[int, set[int]] = {}
    for last, (size, places) in automaton.iter(text):
        for number, offset in places:
            begins.setdefault(number, set()).add(last + 1 - size - offset)
    out = []
    for number, starts in begins.items():
        item, k, best = items[number][1], budgets[number], None
        short = len(item) < min_chars
        exact = next((s for s in sorted(starts) if s >= 0 and text.startswith(item, s) and not (short and not _whole(text, s, s + len(item)))), None)
        if exact is not None:
            best = (0, exact, exact + len(item))
        elif k:
            ordered = sorted(starts)
            while ordered:
                lo = hi = ordered.pop(0)
                while ordered and ordered[0] - hi <= 2 * k:
                    hi = ordered.pop(0)
                at = max(0, lo - k)
                distance, end = best_match(item, text[at : hi + len(item) + k], masks[number])
                if distance <= k and (best is None or distance < best[0]):
                    best = (distance, max(0, at + end - len(item)), at + end)
        if best:
            out.append((number, *best))
    return out


def _whole(text: str, start: int, end: int) -> bool:
    return (start == 0 or not text[start - 1].isalnum()) and (end == len(text) or not text[end].isalnum())


def contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, distance, start, end (in the normalised text) for each document and item it holds."""
    test = benchmark.select("item_id", "text").where(F.length(F.trim("text")) > 0)
    total = test.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_chars))
    if blocks > 1:
        test = stored(test.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).cast("int")), "block")
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    out = None
    for block in range(blocks):
        rows = (test.where(F.col("block") == block) if blocks > 1 else test).select("item_id", "text").collect()
        items = tuple(sorted(((r["item_id"], n) for r in rows if (n := normal(r["text"]))), key=lambda x: (x[0] is None, x[0] or 0, x[1])))
        if not items and block:
            continue
        found = texts.mapInArrow(_scan(items, rate, min_chars), OUT)
        # of several blocks each runs before the next is read, so the driver and the plan never hold more than one
        found = stored(found) if blocks > 1 else found
        out = found if out is None else out.unionByName(found)
    return out


def _scan(items, rate, min_chars):
    def run(batches):
        for batch in batches if items else ():
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                for number, distance, start, end in matches(normal(text.as_py()), items, rate, min_chars):
                    rows.append((doc_id, items[number][0], distance, start, end))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()))],
                names=["doc_id", "item_id", "distance", "start", "end"],
            )

    return run


def op3_decontaminate(spark, sf_dir):
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "benchmark"))
    return contaminated(docs, benchmark)
