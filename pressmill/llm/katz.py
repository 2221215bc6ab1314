"""Katz backoff language model: trained on a part of the documents, scoring all of them.

An n-gram seen c times keeps d(c) * c of its count (Good-Turing for c <= SMALL, a small constant less
beyond), and what its context loses goes to the words unseen there, in proportion to the next
lower order and normalised exactly over the vocabulary and one unknown word. Start symbols stand
before a document as context only; its end is a token.

1. Documents are packed into chunks. A chunk sends each of its distinct n-grams once, with its count
   in training documents, to the n-gram's bucket; the bucket adds up and replies with total counts in the order
   asked. One chunk is told that it owns the n-gram. The replies are a table, partitioned by order.
2. Each chunk meets its replies and scores its tokens recursively from the highest order down. For
   n-grams it owns it sends what their context loses and the lower order's share of them;
   for tokens that back off it sends their context.
3. Per bucket of contexts the weights are made exact and applied.

No word or context meets in one task more than once per chunk, however frequent it is.

Edge cases: null or empty text is one end token. A null doc_id counts as the empty string in the split.
Repeated rows each train and get a score each. Without training documents all tokens are unknown and
score 0. Extra columns are ignored.
"""

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .anchors import U, Rolling, mixed
from .blobs import text_chunks
from .common import shuffle_partitions, stored
from .language import fold
from .words import LOWER, word_bounds, word_hashes

ORDER = 2
SMALL = 5
#: What an n-gram seen more than SMALL times gives away, so that every context leaves mass for unseen words.
TAIL = 0.05
CHUNK = 8_000_000
START, END = (mixed(np.array([seed], dtype=U))[0] for seed in (0x5354, 0x454E))
OWNER = U(1 << 63)
REPLY = "chunk long, bucket int, n int, data binary"
SCORED = "chunk long, place int, bucket int, n int, data binary, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double"


def encode(keys: np.ndarray) -> bytes:
    """Ascending 64-bit keys as steps of as few bytes as the widest one needs."""
    steps = np.diff(keys, prepend=U(0))
    width = max(1, -(-int(steps[1:].max()).bit_length() // 8)) if len(keys) > 1 else 1
    head = int(keys[0]) if len(keys) else 0
    return bytes([width]) + head.to_bytes(8, "little") + np.ascontiguousarray(steps[1:].view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def decode(data: bytes, n: int) -> np.ndarray:
    steps = np.zeros((n, 8), dtype=np.uint8)
    if n:
        steps[0] = np.frombuffer(data, dtype=np.uint8, count=8, offset=1)
        steps[1:, : data[0]] = np.frombuffer(data, dtype=np.uint8, offset=9).reshape(n - 1, data[0])
    return np.cumsum(steps.reshape(-1).view(U), dtype=U)


def bucket_edges(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Ascending keys' first positions in each of the equal key ranges, and their number."""
    own = ((keys >> U(32)) * U(buckets)) >> U(32)
    return np.searchsorted(own, np.arange(buckets + 1, dtype=U))


class Tokens:
    """The tokens of a chunk's texts with their n-grams' hashes for every order."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, order: int):
        data = LOWER[data]
        starts, ends, bounds = word_bounds(data, offsets)
        words = np.diff(bounds)
        self.n_tokens = words + 1
        pads = order - 1
        begin = np.cumsum(self.n_tokens + pads) - (self.n_tokens + pads)
        symbols = np.full(int((self.n_tokens + pads).sum()), START, dtype=U)
        doc = np.repeat(np.arange(len(words)), words)
        symbols[np.arange(len(starts)) - bounds[doc] + begin[doc] + pads] = word_hashes(data, starts, ends)
        symbols[begin + pads + words] = END
        self.doc = np.repeat(np.arange(len(words)), self.n_tokens)
        self.at = np.arange(len(self.doc)) - np.repeat(np.cumsum(self.n_tokens) - self.n_tokens, self.n_tokens) + begin[self.doc] + pads
        self.first = self.at == (begin + pads)[self.doc]
        self.rolling = Rolling(symbols)

    def grams(self, n: int) -> np.ndarray:
        return self.rolling.spans(self.at - n + 1, self.at + 1)

    def contexts(self, n: int) -> np.ndarray:
        return self.rolling.spans(self.at - n + 1, self.at)


def _chunks(batches):
    """Rows (chunk, ids, held, sizes, body): texts of about CHUNK bytes, compressed."""
    task, number = TaskContext.get().partitionId(), 0
    for ids, data, offsets, rows in text_chunks(batches, "row", CHUNK):
        held = rows.column("held")
        doc_ids = rows.column("doc_id")
        yield pa.record_batch(
            [
                pa.array([(task << 24) + number], pa.int64()),
                pa.array([doc_ids.to_pylist()], pa.list_(pa.int64())),
                pa.array([held.to_pylist()], pa.list_(pa.bool_())),
                pa.array([np.diff(offsets)], pa.list_(pa.int64())),
                pa.array([zstandard.compress(data.tobytes(), 3)], pa.binary()),
            ],
            names=["chunk", "ids", "held", "sizes", "body"],
        )
        number += 1


def _opened(held, sizes, body, order: int) -> tuple[Tokens, np.ndarray]:
    data = np.frombuffer(zstandard.decompress(body), dtype=np.uint8)
    return Tokens(data, np.append(0, np.cumsum(sizes.values.to_numpy())), order), np.asarray(held.values)


def _ask(order: int, buckets: int):
    """Chunks to rows (bucket, chunk, n, keys, counts): the distinct n-grams and their training counts."""

    def run(batches):
        for batch in batches:
            for chunk, held, sizes, body in zip(batch["chunk"].to_pylist(), batch["held"], batch["sizes"], batch["body"].to_pylist()):
                tokens, out = _opened(held, sizes, body, order)
                train = ~out[tokens.doc]
                found = []
                for n in range(1, order + 1):
                    keys, which = np.unique(tokens.grams(n), return_inverse=True)
                    counts = np.bincount(which, weights=train, minlength=len(keys)).astype(np.uint32)
                    edges = bucket_edges(keys, buckets)
                    found += [(b, chunk, n, encode(keys[lo:hi]), counts[lo:hi].tobytes()) for b, (lo, hi) in enumerate(zip(edges, edges[1:])) if hi > lo]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*found), (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()))], names=["bucket", "chunk", "n", "keys", "counts"])

    return run


def _count(table: pa.Table) -> pa.Table:
    """Replies to the chunks (total count, and whether the chunk owns the n-gram); one row of counts of counts (chunk -1)."""
    n, bucket = table["n"][0].as_py(), table["bucket"][0].as_py()
    order = np.argsort(table["chunk"].to_numpy())
    chunks = table["chunk"].to_numpy()[order]
    counts = [np.frombuffer(c, dtype=np.uint32) for c in table["counts"].take(order).to_pylist()]
    keys = np.concatenate([decode(k, len(c)) for k, c in zip(table["keys"].take(order).to_pylist(), counts)])
    sizes, counts = np.array([len(c) for c in counts]), np.concatenate(counts)
    _, which = np.unique(keys, return_inverse=True)
    totals = np.bincount(which, weights=counts).astype(U)
    asked = np.flatnonzero(counts)
    owner = np.zeros(len(keys), dtype=bool)
    owner[asked[np.unique(which[asked], return_index=True)[1]]] = True
    replies = totals[which] | np.where(owner, OWNER, U(0))
    ends = np.cumsum(sizes)
    stats = np.append(np.bincount(np.minimum(totals, SMALL + 2).astype(np.int64), minlength=SMALL + 3)[1:], int(totals.sum())).astype(np.int64)
    data = [stats.tobytes()] + [replies[e - s : e].tobytes() for s, e in zip(sizes, ends)]
    return pa.table({"chunk": pa.array(np.append(-1, chunks)), "bucket": pa.array([bucket] * len(data), pa.int32()), "n": pa.array([n] * len(data), pa.int32()), "data": pa.array(data, pa.binary())})


def discounts(n_of: list[int], small: int = SMALL) -> np.ndarray:
    """d(1) .. d(small) from the numbers of n-grams seen 1, 2, .. small + 1 times.

    Good-Turing as Katz has it; absolute discounting where the counts are too thin for it.
    """
    n = np.maximum(np.array(n_of[: small + 1], dtype=float), 1e-9)
    r = np.arange(1, small + 1)
    cut = (small + 1) * n[small] / n[0]
    with np.errstate(divide="ignore", invalid="ignore"):
        d = ((r + 1) * n[1:] / n[:-1] / r - cut) / (1 - cut)
    if cut >= 1 or not np.all((d > 0.02) & (d < 1)):
        lost = min(0.9, max(0.1, n[0] / (n[0] + 2 * n[1])))
        d = (r - lost) / r
    return d


class Model:
    """Scalars of the model: per order the discounts, the tokens trained on, the vocabulary, the documents."""

    def __init__(self, stats: dict[int, np.ndarray], documents: int):
        zero = np.zeros(SMALL + 3, dtype=np.int64)
        self.kept = {n: np.append(discounts(list(s)), 1.0) for n, s in stats.items()}
        self.tokens, self.types, self.documents = int(stats.get(1, zero)[-1]), int(stats.get(1, zero)[:-1].sum()), documents
        few = stats.get(1, zero)[: SMALL].astype(float) * np.arange(1, SMALL + 1)
        lost = float((few * (1 - self.kept[1][:SMALL])).sum()) + TAIL * float(stats.get(1, zero)[SMALL : SMALL + 2].sum()) if 1 in stats else 0.0
        self.unknown = lost / self.tokens if self.tokens else 1.0

    def reduced(self, n: int, counts: np.ndarray) -> np.ndarray:
        """Counts after discounting."""
        small = counts <= SMALL
        return np.where(small, counts * self.kept[n][np.maximum(np.minimum(counts, SMALL + 1), 1) - 1], counts - TAIL)


def _score(order: int, buckets: int, model: Model):
    """A chunk and its replies to a row per document, and blobs of owned contexts (n > 0) and of contexts backed off from (n < 0)."""

    def run(table: pa.Table) -> pa.Table:
        own = table.filter(table["body"].is_valid())
        chunk, ids = own["chunk"][0].as_py(), own["ids"][0].values
        tokens, held = _opened(own["held"][0], own["sizes"][0], own["body"][0].as_py(), order)
        docs = len(held)
        replies = table.filter(table["data"].is_valid()).sort_by([("n", "ascending"), ("bucket", "ascending")])
        seen, blobs = {}, []
        for n in range(1, order + 1):
            keys, first, which = np.unique(tokens.grams(n), return_index=True, return_inverse=True)
            data = np.frombuffer(b"".join(d for d, k in zip(replies["data"].to_pylist(), replies["n"].to_pylist()) if k == n), dtype=U)
            counts = (data & ~OWNER).astype(np.int64)
            seen[n] = (counts[which], np.sort(first[(data & OWNER) != 0]))
        base = np.log10((seen[1][0] + 0.5) / (model.tokens + 0.5 * (model.types + 1)))
        total, share = {1: np.full(len(base), float(model.tokens))}, {}
        for n in range(2, order + 1):
            before = np.append(0, seen[n - 1][0][:-1])
            total[n] = np.where(tokens.first, model.documents, before).astype(float)
        for n in range(1, order + 1):
            with np.errstate(divide="ignore", invalid="ignore"):
                share[n] = np.where(seen[n][0] > 0, model.reduced(n, seen[n][0]) / total[n], 0.0) if n in model.kept else np.zeros(len(base))
        chance, open_ = np.zeros(len(base)), np.ones(len(base), dtype=bool)
        for n in range(order, 0, -1):
            hit = open_ & (share[n] > 0)
            chance[hit] = np.log10(share[n][hit])
            open_ &= ~hit
            if n > 1:
                context = tokens.contexts(n)
                back = np.flatnonzero(open_ & (total[n] > 0))
                back = back[np.argsort(context[back], kind="stable")]
                keys, edges = context[back], None
                edges = bucket_edges(keys, buckets)
                rows = tokens.doc[back].astype(np.uint32)
                blobs += [(b, -n, encode(keys[lo:hi]) + rows[lo:hi].tobytes(), hi - lo) for b, (lo, hi) in enumerate(zip(edges, edges[1:])) if hi > lo]
                mine = seen[n][1]
                keys, which, = np.unique(context[mine], return_inverse=True)
                loss = np.bincount(which, weights=(seen[n][0][mine] - model.reduced(n, seen[n][0][mine])) / total[n][mine], minlength=len(keys))
                lower = np.bincount(which, weights=share[n - 1][mine], minlength=len(keys))
                edges = bucket_edges(keys, buckets)
                blobs += [(b, n, encode(keys[lo:hi]) + loss[lo:hi].tobytes() + lower[lo:hi].tobytes(), hi - lo) for b, (lo, hi) in enumerate(zip(edges, edges[1:])) if hi > lo]
        chance[open_] = np.log10(model.unknown)
        per_doc = lambda x: np.bincount(tokens.doc, weights=x, minlength=docs)
        k = len(blobs)
        return pa.table(
            {
                "chunk": pa.array(np.full(docs + k, chunk), pa.int64()),
                "place": pa.array([*range(docs), *[None] * k], pa.int32()),
                "bucket": pa.array([None] * docs + [b[0] for b in blobs], pa.int32()),
                "n": pa.array([0] * docs + [b[1] for b in blobs], pa.int32()),
                "data": pa.array([None] * docs + [b[3].item().to_bytes(4, "little") + b[2] for b in blobs], pa.binary()),
                "doc_id": pa.concat_arrays([ids, pa.nulls(k, pa.int64())]),
                "held_out": pa.concat_arrays([pa.array(held), pa.nulls(k, pa.bool_())]),
                "n_tokens": pa.concat_arrays([pa.array(tokens.n_tokens.astype(np.int64)), pa.nulls(k, pa.int64())]),
                "n_known": pa.concat_arrays([pa.array(per_doc(seen[1][0] > 0).astype(np.int64)), pa.nulls(k, pa.int64())]),
                "base": pa.concat_arrays([pa.array(per_doc(base)), pa.nulls(k, pa.float64())]),
                "score": pa.concat_arrays([pa.array(per_doc(chance)), pa.nulls(k, pa.float64())]),
            }
        )

    return run


def _weights(table: pa.Table) -> pa.Table:
    """Per chunk the documents that back off, and the sum of their contexts' log weights."""
    keys, loss, lower, asked = [], [], [], []
    for chunk, n, data in zip(table["chunk"].to_pylist(), table["n"].to_pylist(), table["data"].to_pylist()):
        size, width = int.from_bytes(data[:4], "little"), data[4]
        end = 13 + width * (size - 1)
        own = decode(data[4:end], size)
        if n > 0:
            keys.append(own)
            loss.append(np.frombuffer(data, dtype=float, count=size, offset=end))
            lower.append(np.frombuffer(data, dtype=float, offset=end + 8 * size))
        else:
            asked.append((chunk, own, np.frombuffer(data, dtype=np.uint32, offset=end)))
    chunks, sums = [], []
    if keys and asked:
        keys, which = np.unique(np.concatenate(keys), return_inverse=True)
        weight = np.log10(np.bincount(which, weights=np.concatenate(loss))) - np.log10(np.maximum(1 - np.bincount(which, weights=np.concatenate(lower)), 1e-12))
        for chunk, own, docs in asked:
            per_doc = np.bincount(docs, weights=weight[np.searchsorted(keys, own)])
            some = np.unique(docs)
            chunks.append(chunk)
            sums.append(len(some).to_bytes(4, "little") + some.astype(np.uint32).tobytes() + per_doc[some].tobytes())
    return pa.table({"chunk": pa.array(chunks, pa.int64()), "data": pa.array(sums, pa.binary())})


def _added(table: pa.Table) -> pa.Table:
    """The weights of one chunk's documents, added up over all buckets."""
    docs, sums = [np.zeros(0, dtype=np.uint32)], [np.zeros(0)]
    for data in table["data"].to_pylist():
        n = int.from_bytes(data[:4], "little")
        docs.append(np.frombuffer(data, dtype=np.uint32, count=n, offset=4))
        sums.append(np.frombuffer(data, dtype=float, offset=4 + 4 * n))
    docs, which = np.unique(np.concatenate(docs), return_inverse=True)
    chunk = np.full(len(docs), table["chunk"][0].as_py(), dtype=np.int64)
    return pa.table({"chunk": pa.array(chunk), "place": pa.array(docs.astype(np.int32)), "weight": pa.array(np.bincount(which, weights=np.concatenate(sums)))})


def katz_scores(docs: DataFrame, held_out: Column, order: int = ORDER) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: a row for each row of docs.

    The model learns from rows where held_out is false.
    """
    spark = docs.sparkSession
    buckets = 2 * shuffle_partitions(spark)
    texts = docs.select(F.lit(0).cast("long").alias("row"), "doc_id", F.col("text").cast("binary").alias("text"), held_out.alias("held"))
    chunks = stored(texts.mapInArrow(_chunks, "chunk long, ids array<long>, held array<boolean>, sizes array<long>, body binary"))
    asked = chunks.mapInArrow(_ask(order, buckets), "bucket int, chunk long, n int, keys binary, counts binary")
    replies = stored(asked.groupBy("bucket", "n").applyInArrow(_count, REPLY), "n")

    stats: dict[int, np.ndarray] = {}
    for r in replies.where("chunk = -1").select("n", "data").collect():
        stats[r["n"]] = stats.get(r["n"], 0) + np.frombuffer(r["data"], dtype=np.int64)
    documents = chunks.agg(F.sum(F.size(F.filter("held", lambda h: ~h)))).first()[0] or 0
    model = Model(stats, documents)

    both = chunks.select("chunk", "ids", "held", "sizes", "body", F.lit(None).cast("int").alias("bucket"), F.lit(None).cast("int").alias("n"), F.lit(None).cast("binary").alias("data"))
    both = both.unionByName(replies.where("chunk >= 0"), allowMissingColumns=True)
    scored = stored(both.groupBy("chunk").applyInArrow(_score(order, buckets, model), SCORED))
    weights = (
        scored.where(F.col("bucket").isNotNull())
        .select("chunk", "bucket", "n", "data", F.abs("n").alias("level"))
        .groupBy("bucket", "level")
        .applyInArrow(_weights, "chunk long, data binary")
    )
    added = weights.groupBy("chunk").applyInArrow(_added, "chunk long, place int, weight double")
    rows = scored.where(F.col("bucket").isNull()).select("chunk", "place", "doc_id", "held_out", "n_tokens", "n_known", "base", "score")
    return rows.join(added, ["chunk", "place"], "left").select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), (F.col("score") + F.coalesce("weight", F.lit(0.0))).alias("score")
    )


def op4_katz_scores(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return katz_scores(docs, fold(docs["doc_id"], 5) == 1)
