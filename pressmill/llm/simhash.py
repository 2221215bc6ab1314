"""SimHash near-duplicates: fingerprints, linked by a binary-trie self-join, and their components.

Documents with one fingerprint are one node. Of six blocks of the 64 bits, two at least are alike in
any pair that differs in four bits or fewer, so there are fifteen tries, each with another two blocks on
top, where no error is allowed: Spark's shuffle is the descent through these top levels. Below them, node pairs of the
bucket's tries are traversed together from branch to branch; each pair carries the bits it differs in so far and is dropped
when they exceed the budget. Crowded subtrees are first split by Spark into their pairs of child nodes,
which are bucketed on their own. A task returns links that span what is connected in it, not all pairs.

Edge cases: null text is empty; a text without words has fingerprint zero; a null doc_id is smaller
than all others and appears as null component. Repeated rows are one node. Extra columns are ignored.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import U
from .blobs import sort_runs
from .common import NULL_ID, shuffle_partitions, stored
from .components import components

BUDGET, BLOCKS = 4, 6
#: Fingerprints a subtree may hold before it is split into child pairs.
CROWDED = 20_000
#: Node pairs of tries that a task takes a step further at once.
FRONTIER = 100_000
#: Band prints of a text and the random orders each of them takes: 0.99993 of pairs of similarity 0.8 share a print.
BANDS, WIDTH = 24, 5
_ORDERS = np.random.default_rng(7).integers(0, 1 << 64, (2, BANDS * WIDTH), dtype=U)


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """XXH64 of each run of `shingle` words, repeats included; of fewer words, of all together; none of no words."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype="<u8")
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    size = min(shingle, len(words))
    starts = [0, *(ends[: len(words) - size] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], 42) for a, b in zip(starts, ends[size - 1 :].tolist())], dtype="<u8")


def fingerprint(text: bytes, shingle: int = 4, distinct: bool = False) -> int:
    """Each bit is one if over half the shingles' hashes have it; distinct ones count once if so asked."""
    hashes = shingle_hashes(text, shingle)
    if distinct:
        hashes = np.unique(hashes)
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 8192):
        part = hashes[i : i + 8192]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, keep: tuple = ("doc_id",), distinct: bool = False) -> DataFrame:
    """The kept columns and fp, the fingerprint as a long."""
    rows = docs.select(*keep, F.coalesce(docs["text"], F.lit("")).cast("binary").alias("_text"))

    def run(batches):
        for batch in batches:
            out = [fingerprint(t.as_py(), shingle, distinct) for t in batch.column("_text")]
            fps = pa.array(np.array(out, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), fps], names=[*keep, "fp"])

    schema = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep)
    return rows.mapInArrow(run, f"{schema}, fp long")


def _layouts(blocks: int, budget: int) -> list[tuple[list[int], int]]:
    """For each choice of the blocks on top: the bits' order from the top, and how many of them are on top."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    own = [list(range(a, b)) for a, b in zip(edges, edges[1:])]
    out = []
    for top in combinations(range(blocks), blocks - budget):
        head = [bit for i in top for bit in own[i]]
        out.append((head + [bit for i in range(blocks) if i not in top for bit in own[i]], len(head)))
    return out


def _rotated(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    """The bits of each fingerprint in the given order, the first one highest."""
    out = np.zeros(len(fps), dtype=U)
    for place, bit in enumerate(bits):
        out |= ((fps >> U(bit)) & U(1)) << U(63 - place)
    return out


def _spread(bits_by_layout, tops, split_bits):
    def run(batches):
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False).view(U)
            nodes = batch.column("node").to_numpy(zero_copy_only=False)
            for layout, (bits, top) in enumerate(zip(bits_by_layout, tops)):
                turned = _rotated(fps, bits)
                yield pa.record_batch(
                    [
                        pa.array(np.full(len(fps), layout, dtype=np.int32)),
                        pa.array((turned >> U(64 - top)).view(np.int64)),
                        pa.array(turned.view(np.int64)),
                        pa.array(nodes),
                        pa.array(((turned << U(top)) >> U(64 - split_bits)).astype(np.int32)),
                    ],
                    names=["layout", "head", "turned", "node", "child"],
                )

    return run


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


class _Groups:
    """Union by least index over arrays of pairs."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.label[a], self.label[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.label, np.maximum(x, y), np.minimum(x, y))
            while True:
                further = self.label[self.label]
                if np.array_equal(further, self.label):
                    break
                self.label = further


def _shared_bits(x: np.ndarray) -> np.ndarray:
    """Leading zero bits of each difference: how long the two entries go together."""
    for step in (1, 2, 4, 8, 16, 32):
        x = x | (x >> U(step))
    return 64 - _popcount(x)


def _below(depth: np.ndarray) -> np.ndarray:
    """Masks of the bits from a depth (0 to 64) on."""
    return np.where(depth > 63, U(0), ~U(0) >> np.minimum(depth, 63).astype(U))


def trie_links(turned: np.ndarray, starts: np.ndarray, stops: np.ndarray, top: np.ndarray, budget: int, groups: _Groups) -> np.ndarray:
    """Joins in `groups` all pairs within each range of `turned` that differ in `budget` bits or fewer.

    Returns for each entry the nearest one before it within the budget, or -1. Ranges are sorted and share their top bits;
    each is a binary trie whose nodes are ranges of entries of one prefix. The frontier holds node pairs with the bits
    they differ in so far. A step takes each pair down to where one of its nodes branches, adds the bits in
    which the stretch between differs, drops the pair if that exceeds the budget, and goes on with the pairs of children.
    """
    nearest = np.full(len(turned), 1 << 62, dtype=np.int64)  # bits apart above the entry's number
    stack = [(starts, stops, starts, stops, top.astype(np.int64), np.zeros(len(starts), dtype=np.int64))]
    while stack:  # in parts, the deepest first, so that memory stays bounded however many pairs there are
        part = stack.pop()
        if len(part[0]) > FRONTIER:
            stack.append(tuple(v[FRONTIER:] for v in part))
        a0, a1, b0, b1, depth, errors = (v[:FRONTIER] for v in part)
        branch = np.minimum(_shared_bits(turned[a0] ^ turned[a1 - 1]), _shared_bits(turned[b0] ^ turned[b1 - 1]))
        errors = errors + _popcount((turned[a0] ^ turned[b0]) & _below(depth) & ~_below(branch))
        live = errors <= budget
        leaf = live & (branch > 63)
        _join_leaves(a0[leaf], a1[leaf], b0[leaf], b1[leaf], errors[leaf], groups, nearest)
        live &= branch <= 63
        a0, a1, b0, b1, depth, errors = (v[live] for v in (a0, a1, b0, b1, branch, errors))
        bit = U(1) << (U(63) - depth.astype(U))
        am, bm = _lower_bound(turned, a0, a1, bit), _lower_bound(turned, b0, b1, bit)
        apart, every = a0 != b0, np.ones(len(a0), dtype=bool)
        children = [(a0, am, b0, bm, 0, every), (am, a1, bm, b1, 0, every), (a0, am, bm, b1, 1, every), (am, a1, b0, bm, 1, apart)]
        use = [use & (hi > lo) & (high > low) & (errors + more <= budget) for lo, hi, low, high, more, use in children]
        # the branching bit itself is in the difference that the next step counts
        pairs = [np.concatenate([c[i][u] for c, u in zip(children, use)]) for i in range(4)] + [np.concatenate([v[u] for u in use]) for v in (depth, errors)]
        if len(pairs[0]):
            stack.append(tuple(pairs))
    return np.where(nearest < 1 << 62, nearest & (1 << 40) - 1, -1)


def _join_leaves(a0, a1, b0, b1, errors, groups: _Groups, nearest: np.ndarray) -> None:
    """Leaf pairs within the budget; a leaf may hold several equal entries, of which all meet the other leaf's first."""
    for first, lo, hi in ((a0, b0, b1), (b0, a0, a1)):
        which = np.repeat(np.arange(len(lo)), hi - lo)
        other = lo[which] + np.arange(len(which)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo)
        x, y = np.minimum(first[which], other), np.maximum(first[which], other)
        pair = x < y
        groups.join(x[pair], y[pair])
        np.minimum.at(nearest, y[pair], errors[which][pair] << 40 | x[pair])


def _lower_bound(turned: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """In each range the first index whose entry has the bit set, by bisection of all ranges at once."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) // 2
        one = (turned[np.minimum(mid, len(turned) - 1)] & bit) != 0
        hi = np.where(open_ & one, mid, hi)
        lo = np.where(open_ & ~one, mid + 1, lo)


def _links(tops: list[int], budget: int, nearest: bool):
    def run(table: pa.Table) -> pa.Table:
        layout = table["layout"].to_numpy()
        group = table["group"].to_numpy()
        turned = table["turned"].to_numpy().view(U)
        node = table["node"].to_numpy()
        order = np.lexsort((turned, group, layout))
        layout, group, turned, node = layout[order], group[order], turned[order], node[order]
        new = np.append(True, (layout[1:] != layout[:-1]) | (group[1:] != group[:-1]))[: len(order)]
        starts = np.flatnonzero(new)
        stops = np.append(starts[1:], len(order))
        several = stops - starts > 1
        groups = _Groups(len(order))
        before = trie_links(turned, starts[several], stops[several], np.array(tops)[layout[starts[several]]], budget, groups)
        linked = np.flatnonzero(groups.label != np.arange(len(order)))
        a, b = groups.label[linked], linked
        if nearest:
            more = np.flatnonzero(before >= 0)
            a, b = np.append(a, before[more]), np.append(b, more)
        return pa.table({"a": pa.array(node[a]), "b": pa.array(node[b])})

    return run


def similar_links(nodes: DataFrame, budget: int = BUDGET, blocks: int = BLOCKS, crowded: int = CROWDED, nearest: bool = False) -> DataFrame:
    """Links (a, b) that connect the nodes (node, fp) of distinct fingerprints with `budget` bits or fewer between them.

    nearest adds the nearest other node to each, for use where links are confirmed one by one.
    """
    spark = nodes.sparkSession
    layouts = _layouts(blocks, budget)
    bits, tops = [x for x, _ in layouts], [n for _, n in layouts]
    split_bits = 4
    spread = nodes.mapInArrow(_spread(bits, tops, split_bits), "layout int, head long, turned long, node long, child int")
    heads = spread.groupBy("layout", "head").agg(F.count("*").alias("n")).where(F.col("n") > crowded)
    heads = stored(heads.select(F.col("layout").alias("l"), F.col("head").alias("h")))
    marked = spread.join(heads, (spread["layout"] == heads["l"]) & (spread["head"] == heads["h"]), "left")
    # a crowded subtree becomes one group for each pair of its children that the budget allows
    other = F.filter(F.sequence(F.lit(0), F.lit(2**split_bits - 1)), lambda o: F.bit_count(o.bitwiseXOR(F.col("child"))) <= budget)
    lone = F.array(F.lit(-1))
    pairs = marked.withColumn("other", F.explode(F.when(F.col("h").isNull(), lone).otherwise(other)))
    low, high = F.least("child", "other"), F.greatest("child", "other")
    group = F.when(F.col("other") < 0, F.xxhash64("head")).otherwise(F.xxhash64("head", low, high))
    buckets = 4 * shuffle_partitions(spark)
    dealt = pairs.select("layout", group.alias("group"), "turned", "node", F.pmod(F.xxhash64("layout", group), F.lit(buckets)).alias("bucket"))
    return dealt.groupBy("bucket").applyInArrow(_links(tops, budget, nearest), "a long, b long")


def simhash_components(docs: DataFrame, shingle: int = 4, budget: int = BUDGET, blocks: int = BLOCKS) -> DataFrame:
    """doc_id, fp, component: a row for each row of docs."""
    rows = stored(fingerprints(docs.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("node"), "text"), shingle, ("node",)))
    nodes = stored(rows.groupBy("fp").agg(F.min("node").alias("node")))
    found = components(similar_links(nodes, budget, blocks))
    least = nodes.join(found, "node", "left").select(F.col("fp").alias("_fp"), F.coalesce("component", "node").alias("component"))
    out = rows.join(stored(least), rows["fp"] == F.col("_fp"))
    real = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return out.select(real("node").alias("doc_id"), "fp", real("component").alias("component"))


def _minima(seeds: np.ndarray, odd: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The least value of the hashes in each of the random orders that the seeds stand for."""
    least = np.full(len(seeds), ~U(0), dtype=U)
    for i in range(0, len(hashes), 1024):
        np.minimum(least, ((hashes[None, i : i + 1024] ^ seeds[:, None]) * odd[:, None]).min(axis=1), out=least)
    return least


def band_prints(text: bytes, shingle: int) -> list[int]:
    """A print for each band: two texts share it with a probability of their shingles' Jaccard similarity to the power of WIDTH."""
    seeds, odd = _ORDERS
    least = _minima(seeds, odd | U(1), np.unique(shingle_hashes(text, shingle))).reshape(BANDS, WIDTH)
    return [xxhash.xxh64_intdigest(row.tobytes(), i) for i, row in enumerate(least)]


def _prints(ids: DataFrame, feature: int, shingle: int) -> DataFrame:
    """node, sig, fp and bands of each row of node, sig, text."""

    def run(batches):
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").to_pylist()]
            fps = np.array([fingerprint(t, feature, True) for t in texts], dtype=np.uint64).view(np.int64)
            bands = [np.array(band_prints(t, shingle), dtype=np.uint64).view(np.int64) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("sig"), pa.array(fps), pa.array(bands, pa.list_(pa.int64()))], names=["node", "sig", "fp", "bands"])

    return ids.select("node", "sig", F.col("text").cast("binary").alias("text")).mapInArrow(run, "node long, sig long, fp long, bands array<long>")


def _sketches(texts: DataFrame, shingle: int) -> DataFrame:
    """sig, sketch: 32-bit hashes of the distinct shingles of each text, ascending."""

    def run(batches):
        for batch in batches:
            made = [np.unique(shingle_hashes(t, shingle).astype(np.uint32)).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("sig"), pa.array(made, pa.binary())], names=["sig", "sketch"])

    return texts.select("sig", F.coalesce("text", F.lit("")).cast("binary").alias("text")).mapInArrow(run, "sig long, sketch binary")


def _confirm(similarity: float):
    def run(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("sketch_a").to_pylist(), batch.column("sketch_b").to_pylist()):
                a, b = np.frombuffer(a, dtype=np.uint32), np.frombuffer(b, dtype=np.uint32)
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(both >= similarity * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _bounds(sketches: DataFrame) -> DataFrame:
    """sig, size, common: how many shingles each text has, and how many of them any other of these texts has too."""

    def run(batches):
        for batch in batches:
            hashes = [np.frombuffer(x, dtype=np.uint32).view(np.int32) for x in batch.column("sketch").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("sig"), pa.array(hashes, pa.list_(pa.int32()))], names=["sig", "hashes"])

    flat = sketches.mapInArrow(run, "sig long, hashes array<int>").select("sig", F.explode("hashes").alias("h"))
    shared = flat.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    common = flat.join(shared, "h", "left_semi").groupBy(F.col("sig").alias("s")).agg(F.count("*").alias("common"))
    sizes = sketches.select("sig", (F.octet_length("sketch") / 4).cast("long").alias("size"))
    return sizes.join(common, F.col("sig") == F.col("s"), "left").select("sig", "size", F.coalesce("common", F.lit(0)).alias("common"))


#: Pairs of one group that a task looks at together.
AT_ONCE = 2_000_000


def _across(limit: int, similarity: float):
    """Pairs of a group's texts under different labels that may be similar, up to `limit` for each text; a row with cut says that there were more.

    Two texts share no more shingles than either shares with any text, so most pairs are ruled out by that number. Texts
    propose pairs to those of labels that more of the group's texts have, so that the many texts of one large label do
    not each name the few others.
    """

    def run(table: pa.Table) -> pa.Table:
        group, label, own, sig, size, common = (table[c].to_numpy() for c in ("group", "label", "own", "sig", "size", "common"))
        order, new = sort_runs(group, label)
        many = np.empty(len(order), dtype=np.int64)
        many[order] = np.bincount(np.cumsum(new) - 1)[np.cumsum(new) - 1] if len(order) else 0
        order = np.lexsort((sig, own, label, many, group))
        group, label, own, sig, size, common = (x[order] for x in (group, label, own, sig, size, common))
        inner = table["inner"].to_numpy()[order]
        ends = lambda *keys: np.append(np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1, len(sig))
        stop, after = ends(group), ends(group, label)
        at = np.arange(len(sig))
        stop, after = stop[np.searchsorted(stop, at, side="right")], after[np.searchsorted(after, at, side="right")]
        n = stop - after
        pairs, cut, lo = [], False, 0
        total = np.cumsum(n)
        while lo < len(sig):
            hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + AT_ONCE, side="right")))
            x = np.repeat(at[lo:hi], n[lo:hi])
            y = after[x] + np.arange(len(x)) - np.repeat(np.cumsum(n[lo:hi]) - n[lo:hi], n[lo:hi])
            fit = ((own[x] != own[y]) | inner[x]) & (np.minimum(common[x], common[y]) * (1 + similarity) >= similarity * (size[x] + size[y]) - 1e-6)
            x, y = x[fit], y[fit]
            nth = np.arange(len(x)) - np.searchsorted(x, x, side="left")
            cut |= bool((nth >= limit).any())
            pairs.append((x[nth < limit], y[nth < limit]))
            lo = hi
        x, y = (np.concatenate([p[i] for p in pairs]) if pairs else np.zeros(0, dtype=np.int64) for i in (0, 1))
        more = np.zeros(len(x), dtype=bool)
        if cut:  # said by a pair of a text with itself, as no other may be left
            x, y, more = np.append(x, 0), np.append(y, 0), np.append(more, True)
        return pa.table({"a": pa.array(np.minimum(sig[x], sig[y])), "b": pa.array(np.maximum(sig[x], sig[y])), "cut": pa.array(more)})

    return run


def mixed_members(members: DataFrame, labels: DataFrame) -> DataFrame:
    """key, n, sig, label of the members (key, n, sig) whose key stands under several labels (node, component)."""
    named = members.join(labels, members["sig"] == labels["node"], "left").select("key", "n", "sig", F.coalesce("component", "sig").alias("label"))
    mixed = named.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select(F.col("key").alias("k"))
    return named.join(stored(mixed), F.col("key") == F.col("k"), "left_semi")


def across_pairs(mixed: DataFrame, bounds: DataFrame, limit: int, crowded: int, similarity: float) -> DataFrame:
    """a, b, cut: pairs of mixed_members that share a key and not the label; n texts have the key. bounds: see _bounds.

    Crowded keys are dealt out as pairs of their parts.
    """
    parts = F.ceil(F.col("n") / crowded).cast("int")
    known = bounds.withColumnRenamed("sig", "s")
    split = mixed.join(known, F.col("sig") == F.col("s")).withColumn("own", F.pmod(F.xxhash64("sig", F.lit(1)), parts).cast("int"))
    dealt = split.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    group = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    buckets = 16 * shuffle_partitions(mixed.sparkSession)
    rows = dealt.select(group.alias("group"), "label", "own", "sig", "size", "common", (F.col("own") == F.col("other")).alias("inner"), F.pmod(group, F.lit(buckets)).alias("bucket"))
    return rows.groupBy("bucket").applyInArrow(_across(limit, similarity), "a long, b long, cut boolean")


def near_copy_groups(docs: DataFrame, similarity: float = 0.8, shingle: int = 5, feature: int = 2, budget: int = 8, blocks: int = 10, first_limit: int = 4, crowded: int = 1024) -> DataFrame:
    """node, sig, head, head_sig: a row for each row of docs, by doc_id (null is NULL_ID) and hash of its text; head is the least of its group.

    Groups are the components of distinct texts linked by a Jaccard similarity of their shingles. Candidates are, first,
    spanning links of fingerprints (of distinct runs of `feature` words, which differ in fewer bits than those of longer
    shingles) and of all texts that share a band print; those links stay whose shingles are as similar as asked. Then all pairs
    that share a band print and are not yet in one group are tried, a few per text at first, until none is left untried.
    """
    ids = docs.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("node"), "text", F.xxhash64("text").alias("sig"))
    rows = stored(_prints(ids, feature, shingle))
    texts = stored(rows.groupBy("sig").agg(F.min("node").alias("node"), F.first("fp").alias("fp"), F.first("bands").alias("bands")))
    alike = stored(texts.groupBy("fp").agg(F.min("sig").alias("first"), F.count("*").alias("n")))
    found = similar_links(alike.select(F.col("first").alias("node"), "fp"), budget, blocks, nearest=True)
    same = texts.join(alike.where("n > 1"), "fp").where("sig <> first").select(F.col("first").alias("a"), F.col("sig").alias("b"))
    spread = texts.select("sig", F.explode("bands").alias("key"))
    hubs = stored(spread.groupBy("key").agg(F.min("sig").alias("first"), F.count("*").alias("n")).where("n > 1").withColumnRenamed("key", "k"))
    members = stored(spread.join(hubs, F.col("key") == F.col("k")).select("key", "n", "first", "sig"))
    shared = members.where("sig <> first").select(F.col("first").alias("a"), F.col("sig").alias("b"))
    ordered = lambda p: stored(p.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    prints, near = ordered(same.unionByName(shared)), ordered(found)
    linked = prints.select(F.col("a").alias("sig")).union(prints.select("b")).union(near.select("a")).union(near.select("b")).distinct()
    one_each = texts.join(linked, "sig", "left_semi").select("node", "sig")
    # linked grows with docs; rows that are wholly alike leave one sketch
    sketches = stored(_sketches(ids.join(one_each.hint("merge"), ["node", "sig"], "left_semi"), shingle).dropDuplicates(["sig"]))
    of = lambda name: sketches.select(F.col("sig").alias(name), F.col("sketch").alias(f"sketch_{name}"))
    confirmed = lambda p: p.join(of("a"), "a").join(of("b"), "b").select("a", "b", "sketch_a", "sketch_b").mapInArrow(_confirm(similarity), "a long, b long")
    links = stored(confirmed(prints))
    # of the fingerprints' links only those are tried that would join groups
    label = stored(components(links))
    ends = [label.select(F.col("node").alias(f"n{c}"), F.col("component").alias(f"c{c}")) for c in ("a", "b")]
    apart = near.join(ends[0], F.col("a") == F.col("na"), "left").join(ends[1], F.col("b") == F.col("nb"), "left")
    apart = stored(apart.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b").join(prints, ["a", "b"], "left_anti"))
    tried, limit = prints.unionByName(apart), first_limit
    links = links.unionByName(stored(confirmed(apart)))
    groups, bounds = stored(components(links)), None
    while True:
        mixed = stored(mixed_members(members.select("key", "n", "sig"), groups))
        if bounds is None:  # later rounds join groups, so no other texts come to stand under several labels
            bounds = stored(_bounds(sketches.join(mixed.select("sig").distinct(), "sig", "left_semi")))
        found = stored(across_pairs(mixed, bounds, limit, crowded, similarity).groupBy("a", "b").agg(F.max("cut").alias("cut")))
        fresh = stored(found.where("a <> b").select("a", "b").join(tried, ["a", "b"], "left_anti"))
        more = stored(confirmed(fresh))
        if not more.isEmpty():
            links = links.unionByName(more)
            groups = stored(components(links))
        if found.where("cut").isEmpty():
            break
        tried, limit = tried.unionByName(fresh), limit * 16
    grouped = texts.select("sig", "node").join(groups.withColumnRenamed("node", "member"), F.col("sig") == F.col("member"), "left").select("sig", "node", F.coalesce("component", "sig").alias("group"))
    heads = grouped.groupBy("group").agg(F.min(F.struct("node", "sig")).alias("least")).withColumnRenamed("group", "g")
    least = grouped.join(heads, F.col("group") == F.col("g")).select(F.col("sig").alias("_sig"), "least.*").toDF("_sig", "head", "head_sig")
    return rows.select("node", "sig").join(stored(least), F.col("sig") == F.col("_sig")).select("node", "sig", "head", "head_sig")


def near_copies(docs: DataFrame, similarity: float = 0.8, shingle: int = 5, feature: int = 2, budget: int = 8, blocks: int = 10) -> DataFrame:
    """doc_id, component: a row for each row of docs; component is the least doc_id of its near_copy_groups."""
    real = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return near_copy_groups(docs, similarity, shingle, feature, budget, blocks).select(real("node").alias("doc_id"), real("head").alias("component"))


def op7_simhash_components(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return simhash_components(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))
