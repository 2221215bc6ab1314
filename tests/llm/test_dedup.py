"""Exact operators against plain versions and SQL, and each edge case of their docstrings."""

from zlib import crc32

import pytest
from pyspark.sql import functions as F

from pressmill.llm import line_dedup, mixing, queries, simhash, substring_dedup, suffix_dedup
from tests.llm import brute
from tests.oracle import agree

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "a fairly long line that surely has more than forty characters in it, whatever comes"
EDGES = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, "word", "en", "a", 4), (4, LONG * 3, "en", "b", 1), (5, LONG * 3, "en", "b", 1),
    (6, f"x\n{LONG}\n{LONG.upper()} \ny", "en", None, 1), (7, LONG, "en", "a", 1), (8, f" {LONG}\t", "en", "a", 1), (9, f"\n\n{LONG}", "en", "a", 1),
    (10, "Ünïcödé wörds " * 40, "de", "a", 1), (11, "Ünïcödé wörds " * 40 + "end", "de", "a", 1), (12, "w " * 60_000, "xx", "b", 1), (13, " \t\n\x0b\r ", None, "a", 3),
    (14, f"{LONG}\nz", "en", "b", 1),
]


def texts(spark, path):
    return [tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, SCHEMA)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, medium, name):
    agree(spark, medium, queries.QUERIES[name], queries.SQL[name])


def test_suffix_dedup(spark, medium):
    got = {r[0]: tuple(r[1:]) for r in suffix_dedup.op1_suffix_dedup(spark, medium).collect()}
    assert got == brute.suffix_dedup(texts(spark, medium))


def test_suffix_dedup_edges(edges):
    got = {r[0]: tuple(r[1:]) for r in suffix_dedup.remove_repeats(edges, with_text=False).collect()}
    assert got == brute.suffix_dedup([(r[0], r[1]) for r in EDGES])


@pytest.fixture(scope="module")
def alike_by_crc():
    """Two texts of different length and one CRC-32, the longer of which repeats itself and another text."""
    seen = {}
    for n in range(1_000_000):
        long = n % 2 == 0
        text = f"{n} " + " ".join(f"w{(n * 31 + i) % 9973}" for i in range(40)) + (" " + " ".join(f"common{i}" for i in range(40)) if long else "")
        other = seen.setdefault((crc32(text.encode()), not long), None)
        if other is not None:
            return (text, other) if long else (other, text)
        seen[(crc32(text.encode()), long)] = text
    raise AssertionError("no pair")


@pytest.mark.parametrize("doc_id", [7, None])
@pytest.mark.parametrize("turned", [False, True])
def test_rows_of_one_id_and_crc(spark, alike_by_crc, doc_id, turned):
    long, short = alike_by_crc
    assert crc32(long.encode()) == crc32(short.encode()) and len(long) > len(short)
    common = " ".join(f"common{i}" for i in range(40))
    rows = [(doc_id, long), (doc_id, short)][:: -1 if turned else 1] + [(9, f"{common} ends here"), (None if doc_id else 1, "before all")]
    table = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    # the later document loses what the long text holds; neither row of the shared id is taken for the other
    words = {(r["doc_id"], r["kept"].decode()): r["n_removed"] for r in substring_dedup.remove_repeated_words(table).collect()}
    assert words[(doc_id, long)] == words[(doc_id, short)] == 0 and words[(9, "ends here")] == 40
    spans = {(r["doc_id"], r["kept"].decode()): r["n_removed"] for r in suffix_dedup.remove_repeats(table).collect()}
    assert spans[(doc_id, long)] == spans[(doc_id, short)] == 0 and spans[(9, " ends here")] == len(common)


def test_suffix_dedup_crowded_gram(spark):
    # one common middle in very many contexts, some of which repeat
    middle = "the same forty-eight characters stand in each text"
    rows = [(i, f"{i * 7919:060d}"[::-1] + middle + f"{i * 104729 % 97:080d}" + "tail " * (i % 5)) for i in range(300)]
    got = {r[0]: tuple(r[1:]) for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), with_text=False).collect()}
    assert got == brute.suffix_dedup(rows)


def test_suffix_dedup_heavy_grams(spark, monkeypatch, edges):
    from pressmill.llm import anchors

    for bound in (0, 64):
        monkeypatch.setattr(anchors, "CROWDED", bound)
        got = {r[0]: tuple(r[1:]) for r in suffix_dedup.remove_repeats(edges, with_text=False).collect()}
        assert got == brute.suffix_dedup([(r[0], r[1]) for r in EDGES])
        test_suffix_dedup_crowded_gram(spark)


def test_suffix_index_takes_batches(spark, small, tmp_path):
    rows = sorted((r for r in texts(spark, small)), key=lambda r: r[0])
    rows += [(10**6 + k, rows[k][1]) for k in (3, 50)] + [(10**7, None), (10**7 + 1, "x" * 99), (10**7 + 2, "x" * 250)]
    want, got, ranks = brute.suffix_dedup(rows), {}, []
    for n in range(5):
        part = spark.createDataFrame(rows[n * len(rows) // 5 : (n + 1) * len(rows) // 5], "doc_id long, text string").repartition(3)
        index = suffix_dedup.SuffixIndex(spark, f"file://{tmp_path}/index", buckets=8)  # opened anew for each batch
        found = suffix_dedup.remove_repeats(part, with_text=False, spans=index.add(part))
        got |= {r[0]: tuple(r[1:]) for r in found.collect()}
        ranks.append([rank for rank, _ in index.levels()])
    assert ranks == [[0], [1], [1, 0], [2], [2, 0]] and got == want
    again = index.add(spark.createDataFrame(rows[:40], "doc_id long, text string"))
    assert suffix_dedup.remove_repeats(spark.createDataFrame(rows[:40], "doc_id long, text string"), spans=again).where("n_bytes >= 100 and n_removed < n_bytes").isEmpty()


def test_suffix_levels_are_in_the_order_of_the_text():
    import random

    import numpy as np

    rnd, window = random.Random(9), 20
    text = bytes(rnd.choices(b"ab\x00\xff", [9, 9, 1, 1], k=3000))
    text += text[500:1500] + text[:200]
    index, seen = suffix_dedup.SuffixLevels(np.frombuffer(text, dtype=np.uint8), window), {}
    places = np.arange(len(text) - window + 1)
    for lo in range(0, len(places), 100):
        found = index.add(places[lo : lo + 100])
        for p, earlier in zip(range(lo, lo + 100), found.tolist()):
            own = text[p : p + window]
            assert (earlier < 0) == (own not in seen) and (earlier < 0 or text[earlier : earlier + window] == own and earlier < p)
            seen.setdefault(own, p)
        sizes = [len(level) for level in index.levels]
        assert all(a > 2 * b for a, b in zip(sizes, sizes[1:])) and sum(sizes) == len(seen)
        for level in index.levels:
            strings = [text[p : p + window] for p in level.tolist()]
            assert strings == sorted(strings)


def test_substring_dedup(spark, medium):
    got = {r[0]: tuple(r[1:]) for r in substring_dedup.op2_substring_dedup(spark, medium).collect()}
    assert got == brute.substring_dedup(texts(spark, medium))


def test_substring_dedup_edges(edges):
    got = {r[0]: tuple(r[1:]) for r in substring_dedup.remove_repeated_words(edges, with_text=False).collect()}
    assert got == brute.substring_dedup([(r[0], r[1]) for r in EDGES])


def test_simhash(spark, medium):
    got = {r[0]: (r[1], r[2]) for r in simhash.op7_simhash_components(spark, medium).collect()}
    assert got == brute.simhash(texts(spark, medium))


def test_simhash_edges_and_splits(spark, edges):
    got = {r[0]: r[2] for r in simhash.simhash_components(edges).collect()}
    want = brute.simhash([(r[0], r[1]) for r in EDGES])
    assert got == {k: v[1] for k, v in want.items()}
    import random

    rnd, fps = random.Random(5), []
    for _ in range(120):
        base = rnd.getrandbits(64)
        for _ in range(8):
            fps.append(base)
            for bit in rnd.sample(range(64), rnd.randint(1, 4)):
                base ^= 1 << bit
    fps = sorted(set(fps))
    nodes = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)], "node long, fp long")
    want = brute.linked(fps, 4)
    for crowded in (20_000, 3):
        links = [(r.a, r.b) for r in simhash.similar_links(nodes, crowded=crowded).collect()]
        assert brute.classes(len(fps), links) == brute.classes(len(fps), want)


def test_substring_dedup_heavy_grams(spark, monkeypatch, edges):
    # with a low bound nearly every gram is heavy, and the windows are dealt out one by one
    from pressmill.llm import anchors

    middle = "the same five words and more stand in each text of this table here"
    rows = [(i, f"{' '.join(str(i * 7919 + k) for k in range(9))} {middle} {' '.join(str(i % 97 + k) for k in range(14))}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    for bound in (0, 64, 4096):
        monkeypatch.setattr(anchors, "CROWDED", bound)
        got = {r[0]: tuple(r[1:]) for r in substring_dedup.remove_repeated_words(docs, with_text=False).collect()}
        assert got == brute.substring_dedup(rows)
    monkeypatch.setattr(anchors, "CROWDED", 0)
    got = {r[0]: tuple(r[1:]) for r in substring_dedup.remove_repeated_words(edges, with_text=False).collect()}
    assert got == brute.substring_dedup([(r[0], r[1]) for r in EDGES])


def test_substring_dedup_giant_document(spark):
    words = [f"{k * 2654435761 % 999983:x}" for k in range(1_100_000)]
    cut = substring_dedup.PIECE
    rows = [(1, " ".join(words)), (2, " ".join(words[cut - 30 : cut + 30])), (0, " ".join(words[cut - 7 : cut + 9])), (3, " ".join(words[-400_000:]))]
    got = {r[0]: tuple(r[1:]) for r in substring_dedup.remove_repeated_words(spark.createDataFrame(rows, "doc_id long, text string"), with_text=False).collect()}
    assert got == brute.substring_dedup(rows)


def test_substring_dedup_rejects_what_the_sources_do_not_hold(spark, monkeypatch):
    text = " ".join(f"w{k}" for k in range(40))
    docs = spark.createDataFrame([(1, text), (2, f"own words {text}"), (3, "x " * 40), (None, text)], "doc_id long, text string")
    right = substring_dedup.repeated_paths

    def wrong_at_first(docs, window, seed):
        found = right(docs, window, seed)
        return found if seed else found.withColumn("at", F.when(F.col("doc") == 2, F.col("at") + 1).otherwise(F.col("at")))

    monkeypatch.setattr(substring_dedup, "repeated_paths", wrong_at_first)
    got = sorted((r[0] or 0, r[1], r[2]) for r in substring_dedup.remove_repeated_words(docs).collect())
    assert got == [(0, 40, 0), (1, 40, 40), (2, 42, 40), (3, 40, 0)]


@pytest.mark.parametrize("sizes", [(300, 8, 4, 0), (60, 30, 8, 0), (500, 4, 4, 5), (1, 3, 3, 0), (0, 1, 1, 0)])
def test_trie_walk_on_deep_groups(monkeypatch, sizes):
    import random

    import numpy as np

    monkeypatch.setattr(simhash, "FRONTIER", 1000)
    clusters, size, budget, top = sizes
    rnd, fps = random.Random(7), [0, 0, (1 << 64) - 1, 5]
    for _ in range(clusters):
        base = rnd.getrandbits(64)
        for _ in range(size):
            fps.append(base)
            for bit in rnd.sample(range(64), rnd.randint(1, budget)):
                base ^= 1 << bit
    fps = sorted(fps)
    turned = np.array(fps, dtype=np.uint64)
    heads = np.array([f >> (64 - top) for f in fps])
    starts = np.flatnonzero(np.append(True, heads[1:] != heads[:-1]))
    groups = simhash._Groups(len(fps))
    nearest = simhash.trie_links(turned, starts, np.append(starts[1:], len(fps)), np.full(len(starts), top), budget, groups)
    pairs = [(i, j) for i, j in brute.linked(fps, budget) if heads[i] == heads[j]]
    assert brute.classes(len(fps), list(enumerate(groups.label.tolist()))) == brute.classes(len(fps), pairs)
    apart = lambda i, j: (fps[i] ^ fps[j]).bit_count()
    least = {}
    for i, j in pairs:
        least[j] = min(least.get(j, 64), apart(i, j))
    assert {j: apart(i, j) for j, i in enumerate(nearest.tolist()) if i >= 0} == least


def test_lines_and_mix_edges(spark, edges):
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_text) for r in line_dedup.line_dedup(edges).collect()}
    assert got[1] == got[2] == (1, 0, "")
    assert got[6] == (4, 2, "x\ny") and got[7] == (1, 1, "") and got[9] == (3, 1, "\n") and got[14] == (2, 0, f"{LONG}\nz")
    assert {r.doc_id for r in mixing.mix_sources(edges).collect()} == {r[0] for r in EDGES}
    # many runs in one long text, and one line in enough documents to fill all slices
    long = "\n".join(f"{LONG} {i}" if i % 3 else f"own line {i}" for i in range(3000))
    many = spark.createDataFrame([(i, long) for i in range(6)] + [(100 + i, f"{LONG}\n{i}") for i in range(2000)], "doc_id long, text string").repartition(11)
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_text) for r in line_dedup.line_dedup(many).collect()}
    assert all(got[i] == (3000, 2000, "\n".join(f"own line {k}" for k in range(0, 3000, 3))) for i in range(5)) and got[5] == (3000, 0, long)
    assert all(got[100 + i] == ((2, 1, str(i)) if i < 1999 else (2, 0, f"{LONG}\n{i}")) for i in range(2000))
    clash = edges.withColumn("size", F.lit("x")).withColumn("key", F.lit(1)).withColumn("starts", F.lit(2))
    assert mixing.mix_sources(clash).count() == line_dedup.line_dedup(clash).count() == len(EDGES)


def water_filling(sizes, weights=(3, 1, 2)):
    """source -> target: whatever exceeds a cap is shared again among those below theirs, until nothing does."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, open_ = dict.fromkeys(names, 0.0), 1.5 * sum(sizes.values()), set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > 2 * sizes[s]}
        for s in over or open_:
            target[s] = 2.0 * sizes[s] if over else weight[s] * level
        left -= sum(target[s] for s in over)
        open_ = open_ - over if over else set()
    return target


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_mix_meets_targets(spark, medium, sf):
    path = medium.replace("sf0.01", sf)
    docs = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "source")
    rows = mixing.op10_mix_sources(spark, path).join(docs, "doc_id")
    assert rows.where("taken < 0 or taken > 2 * size or target < 0 or target > 2 * source_size").isEmpty()
    found = rows.groupBy("source").agg(F.max("target").alias("t"), F.sum("taken").alias("n"), F.sum("size").alias("size"), F.max("size").alias("largest"), F.max("source_size").alias("m")).collect()
    want = water_filling({r.source: r["size"] for r in found})
    for r in found:
        assert r.m == r["size"] and abs(r.t - want[r.source]) < 1e-6 and abs(r.t - r.n) <= r.largest
    assert abs(sum(r.t for r in found) - 1.5 * sum(r["size"] for r in found)) < 1e-3


def test_targets_against_water_filling(spark):
    import random

    rnd = random.Random(3)
    for n in (1, 2, 5, 40):
        sizes = {f"s{i}": rnd.choice([0, 1, 10, 10, rnd.randrange(10**6)]) for i in range(n)} | {None: rnd.randrange(100)}
        table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in mixing.source_targets(table).collect()}
        want = water_filling(sizes)
        assert set(got) == set(want) and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_mix_by_quality(spark):
    # one source, half of which is to be taken once more; a quality of 0 comes last, null and NaN count as 1
    docs = spark.createDataFrame([(i, "w " * 10, "s") for i in range(400)], "doc_id long, text string, source string")
    kinds = [0.0, None, float("nan"), 50.0]
    quality = spark.createDataFrame([(i, kinds[i % 4]) for i in range(400)], "doc_id long, quality double")
    rows = mixing.mix_sources(docs, quality=quality)
    twice = {k: rows.where((F.col("doc_id") % 4 == k) & (F.col("copies") == 2)).count() for k in range(4)}
    assert rows.where("copies not in (1, 2)").isEmpty() and sum(twice.values()) == 200
    assert twice[0] == 0 and twice[3] > 95 and min(twice[1], twice[2]) > 30
    only_zero = mixing.mix_sources(docs, quality=quality.withColumn("quality", F.lit(0.0)))
    assert only_zero.where("copies = 2").count() == 200
    none = mixing.mix_sources(docs, quality=quality.limit(0))
    plain = lambda df: sorted((r.doc_id, r.copies) for r in df.collect())
    assert plain(none) == plain(mixing.mix_sources(docs)) != plain(rows)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (3, None), (None, 1)], "doc_id long, quality int")
    assert {r.doc_id: r.quality for r in mixing.quality_weights(labels).collect()} == {1: 1.0, 2: 1.5}


def test_running_sums(spark):
    from pressmill.llm.common import drop_stored, running_sums, scratch_dir

    rows = spark.createDataFrame([(i, i * i) for i in range(100)], "k long, v long").repartition(5)
    got = {r.k: (r.n, r.total) for r in running_sums(rows, [F.col("k").desc()], n=F.lit(1), total=F.col("v")).collect()}
    assert got == {i: (99 - i, sum(j * j for j in range(i + 1, 100))) for i in range(100)}
    folder = scratch_dir(spark).rsplit("/", 1)[0].removeprefix("file://")
    import os

    assert os.listdir(folder)
    drop_stored(spark)
    assert not os.path.exists(folder)


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, LONG), (1, LONG), (None, LONG), (2, LONG), (2, LONG * 2), (3, LONG), (4, LONG), (5, LONG)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for out in (suffix_dedup.remove_repeats(docs), substring_dedup.remove_repeated_words(docs), simhash.simhash_components(docs), line_dedup.line_dedup(docs), mixing.mix_sources(docs.withColumn("source", F.lit(None).cast("string")))):
        assert out.count() == len(rows)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for out in (suffix_dedup.remove_repeats(docs), substring_dedup.remove_repeated_words(docs), simhash.simhash_components(docs), line_dedup.line_dedup(docs), mixing.mix_sources(docs)):
        assert out.count() == 0
