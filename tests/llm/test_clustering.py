"""Exact clustering against plain integers, and what the float32 screen may and may not rule out."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np

from pressmill.llm import clustering, queries
from tests.oracle import agree


def plain(rows, k, rounds, dims):
    """vec_id -> cluster, distance, cluster_inertia, inertia, centroid_sha256, for distinct ids."""
    kept = [(i, [math.floor(Fraction(x) * 256) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min((far(v, c), j) for j, c in enumerate(centroids))
    centroids = [v for _, v in sorted(kept, key=lambda r: hashlib.sha256(f"2:{r[0]}".encode()).hexdigest())[:k]]
    for _ in range(rounds):
        own = {}
        for _, v in kept:
            own.setdefault(near(v)[1], []).append(v)
        centroids = [[sum(x) // len(own[j]) for x in zip(*own[j])] if j in own else c for j, c in enumerate(centroids)]
    found = [(i, *near(v)[::-1]) for i, v in kept]
    total = lambda rows: (lambda s: s if s < 1 << 63 else None)(sum(r[2] for r in rows))
    long = lambda d: d if d < 1 << 63 else None
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return {i: (c, long(d), total([r for r in found if r[1] == c]), total(found), sha[c]) for i, c, d in found}


def ours(spark, rows, k, rounds, dims, partitions=3):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(partitions)
    return {r[0]: tuple(r[1:]) for r in clustering.clustered(table, k, rounds, dims).collect()}


def test_sql(spark, medium):
    agree(spark, medium, queries.QUERIES["op11_centroid_clusters"], queries.SQL["op11_centroid_clusters"])


def test_query(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = {r[0]: tuple(r[1:]) for r in clustering.op11_centroid_clusters(spark, small).collect()}
    assert got == plain(rows, 40, 5, 64)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [1.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 0.0]), (7, [1.0, 2.0, 3.0]), (8, [0.0, -0.001]), (9, [0.0, 0.0]), (10, [-1e-30, 1.0])]
    assert ours(spark, rows, 2, 3, 2) == plain(rows, 2, 3, 2)
    assert ours(spark, rows, 50, 2, 2) == plain(rows, 50, 2, 2)
    assert ours(spark, rows[:7], 2, 3, 2) == {}
    assert ours(spark, [], 2, 3, 2) == {}


def test_ties_and_copies(spark):
    # a lattice about its own mirror images: very many equal distances; and a third of the rows one vector
    draw = random.Random(5)
    rows = [(i, [float(draw.choice((-1, 0, 1))) for _ in range(4)]) for i in range(300)] + [(1000 + i, [1.0, 1.0, 0.0, 0.0]) for i in range(150)]
    assert ours(spark, rows, 7, 4, 4) == plain(rows, 7, 4, 4)


def test_large_numbers(spark):
    # differences that float32 cannot tell, numbers that no long holds, and distances that none holds
    draw = random.Random(6)
    close = [(i, [float(2**15 + draw.randint(0, 3) / 256) for _ in range(3)]) for i in range(120)]
    assert ours(spark, close, 6, 3, 3) == plain(close, 6, 3, 3)
    wide = close + [(500 + i, [draw.uniform(-1, 1) * 10.0 ** draw.randint(0, 40) for _ in range(3)]) for i in range(40)]
    assert ours(spark, wide, 6, 3, 3) == plain(wide, 6, 3, 3)


def test_other_columns(spark):
    table = spark.createDataFrame([(1, [1.0, 2.0], "a", 5), (1, [1.0, 2.0], "a", 5), (None, [3.0, 4.0], None, 6)], "vec_id long, embedding array<float>, _q string, note int")
    out = clustering.clustered(table, 1, 1, 2)
    assert out.columns == ["vec_id", "note", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    # the mean is floor(5 / 3 * 256) and floor(8 / 3 * 256)
    rows = sorted((r["vec_id"] or 0, r["note"], r["cluster"], r["distance"]) for r in out.collect())
    assert rows == [(0, 6, 0, (768 - 426) ** 2 + (1024 - 682) ** 2), *[(1, 5, 0, (256 - 426) ** 2 + (512 - 682) ** 2)] * 2]



def test_screen_keeps_the_nearest():
    draw = np.random.default_rng(1)
    for spread in (1, 100, 1 << 20, 1 << 40):
        rows = np.floor(draw.uniform(-spread, spread, (200, 64)))
        centroids = [[int(x) for x in row] for row in np.floor(draw.uniform(-spread, spread, (9, 64)))]
        possible = clustering.shortlist(rows, centroids)
        for row, some in zip(rows, possible):
            true = min((sum((int(x) - y) ** 2 for x, y in zip(row, c)), j) for j, c in enumerate(centroids))[1]
            assert some[true]
        assert possible.sum() < 2 * len(rows) or spread == 1


def test_limbs():
    for total in (0, -1, 1, 1 << 40, -(1 << 40), (1 << 200) + 12345, -(1 << 200) - 1, (1 << 40) - 1):
        assert sum(x << clustering.LIMB * i for i, x in enumerate(clustering._limbs(total))) == total
