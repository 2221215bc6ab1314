"""Centroid clustering of vectors in exact integers, with float32 products as a screen.

1. Vectors of the right length without null or non-finite components are a table of floor(scale * x), which a double
   holds exactly. The first centroids are the k vectors with the smallest hash of their id.
2. A pass takes Arrow batches of vectors against all centroids. |c|^2 - 2 x.c comes from one float32 matrix product;
   its rounding error is bounded by ERROR * |x| * |c| whatever the order of the sums, so each value is an interval. A
   centroid whose interval lies above another's upper end is out. Where more than one is left, their distances are
   recomputed in integers, and the lowest number wins a tie.
3. Tasks add up their vectors by centroid and send sums as limbs of 40 bits, so that no sum overflows. Spark adds
   these; the driver gets k rows a limb and takes floor(sum / count). Centroids are k * components integers, however many vectors there are.

Edge cases: repeated rows count each. A null id hashes as the empty text after the seed. Vectors with the same hash
are taken in the order of their components. With fewer than k vectors there are as many centroids as vectors. Vectors for which
scale * x is no finite double are left out. Components beyond INT_SAFE are worked out in Python integers; a distance or an
inertia that no long can hold is null. Extra columns are kept by clustered() unless they carry a name of the result. No vectors: no rows.
"""

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored

#: Differences of such integers can be squared and summed in 64 bits, for up to 1,024 components.
INT_SAFE = 1 << 25
#: float32 products of numbers up to this cannot overflow.
FLOAT_SAFE = float(1 << 55)
#: Unit roundoff of float32 and of double.
U32, U64 = 2.0**-24, 2.0**-53
#: Rows that are recomputed at once, so that all their differences fit a few MB.
AT_ONCE = 1024
LIMB = 40
LONG_MAX = (1 << 63) - 1


def quantised(vectors: DataFrame, dims: int, scale: float, vector: str) -> DataFrame:
    """The vectors that count, with _q: floor(scale * x) of each component as a double."""
    scaled = F.transform(vector, lambda x: x.cast("double") * F.lit(float(scale)))
    whole = lambda y: F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).otherwise(y)  # noqa: E731  doubles beyond are whole numbers
    finite = F.forall("_y", lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y) < float("inf")))
    # the length is looked at before the components are
    right = F.when(F.size(vector) == dims, scaled)
    return vectors.withColumn("_y", right).where(F.col("_y").isNotNull() & finite).withColumn("_q", F.transform("_y", whole)).drop("_y")


def first_centroids(points: DataFrame, k: int, order: Column) -> list[list[int]]:
    """The components of the k vectors that come first."""
    rows = points.select(order.alias("_order"), "_q").orderBy("_order", "_q").limit(k).collect()
    return [[int(x) for x in row["_q"]] for row in rows]


def _exact(rows: np.ndarray, centroids: list[list[int]], pairs: np.ndarray) -> np.ndarray:
    """Squared distances in integers for the chosen pairs (a boolean matrix); -1 elsewhere."""
    at, to = np.nonzero(pairs)
    safe = len(rows) == 0 or max(np.abs(rows).max(), max(abs(c) for row in centroids for c in row)) < INT_SAFE
    if safe:
        out = np.full(pairs.shape, -1, dtype=np.int64)
        whole, table = rows.astype(np.int64), np.array(centroids, dtype=np.int64)
    else:
        out = np.full(pairs.shape, -1, dtype=object)
        whole, table = np.array([[int(x) for x in row] for row in rows], dtype=object), np.array(centroids, dtype=object)
    for lo in range(0, len(at), AT_ONCE * 16):
        i, j = at[lo : lo + AT_ONCE * 16], to[lo : lo + AT_ONCE * 16]
        off = whole[i] - table[j]
        out[i, j] = (off * off).sum(axis=1)
    return out


def shortlist(rows: np.ndarray, centroids: list[list[int]]) -> np.ndarray:
    """Which centroids can be nearest to which row: intervals around float32 products that surely hold the true values."""
    table = np.array([[float(c) for c in row] for row in centroids])
    dims = rows.shape[1]
    wide = np.abs(rows).max(axis=1) >= FLOAT_SAFE
    if np.abs(table).max() >= FLOAT_SAFE:
        return np.ones((len(rows), len(centroids)), dtype=bool)
    tame = np.where(wide[:, None], 0.0, rows)
    products = (tame.astype(np.float32) @ table.astype(np.float32).T).astype(np.float64)
    squares = np.array([float(sum(c * c for c in row)) for row in centroids])
    lengths = np.sqrt((tame * tame).sum(axis=1))[:, None] * np.sqrt(squares)[None, :]
    # each product errs by at most (dims + 2) u / (1 - (dims + 2) u) * |x| |c|: two roundings to float32, dims products and sums
    n = (dims + 2) * U32
    slack = 2 * (n / (1 - n)) * lengths * (1 + 1e-9) + 8 * U64 * (squares[None, :] + 2 * np.abs(products))
    values = squares[None, :] - 2 * products
    possible = values - slack <= (values + slack).min(axis=1)[:, None]
    possible[wide] = True
    return possible


def nearest(rows: np.ndarray, centroids: list[list[int]]) -> np.ndarray:
    """The number of the nearest centroid of each row, the lowest of equally near ones; exact."""
    if not len(rows):
        return np.zeros(0, dtype=np.int64)
    possible = shortlist(rows, centroids)
    out = possible.argmax(axis=1)
    open_ = np.flatnonzero(possible.sum(axis=1) > 1)
    for lo in range(0, len(open_), AT_ONCE):
        some = open_[lo : lo + AT_ONCE]
        far = _exact(rows[some], centroids, possible[some])
        for i, row in zip(some, far) if far.dtype == object else ():
            out[i] = min((d, j) for j, d in enumerate(row) if d >= 0)[1]
        if far.dtype != object:
            out[some] = np.where(far < 0, LONG_MAX, far).argmin(axis=1)
    return out


def distances(rows: np.ndarray, centroids: list[list[int]], to: np.ndarray) -> list[int]:
    """Squared distance of each row to its centroid."""
    out: list[int] = []
    for lo in range(0, len(rows), AT_ONCE):
        part, at = rows[lo : lo + AT_ONCE], to[lo : lo + AT_ONCE]
        pairs = np.zeros((len(part), len(centroids)), dtype=bool)
        pairs[np.arange(len(part)), at] = True
        out += _exact(part, centroids, pairs)[pairs].tolist()
    return out


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("_q")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _limbs(total: int) -> list[int]:
    """total as a sum of limb i << LIMB * i; the last limb has the sign."""
    out = []
    while not -(1 << LIMB) < total < 1 << LIMB:
        out.append(total & ((1 << LIMB) - 1))
        total >>= LIMB
    return [*out, total]


def _map_sums(centroids: list[list[int]]):
    def run(batches):
        k, dims = len(centroids), len(centroids[0])
        sums, counts = np.zeros((k, dims), dtype=object), np.zeros(k, dtype=np.int64)
        sums += 0
        for batch in batches:
            rows = _matrix(batch)
            to = nearest(rows, centroids)
            for c in np.unique(to):
                own = rows[to == c]
                counts[c] += len(own)
                # a batch of so small numbers adds up exactly in doubles
                exact = np.abs(own).max() * len(own) < 2.0**53
                sums[c] += np.array([int(x) for x in own.sum(axis=0)] if exact else [sum(map(int, column)) for column in own.T], dtype=object)
        made = []
        for c in np.flatnonzero(counts):
            limbs = [_limbs(int(s)) for s in sums[c]]
            made += [(int(c), i, int(counts[c]) if i == 0 else 0, [x[i] if i < len(x) else 0 for x in limbs]) for i in range(max(map(len, limbs)))]
        columns = list(zip(*made)) or [[], [], [], []]
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(list(x), kind) for x, kind in zip(columns, kinds)], names=["cluster", "limb", "n", "sums"])

    return run


def moved_centroids(points: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Each centroid as floor(sum / count) of the vectors nearest to it; one without any stays."""
    dims = range(len(centroids[0]))
    parts = points.select("_q").mapInArrow(_map_sums(centroids), "cluster int, limb int, n long, sums array<long>")
    rows = parts.groupBy("cluster", "limb").agg(F.sum("n").alias("n"), *(F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in dims)).collect()
    counts, totals = {}, {}
    for row in rows:
        c = row["cluster"]
        counts[c] = counts.get(c, 0) + row["n"]
        own = totals.setdefault(c, [0 for _ in dims])
        for i in dims:
            own[i] += row[f"s{i}"] << (LIMB * row["limb"])
    return [[s // counts[c] for s in totals[c]] if c in totals else old for c, old in enumerate(centroids)]


def assigned(points: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """points with cluster and distance in place of _q."""
    kept = [c for c in points.columns if c != "_q"]

    def run(batches):
        for batch in batches:
            rows = _matrix(batch)
            to = nearest(rows, centroids)
            far = [d if d <= LONG_MAX else None for d in distances(rows, centroids, to)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(to, pa.int32()), pa.array(far, pa.int64())], names=[*kept, "cluster", "distance"])

    schema = points.select(*kept).schema.add("cluster", T.IntegerType()).add("distance", T.LongType())
    return points.mapInArrow(run, schema)


def clustered(vectors: DataFrame, k: int, rounds: int, dims: int, scale: float = 256, seed: str = "2:", vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The vectors that count without their components, with cluster, distance, cluster_inertia, inertia and centroid_sha256."""
    made = {"_q", "_y", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"}
    extra = [c for c in vectors.columns if c not in made and c != vector]
    points = stored(quantised(vectors.select(*extra, vector), dims, scale, vector).drop(vector))
    order = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col(vec_id).cast("string"), F.lit(""))), 256)
    centroids = first_centroids(points, k, order)
    if not centroids:
        return points.drop("_q").selectExpr("*", "cast(null as int) cluster", "cast(null as long) distance", "cast(null as long) cluster_inertia", "cast(null as long) inertia", "cast(null as string) centroid_sha256")
    for _ in range(rounds):
        centroids = moved_centroids(points, centroids)
    found = stored(assigned(points, centroids))
    # k rows; one that holds a null has a null sum
    per = found.groupBy("cluster").agg(F.when(F.count("distance") == F.count("*"), F.sum(F.col("distance").cast("decimal(38,0)"))).alias("total")).collect()
    totals = {row["cluster"]: int(row["total"]) if row["total"] is not None else None for row in per}
    every = reduce(lambda a, b: None if a is None or b is None else a + b, totals.values(), 0)
    fits = lambda x: x if x is not None and x <= LONG_MAX else None
    of = lambda values, kind: F.get(F.array(*(F.lit(v).cast(kind) for v in values)), F.col("cluster"))
    prints = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return found.withColumns(
        {"cluster_inertia": of([fits(totals.get(c)) for c in range(len(centroids))], "long"), "inertia": F.lit(fits(every)).cast("long"), "centroid_sha256": of(prints, "string")}
    )


def op11_centroid_clusters(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return clustered(vectors, k=40, rounds=5, dims=64)


def _sql(k: int, rounds: int, dims: int) -> str:
    """The same by plain integer distances to all centroids, every round spelled out."""
    steps = []
    for r in range(rounds + 1):
        steps.append(
            f"d{r} AS MATERIALIZED (SELECT q.vec_id, c.c, sum((q.x - c.x) * (q.x - c.x))::BIGINT AS d FROM q JOIN c{r} c ON q.i = c.i GROUP BY q.vec_id, c.c),\n"
            f"a{r} AS MATERIALIZED (SELECT vec_id, arg_min(c, d * 1000 + c) AS c, min(d) AS d FROM d{r} GROUP BY vec_id)"
        )
        if r < rounds:
            steps.append(
                f"m{r} AS MATERIALIZED (SELECT a.c, q.i, sum(q.x)::BIGINT AS s, count(*) AS n FROM q JOIN a{r} a USING (vec_id) GROUP BY a.c, q.i),\n"
                f"c{r + 1} AS MATERIALIZED (SELECT o.c, o.i, CASE WHEN m.s IS NULL THEN o.x ELSE (m.s - ((m.s % m.n) + m.n) % m.n) // m.n END AS x FROM c{r} o LEFT JOIN m{r} m ON o.c = m.c AND o.i = m.i)"
            )
    return f"""
WITH e AS (SELECT vec_id, embedding FROM embeddings WHERE len(embedding) = {dims}
           AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}),
q AS MATERIALIZED (SELECT vec_id, unnest(range(1, {dims + 1})) AS i, unnest(list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT)) AS x FROM e),
f AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c FROM e QUALIFY c < {k}),
c0 AS MATERIALIZED (SELECT f.c, q.i, q.x FROM f JOIN q USING (vec_id)),
{(","+chr(10)).join(steps)},
p AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
SELECT a.vec_id, a.c::INTEGER AS cluster, a.d AS distance, (sum(a.d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
       (sum(a.d) OVER ())::BIGINT AS inertia, p.centroid_sha256
FROM a{rounds} a JOIN p USING (c)
"""


SQL = _sql(40, 5, 64)
