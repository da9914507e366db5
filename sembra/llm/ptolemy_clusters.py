"""Centroid clustering in integers, with lower bounds from Ptolemy's inequality over fixed pivot pairs.

Components become integers, ``floor(scale * x)``; distances are squared Euclidean ones and exact.
Rounds are Lloyd's: every vector goes to its nearest centroid (ties: the smaller number), then each
centroid that has vectors becomes their componentwise floor(sum / count).

For any four points d(p,s) * d(x,c) >= |d(x,p) * d(c,s) - d(x,s) * d(c,p)| (Ptolemy). The distances
of every vector to a few pivots are computed once and kept with the vector; those of the centroids
are computed once a round. So each pivot pair bounds the distance of a vector to all centroids
without reading its components. The centroid with the least bound is measured first; of the others
only those are measured whose bound does not exceed that distance. Bounds are floats: each is
lowered by more than its rounding can be (``ROUNDING``), so a nearest centroid is never left out,
and survivors are compared by their exact integer distances.

Sums and counts are added up per task and centroid, then by Spark; the driver sees ``k`` rows a
round. Vectors are written once, with their pivot distances, and every round reads them in place.

Vectors that are null, of another length, or hold a null or non-finite component take no part, nor
do those with a component beyond ``LARGEST`` after scaling, as their distances fit in no long.
Rows that share an id are vectors of their own; a row with a null id has no hash, so such rows come
after all others as starts, in the order of their components. With fewer vectors than ``k`` there
are fewer centroids; an empty table gives no rows. An inertia that fits in no long is null. Extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from sembra.session import materialize

#: Components of at most 2^27 keep every squared distance of 64 of them below 2^62.
LARGEST = 1 << 27
#: Relative slack of a bound: far above the error of its five roundings, far below any use.
ROUNDING = 1e-12
BLOCK_ROWS = 4_096


@dataclass(frozen=True)
class ClusterSettings:
    k: int = 40
    rounds: int = 5
    dimensions: int = 64
    scale: int = 256
    pivots: int = 6
    seed: str = "2"


def integer_vectors(vectors: DataFrame, vector: str, key: str, settings: ClusterSettings) -> DataFrame:
    """(id, v) of the vectors that take part; v is an array of longs."""
    scaled = F.transform(F.col(vector), lambda x: x.cast("double") * F.lit(float(settings.scale)))
    usable = F.forall(scaled, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= F.lit(float(LARGEST))))
    # A null array, or one with nulls, makes the condition null or false: the row goes.
    good = vectors.where((F.size(vector) == settings.dimensions) & usable)
    return good.select(F.col(key).alias("id"), F.transform(scaled, lambda x: F.floor(x).cast("long")).alias("v"))


def first_centroids(points: DataFrame, settings: ClusterSettings) -> np.ndarray:
    """The vectors with the k smallest hashes of their ids, in that order."""
    named = F.sha2(F.concat(F.lit(settings.seed + ":"), F.col("id").cast("string")), 256)
    rows = points.withColumn("h", named).orderBy(F.col("h").asc_nulls_last(), "v").limit(settings.k).collect()
    return np.array([r.v for r in rows], np.int64).reshape(-1, settings.dimensions)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of ``a`` to ``b`` (one point, or as many rows)."""
    apart = a - b
    return np.einsum("ij,ij->i", apart, apart)


def choose_pivots(centroids: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` different starts far from each other: the first, then always the farthest one."""
    if not len(centroids):
        return centroids
    chosen, least = [0], squared(centroids, centroids[0])
    while len(chosen) < n and least.max() > 0:
        chosen.append(int(least.argmax()))
        least = np.minimum(least, squared(centroids, centroids[chosen[-1]]))
    return centroids[chosen]


def with_pivots(points: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(id, v, d): components and distances to the pivots, both as bytes; written once."""
    kind = points.schema["id"].dataType.simpleString()
    schema = StructType.fromDDL(f"id {kind}, v binary, d binary")

    def run(batches):
        types = to_arrow_schema(schema)
        for batch in batches:
            v = components(batch.column(1), pivots.shape[1])
            d = np.sqrt(np.stack([squared(v, p) for p in pivots], 1).astype(float))
            yield pa.RecordBatch.from_arrays([batch.column(0), as_bytes(v), as_bytes(d)], schema=types)

    return materialize(points.mapInArrow(run, schema), "pivot-distances")


def components(column, dimensions: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(-1, dimensions)


def as_bytes(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows)
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(rows.itemsize * rows.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows.tobytes())])


def from_bytes(column, kind, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


class Nearest:
    """Nearest centroids of blocks of vectors, and how many distances were measured for them."""

    def __init__(self, centroids: np.ndarray, pivots: np.ndarray):
        self.centroids = centroids
        c = np.sqrt(np.stack([squared(centroids, p) for p in pivots], 1).astype(float))
        self.pairs = []
        for p in range(len(pivots)):
            for s in range(p):
                apart = float(np.sqrt(float(squared(pivots[p : p + 1], pivots[s])[0])))
                self.pairs.append((p, s, np.stack([c[:, s], -c[:, p]]) / apart, np.stack([c[:, s], c[:, p]]) / apart))
        self.vectors = self.measured = 0

    def bounds(self, d: np.ndarray) -> np.ndarray:
        """Lower bounds of the distances of vectors, with pivot distances ``d``, to all centroids."""
        best = np.zeros((len(d), len(self.centroids)))
        for p, s, minus, plus in self.pairs:
            both = d[:, (p, s)]
            np.maximum(best, np.abs(both @ minus) - ROUNDING * (both @ plus), out=best)
        return best

    def __call__(self, v: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the nearest centroid, exact squared distance) of each vector."""
        low = self.bounds(d)
        low *= low * (1 - ROUNDING)
        rows = np.arange(len(v))
        cluster = low.argmin(1)
        distance = squared(v, self.centroids[cluster])
        # Longs are rounded when compared with floats; the slack covers that too.
        open_ = low <= (distance * (1 + ROUNDING))[:, None]
        open_[rows, cluster] = False
        self.vectors += len(v)
        self.measured += len(v) + int(open_.sum())
        for c in np.flatnonzero(open_.any(0)):
            at = np.flatnonzero(open_[:, c])
            found = squared(v[at], self.centroids[c])
            nearer = (found < distance[at]) | ((found == distance[at]) & (c < cluster[at]))
            cluster[at[nearer]], distance[at[nearer]] = c, found[nearer]
        return cluster, distance


def blocks(batches, dimensions: int, n_pivots: int):
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(start, BLOCK_ROWS)
            yield part, from_bytes(part.column(1), np.int64, dimensions), from_bytes(part.column(2), np.float64, n_pivots)


def next_centroids(points: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, int, int]:
    """The centroids after one round; with the vectors and the measured distances of it."""
    k, dimensions = centroids.shape
    schema = StructType.fromDDL("cluster int, n long, measured long, sums array<long>")

    def run(batches):
        nearest = Nearest(centroids, pivots)
        sums, counts = np.zeros((k, dimensions), np.int64), np.zeros(k, np.int64)
        for _, v, d in blocks(batches, dimensions, len(pivots)):
            cluster, _ = nearest(v, d)
            order = np.argsort(cluster, kind="stable")
            found, starts = np.unique(cluster[order], return_index=True)
            sums[found] += np.add.reduceat(v[order], starts, axis=0)
            counts += np.bincount(cluster, minlength=k)
        used = np.flatnonzero(counts)
        measured = np.zeros(len(used), np.int64)
        measured[:1] = nearest.measured
        rows = [pa.array(used.astype(np.int32)), pa.array(counts[used]), pa.array(measured), pa.array(list(sums[used]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(rows, schema=to_arrow_schema(schema))

    added = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(dimensions)]
    partial = points.mapInArrow(run, schema)
    rows = partial.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum("measured").alias("measured"), *added).collect()
    after = centroids.copy()
    for r in rows:
        after[r.cluster] = [int(r[f"s{i}"]) // r.n for i in range(dimensions)]
    return after, sum(r.n for r in rows), sum(r.measured for r in rows)


def assigned(points: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """(id, cluster, distance) of every vector."""
    schema = StructType.fromDDL(f"id {points.schema['id'].dataType.simpleString()}, cluster int, distance long")

    def run(batches):
        nearest, types = Nearest(centroids, pivots), to_arrow_schema(schema)
        for part, v, d in blocks(batches, centroids.shape[1], len(pivots)):
            cluster, distance = nearest(v, d)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance)], schema=types)

    return points.mapInArrow(run, schema)


@dataclass(frozen=True)
class Clusters:
    rows: DataFrame  # id, cluster, distance
    centroids: np.ndarray
    vectors: int  # of all rounds
    measured: int  # distances of vectors to centroids that the bounds left, of all rounds


def cluster_vectors(
    vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", settings: ClusterSettings = ClusterSettings()
) -> Clusters:
    """Cluster ``vectors`` in ``settings.rounds`` rounds and assign them once more."""
    points = integer_vectors(vectors, vector, key, settings)
    centroids = first_centroids(points, settings)
    if not len(centroids):
        return Clusters(points.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0), centroids, 0, 0)
    pivots = choose_pivots(centroids, settings.pivots)
    points, n, measured = with_pivots(points, pivots), 0, 0
    for _ in range(settings.rounds):
        centroids, seen, more = next_centroids(points, centroids, pivots)
        n, measured = n + seen, measured + more
    return Clusters(materialize(assigned(points, centroids, pivots), "clusters"), centroids, n, measured)


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def as_long(value: int) -> int | None:
    return value if value < 1 << 63 else None


def cluster_report(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", settings: ClusterSettings = ClusterSettings()) -> DataFrame:
    """``key``, cluster, distance, cluster_inertia, inertia and centroid_sha256, a row per vector."""
    found = cluster_vectors(vectors, vector, key, settings)
    # One row a cluster, so at most k.
    sums = found.rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    totals = {r.cluster: int(r.total) for r in sums}
    rows = [(c, as_long(t), as_long(sum(totals.values())), centroid_digest(found.centroids[c])) for c, t in sorted(totals.items())]
    told = vectors.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    joined = found.rows.join(F.broadcast(told), "cluster")
    return joined.select(F.col("id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def clusters_sql(settings: ClusterSettings = ClusterSettings()) -> str:
    """The contract's rows in DuckDB SQL over the view ``embeddings``: all distances, round by round."""
    apart = "CAST(list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT)"
    parts = [f"""
WITH x AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: CAST(floor({settings.scale} * CAST(e AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {settings.dimensions} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {settings.dimensions}
),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS n, v
  FROM (SELECT v, sha256('{settings.seed}:' || vec_id) AS h FROM x) ORDER BY h NULLS LAST, v LIMIT {settings.k}
)"""]  # fmt: skip
    for i in range(settings.rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT r, vec_id, v, pair.n AS n, pair.d AS d
  FROM (SELECT x.r, x.vec_id, x.v, min({{'d': {apart}, 'n': c.n}}) AS pair FROM x, c{i} c GROUP BY ALL)
)""")
        if i < settings.rounds:
            parts.append(f"""s{i} AS (
  SELECT n, i, CAST(sum(v[i]) AS BIGINT) AS t, count(*) AS m FROM (SELECT n, v, unnest(range(1, {settings.dimensions + 1})) AS i FROM a{i}) GROUP BY n, i
),
m{i} AS (SELECT n, list((t - ((t % m) + m) % m) // m ORDER BY i) AS v FROM s{i} GROUP BY n),
c{i + 1} AS MATERIALIZED (SELECT c.n, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN m{i} m ON m.n = c.n)""")
    last = settings.rounds
    return ",\n".join(parts) + f"""
SELECT a.vec_id, CAST(a.n AS INTEGER) AS cluster, a.d AS distance,
  CAST(sum(a.d) OVER (PARTITION BY a.n) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{last} a JOIN c{last} c ON c.n = a.n"""
