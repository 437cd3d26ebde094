"""Centroid clustering with exact integer arithmetic, in which an n-simplex projection spares most comparisons.

Vectors become integers. A few pivots, taken from a bounded pool of vectors (those whose ids hash lowest), span a simplex. The
squared distances of a vector to the pivots are worked out once and kept as the coordinates of an apex over that simplex:
the pivots' subspace, and the height above it. For two apexes the Euclidean distance is a lower bound of the distance of
their vectors, and with one height turned downwards it is an upper bound. In each round a centroid is ruled out if its lower
bound exceeds the least upper bound of all; where several remain, they are compared exactly over all components. Bounds carry
a slack far above the rounding of doubles, so ties and near ties are always decided by integers.

The table of integers and apexes is written once in the shared folder and read in every round; a task returns one row of sums
per centroid. Only the centroids (`CLUSTERS` rows) and the pool (`POOL` rows) pass through the driver.

Defined results: vectors of another length, null, or with a component that is null, NaN or infinite are left out; components
are held within +-2**27 after scaling, so a squared distance fits in a long; rows with equal ids and vectors are rows like any
other; a null id is written as nothing when it is hashed; with fewer vectors than clusters there are as many clusters as
vectors; a table without usable vectors gives no rows. Only id and vector are read, so other columns can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.operators.maintenance import drop_folder
from postlake.session import checkpointed, shared_folder

COMPONENTS = 64
SCALE = 1024
LARGEST = 1 << 27
CLUSTERS = 8
ROUNDS = 10
SEED = "3"
POOL = 64
PIVOTS = 12
LEAST_HEIGHT = 0.05  # of a pivot over the pivots before it, as a share of the largest distance
SLACK = 1e-6  # of the squared distances to the first pivot; heights near 0 are only known to the root of a double's precision
CHUNK = 1 << 16  # vector and centroid pairs compared exactly at a time


def integer_points(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id and point: the usable vectors as integers."""
    values = F.col("values")
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("values"))
    usable = (F.size(values) == COMPONENTS) & F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.transform(
        values, lambda x: F.floor(F.greatest(F.least(x * SCALE, F.lit(float(LARGEST))), F.lit(float(-LARGEST)))).cast("int")
    )
    return rows.where(values.isNotNull() & usable).select("vec_id", scaled.alias("point"))


def lowest_hashes(points: DataFrame, most: int, seed: str = SEED) -> np.ndarray:
    """The points whose ids hash lowest, in the order of the hash."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = points.select(F.sha2(name, 256).alias("hash"), "point").orderBy("hash", "point").limit(most).collect()
    return np.array([row["point"] for row in rows], dtype=np.int64).reshape(len(rows), COMPONENTS)


def squared_distances(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact, one column per row of `others`."""
    out = np.empty((len(points), len(others)), dtype=np.int64)
    for at, other in enumerate(others):
        apart = points - other
        out[:, at] = np.einsum("ij,ij->i", apart, apart)
    return out


@dataclass
class Simplex:
    """Pivots, and what turns squared distances to them into apex coordinates."""

    pivots: np.ndarray
    inverse: np.ndarray
    squares: np.ndarray

    def apexes(self, points: np.ndarray) -> np.ndarray:
        """One row per point: coordinates within the span of the pivots, then the height above it."""
        apart = squared_distances(points, self.pivots).astype(np.float64)
        base = ((apart[:, :1] + self.squares - apart[:, 1:]) / 2) @ self.inverse.T
        height = np.sqrt(np.maximum(apart[:, 0] - np.einsum("ij,ij->i", base, base), 0))
        return np.column_stack((base, height))


def simplex_over(pivots: np.ndarray) -> Simplex:
    apart = squared_distances(pivots, pivots).astype(np.float64)
    gram = (apart[0, 1:, None] + apart[0, None, 1:] - apart[1:, 1:]) / 2
    corners = np.linalg.cholesky(gram) if len(gram) else gram
    return Simplex(pivots, np.linalg.inv(corners) if len(gram) else corners, apart[0, 1:])


def choose_simplex(pool: np.ndarray, most: int = PIVOTS) -> Simplex:
    """Pivots from `pool`: the first row, then always the one that is highest over the simplex so far."""
    simplex = simplex_over(pool[:1])
    widest = np.sqrt(squared_distances(pool, pool[:1]).max(initial=0))
    while len(simplex.pivots) < most:
        heights = simplex.apexes(pool)[:, -1]
        at = int(np.argmax(heights))
        if heights[at] <= LEAST_HEIGHT * widest:
            break
        simplex = simplex_over(np.concatenate((simplex.pivots, pool[at : at + 1])))
    return simplex


def remaining(apexes: np.ndarray, others: np.ndarray) -> np.ndarray:
    """For each apex and each of `others`, whether the bounds leave it as the nearest one possible."""
    base = np.stack([np.square(apexes[:, :-1] - other[:-1]).sum(axis=1) for other in others], axis=1)
    height, other_height = apexes[:, -1:], others[None, :, -1]
    slack = SLACK * (np.square(apexes).sum(axis=1)[:, None] + np.square(others).sum(axis=1)[None, :])
    lower = base + np.square(height - other_height) - slack
    upper = base + np.square(height + other_height) + slack
    return lower <= upper.min(axis=1)[:, None]


def nearest(points: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, simplex: Simplex) -> np.ndarray:
    """The number of the nearest centroid; of equally near ones the smallest."""
    left = remaining(apexes, simplex.apexes(centroids))
    several = np.flatnonzero(left.sum(axis=1) > 1)
    found = left.argmax(axis=1)
    for start in range(0, len(several), max(1, CHUNK // len(centroids))):
        rows = several[start : start + max(1, CHUNK // len(centroids))]
        at, number = np.nonzero(left[rows])
        apart = points[rows[at]] - centroids[number]
        exact = np.full((len(rows), len(centroids)), np.iinfo(np.int64).max)
        exact[at, number] = np.einsum("ij,ij->i", apart, apart)
        found[rows] = exact.argmin(axis=1)
    return found


def matrix(column: pa.Array, dtype) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def with_apexes(points: DataFrame, simplex: Simplex) -> DataFrame:
    shared = points.sparkSession.sparkContext.broadcast(simplex)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                apexes = shared.value.apexes(matrix(batch.column("point"), np.int64))
                offsets = np.arange(len(apexes) + 1, dtype=np.int32) * apexes.shape[1]
                column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(apexes.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, "apex"])

    return points.mapInArrow(run, T.StructType([*points.schema, T.StructField("apex", T.ArrayType(T.DoubleType()))]))


def moved(table: DataFrame, centroids: np.ndarray, simplex: Simplex) -> np.ndarray:
    """Each centroid at the floor of the mean of its vectors; one without vectors stays."""
    shared = table.sparkSession.sparkContext.broadcast((centroids, simplex))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, own_simplex = shared.value
        sums, sizes = np.zeros_like(own), np.zeros(len(own), dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                points = matrix(batch.column("point"), np.int64)
                found = nearest(points, matrix(batch.column("apex"), np.float64), own, own_simplex)
                for number in np.unique(found):
                    sums[number] += points[found == number].sum(axis=0)
                sizes += np.bincount(found, minlength=len(own))
        full = np.flatnonzero(sizes)
        yield pa.RecordBatch.from_arrays(
            [pa.array(full, type=pa.int32()), pa.array(sizes[full]), pa.array(list(sums[full]), type=pa.list_(pa.int64()))],
            names=["cluster", "size", "sums"],
        )

    parts = table.select("point", "apex").mapInArrow(run, "cluster int, size long, sums array<long>")
    totals = (
        parts.select("cluster", "size", F.posexplode("sums").alias("place", "part"))
        .groupBy("cluster", "place")
        .agg(F.sum("size").alias("size"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
    )
    new = centroids.copy()
    for row in totals.collect():  # one row per centroid and component
        new[row["cluster"], row["place"]] = int(row["total"]) // row["size"]
    return new


def assigned(table: DataFrame, centroids: np.ndarray, simplex: Simplex) -> DataFrame:
    """vec_id, cluster, distance."""
    shared = table.sparkSession.sparkContext.broadcast((centroids, simplex))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, own_simplex = shared.value
        for batch in batches:
            if batch.num_rows:
                points = matrix(batch.column("point"), np.int64)
                found = nearest(points, matrix(batch.column("apex"), np.float64), own, own_simplex)
                apart = points - own[found]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id"),
                        pa.array(found, type=pa.int32()),
                        pa.array(np.einsum("ij,ij->i", apart, apart), type=pa.int64()),
                    ],
                    names=["vec_id", "cluster", "distance"],
                )

    kept = [table.schema["vec_id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())]
    return table.mapInArrow(run, T.StructType(kept))


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: str = SEED, vec_id: str = "vec_id",
    embedding: str = "embedding", pivots: int = PIVOTS, observe: Callable[[np.ndarray], None] | None = None,
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256: one row per usable vector.

    `observe` is called with the centroids of each round.
    """
    spark = vectors.sparkSession
    points = integer_points(vectors, vec_id, embedding)
    pool = lowest_hashes(points, max(POOL, clusters), seed)
    out = T.StructType(
        [
            points.schema["vec_id"],
            *[T.StructField(name, kind) for name, kind in (("cluster", T.IntegerType()), ("distance", T.LongType()))],
            *[T.StructField(name, T.LongType()) for name in ("cluster_inertia", "inertia")],
            T.StructField("centroid_sha256", T.StringType()),
        ]
    )
    if not len(pool):
        return spark.createDataFrame([], out)
    centroids, simplex = pool[:clusters], choose_simplex(pool, pivots)
    folder = shared_folder(spark, "points")
    prepared = with_apexes(points, simplex)
    prepared.write.parquet(folder)
    table = spark.read.schema(prepared.schema).parquet(folder)
    for _ in range(rounds):
        centroids = moved(table, centroids, simplex)
        if observe:
            observe(centroids)
    found = checkpointed(assigned(table, centroids, simplex))
    drop_folder(spark, folder)
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("apart")).collect()
    inertia = sum(int(row["apart"]) for row in sums)
    facts = [
        (row["cluster"], int(row["apart"]), inertia, centroid_digest(centroids[row["cluster"]])) for row in sums
    ]  # one row per centroid at most
    by_cluster = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(by_cluster), "cluster").select(*out.names)


def oracle() -> str:
    """DuckDB SQL that compares every vector with every centroid in every round."""
    parts = [
        """kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS point, row_number() OVER () AS id
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
)""",
        """c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')), point) - 1 AS cluster, point
  FROM kept QUALIFY cluster < 8
)""",
    ]
    for at in range(ROUNDS + 1):
        parts.append(
            f"""a{at} AS MATERIALIZED (
  SELECT id, min(struct_pack(distance := distance, cluster := cluster)) AS best FROM (
    SELECT k.id, c.cluster, CAST(list_sum(list_transform(list_zip(k.point, c.point), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS distance
    FROM kept k CROSS JOIN c{at} c) GROUP BY id
)"""
        )
        if at < ROUNDS:
            parts.append(
                f"""c{at + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.point, c.point) AS point FROM c{at} c LEFT JOIN (
    SELECT cluster, list(CAST((total - ((total % size) + size) % size) // size AS BIGINT) ORDER BY place) AS point FROM (
      SELECT a.best.cluster AS cluster, p.place, sum(k.point[p.place]) AS total, count(*) AS size
      FROM a{at} a JOIN kept k USING (id) CROSS JOIN (SELECT unnest(range(1, 65)) AS place) p GROUP BY 1, 2) GROUP BY cluster
  ) m USING (cluster)
)"""
            )
    return f"""WITH {", ".join(parts)}
SELECT k.vec_id, CAST(a.best.cluster AS INTEGER) AS cluster, a.best.distance AS distance,
       CAST(sum(a.best.distance) OVER (PARTITION BY a.best.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.best.distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.point, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN kept k USING (id) JOIN c{ROUNDS} c ON c.cluster = a.best.cluster"""
