"""Centroid clustering with an incremental matrix of exact integer dot products.

Vectors of ``dims`` finite components become integers floor(``scale`` * x).  Each
round keeps, beside every vector, its dot products with all centroids.  Where a
centroid's components have changed, and only there, the products are brought up to
date by vector times change; |v|^2 - 2 v.c + |c|^2 then gives the distances, and
the argmin the clusters, ties going to the smaller number.  A centroid becomes the
componentwise floor of its vectors' mean; an empty one stays.  All numbers are
64-bit integers.  A round is one scan that writes the next state to the shared
checkpoint folder and one aggregation to a row for each cluster; only those rows,
and the centroids, pass the driver.

Defined cases: vectors that are null, of another length, or hold a null or a
number that is not finite are left out; equal vectors and repeated rows are each
clustered; first centroids of equal hashes are ordered by components; a null id is
hashed as the text ``null``; fewer vectors than ``k`` give that many centroids; an
empty table gives no rows; other columns are not read.  A component
beyond 2 ** 19 is an error, since squared distances would leave 64 bits.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, stored, table

K, ROUNDS, DIMS, SCALE = 40, 5, 64, 256
LARGEST = 1 << 19


def integers(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): the vectors that are kept, as integers."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    whole = lambda e: F.when(F.abs(e) <= LARGEST, F.floor(e * scale)).otherwise(F.raise_error(F.lit(f"a component is beyond {LARGEST}")).cast("long"))
    return vectors.where((F.size("embedding") == dims) & finite).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, whole).cast("array<int>").alias("v"))


def first_centroids(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The ``k`` vectors of least hash, in its order."""
    hashed = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    return np.array([r.v for r in vectors.orderBy(hashed, "v").limit(k).select("v").collect()], np.int64)


def updated(state: DataFrame, change: np.ndarray, centroids: np.ndarray) -> DataFrame:
    """The state (vec_id, v, dots) after its centroids changed, with each vector's cluster and distance."""
    k, dims = centroids.shape
    norms = (centroids**2).sum(1)
    changed = [(c, np.flatnonzero(row)) for c, row in enumerate(change) if row.any()]

    def of(batches):
        for batch in batches:
            n = batch.num_rows
            v = batch.column(1).flatten().to_numpy().reshape(n, dims).astype(np.int64)
            dots = batch.column(2).flatten().to_numpy().reshape(n, k).copy()
            for c, at in changed:
                dots[:, c] += v[:, at] @ change[c, at]
            squared = (v * v).sum(1)[:, None] - 2 * dots + norms
            cluster = squared.argmin(1)
            listed = pa.ListArray.from_arrays(pa.array(np.arange(0, n * k + 1, k, dtype=np.int32)), pa.array(dots.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), listed, pa.array(cluster.astype(np.int32)), pa.array(squared[np.arange(n), cluster])], ["vec_id", "v", "dots", "cluster", "distance"])

    return state.select("vec_id", "v", "dots").mapInArrow(of, "vec_id long, v array<int>, dots array<long>, cluster int, distance long")


def means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: floors of exact means; without vectors, as before."""
    dims = centroids.shape[1]
    sums = state.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(dims)])
    moved = centroids.copy()
    for r in sums.collect():  # a row for each cluster
        moved[r.cluster] = [r[f"s{i}"] // r.n for i in range(dims)]
    return moved


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, salt: str = "2") -> DataFrame:
    """A row per vector kept: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    spark = vectors.sparkSession
    kept, at = stored(integers(vectors, dims, scale))
    centroids = first_centroids(kept, k, salt)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    state, change = kept.withColumn("dots", F.array_repeat(F.lit(0).cast("long"), len(centroids))), centroids
    for left in range(rounds, -1, -1):
        after = updated(state, change, centroids)
        # the last assignment is not carried on
        state, path = stored(after if left else after.select("vec_id", "cluster", "distance"))
        discard(spark, at)
        at = path
        if left:
            moved = means(state, centroids)
            change, centroids = moved - centroids, moved
    inertia = {r.cluster: r.total for r in state.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    named = lambda c: sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()
    by_cluster = spark.createDataFrame([(c, total, sum(inertia.values()), named(c)) for c, total in inertia.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.join(F.broadcast(by_cluster), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def query(spark, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings"))
