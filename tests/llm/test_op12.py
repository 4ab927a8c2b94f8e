from __future__ import annotations

import math
from hashlib import sha256

import pytest

from tests.conftest import SF
from tests.llm.helpers import rows
from tidemark.llm import op12_centroids as op
from tidemark.llm.common import table

COLUMNS = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def brute(vectors, k, n_rounds, dims):
    """Every distance anew in every round."""
    kept = [(r.vec_id, [math.floor(256 * x) for x in r.embedding]) for r in vectors if r.embedding is not None and len(r.embedding) == dims and all(x is not None and math.isfinite(x) for x in r.embedding)]
    hashed = lambda i: sha256(f"2:{'null' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, _, v in sorted((hashed(i), v, v) for i, v in kept)[:k]]
    away = lambda v, c: sum((x - y) ** 2 for x, y in zip(v, c))
    assign = lambda: [min((away(v, c), j) for j, c in enumerate(centroids)) for _, v in kept]
    for _ in range(n_rounds):
        at = assign()
        for j in range(len(centroids)):
            mine = [v for (_, v), (_, c) in zip(kept, at) if c == j]
            if mine:
                centroids[j] = [sum(x) // len(mine) for x in zip(*mine)]
    at = assign()
    of = lambda j: sum(d for d, c in at if c == j)
    return sorted(((i, c, d, of(c), sum(x for x, _ in at), sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for (i, _), (d, c) in zip(kept, at)), key=repr)


def test_whole_table(spark):
    vectors = table(spark, SF, "embeddings")
    assert rows(op.query(spark, SF), *COLUMNS) == brute(vectors.collect(), op.K, op.ROUNDS, op.DIMS)


ODD = [
    (1, [0.5, 0.25]), (2, [0.5, 0.25]), (2, [0.5, 0.25]), (3, [-0.001, 0.0]), (4, [3.0, -7.5]), (5, [3.01, -7.5]), (6, [0.0, 0.0]),
    (7, None), (8, []), (9, [1.0]), (10, [1.0, 2.0, 3.0]), (11, [None, 1.0]), (12, [float("nan"), 1.0]), (13, [float("-inf"), 1.0]), (None, [524288.0, -524288.0]), (None, [0.1, 0.2]),
]


@pytest.mark.parametrize("k, n_rounds", [(3, 5), (40, 2), (1, 3), (4, 0)])
def test_odd_vectors(spark, k, n_rounds):
    """Ties, repeated rows, null ids, vectors of other lengths or with numbers that are none, fewer vectors than centroids, empty clusters."""
    from pyspark.sql import functions as F

    vectors = spark.createDataFrame(ODD, "vec_id long, embedding array<double>")
    expected = brute(vectors.collect(), k, n_rounds, 2)
    assert len(expected) == 9
    assert rows(op.cluster(vectors, k, n_rounds, 2), *COLUMNS) == expected
    clash = vectors.select("*", *[F.lit("clash").alias(c) for c in ("v", "dots", "cluster", "distance", "label")])
    assert rows(op.cluster(clash, k, n_rounds, 2), *COLUMNS) == expected


def test_empty_and_too_large(spark):
    vectors = spark.createDataFrame(ODD, "vec_id long, embedding array<double>")
    nothing = op.cluster(vectors.limit(0), dims=2)
    assert nothing.columns == list(COLUMNS) and nothing.count() == 0
    with pytest.raises(Exception, match="beyond"):
        op.cluster(spark.createDataFrame([(1, [1e9, 0.0])], "vec_id long, embedding array<double>"), dims=2).count()


def test_only_changed_components_are_multiplied(spark):
    """A centroid that stays leaves its products as they were; a wrong product there would stay, too."""
    import numpy as np

    state = spark.createDataFrame([(1, [3, 4], [100, 200])], "vec_id long, v array<int>, dots array<long>")
    got = op.updated(state, np.array([[0, 0], [0, 2]]), np.array([[1, 1], [5, 7]])).first()
    assert got.dots == [100, 200 + 8]
