"""Annulus search against all centroids, whole rounds against a plain version, and the query as its SQL."""

import hashlib

import numpy as np
import pytest

from vellumflow.llm import op11_annulus as annulus


def plain(rows, k, rounds, width, scale):
    kept = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v)]
    start = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), q) for i, q in kept if i is not None)[:k]
    centroids = [q for _, q in start]
    if not centroids:
        return [], []
    near = lambda q: min((sum((a - b) ** 2 for a, b in zip(q, c)), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        own = [near(q)[1] for _, q in kept]
        centroids = [[sum(x) // len(x) for x in zip(*mine)] if (mine := [q for (_, q), o in zip(kept, own) if o == n]) else c for n, c in enumerate(centroids)]
    return sorted(((i, near(q)[1], near(q)[0]) for i, q in kept), key=str), centroids


def test_rounds_as_plain(spark):
    draw = np.random.default_rng(3)
    middle = draw.normal(size=(5, 6))
    rows = [(i, (middle[i % 5] * (i % 3 + 1) + draw.normal(size=6) * 0.3).astype(np.float32).tolist()) for i in range(150)]
    rows += [(7, rows[7][1]), (7, rows[7][1]), (200, rows[8][1]), (None, rows[9][1])]  # repeated rows, equal vectors, no id
    rows += [(300, None), (301, []), (302, [1.0] * 5), (303, [None, *[1.0] * 5]), (304, [float("nan")] * 6), (305, [float("inf")] * 6), (306, [0.0] * 6)]
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "vec_id long, embedding array<float>, cluster int, q string, distance int")
    out, centroids = annulus.cluster_vectors(frame, k=9, rounds=3, width=6, scale=64)
    want, final = plain(rows, 9, 3, 6, 64)
    assert out.columns == ["vec_id", "cluster", "distance"]
    assert sorted((tuple(r) for r in out.collect()), key=str) == want and centroids.tolist() == final


def test_ties_and_few(spark):
    """Vectors as far from two centroids as from each other go to the smaller number; equal centroids leave one empty."""
    rows = [(1, [0.0, 0.0]), (2, [0.0, 0.0]), (3, [2.0, 0.0]), (4, [1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for k in (2, 4, 30):
        out, _ = annulus.cluster_vectors(frame, k=k, rounds=2, width=2, scale=4)
        assert sorted((tuple(r) for r in out.collect()), key=str) == plain(rows, k, 2, 2, 4)[0]


def test_nothing(spark):
    for rows in ([], [(1, None)], [(None, [1.0, 2.0])]):
        assert annulus.cluster_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), width=2)[0].count() == 0


def test_large_components_are_held(spark):
    rows = [(1, [3e38, 0.0]), (2, [-3e38, 0.0]), (3, [1.0, 1.0])]
    out, centroids = annulus.cluster_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=1, rounds=0, width=2, scale=64)
    q = {1: [annulus.BOUND, 0], 2: [-annulus.BOUND, 0], 3: [64, 64]}
    assert {r["vec_id"]: r["distance"] for r in out.collect()} == {i: sum((a - b) ** 2 for a, b in zip(v, centroids[0].tolist())) for i, v in q.items()}


@pytest.mark.parametrize("known", [False, True])
def test_search_as_all_and_with_fewer_comparisons(known):
    draw = np.random.default_rng(1)
    centroids = (draw.normal(size=(40, 4)) * np.linspace(1, 400, 40)[:, None]).astype(np.int64)
    vectors = (centroids[draw.integers(0, 40, 2000)] + draw.integers(-3, 4, (2000, 4))).astype(np.int64)
    everything = ((vectors[:, None] - centroids[None]) ** 2).sum(axis=2)
    guess = everything.argmin(axis=1) if known else None
    who, least, compared = annulus.Annuli(centroids).nearest(vectors, guess)
    assert (who == everything.argmin(axis=1)).all() and (least == everything.min(axis=1)).all()
    assert compared < 2000 * 40 / (8 if known else 1.5)


def test_query_as_its_sql(spark, tables):
    duckdb = pytest.importorskip("duckdb")
    draw = np.random.default_rng(4)
    rows = [(i, draw.normal(size=64).astype(np.float32).tolist()) for i in range(60)]
    rows += [(7, rows[7][1]), (200, rows[0][1]), (201, None), (202, [0.0] * 8), (203, [float("nan")] * 64), (204, [None] * 64), (205, [0.0] * 64)]
    at = tables(embeddings=spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    told = duckdb.connect()
    told.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{at}/embeddings.parquet/*.parquet'")
    found = annulus.op11_annulus_clustering(spark, at)
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, told.sql(annulus.ORACLE).fetchall()))
    nothing = tables(embeddings=spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert annulus.op11_annulus_clustering(spark, nothing).count() == 0
