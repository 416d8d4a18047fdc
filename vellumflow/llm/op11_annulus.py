"""Centroid clustering with annulus search.

Lloyd's rounds over integer vectors. Centroids are sorted by norm. By the triangle inequality a centroid
whose norm differs from a vector's by more than an upper bound on the distance to its nearest centroid
cannot be nearest. That bound is the distance to the centroid that the vector had in the round before (in
the first round, to the one of nearest norm). The centroids within the annulus are found by two binary
searches and compared exactly, in whole numbers, ties going to the smaller number.

A task adds up its vectors by cluster, so that a round sends one row per task and cluster; only centroids,
a fixed number of them, reach the driver and go out again.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumflow.llm.common import drop_written, table, tables_written, written

CLUSTERS = 16
ROUNDS = 3
WIDTH = 64
SCALE = 64
BOUND = 1 << 27  # 64 squared differences of such components fit a long
ROUNDING = 1e-9  # added to annuli, relative to the norms: their ends are floats
PASSED = "vec_id long, q array<int>, cluster int, sums array<long>, n long"


def whole_components(vector: Column, width: int = WIDTH, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component as array<int>, or null unless there are `width` components, none
    of them null or non-finite."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    steps = F.transform(vector, lambda x: F.greatest(F.lit(-float(BOUND)), F.least(F.lit(float(BOUND)), F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))).cast("int"))
    return F.when((F.size(vector) == width) & sound, steps)


class Annuli:
    """Centroids sorted by norm, ready for search."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids = centroids
        norms = np.sqrt((centroids * centroids).sum(axis=1).astype(float))
        self.order = np.argsort(norms, kind="stable")
        self.norms = norms[self.order]

    def _by_norm(self, norms: np.ndarray) -> np.ndarray:
        """The centroid whose norm is nearest to each of the norms."""
        above = np.clip(np.searchsorted(self.norms, norms), 1, max(1, len(self.norms) - 1)) if len(self.norms) > 1 else np.zeros(len(norms), int)
        below = np.maximum(above - 1, 0)
        return self.order[np.where(norms - self.norms[below] <= self.norms[above] - norms, below, above)]

    def nearest(self, vectors: np.ndarray, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, int]:
        """(number of the nearest centroid, squared distance, centroids compared) of integer vectors; known:
        any centroid of each, the nearer the better."""
        norms = np.sqrt((vectors * vectors).sum(axis=1).astype(float))
        who = self._by_norm(norms) if known is None else known.astype(np.int64)
        gap = vectors - self.centroids[who]
        least = (gap * gap).sum(axis=1)
        width = np.sqrt(least.astype(float)) + ROUNDING * (norms + self.norms[-1] + 1)
        first, last = np.searchsorted(self.norms, norms - width, "left"), np.searchsorted(self.norms, norms + width, "right")
        for place, centroid in enumerate(self.order.tolist()):
            rows = np.flatnonzero((first <= place) & (place < last))
            gap = vectors[rows] - self.centroids[centroid]
            distance = (gap * gap).sum(axis=1)
            better = (distance < least[rows]) | ((distance == least[rows]) & (centroid < who[rows]))
            who[rows[better]], least[rows[better]] = centroid, distance[better]
        return who, least, int((last - first).sum())


def _vectors(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("q").flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.int64)


def _assign(rows: DataFrame, centroids: np.ndarray, known: bool) -> DataFrame:
    """PASSED: every vector with its cluster, and per task and cluster (q is null) the sums and numbers."""
    k, width = centroids.shape

    def go(batches):
        annuli, sums, n = Annuli(centroids), np.zeros((k, width), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            if batch.num_rows:
                vectors = _vectors(batch, width)
                who, _, _ = annuli.nearest(vectors, batch.column("cluster").to_numpy() if known else None)
                np.add.at(sums, who, vectors)
                n += np.bincount(who, minlength=k)
                rest = [pa.nulls(len(who), pa.list_(pa.int64())), pa.nulls(len(who), pa.int64())]
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("q"), pa.array(who, pa.int32()), *rest], ["vec_id", "q", "cluster", "sums", "n"])
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(some), pa.int64()), pa.nulls(len(some), pa.list_(pa.int32())), pa.array(some, pa.int32()), pa.array(sums[some].tolist(), pa.list_(pa.int64())), pa.array(n[some])], ["vec_id", "q", "cluster", "sums", "n"])

    return rows.mapInArrow(go, PASSED)


def _moved(passed: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids at the floors of their vectors' means; those without vectors stay."""
    parts = passed.where("q IS NULL").select("cluster", "n", F.posexplode("sums").alias("at", "part"))
    exact = parts.groupBy("cluster", "at").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("sum"), F.sum("n").alias("n"))
    out = centroids.copy()
    for r in exact.collect():  # clusters times components
        out[r["cluster"], r["at"]] = int(r["sum"]) // int(r["n"])
    return out


def cluster_vectors(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE, seed: int = 1, key: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance) of every vector kept, final centroids).

    Kept are vectors of `width` components, none null or non-finite; other rows are not in the result.
    Components become floor(scale * x), held within 2^27 on either side. Centroids start as the vectors with
    the least sha256 of "seed:vec_id"; rows with a null vec_id are clustered but start none, and of rows with
    equal vec_ids the one with the smaller vector comes first. Repeated rows are rows of their own, equal
    centroids leave all vectors to the first. Fewer than k vectors make as many centroids; no vectors, or
    none with a vec_id, give no rows. Other columns, whatever their names, are not looked at.
    """
    spark, mark = vectors.sparkSession, tables_written()
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("vec_id"), whole_components(F.col(f"`{vector}`"), width, scale).alias("q")).where("q IS NOT NULL")
    hashed = rows.where("vec_id IS NOT NULL").withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256))
    centroids = np.array([r["q"] for r in hashed.orderBy("h", "q").limit(k).select("q").collect()], np.int64).reshape(-1, width)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), centroids
    held = rows.withColumn("cluster", F.lit(None).cast("int"))
    for n in range(rounds):
        passed = written(_assign(held, centroids, n > 0), "assigned")
        drop_written(spark, mark, tables_written() - 1)
        centroids = _moved(passed, centroids)
        held = passed.where("q IS NOT NULL").select("vec_id", "q", "cluster")

    def last(batches):
        annuli = Annuli(centroids)
        for batch in batches:
            if batch.num_rows:
                who, least, _ = annuli.nearest(_vectors(batch, width), batch.column("cluster").to_numpy() if rounds else None)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(who, pa.int32()), pa.array(least)], ["vec_id", "cluster", "distance"])

    return written(held.mapInArrow(last, "vec_id long, cluster int, distance long"), "clusters"), centroids


def op11_annulus_clustering(spark, sf_dir: str) -> DataFrame:
    """Cluster, distance, sums of distances and the centroid's hash of every vector that is kept."""
    found, centroids = cluster_vectors(table(spark, sf_dir, "embeddings"))
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # a row per cluster
    total = sum(int(r["s"]) for r in sums)
    digest = lambda c: hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()
    told = [(r["cluster"], int(r["s"]), total, digest(r["cluster"])) for r in sums]
    about = spark.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle() -> str:
    sql = f"""
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE len(embedding) = {WIDTH} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {WIDTH}
), c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), q) - 1 AS c, q FROM kept WHERE vec_id IS NOT NULL QUALIFY c < {CLUSTERS}
)"""
    for n in range(ROUNDS + 1):
        sql += f""", a{n} AS (
  SELECT k.r, k.vec_id, k.q, c.c, CAST(list_sum(list_transform(list_zip(k.q, c.q), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
  FROM kept AS k CROSS JOIN c{n} AS c QUALIFY row_number() OVER (PARTITION BY k.r ORDER BY d, c.c) = 1
)"""
        if n < ROUNDS:
            sql += f""", m{n} AS (
  SELECT c, list(m ORDER BY i) AS q FROM (
    SELECT c, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS m
    FROM (SELECT c, i, sum(x) AS s, count(*) AS n FROM (SELECT c, unnest(q) AS x, generate_subscripts(q, 1) AS i FROM a{n}) GROUP BY c, i))
  GROUP BY c
), c{n + 1} AS (SELECT c, coalesce(m{n}.q, c{n}.q) AS q FROM c{n} LEFT JOIN m{n} USING (c))"""
    return sql + f"""
SELECT vec_id, CAST(c AS INT) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{ROUNDS}.q, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN c{ROUNDS} USING (c)
"""


ORACLE = _oracle()
