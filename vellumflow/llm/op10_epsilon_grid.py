"""Embedding near-duplicates by an epsilon grid order join.

Vectors are scaled to length one, so that cosine >= t is distance <= e = sqrt(2 - 2t). On the leading
principal directions of a sample a grid of cell width e is laid; vectors are sorted by their cells.
Intervals of that sequence are joined recursively: two intervals whose boxes lie further apart than
e cannot hold a link and are skipped, others are halved down to small blocks that are multiplied out.
Directions are orthonormal, so distances between boxes never overstate: nothing is lost.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumflow.llm.common import packed, table, written
from vellumflow.llm.components import components, spanning

COSINE = 0.9
DIRECTIONS = 8
SAMPLE_VALUES = 1 << 18  # bound on the sample that the directions are fitted to; any directions give the same links
INTERVAL = 8192
LEAF = 256
SLACK = 1e-9
BROADCAST_ROWS = 1_000_000


def usable(vector: Column) -> Column:
    """Not null, nothing in it null or non-finite, and not zero."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & sound & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def directions(sample: np.ndarray) -> np.ndarray:
    """Leading principal directions, as columns."""
    around = unit_rows(sample)
    around = around - around.mean(axis=0)
    return np.linalg.svd(around, full_matrices=True)[2][:DIRECTIONS].T


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy().reshape(-1, width) if isinstance(column, pa.ChunkedArray) else column.flatten().to_numpy().reshape(-1, width)


def apart(low: np.ndarray, high: np.ndarray, other_low: np.ndarray, other_high: np.ndarray) -> np.ndarray:
    """Squared distance between boxes."""
    gap = np.maximum(0, np.maximum(low - other_high, other_low - high))
    return (gap * gap).sum(axis=-1)


class Interval:
    """A stretch of the sequence: raw and unit vectors, and the boxes of its leaves."""

    def __init__(self, raw: np.ndarray, basis: np.ndarray) -> None:
        self.raw, self.unit = raw, unit_rows(raw)
        places = self.unit @ basis
        starts = np.arange(0, len(raw), LEAF)
        self.low, self.high = np.minimum.reduceat(places, starts), np.maximum.reduceat(places, starts)


def leaf_pairs(a: Interval, b: Interval, reach: float, same: bool):
    """Pairs of leaves that may hold links, by recursive halving of the two intervals."""
    todo = [(0, len(a.low), 0, len(b.low))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if same and a0 >= b1:
            continue
        if apart(a.low[a0:a1].min(axis=0), a.high[a0:a1].max(axis=0), b.low[b0:b1].min(axis=0), b.high[b0:b1].max(axis=0)) > reach:
            continue
        if a1 - a0 == 1 and b1 - b0 == 1:
            yield a0, b0
        elif a1 - a0 >= b1 - b0:
            mid = (a0 + a1) // 2
            todo += [(a0, mid, b0, b1), (mid, a1, b0, b1)]
        else:
            mid = (b0 + b1) // 2
            todo += [(a0, a1, b0, mid), (a0, a1, mid, b1)]


def _linked(a: Interval, b: Interval, at: slice, to: slice, least: float) -> np.ndarray:
    cosines = a.unit[at] @ b.unit[to].T
    linked = cosines >= least
    for i, j in zip(*np.nonzero(np.abs(cosines - least) < 1e-12)):  # decided without rounding of the unit vectors
        x, y = a.raw[at][i], b.raw[to][j]
        linked[i, j] = math.fsum(x * y) / (math.sqrt(math.fsum(x * x)) * math.sqrt(math.fsum(y * y))) >= least
    return linked


def join(a: Interval, b: Interval | None, n_a: np.ndarray, n_b: np.ndarray | None, least: float):
    """Links between two intervals (b None: within a): for each vector the copies of vectors linked to
    it, and index pairs of links that connect what all links connect (b's indices follow a's)."""
    same = b is None
    other, n_other = (a, n_a) if same else (b, n_b)
    shift = 0 if same else len(a.raw)
    counts_a, counts_b = np.zeros(len(a.raw)), np.zeros(len(other.raw))
    labels = np.arange(len(a.raw) + (0 if same else len(other.raw)))
    lefts, rights = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i, j in leaf_pairs(a, other, 2 - 2 * least + SLACK, same):
        if same and i > j:
            continue
        at, to = slice(i * LEAF, (i + 1) * LEAF), slice(j * LEAF, (j + 1) * LEAF)
        linked = _linked(a, other, at, to, least)
        if same and i == j:
            np.fill_diagonal(linked, False)
        if not linked.any():
            continue
        counts_a[at] += linked @ n_other[to].astype(float)
        if not (same and i == j):
            (counts_a if same else counts_b)[to] += n_a[at].astype(float) @ linked
        left, right = np.nonzero(linked & (labels[: len(a.raw)][at][:, None] != labels[shift:][to][None, :]))
        left, right = left + at.start, right + to.start + shift
        joined = spanning(labels, left, right)
        lefts.append(left[joined])
        rights.append(right[joined])
    return (counts_a if same else np.concatenate([counts_a, counts_b])).astype(np.int64), np.concatenate(lefts), np.concatenate(rights)


def _meeting(placed: DataFrame, directions: int, reach: float) -> DataFrame:
    """(i, j, pair) of intervals i <= j whose boxes lie within the squared distance `reach`.

    On the first direction intervals are met by the cells of width sqrt(reach) that they lie in, each pair
    in one cell only; the other directions then decide. No pair passes through the driver."""
    sides = [f(F.col("places")[k]).alias(f"{name}{k}") for k in range(directions) for name, f in (("low", F.min), ("high", F.max))]
    boxes = written(placed.groupBy("run").agg(*sides), "boxes")
    width = math.sqrt(reach)
    first, last = F.floor(F.col("low0") / width), F.floor(F.col("high0") / width)
    a, b = (boxes.select(*(F.col(c).alias(f"{c}{t}") for c in boxes.columns)) for t in ("_a", "_b"))
    a = a.join(boxes.select(F.col("run").alias("run_a"), F.explode(F.sequence(first, last)).alias("cell"), first.alias("from_a")), "run_a")
    b = b.join(boxes.select(F.col("run").alias("run_b"), F.explode(F.sequence(first - 1, last + 1)).alias("cell"), (first - 1).alias("from_b")), "run_b")
    met = a.join(b, "cell").where("run_a <= run_b AND cell = greatest(from_a, from_b)")
    gap = lambda k: F.greatest(F.lit(0.0), F.col(f"low{k}_a") - F.col(f"high{k}_b"), F.col(f"low{k}_b") - F.col(f"high{k}_a"))
    apart_ = sum((gap(k) * gap(k) for k in range(1, directions)), gap(0) * gap(0))
    near = met.where(apart_ <= reach).select(F.col("run_a").cast("long").alias("i"), F.col("run_b").cast("long").alias("j"))
    return near.withColumn("pair", F.expr("i * 2147483647L + j"))


def _join_length(classes: DataFrame, width: int, least: float) -> DataFrame:
    """(a, b, links) for distinct vectors of one length: rows with b are links, the others sums."""
    spark = classes.sparkSession
    own = classes.where(F.size("v") == width)
    sample = own.orderBy(F.xxhash64("cid")).limit(max(64, SAMPLE_VALUES // width)).select("v").collect()
    basis = directions(np.array([r["v"] for r in sample], float))
    cell = math.sqrt(2 - 2 * least)

    def place(batches):
        for batch in batches:
            if batch.num_rows:
                places = unit_rows(_matrix(batch.column("v"), width)) @ basis
                cells = (np.floor(places / cell) + 128).clip(0, 255).astype(np.uint8)
                offsets = np.arange(len(cells) + 1) * cells.shape[1]
                yield pa.RecordBatch.from_arrays([batch.column("cid"), batch.column("n"), batch.column("v"), packed(cells.ravel(), offsets), pa.array(places.tolist(), pa.list_(pa.float64()))], ["cid", "n", "v", "cells", "places"])

    count = own.count()
    wanted = -(-count // INTERVAL)
    placed = own.select("cid", "n", "v").mapInArrow(place, "cid long, n long, v array<double>, cells binary, places array<double>")
    runs = written(placed.repartitionByRange(wanted, "cells", "cid").sortWithinPartitions("cells", "cid").withColumn("run", F.spark_partition_id()), "sequence")
    last = runs.agg(F.max("run")).first()[0] + 1
    placed = runs.withColumn("run", F.expr(f"run * {min(wanted, last)}L div {last}L"))
    pairs = written(_meeting(placed, basis.shape[1], 2 - 2 * least + SLACK), "pairs")
    both = pairs.select(F.col("i").alias("run"), "pair", F.lit(0).alias("side")).union(pairs.where("i < j").select("j", "pair", F.lit(1)))

    def meet(group: pa.Table) -> pa.Table:
        group = group.sort_by([("side", "ascending"), ("cells", "ascending"), ("cid", "ascending")])
        ids, n = group.column("cid").to_numpy(), group.column("n").to_numpy()
        raw, split = _matrix(group.column("v"), width), int((group.column("side").to_numpy() == 0).sum())
        if split == len(ids):
            sums, left, right = join(Interval(raw, basis), None, n, None, least)
        else:
            sums, left, right = join(Interval(raw[:split], basis), Interval(raw[split:], basis), n[:split], n[split:], least)
        some = sums > 0
        none = pa.nulls(int(some.sum()), pa.int64())
        return pa.table({"a": pa.concat_arrays([pa.array(ids[some]), pa.array(ids[left])]), "b": pa.concat_arrays([none, pa.array(ids[right])]), "links": pa.concat_arrays([pa.array(sums[some]), pa.nulls(len(left), pa.int64())])})

    # A row or two for each pair of intervals that may meet: sent to all while that is little.
    met = placed.select("run", "cid", "n", "v", "cells").join(F.broadcast(both) if 2 * pairs.count() <= BROADCAST_ROWS else both, "run")
    return met.groupBy("pair").applyInArrow(meet, "a long, b long, links long")


def near_vectors(vectors: DataFrame, least: float = COSINE, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row: all pairs with cosine >= least are links.

    Equal vectors are one class with a count, so copies never meet as pairs; dense groups give counts
    and connecting links only. Vectors that are null, zero or hold null or non-finite components, and
    rows with a null vec_id, link with nothing; vectors of different length do not link. Repeated
    vec_ids are rows of their own; no rows give no rows; vectors are compared whole, however long. Other
    columns, whatever their names, are not looked at. kept marks the least vec_id of a component.
    """
    spark = vectors.sparkSession
    v = F.col(f"`{vector}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("vec_id"), v.alias("v")).withColumn("ok", usable(F.col("v")) & F.col("vec_id").isNotNull())
    sound = rows.where("ok").select("vec_id", "v")
    classes = written(sound.groupBy("v").agg(F.min("vec_id").alias("least"), F.count("*").alias("n")).withColumn("cid", F.monotonically_increasing_id()), "vectors")
    widths = sorted(r[0] for r in classes.select(F.size("v")).distinct().collect())
    found = spark.createDataFrame([], "a long, b long, links long")
    for width in widths:
        found = found.union(_join_length(classes, width, least))
    found = written(found, "links")
    sums = found.where("links IS NOT NULL").groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "cid")
    labels = components(found.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "cid")
    named = classes.join(sums, "cid", "left").join(labels, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    least_id = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least_id, "component").select("v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    linked = sound.join(named, "v").select("vec_id", "n_links", "component_id")
    alone = rows.where("NOT ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op10_epsilon_grid_join(spark, sf_dir: str) -> DataFrame:
    """Direct links and component of every vector at cosine 0.9."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


#: All pairs against each other, and links followed to the end: for small tables.
ORACLE = r"""
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), u AS (
  SELECT r, vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS size FROM v
  WHERE vec_id IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.r AS a, b.r AS b FROM u AS a JOIN u AS b ON a.r <> b.r AND len(a.e) = len(b.e)
  WHERE list_sum(list_transform(list_zip(a.e, b.e), lambda p: p[1] * p[2])) >= 0.9 * a.size * b.size
), reach AS (
  SELECT a, b FROM l UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a
), least AS (
  SELECT reach.a AS r, min(v.vec_id) AS m FROM reach JOIN v ON v.r = reach.b GROUP BY reach.a
), n AS (
  SELECT a AS r, count(*) AS n FROM l GROUP BY a
)
SELECT vec_id, coalesce(n.n, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id, coalesce(vec_id <= coalesce(m, vec_id), false) AS kept
FROM v LEFT JOIN n USING (r) LEFT JOIN least USING (r)
"""
