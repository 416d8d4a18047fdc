"""Connected components of a link table by alternating stars, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from vellumflow.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links(a long, b long); component is the smallest node
    that can be reached. Loops, repeats and nulls in links are ignored; no links give no rows.

    Each round points every node's larger neighbours, then all its neighbours, at the least node
    around it, until only stars are left: a number of rounds logarithmic in the nodes. Each round's
    table is written to the shared folder. Minima are taken by combinable aggregations and met by
    joins whose skewed partitions Spark can split, so a node with many links is no bottleneck.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    stars, seen = _checked(links.where("a <> b").select(high.alias("hi"), low.alias("lo")).distinct())
    while seen[0]:
        both = stars.select("hi", "lo").union(stars.select("lo", "hi")).toDF("node", "other")
        least = both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("m"))
        large = stars.join(least.withColumnRenamed("node", "lo"), "lo").select("hi", F.col("m").alias("lo"))
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        stars, now = _checked(small.union(least.select("hi", "m")).distinct())
        if now == seen:
            break
        seen = now
    roots = stars.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return stars.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(roots)


def _checked(stars: DataFrame) -> tuple[DataFrame, tuple]:
    """stars written, and their number and a sum of their hashes, gathered while they are."""
    seen = Observation()
    found = written(stars.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("sum")), "links")
    return found, (seen.get["n"], seen.get["sum"])


def spanning(labels, left, right):
    """Union-find by relabelling over index arrays: merge the classes of left[i] and right[i] for all
    i in place in labels (numpy); gives the positions i whose links joined two classes."""
    import numpy as np

    used = []
    at = np.arange(len(left))
    while True:
        a, b = labels[left[at]], labels[right[at]]
        apart = a != b
        at, a, b = at[apart], a[apart], b[apart]
        if not len(at):
            return np.concatenate(used) if used else np.zeros(0, np.int64)
        high, low = np.maximum(a, b), np.minimum(a, b)
        first = np.unique(high, return_index=True)[1]  # each class joins one lower class a round
        used.append(at[first])
        into = np.arange(len(labels))
        into[high[first]] = low[first]
        while True:
            further = into[into]
            if (further == into).all():
                break
            into = further
        labels[:] = into[labels]
