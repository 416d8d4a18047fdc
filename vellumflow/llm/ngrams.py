"""Character n-grams of whole texts as hashed densities, and the choice of those that tell two classes apart.

A text is folded: lower case, runs of white space one space, a space before and after it; signs are
spaces too or stay, as asked, and where they stay digits are 0. Its n-grams of ORDERS code points are
hashed to BITS bits. The density of an n-gram that occurs k times in n words is
min(1, RARE * k / (n + RARE)), in steps of 1 / STEPS, so that sums over documents are exact in any order.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumflow.llm.common import drop_written, is_held_out, tables_written, written

ORDERS = (2, 3, 4, 5, 6)
BITS = 20
RARE = 60
STEPS = 1024
SLICE = 1 << 20
LEAST_ROWS, MOST_ROWS = 2048, 32768  # labelled texts of a task: fewer tasks than cores have the least at least, none more than the most
ROWS = 256  # texts whose densities are held at a time
LEAST_DOCUMENTS = 8
LEAST_T = 2.0
SKETCH = 8
SMOOTH = 0.002
SPACE = 32


@cache
def folding(signs: bool) -> np.ndarray:
    """What each code point of the basic plane becomes; the others stay."""
    points = np.arange(1 << 16, dtype=np.uint32)
    letters = [chr(p) for p in points.tolist()]
    if not signs:
        points[~np.array([c.isalnum() for c in letters])] = SPACE
        return points
    points[np.array([c.isdigit() for c in letters])] = ord("0")
    points[np.array([c.isspace() or c < " " for c in letters])] = SPACE
    return points


def folded(text: str, signs: bool):
    """The folded text as arrays of code points, each led by what n-grams across the cut need:
    (array, length of that lead). A slice of the text is held at a time."""
    table, lead, last = folding(signs), np.zeros(0, np.uint32), -1
    for at in range(0, max(1, len(text)), SLICE):
        first, end = at == 0, at + SLICE >= len(text)
        part = " " * first + text[at : at + SLICE].lower() + " " * end
        points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        points = np.where(points < 1 << 16, table[np.minimum(points, (1 << 16) - 1)], points)
        keep = (points != SPACE) | (np.concatenate([[last], points[:-1]]) != SPACE)
        last = points[-1]
        points = points[keep]
        if len(points):
            yield np.concatenate([lead, points]), len(lead)
            lead = np.concatenate([lead, points])[-(max(ORDERS) - 1) :]


def hashes(points: np.ndarray):
    """(order, hash of the n-gram from each place on), each order's from those of the order before."""
    h = np.full(len(points), 0x811C9DC5, np.uint32)
    for order in range(1, max(ORDERS) + 1):
        if len(points) < order:
            return
        h = (h[: len(points) - order + 1] ^ points[order - 1 :]) * np.uint32(0x01000193)
        h ^= h >> np.uint32(15)
        if order in ORDERS:
            yield order, (h * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)


def density(times: np.ndarray, words: np.ndarray | int) -> np.ndarray:
    """Density in steps, as whole numbers."""
    return np.minimum(STEPS, np.rint(STEPS * RARE * times / (words + RARE))).astype(np.int64)


def counted(text: str, signs: bool) -> tuple[np.ndarray, np.ndarray, int]:
    """(hashed n-grams, times, words) of a whole text."""
    total, spaces = None, 0
    for points, lead in folded(text, signs):
        spaces += int((points[lead:] == SPACE).sum())
        found = [h[max(0, lead - order + 1) :] for order, h in hashes(points)]
        grams, times = np.unique(np.concatenate([np.zeros(0, np.uint32), *found]), return_counts=True)
        if total is None:
            total = grams, times
        else:
            both, at = np.unique(np.concatenate([total[0], grams]), return_inverse=True)
            total = both, np.bincount(at, np.concatenate([total[1], times])).astype(np.int64)
    return total[0].astype(np.uint32), total[1], max(0, spaces - 1)


class Densities:
    """Densities of chosen n-grams in texts."""

    def __init__(self, grams: np.ndarray, signs: bool) -> None:
        self.signs, self.size = signs, len(grams)
        self.index = np.zeros(1 << BITS, np.uint16)
        self.index[grams] = np.arange(1, len(grams) + 1)

    def _count(self, waiting: list[tuple[int, np.ndarray, int]], counts: np.ndarray) -> None:
        """Add the n-grams of (row, points, lead) to counts; those within a lead count elsewhere."""
        starts = np.cumsum([0, *(len(p) for _, p, _ in waiting)])
        rows, leads = (np.array([w[k] for w in waiting], np.int64) for k in (0, 2))
        for order, h in hashes(np.concatenate([p for _, p, _ in waiting])):
            feature = self.index[h]
            place = np.flatnonzero(feature)
            of = np.searchsorted(starts, place, "right") - 1
            whole = (place + order <= starts[of + 1]) & (place + order > starts[of] + leads[of])
            place, of = place[whole], of[whole]
            counts += np.bincount(rows[of] * self.size + feature[place] - 1, minlength=counts.size).reshape(counts.shape)

    def groups(self, texts: list[str]):
        """(first row, densities of some rows on end) for all texts."""
        for first in range(0, len(texts), ROWS):
            group = texts[first : first + ROWS]
            counts, words = np.zeros((len(group), self.size), np.int64), np.zeros(len(group), np.int64)
            waiting, size = [], 0
            for row, text in enumerate(group):
                for points, lead in folded(text, self.signs):
                    words[row] += int((points[lead:] == SPACE).sum())
                    waiting.append((row, points, lead))
                    size += len(points)
                    if size >= SLICE:
                        self._count(waiting, counts)
                        waiting, size = [], 0
            if waiting:
                self._count(waiting, counts)
            yield first, density(counts, np.maximum(0, words - 1)[:, None]).astype(np.float32) / STEPS


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label, text) of all labelled documents outside the held-out rows. Rows without a label or an
    id are left out; of several labels the least counts, of several texts that with the least hash; null
    texts are empty."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min(label).alias("label"))
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(known, "doc_id")
    return rows.groupBy("doc_id").agg(F.min("label").alias("label"), F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))


@dataclass
class Examples:
    """Chosen n-grams, the log ratio of their mean densities in the two classes, mean and deviation of their
    densities and of the measures, how many texts are of class 1 and of class 0, and the texts:
    (doc_id, good, text, measures), as they are stored, sorted within files."""

    grams: np.ndarray
    ratio: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    known: np.ndarray
    good: int
    poor: int
    texts: DataFrame


@dataclass
class Sample:
    """Examples that one machine holds: for each text its densities, its measures and whether it is of class 1."""

    grams: np.ndarray
    ratio: np.ndarray
    x: np.ndarray
    measures: np.ndarray
    y: np.ndarray


def _sketch(text: bytes) -> list[int]:
    """The least hashes of the text's runs of four words."""
    from vellumflow.llm.op9_golay import shingle_hashes

    least = np.zeros(0, np.uint64)
    for part in shingle_hashes(text, 4):
        least = np.unique(np.concatenate([least, part]))[:SKETCH]
    return least.view(np.int64).tolist()


def _distinct(rows: DataFrame, measures: Callable[[bytes], list[float]]) -> DataFrame:
    """(doc_id, good, text, measures), stored, of the rows but those that share half of their sketch with rows
    of smaller ids: copies of one document are no independent evidence."""

    def take_apart(batches):
        for whole in batches:
            for batch in (whole.slice(at, 16) for at in range(0, whole.num_rows, 16)):
                texts = [t.encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]
                known = [pa.array([_sketch(t) for t in texts], pa.list_(pa.int64())), pa.array([measures(t) for t in texts], pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *known], ["doc_id", "good", "text", "sketch", "measures"])

    spark, first = rows.sparkSession, tables_written()
    rows = rows.select(F.col("doc_id").cast("long"), (F.col("label") > 0).alias("good"), "text")
    held = written(rows.mapInArrow(take_apart, "doc_id long, good boolean, text string, sketch array<long>, measures array<double>"), "labelled")
    n, cores = held.count(), spark.sparkContext.defaultParallelism
    tasks = max(1, min(-(-n // LEAST_ROWS), max(cores, -(-n // MOST_ROWS))))
    parts = held.select("doc_id", F.explode("sketch").alias("h"))
    seen = parts.join(parts.groupBy("h").agg(F.min("doc_id").alias("first")), "h").groupBy("doc_id").agg(F.count_if(F.col("first") < F.col("doc_id")).alias("seen"))
    copies = seen.join(held.select("doc_id", F.size("sketch").alias("n")), "doc_id").where(2 * F.col("seen") >= F.col("n")).select("doc_id")
    kept = held.drop("sketch").join(copies, "doc_id", "left_anti").repartition(tasks, "doc_id").sortWithinPartitions("doc_id")
    stored = written(kept, "examples")
    drop_written(spark, first, first + 1)
    return stored


def examples(docs: DataFrame, labels: DataFrame, label: str, features: int, signs: bool, measures: Callable[[bytes], list[float]] = lambda text: []) -> Examples:
    """What a classifier can be fitted to: all labelled texts outside the held-out rows, near copies once.
    N-grams are chosen by the t statistic of their densities in the two classes; only those, `features` at the
    most, reach the driver, with sums over the texts."""
    texts = _distinct(labelled_rows(docs, labels, label), measures)

    def moments(batches):
        sums = np.zeros((5, 1 << BITS), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                few = batch.slice(at, ROWS)
                for good, text in zip(few.column("good").to_pylist(), few.column("text").to_pylist()):
                    grams, times, words = counted(text, signs)
                    v, side = density(times, words), 2 * int(good)
                    sums[side][grams] += v
                    sums[side + 1][grams] += v * v
                    sums[4][grams] += 1
        found = np.flatnonzero(sums[4])
        for k in range(0, len(found), 1 << 16):
            at = found[k : k + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (at, *sums[:, at])], ["gram", *names])

    names = ("s0", "q0", "s1", "q1", "n")
    counts = texts.agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("poor")).first()
    good, poor = max(1, counts["good"]), max(1, counts["poor"])
    sums = texts.select("good", "text").mapInArrow(moments, "gram long, " + ", ".join(f"{c} long" for c in names)).groupBy("gram").agg(*(F.sum(c).alias(c) for c in names))
    variance = (F.col("q1") / good - (F.col("s1") / good) ** 2) / good + (F.col("q0") / poor - (F.col("s0") / poor) ** 2) / poor
    t = F.abs(F.col("s1") / good - F.col("s0") / poor) / F.sqrt(F.greatest(variance, F.lit(0.0)) + 1e-9 * STEPS**2)
    best = sums.withColumn("t", t).where((F.col("n") >= LEAST_DOCUMENTS) & (F.col("t") > LEAST_T)).orderBy(F.desc("t"), "gram").limit(features).collect()
    best.sort(key=lambda r: r["gram"])
    s0, q0, s1, q1 = (np.array([r[c] for r in best], float) for c in names[:4])
    ratio = np.log((s1 / good / STEPS + SMOOTH) / (s0 / poor / STEPS + SMOOTH))
    n = max(1, counts["good"] + counts["poor"])
    mean = (s0 + s1) / n / STEPS
    known = texts.select(F.posexplode("measures").alias("at", "x")).groupBy("at").agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("scale")).orderBy("at").collect()
    known = np.array([(r["mean"], r["scale"]) for r in known], float).reshape(-1, 2)
    scale = np.sqrt(np.maximum(0, (q0 + q1) / n / STEPS**2 - mean**2))
    return Examples(np.array([r["gram"] for r in best], np.uint32), ratio, mean, scale, known, counts["good"], counts["poor"], texts)


#: A row of features as MLlib stores a sparse vector: type 0, length, places and values.
VECTOR = "struct<type: tinyint, size: int, indices: array<int>, values: array<double>>"


def sparse(rows: list[tuple[np.ndarray, np.ndarray]], size: int) -> pa.Array:
    """An Arrow column of VECTOR from (places, values) of each row."""
    kind = pa.struct([("type", pa.int8()), ("size", pa.int32()), ("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])
    places, values = pa.array([p.astype(np.int32) for p, _ in rows], pa.list_(pa.int32())), pa.array([v.astype(float) for _, v in rows], pa.list_(pa.float64()))
    return pa.StructArray.from_arrays([pa.array([0] * len(rows), pa.int8()), pa.array([size] * len(rows), pa.int32()), places, values], fields=list(kind))


def featured(found: Examples, signs: bool, factor: np.ndarray) -> DataFrame:
    """(doc_id, good, features VECTOR), stored: the measures, then the densities, each times its factor."""
    grams, width, first = found.grams, len(factor), len(factor) - len(found.grams)

    def answer(batches):
        densities = Densities(grams, signs)
        for whole in batches:
            for batch in (whole.slice(at, ROWS) for at in range(0, whole.num_rows, ROWS)):
                x = np.zeros((batch.num_rows, width))
                if first:
                    x[:, :first] = np.array(batch.column("measures").to_pylist(), float)
                if width > first:
                    for at, part in densities.groups(batch.column("text").to_pylist()):
                        x[at : at + len(part), first:] = part
                x *= factor
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("good"), sparse([(at := np.flatnonzero(row), row[at]) for row in x], width)], ["doc_id", "good", "features"])

    return written(found.texts.mapInArrow(answer, f"doc_id long, good boolean, features {VECTOR}"), "features")


def entries(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, value) of all that a column of VECTOR holds."""
    places, values = column.field("indices"), column.field("values")
    ends = np.asarray(places.offsets).astype(np.int64)
    at, x = np.asarray(places.values)[ends[0] : ends[-1]], np.asarray(values.values)[ends[0] : ends[-1]]
    return np.repeat(np.arange(len(column)), np.diff(ends)), at, x


def dots(weights: np.ndarray):
    """A function from a column of VECTOR to the product of each row with each row of weights."""

    def of(column: pa.Array) -> np.ndarray:
        row, at, x = entries(column)
        return np.array([np.bincount(row, x * w[at], len(column)) for w in weights])

    return of


def fitted(rows: DataFrame, penalty: float, intercept: bool, rounds: int = 200) -> tuple[np.ndarray, float]:
    """Weights and bias of the logistic regression of (label, features) with a quadratic penalty but on the
    bias, by MLlib over all rows. rows must be read from files, features as VECTOR."""
    from pyspark.ml.classification import LogisticRegression

    model = LogisticRegression(regParam=penalty, elasticNetParam=0.0, standardization=False, fitIntercept=intercept, maxIter=rounds, tol=1e-7, family="binomial").fit(rows)
    return model.coefficients.toArray(), float(model.intercept)


def as_vectors(stored: DataFrame) -> DataFrame:
    """A stored table with its column `features` read as vectors."""
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql.types import StructField, StructType

    schema = StructType([StructField(f.name, VectorUDT()) if f.name == "features" else f for f in stored.schema])
    return stored.sparkSession.read.schema(schema).parquet(*{name.rsplit("/", 1)[0] for name in stored.inputFiles()})


def learnable(docs: DataFrame, labels: DataFrame, label: str, limit: int, features: int, signs: bool, measures: Callable[[bytes], list[float]] = lambda text: []) -> Sample:
    """Examples brought to the driver, for tables of few labels: those with the `limit` least hashes of their
    ids. The queries fit all examples where they lie."""
    few = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id"))).select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    found = examples(docs, labels.join(few, "doc_id", "left_semi"), label, features, signs, measures)
    rows = found.texts.orderBy("doc_id").collect()
    x = np.concatenate([np.zeros((0, len(found.grams)), np.float32), *(part for _, part in Densities(found.grams, signs).groups([r["text"] for r in rows]))])
    return Sample(found.grams, found.ratio, x, np.array([r["measures"] for r in rows], float).reshape(len(rows), -1 if rows else 0), np.array([r["good"] for r in rows], bool))
