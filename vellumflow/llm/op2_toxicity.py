"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Texts are folded to lower case with all runs apart from letters and digits as spaces; their n-grams
of two to six characters are hashed. A feature is the density of an n-gram in a text times the
log ratio of its mean densities in the two classes; a logistic regression with a quadratic penalty,
chosen on a part of the labelled texts, weighs the features.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumflow.llm.common import drop_written, is_held_out, table, tables_written, with_scores, written
from vellumflow.llm.ngrams import Densities, Examples, Sample, dots, entries, examples, featured

FEATURES = 2048
PENALTIES = (1e-2, 1e-3, 1e-4)
LEAST = 50  # texts of a class below which the middle penalty is taken unseen
GAIN = 1e-12  # that a step must promise, in the mean loss
CURVED, BLOCK, STRIP = 8192, 1024, 64  # rows of a task that multiplies them out, of them at a time, rows of a strip


def logistic(x: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Weights and bias of rows on one machine by accelerated gradient descent; the bias is not penalised."""
    n = len(y)
    y = y.astype(np.float32)
    v = np.ones(x.shape[1], np.float32)
    for _ in range(20):  # the largest curvature, by power iteration
        v = x.T @ (x @ v)
        size = float(np.sqrt(v @ v))
        v /= max(size, 1e-12)
    step = np.float32(1 / (0.25 * (1.1 * size / n + 1) + penalty))
    w, b = np.zeros(x.shape[1], np.float32), np.float32(np.log((y.sum() + 0.5) / (n - y.sum() + 1.5)))
    v, c = w.copy(), b
    for k in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ v + c, -30, 30)))
        w2, b2 = v - step * (x.T @ (p - y) / n + np.float32(penalty) * v), c - step * (p - y).mean()
        pull = np.float32(k / (k + 3))
        v, c = w2 + pull * (w2 - w), b2 + pull * (b2 - b)
        w, b = w2, b2
    return w.astype(float), float(b)


def loss_of_all(rows: DataFrame, weights: np.ndarray, penalty: float) -> tuple[int, float, np.ndarray]:
    """How many rows (good, features VECTOR) there are, their mean logistic loss with the penalty, and its
    gradient; the bias is the last of the weights. Each task sends the driver its sums, one number for each weight."""

    def sums(batches):
        total, score = np.zeros(len(weights) + 2), dots(weights[None, :-1])
        for batch in batches:
            row, at, x = entries(batch.column("features"))
            side = np.where(batch.column("good").to_numpy(zero_copy_only=False), -1.0, 1.0)
            z = side * (score(batch.column("features"))[0] + weights[-1])
            pull = side / (1 + np.exp(-np.clip(z, -700, 700)))
            total[:-3] += np.bincount(at, x * pull[row], len(weights) - 1)
            total[-3:] += pull.sum(), np.logaddexp(0, z).sum(), len(z)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    found = rows.select("good", "features").mapInArrow(sums, "sums binary").collect()
    total = sum((np.frombuffer(r["sums"]) for r in found), np.zeros(len(weights) + 2))
    n, w = max(1, int(total[-1])), np.append(weights[:-1], 0)
    return n, float(total[-2] / n + penalty / 2 * (w @ w)), total[:-2] / n + penalty * w


def curvature_strips(rows: DataFrame, n: int, weights: np.ndarray) -> DataFrame:
    """Second derivatives of loss_of_all() of n rows but for the penalty, as strips of the upper triangle: (first, strip), each
    once. Tasks of about CURVED rows multiply out their own and send strips, which are added up by strip."""
    size = len(weights)

    def products(batches):
        total, score = np.zeros((size, size), np.float32), dots(weights[None, :-1])
        for batch in (whole.slice(at, BLOCK) for whole in batches for at in range(0, whole.num_rows, BLOCK)):
            row, at, x = entries(batch.column("features"))
            p = 1 / (1 + np.exp(-np.clip(score(batch.column("features"))[0] + weights[-1], -700, 700)))
            dense = np.zeros((len(p), size), np.float32)
            dense[row, at], dense[:, -1] = x, 1
            dense *= np.sqrt(p * (1 - p)).astype(np.float32)[:, None]
            total += dense.T @ dense
        for k in range(0, size, STRIP):
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([total[k : k + STRIP, k:].tobytes()], pa.binary())], ["first", "strip"])

    def added(batches):
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, strip in zip(batch.column("first").to_pylist(), batch.column("strip")):
                found[k] = found.get(k, 0) + np.frombuffer(strip.as_buffer(), np.float32).astype(float)
        for k, strip in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([(strip / n).tobytes()], pa.binary())], ["first", "strip"])

    kind = "first int, strip binary"
    return rows.select("features").coalesce(-(-n // CURVED)).mapInArrow(products, kind).repartition("first").mapInArrow(added, kind)


def put_together(strips, size: int) -> np.ndarray:
    """The symmetric matrix whose upper triangle is in strips (first, strip)."""
    total = np.zeros((size, size))
    for k, strip in strips:
        part = np.frombuffer(strip).reshape(-1, size - k)
        total[k : k + part.shape[0], k:], total[k:, k : k + part.shape[0]] = part, part.T
    return total


def curvature_of_all(rows: DataFrame, n: int, weights: np.ndarray) -> np.ndarray:
    """curvature_strips() as one matrix on the driver, for few weights; the fit leaves it on the executors."""
    return put_together(curvature_strips(rows, n, weights).collect(), len(weights))


def solved(matrix: np.ndarray, ridge: np.ndarray, wanted: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """x with (matrix + diagonal ridge) x = wanted, by conjugate gradients scaled by the diagonal. Sums go without
    BLAS: its threads were seen to hang in a small driver."""
    scale = 1 / (np.diag(matrix) + ridge)
    x, left = np.zeros(len(wanted)), wanted.copy()
    move = z = scale * left
    size = least = float(left @ z)
    for _ in range(rounds):
        if size <= 1e-16 * least or size <= 0:
            break
        turned = np.einsum("ij,j->i", matrix, move) + ridge * move
        step = size / float(move @ turned)
        x, left = x + step * move, left - step * turned
        z = scale * left
        size, before = float(left @ z), size
        move = z + size / before * move
    return x


def solved_of_all(strips: DataFrame, ridge: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """solved() for the matrix in stored strips, in a task of its own: its size is that of the weights squared, whatever
    the rows, but collecting 2,049 weights' took a driver of 750 MB heap some 300 MB more. The solution alone is sent there."""

    def solve(batches):
        found = ((k, strip.as_buffer()) for batch in batches for k, strip in zip(batch.column("first").to_pylist(), batch.column("strip")))
        yield pa.RecordBatch.from_arrays([pa.array([solved(put_together(found, len(wanted)), ridge, wanted).tobytes()], pa.binary())], ["x"])

    return np.frombuffer(strips.coalesce(1).mapInArrow(solve, "x binary").collect()[0]["x"])


def logistic_of_all(rows: DataFrame, penalty: float, start: np.ndarray, matrix: DataFrame | None = None, rounds: int = 100) -> tuple[np.ndarray, DataFrame | None]:
    """Weights, the bias last, of the least loss_of_all(), by Newton steps from `start`, and the last curvature, stored in strips.
    A curvature, at first that given, is kept while what the next step promises to gain is at most a tenth of
    what the step before did. So the minimum takes some ten passes over the rows, where a gradient method that
    has the rows spread takes hundreds, each a job."""
    weights, kept, last = start, matrix is not None, np.inf
    ridge = np.append(np.full(len(start) - 1, penalty), 1e-12)
    n, loss, slope = loss_of_all(rows, weights, penalty)
    for _ in range(rounds):
        if matrix is None:
            matrix, kept = written(curvature_strips(rows, n, weights), "curvature"), False
        move = -solved_of_all(matrix, ridge, slope)
        gain = -float(slope @ move)
        if gain < GAIN:
            break
        if kept and gain > last / 10:
            matrix = None
            continue
        step, found = 1.0, loss_of_all(rows, weights + move, penalty)
        while not kept and step > 1e-3 and not found[1] <= loss - 1e-4 * step * gain:
            step /= 2
            found = loss_of_all(rows, weights + step * move, penalty)
        if found[1] < loss:
            weights, loss, slope = weights + step * move, *found[1:]
        elif not kept:  # no better by rounding
            break
        else:
            matrix = None
            continue
        last, kept = gain if step == 1 else 0.0, True
    return weights, matrix


def best_penalty_of_all(stored: DataFrame, start: np.ndarray, good: int, poor: int) -> tuple[float, np.ndarray, DataFrame | None]:
    """best_penalty() over stored features, and where to start its fit from; the quarter is drawn by hashes of ids."""
    if min(good, poor) < LEAST:
        return PENALTIES[1], start, None
    back = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    best, least, matrix = None, np.inf, None
    for penalty in PENALTIES:
        start, matrix = logistic_of_all(stored.where(~back), penalty, start, matrix)
        loss = loss_of_all(stored.where(back), start, 0)[1]
        if best is None or loss < least:
            best, least = (penalty, start, matrix), loss
    return best


def best_penalty(x: np.ndarray, y: np.ndarray) -> float:
    """The penalty under which a quarter of the sample, held back, is likeliest."""
    if min(y.sum(), len(y) - y.sum()) < LEAST:
        return PENALTIES[1]
    back = np.arange(len(y)) % 4 == 0

    def loss(penalty: float) -> float:
        w, b = logistic(x[~back], y[~back], penalty)
        return float(np.logaddexp(0, np.where(y[back], -1, 1) * (x[back] @ w + b)).mean())

    return min(PENALTIES, key=loss)


class Model:
    """Densities of the chosen n-grams, weights with the ratios folded in, bias."""

    def __init__(self, sample: Sample) -> None:
        y = sample.y
        self.densities, self.weights = Densities(sample.grams, signs=False), np.zeros(len(sample.grams))
        self.bias = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 1.5)))
        if len(sample.grams) and 0 < y.sum() < len(y):
            x = sample.x
            x *= sample.ratio.astype(np.float32)
            w, self.bias = logistic(x, y, best_penalty(x, y))
            self.weights = w * sample.ratio

    @classmethod
    def of(cls, found: Examples) -> Model:
        """The model of all examples, fitted where they lie."""
        self = cls(Sample(found.grams, found.ratio, np.zeros((0, len(found.grams))), np.zeros((0, 0)), np.zeros(0, bool)))
        self.bias = float(np.log((found.good + 0.5) / (found.poor + 1.5)))
        if len(found.grams) and found.good and found.poor:
            stored = featured(found, False, found.ratio)
            first = tables_written()
            best = best_penalty_of_all(stored, np.append(np.zeros(len(found.grams)), self.bias), found.good, found.poor)
            *w, self.bias = logistic_of_all(stored, *best)[0].tolist()
            self.weights = np.array(w) * found.ratio
            drop_written(stored.sparkSession, first)
        return self

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Probability of each whole text; empty ones have the prior."""
        out = np.full(len(texts), self.bias)
        if len(self.weights):
            for first, x in self.densities.groups([t.decode("utf-8", "replace") for t in texts]):
                out[first : first + len(x)] += x @ self.weights
        return 1 / (1 + np.exp(-np.clip(out, -700, 700)))


def toxicity(docs: DataFrame, labels: DataFrame, target: DataFrame, name: str) -> DataFrame:
    """target with the probability `name` that its text is toxic, learnt from all labels of docs.

    Only text is looked at. Null and empty texts get about the prior, and so do all texts where labels
    of both classes are missing. Very long texts are scored whole, a slice at a time. Repeated rows and
    equal texts score alike; no rows give no rows. A column `name` is replaced, all others stay."""
    model = docs.sparkSession.sparkContext.broadcast(Model.of(examples(docs, labels, "toxic", FEATURES, signs=False)))
    return with_scores(target, lambda texts: model.value.scores(texts), name)


def op2_ngram_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every document; rows with crc32(doc_id) divisible by 5 are never learnt from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = toxicity(docs, table(spark, sf_dir, "labels"), docs, "score")
    return out.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that score below one half, as they are. Null and empty texts are
    kept unless half of the labels are toxic; a column named as the inner score would be replaced, so
    its name is made unlike all others; no documents give none."""
    name = "score"
    while name in docs.columns:
        name += "_"
    scored = toxicity(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"), docs, name)
    return scored.where(F.col(name) < 0.5).drop(name)
