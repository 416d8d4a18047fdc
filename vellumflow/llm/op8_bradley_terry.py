"""Quality by Bradley-Terry pairwise ranking.

A document's score is linear in measures of its text and in the densities of character n-grams that
good and poor labelled texts differ in. In a preference pair the chance that one is preferred is
the logistic function of the difference of the scores, so that weights come from a logistic loss on
feature differences. The score that cuts off the labels' share of poor documents, a quantile, is
placed at the threshold.
"""

from __future__ import annotations

import operator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellumflow.llm.common import is_held_out, table, with_scores, written
from vellumflow.llm.ngrams import VECTOR, Densities, Examples, as_vectors, dots, examples, featured, fitted, sparse

FEATURES = 512
PAIRS = 40_000  # at least; every labelled text is in one
BUCKETS = 1024  # of ids, in which rows are numbered
HELD = 10_000  # ranks that the driver sorts
PENALTY = 1e-3
THRESHOLD = 0.3
SLICE = 1 << 20
UPPER, LOWER, DIGIT, STOPS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b".,;:!?"
HIGH = bytes(range(128, 256))
SIGNS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and c not in STOPS)


def _word_measures(text: bytes) -> tuple[int, int, int, int]:
    """Words, distinct words, words equal to the one before and bytes of words; cut from a slice of the
    text at a time."""
    n = same = size = 0
    kinds: set[bytes] = set()
    last, at = b"", 0
    while at < len(text):
        end = text.find(b" ", at + SLICE)
        words = text[at : end if end >= 0 else len(text)].split()
        at = end if end >= 0 else len(text)
        if words:
            n, size = n + len(words), size + sum(map(len, words))
            same += sum(map(operator.eq, words, words[1:])) + (words[0] == last)
            last = words[-1]
            kinds.update(words)
    return n, len(kinds), same, size


def measures(text: bytes) -> list[float]:
    """Numbers about a whole text, none fitted to any corpus: shares of kinds of characters, repeated
    words and lines, lengths. An empty text has mostly zeros."""
    length = max(1, len(text))
    count = lambda signs: len(text) - len(text.translate(None, signs))
    kinds_of = [count(x) / length for x in (UPPER, LOWER, DIGIT, SIGNS, STOPS, HIGH)]
    n, kinds, same, size = _word_measures(text)
    lines = text.split(b"\n")
    words, again = max(1, n), len(lines) - len(set(lines))
    share = [*kinds_of, 1 - kinds / words, same / words, again / len(lines)]
    much = [np.log1p(x) for x in (len(text), n, len(lines), same, again, size / words)]
    return [*share, *(float(np.sqrt(max(0.0, x))) for x in share), *map(float, much)]


def bradley_terry(x: np.ndarray, better: np.ndarray, worse: np.ndarray, penalty: float, rounds: int = 500) -> np.ndarray:
    """Weights w under which the preferences of row better[k] of x over row worse[k], each of chance
    logistic(w . difference), are likeliest, by accelerated gradient descent. Differences are never
    written out: pairs are summed by row first."""
    n, pairs = len(x), len(better)

    def spread(pull: np.ndarray) -> np.ndarray:
        return (x.T @ (np.bincount(better, pull, n) - np.bincount(worse, pull, n)).astype(x.dtype)).astype(float) / pairs

    v, size = np.ones(x.shape[1]), 1.0
    for _ in range(20):  # the largest curvature, by power iteration
        ranks = x @ v.astype(x.dtype)
        v = spread(ranks[better] - ranks[worse])
        size = float(np.sqrt(v @ v))
        v /= max(size, 1e-12)
    step = 1 / (0.25 * 1.1 * size + penalty + 1e-12)
    w = np.zeros(x.shape[1])
    v = w.copy()
    for k in range(rounds):
        ranks = x @ v.astype(x.dtype)
        missed = 1 / (1 + np.exp(np.clip(ranks[better] - ranks[worse], -30, 30)))
        following = v + step * (spread(missed) - penalty * v)
        v = following + k / (k + 3) * (following - w)
        w = following
    return w


def numbered(rows: DataFrame) -> DataFrame:
    """rows with `at`, from 0 without gaps in each class, by hashes of ids."""
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS)))
    # Two rows for each bucket.
    counts = rows.groupBy("good", "bucket").count()
    before = counts.withColumn("before", F.sum("count").over(Window.partitionBy("good").orderBy("bucket")) - F.col("count")).drop("count")
    within = F.row_number().over(Window.partitionBy("good", "bucket").orderBy(F.xxhash64("doc_id"), "doc_id"))
    return rows.withColumn("within", within).join(F.broadcast(before), ["good", "bucket"]).withColumn("at", F.col("before") + F.col("within") - 1).drop("bucket", "before", "within")


def preferences(stored: DataFrame, good: int, poor: int, least: int) -> DataFrame:
    """(label, features VECTOR), stored, of max(least, good, poor) pairs: the difference of the better and the
    worse text, label 1, or, in every other pair, of the worse and the better, label 0. Each text of the
    larger class is paired in turn with the next of the other, so that all of both take part."""
    larger, more, fewer = good >= poor, max(good, poor), min(good, poor)
    pairs, rows = max(least, more), numbered(stored)
    again = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.lit(pairs - 1) - F.col("at")) / more)))
    left = rows.where(F.col("good") == larger).select("at", "features", again.alias("round"))
    left = left.select("at", "round", "features", ((F.col("at") + F.col("round") * (more + 1)) % fewer).alias("other"))
    right = rows.where(F.col("good") != larger).select(F.col("at").alias("other"), F.col("features").alias("against"))

    def differ(batches):
        for batch in (whole.slice(at, 256) for whole in batches for at in range(0, whole.num_rows, 256)):
            out, label = [], []
            for turn, a, b in zip(*(batch.column(c).to_pylist() for c in ("turn", "features", "against"))):
                row = np.zeros(a["size"])
                row[a["indices"]] = a["values"]
                row[b["indices"]] -= np.array(b["values"])
                row = row if turn == 0 else -row
                out.append((at := np.flatnonzero(row), row[at]))
                label.append(float(larger == (turn == 0)))
                size = len(row)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(label, pa.float64()), sparse(out, size)], ["label", "features"])

    both = left.join(right, "other").sortWithinPartitions("other", "at", "round")
    both = both.select(F.pmod(F.col("at") + F.col("round"), F.lit(2)).alias("turn"), "features", "against")
    return written(both.mapInArrow(differ, f"label double, features {VECTOR}"), "preferences")


def in_order(ranks: DataFrame, n: int, place: int) -> float:
    """The value at a place, from 0, of the n sorted values `rank`: bins are counted and all but the one that
    holds it left out, until few enough values are left to sort."""
    rows = ranks.select("rank")
    while n > HELD:
        least, most = rows.agg(F.min("rank"), F.max("rank")).first()
        if least == most:
            return least
        bin_of = F.least(F.floor((F.col("rank") - least) / (most - least) * 4096), F.lit(4095))
        counts = sorted(map(tuple, rows.groupBy(bin_of.alias("bin")).count().collect()))
        upto = np.cumsum([c for _, c in counts])
        i = int(np.searchsorted(upto, place, "right"))
        rows, n, place = rows.where(bin_of == counts[i][0]), counts[i][1], place - int(upto[i] - counts[i][1])
    return sorted(r["rank"] for r in rows.collect())[place]


def quantile(ranks: DataFrame, n: int, share: float) -> float:
    """np.quantile of the n values `rank`."""
    place = (n - 1) * share
    low = in_order(ranks, n, int(place))
    return low + (place - int(place)) * (in_order(ranks, n, min(n - 1, int(place) + 1)) - low)


class Ranking:
    """Chosen n-grams, scaling, weights, and the line from ranking scores to probabilities."""

    def __init__(self, found: Examples) -> None:
        """Fitted to all examples, where they lie."""
        self.known, good, n = len(found.known), found.good, found.good + found.poor
        width = self.known + len(found.grams)
        self.densities = Densities(found.grams, signs=True)
        self.mean, self.scale, self.weights, self.cut, self.slope = np.zeros(width), np.ones(width), np.zeros(width), 0.0, 1.0
        #: What a text scores where there is nothing to rank by.
        self.base = float(np.log((good + 1) / (found.poor + 1)))
        if not 0 < good < n:
            return
        self.base = float(np.log(THRESHOLD / (1 - THRESHOLD)))
        self.mean, self.scale = np.concatenate([found.known[:, 0], found.mean]), np.concatenate([found.known[:, 1], found.scale]) + 1e-6
        stored = featured(found, True, 1 / self.scale)
        self.weights, _ = fitted(as_vectors(preferences(stored, good, found.poor, PAIRS)), PENALTY, False)
        weights, middle = self.weights, float(self.mean / self.scale @ self.weights)

        def ranked(batches):
            score = dots(weights[None])
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column("good"), pa.array(score(batch.column("features"))[0] - middle)], ["good", "rank"])

        ranks = written(stored.select("good", "features").mapInArrow(ranked, "good boolean, rank double"), "ranks")
        self.cut = quantile(ranks, n, 1 - good / n)
        slopes = np.geomspace(0.05, 5, 60).tolist()
        missed = lambda slope: F.when(F.col("good"), -1).otherwise(1) * (slope * (F.col("rank") - self.cut) + self.base)
        loss = ranks.agg(*(F.sum(F.greatest(missed(x), F.lit(0.0)) + F.log1p(F.exp(-F.abs(missed(x))))) for x in slopes)).first()
        self.slope = slopes[int(np.argmin(loss))]

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        x = np.array([measures(t) for t in texts])[:, : self.known]
        ranks = (x - self.mean[: self.known]) / self.scale[: self.known] @ self.weights[: self.known]
        if self.densities.size:
            scaled = self.weights[self.known :] / self.scale[self.known :]
            for first, found in self.densities.groups([t.decode("utf-8", "replace") for t in texts]):
                ranks[first : first + len(found)] += (found - self.mean[self.known :]) @ scaled
        return 1 / (1 + np.exp(-np.clip(self.slope * (ranks - self.cut) + self.base, -700, 700)))


def quality(docs: DataFrame, labels: DataFrame, target: DataFrame, name: str) -> DataFrame:
    """target with the probability `name` that its text is good, learnt from all labels of docs.

    Only text is looked at. Null texts count as empty and are ranked like any other; where labels of
    both classes are missing every text gets the labels' share. Very long texts are measured whole, a
    slice at a time. Repeated rows and equal texts score alike; no rows give no rows. A column `name` is
    replaced, all others stay."""
    found = examples(docs, labels, "quality", FEATURES, signs=True, measures=measures)
    model = docs.sparkSession.sparkContext.broadcast(Ranking(found))
    return with_scores(target, lambda texts: model.value.scores(texts), name)


def op8_bradley_terry_quality(spark, sf_dir: str) -> DataFrame:
    """Quality of every document; rows with crc32(doc_id) divisible by 5 are never learnt from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = quality(docs, table(spark, sf_dir, "labels"), docs, "score")
    return out.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
