"""Removal of repeated word windows by relative Lempel-Ziv parsing.

A window is WINDOW consecutive words of a document; those that also start in a document with a smaller id
are removed. A document is parsed greedily into factors copied from reference blocks, stretches of at most
about SEGMENT words of earlier documents. A block is indexed by the hash of each of its windows; a factor
starts where a window of the document is in the index and follows the block as long as the words agree.
Factors of less than a window are single words that say nothing. Where a factor ends, windows that cross its
end may lie elsewhere in the block, so the parse goes on with the first of these. Words are compared one by
one; hashes only say where to look.

Not every document meets every block, only those that can hold one of its windows:

1. Of a window's GRAM-word grams the one with the least hash is its anchor, so equal windows have equal
   anchors. Every document that has an anchor's gram is parsed against the first document that has it.
2. What windows around such anchors no factor covers is looked up by its own hash: documents are parsed
   against the first document in which the window was left over too. The first document of a window that is
   not in its anchor's first document is always among those, so nothing is lost.

Stretches of documents meet blocks in a join that streams the documents' side, a third of all rows may go to
one block; a block has a bounded number of words, and a document that holds many passages sends stretches,
not itself.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumflow.llm.common import document_bytes, table, written
from vellumflow.llm.op3_deep_shallow import ODD, _sliding, mixed

WINDOW = 50
GRAM = 20
SPREAD = WINDOW - GRAM + 1  # grams in a window
SEGMENT = 1024
SLICE = 1 << 17  # words hashed at a time
FIRST = -(2**63)
STEP = 4096  # bytes compared at a time at least
INVERSE = np.uint64(pow(int(ODD), -1, 1 << 64))
#: Stretches of a text are parted by one byte, those of a block by another, so that no factor crosses them.
TEXT_END, BLOCK_END = b"\n", b"\r"
BETWEEN = np.isin(np.arange(256), [10, 13, 32])
LETTERS = np.random.default_rng(5).integers(1, 2**63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
FOUND = "key long, doc long, version long, place int"
STRETCH = "block long, segment int, doc long, version long, places array<int>, text binary"
PARSED = "doc long, version long, low array<int>, high array<int>, keys array<long>, places array<int>"

_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base to the powers 0 to n - 1, modulo 2^64; kept, since every call needs them."""
    held = _powers.get(int(base))
    if held is None or len(held) < n:
        held = np.full(max(n, 1 << 16), base)
        held[0] = 1
        _powers[int(base)] = held = np.multiply.accumulate(held)
    return held[:n]


def sums_between(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Polynomial hashes of values[low:high], equal for equal values wherever they stand."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(ODD, len(values)), out=sums[1:])
    return mixed((sums[high] - sums[low]) * powers(INVERSE, len(values) + 1)[low])


def split_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words each of which is followed by one byte of white space."""
    ends = np.flatnonzero(BETWEEN[data])
    return np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends, ends


def hashed(data: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts and ends of words, hash of the `width` words from each on, whether they end in one stretch)
    of stretches of words parted by spaces, each stretch ended by another white space."""
    starts, ends = split_words(data)
    last = np.cumsum(data[ends] != 32)
    n = max(0, len(ends) - width + 1)
    words = sums_between(LETTERS[data], starts, ends) if len(ends) else np.zeros(0, np.uint64)
    at = np.arange(n)
    whole = np.concatenate([[0], last])[:n] == np.concatenate([[0], last])[width - 1 : width - 1 + n] if n else np.zeros(0, bool)
    return starts, ends, sums_between(words, at, at + width) if n else np.zeros(0, np.uint64), whole


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, word, hash of the gram) of the anchors of texts of words parted by single spaces."""
    data = np.frombuffer(TEXT_END.join([*texts, b""]), np.uint8)
    _, ends, grams, _ = hashed(data, GRAM)
    if len(ends) < WINDOW:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0, np.uint64)
    last = np.concatenate([[0], np.cumsum(data[ends] != 32)])  # stretches ended before each word
    order = (grams >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    least = _sliding(order, SPREAD, np.minimum)
    least[last[: len(least)] != last[WINDOW - 1 : WINDOW - 1 + len(least)]] = 0  # not within one text
    none = np.zeros(SPREAD - 1, np.uint32)
    reach = _sliding(np.concatenate([none, least, none]), SPREAD, np.maximum)
    at = np.flatnonzero(reach == order)
    firsts = np.concatenate([[0], np.flatnonzero(data[ends] != 32) + 1])
    text = last[at]
    return text, at - firsts[text], grams[at]


def scan(batches):
    """Anchors of documents, FOUND."""
    for batch in batches:
        docs, versions = batch.column("doc").to_numpy(), batch.column("version").to_numpy()
        waiting: list[tuple[int, int, bytes]] = []
        size = 0
        for i, text in enumerate(document_bytes(batch.column("text"))):
            words = text.split()
            if len(words) < WINDOW:
                continue
            for low in range(0, len(words) - WINDOW + 1, SLICE):
                part = words[low : low + SLICE + WINDOW - 1]
                waiting.append((i, low, b" ".join(part)))
                size += len(part)
                if size >= SLICE:
                    yield _found(waiting, docs, versions)
                    waiting, size = [], 0
        if waiting:
            yield _found(waiting, docs, versions)


def _found(waiting: list[tuple[int, int, bytes]], docs: np.ndarray, versions: np.ndarray) -> pa.RecordBatch:
    text, word, gram = anchors([w[2] for w in waiting])
    row, low = np.array([w[0] for w in waiting])[text], np.array([w[1] for w in waiting])[text]
    return pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(docs[row]), pa.array(versions[row]), pa.array(word + low, pa.int32())], ["key", "doc", "version", "place"])


def cut(batches, before: int, after: int):
    """Stretches of documents, STRETCH: for each block the words from `before` words before the places
    wanted there to `after` words after, those that overlap in one."""
    for batch in batches:
        docs, versions = batch.column("doc").to_numpy(), batch.column("version").to_numpy()
        wanted = batch.column("wanted")
        row = np.repeat(np.arange(batch.num_rows), np.diff(wanted.offsets.to_numpy()))
        block, segment, place = (wanted.flatten().field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3))
        words = [t.split() for t in document_bytes(batch.column("text"))]
        order = np.lexsort((place, segment, block, row))
        row, block, segment, place = row[order], block[order], segment[order], place[order]
        low, high = np.maximum(place - before, 0), np.minimum(place + after, np.array([len(w) for w in words], np.int64)[row])
        fresh = np.concatenate([[True], (row[1:] != row[:-1]) | (block[1:] != block[:-1]) | (segment[1:] != segment[:-1])])
        heads = np.flatnonzero(fresh | np.concatenate([[True], low[1:] > high[:-1]]))
        low, high, own = low[heads], high[np.append(heads[1:], len(high)) - 1], heads
        starts = np.flatnonzero(fresh[own])
        out: list[tuple] = []
        size = 0
        for a, b in zip(starts.tolist(), np.append(starts[1:], len(own)).tolist()):
            i, w = row[own[a]], words[row[own[a]]]
            end = BLOCK_END if docs[i] == block[own[a]] else TEXT_END
            text = b"".join(b" ".join(w[x:y]) + end for x, y in zip(low[a:b].tolist(), high[a:b].tolist()))
            out.append((block[own[a]], segment[own[a]], docs[i], versions[i], low[a:b], text))
            size += len(text)
            if size > 1 << 22:
                yield _rows(out, STRETCH)
                out, size = [], 0
        if out:
            yield _rows(out, STRETCH)


_TYPES = {"long": pa.int64(), "int": pa.int32(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()), "binary": pa.binary()}


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, types = zip(*(c.split() for c in schema.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, t in zip(zip(*rows), types)], list(names))


def agreement(text: np.ndarray, at: int, block: np.ndarray, to: int) -> int:
    """Bytes that text from `at` and block from `to` have in common."""
    done, step, most = 0, STEP, min(len(text) - at, len(block) - to)
    while done < most:
        n = min(step, most - done)
        differ = text[at + done : at + done + n] != block[to + done : to + done + n]
        first = int(differ.argmax())
        if differ[first]:
            return done + first
        done, step = done + n, step * 4
    return most


class Block:
    """A reference block: its words and its windows by hash, each at its first place."""

    def __init__(self, text: bytes) -> None:
        self.data = np.frombuffer(text, np.uint8)
        starts, _, hashes, whole = hashed(self.data, WINDOW)
        at = np.flatnonzero(whole)
        self.hashes, first = np.unique(hashes[at], return_index=True)
        self.starts = starts[at[first]]

    def look_up(self, hashes: np.ndarray) -> np.ndarray:
        """Where in the block each window starts, -1 for none."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.starts[at], -1)


def factors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, places: np.ndarray, block: Block) -> list[tuple[int, int]]:
    """Long factors [from, to), in words of the text, of its greedy parse against a block. places: where in
    the block the window at each word starts, or -1."""
    out = []
    ahead = np.flatnonzero(places >= 0)
    k = 0
    while k < len(ahead):
        word = int(ahead[k])
        at, to = int(starts[word]), int(places[word])
        common = agreement(data, at, block.data, to)
        last = int(np.searchsorted(ends, at + common))  # words before it agree with their white space
        if at + common < len(data) and to + common < len(block.data) and BETWEEN[data[at + common]] and BETWEEN[block.data[to + common]]:
            last += 1  # both words end, one of them its stretch
        if last - word < WINDOW:
            k += 1  # another window of the same hash
            continue
        out.append((word, last))
        k = max(k + 1, int(np.searchsorted(ahead, last - WINDOW + 1)))
    return out


def parse(batches, with_rest: bool):
    """PARSED, from stretches joined to blocks: the words that factors cover, and windows in none."""
    key, block = None, Block(b"")
    for batch in batches:
        docs, versions, ids = (batch.column(c).to_numpy() for c in ("doc", "version", "block"))
        segments, others = batch.column("segment").to_numpy(), batch.column("block_version").to_numpy()
        texts, blocks = batch.column("text"), batch.column("block_text")
        low_places = batch.column("places").to_pylist()
        for first, upto in _slices(pc.binary_length(texts).to_numpy()):
            held = [texts[i].as_py() for i in range(first, upto)]
            data = np.frombuffer(b"".join(held), np.uint8)
            starts, ends, hashes, whole = hashed(data, WINDOW)
            edges = np.searchsorted(starts, np.cumsum([0, *map(len, held)]))
            out = []
            for n, i in enumerate(range(first, upto)):
                if key != (ids[i], segments[i], others[i]):
                    key, block = (ids[i], segments[i], others[i]), Block(blocks[i].as_py())
                a, b = int(edges[n]), int(edges[n + 1])
                at = np.arange(a, min(b, len(hashes)))
                at = at[whole[at]]
                places = np.full(b - a, -1)
                places[at - a] = block.look_up(hashes[at])
                begin = int(starts[a])
                found = factors(data[begin : int(ends[b - 1]) + 1], starts[a:b] - begin, ends[a:b] - begin, places, block)
                # Words of the stretches as words of the document.
                breaks = np.flatnonzero(data[ends[a:b]] != 32)
                lengths = np.diff(np.concatenate([[-1], breaks]))
                word = np.arange(b - a) + np.repeat(np.array(low_places[i]) - np.concatenate([[0], lengths.cumsum()[:-1]]), lengths)
                rest = at[:0]
                if with_rest:
                    covered = np.zeros(b - a + 1, np.int64)
                    for x, y in found:
                        covered[x] += 1
                        covered[y - WINDOW + 1] -= 1
                    rest = at[covered.cumsum()[at - a] == 0]
                out.append((docs[i], versions[i], [word[x] for x, _ in found], [word[y - 1] + 1 for _, y in found], hashes[rest].view(np.int64), word[rest - a]))
            yield _rows(out, PARSED)


def _slices(sizes: np.ndarray):
    """Runs of rows with about 4 MB."""
    first, size = 0, 0
    for i, n in enumerate(sizes.tolist()):
        size += n
        if size > 1 << 22:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(sizes):
        yield first, len(sizes)


def _parsed(docs: DataFrame, found: DataFrame, before: int, after: int, name: str, with_rest: bool) -> DataFrame:
    """PARSED, for what is found of keys (FOUND): the documents of a key against the first that has it."""
    firsts = found.groupBy("key").agg(F.min(F.struct("doc", "place")).alias("first"), F.max("doc").alias("last")).where("first.doc < last")
    firsts = firsts.select("key", F.col("first.doc").alias("block"), F.expr(f"cast(first.place div {SEGMENT} as int)").alias("segment"))
    routed = found.join(firsts, "key").groupBy("doc", "version").agg(F.collect_set(F.struct("block", "segment", "place")).alias("wanted"))
    stretches = written(docs.join(routed, ["doc", "version"]).select("doc", "version", "text", "wanted").mapInArrow(lambda batches: cut(batches, before, after), STRETCH), f"{name}-stretches")
    blocks = stretches.where("doc = block").groupBy("block", "segment", "version").agg(F.first("text").alias("block_text")).withColumnRenamed("version", "block_version")
    met = stretches.where("doc <> block").join(blocks, ["block", "segment"])
    return written(met.mapInArrow(lambda batches: parse(batches, with_rest), PARSED), f"{name}-factors")


def repeated_words(docs: DataFrame) -> DataFrame:
    """(doc, version, low, high) of documents (doc, version, text) with words to remove: arrays of the
    ends of spans, in words, in no order; spans may overlap."""
    found = written(docs.select("doc", "version", "text").mapInArrow(scan, FOUND), "anchors")
    first = _parsed(docs, found, SPREAD - 1, WINDOW, "anchored", True)
    rest = first.select("doc", "version", F.explode(F.arrays_zip("keys", "places")).alias("w")).select(F.col("w.keys").alias("key"), "doc", "version", F.col("w.places").alias("place"))
    second = _parsed(docs, rest, 0, WINDOW, "left", False)
    spans = first.union(second).where(F.size("low") > 0)
    return spans.groupBy("doc", "version").agg(F.flatten(F.collect_list("low")).alias("low"), F.flatten(F.collect_list("high")).alias("high"))


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", with_text: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, low, high, kept) for every row: each word in a window that
    also starts in a document with a smaller doc_id is removed. [low, high) are the spans removed, in words;
    kept, null unless with_text, holds the other words joined by single spaces.

    A null doc_id is smaller than all others; rows of equal doc_id count as one document, so that equal rows
    do not remove each other. Null, empty and white texts have no words; texts under WINDOW words are kept;
    very long texts are read whole; no rows give no rows. Other columns, whatever their names, are not
    looked at."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    named = docs.select(F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(FIRST)).alias("doc"), F.xxhash64(body).alias("version"), F.col(f"`{key}`").cast("long").alias("doc_id"), body.alias("text"))
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", "low", "high", "kept"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]

    def finish(batches):
        for batch in batches:
            lows, highs = batch.column("low").to_pylist(), batch.column("high").to_pylist()
            out = []
            for i, data in enumerate(document_bytes(batch.column("text"))):
                words = data.split()
                runs: list[list[int]] = []
                for x, y in sorted(zip(lows[i] or (), highs[i] or ())):
                    if runs and x <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], y)
                    else:
                        runs.append([x, y])
                left, at = [], 0
                for x, y in runs:
                    left += words[at:x]
                    at = y
                left += words[at:]
                kept = b" ".join(left)
                out.append((len(words), len(words) - len(left), hashlib.sha256(kept).hexdigest(), [x for x, _ in runs], [y for _, y in runs], kept if with_text else None))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 6, types[1:]))], names)

    joined = named.join(repeated_words(named), ["doc", "version"], "left").select("doc_id", "text", "low", "high")
    return joined.mapInArrow(finish, "doc_id long, n_words long, n_removed long, kept_sha256 string, low array<long>, high array<long>, kept binary")


def op13_relative_lz_dedup(spark, sf_dir: str) -> DataFrame:
    """What is removed from every document as windows of 50 words that an earlier document has."""
    return without_repeats(table(spark, sf_dir, "documents"), with_text=False).select("doc_id", "n_words", "n_removed", "kept_sha256")


ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, -9223372036854775808) AS doc, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), p AS (
  SELECT r, doc, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d WHERE len(w) >= {WINDOW}
), k AS (
  SELECT p.r, p.doc, i, md5(array_to_string(list_slice(w, i, i + {WINDOW - 1}), ' ')) AS k FROM p JOIN d USING (r)
), f AS (
  SELECT r, i, doc > min(doc) OVER (PARTITION BY k) AS again FROM k
), x AS (
  SELECT DISTINCT r, unnest(range(i, i + {WINDOW})) AS j FROM f WHERE again
), e AS (
  SELECT r, list(j) AS gone FROM x GROUP BY r
), o AS (
  SELECT doc_id, w, coalesce(len(gone), 0) AS n_removed,
    list_filter(list_transform(w, lambda y, j: CASE WHEN gone IS NULL OR NOT list_contains(gone, j) THEN y END), lambda y: y IS NOT NULL) AS kept
  FROM d LEFT JOIN e USING (r)
)
SELECT doc_id, len(w) AS n_words, n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM o
"""
