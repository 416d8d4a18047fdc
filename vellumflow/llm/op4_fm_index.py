"""Benchmark decontamination with an FM-index per shard of the training texts.

A shard is the word sequence of some documents, as symbols of the benchmark's vocabulary. Its
Burrows-Wheeler transform lies in a wavelet matrix; all test phrases are searched backwards at once,
their occurrences located by walking to sampled suffix positions, and the spans merged.
"""

from __future__ import annotations

import pickle
import re
import zlib
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumflow.llm.common import document_bytes, table

WINDOW = 10
SHARD_BYTES = 4 << 20
SHARD_WORDS = 1 << 20
PHRASE_BYTES = 32 << 20
GATHER = 32 << 20
SAMPLE = 8
# Bytes of words stay, A-Z fold to a-z, all others part words.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


class Phrases:
    """The windows of some benchmark items: vocabulary, distinct windows as symbols from 1, and the
    items of each."""

    def __init__(self, items: list[tuple[str, bytes]], width: int) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.items = [i for i, _ in items]
        windows: dict[tuple[int, ...], set[int]] = {}
        for at, (_, text) in enumerate(items):
            symbols = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in text.translate(FOLD).split()]
            for i in range(max(1, len(symbols) - width + 1) if symbols else 0):
                windows.setdefault(tuple(symbols[i : i + width]), set()).add(at)
        self.lengths = np.array([len(w) for w in windows], np.int64)
        self.longest = int(self.lengths.max(initial=0))
        self.shortest = int(self.lengths.min()) if windows else 0
        #: Right-aligned, 0 where a window is shorter.
        self.windows = np.zeros((len(windows), self.longest), np.int64)
        for row, w in zip(self.windows, windows):
            row[self.longest - len(w) :] = w
        self.owners = [sorted(x) for x in windows.values()]


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; the last symbol must be the only 0."""
    n, step = len(symbols), 1
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    while True:
        after = np.zeros(n, np.int64)
        after[:-step] = rank[step:] + 1
        pair = rank * (n + 1) + after
        order = np.argsort(pair, kind="stable")
        steps = np.concatenate([[0], np.diff(pair[order]) > 0]).cumsum()
        rank[order] = steps
        if steps[-1] == n - 1:
            return order
        step *= 2
        if step >= n:
            return order


class FMIndex:
    """Counts and places of symbol sequences in a text of symbols from 1 up."""

    def __init__(self, text: np.ndarray) -> None:
        symbols = np.append(text, 0)
        order = suffix_order(symbols)
        self.size = len(symbols)
        transform = symbols[order - 1]
        top = int(symbols.max())
        self.before = np.concatenate([[0], np.bincount(symbols, minlength=top + 1).cumsum()])
        self.sampled = order % SAMPLE == 0
        self.sample_rank = np.cumsum(self.sampled) - 1
        self.samples = order[self.sampled]
        #: From the highest bit: (zeros, ones before each 64 bits, the bits).
        self.levels = []
        for shift in range(max(1, top.bit_length()) - 1, -1, -1):
            bits = (transform >> shift & 1).astype(bool)
            words = np.zeros(self.size // 64 + 1, np.uint64)
            packed = np.packbits(bits, bitorder="little")
            words.view(np.uint8)[: len(packed)] = packed
            ones = np.concatenate([[0], np.bitwise_count(words).astype(np.int64).cumsum()])
            self.levels.append((shift, self.size - int(ones[-1]), ones, words))
            transform = np.concatenate([transform[~bits], transform[bits]])

    @staticmethod
    def _ones(at: np.ndarray, ones: np.ndarray, words: np.ndarray) -> np.ndarray:
        block = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return ones[block] + np.bitwise_count(words[block] & mask)

    def step(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """First row of the suffixes that begin with symbol and go on as the rows before `at`."""
        low = np.zeros_like(at)
        for shift, zeros, ones, words in self.levels:
            one = (symbol >> shift & 1).astype(bool)
            a, b = self._ones(low, ones, words), self._ones(at, ones, words)
            low, at = np.where(one, zeros + a, low - a), np.where(one, zeros + b, at - b)
        return self.before[symbol] + at - low

    def symbol(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros_like(at)
        for _, zeros, ones, words in self.levels:
            one = (words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
            a = self._ones(at, ones, words)
            at, out = np.where(one, zeros + a, at - a), out << 1 | one
        return out

    def search(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, position) of every occurrence of right-aligned windows."""
        top = len(self.before) - 2
        alive = np.flatnonzero((windows <= top).all(axis=1))
        low, high = np.zeros(len(alive), np.int64), np.full(len(alive), self.size, np.int64)
        for column in range(windows.shape[1] - 1, -1, -1):
            c = windows[alive, column]
            low, high = np.where(c > 0, self.step(c, low), low), np.where(c > 0, self.step(c, high), high)
            found = low < high
            alive, low, high = alive[found], low[found], high[found]
        counts = high - low
        row = np.repeat(low - (counts.cumsum() - counts), counts) + np.arange(counts.sum())
        return np.repeat(alive, counts), self._locate(row)

    def _locate(self, row: np.ndarray) -> np.ndarray:
        place, steps = np.zeros(len(row), np.int64), 0
        left = np.arange(len(row))
        while len(left):
            done = self.sampled[row]
            place[left[done]] = self.samples[self.sample_rank[row[done]]] + steps
            left, row = left[~done], row[~done]
            row = self.step(self.symbol(row), row) if len(row) else row
            steps += 1
        return place


def word_symbols(text: bytes, vocabulary: dict[bytes, int]) -> np.ndarray:
    """The text's words as symbols, 0 for words outside the vocabulary; cut from a slice at a time."""
    text, at, parts = text.translate(FOLD), 0, [np.zeros(0, np.int64)]
    while at < len(text):
        end = text.find(b" ", at + SHARD_BYTES)
        words = text[at : end if end >= 0 else len(text)].split()
        parts.append(np.fromiter(map(vocabulary.get, words, repeat(0)), np.int64, len(words)))
        at = end if end >= 0 else len(text)
    return np.concatenate(parts)


def occurrences(symbols: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(window, position) in a sequence in which 0 parts what cannot match across. Only runs of
    vocabulary words as long as the shortest window are indexed: no other word can be hit."""
    inside = np.concatenate([[False], symbols > 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= phrases.shortest
    starts, sizes = starts[long], (ends - starts)[long]
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # Runs side by side, each followed by a parting symbol above the vocabulary.
    places = np.repeat(starts - np.concatenate([[0], (sizes + 1).cumsum()[:-1]]), sizes + 1) + np.arange((sizes + 1).sum())
    text = np.concatenate([symbols, [0]])[places]
    text[(sizes + 1).cumsum() - 1] = len(phrases.vocabulary) + 1
    found = []
    for at in range(0, len(text), SHARD_WORDS):
        part = text[at : at + SHARD_WORDS + phrases.longest - 1]
        window, place = FMIndex(part).search(phrases.windows)
        found.append((window, places[place + at]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _shards(texts: list[bytes], limit: int):
    """Runs of texts of about `limit` bytes."""
    first = size = 0
    for i, x in enumerate(texts):
        size += len(x)
        if size >= limit or i == len(texts) - 1:
            yield texts[first : i + 1]
            first, size = i + 1, 0


def scan(texts: list[bytes], phrases: Phrases) -> list[tuple[int, np.ndarray, set[str]]]:
    """For each text of a shard: its words, which of them are hit, and the items with occurring windows."""
    parts = [word_symbols(x, phrases.vocabulary) for x in texts]
    starts = np.cumsum([0, *(len(p) + 1 for p in parts)])
    symbols = np.zeros(starts[-1], np.int64)
    for a, p in zip(starts, parts):
        symbols[a : a + len(p)] = p
    window, place = occurrences(symbols, phrases)
    change = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(change, place, 1)
    np.add.at(change, place + phrases.lengths[window], -1)
    hit = change.cumsum() > 0
    out: list[tuple[int, np.ndarray, set[str]]] = [(len(p), hit[a : a + len(p)], set()) for a, p in zip(starts, parts)]
    document = np.searchsorted(starts, place, "right") - 1
    pairs = np.unique(document * (len(phrases.lengths) + 1) + window)
    for d, w in zip(*(x.tolist() for x in np.divmod(pairs, len(phrases.lengths) + 1))):
        out[d][2].update(phrases.items[i] for i in phrases.owners[w])
    return out


_held: dict[tuple[int, int], Phrases] = {}


def _packed(items: list[tuple[str, bytes]], width: int) -> bytes:
    return zlib.compress(pickle.dumps((items, width)))


def _unpacked(block: bytes) -> Phrases:
    return Phrases(*pickle.loads(zlib.decompress(block)))


class Scanner:
    """Scans texts against all blocks of a benchmark. A single block's phrases are kept by the worker
    from task to task; of several blocks one at a time is unpacked, for GATHER bytes of texts."""

    def __init__(self, blocks: list) -> None:
        self.blocks = blocks

    def _phrases(self):
        if len(self.blocks) > 1:
            yield from (_unpacked(b.value) for b in self.blocks)
        elif self.blocks:
            block = self.blocks[0].value
            key = zlib.crc32(block), len(block)
            if key not in _held:
                _held.clear()
                _held[key] = _unpacked(block)
            yield _held[key]
        else:
            yield Phrases([], 1)

    def __call__(self, texts: list[bytes]) -> list[tuple[int, np.ndarray, set[str]]]:
        total: list[tuple[int, np.ndarray, set[str]]] = []
        for phrases in self._phrases():
            found = [row for shard in _shards(texts, SHARD_BYTES) for row in scan(shard, phrases)]
            total = [(n, h | g, s | t) for (n, h, s), (_, g, t) in zip(total, found)] if total else found
        return total

    def batches(self, batches, at: int):
        """(batch, its texts, what was found in them) of every batch with the texts in column `at`."""
        waiting: list[tuple] = []
        size = 0
        for batch in batches:
            texts = document_bytes(batch.column(at))
            waiting.append((batch, texts))
            size += sum(map(len, texts))
            if len(self.blocks) < 2 or size >= GATHER:
                yield from self._found(waiting)
                waiting, size = [], 0
        yield from self._found(waiting)

    def _found(self, waiting: list[tuple]):
        found = self([x for _, texts in waiting for x in texts])
        first = 0
        for batch, texts in waiting:
            yield batch, texts, found[first : first + len(texts)]
            first += len(texts)


def phrase_blocks(benchmark: DataFrame, width: int, limit: int = PHRASE_BYTES) -> list:
    """Broadcasts of the items, compressed, each of about `limit` bytes of benchmark text, however large
    the benchmark is: the driver and a task unpack one block at a time. Null texts have no windows; a
    null item_id reads as the empty string."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = total // limit + 1
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
    blocks = ([(r["item_id"], r["text"].encode()) for r in dealt.where(F.col("block") == k).collect()] for k in range(n))
    return [spark.sparkContext.broadcast(_packed(rows, width)) for rows in blocks if rows]


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """A row per document: doc_id, n_words, n_hit, items (distinct item_ids, sorted as strings) and
    spans (merged runs of hit words, [start, end)).

    Texts are lower-cased (A-Z); words are runs of a-z, 0-9 and non-ASCII characters. Windows are
    `width` words of an item, or all words of a shorter one. Null and empty texts have no words and no
    hits; an empty benchmark hits nothing; very long texts are indexed whole, in stretches that overlap by
    a window; items of equal windows are all found; repeated rows are answered each; no rows give no rows.
    Other columns, whatever their names, are not looked at."""
    blocks = phrase_blocks(benchmark, width)

    def answer(batches):
        for batch, _, rows in Scanner(blocks).batches(batches, 1):
            spans = [np.flatnonzero(np.diff(np.concatenate([[0], h.view(np.int8), [0]]))).reshape(-1, 2).tolist() if h.any() else [] for _, h, _ in rows]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([n for n, _, _ in rows], pa.int64()), pa.array([int(h.sum()) for _, h, _ in rows], pa.int64()), pa.array([sorted(s) for _, _, s in rows], pa.list_(pa.string())), pa.array(spans, pa.list_(pa.list_(pa.int64())))], ["doc_id", "n_words", "n_hit", "items", "spans"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(answer, f"doc_id {dict(docs.dtypes)['doc_id']}, n_words long, n_hit long, items array<string>, spans array<array<long>>")


def without_spans(text: bytes, hit: np.ndarray) -> bytes:
    """The text without its hit words and what lies between neighbouring ones."""
    words = [(m.start(), m.end()) for m in re.finditer(rb"[^ ]+", text.translate(FOLD))]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))).reshape(-1, 2)
    out, at = [], 0
    for a, b in edges.tolist():
        out.append(text[at : words[a][0]])
        at = words[b - 1][1]
    return b"".join([*out, text[at:]])


def op4_fm_index_decontamination(spark, sf_dir: str) -> DataFrame:
    """Words, hit words and the items found in every document."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents without the merged spans of benchmark windows. A document of
    which no word is left goes; n_chars of a cut text counts what is left; all else stays as it is, null and
    empty texts and columns of any name included; repeated rows are cut alike; no documents give none."""
    blocks = phrase_blocks(table(spark, sf_dir, "benchmark"), WINDOW)
    at = docs.columns.index("text")
    size = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def cut(batches):
        for batch, texts, rows in Scanner(blocks).batches(batches, at):
            hits = [h for _, h, _ in rows]
            touched = [i for i, h in enumerate(hits) if h.any()]
            if touched:
                columns = list(batch.columns)
                left = columns[at].to_pylist()
                counts = columns[size].to_pylist() if size is not None else []
                for i in touched:
                    left[i] = without_spans(texts[i], hits[i]).decode()
                    if counts:
                        counts[i] = len(left[i])
                columns[at] = pa.array(left, columns[at].type)
                if counts:
                    columns[size] = pa.array(counts, columns[size].type)
                batch = pa.RecordBatch.from_arrays(columns, batch.schema.names).filter(pa.array([not len(h) or not h.all() for h in hits]))
            yield batch

    return docs.mapInArrow(cut, docs.schema)


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL
), bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + 9), ' ') AS k
  FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(i) WHERE len(w) > 0
), dw AS (
  SELECT r, i, n.n, array_to_string(list_slice(w, i, i + n.n - 1), ' ') AS k
  FROM d, (SELECT DISTINCT n FROM bw) AS n, unnest(range(1, len(w) - n.n + 2)) AS u(i)
), m AS (
  SELECT dw.r, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.k = bw.k
), hits AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM m) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM m) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r)
"""
