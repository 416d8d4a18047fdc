"""Token ids in compressed files: canonical length-limited Huffman coding from global counts.

Format. A file set is a folder with two Parquet tables. `codebook` has a row per used id: id, length
of its code. Codes are canonical: by length, then id, each the one before plus one, moved left by the
gain in length. `segments` has rows of whole documents in order, about GROUP_BYTES characters of text each:
  part, seq       place in the order of all segments
  doc_ids         list<long>, the documents in ascending order (nulls first)
  counts          list<long>, ids per document, its end id included
  n               their sum
  payload         binary: each document's codes, first bit first, from a whole byte on
  bytes           list<long>, payload bytes per document
  checkpoints     binary, little-endian uint32: for each document, for its 256th, 512th ... id, the
                  bit at which the code starts, counted from the document's first
A run of ids between checkpoints is a block that decodes on its own.
"""

from __future__ import annotations

import re
import uuid
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellumflow.llm.common import shared_dir, table, written

LONGEST = 18
BLOCK = 256
GROUP_BYTES = 1 << 20
CACHED = 600_000
# Letters, numbers and white space up to U+024F, as the byte-level pre-tokenizer's pattern has them.
LETTER, NUMBER, SPACE = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{SPACE}{LETTER}{NUMBER}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
BEYOND = re.compile("[ɐ-\U0010ffff]")


class Encoder:
    """The tokenizers library with a store of pieces: byte-level BPE treats each piece of the
    pre-tokenizer's pattern alone, so the ids of a piece seen before need not be worked out again. Texts
    with other than Latin characters, with added tokens or for other tokenizers take the plain way."""

    def __init__(self, definition: str) -> None:
        import json
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.plain = Tokenizer.from_str(definition)
        spec = json.loads(definition)
        before = spec.get("pre_tokenizer") or {}
        self.by_piece = not spec.get("normalizer") and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        self.added = [x["content"] for x in spec.get("added_tokens", ())]
        # The byte-level alphabet: printing characters stand for themselves, the other bytes for those from 256 up.
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = iter(range(256, 512))
        self.alphabet = {b: b if b in own else next(other) for b in range(256)}
        self.kind = np.dtype("<u2") if self.plain.get_vocab_size() <= 1 << 16 else np.dtype("<u4")

        class Store(dict):
            def __missing__(store, piece: str) -> bytes:
                if len(store) >= CACHED:
                    store.clear()
                store[piece] = found = self.piece_ids(piece)
                return found

        self.store = Store()

    def _plain(self, text: str) -> bytes:
        return np.array(self.plain.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def piece_ids(self, piece: str) -> bytes:
        symbols = piece.encode().decode("latin-1").translate(self.alphabet)
        return np.array([t.id for t in self.plain.model.tokenize(symbols)], self.kind).tobytes()

    def pieces(self, text: str) -> list[str] | None:
        """The text's pieces, or None if it must be encoded whole."""
        if not self.by_piece or BEYOND.search(text) or any(x in text for x in self.added):
            return None
        return PIECE.findall(text)

    def ids(self, text: str) -> np.ndarray:
        pieces = self.pieces(text)
        return np.frombuffer(self._plain(text) if pieces is None else b"".join(map(self.store.__getitem__, pieces)), self.kind)


def encoder_of(definition: str) -> Encoder:
    """The worker's encoder for a definition. It hangs on the library's module, which outlives a task, so
    that a worker loads the vocabulary and meets a piece once and not again with every task."""
    import tokenizers

    held = vars(tokenizers).setdefault("_vellumflow_encoders", {})
    key = crc32(definition.encode()), len(definition)
    if key not in held:
        held.clear()
        held[key] = Encoder(definition)
    return held[key]


def longest_code(used: int) -> int:
    """Bits that codes of so many ids may have: LONGEST, or as many as they need."""
    return max(LONGEST, (max(1, used) - 1).bit_length())


def code_lengths(counts: np.ndarray, longest: int | None = None) -> np.ndarray:
    """Lengths (0: unused) of an optimal prefix code with none above `longest`, or else above what
    longest_code() gives, by package-merge."""
    used = np.flatnonzero(counts)
    longest = longest or longest_code(len(used))
    out = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        out[used] = 1
        return out
    if len(used) > 1 << longest:
        raise ValueError(f"{len(used)} symbols need codes longer than {longest} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    levels, row = [], leaves
    for _ in range(longest):
        pairs = row[: len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        at = np.argsort(both, kind="stable")
        levels.append(at < len(leaves))
        row = both[at]
    lengths, take = np.zeros(len(leaves), np.int64), 2 * len(leaves) - 2
    # The last level merged leaves with the packages of `longest` - 1 levels: that is one level too many.
    for is_leaf in reversed(levels[: longest - 1]):
        n = int(is_leaf[:take].sum())
        lengths[:n] += 1
        take = 2 * (take - n)
    lengths[:take] += 1
    out[order] = lengths
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Code of each id, by length and then id."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    codes = np.zeros(len(lengths), np.uint64)
    if len(order):
        # Left-aligned, the codes are the running sum of the shares that the shorter codes take.
        longest = int(lengths.max())
        share = np.left_shift(1, longest - lengths[order].astype(np.int64))
        codes[order] = np.right_shift(share.cumsum() - share, longest - lengths[order].astype(np.int64))
    return codes


def encode(ids: np.ndarray, counts: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(payload, bytes per document, checkpoints) of documents with `counts` ids each."""
    size = lengths[ids].astype(np.int64)
    ends = size.cumsum()
    first = np.concatenate([[0], counts.cumsum()])
    bits = np.diff(np.concatenate([[0], ends])[first])
    width = -(-bits // 8)
    begin = np.concatenate([[0], width.cumsum()[:-1]]) * 8
    place = ends - size + np.repeat(begin - (np.concatenate([[0], ends])[first[:-1]]), counts)
    value = codes[ids] << (64 - (place & 31) - size).astype(np.uint64)
    word = place >> 5
    starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    out = np.zeros(int(width.sum()) // 4 + 3, np.uint64)
    out[word[starts]] += np.add.reduceat(value >> np.uint64(32), starts)
    out[word[starts] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), starts)
    within = np.arange(len(ids)) - np.repeat(first[:-1], counts)
    marked = np.flatnonzero((within % BLOCK == 0) & (within > 0))
    checkpoints = place[marked] - np.repeat(begin, counts)[marked]
    return out.astype(">u4").view(np.uint8)[: int(width.sum())], width, checkpoints.astype("<u4")


class Decoder:
    """Looks up as many bits as the longest code has: the id they begin with, and its length."""

    def __init__(self, lengths: np.ndarray) -> None:
        order = np.lexsort((np.arange(len(lengths)), lengths))
        order = order[lengths[order] > 0]
        self.longest = int(lengths.max(initial=1))
        if self.longest > 25:  # a code and its place in a byte fit 32 bits
            raise ValueError(f"codes of {self.longest} bits: more than 2**25 ids are in use")
        spans = np.left_shift(1, self.longest - lengths[order].astype(np.int64))
        self.symbol = np.zeros(1 << self.longest, np.uint32)
        self.length = np.ones(1 << self.longest, np.uint8)
        self.symbol[: spans.sum()] = np.repeat(order, spans)
        self.length[: spans.sum()] = np.repeat(lengths[order], spans)

    def decode(self, payload: np.ndarray, counts: np.ndarray, width: np.ndarray, checkpoints: np.ndarray) -> np.ndarray:
        """All ids; the blocks, which start at documents and checkpoints, are read side by side."""
        blocks = np.maximum(1, -(-counts // BLOCK))
        document = np.repeat(np.arange(len(counts)), blocks)
        within = np.arange(len(document)) - np.repeat(blocks.cumsum() - blocks, blocks)
        at = np.repeat((width.cumsum() - width) * 8, blocks)
        at[within > 0] += checkpoints
        left = np.minimum(BLOCK, counts[document] - within * BLOCK)
        data = np.concatenate([payload, np.zeros(8, np.uint8)]).astype(np.uint32)
        quads = data[:-3] << np.uint32(24) | data[1:-2] << np.uint32(16) | data[2:-1] << np.uint32(8) | data[3:]
        longest = np.argsort(-left, kind="stable")
        at, sizes = at[longest], left[longest]
        out = np.zeros((BLOCK, len(at)), np.uint32)
        for step in range(int(sizes[0]) if len(sizes) else 0):
            n = int(np.searchsorted(-sizes, -step, "left"))  # the blocks with more than `step` ids
            now = at[:n]
            bits = quads[now >> 3] >> (32 - self.longest - (now & 7)).astype(np.uint32) & np.uint32((1 << self.longest) - 1)
            out[step, :n] = self.symbol[bits]
            now += self.length[bits]
        rows = np.empty((len(at), BLOCK), np.uint32)
        rows[longest] = out.T
        return rows[np.arange(BLOCK) < left[:, None]]


def _groups(texts: list, limit: int):
    """Slices of a list of texts of about `limit` characters."""
    first = size = 0
    for i, x in enumerate(texts):
        size += len(x)
        if size >= limit or i == len(texts) - 1:
            yield texts[first : i + 1], first
            first, size = i + 1, 0


def _tokens(docs: DataFrame, definition, end_id: int) -> DataFrame:
    """Rows of documents side by side, in the order of their ids: part, seq, doc_ids, counts and all
    their ids as little-endian uint32 or, where the vocabulary allows, uint16."""

    def tokenize(batches):
        encoder = encoder_of(definition.value)
        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = [x or "" for x in batch.column("text").to_pylist()]
            doc_ids = batch.column("doc_id")
            for group, first in _groups(texts, GROUP_BYTES):
                end = np.array([end_id], encoder.kind)
                found = [np.concatenate([encoder.ids(x), end]) for x in group]
                row = [[part], [seq], [doc_ids.slice(first, len(group)).to_pylist()], [[len(x) for x in found]], [np.concatenate(found).tobytes()], [encoder.kind.itemsize]]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, TOKEN_TYPES)], TOKEN_NAMES)
                seq += 1

    # Rows of one id may be many: they are parted by their text, and equal rows by where they were read.
    keyed = docs.withColumns({"hash": F.xxhash64("text"), "read": F.monotonically_increasing_id()})
    ordered = keyed.repartitionByRange("doc_id", "hash", "read").sortWithinPartitions("doc_id", "hash", "text").select("doc_id", "text")
    return ordered.mapInArrow(tokenize, "part int, seq int, doc_ids array<long>, counts array<long>, ids binary, width int")


TOKEN_NAMES = ["part", "seq", "doc_ids", "counts", "ids", "width"]
TOKEN_TYPES = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.int32()]


def id_counts(tokens: DataFrame) -> np.ndarray:
    """How often each id occurs. One row per id and task is shuffled; the driver gets at most one row
    per id of the vocabulary."""

    def count(batches):
        totals = np.zeros(1, np.int64)
        for batch in batches:
            for blob, width in zip(batch.column("ids").to_pylist(), batch.column("width").to_pylist()):
                found = np.bincount(np.frombuffer(blob, f"<u{width}"))
                if len(found) > len(totals):
                    totals = np.concatenate([totals, np.zeros(len(found) - len(totals), np.int64)])
                totals[: len(found)] += found
        ids = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(totals[ids], pa.int64())], ["id", "times"])

    rows = tokens.select("ids", "width").mapInArrow(count, "id long, times long").groupBy("id").agg(F.sum("times").alias("times")).collect()
    counts = np.zeros(max([r["id"] for r in rows], default=0) + 1, np.int64)
    for r in rows:
        counts[r["id"]] = r["times"]
    return counts


def write_ids(docs: DataFrame, definition: str, end_id: int, folder: str) -> None:
    """Encode doc_id, text of docs with a tokenizer's definition, end_id after each document, and write
    the file set. Null texts are empty; documents of equal id follow each other by a hash of their text, null
    ids come first; a very long text is encoded whole, in a segment of its own; no documents give empty
    tables. Other columns, whatever their names, are not looked at. The ids are written to the shared
    folder before they are counted and encoded, so that every text is tokenized once."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tokens = written(_tokens(docs, spark.sparkContext.broadcast(definition), end_id), "tokens")
    lengths = code_lengths(id_counts(tokens))
    book = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(book, "id long, length int").coalesce(1).write.parquet(f"{folder}/codebook")
    coded = spark.sparkContext.broadcast((canonical(lengths), lengths))

    def pack(batches):
        codes, lengths = coded.value
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.array(row["counts"], np.int64)
                payload, width, marks = encode(np.frombuffer(row["ids"], f"<u{row['width']}").astype(np.int64), counts, codes, lengths)
                out = [[row["part"]], [row["seq"]], [row["doc_ids"]], [row["counts"]], [int(counts.sum())], [payload.tobytes()], [width.tolist()], [marks.tobytes()]]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, SEGMENT_TYPES)], SEGMENT_NAMES)

    tokens.mapInArrow(pack, SEGMENT_SCHEMA).write.option("compression", "uncompressed").parquet(f"{folder}/segments")


SEGMENT_SCHEMA = "part int, seq int, doc_ids array<long>, counts array<long>, n long, payload binary, bytes array<long>, checkpoints binary"
SEGMENT_NAMES = ["part", "seq", "doc_ids", "counts", "n", "payload", "bytes", "checkpoints"]
SEGMENT_TYPES = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary()]


def read_ids(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids binary of little-endian uint32) from a file set; start
    counts the ids of all documents before. The codebook, a row per id of the vocabulary, goes to all."""
    book = spark.read.schema("id long, length int").parquet(f"{folder}/codebook").collect()
    lengths = np.zeros(max([r["id"] for r in book], default=0) + 1, np.uint8)
    for r in book:
        lengths[r["id"]] = r["length"]
    shared = spark.sparkContext.broadcast(lengths)
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(f"{folder}/segments")
    # Sums of ids: within each part by segment, then over the parts, one row for each task that wrote.
    sums = segments.select("part", "seq", "n")
    within = sums.select("part", "seq", (F.sum("n").over(Window.partitionBy("part").orderBy("seq")) - F.col("n")).alias("within"))
    parts = sums.groupBy("part").agg(F.sum("n").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    placed = within.join(parts, "part").select("part", "seq", (F.col("within") + F.col("before")).alias("first"))

    def unpack(batches):
        decoder = Decoder(shared.value)
        for batch in batches:
            for row in batch.to_pylist():
                counts, width = np.array(row["counts"], np.int64), np.array(row["bytes"], np.int64)
                ids = decoder.decode(np.frombuffer(row["payload"], np.uint8), counts, width, np.frombuffer(row["checkpoints"], "<u4"))
                ids, ends = ids.astype("<u4"), counts.cumsum()
                blobs = [ids[a:b].tobytes() for a, b in zip((ends - counts).tolist(), ends.tolist())]
                place = [pa.array(np.full(len(counts), row[k]), pa.int32()) for k in ("part", "seq")]
                columns = [*place, pa.array(row["doc_ids"], pa.int64()), pa.array(ends - counts), pa.array(counts), pa.array([crc32(x) for x in blobs], pa.int64())]
                if with_ids:
                    columns.append(pa.array(blobs, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["part", "seq", "doc_id", "start", "n_tokens", "ids_crc32", "ids"][: 7 if with_ids else 6]
    schema = "part int, seq int, doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    # Decoded where they are read: what meets the sums are rows of documents, not payloads.
    found = segments.mapInArrow(unpack, schema).join(placed, ["part", "seq"])
    return found.withColumn("start", F.col("start") + F.col("first")).select(names[2:])


def op6_huffman_ids(spark, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Encode all documents, write the files and describe every document from what is read back."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    with open(tokenizer, encoding="utf-8") as f:
        definition = f.read()
    folder = f"{shared_dir(spark)}/token-ids-{uuid.uuid4().hex}"
    write_ids(table(spark, sf_dir, "documents"), definition, 2, folder)
    return read_ids(spark, folder, with_ids=False)
