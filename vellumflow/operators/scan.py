"""Packing of lines into chunks for books of any size, which are never put into one row or task.

What packing needs to know of the lines before is the size of the chunk that is being filled: 0 for none, at
most `target`, since above it no line fits. Lines of pages in order are cut into blocks, and a block is a
function from the size it is entered with to the size it is left with and the number of chunks it begins.
Sorted pages lie in the tasks of one range partitioning. A task composes the functions of its blocks: for its
first book, which may have begun in an earlier task, for all sizes that there are, for the others, which
begin in it, for size 0 only. The functions of whole tasks, two rows each at the most, are applied one after
the other; then each block is packed by itself, and only chunks that cross an edge of a block are put together
from pieces.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from vellumflow.functions.text import WHITE_SPACE
from vellumflow.operators.chunking import TARGET
from vellumflow.sources.files import shared_folder

BLOCK_BYTES = 1 << 20
BATCH_ROWS = 4096
PAGES = 64  # of a batch that are strings at a time
BATCH_BYTES = 4 << 20


class Packing:
    """Greedy packing of a block's lines."""

    def __init__(self, lines: list[str], target: int) -> None:
        self.target, self.n = target, len(lines)
        self.upto = np.cumsum([0, *(len(line.encode()) + 1 for line in lines)])
        fits = np.searchsorted(self.upto[1:], self.upto[:-1] + target + 1, "right")
        self.following = np.maximum(fits, np.arange(1, self.n + 1)).tolist()

    def fitting(self, size: np.ndarray) -> np.ndarray:
        """How many of the first lines go to the chunk of that size which is open at the start."""
        return np.where(size > 0, np.searchsorted(self.upto[1:], self.target - size, "right"), 0)

    def leave(self, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(size of the chunk open at the end, chunks begun) for each size at the start."""
        first = self.fitting(size)
        known: dict[int, tuple[int, int]] = {}
        for at in np.unique(first).tolist():
            path = []
            while at < self.n and at not in known:
                path.append(at)
                at = self.following[at]
            end, begun = known[at] if at < self.n else (min(int(self.upto[-1] - self.upto[path[-1]]) - 1, self.target) if path else 0, 0)
            for at in reversed(path):
                begun += 1
                known[at] = end, begun
        found = np.array([known.get(at, (0, 0)) for at in first.tolist()], np.int64).reshape(-1, 2)
        return np.where(first == self.n, size + self.upto[-1], found[:, 0]), found[:, 1]


def _schema(book) -> StructType:
    return StructType([StructField("part", IntegerType()), StructField("nth", IntegerType()), StructField("block", IntegerType()), StructField("book", book), StructField("lines", ArrayType(StringType())), StructField("sizes", ArrayType(IntegerType())), StructField("begun", ArrayType(LongType()))])


class Blocks:
    """A task's blocks, and rows without lines that stand for its first and its last book as a whole."""

    def __init__(self, target: int, block_bytes: int) -> None:
        self.target, self.block_bytes = target, block_bytes

    def _pages(self, batch):
        for at in range(0, batch.num_rows, PAGES):
            few = batch.slice(at, PAGES)
            yield from zip(few.column("book").to_pylist(), few.column("text").to_pylist())

    def __call__(self, batches):
        part, rows, held = TaskContext.get().partitionId(), [], 0
        types = [pa.int32(), pa.int32(), pa.int32(), None, pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int64())]
        names = ["part", "nth", "block", "book", "lines", "sizes", "begun"]
        table = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
        nth, block, book, lines, size = -1, 0, None, [], 0
        sizes = begun = np.zeros(0, np.int64)

        def close() -> None:
            """The lines held become a block."""
            nonlocal block, lines, size, sizes, begun, held
            if lines:
                rows.append((part, nth, block, book, lines, sizes.tolist(), begun.tolist()))
                sizes, more = Packing(lines, self.target).leave(sizes)
                begun, block, held = begun + more, block + 1, held + size
                lines, size = [], 0

        for batch in batches:
            types[3] = batch.schema.field("book").type
            for name, text in self._pages(batch):
                if nth < 0 or name != book:
                    close()
                    if nth == 0:
                        rows.append((part, nth, None, book, None, sizes.tolist(), begun.tolist()))
                    nth, block, book = nth + 1, 0, name
                    sizes = np.arange(self.target + 1) if nth == 0 else np.zeros(1, np.int64)
                    begun = np.zeros(len(sizes), np.int64)
                for line in text.split("\n"):
                    if line := line.strip(WHITE_SPACE):
                        lines.append(line)
                        size += len(line.encode()) + 1
                        if size >= self.block_bytes:
                            close()
                if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
                    yield table()
                    rows, held = [], 0
        close()
        if nth >= 0:
            rows.append((part, nth, None, book, None, sizes.tolist(), begun.tolist()))
            yield table()


class Pieces:
    """Chunks of blocks: those that lie within one (whole), or the pieces of the others. A block is taken
    out of its batch and given on by itself: a batch may hold 64 MB, which is many times that as strings."""

    def __init__(self, target: int, whole: bool) -> None:
        self.target, self.whole = target, whole

    def __call__(self, batches):
        for batch in (blocks.slice(at, 1) for blocks in batches for at in range(blocks.num_rows)):
            out: list[tuple] = []
            columns = (batch.column(c).to_pylist() for c in ("part", "block", "book", "lines", "size", "before"))
            for part, block, book, lines, size, number in zip(*columns):
                packing = Packing(lines, self.target)
                at = int(packing.fitting(np.array([size]))[0])
                if at and not self.whole:
                    out.append((book, number, part, block, " ".join(lines[:at])))
                while at < packing.n:
                    number, to = number + 1, packing.following[at]
                    if self.whole == (to < packing.n):
                        out.append((book, number, part, block, " ".join(lines[at:to])))
                    at = to
            types = [batch.schema.field("book").type, pa.int64(), pa.int32(), pa.int32(), pa.string()]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["book", "chunk_no", "part", "block", "chunk"])


def _entered(ends: DataFrame) -> DataFrame:
    """(part, nth, entry, earlier): the size with which each task's first book is entered there, and its
    chunks begun before. Not more rows than tasks: a book's tasks are one row of an array."""
    came = F.struct(F.lit(0).alias("size"), F.lit(0).cast("long").alias("begun"), F.array().cast("array<struct<part:int,nth:int,entry:int,earlier:bigint>>").alias("seen"))

    def step(a: Column, x: Column) -> Column:
        at = F.when(F.size(x["sizes"]) == 1, 0).otherwise(a["size"])
        here = F.struct(x["part"].alias("part"), x["nth"].alias("nth"), a["size"].alias("entry"), a["begun"].alias("earlier"))
        return F.struct(F.get(x["sizes"], at).alias("size"), (a["begun"] + F.get(x["begun"], at)).alias("begun"), F.concat(a["seen"], F.array(here)).alias("seen"))

    in_turn = F.array_sort(F.collect_list(F.struct("part", "nth", "sizes", "begun")))
    folded = ends.groupBy("book").agg(F.aggregate(in_turn, came, step)["seen"].alias("seen"))
    return folded.select(F.inline("seen")).where("nth = 0")


def chunks_of_pages(pages: DataFrame, order: list[Column], target: int = TARGET, parts: int = 0, block_bytes: int = BLOCK_BYTES, change: Callable[[Column], Column] = lambda text: text) -> DataFrame:
    """(book, chunk_no from 1, chunk, content_hash) of pages (book, text, ...) in `order` in each book, ties by
    text: the same as chunking.chunks() of the pages joined with empty lines. A row holds at most block_bytes
    and a line. Null and blank texts have no lines, books of such no chunks; rows of a null book are a book.

    The blocks are written to the shared folder once, so that what is counted and what is packed are the same
    whatever executors are lost. parts: tasks to sort in, by default as many as shuffles have. change: what
    is done to texts, null only for null ones; it is worked out once, in the sorted tasks, while that of a column
    of pages would be for the sample of the keys, too."""
    spark, at = pages.sparkSession, shared_folder(pages.sparkSession)
    named = pages.where(F.col("text").isNotNull()).select("book", "text", *(c.alias(f"_k{i}") for i, c in enumerate(order)))
    keys = ["book", *(f"_k{i}" for i in range(len(order)))]
    dealt = named.repartitionByRange(*([parts] if parts else []), *keys).sortWithinPartitions(*keys, "text").select("book", change(F.col("text")).alias("text"))
    schema = _schema(pages.schema["book"].dataType)
    dealt.mapInArrow(Blocks(target, block_bytes), schema).write.option("compression", "zstd").parquet(at)
    stored = spark.read.schema(schema).parquet(at)
    # As many rows as tasks at the most, of four numbers each.
    entered = F.broadcast(_entered(stored.where("block IS NULL")))
    blocks = stored.where("block IS NOT NULL").join(entered, ["part", "nth"], "left")
    own = F.coalesce("entry", F.lit(0))
    blocks = blocks.select("part", "block", "book", "lines", F.get("sizes", own).alias("size"), (F.get("begun", own) + F.coalesce("earlier", F.lit(0))).alias("before"))
    found = StructType([pages.schema["book"], StructField("chunk_no", LongType()), StructField("part", IntegerType()), StructField("block", IntegerType()), StructField("chunk", StringType())])
    whole = blocks.mapInArrow(Pieces(target, True), found).select("book", "chunk_no", "chunk")
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("part", "block", "chunk"))), lambda p: p["chunk"])
    crossing = blocks.mapInArrow(Pieces(target, False), found).groupBy("book", "chunk_no").agg(F.array_join(pieces, " ").alias("chunk"))
    return whole.union(crossing).withColumn("content_hash", F.sha2(F.col("chunk").cast("binary"), 256))
