"""Greedy packing of lines into chunks of a bounded size."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from vellumflow.functions.text import WHITE_SPACE

TARGET = 200
BOOKS = 64  # of a batch whose chunks are held at a time


def pack_lines(text: str | None, target: int) -> list[str]:
    """Lines, trimmed and not blank, joined by spaces as long as a chunk and the next line with one byte
    more stay within `target` UTF-8 bytes; a longer line is a chunk of its own. Null has no chunks."""
    chunks: list[str] = []
    held: list[str] = []
    size = 0
    for line in (text or "").split("\n"):
        line = line.strip(WHITE_SPACE)
        if not line:
            continue
        more = len(line.encode())
        if held and size + more + 1 <= target:
            held.append(line)
            size += more + 1
        else:
            if held:
                chunks.append(" ".join(held))
            held, size = [line], more
    if held:
        chunks.append(" ".join(held))
    return chunks


def chunk_text(text: Column, target: int = TARGET) -> Column:
    """array<string> of a text's chunks. A scan with state over the lines: linear in Python, quadratic
    as an aggregate that copies its array."""

    @F.pandas_udf("array<string>")
    def packed(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: pack_lines(t, target))

    return packed(text)


class Chunks:
    """Chunks of a batch's books, a few books at a time."""

    def __init__(self, target: int) -> None:
        self.target = target

    def __call__(self, batches):
        for batch in (books.slice(at, BOOKS) for books in batches for at in range(0, books.num_rows, BOOKS)):
            packed = [pack_lines(t, self.target) for t in batch.column("text").to_pylist()]
            of = pa.array([i for i, p in enumerate(packed) for _ in p], pa.int32())
            numbers = pa.array([n for p in packed for n in range(1, len(p) + 1)], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("book").take(of), numbers, pa.array([c for p in packed for c in p], pa.string())], ["book", "chunk_no", "chunk"])


def chunks(narrations: DataFrame, target: int = TARGET) -> DataFrame:
    """(book, chunk_no from 1, chunk, content_hash) of book narrations."""
    found = StructType([narrations.schema["book"], StructField("chunk_no", IntegerType()), StructField("chunk", StringType())])
    rows = narrations.select("book", F.col("text").cast("string").alias("text")).mapInArrow(Chunks(target), found)
    return rows.select("book", "chunk_no", "chunk", F.sha2(F.col("chunk").cast("binary"), 256).alias("content_hash"))


def chunk_counts(narrations: DataFrame, target: int = TARGET) -> DataFrame:
    """(book, n_chunks) as planned, whether or not they are spoken; a book without lines has 0."""

    @F.pandas_udf("long")
    def counted(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: len(pack_lines(t, target))).astype("int64")

    return narrations.select("book", counted(F.col("text")).alias("n_chunks"))
