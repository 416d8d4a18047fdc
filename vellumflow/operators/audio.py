"""Audio chunks: headers, resampling, ordered concatenation.

Samples are handled with NumPy in Arrow batches. A whole book's audio can pass the 2 GB that a row may
hold, so concat_to_files() streams each book to a file instead of returning it.
"""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RATE, BITS = 48_000, 32


def wav(pcm: bytes, rate: int, bits: int, channels: int = 1) -> bytes:
    """A RIFF file of linear samples."""
    frame = channels * bits // 8
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(pcm), b"WAVE", b"fmt ", 16, 1, channels, rate, rate * frame, frame, bits, b"data", len(pcm)) + pcm


def read_wav(data: bytes) -> tuple[int, int, int, bytes]:
    """(rate, bits, channels, samples); ValueError if it is no such file."""
    if data[:4] != b"RIFF" or data[8:12] != b"WAVE":
        raise ValueError("not a RIFF file")
    at, shape = 12, None
    while at + 8 <= len(data):
        name, size = struct.unpack_from("<4sI", data, at)
        if name == b"fmt ":
            _, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", data, at + 8)
            shape = rate, bits, channels
        elif name == b"data" and shape:
            return *shape, data[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no samples in the file")


def resample_one(data: bytes, rate: int = RATE) -> bytes:
    """A 16- or 32-bit file as 32-bit mono at `rate`, by linear interpolation."""
    old, bits, channels, pcm = read_wav(data)
    kind = {16: "<i2", 32: "<i4"}[bits]
    x = np.frombuffer(pcm, kind).reshape(-1, channels).mean(axis=1) * 2.0 ** (32 - bits)
    n = len(x) * rate // old
    y = np.interp(np.arange(n) * old / rate, np.arange(len(x)), x) if len(x) else x
    return wav(np.clip(np.rint(y), -(2**31), 2**31 - 1).astype("<i4").tobytes(), rate, 32)


def resample(audio: Column) -> Column:
    """struct(value, error): a file that cannot be read gives an error, not a failed task."""

    @F.pandas_udf("value binary, error string")
    def done(files: pd.Series) -> pd.DataFrame:
        rows = []
        for data in files:
            try:
                rows.append((resample_one(data), None))
            except Exception as e:
                rows.append((None, f"{type(e).__name__}: {e}"))
        return pd.DataFrame(rows, columns=["value", "error"])

    return done(audio)


def concat_audio(chunks: DataFrame) -> DataFrame:
    """(book, wav) of (book, chunk_no, wav): the samples by chunk number under one header."""

    def one(group: pd.DataFrame) -> pd.DataFrame:
        parts = [read_wav(w) for w in group.sort_values("chunk_no")["wav"]]
        return pd.DataFrame([(group["book"].iloc[0], wav(b"".join(p[3] for p in parts), *parts[0][:3]))], columns=["book", "wav"])

    return chunks.select("book", "chunk_no", "wav").groupBy("book").applyInPandas(one, "book string, wav binary")


def concat_to_files(chunks: DataFrame, folder: str) -> DataFrame:
    """As concat_audio, with (book, path, samples) of a file per book below a folder that all executors
    share; chunks pass one at a time, sorted within their partition."""

    def stream(batches):
        book = out = shape = None
        size = 0

        def close():
            head = wav(b"", *shape)[:-4]
            out.seek(0)
            out.write(head[:4] + struct.pack("<I", min(36 + size, 2**32 - 1)) + head[8:] + struct.pack("<I", min(size, 2**32 - 1)))
            out.close()
            return pd.DataFrame([(book, out.name, size)], columns=["book", "path", "bytes"])

        for batch in batches:
            for row in batch.itertuples():
                if row.book != book:
                    if out:
                        yield close()
                    book, size = row.book, 0
                    out = open(f"{folder}/{row.name}", "wb")
                rate, bits, channels, pcm = read_wav(row.wav)
                if not size:
                    shape = rate, bits, channels
                    out.write(wav(b"", *shape))
                out.write(pcm)
                size += len(pcm)
        if out:
            yield close()

    name = F.concat(F.sha2(F.col("book").cast("binary"), 256), F.lit(".wav")).alias("name")
    rows = chunks.select("book", "chunk_no", "wav", name).repartition("book").sortWithinPartitions("book", "chunk_no")
    return rows.mapInPandas(stream, "book string, path string, bytes long")
