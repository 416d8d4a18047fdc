"""What the operators share: the shared scratch folder, written tables, Arrow helpers."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
_written: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, where that is unset on a
    single machine, a temporary one. On a cluster it must be set, or executors would not see each
    other's files."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="vellumflow-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def written(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet below the shared folder and read again. That cuts its lineage: a lost
    executor costs no recomputation of what was written."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def tables_written() -> int:
    """How many tables written() has made in this process and drop_written() has left."""
    return len(_written)


def drop_written(spark: SparkSession, first: int = 0, last: int | None = None) -> None:
    """Delete the tables that written() made in this process, from the `first` on and before the `last`;
    results read from them must be stored before."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in _written[first:last]:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)
        _written.remove(name)


def unused(df: DataFrame, name: str) -> str:
    """name, made longer until no column of df has it."""
    while name in df.columns:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words of a text: runs of anything but ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def is_held_out(doc_id: Column) -> Column:
    """Rows kept away from learning: crc32 of the id as text divisible by 5 (a null id is held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string or binary Arrow column as (bytes, offsets) without a copy of the text; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    ends = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2] if len(column) else None
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), ends.astype(np.int64)


def document_bytes(column: pa.Array) -> list[bytes]:
    """Each text of an Arrow string column as UTF-8 bytes; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def packed(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Rows values[offsets[i]:offsets[i+1]] of a numeric array as an Arrow binary column."""
    ends = (offsets * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))])


def with_scores(docs: DataFrame, score, name: str) -> DataFrame:
    """docs with a double column `name`, in place of any such, from score(list of text bytes) -> array."""
    docs = docs.drop(name)
    at = docs.columns.index("text")

    def answer(batches):
        for batch in batches:
            found = pa.array(score(document_bytes(batch.column(at))), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, name])

    from pyspark.sql.types import DoubleType, StructField, StructType

    return docs.mapInArrow(answer, StructType([*docs.schema.fields, StructField(name, DoubleType())]))
