"""File-tree sources.

Spark's file sources drop empty files and names that begin with _ or ., and read [, { and * in paths as
patterns. Listing therefore goes through the Hadoop file system on the driver, names only; contents are
read by executors and joined on, so that an empty file has an empty text.
"""

from __future__ import annotations

import tempfile
import uuid
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumflow.functions.names import base_name, book_name

LISTING = "path string, file_name string, length bigint"
IMAGE_SUFFIXES = (".png", ".jpg", ".jpeg")


def list_files(spark: SparkSession, folder: str, suffixes: tuple[str, ...], recursive: bool = False) -> DataFrame:
    """(path, file_name, length) of the files below folder with one of the suffixes, in any case, in
    byte order of their paths; folders never count. A missing folder raises FileNotFoundError."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(folder)
    system = root.getFileSystem(conf)
    if not system.exists(root) or not system.getFileStatus(root).isDirectory():
        raise FileNotFoundError(folder)
    found, todo = [], [root]
    while todo:
        for status in system.listStatus(todo.pop()):
            path = status.getPath()
            if status.isDirectory():
                todo += [path] if recursive else []
            elif path.getName().lower().endswith(suffixes):
                found.append((path.toUri().getPath(), path.getName(), status.getLen()))
    found.sort(key=lambda f: f[0].encode())
    return spark.createDataFrame(found, LISTING)


def pdfs(spark: SparkSession, folder: str, recursive: bool = False, strict_suffix: bool = False) -> DataFrame:
    """(book, pdf_path) of the documents in a folder."""
    files = list_files(spark, folder, (".pdf",), recursive)
    return files.select(book_name(F.col("file_name"), strict_suffix).alias("book"), F.col("path").alias("pdf_path"))


def _literal(path: str) -> str:
    return "".join(f"\\{c}" if c in "[]{}*?\\" else c for c in path)


HIDDEN_BYTES = 64 << 20


def shared_folder(spark: SparkSession) -> str:
    """A new folder's path where driver and executors both see it: below spark.checkpoint.dir, or, where
    that is unset on a single machine, below a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="vellumflow-")
    return f"{found}/{uuid.uuid4().hex}"


def _hidden(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Contents of files whose names Spark's readers pass over, read on the driver. Beyond HIDDEN_BYTES they
    are put into a table of the shared folder, about as many bytes at a time, so that few are held."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    named, kind = files.where(F.col("file_name").rlike("^[_.]") & (F.col("length") > 0)).select("path", "length"), "path string, content binary"
    read, size, table = [], 0, None
    for r in named.toLocalIterator():
        path = jvm.org.apache.hadoop.fs.Path(r["path"])
        stream = path.getFileSystem(conf).open(path)
        try:
            read.append((r["path"], bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream))))
        finally:
            stream.close()
        size += r["length"]
        if size >= HIDDEN_BYTES:
            table = table or shared_folder(spark)
            spark.createDataFrame(read, kind).write.mode("append").parquet(table)
            read, size = [], 0
    rest = spark.createDataFrame(read, kind)
    return rest if table is None else rest.union(spark.read.schema(kind).parquet(table))


def contents(spark: SparkSession, files: DataFrame) -> DataFrame:
    """files with `content`: the bytes of each; empty files, which the source skips, have none."""
    folders = [r[0] for r in files.select(F.regexp_extract("path", "(.*)/[^/]*\\z", 1)).distinct().collect()]
    if not folders:
        return files.withColumn("content", F.lit(None).cast("binary"))
    read = spark.read.format("binaryFile").load([_literal(f) for f in folders]).select(F.regexp_replace("path", "^[a-z]+:(//[^/]*)?(?=/)", "").alias("path"), "content")
    return files.join(read.union(_hidden(spark, files)), "path", "left").withColumn("content", F.coalesce("content", F.lit(b"")))


def decoded(content: Column) -> Column:
    """UTF-8 text; bytes that are none become the replacement character."""
    return F.make_valid_utf8(content.cast("string"))


def texts(spark: SparkSession, folder: str, book: str) -> DataFrame:
    """(book, base, file_name, path, text) of a folder's text files."""
    rows = contents(spark, list_files(spark, folder, (".txt",)))
    return rows.select(F.lit(book).alias("book"), base_name(F.col("file_name")).alias("base"), "file_name", "path", decoded(F.col("content")).alias("text"))


def images(spark: SparkSession, folder: str, book: str, suffixes: tuple[str, ...] = IMAGE_SUFFIXES) -> DataFrame:
    """(book, base, file_name, path, length) of a folder's images; contents() adds their bytes."""
    rows = list_files(spark, folder, suffixes)
    return rows.select(F.lit(book).alias("book"), base_name(F.col("file_name")).alias("base"), "file_name", "path", "length")


def wavs(spark: SparkSession, folder: str, book: str) -> DataFrame:
    """(book, chunk_no, file_name, path, length) of a folder's audio, numbered in byte order of names."""
    rows = list_files(spark, folder, (".wav",)).withColumn("book", F.lit(book))
    from pyspark.sql import Window

    return rows.select("book", F.row_number().over(Window.partitionBy("book").orderBy("file_name")).alias("chunk_no"), "file_name", "path", "length")


def book_dirs(pdf_files: DataFrame, output_dir: str, book_dir: str | None = None) -> DataFrame:
    """(book, dir): the given folder alone, or output_dir/<book> of every document."""
    if book_dir:
        at = PurePosixPath(book_dir)
        return pdf_files.sparkSession.createDataFrame([(at.name, str(at))], "book string, dir string")
    name = base_name(F.regexp_extract("pdf_path", "([^/]*)\\z", 1))
    return pdf_files.select(name.alias("book"), F.concat_ws("/", F.lit(output_dir), name).alias("dir"))


def count_files(spark: SparkSession, folder: str, suffix: str) -> int:
    return list_files(spark, folder, (suffix,)).count()


def ensure_dir(spark: SparkSession, folder: str) -> None:
    """NotADirectoryError unless the folder is there."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(conf)
    if not system.exists(path) or not system.getFileStatus(path).isDirectory():
        raise NotADirectoryError(folder)
