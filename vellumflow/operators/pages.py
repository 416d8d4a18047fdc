"""Pages of books: pairing, order, limits, pending work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellumflow.functions.names import base_name, document_order, page_file

KEYS = ["book", "base"]


def last_wins(files: DataFrame, *carried: str) -> DataFrame:
    """One row per (book, base): of files that share it, the one whose name is last in byte order."""
    kept = F.max_by(F.struct("file_name", *carried), F.col("file_name")).alias("f")
    return files.withColumn("base", base_name(F.col("file_name"))).groupBy(*KEYS).agg(kept).select(*KEYS, "f.*")


def page_pairs(texts: DataFrame, images: DataFrame) -> DataFrame:
    """Texts and images of one name in one book; pages with only one of them are dropped."""
    return texts.join(images, KEYS, "inner")


def books_with(books: DataFrame, found: DataFrame) -> DataFrame:
    """Books that have any of the found files."""
    return books.join(found, "book", "left_semi")


def pending(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Work without a finished output; an output without bytes is not finished."""
    return work.join(done.where(F.col("length") > 0), keys, "left_anti")


def in_order(pages: DataFrame, limit: int = 0) -> DataFrame:
    """pages with doc_ord, from 1 in each book in document order; only the first `limit`, if above 0."""
    ranked = pages.withColumn("doc_ord", F.row_number().over(Window.partitionBy("book").orderBy(*document_order(F.col("base")))))
    return ranked.where(F.col("doc_ord") <= limit) if limit > 0 else ranked


def page_jobs(books: DataFrame, pages: str = "pages") -> DataFrame:
    """A row per page of each book, from 1, with its file name; books without pages have none."""
    some = books.where(F.col(pages) >= 1)
    numbered = some.withColumn("page_no", F.explode(F.sequence(F.lit(1), F.col(pages).cast("int"))))
    return numbered.withColumn("file_name", page_file(F.col("page_no")))


def not_blank(pages: DataFrame, is_blank: Column) -> DataFrame:
    """Drops blank pages; a page whose check failed (null) stays."""
    return pages.where(~F.coalesce(is_blank, F.lit(False)))
