"""Pages put together to books, and errors summed up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def concat_terminated(pages: DataFrame) -> DataFrame:
    """One text per book: its files in byte order of their names, each followed by an empty line."""
    ended = F.struct("file_name", F.concat(F.coalesce("text", F.lit("")), F.lit("\n\n")).alias("t"))
    return pages.groupBy("book").agg(F.array_join(F.transform(F.array_sort(F.collect_list(ended)), lambda p: p["t"]), "").alias("text"))


def concat_separated(pages: DataFrame, *order: str | Column) -> DataFrame:
    """One text per book: its pages by `order` with an empty line between them; empty and null texts
    take no part, and a book of such only has an empty text."""
    keys = [(F.col(c) if isinstance(c, str) else c).alias(f"k{i}") for i, c in enumerate(order)]
    some = F.when(F.coalesce(F.col("text"), F.lit("")) != "", F.struct(*keys, F.col("text").alias("t")))
    return pages.groupBy("book").agg(F.array_join(F.transform(F.array_sort(F.collect_list(some)), lambda p: p["t"]), "\n\n").alias("text"))


def error_rollup(results: DataFrame, *by: str) -> DataFrame:
    """Per group: rows, rows with an error, and whether there is any."""
    bad = F.col("error").isNotNull()
    return results.groupBy(*by).agg(F.count("*").alias("n_rows"), F.count_if(bad).alias("n_errors"), F.coalesce(F.bool_or(bad), F.lit(False)).alias("any_error"))


def whole_groups(results: DataFrame, *by: str) -> DataFrame:
    """Rows of the groups in which no row has an error."""
    return results.join(results.where(F.col("error").isNotNull()).select(*by).distinct(), list(by), "left_anti")
