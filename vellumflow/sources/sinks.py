"""Sinks: tables partitioned by book, and plain files for other programs."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame


def write_pages(pages: DataFrame, path: str) -> None:
    """Overwrites the partitions of the books that pages holds, and no others."""
    pages.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("book").parquet(path)


def append_new(pages: DataFrame, path: str) -> None:
    """Write-once outputs: callers leave out what is done with operators.pages.pending."""
    pages.write.mode("append").partitionBy("book").parquet(path)


def export_files(rows: DataFrame, folder: str, value: str = "text") -> DataFrame:
    """Writes each row's value to folder/<book>/<file_name>; (path, length) of what was written. The
    folder must be one that all executors share; a file is replaced whole, so that a task run again does
    no harm."""
    import pandas as pd

    def write(batches):
        for batch in batches:
            done = []
            for row in batch.itertuples():
                target = Path(folder, row.book, row.file_name)
                target.parent.mkdir(parents=True, exist_ok=True)
                data = row.value.encode() if isinstance(row.value, str) else bytes(row.value or b"")
                part = target.with_name(f".{target.name}.{id(batch)}")
                part.write_bytes(data)
                part.replace(target)
                done.append((str(target), len(data)))
            yield pd.DataFrame(done, columns=["path", "length"])

    return rows.selectExpr("book", "file_name", f"`{value}` AS value").mapInPandas(write, "path string, length bigint")
