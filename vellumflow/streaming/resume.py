"""Work that goes on where it stopped: a file stream with a checkpoint reads each file once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def process_new(spark: SparkSession, source: str, schema: str, transform: Callable[[DataFrame], DataFrame], target: str, checkpoint: str) -> DataFrame:
    """Runs transform over the files of source that no earlier run with this checkpoint has seen, adds
    the result to target and returns all of target. A run that breaks off is taken up again; the file
    sink's log keeps each file's rows from counting twice. source is a folder or a single file: written
    as a pattern, its last character in brackets, either will do."""
    stream = transform(spark.readStream.schema(schema).parquet(f"{source[:-1]}[{source[-1]}]"))
    query = stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(target)
