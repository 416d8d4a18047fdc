"""A training corpus in five stages: toxic documents go, near copies go, benchmark passages are cut
out, sources are mixed to their targets, and what is left is dealt into shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vellumflow.llm import op1_mixing, op2_toxicity, op4_fm_index, op7_hilbert, op9_golay
from vellumflow.llm.common import drop_written, table, tables_written, written

STAGES = [
    ("toxicity", op2_toxicity.stage),
    ("simhash_near_dedup", op9_golay.stage),
    ("benchmark_decontamination", op4_fm_index.stage),
    ("source_mixing", op1_mixing.stage),
    ("hilbert_sharding", op7_hilbert.stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that all stages keep, with shard and slot; each stage's result is written to the
    shared folder and read again. What a stage wrote besides, and the result before, are deleted then."""
    docs, first = table(spark, sf_dir, "documents"), tables_written()
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
        drop_written(spark, first, tables_written() - 1)
    return docs


#: Learnt scores and hashed fingerprints are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL = None
