import corpus_pipeline
from pyspark.sql import functions as F
from small_corpus import corpus


def test_pipeline(spark, tables):
    rows, labels, bench = corpus()
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    at = tables(documents=spark.createDataFrame(rows, kind), labels=spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), benchmark=spark.createDataFrame(bench, "item_id long, text string"))
    out = corpus_pipeline.run(spark, at).cache()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "source_mixing", "hilbert_sharding"]
    assert out.count() > 50 and set(out.columns) == {"doc_id", "text", "lang", "source", "n_chars", "shard", "slot"}
    assert not out.where(F.col("text").contains("idiot") | F.col("text").contains(bench[0][1])).count()
    assert not out.where("doc_id between 1000 and 1099").count()  # copies of the first hundred
    assert out.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3
    sizes = [r["count"] for r in out.groupBy("shard").count().collect()]
    assert max(sizes) - min(sizes) <= 1


def test_empty(spark, tables):
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    at = tables(documents=spark.createDataFrame([], kind), labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"), benchmark=spark.createDataFrame([], "item_id long, text string"))
    assert corpus_pipeline.run(spark, at).count() == 0
