import pyarrow as pa
from pyspark.sql import functions as F

from vellumflow.functions import names
from vellumflow.operators import assemble, chunking, pages


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_document_order(spark):
    bases = ["cover", "page_0010", "Page 3", "page-2", "subpage_7", "page_" + "9" * 20, "Appendix"]
    rows = spark.createDataFrame([("b", x) for x in bases], "book string, base string")
    found = [r["base"] for r in pages.in_order(rows).orderBy("doc_ord").collect()]
    assert found == ["page_" + "9" * 20, "page-2", "Page 3", "subpage_7", "page_0010", "Appendix", "cover"]
    assert {r["base"] for r in pages.in_order(rows, 2).collect()} == set(found[:2])


def test_pairs_and_last_wins(spark):
    images = spark.createDataFrame([("b", "p.jpg"), ("b", "p.png"), ("b", "q.png")], "book string, file_name string")
    texts = spark.createDataFrame([("b", "p.TXT"), ("b", "p.txt"), ("b", "r.txt")], "book string, file_name string")
    found = pages.page_pairs(pages.last_wins(texts).withColumnRenamed("file_name", "t"), pages.last_wins(images))
    assert values(found, "base", "t", "file_name") == [("p", "p.txt", "p.png")]
    assert pages.page_pairs(pages.last_wins(texts.limit(0)), pages.last_wins(images)).count() == 0


def test_pending_retries_empty_outputs(spark):
    work = spark.createDataFrame([("b", str(i)) for i in range(3)], "book string, base string")
    done = spark.createDataFrame([("b", "0", 5), ("b", "1", 0)], "book string, base string, length long")
    assert sorted(values(pages.pending(work, done, pages.KEYS), "base")) == [("1",), ("2",)]


def test_page_jobs_and_names(spark):
    books = spark.createDataFrame([("a", 2), ("none", 0), ("null", None)], "book string, pages int")
    assert values(pages.page_jobs(books), "book", "page_no", "file_name") == [("a", 1, "page_0001.png"), ("a", 2, "page_0002.png")]
    n = spark.createDataFrame([(12345,)], "n int").select(names.page_file(F.col("n")), names.chunk_file(F.lit(7))).first()
    assert tuple(n) == ("page_12345.png", "chunk_0007.wav")


def test_names(spark):
    def of(f, value):
        return spark.createDataFrame([(value,)], "x string").select(f(F.col("x"))).first()[0]

    assert [of(names.mime_type, x) for x in ("p.png", "p.jpg", "p.JPEG", "p.webp", "p.bin")] == ["image/png", "image/jpeg", "image/jpeg", "image/webp", "image/png"]
    assert of(names.book_name, "X.PDF") == "X" and of(lambda c: names.book_name(c, True), "X.PDF") == "X.PDF"
    assert of(names.page_count, "Title: a\nPages:    12\n") == 12 and of(names.page_count, "Pages: 0") is None and of(names.page_count, "Pages: x") is None
    verdicts = [spark.range(1).select(names.blank_verdict(F.lit(k)).alias("v")).first()["v"] for k in (0, 1, 2)]
    assert [(v["blank"], v["error"]) for v in verdicts] == [(True, None), (False, None), (None, "blank detector exit code 2")]


def test_concatenation(spark):
    rows = spark.createDataFrame([("b", "b.txt", "second"), ("b", "a.txt", "first"), ("b", "c.txt", ""), ("e", "x.txt", None)], "book string, file_name string, text string")
    assert dict(values(assemble.concat_terminated(rows), "book", "text")) == {"b": "first\n\nsecond\n\n\n\n", "e": "\n\n"}
    assert dict(values(assemble.concat_separated(rows, "file_name"), "book", "text")) == {"b": "first\n\nsecond", "e": ""}


def test_errors(spark):
    rows = spark.createDataFrame([("a", None), ("a", "x"), ("b", None)], "book string, error string")
    assert sorted(values(assemble.error_rollup(rows, "book"), "book", "n_rows", "n_errors", "any_error")) == [("a", 2, 1, True), ("b", 1, 0, False)]
    assert values(assemble.whole_groups(rows, "book"), "book") == [("b",)]


def test_pack_lines():
    pack = chunking.pack_lines
    assert pack("line1\n\nline2\nline3\n\nline4", 6) == ["line1", "line2", "line3", "line4"]
    assert pack("ab\ncd\nef", 5) == ["ab cd", "ef"] and pack("ab\ncd", 4) == ["ab", "cd"]
    assert pack("é" * 3 + "\nx", 8) == ["ééé x"] and pack("é" * 3 + "\nx", 7) == ["ééé", "x"]
    assert pack("x" * 70_000 + "\ny", 200) == ["x" * 70_000, "y"]
    assert pack(None, 5) == pack(" \n\t\n", 5) == []


def test_chunks_of_a_batch_a_few_books_at_a_time():
    batch = pa.RecordBatch.from_pydict({"book": [*range(300), None], "text": ["a\nb", None, "c" * 250 + "\nd"] * 100 + ["e"]})
    out = list(chunking.Chunks(chunking.TARGET)(iter([batch])))
    assert len(out) == -(-301 // chunking.BOOKS)
    rows = [tuple(r.values()) for b in out for r in b.to_pylist()]
    want = [(k, i + 1, c) for k, t in zip(batch.column("book").to_pylist(), batch.column("text").to_pylist()) for i, c in enumerate(chunking.pack_lines(t, chunking.TARGET))]
    assert rows == want
