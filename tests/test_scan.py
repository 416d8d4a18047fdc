"""Books packed over many tasks and blocks, against each book packed as one text."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vellumflow.operators import chunking, scan


def plain_leave(sizes, start, target):
    held, begun = start, 0
    for size in sizes:
        if held and held + size + 1 <= target:
            held += size + 1
        else:
            held, begun = min(size, target), begun + 1
    return held, begun


@pytest.mark.parametrize("seed", range(30))
def test_block_as_a_function(seed):
    draw = random.Random(seed)
    target = draw.choice([1, 2, 7, 30])
    sizes = [draw.choice([1, 1, 2, 3, draw.randint(1, 40)]) for _ in range(draw.randint(1, 40))]
    end, begun = scan.Packing(["x" * n for n in sizes], target).leave(np.arange(target + 1))
    assert list(zip(end.tolist(), begun.tolist())) == [plain_leave(sizes, s, target) for s in range(target + 1)]


def odd_pages():
    """A book of 400 pages, short, blank, null and of very long lines; books of a page; one without lines; a null book."""
    draw = random.Random(4)
    line = lambda: draw.choice(["", " ", "é" * draw.randint(1, 90), "w" * draw.randint(1, 30), "two words", "z" * 450])
    page = lambda: draw.choice([None, "", "\n", "a", *("\n".join(line() for _ in range(draw.randint(1, 12))) for _ in range(8))])
    rows = [("long", n, page()) for n in range(400)] + [(f"b{n}", 1, page()) for n in range(40)]
    return rows + [("none", n, " \n ") for n in range(3)] + [(None, n, "a\nb") for n in range(70)] + [("ties", 1, "y"), ("ties", 1, "x"), ("ties", None, "w"), ("ties", 1, "x")]


@pytest.mark.parametrize("parts,block_bytes", [(1, 1 << 20), (1, 1), (7, 300), (50, 1 << 20), (50, 40)])
def test_same_as_one_text(spark, parts, block_bytes):
    rows = odd_pages()
    books: dict = {}
    for book, n, text in sorted(rows, key=lambda r: (r[0] or "", n_first(r[1]), r[2] or "")):
        books.setdefault(book, []).append(text or "")
    want = {(b, i + 1, c) for b, texts in books.items() for i, c in enumerate(chunking.pack_lines("\n\n".join(texts), chunking.TARGET))}
    pages = spark.createDataFrame(rows, "book string, n int, text string").repartition(9)
    got = scan.chunks_of_pages(pages, [F.col("n")], parts=parts, block_bytes=block_bytes).select("book", "chunk_no", "chunk").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def n_first(n):
    return (n is not None, n or 0)


def test_numbered_books_and_no_pages(spark):
    pages = spark.createDataFrame([(7, 1, "a\n\nb", "extra")], "book long, n int, text string, chunk string")
    assert [tuple(r)[:3] for r in scan.chunks_of_pages(pages, [F.col("n")]).collect()] == [(7, 1, "a b")]
    assert scan.chunks_of_pages(pages.limit(0), [F.col("n")]).count() == 0


def test_rows_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scan, "shared_folder", lambda _: str(tmp_path / "blocks"))
    pages = spark.createDataFrame([("b", n, "some words of a line\n" * 50) for n in range(40)], "book string, n int, text string")
    scan.chunks_of_pages(pages, [F.col("n")], parts=5, block_bytes=500)
    stored = spark.read.parquet(str(tmp_path / "blocks"))
    assert stored.select(F.max(F.length(F.array_join("lines", " ")))).first()[0] < 600
    assert stored.where("block IS NULL").count() <= 10


def test_blocks_leave_a_batch_one_by_one():
    """A batch of many blocks gives as many small batches, pages of a large batch are strings a few at a time."""
    lines = [["some words of a line"] * 30] * 50
    batch = pa.RecordBatch.from_pydict({"part": [0] * 50, "block": list(range(50)), "book": ["b"] * 50, "lines": lines, "size": [0] * 50, "before": [0] * 50})
    out = list(scan.Pieces(chunking.TARGET, True)(iter([batch])))
    assert len(out) == 50 and sum(b.num_rows for b in out) == 50 * (len(chunking.pack_lines("\n".join(lines[0]), chunking.TARGET)) - 1)


def test_texts_are_changed_once_after_sorting(spark):
    pages = spark.createDataFrame([("b", n, None if n == 3 else f"a{n}") for n in range(9)], "book string, n int, text string")
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        seen.add(1)
        return text.upper()

    out = scan.chunks_of_pages(pages, [F.col("n")], parts=3, change=counted.asNondeterministic()).collect()
    assert [r["chunk"] for r in out] == ["A0 A1 A2 A4 A5 A6 A7 A8"] and seen.value == 8


def test_narrations_are_never_a_row(spark):
    """The query from pages to speech collects no book: its plan has no list of pages."""
    from vellumflow.plans import catalogue

    out = catalogue.narration_chunks(spark, "/root/testdata/sf0.001")
    assert out.schema["chunk_no"].dataType.simpleString() == "int"
    assert "posexplode" not in (plan := out._jdf.queryExecution().toString()) and "Window" not in plan
