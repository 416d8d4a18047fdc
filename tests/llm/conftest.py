import random

import pytest

FIELDS = "doc_id long, text string, lang string, source string, n_chars long, size long, shard string, slot int, mix int, score string, component_id int, fp string, text2 string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, source]) with columns whose names clash with results."""

    def make(rows):
        full = [(r[0], r[1], "en" if r[0] is None or r[0] % 2 else None, r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), 7, "x", 1, 2, "y", 3, "z", None) for r in rows]
        return spark.createDataFrame(full, FIELDS)

    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, empty and very long texts, ties and repeated rows."""
    draw = random.Random(4)
    words = ["alpha", "beta", "gamma", "delta", "Épsilon", "zeta", "eta", "theta"]
    prose = lambda n: " ".join(draw.choice(words) for _ in range(n))
    long, base = prose(60_000), prose(120)
    rows = [(0, None), (1, ""), (2, " \n"), (3, base), (4, base), (4, base), (None, base), (None, None), (5, base + " end"), (6, prose(80)), (7, long), (8, "x" * 30_000), (9, long[:5000]), (10, "one two")]
    return rows + [(20 + i, prose(draw.randint(1, 60))) for i in range(30)]


@pytest.fixture
def tables(spark, tmp_path):
    """Writes named tables to a folder laid out as the test tables are."""

    def write(**frames):
        for name, frame in frames.items():
            frame.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
