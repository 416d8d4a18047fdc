from itertools import product
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from vellumflow.llm import op7_hilbert as hilbert


@pytest.mark.parametrize(("dims", "bits"), [(1, 4), (2, 3), (3, 2), (4, 2)])
def test_curve_walks_through_neighbours(spark, dims, bits):
    rows = spark.createDataFrame(list(product(range(1 << bits), repeat=dims)), ", ".join(f"c{i} int" for i in range(dims)))
    at = {r["i"]: r[:dims] for r in rows.withColumn("i", hilbert.curve_index([F.col(f"c{i}") for i in range(dims)], bits)).collect()}
    assert sorted(at) == list(range(1 << bits * dims))
    assert all(sum(abs(a - b) for a, b in zip(at[i], at[i + 1])) == 1 for i in range(len(at) - 1))


def shards_of(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["shard"], []).append(r["slot"])
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("per_bucket", [65_536, 4])
def test_shards(spark, make_docs, odd_texts, monkeypatch, per_bucket):
    monkeypatch.setattr(hilbert, "ROWS_PER_BUCKET", per_bucket)
    docs = make_docs([(d, t, f"src{i % 7}" if i % 5 else None) for i, (d, t) in enumerate(odd_texts)])
    out = hilbert.hilbert_shards(docs, 16)
    assert set(out.columns) == set(docs.columns) and out.count() == docs.count()
    found = shards_of(out)
    assert all(v == list(range(len(v))) for v in found.values()) and set(found) == set(range(16))
    assert max(map(len, found.values())) - min(map(len, found.values())) <= 1
    assert shards_of(hilbert.hilbert_shards(docs.limit(3), 16)).keys() <= set(range(16))
    assert hilbert.hilbert_shards(docs.limit(0), 16).count() == 0


def test_query_and_pruning(spark, make_docs, odd_texts, tables):
    rows = [(d, t, f"src{i % 4}") for i, (d, t) in enumerate(odd_texts * 8)]
    out = hilbert.op7_hilbert_sharding(spark, tables(documents=make_docs(rows)))
    want = sorted((d, len((t or "").encode()) + 1, crc32((t or "").encode())) for d, t, _ in rows if d is not None)
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in out.collect() if r["doc_id"] is not None) == want
    assert {r["law"] for r in out.collect()} == {"rows"}
    # Shards span less of each dimension than runs of a random order would.
    boxes = hilbert.hilbert_shards(make_docs(rows), 16).groupBy("shard").agg(F.count_distinct("source").alias("s"), F.count_distinct("lang").alias("l")).collect()
    assert sum(b["s"] for b in boxes) / 16 < 3


def test_no_python_on_executors(spark, make_docs, odd_texts):
    plan = hilbert.hilbert_shards(make_docs(odd_texts), 16)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def bounds_plainly(values, parts):
    """Least values that i / parts of the rows do not exceed."""
    values = sorted(values)
    return sorted({values[-(-i * len(values) // parts) - 1] for i in range(1, parts)} if values else set())


def index_plainly(cells, bits):
    """The curve's automaton, walked in plain Python."""
    digit, following = hilbert.curve_tables(len(cells))
    state = index = 0
    for level in range(bits - 1, -1, -1):
        corner = sum((c >> level & 1) << j for j, c in enumerate(cells))
        k = (state << len(cells)) + corner
        index, state = index << len(cells) | digit[k], following[k]
    return index


@pytest.mark.parametrize("per_range", [65_536, 3])
def test_placement_as_by_brute_force(spark, make_docs, odd_texts, monkeypatch, per_range):
    monkeypatch.setattr(hilbert, "VALUES_PER_RANGE", per_range)
    rows = [(i, t, [None, "https://site-a", "https://site-b", "https://site", "é", "https://site-a/b"][i % 6]) for i, (_, t) in enumerate(odd_texts * 2)]
    docs, bits = make_docs(rows), 3
    got = hilbert.hilbert_shards(docs, 5, bits=bits, narrow=per_range == 3).collect()
    columns = [[r[c] for r in got] for c in hilbert.DIMENSIONS]
    bounds = [bounds_plainly([v.encode() if isinstance(v, str) else v for v in c if v is not None], 1 << bits) for c in columns]
    cell = lambda r: [0 if r[c] is None else sum((r[c].encode() if isinstance(r[c], str) else r[c]) >= b for b in bound) for c, bound in zip(hilbert.DIMENSIONS, bounds)]
    curve = {r["doc_id"]: index_plainly(cell(r), bits) for r in got}
    order = sorted(got, key=lambda r: (curve[r["doc_id"]], r["doc_id"]))
    assert [(r["shard"], r["slot"]) for r in order] == [(p * 5 // len(got), p - -(-(p * 5 // len(got)) * len(got) // 5)) for p in range(len(got))]


def test_sources_with_a_common_lead_are_told_apart(spark):
    """Forty sources prune as well with long equal leads as without."""
    spans = []
    for lead in ("s", "https://www.example.org/site"):
        rows = [(i, f"{lead}{i % 40:02d}", "en", (i * 7919) % 1000) for i in range(4000)]
        out = hilbert.hilbert_shards(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long"), 16)
        spans.append(sorted(r["s"] for r in out.groupBy("shard").agg(F.count_distinct("source").alias("s")).collect()))
    assert spans[0] == spans[1] and sum(spans[0]) <= 14 * 16


def test_names_of_inner_columns_may_be_used(spark, make_docs, odd_texts):
    docs = make_docs(odd_texts).withColumnsRenamed({"score": "cell", "fp": "part", "mix": "place", "size": "c1"})
    out = hilbert.hilbert_shards(docs, 4)
    assert set(out.columns) == set(docs.columns) and out.count() == docs.count()
