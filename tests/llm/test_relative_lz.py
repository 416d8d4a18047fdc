"""Removed words against a plain version over all windows, factors against their definition, and the query as its SQL."""

import hashlib
import random
import re

import numpy as np
import pytest

from vellumflow.llm import op13_relative_lz as relative


def plain(rows, width=relative.WINDOW):
    """(doc_id, n_words, n_removed, kept_sha256) from every window of every document."""
    split = [re.findall(rf"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    ids = [-(2**63) if i is None else i for i, _ in rows]
    first: dict[tuple, int] = {}
    for i, w in zip(ids, split):
        for k in range(len(w) - width + 1):
            key = tuple(w[k : k + width])
            first[key] = min(first.get(key, i), i)
    out = []
    for (doc, _), i, w in zip(rows, ids, split):
        gone = {j for k in range(len(w) - width + 1) if first[tuple(w[k : k + width])] < i for j in range(k, k + width)}
        kept = [x for j, x in enumerate(w) if j not in gone]
        out.append((doc, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def found(docs, **more):
    return sorted((tuple(r) for r in relative.without_repeats(docs, **more).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)


def passages(seed, n=60):
    """Documents pieced together from few passages, so that windows begin and end anywhere in earlier ones."""
    draw = random.Random(seed)
    prose = lambda k: " ".join(draw.choice(["ab", "c", "dé", "efg", "h", "ij"]) for _ in range(k))
    pool = [prose(draw.randint(30, 200)) for _ in range(8)] + [" ".join(["same"] * 120), " ".join(["x y"] * 60)]
    rows = []
    for i in range(n):
        parts = [p if draw.random() < 0.5 else " ".join(p.split()[draw.randint(0, 40) :]) for p in draw.sample(pool, draw.randint(1, 4))]
        rows.append((draw.randint(0, 10_000), draw.choice([" ", "\n", " \t\x0b "]).join([prose(draw.randint(0, 20)), *parts])))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_as_plain(spark, make_docs, seed):
    rows = passages(seed)
    assert found(make_docs(rows)) == plain(rows)


def test_odd_texts(spark, make_docs, odd_texts):
    """Nulls, ties, repeated rows, very long texts and columns of clashing names."""
    assert found(make_docs(odd_texts)) == plain(odd_texts)
    assert found(make_docs(odd_texts).limit(0)) == []


def test_long_document_of_many_passages(spark, make_docs, monkeypatch):
    """Slices and blocks smaller than the texts lose no window at their borders."""
    monkeypatch.setattr(relative, "SLICE", 300)
    monkeypatch.setattr(relative, "SEGMENT", 64)
    rows = passages(9, 30)
    rows.append((20_000, " ".join(t for _, t in rows)))
    assert found(make_docs(rows)) == plain(rows)


def test_spans_and_kept(spark, make_docs):
    draw = random.Random(1)
    words = [str(draw.random()) for _ in range(90)]
    rows = [(1, " ".join(words)), (2, "a " + " ".join(words[:60]) + "\nb " + " ".join(words[20:69])), (3, " ".join(words[:49]))]
    out = {r["doc_id"]: r for r in relative.without_repeats(make_docs(rows)).collect()}
    assert (out[2]["low"], out[2]["high"]) == ([1], [61])
    assert out[2]["kept"].decode() == " ".join(["a", "b", *words[20:69]])  # 49 words are no window
    assert out[1]["n_removed"] == out[3]["n_removed"] == 0


@pytest.mark.parametrize("seed", range(5))
def test_factors_cover_every_window_of_the_block(seed):
    draw = random.Random(seed)
    source = [draw.choice("abc") + str(draw.randint(0, 2)) for _ in range(400)]
    copy = [w for k in draw.sample(range(300), 6) for w in source[k : k + draw.randint(40, 100)]]
    block = relative.Block(" ".join(source).encode() + relative.BLOCK_END)
    data = np.frombuffer(" ".join(copy).encode() + relative.TEXT_END, np.uint8)
    starts, ends, hashes, whole = relative.hashed(data, relative.WINDOW)
    places = np.full(len(starts), -1)
    places[: len(hashes)] = np.where(whole, block.look_up(hashes), -1)
    covered = {k for x, y in relative.factors(data, starts, ends, places, block) for k in range(x, y - relative.WINDOW + 1)}
    windows = {tuple(source[k : k + relative.WINDOW]) for k in range(len(source) - relative.WINDOW + 1)}
    assert covered == {k for k in range(len(copy) - relative.WINDOW + 1) if tuple(copy[k : k + relative.WINDOW]) in windows}


def test_query_as_its_sql(spark, tables, make_docs, odd_texts):
    duckdb = pytest.importorskip("duckdb")
    at = tables(documents=make_docs(passages(4) + odd_texts))
    told = duckdb.connect()
    told.sql(f"CREATE VIEW documents AS SELECT * FROM '{at}/documents.parquet/*.parquet'")
    rows = sorted(map(str, (tuple(r) for r in relative.op13_relative_lz_dedup(spark, at).collect())))
    assert rows == sorted(map(str, told.sql(relative.ORACLE).fetchall()))
