import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from vellumflow.llm import op4_fm_index as fm

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
fold = lambda t: WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def plain(docs, items):
    windows = {}
    for item, text in items:
        w = fold(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add("" if item is None else str(item))
    out = []
    for d, text in docs:
        w, hit, found = fold(text), set(), set()
        for k, owners in windows.items():
            for i in range(len(w) - len(k) + 1):
                if tuple(w[i : i + len(k)]) == k:
                    hit |= set(range(i, i + len(k)))
                    found |= owners
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def answer(found):
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return sorted([tuple(r) for r in found.select("doc_id", "n_words", "n_hit", F.size("items"), digest, F.col("n_hit") > 0).collect()], key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_as_word_by_word(spark, make_docs, odd_texts, seed, monkeypatch):
    draw = random.Random(seed)
    words = ["Alpha", "beta", "Γ", "x1", "don", "t", "über"]
    some = lambda n: draw.choice((" ", "-", ", ")).join(draw.choice(words) for _ in range(n))
    items = [(i, some(draw.choice((1, 3, 9, 10, 11, 25)) + 2)) for i in range(12)] + [(12, None), (13, ""), (14, "..."), (3, some(12)), (None, some(10))]
    docs = odd_texts[:7] + [(100 + i, " ".join(draw.choice((some(5), draw.choice(items)[1] or "")) for _ in range(8))) for i in range(25)]
    if seed == 2:  # several shards of documents and of a sequence
        monkeypatch.setattr(fm, "SHARD_BYTES", 300)
        monkeypatch.setattr(fm, "SHARD_WORDS", 40)
    if seed == 3:  # several blocks of the benchmark
        monkeypatch.setattr(fm, "PHRASE_BYTES", 100)
        monkeypatch.setattr(fm.phrase_blocks, "__defaults__", (100,))
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert answer(fm.contamination(make_docs(docs), bench)) == plain(docs, items)


def test_nothing_to_find(spark, make_docs, odd_texts):
    none = spark.createDataFrame([], "item_id long, text string")
    assert answer(fm.contamination(make_docs(odd_texts), none)) == plain(odd_texts, [])
    assert fm.contamination(make_docs(odd_texts).limit(0), none).count() == 0


def test_suffix_order_and_index():
    import numpy as np

    draw = np.random.default_rng(1)
    text = draw.integers(1, 5, 400)
    order = fm.suffix_order(np.append(text, 0))
    suffixes = [tuple(np.append(text, 0)[i:]) for i in order]
    assert suffixes == sorted(suffixes)
    index = fm.FMIndex(text)
    windows = draw.integers(1, 5, (30, 3))
    found = sorted(zip(*(x.tolist() for x in index.search(windows))))
    assert found == sorted((i, p) for i, w in enumerate(windows) for p in range(398) if (text[p : p + 3] == w).all())


def test_stage_cuts_spans(spark, make_docs, tables):
    leak = "the quick brown fox jumps over the lazy dog again"
    at = tables(benchmark=spark.createDataFrame([(1, leak)], "item_id long, text string"))
    docs = make_docs([(1, f"Before it, {leak.title()}! After."), (2, "Clean  text."), (3, leak), (4, None), (5, "")])
    kept = fm.stage(spark, docs, at)
    assert kept.columns == docs.columns
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in kept.collect()} == {1: ("Before it, ! After.", 19), 2: ("Clean  text.", 12), 4: (None, None), 5: ("", 0)}
