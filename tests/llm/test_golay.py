import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from vellumflow.llm import components as parts
from vellumflow.llm import op9_golay as golay


def plain_print(text, width=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    counts = Counter(b for s in shingles for b in range(64) if xxh64_intdigest(s, 42) >> b & 1)
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def smallest(n, pairs):
    least = list(range(n))

    def find(a):
        while least[a] != a:
            a = least[a]
        return a

    for a, b in pairs:
        a, b = find(a), find(b)
        least[max(a, b)] = min(a, b)
    return [find(a) for a in range(n)]


def test_perfect_code():
    words = np.arange(1 << 23)
    remainder, _ = golay.golay_tables()
    index = golay.codeword_index(words)
    codeword = index << 11 | remainder[index]
    assert np.bitwise_count((words ^ codeword).astype(np.uint64)).max() == 3


def test_near_fingerprints_share_a_key():
    draw = np.random.default_rng(0)
    x = draw.integers(-(2**63), 2**63 - 1, 3000, dtype=np.int64)
    y = x.view(np.uint64).copy()
    for i in range(len(y)):
        for bit in draw.choice(64, draw.integers(0, 5), replace=False):
            y[i] ^= np.uint64(1) << np.uint64(bit)
    keys = [set(zip(*(v.tolist() for v in golay.keys_of(z)))) for z in (x, y.view(np.int64))]
    assert len({r for r, _ in keys[0] & keys[1]}) == len(x)


def test_spanning_forest():
    draw = np.random.default_rng(1)
    for n in (2, 10, 200):
        a, b = draw.integers(0, n, (2, n))
        labels = np.arange(n)
        used = parts.spanning(labels, a, b)
        assert (labels == smallest(n, zip(a, b))).all() and len(used) == n - len(set(labels.tolist()))


def test_components(spark):
    draw = random.Random(3)
    links = [(i, i + 1) for i in range(60)] + [(100, 200 + i) for i in range(80)] + [(draw.randrange(500, 900), draw.randrange(500, 900)) for _ in range(250)] + [(5, 5), (None, 3), (-4, 999)]
    out = {r["node"]: r["component"] for r in parts.components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = sorted({x for a, b in links if None not in (a, b) and a != b for x in (a, b)})
    at = {x: i for i, x in enumerate(nodes)}
    want = smallest(len(nodes), [(at[a], at[b]) for a, b in links if a in at and b in at])
    assert out == {x: nodes[want[i]] for x, i in at.items()}
    assert parts.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("small", [32, 2])
def test_as_pair_by_pair(spark, make_docs, odd_texts, tables, small, monkeypatch):
    monkeypatch.setattr(golay, "SMALL", small)
    if small == 2:  # texts in slices, and nearly all runs of keys dealt out in blocks
        monkeypatch.setattr(golay, "SLICE", 50)
        monkeypatch.setattr(golay, "RUN", 10)
        monkeypatch.setattr(golay, "SAMPLED", 1)
    draw = random.Random(5)
    base = [f"w{draw.randrange(50)}" for _ in range(900)]
    near = []
    for i in range(40):
        words = list(base)
        for _ in range(draw.randint(0, 6)):
            words[draw.randrange(len(words))] = "edited"
        near.append((300 + i, " ".join(words)))
    rows = [(d, None if t is None else t[:9000]) for d, t in odd_texts] + near
    prints = [plain_print(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= 4]
    labels = smallest(len(rows), pairs)
    least = {c: min((d for (d, _), x in zip(rows, labels) if x == c and d is not None), default=None) for c in set(labels)}
    out = golay.op9_golay_simhash(spark, tables(documents=make_docs(rows))).collect()
    assert sorted(map(str, map(tuple, out))) == sorted(str((d, f"{p:016x}", least[c])) for (d, _), p, c in zip(rows, prints, labels))
    assert golay.near_duplicates(make_docs(rows).limit(0)).count() == 0


def test_stage_keeps_one_of_each_group(spark, make_docs, odd_texts):
    draw = random.Random(6)
    word = lambda: "".join(draw.choice("aeinrst") for _ in range(5))
    originals = [(1000 + 10 * i, [word() for _ in range(400)]) for i in range(20)]
    rows = [(d, " ".join(w)) for d, w in originals]
    rows += [(d + 1, " ".join(w).upper()) for d, w in originals] + [(d + 2, " ".join([*w[:200], "other", *w[201:]])) for d, w in originals]
    rows += [(d + 3, " ".join([*w[:200], *(word() for _ in range(200))])) for d, w in originals]
    kept = golay.stage(spark, make_docs(rows), "")
    ids = {r["doc_id"] for r in kept.collect()}
    assert kept.columns == make_docs(rows).columns and ids == {d + k for d, _ in originals for k in (0, 3)}
    odd = golay.stage(spark, make_docs(odd_texts), "")
    found = Counter(" ".join((r["text"] or "").lower().split()) for r in odd.collect())
    assert max(found.values()) == 1 and {r["doc_id"] for r in odd.collect()} >= {0, 3, 6, 7, 8, 10}
    assert golay.stage(spark, make_docs([]), "").count() == 0


def shingle_sets(texts):
    words = [t.lower().split() for t in texts]
    return [{tuple(w[i : i + golay.WIDTH]) for i in range(max(1, len(w) - golay.WIDTH + 1))} for w in words]


def least_by_all_pairs(rows):
    sets = shingle_sets([t for _, t in rows])
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if len(sets[i] & sets[j]) >= golay.SIMILARITY * len(sets[i] | sets[j])]
    labels = smallest(len(rows), pairs)
    return {min(d for (d, _), x in zip(rows, labels) if x == c) for c in set(labels)}


def families(draw, each, copies, changed, own, words=300):
    """Texts of one template: families that are apart, in each some true copies."""
    word = lambda: "".join(draw.choice("aeinrst") for _ in range(6))
    texts, base = [], [word() for _ in range(words)]
    for _ in range(each):
        family = list(base)
        for at in draw.sample(range(words), changed):
            family[at] = word()
        for _ in range(copies):
            text = list(family)
            for at in draw.sample(range(words), own):
                text[at] = word()
            texts.append(" ".join(text))
    draw.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("block", [8 << 20, 20_000])
def test_stage_compares_across_families(spark, make_docs, block, monkeypatch):
    monkeypatch.setattr(golay, "BLOCK", block)
    monkeypatch.setattr(golay, "PIVOTS", 3)
    if block < 1 << 20:
        monkeypatch.setattr(golay, "RUN", 40)
        monkeypatch.setattr(golay, "SAMPLED", 1)
    rows = families(random.Random(8), 150, 2, 2, 3)
    assert {r["doc_id"] for r in golay.stage(spark, make_docs(rows), "").collect()} == least_by_all_pairs(rows)


def test_stage_uses_keys_of_all_equal_fingerprints(spark, make_docs, monkeypatch):
    draw = random.Random(9)
    words = [[f"w{draw.randrange(10**6)}" for _ in range(300)] for _ in range(2)]
    rows = [(d, " ".join([*words[d // 2][:-1], f"end{d}"])) for d in range(4)]
    described = golay._described

    def same_last(docs):
        # 0 and 2 have equal last words; their keys lead to 1 and to 3.
        last = F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).cast("long")
        keys = F.array(F.when(F.col("id") < 2, 0).otherwise(1).cast("int"))
        return described(docs).withColumns({"fp": last, "fp2": F.lit(0).cast("long"), "keys": keys})

    monkeypatch.setattr(golay, "_described", same_last)
    assert {r["doc_id"] for r in golay.stage(spark, make_docs(rows), "").collect()} == {0, 2}


def test_stage_finds_single_pairs_at_the_threshold(spark, make_docs):
    draw = random.Random(10)
    rows = []
    for i in range(200):
        words = [f"w{draw.randrange(10**6)}" for _ in range(300)]
        other = list(words)
        for at in range(20, 300, 48):
            other[at] = "other"
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
    sets = shingle_sets([t for _, t in rows])
    assert all(0.8 <= len(a & b) / len(a | b) < 0.83 for a, b in zip(sets[::2], sets[1::2]))
    assert {r["doc_id"] for r in golay.stage(spark, make_docs(rows), "").collect()} == {2 * i for i in range(200)}


def margin_keys_plainly(margins):
    """The keys of one row by trying all pairs of flips in order of their cost."""
    out = set()
    for f in range(golay.KEYED):
        found = []
        for s in range(2):
            part = margins[46 * f + 23 * s : 46 * f + 23 * s + 23]
            word = sum(1 << b for b in range(23) if part[b] > 0)
            unsure = sorted(range(23), key=lambda b: abs(part[b]))[: golay.UNSURE]
            best = {}
            for mask in range(1 << golay.UNSURE):
                flips = [b for k, b in enumerate(unsure) if mask >> k & 1]
                index = int(golay.codeword_index(np.array([word ^ sum(1 << b for b in flips)]))[0])
                best[index] = min(best.get(index, np.inf), sum(part[b] ** 2 for b in flips))
            found.append(best)
        pairs = sorted((x + y, i << 12 | j) for i, x in found[0].items() for j, y in found[1].items())
        out |= {f << 24 | k for _, k in pairs[: golay.PROBES]}
    return out


def test_margin_keys():
    margins = np.random.default_rng(4).normal(size=(20, golay.SCRAMBLES * 64)).astype(np.float32)
    for row, keys in zip(margins, golay.margin_keys(margins)):
        assert set(keys.tolist()) == margin_keys_plainly(row.tolist())


def test_keys_find_pairs_at_the_threshold():
    """Of pairs of sets with a similarity of 0.8 nearly all are candidates."""
    draw = np.random.default_rng(5)
    missed = 0
    for _ in range(1000):
        both, own = draw.integers(0, 2**64, 320, np.uint64), draw.integers(0, 2**64, (2, 40), np.uint64)
        margins = np.array([2 * golay.bit_sums(x, golay.SCRAMBLES) - len(x) for x in (np.concatenate([both, o]) for o in own)]).reshape(2, -1)
        keys = golay.margin_keys(margins)
        last = golay.as_print(margins[:, -128:].reshape(2, 2, 64)).view(np.uint64)
        apart = np.bitwise_count(last[0] ^ last[1]).sum()
        missed += not set(keys[0].tolist()) & set(keys[1].tolist()) or apart > golay.CANDIDATE
    assert missed <= 8


def test_stage_with_clashing_names_and_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, "a", 1)] * 5 + [(1, text + " end", "b", 2), (2, text, "c", 3), (None, "alone here", "d", 4), (None, None, "e", 5), (7, " ", "f", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string, c0 int").withColumnRenamed("c0", "keys")
    kept = golay.stage(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == ["1", "7", "None"]


def test_stage_of_dense_groups(spark, make_docs):
    """Sixty texts that differ in one to four words each: as many stay as all pairs leave."""
    for seed, (n, words, least, most) in enumerate([(60, 200, 1, 4), (150, 200, 2, 4)]):
        draw = random.Random(20 + seed)
        base = [f"w{draw.randrange(10**6)}" for _ in range(words)]
        rows = []
        for d in range(n):
            text = list(base)
            for _ in range(draw.randint(least, most)):
                text[draw.randrange(words)] = f"x{draw.randrange(10**6)}"
            rows.append((d, " ".join(text)))
        kept, want = {r["doc_id"] for r in golay.stage(spark, make_docs(rows), "").collect()}, least_by_all_pairs(rows)
        assert len(kept ^ want) <= 0.02 * n
