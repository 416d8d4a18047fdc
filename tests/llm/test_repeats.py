import hashlib
import random

import numpy as np
import pytest

from vellumflow.llm import op3_deep_shallow as repeats

W = repeats.WINDOW


def plain(rows):
    """What is left of each (doc_id, bytes), window by window."""
    seen = {}
    order = lambda d: (d is not None, d or 0)
    for d, x in rows:
        for i in range(len(x) - W + 1):
            k = x[i : i + W]
            seen[k] = min(seen.get(k, (order(d), i)), (order(d), i))
    out = []
    for d, x in rows:
        gone = np.zeros(len(x), bool)
        for i in range(len(x) - W + 1):
            if seen[x[i : i + W]] < (order(d), i):
                gone[i : i + W] = True
        edges = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        out.append((d, len(x), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(bytes(np.frombuffer(x, np.uint8)[~gone])).hexdigest()))
    return sorted(out, key=str)


def passages(seed):
    """Texts that share passages of about the window's length, with edits, runs and periods."""
    draw = random.Random(seed)
    letters = "ab" if seed % 2 else "abcdefghij klmnoé"
    some = lambda n: "".join(draw.choice(letters) for _ in range(n))
    shared = [some(draw.randint(80, 320)) for _ in range(6)] + ["a" * 250, "ab" * 130, "\0" * 150]
    rows = []
    for i in range(60):
        text = "".join(draw.choice((some(draw.randint(0, 90)), draw.choice(shared), draw.choice(shared)[draw.randint(0, 60) :][: draw.randint(60, 200)])) for _ in range(draw.randint(0, 7)))
        if text and draw.random() < 0.3:
            at = draw.randrange(len(text))
            text = text[:at] + draw.choice(letters) + text[at + 1 :]
        rows.append((i * 3 % 61, text))
    return rows


def answer(df):
    return sorted([(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()], key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_as_window_by_window(make_docs, seed, monkeypatch):
    rows = passages(seed)
    if seed == 3:  # long texts are read in slices
        monkeypatch.setattr(repeats, "SLICE", 200)
        monkeypatch.setattr(repeats, "HELD", 50)
    assert answer(repeats.without_repeats(make_docs(rows).repartition(3))) == plain([(d, t.encode()) for d, t in rows])


def test_odd_rows(make_docs, odd_texts):
    rows = [(d, None if t is None else t[:20_000]) for d, t in odd_texts]
    assert answer(repeats.without_repeats(make_docs(rows))) == plain([(d, (t or "").encode()) for d, t in rows])
    assert repeats.without_repeats(make_docs(rows).limit(0)).count() == 0
    found = repeats.without_repeats(make_docs(rows)).where("doc_id = 5").first()
    assert hashlib.sha256(bytes(found["kept"])).hexdigest() == found["kept_sha256"] and sum(b - a for a, b in found["spans"]) == found["n_removed"]


def test_deep_shallow_order():
    draw = np.random.default_rng(0)
    rows = draw.integers(0, 3, (2000, 50)).astype(np.uint8)
    rows[500:900] = rows[0]
    rows[600:900, 40:] = draw.integers(0, 2, (300, 10))
    order, common = repeats.deep_shallow(rows)
    found = [bytes(x) for x in rows[order]]
    assert found == sorted(found)
    for i in range(1, len(found)):
        same = next((k for k in range(50) if found[i][k] != found[i - 1][k]), 50)
        assert common[i] == same
