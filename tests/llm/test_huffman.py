import heapq
import random
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from vellumflow.llm import op6_huffman as huffman

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")


def optimal(counts):
    heap, total = [int(c) for c in counts if c], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        total += a
        heapq.heappush(heap, a)
    return total


def test_lengths_and_round_trip():
    draw = np.random.default_rng(0)
    counts = draw.integers(0, 1000, 500)
    lengths = huffman.code_lengths(counts)
    assert (counts * lengths).sum() == optimal(counts) and sum(2.0 ** -int(x) for x in lengths if x) == 1
    steep = (1.7 ** np.arange(40)).astype(np.int64) + 1
    assert huffman.code_lengths(steep).max() <= huffman.LONGEST
    limited = [huffman.code_lengths(np.array([1, 1, 2, 3, 5, 8, 13, 21]), k) for k in (3, 4, 7)]
    assert [int((x * [1, 1, 2, 3, 5, 8, 13, 21]).sum()) for x in limited] == [162, 137, 133] or all(sum(2.0 ** -int(v) for v in x) <= 1 for x in limited)
    for used in ([], [7], [3, 9]):
        c = np.zeros(10, np.int64)
        c[used] = 5
        assert (np.flatnonzero(huffman.code_lengths(c)) == used).all()
    sizes = np.array([1, 255, 256, 257, 512, 513, 3000])
    ids = draw.choice(np.flatnonzero(counts), sizes.sum())
    payload, width, marks = huffman.encode(ids, sizes, huffman.canonical(lengths), lengths)
    assert (huffman.Decoder(lengths).decode(payload, sizes, width, marks) == ids).all()


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_as_the_library_encodes(name):
    encoder = huffman.Encoder(open(public.path(name), encoding="utf-8").read())
    signs = ["a", "é", " ", "  ", "\n", "'s", "'", "S", "1", "²", "!", "\t", "\xa0", "\x85", "\x1c", "\x1f", "ß", "×", "ª", "Ɏ", "’", "中", "<|endoftext|>", "'ll", "\r\n", "_", "́", "😀", "ɐ", "I'm", "\0"]
    draw = random.Random(1)
    for _ in range(4000):
        text = "".join(draw.choice(signs) for _ in range(draw.randint(0, 25)))
        assert encoder.ids(text).tolist() == encoder.plain.encode(text, add_special_tokens=False).ids


def test_files(spark, make_docs, odd_texts, tmp_path):
    path = public.path("byte_bpe_50k.json")
    plain = tokenizers.Tokenizer.from_file(path)
    rows = [(d, t if t is None else t[:30_000]) for d, t in odd_texts]
    huffman.write_ids(make_docs(rows).repartition(3), open(path, encoding="utf-8").read(), 2, str(tmp_path / "f"))
    out = sorted(huffman.read_ids(spark, str(tmp_path / "f")).collect(), key=lambda r: r["start"])
    expected = Counter()
    for doc_id, text in rows:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        expected[doc_id, len(ids) // 4, crc32(ids), ids] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"], bytes(r["ids"])) for r in out) == expected
    assert [r["start"] for r in out] == np.cumsum([0, *(r["n_tokens"] for r in out[:-1])]).tolist()
    order = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in out]  # documents of one id in any order
    assert order == sorted(order)
    huffman.write_ids(make_docs([]), open(path, encoding="utf-8").read(), 2, str(tmp_path / "none"))
    assert huffman.read_ids(spark, str(tmp_path / "none")).count() == 0


def test_more_ids_than_short_codes():
    draw = np.random.default_rng(3)
    counts = draw.integers(1, 50, (1 << 18) + 1000)
    lengths = huffman.code_lengths(counts)
    assert lengths.min() > 0 and huffman.LONGEST < lengths.max() <= huffman.longest_code(len(counts)) == 19
    ids, sizes = draw.integers(0, len(counts), 3000), np.array([1000, 2000])
    payload, width, marks = huffman.encode(ids, sizes, huffman.canonical(lengths), lengths)
    assert (huffman.Decoder(lengths).decode(payload, sizes, width, marks) == ids).all()


def test_query(spark, make_docs, odd_texts, tables):
    rows = [(d, t if t is None else t[:3000]) for d, t in odd_texts]
    plain = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    out = sorted(huffman.op6_huffman_ids(spark, tables(documents=make_docs(rows))).collect(), key=lambda r: r["start"])
    want = Counter((d, crc32(np.array([*plain.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes())) for d, t in rows)
    assert Counter((r["doc_id"], r["ids_crc32"]) for r in out) == want
    assert out[0]["start"] == 0 and all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(out, out[1:]))
