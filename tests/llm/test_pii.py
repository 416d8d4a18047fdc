import random
import re

import pytest
from pyspark.sql import functions as F

from vellumflow.llm import op5_pii as pii

EMAIL, IP = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD, PHONE = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", m.start(), m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m.group())) <= 19 and pii.luhn(digits(m.group()))]
    out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m.group())) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


@pytest.fixture(scope="module")
def redactor():
    return pii.Redactor()


def test_base_spans_as_the_patterns_have_them(redactor):
    draw = random.Random(0)
    for signs in ("a1.@+-() 2.5\n:%é", "1 2-3.4+5@a", "0123456789 -"):
        texts = ["".join(draw.choice(signs) for _ in range(draw.randint(0, 60))) for _ in range(15_000)]
        for text, (base, spans) in zip(texts, redactor.all_spans(texts)):
            assert base == plain(text) and set(base) <= set(spans)


def test_added_spans(redactor):
    kinds = lambda t: [t[a:b] for _, a, b in redactor.spans(t)[1]]
    assert kinds("call me at (415) 555-2671 ok") == ["(415) 555-2671"]
    assert kinds("server 10[.]0[.]0[.]5 is up") == ["10[.]0[.]0[.]5"]
    assert kinds("write joe{@}site.org. Then wait") == ["joe{@}site.org"]
    run = "card 4111 1111 1111 1111 5500 9912 on file"  # one failing match: its parts are proposed
    assert ("card", 5, 24) in pii.candidates(run, pii.matches(run))
    for value in ("cf1d64a9a4cd9723e1f4eafc27395915e6868ffa", "Zx81kQp0aV7rT2mWn45LbY"):
        for text in (f'token = "{value}"', f"the words api_key: {value} and more", f'%%% secret = "{value}"### La%%%'):
            assert kinds(text) == [value]
    for clean in ("order 123 456 7890 shipped", "serial 1234567890123456", "In 2019, 12 of 365 days. Version 1.2.3", "commit cf1d64a9a4cd9723e1f4eafc27395915e6868ffa", "Note: something-else entirely", "name = value_here", "a @ b", ""):
        assert redactor.spans(clean) == ([], [])


def test_many_texts_at_once(redactor):
    texts = ["call (415) 555-2671", "", 'token = "cf1d64a9a4cd9723e1f4eafc27395915e6868ffa"', "10[.]0[.]0[.]5", "a.b@c.de +1 (017) 555-7713"]
    assert redactor.all_spans(texts) == [redactor.spans(t) for t in texts]


def test_corpus_examples(spark, make_docs):
    rows = [(i, f"host 10.0.0.{i} and 300.1.1.{i} end") for i in range(20)] * 2
    found = pii.corpus_examples(make_docs(rows))
    assert sorted(label for _, _, label in found) == [0] * 20 + [1] * 20 and {k for _, k, _ in found} == {"ip"}
    assert len(pii.corpus_examples(make_docs(rows), limit=5)) == 10 and pii.corpus_examples(make_docs([])) == []


def test_long_text_as_a_short_one(redactor):
    short = 'mail a.b@c.de, token = "cf1d64a9a4cd9723e1f4eafc27395915e6868ffa" ends'
    long = "word " * 300_000 + short
    shift = len(long) - len(short)
    assert redactor.spans(long)[1] == [(k, a + shift, b + shift) for k, a, b in redactor.spans(short)[1]]


def test_long_texts_take_linear_time(redactor):
    for text in ("1" * 200_000, "1." * 100_000, "a" * 200_000, "+1" * 100_000, "a@" * 100_000, "x.@" * 50_000, "a-" * 100_000, "=" * 200_000, "1 " * 50_000):
        redactor.spans(text)


def test_trees_are_calibrated(redactor):
    import numpy as np

    drawn = pii.examples(2000, seed=77)
    scores = redactor.trees.scores(np.array([m for m, _, _ in drawn]))
    chosen = np.array([s >= redactor.least[k] for s, (_, k, _) in zip(scores, drawn)])
    y = np.array([label for _, _, label in drawn], bool)
    assert y[chosen].mean() > 0.97 and chosen[y].mean() > 0.6


def test_rows(spark, make_docs, odd_texts, tables):
    rows = odd_texts + [(200, "é mail a.b@c.de, 10.0.0.1"), (201, "+1 (017) 555-7713")]
    out = {r["doc_id"]: r for r in pii.op5_boosted_pii(spark, tables(documents=make_docs(rows))).collect()}
    assert out[200]["spans"] == "email:7:15,ip:17:25" and out[200]["n_email"] == out[200]["n_ip"] == 1 and out[201]["n_phone"] == 1
    assert pii.personal_data(make_docs(rows)).count() == len(rows) and pii.personal_data(make_docs(rows).limit(0)).count() == 0
    clean = pii.redacted(make_docs(rows)).where(F.col("doc_id").isin(200, 0)).collect()
    assert {r["text"] for r in clean} == {"é mail [email], [ip]", None}
