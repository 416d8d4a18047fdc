import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
from pyspark.sql import functions as F

from vellumflow.llm import ngrams
from vellumflow.llm import op2_toxicity as toxicity
from vellumflow.llm import op8_bradley_terry as quality

BAD = ("idiot", "moron", "scum")


def corpus(n, seed=1):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("aeinrstoldu") for _ in range(draw.randint(2, 7)))
    rows = []
    for i in range(n):
        words = [word() for _ in range(draw.randint(20, 200))]
        toxic, poor = i % 4 == 0, i % 5 == 0
        if poor:
            words = [w + draw.choice(("###", "$$$", "%%%")) for w in words] if i % 2 else words[:5] * 30
        if toxic:
            words[draw.randrange(len(words))] = draw.choice(BAD)
            words.append(draw.choice(BAD))
        rows.append((i, " ".join(words), int(toxic), int(not poor)))
    return rows


def held(i):
    return crc32(str(i).encode()) % 5 == 0


def area(scores, y):
    return np.mean([(a > b) + (a == b) / 2 for a in scores[y] for b in scores[~y]])


def test_held_out(spark, tables):
    rows = corpus(400)
    at = tables(documents=spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), labels=spark.createDataFrame([(r[0], r[3], r[2]) for r in rows], "doc_id long, quality int, toxic int"))
    for query, k in ((toxicity.op2_ngram_toxicity, 2), (quality.op8_bradley_terry_quality, 3)):
        out = sorted(query(spark, at).collect(), key=lambda r: r["doc_id"])
        assert [r["held_out"] for r in out] == [held(r[0]) for r in rows]
        scores, y = np.array([r["score"] for r in out]), np.array([r[k] == 1 for r in rows])
        away = np.array([held(r[0]) for r in rows])
        assert area(scores[away], y[away]) > 0.97
        assert all(0 <= s <= 1 for s in scores)


def test_held_out_labels_are_not_learnt_from(spark, tables):
    rows = corpus(60)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    flipped = [(r[0], 1 - r[3], 1 - r[2]) if held(r[0]) else (r[0], r[3], r[2]) for r in rows]
    kind = "doc_id long, quality int, toxic int"
    for query in (toxicity.op2_ngram_toxicity, quality.op8_bradley_terry_quality):
        a = query(spark, tables(documents=docs, labels=spark.createDataFrame([(r[0], r[3], r[2]) for r in rows], kind))).collect()
        b = query(spark, tables(documents=docs, labels=spark.createDataFrame(flipped, kind))).collect()
        assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_odd_rows_and_missing_labels(spark, make_docs, odd_texts):
    docs, kind = make_docs(odd_texts), "doc_id long, quality int, toxic int"
    for labels in ([], [(None, None, None), (3, None, None), (6, 1, 1)], [(r[0], r[0] % 2, r[0] % 2) for r in odd_texts if r[0]] * 2):
        frame = spark.createDataFrame(labels, kind)
        for scored in (toxicity.toxicity(docs, frame, docs, "score"), quality.quality(docs, frame, docs, "q")):
            out = [r[-1] for r in scored.collect()]
            assert len(out) == len(odd_texts) and all(0 <= s <= 1 for s in out)
    assert toxicity.toxicity(docs.limit(0), frame, docs.limit(0), "s").count() == 0


def densities_plainly(text, signs):
    """Each n-gram's density by counting strings."""
    kind = lambda c: c if c > "\uffff" else " " if c.isspace() or c < " " or not (signs or c.isalnum()) else "0" if signs and c.isdigit() else c
    text = " " + re.sub(" +", " ", "".join(map(kind, text.lower()))).strip(" ") + " "
    text = re.sub(" +", " ", text)
    found = Counter(text[i : i + n] for n in ngrams.ORDERS for i in range(len(text) - n + 1))
    hashed = Counter()
    for gram, times in found.items():
        hashed[int(dict(ngrams.hashes(np.array([ord(c) for c in gram], np.uint32)))[len(gram)][0])] += times
    return {h: int(ngrams.density(np.array([t]), len(text.split()))[0]) for h, t in hashed.items()}


def test_densities(monkeypatch):
    texts = [r[1] for r in corpus(12, 9)] + ["", "a", " ", "A1 b\u00e9\tC\u4e2d$$ \U0001f600x", "###  12 34"]
    for signs in (False, True):
        plain = [densities_plainly(t, signs) for t in texts]
        grams = np.array(sorted({h for p in plain for h in p})[::3], np.uint32)
        expected = np.array([[p.get(int(g), 0) for g in grams] for p in plain]) / ngrams.STEPS
        for size in (1 << 20, 50):  # whole and in slices
            monkeypatch.setattr(ngrams, "SLICE", size)
            found = np.concatenate([x for _, x in ngrams.Densities(grams, signs).groups(texts)])
            assert np.allclose(found, expected)
            for text, p in zip(texts, plain):
                h, times, words = ngrams.counted(text, signs)
                assert dict(zip(h.tolist(), ngrams.density(times, words).tolist())) == p


def test_fit_is_the_least_loss():
    """The weights of both classifiers against plain Newton steps."""
    draw = np.random.default_rng(2)
    x = draw.normal(size=(600, 4)).astype(np.float32)
    y = draw.random(600) < 1 / (1 + np.exp(-(x @ [1.5, -1, 0, 0.5] - 1)))
    w = np.zeros(5)
    full, ridge = np.concatenate([x, np.ones((600, 1))], axis=1).astype(float), np.diag([0.01] * 4 + [0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-full @ w))
        w -= np.linalg.solve((full * (p * (1 - p))[:, None]).T @ full / 600 + ridge, full.T @ (p - y) / 600 + ridge @ w)
    found, bias = toxicity.logistic(x, y, 0.01)
    assert np.allclose([*found, bias], w, atol=2e-3)
    better, worse = draw.choice(np.flatnonzero(y), 2000), draw.choice(np.flatnonzero(~y), 2000)
    d, w = (x[better] - x[worse]).astype(float), np.zeros(4)
    for _ in range(30):
        p = 1 / (1 + np.exp(-d @ w))
        w += np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d / 2000 + 0.01 * np.eye(4), d.T @ (1 - p) / 2000 - 0.01 * w)
    assert np.allclose(quality.bradley_terry(x, better, worse, 0.01), w, atol=2e-3)


def test_long_texts_score_whole(spark, make_docs, monkeypatch):
    """A text of several slices scores as one that is held at once."""
    rows = corpus(80)
    long = " ".join(r[1] for r in rows) + " idiot"
    docs = make_docs([*((r[0], r[1]) for r in rows), (999, long)])
    labels = spark.createDataFrame([(r[0], r[3], r[2]) for r in rows], "doc_id long, quality int, toxic int")
    sample = ngrams.learnable(docs, labels, "toxic", 50, 64, signs=False)
    assert len(sample.y) <= 50 and sample.x.shape == (len(sample.y), len(sample.grams))
    model = toxicity.Model(sample)
    whole = model.scores([long.encode()])
    monkeypatch.setattr(ngrams, "SLICE", 700)
    assert np.allclose(model.scores([long.encode()]), whole)
    assert np.allclose(model.scores([r[1].encode() for r in rows]), [model.scores([r[1].encode()])[0] for r in rows])


def test_words_in_slices(monkeypatch):
    text = b" ".join(r[1].encode() for r in corpus(50))
    whole = quality.measures(text)
    monkeypatch.setattr(quality, "SLICE", 1000)
    assert quality.measures(text) == whole


def test_toxic_words_of_several_languages(spark, tables):
    """Slurs are made-up beginnings of words in three alphabets; held out, most are found in each."""
    draw, rows = random.Random(6), []
    letters = {"de": ("achl", "einrstä"), "fr": ("réeu", "aeoiéèç"), "el": ("σκατ", "αεινορτ")}
    for i in range(1500):
        lang = ("de", "fr", "el")[i % 3]
        slur, own = letters[lang]
        words = ["".join(draw.choice(own + "mnl") for _ in range(draw.randint(2, 8))) for _ in range(draw.randint(30, 120))]
        toxic = i % 7 == 0
        for _ in range(max(2, len(words) // 25) if toxic else draw.random() < 0.1):
            words[draw.randrange(len(words))] = slur + draw.choice(words)
        rows.append((i, " ".join(words), int(toxic), lang))
    at = tables(documents=spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), labels=spark.createDataFrame([(r[0], 1, r[2]) for r in rows], "doc_id long, quality int, toxic int"))
    said = {r["doc_id"]: r["predicted"] for r in toxicity.op2_ngram_toxicity(spark, at).collect() if r["held_out"]}
    for lang in letters:
        own = [(r[2], said[r[0]]) for r in rows if r[0] in said and r[3] == lang]
        assert sum(t and p for t, p in own) >= 0.7 * sum(t for t, _ in own)
        assert sum(p and not t for t, p in own) <= 0.03 * len(own)


def test_stage(spark, make_docs, tables):
    rows = corpus(300)
    at = tables(labels=spark.createDataFrame([(r[0], r[3], r[2]) for r in rows], "doc_id long, quality int, toxic int"))
    docs = make_docs([(r[0], r[1]) for r in rows])
    kept = toxicity.stage(spark, docs, at)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    bad = {r[0] for r in rows if r[2]}
    assert len(ids & bad) <= 2 and len(set(range(300)) - bad - ids) <= 2


def test_every_labelled_text_is_learnt_from(spark):
    """No bound on labelled rows; every one of both classes is in a pair; cut and weights are those of all rows."""
    rows = [(i, int(i % 7 > 0), f"w{i} " * 3) for i in range(9000)]
    frame = spark.createDataFrame(rows, "doc_id long, quality int, text string")
    assert ngrams.labelled_rows(frame.drop("quality"), frame.drop("text"), "quality").count() == sum(not held(r[0]) for r in rows)
    draw = np.random.default_rng(3)
    x, y = draw.normal(size=(700, 3)), draw.random(700) < 0.8
    x[:, 0] = np.where(y, 0.5, -0.5) + x[:, 0]
    stored = ngrams.written(spark.createDataFrame([(i, bool(g), (0, 3, [0, 1, 2], v.tolist())) for i, (g, v) in enumerate(zip(y, x))], f"doc_id long, good boolean, features {ngrams.VECTOR}"), "features")
    good, poor = int(y.sum()), int((~y).sum())
    for larger in (True, False):
        seen = quality.numbered(stored).where(f"good = {larger}").select("at").collect()
        assert sorted(r["at"] for r in seen) == list(range(good if larger else poor))
    pairs = quality.preferences(stored, good, poor, 10)
    kept = [(r["label"], r["features"]["values"]) for r in pairs.collect()]
    both = {tuple(np.round(a - b, 9)): (i, j) for i, a in enumerate(x) if y[i] for j, b in enumerate(x) if not y[j]}
    found = [both[tuple(np.round(np.array(v) * (1 if label else -1), 9))] for label, v in kept]
    assert len(found) == good and len({i for i, _ in found}) == good and len({j for _, j in found}) == poor
    w, _ = ngrams.fitted(ngrams.as_vectors(pairs), 0.01, False)
    assert np.allclose(w, quality.bradley_terry(x.astype(np.float32), *np.array(found).T, 0.01), atol=5e-3)
    w, b = ngrams.fitted(ngrams.as_vectors(stored).withColumn("label", F.col("good").cast("double")), 0.01, True)
    assert np.allclose([*w, b], np.append(*toxicity.logistic(x.astype(np.float32), y, 0.01)), atol=5e-3)


def test_quantile_of_many(spark, monkeypatch):
    monkeypatch.setattr(quality, "HELD", 20)
    values = [*np.random.default_rng(1).normal(size=900).tolist(), *[0.25] * 300, 1e9]
    ranks = spark.createDataFrame([(v,) for v in values], "rank double")
    for share in (0.0, 0.33, 0.61, 1.0):
        assert np.isclose(quality.quantile(ranks, len(values), share), np.quantile(values, share))


def test_toxicity_is_the_least_loss_after_few_jobs(spark):
    """The fitted weights leave no slope under one of the penalties; passes over the rows are few."""
    rows = corpus(500)
    docs, labels = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    found = ngrams.examples(docs, labels, "toxic", 256, signs=False)
    spark.sparkContext.setJobGroup("fit", "fit")
    try:
        model = toxicity.Model.of(found)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < len(spark.sparkContext.statusTracker().getJobIdsForGroup("fit")) <= 120
    kept = sorted(found.texts.collect(), key=lambda r: r["doc_id"])
    y = np.array([r["good"] for r in kept])
    x = np.concatenate([p for _, p in ngrams.Densities(found.grams, False).groups([r["text"] for r in kept])]) * found.ratio
    w = model.weights / found.ratio
    off = 1 / (1 + np.exp(-(x @ w + model.bias))) - y
    assert abs(off.mean()) < 1e-6
    assert min(np.abs(x.T @ off / len(y) + penalty * w).max() for penalty in toxicity.PENALTIES) < 1e-6


def test_curvature_of_all(spark, monkeypatch):
    """Loss, slope and curvature of rows in several tasks, blocks and strips against plain sums."""
    monkeypatch.setattr(toxicity, "STRIP", 3)
    draw = np.random.default_rng(5)
    x, y, w = draw.normal(size=(300, 7)), draw.random(300) < 0.3, draw.normal(size=8)
    stored = ngrams.written(spark.createDataFrame([(bool(g), (0, 7, list(range(7)), v.tolist())) for g, v in zip(y, x)], f"good boolean, features {ngrams.VECTOR}").repartition(3), "features")
    full = np.concatenate([x, np.ones((300, 1))], axis=1)
    z, away = full @ w, np.append(w[:-1], 0)
    p = 1 / (1 + np.exp(-z))
    n, loss, slope = toxicity.loss_of_all(stored, w, 0.01)
    assert n == 300 and np.isclose(loss, np.logaddexp(0, np.where(y, -z, z)).mean() + 0.005 * away @ away)
    assert np.allclose(slope, full.T @ (p - y) / 300 + 0.01 * away)
    matrix = toxicity.curvature_of_all(stored, n, w)
    assert np.allclose(matrix, (full * (p * (1 - p))[:, None]).T @ full / 300, atol=1e-6)
    assert np.allclose(matrix @ (s := toxicity.solved(matrix, np.full(8, 0.01), slope)) + 0.01 * s, slope, atol=1e-8)


def test_no_curvature_reaches_the_driver(spark, monkeypatch):
    """A fit brings sums and solutions to the driver, a few numbers for each weight, and leaves no curvature stored."""
    from pyspark.sql import DataFrame

    draw, width = np.random.default_rng(6), 60
    x = draw.normal(size=(400, width))
    y = draw.random(400) < 1 / (1 + np.exp(-2 * x[:, 0]))
    stored = ngrams.written(spark.createDataFrame([(bool(g), (0, width, list(range(width)), v.tolist())) for g, v in zip(y, x)], f"good boolean, features {ngrams.VECTOR}").repartition(3), "features")
    whole, sent = type(stored).collect, []

    def collect(df):
        rows = whole(df)
        sent.append(max((len(v) for r in rows for v in r if isinstance(v, (bytes, bytearray))), default=0) * len(rows))
        return rows

    monkeypatch.setattr(type(stored), "collect", collect)
    w, matrix = toxicity.logistic_of_all(stored, 0.01, np.zeros(width + 1))
    assert isinstance(matrix, DataFrame) and 0 < max(sent) <= 3 * 8 * (width + 3) < 8 * width**2 / 2
    off = 1 / (1 + np.exp(-(x @ w[:-1] + w[-1]))) - y
    assert np.abs(x.T @ off / 400 + 0.01 * w[:-1]).max() < 1e-6 and abs(off.mean()) < 1e-6
