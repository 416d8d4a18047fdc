import random
from collections import defaultdict

from pyspark.sql import functions as F

from vellumflow.llm import op1_mixing as mixing


def test_targets_and_apportionment():
    assert mixing.targets([100, 100, 100], [5, 2, 1]) == [187.5, 75.0, 37.5]
    goal = mixing.targets([10, 1000, 0, 500], [5, 2, 1, 5])
    assert goal[0] == 30 and goal[2] == 0 and abs(sum(goal) - 1510) < 1e-9 and abs(goal[3] / goal[1] - 2.5) < 1e-9
    assert mixing.targets([0, 0], [1, 1]) == [0.0, 0.0] and mixing.targets([], []) == []
    draw = random.Random(2)
    for _ in range(200):
        claims = [draw.choice([0.0, draw.random() * 100]) for _ in range(draw.randint(1, 6))]
        caps = [draw.randint(0, 30) for _ in claims]
        seats, plain = draw.randint(0, 60), [0] * len(claims)
        for _ in range(seats):
            open_ = [i for i in range(len(claims)) if claims[i] > 0 and plain[i] < caps[i]]
            if open_:
                plain[max(open_, key=lambda i: (claims[i] / (2 * plain[i] + 1), -i))] += 1
        assert mixing.apportion(claims, caps, seats) == plain


def plain_mix(rows, block):
    """Words taken per row, walking over the words."""
    import hashlib

    by = defaultdict(list)
    for doc_id, text, source in rows:
        by[source].append((hashlib.md5(f"17:{'' if doc_id is None else doc_id}".encode()).hexdigest(), doc_id is not None, doc_id or 0, len((text or "").split())))
    names = sorted(by, key=lambda s: (s is None, s or ""))
    plan = mixing.plan([(n, sum(x[3] for x in by[n])) for n in names], [float(mixing.WEIGHTS[i % 3]) for i in range(len(names))], block, 4, 17)
    out = []
    for name, p in zip(names, plan):
        chosen = [p["rounds"] + ((j + 1) * p["extra"] + p["phase"]) // p["blocks"] - (j * p["extra"] + p["phase"]) // p["blocks"] for j in range(p["blocks"])]
        assert sum(chosen) == sum(p["quotas"]) and max(chosen, default=0) <= 3
        at = 0
        for _, named, doc_id, size in sorted(by[name]):
            out.append((doc_id if named else None, size, sum(chosen[w // block] for w in range(at, at + size))))
            at += size
    return sorted(out, key=str), plan


def test_mix_is_what_walking_over_the_words_gives(make_docs, odd_texts):
    rows = [(d, t, [None, "a", "bb", "B"][i % 4]) for i, (d, t) in enumerate(odd_texts)]
    docs = make_docs(rows).drop("size").withColumn("size", mixing.word_count(F.col("text")))
    mixed = mixing.mix_sources(docs, block=16, n_shards=4).cache()
    expected, plan = plain_mix(rows, 16)
    assert sorted([(r["doc_id"], r["size"], r["t"]) for r in mixed.select("doc_id", "size", F.col("mix.taken").alias("t")).collect()], key=str) == expected
    for p in plan:
        got = sum(r["t"] or 0 for r in mixed.where(F.col("source").eqNullSafe(F.lit(p["source"]))).select(F.col("mix.taken").alias("t")).collect())
        assert abs(got - p["target"]) <= 32
    mixed = mixed.withColumns({"row": F.monotonically_increasing_id(), "source": F.coalesce("source", F.lit("~"))}).cache()
    pieces = mixing.block_pieces(mixed, key="row").cache()
    assert pieces.agg(F.sum(F.col("to_word") - F.col("from_word"))).first()[0] == sum(x[2] for x in expected)
    seats = {r["shard"]: r["n"] for r in pieces.join(mixed.select("row", "source"), "row").groupBy("shard").agg(F.count_distinct("source", "block", "repeat").alias("n")).collect()}
    assert seats == {k: n for k in range(4) if (n := sum(p["quotas"][k] for p in plan))}
    # A document's shard is that of its first block, in the order of rounds.
    first = {}
    for r in sorted(pieces.collect(), key=lambda r: (r["repeat"], r["block"])):
        first.setdefault(r["row"], r["shard"])
    assert {r["row"]: r["shard"] for r in mixed.select("row", "mix.shard").collect() if r["shard"] is not None} == first
    assert mixed.where("(mix.shard IS NULL) <> (mix.taken = 0)").count() == 0


def test_query(spark, make_docs, odd_texts, tables):
    rows = [(d, t, [None, "a", "bb", "B"][i % 4]) for i, (d, t) in enumerate(odd_texts)]
    out = mixing.op1_sainte_lague_mixing(spark, tables(documents=make_docs(rows)))
    expected, plan = plain_mix(rows, mixing.BLOCK)
    assert [f.dataType.simpleString() for f in out.schema][:5] == ["bigint", "bigint", "bigint", "double", "bigint"]
    got = out.collect()
    assert sorted([(r["doc_id"], r["size"], r["taken"]) for r in got], key=str) == expected
    of = {p["source"]: (p["words"], round(p["target"], 6)) for p in plan}
    where = {}
    for d, t, s in rows:
        where.setdefault((d, len((t or "").split())), set()).add(of[s])
    assert all((r["source_size"], r["target"]) in where[r["doc_id"], r["size"]] for r in got)


def test_sources_of_any_size():
    plan = mixing.plan([("a", 2**45), ("b", 2**41 + 7), ("c", 10)], [5.0, 2.0, 1.0], mixing.BLOCK, 16, 17)
    for p in plan:
        taken = sum(p["quotas"]) * p["block"]
        assert p["blocks"] <= mixing.MOST_BLOCKS and (p["blocks"] + 1) * p["extra"] + p["phase"] < 2**63
        assert abs(taken - p["target"]) <= 2 * p["block"] and sum(p["quotas"]) == p["rounds"] * p["blocks"] + p["extra"]


def test_buckets_do_not_change_the_order(make_docs, odd_texts, monkeypatch):
    docs = make_docs(odd_texts).drop("size").withColumn("size", mixing.word_count(F.col("text")))
    one = {tuple(r) for r in mixing.mix_sources(docs).select("doc_id", "size", "mix.at", "mix.taken").collect()}
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", 3)
    assert {tuple(r) for r in mixing.mix_sources(docs).select("doc_id", "size", "mix.at", "mix.taken").collect()} == one


def test_stage(spark, make_docs, odd_texts):
    """Words of each source, of whole documents, come to its target but for one document and one block."""
    docs = make_docs([(d, t, "abc"[i % 3]) for i, (d, t) in enumerate(odd_texts * 3)])
    mixed = mixing.stage(spark, docs, "")
    assert mixed.columns == docs.columns and mixing.stage(spark, docs.limit(0), "").count() == 0
    words = F.sum(mixing.word_count(F.col("text")))
    sizes = {r["source"]: r["w"] for r in docs.groupBy("source").agg(words.alias("w")).collect()}
    longest = {r["source"]: r["w"] for r in docs.groupBy("source").agg(F.max(mixing.word_count(F.col("text"))).alias("w")).collect()}
    goal = dict(zip(sorted(sizes), mixing.targets([sizes[s] for s in sorted(sizes)], [5, 2, 1])))
    for r in mixed.groupBy("source").agg(words.alias("w")).collect():
        assert abs(r["w"] - goal[r["source"]]) <= longest[r["source"]] + 2 * mixing.BLOCK
    odd = docs.withColumnsRenamed({"lang": "__s", "slot": "__part", "score": "c0"})
    assert mixing.stage(spark, odd, "").columns == odd.columns
