"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

The words of a source, its documents in a seeded order, are cut into blocks of equal length. Seats,
one block each, go to the source with the highest quotient target / (2 * seats + 1); runs of the
sequence of seats make the shards' quotas. A source with more seats than blocks takes all its blocks
again; the seats beyond whole rounds go to blocks at equal distances from a seeded start. Seats are
numbered source by source, rounds first, and fill the shards' quotas in that order.
"""

from __future__ import annotations

import hashlib
import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellumflow.llm.common import table, word_count, written

WEIGHTS = (5, 2, 1)
BLOCK = 16
SHARDS = 16
MOST = 3
ROWS_PER_BUCKET = 50_000
MAX_SOURCES = 100_000
MOST_BLOCKS = 2**30


def targets(sizes: list[int], weights: list[float], most: int = MOST) -> list[float]:
    """Shares of the total by weight, none above most times its size; what is cut off goes to the
    others by weight, until none is above. The result is one level: min(cap, level * weight)."""
    total, caps = float(sum(sizes)), [float(most * s) for s in sizes]
    order = sorted(range(len(sizes)), key=lambda i: caps[i] / weights[i])
    out, left, weight = [0.0] * len(sizes), total, float(sum(weights))
    for n, i in enumerate(order):
        if caps[i] / weights[i] >= left / weight:
            for k in order[n:]:
                out[k] = left / weight * weights[k]
            break
        out[i] = caps[i]
        left, weight = left - caps[i], weight - weights[i]
    return out


def apportion(claims: list[float], caps: list[int], seats: int) -> list[int]:
    """Seats by highest quotient claim / (2 * seats + 1), ties to the earlier, none above its cap."""
    seats = min(seats, sum(c for c, t in zip(caps, claims) if t > 0))
    given = lambda d: [min(c, int(t / d + 0.5)) if t > 0 else 0 for t, c in zip(claims, caps)]
    low, high = 1e-9, max([1.0, *claims]) * 4
    for _ in range(200):  # the least divisor that gives no more than the seats
        mid = (low + high) / 2
        if mid in (low, high):
            break
        low, high = (mid, high) if sum(given(mid)) > seats else (low, mid)
    out = given(high)
    heap = [(-t / (2 * q + 1), i) for i, (t, q, c) in enumerate(zip(claims, out, caps)) if t > 0 and q < c]
    heapq.heapify(heap)
    for _ in range(seats - sum(out)):
        _, i = heapq.heappop(heap)
        out[i] += 1
        if out[i] < caps[i]:
            heapq.heappush(heap, (-claims[i] / (2 * out[i] + 1), i))
    return out


def plan(sources: list[tuple], weights: list[float], block: int, n_shards: int, seed: int) -> list[dict]:
    """One entry per source from (name, words): target, blocks, quota per shard, rounds and phase. Blocks
    have `block` words, or more, so that no source has more than MOST_BLOCKS and products of two
    counts of blocks fit a long.

    The method adds seats only, so quotas for a smaller house are part of those for a larger one;
    shard k's quota is what houses of k + 1 shards have beyond those of k."""
    sizes = [s for _, s in sources]
    goal = targets(sizes, weights)
    block = max(block, -(-max(sizes, default=0) // MOST_BLOCKS))
    blocks = [-(-s // block) for s in sizes]
    house = max(1, round(sum(sizes) / block)) if sum(sizes) else 0
    so_far = [apportion(goal, [MOST * b for b in blocks], house * (k + 1) // n_shards) for k in range(n_shards)]
    out = []
    for i, (name, size) in enumerate(sources):
        n, quota = blocks[i], so_far[-1][i]
        start = int(hashlib.md5(f"{seed}:{i}".encode()).hexdigest()[:8], 16) % n if n else 0
        out.append({"source": name, "words": size, "target": goal[i], "block": block, "blocks": n, "rounds": quota // n if n else 0, "extra": quota % n if n else 0, "phase": start, "quotas": [b[i] - (so_far[k - 1][i] if k else 0) for k, b in enumerate(so_far)]})
    return out


def _extras_before(b: str, of: str) -> str:
    """Extra seats of blocks before block b of a source."""
    return f"(({b}) * {of}.extra + {of}.phase) div {of}.blocks"


def _words_before(at: str) -> Column:
    """Extra words taken from the first `at` words of a source."""
    j = f"({at} div __m.block)"
    upto, after = _extras_before(j, "__m"), _extras_before(f"{j} + 1L", "__m")
    return F.expr(f"CASE WHEN __m.blocks > 0 THEN __m.block * ({upto}) + ({at} % __m.block) * (({after}) - ({upto})) ELSE 0L END")


def _shard_of(seat: str, of: str) -> Column:
    """The shard whose quota a seat of the source fills."""
    return F.expr(f"aggregate({of}.quotas, named_struct('sum', 0L, 'shard', 0), (a, q) -> named_struct('sum', a.sum + q, 'shard', a.shard + if({seat} >= a.sum + q, 1, 0)), a -> a.shard)")


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, block: int = BLOCK, n_shards: int = SHARDS, seed: int = 17, size: str = "size", source: str = "source", key: str = "doc_id") -> DataFrame:
    """docs (any columns, with `size` in words) with a struct `mix` of the source's plan, `at` (the
    document's first word within its source), `taken` (words taken, repeats counted) and `shard` (that
    which the first block taken of the document goes to, null where none is).

    Sources are ordered by code point, null last, and weigh `weights`, repeated. No word is taken more
    than three times. The per-source plan is made on the driver: one row per source, MAX_SOURCES at
    the most, else ValueError. Offsets come from sums by source and hash bucket; rows are sorted only
    within a bucket of about ROWS_PER_BUCKET rows, so a hot source is spread. Documents without words
    (null or empty texts) take none; a very long document is a longer stretch of blocks; equal rows may
    swap places; no rows give no rows. A column named mix is replaced; all other names may be used, as
    columns are renamed inside.
    """
    spark, names = docs.sparkSession, [c for c in docs.columns if c != "mix"]
    inner = [f"c{i}" for i in range(len(names))]
    docs = docs.select(*(F.col(f"`{c}`").alias(i) for c, i in zip(names, inner)))
    size, source, key = (inner[names.index(c)] for c in (size, source, key))
    src = F.col(source)
    found = docs.groupBy(src.alias("s")).agg(F.sum(size).alias("w"), F.count("*").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    found.sort(key=lambda r: (r["s"] is None, r["s"] or ""))
    made = plan([(r["s"], int(r["w"] or 0)) for r in found], [float(weights[i % len(weights)]) for i in range(len(found))], block, n_shards, seed)
    kind = "s string, m struct<words:long,target:double,block:long,blocks:long,rounds:long,extra:long,phase:long,quotas:array<long>>, n long"
    rows = [(p["source"], tuple(p[k] for k in ("words", "target", "block", "blocks", "rounds", "extra", "phase", "quotas")), max(1, -(-r["n"] // ROWS_PER_BUCKET))) for p, r in zip(made, found)]
    plans = F.broadcast(spark.createDataFrame(rows, kind).select(F.col("s").alias("__s"), F.col("m").alias("__m"), F.col("n").alias("__n")))
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"))
    dealt = docs.join(plans, src.eqNullSafe(F.col("__s"))).withColumn("__order", order)
    dealt = dealt.withColumn("__part", F.expr("cast(conv(substr(__order, 1, 8), 16, 10) as long) * __n div 4294967296L"))
    sums = dealt.groupBy("__s", "__part").agg(F.sum(size).alias("__w"))
    # One row per source and ROWS_PER_BUCKET documents.
    before = sums.select(F.col("__s").alias("__s2"), F.col("__part").alias("__part2"), (F.sum("__w").over(Window.partitionBy("__s").orderBy("__part")) - F.col("__w")).alias("__before"))
    placed = dealt.join(before, F.col("__s").eqNullSafe(F.col("__s2")) & (F.col("__part") == F.col("__part2")))
    inside = Window.partitionBy("__s", "__part").orderBy("__order", key, size)
    end = F.sum(size).over(inside.rowsBetween(Window.unboundedPreceding, 0)) + F.col("__before")
    placed = placed.withColumn("__end", end.cast("long")).withColumn("__at", F.col("__end") - F.col(size))
    extra = _words_before("__end") - _words_before("__at")
    first, last = "(__at div __m.block)", "((__end - 1L) div __m.block + 1L)"
    placed = placed.withColumn("__lead", F.expr(f"CASE WHEN __end = __at THEN NULL WHEN __m.rounds > 0 THEN {first} WHEN {_extras_before(last, '__m')} > {_extras_before(first, '__m')} THEN {_extras_before(first, '__m')} END"))
    shard = F.when(F.col("__lead").isNotNull(), _shard_of("__lead", "__m"))
    mix = F.struct("__m.*", F.col("__at").alias("at"), (F.col("__m.rounds") * F.col(size) + extra).alias("taken"), shard.alias("shard"))
    return placed.select(*(F.col(i).alias(c) for c, i in zip(names, inner)), mix.alias("mix"))


def block_pieces(mixed: DataFrame, size: str = "size", key: str = "doc_id") -> DataFrame:
    """The mix itself from what mix_sources() returns: a row per document, block and repeat with the
    words [from_word, to_word) of the document and the shard whose quota the block fills."""
    pieces = mixed.where(F.col(size) > 0).select(F.col(key), F.col(size).alias("size"), "mix", F.explode(F.expr(f"sequence(mix.at div mix.block, (mix.at + {size} - 1) div mix.block)")).alias("b"))
    pieces = pieces.withColumn("chosen", F.expr(_extras_before("b", "mix")))
    pieces = pieces.withColumn("times", F.expr(f"cast(mix.rounds + {_extras_before('b + 1L', 'mix')} - chosen as int)")).where("times > 0")
    pieces = pieces.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.col("times") - 1)))
    seat = F.expr("if(repeat < mix.rounds, repeat * mix.blocks + b, mix.rounds * mix.blocks + chosen)")
    words = (F.greatest(F.expr("b * mix.block - mix.at"), F.lit(0)).alias("from_word"), F.least(F.expr("(b + 1) * mix.block - mix.at"), F.col("size")).alias("to_word"))
    return pieces.withColumn("seat", seat).select(key, F.col("b").alias("block"), "repeat", _shard_of("seat", "mix").alias("shard"), *words)


def op1_sainte_lague_mixing(spark, sf_dir: str) -> DataFrame:
    """Every document with its size in words (null text: 0), its source's size and target, the words taken
    and the shard that its first block taken goes to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    out = mix_sources(written(docs, "sizes"))
    return out.select("doc_id", "size", F.col("mix.words").alias("source_size"), F.round("mix.target", 6).alias("target"), F.col("mix.taken").alias("taken"), F.col("mix.shard").alias("shard"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the mix by whole documents. Every document is there as often as its source's blocks
    are taken in whole rounds, and once more if in the seeded order it begins within the words of the seats
    beyond; so each source's words come to its quota but for one document at the most.

    Documents without words follow the others of their source; equal rows are documents of their own;
    columns are renamed inside, so that no name can clash; no documents give none."""
    names = [f"d{i}" for i in range(len(docs.columns))]
    key, source, text = (names[docs.columns.index(c)] for c in ("doc_id", "source", "text"))
    sized = docs.toDF(*names).withColumn("size", word_count(F.col(text)))
    copies = F.expr("cast(mix.rounds + if(mix.at < mix.extra * mix.block, 1, 0) as int)")
    mixed = mix_sources(sized, source=source, key=key).withColumn("copies", copies).where("copies > 0")
    again = mixed.withColumn("again", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return again.select(*(F.col(n).alias(c) for n, c in zip(names, docs.columns)))
