"""Sharding by a Hilbert curve: order rows along the curve through several metadata dimensions and
cut the order into runs, so that every file covers a small box of the metadata space.

Only DataFrame expressions; nothing runs in Python on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from vellumflow.llm.common import table, written

DIMENSIONS = ("source", "lang", "n_chars")
BITS = 5
ROWS_PER_BUCKET = 65_536
VALUES_PER_RANGE = 65_536
BROADCAST_ROWS = 1_000_000


def curve_tables(dims: int) -> tuple[list[int], list[int]]:
    """The curve's automaton as (digit, next state) by state * 2**dims + corner.

    A state is the entry corner of a cell and the axis that the curve leaves it by; corners in a cell
    are visited in Gray-code order seen from that entry and axis.
    """
    side = 1 << dims
    turn = lambda x, k: ((x << k % dims) | (x >> (dims - k % dims))) & (side - 1)
    gray = [i ^ (i >> 1) for i in range(side)]
    ungray = {g: i for i, g in enumerate(gray)}
    ones = lambda i: (~i & (i + 1)).bit_length() - 1  # noqa: E731  trailing ones
    entry = [0 if i == 0 else gray[(i - 1) // 2 * 2] for i in range(side)]
    axis = [0 if i == 0 else ones(i - 1 if i % 2 == 0 else i) % dims for i in range(side)]
    digit, following = [], []
    for state in range(side * dims):
        start, leave = divmod(state, dims)
        for corner in range(side):
            i = ungray[turn(corner ^ start, dims - (leave + 1) % dims)]
            digit.append(i)
            following.append((start ^ turn(entry[i], leave + 1)) * dims + (leave + axis[i] + 1) % dims)
    return digit, following


def curve_index(cells: list[Column], bits: int) -> Column:
    """Position on the curve of integer coordinates below 2**bits."""
    dims = len(cells)
    digit, following = ([F.lit(x) for x in t] for t in curve_tables(dims))
    digits, states = F.array(*digit), F.array(*following)

    def step(at: Column, level: Column) -> Column:
        corner = sum((F.call_function("shiftright", at[f"c{j}"], level) % 2 * (1 << j) for j in range(dims)), F.lit(0))
        k = at["state"] * (1 << dims) + corner + 1
        return F.struct(F.element_at(states, k).alias("state"), (at["index"] * (1 << dims) + F.element_at(digits, k)).alias("index"), *kept(at))

    # The cells ride in the accumulator, so that each is worked out once and not at every level.
    kept = lambda at: (at[f"c{j}"].alias(f"c{j}") for j in range(dims))
    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("index"), *(c.cast("int").alias(f"c{j}") for j, c in enumerate(cells)))
    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), start, step, lambda at: at["index"])


def _count_reached(bounds: list):
    """How many bounds a value reaches; as a lambda, so that the value is worked out only once."""
    return lambda value: sum(((value >= F.lit(b)).cast("int") for b in bounds), F.lit(0))


def string_bounds(df: DataFrame, name: str, parts: int) -> list[str]:
    """The quantiles i / parts of a string column over all rows, 0 < i < parts, in the order of whole
    strings, each once: the least value that such a share of the rows does not exceed.

    Distinct values are counted, sorted in ranges of about VALUES_PER_RANGE, and summed up range by
    range, so that no task holds more, however many values there are."""
    counts = df.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("value")).agg(F.count("*").alias("n"))
    seen = Observation()
    counts = written(counts.observe(seen, F.count("*").alias("values"), F.sum("n").alias("rows")), "values")
    values, rows = seen.get["values"], seen.get["rows"]
    if not values:
        return []
    # Written, so that the ranges, which are sampled, are the same wherever they are read.
    ranges = written(counts.repartitionByRange(values // VALUES_PER_RANGE + 1, "value").withColumn("range", F.spark_partition_id()), "ranges")
    sums = ranges.groupBy("range").agg(F.sum("n").alias("rows"))
    before = sums.select("range", (F.sum("rows").over(Window.orderBy("range")) - F.col("rows")).alias("before"))
    upto = F.sum("n").over(Window.partitionBy("range").orderBy("value")) + F.col("before")
    ranked = ranges.join(before, "range").select("value", upto.alias("upto"))
    found = ranked.agg(*(F.min(F.when(F.col("upto") * parts >= i * rows, F.col("value"))).alias(f"q{i}") for i in range(1, parts))).first()
    return sorted(set(found))


def cells(df: DataFrame, dimensions: tuple[str, ...], bits: int) -> tuple[list[Column], int]:
    """Each dimension cut at its 2**bits quantiles over all rows, and the number of rows. Strings are
    ordered as whole strings, other columns as doubles; null falls in the first cell."""
    parts, kinds = 1 << bits, dict(df.dtypes)
    at = [i / parts for i in range(1, parts)]
    value = {d: F.col(f"`{d}`") if kinds[d] == "string" else F.col(f"`{d}`").cast("double") for d in dimensions}
    numbers = [F.percentile_approx(value[d], at, 100_000).alias(f"q{i}") for i, d in enumerate(dimensions) if kinds[d] != "string"]
    row = df.agg(F.count("*").alias("rows"), *numbers).first()
    cut = []
    for i, d in enumerate(dimensions):
        bounds = string_bounds(df.select(value[d].alias("value")), "value", parts) if kinds[d] == "string" else sorted(set(row[f"q{i}"] or []))
        cut.append(F.coalesce(F.transform(F.array(value[d]), _count_reached(bounds))[0], F.lit(0)))
    return cut, row["rows"]


def hilbert_shards(df: DataFrame, n_shards: int, dimensions: tuple[str, ...] = DIMENSIONS, bits: int = BITS, tie: str = "doc_id", narrow: bool = False) -> DataFrame:
    """df with `shard` (0 to n_shards - 1) and `slot` (gapless from 0 in each shard), rows in curve
    order, counts of the shards at most one apart.

    Row numbers come from counts: at most 2**(bits * dimensions) curve cells are counted, a cell of
    more than ROWS_PER_BUCKET rows is dealt by the hash of `tie` into buckets of about that size, and
    only within a bucket are rows sorted. A hot cell thus never meets in one task. Where rows are
    `narrow` they are written once with their cells; else the cells are worked out where rows are read.

    Rows of equal `tie` take neighbouring slots in any order. Null dimensions fall in the first cell, a
    null `tie` sorts first; texts, however long, are not looked at; empty input gives no rows; columns
    named shard or slot are replaced, all others stay, as columns are renamed inside.
    """
    names = [c for c in df.columns if c not in ("shard", "slot")]
    inner = {c: f"c{i}" for i, c in enumerate(names)}
    df = df.select(*(F.col(f"`{c}`").alias(i) for c, i in inner.items()))
    tie, cut = inner[tie], tuple(inner[d] for d in dimensions)
    found, total = cells(df, cut, bits)
    on_curve = df.withColumn("cell", curve_index(found, bits))
    if narrow:
        on_curve = written(on_curve, "cells")
    # One row per cell, so 2**15 rows at the most.
    buckets = F.broadcast(on_curve.groupBy("cell").agg(F.ceil(F.count("*") / ROWS_PER_BUCKET).alias("n")))
    dealt = on_curve.join(buckets, "cell").withColumn("part", F.pmod(F.xxhash64(F.col(tie)), "n"))
    counts = dealt.groupBy("cell", "part").agg(F.count("*").alias("rows"))
    before = counts.select("cell", "part", (F.sum("rows").over(Window.orderBy("cell", "part")) - F.col("rows")).alias("before"))
    place = F.row_number().over(Window.partitionBy("cell", "part", "before").orderBy(F.col(tie))) - 1 + F.col("before")
    # One row per cell and per ROWS_PER_BUCKET rows of the input: sent to all while that is little.
    small = (1 << bits * len(dimensions)) + total // ROWS_PER_BUCKET <= BROADCAST_ROWS
    total = max(total, 1)
    placed = dealt.join(F.broadcast(before) if small else before, ["cell", "part"]).withColumn("place", place.cast("long"))
    placed = placed.withColumn("shard", F.expr(f"place * {n_shards}L div {total}L").cast("int"))
    first = F.expr(f"(shard * {total}L + {n_shards - 1}L) div {n_shards}L")
    return placed.select(*(F.col(i).alias(c) for c, i in inner.items()), (F.col("place") - first).alias("slot"), "shard")


def op7_hilbert_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of equal row counts along the curve through source, language and
    length. Null text has size 1 and the checksum of no bytes."""
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", "source", "lang", "n_chars", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    out = hilbert_shards(rows, 16, narrow=True)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: the documents with their shard and slot, nulls, empty and repeated rows as
    hilbert_shards() has them."""
    return hilbert_shards(docs, 16)
