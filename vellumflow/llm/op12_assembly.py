"""Assembly of sales and their lines until they are complete, as a stateful stream.

Rows come in batches by day of arrival. A stateful query, started anew for each batch on one checkpoint, holds
what has come of each sale and closes it when sale, lines and amounts are all there, or when it has waited too
long. Sales are grouped by hash buckets, not one by one: a bucket's state is one compressed Arrow table with a
row for each open assembly, and its rows are folded by NumPy, all sales of the bucket side by side. Every
bucket gets a tick row with every batch, which carries the largest day of all batches before, so that time goes
on where nothing arrives.

Rows of one sale and day are added up before they are written for the stream: they join an assembly together,
so nothing changes, and a sale that holds a third of all lines is a row a day.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from vellumflow.llm.common import shared_dir, table

BATCHES = 8
FIRST_DAY = 19_723  # 2024-01-01
DAYS = 160
WAIT = 5
LATE = 8  # days that a shipped line may take
SPREAD = 152  # days over which lines that were not shipped arrive
KINDS = 5
ROWS_PER_BUCKET = 50_000
NEVER = -(2**31)
LARGEST = 1e15
EVENTS = "sale_id long, day int, n_lines long, cents long, has boolean, due long"
FED = f"{EVENTS}, bucket int, prior int, batch int, last boolean"
OPEN = {"sale_id": np.int64, "first_day": np.int32, "last_day": np.int32, "n_lines": np.int64, "cents": np.int64, "has": np.bool_, "due": np.int64}
CLOSED = "sale_id long, first_day int, last_day int, n_lines long, cents long, due long, status string, closing_batch int"


def cents(amount: Column) -> Column:
    """Whole hundredths, halves upwards; null, non-finite and amounts of 10^15 or more count as 0."""
    return F.when(F.abs(amount) < LARGEST, F.floor(amount * 100 + 0.5)).otherwise(0).cast("long")


def day_of(time: Column) -> Column:
    return F.unix_date(time.cast("date"))


def events(sales: DataFrame, lines: DataFrame) -> DataFrame:
    """EVENTS: a row for each sale_id and day on which something arrives, with the cents due.

    Equal lines count once, rows with a null sale_id not at all; of several sales of one sale_id the largest
    total counts; a null line_no is empty text in the hash; a sale without a time of arrival comes on the
    first day. Names other than those used may clash with anything."""
    lines = lines.where("sale_id IS NOT NULL").distinct()
    h = F.crc32(F.concat_ws(":", F.col("sale_id").cast("string"), F.coalesce(F.col("line_no").cast("string"), F.lit(""))).cast("binary"))
    arrived = F.coalesce(day_of(F.col("shipped_at")) + h % LATE, FIRST_DAY + h % SPREAD)
    came = lines.select("sale_id", arrived.cast("int").alias("day"), F.lit(1).alias("n"), cents(F.col("amount")).alias("cents"), F.lit(None).cast("long").alias("total"))
    sold = sales.where("sale_id IS NOT NULL").select("sale_id", F.coalesce(day_of(F.col("arrived_at")), F.lit(FIRST_DAY)).alias("day"), F.lit(0).alias("n"), F.lit(0).cast("long").alias("cents"), cents(F.col("total")).alias("total"))
    days = came.union(sold).groupBy("sale_id", "day").agg(F.sum("n").alias("n_lines"), F.sum("cents").alias("cents"), F.max("total").alias("total"))
    own = Window.partitionBy("sale_id")
    days = days.withColumn("last", F.max(F.when(F.col("n_lines") > 0, F.col("day"))).over(own)).withColumn("all", F.sum("cents").over(own)).withColumn("sum", F.max("total").over(own))
    days = days.withColumn("at_last", F.sum(F.when(F.col("day") == F.col("last"), F.col("cents")).otherwise(0)).over(own))
    kind = F.crc32(F.col("sale_id").cast("string").cast("binary")) % KINDS
    due = F.when(kind == 0, F.coalesce("sum", F.lit(0))).when(kind == 1, F.col("all") - F.col("at_last")).otherwise(F.col("all"))
    return days.select(F.col("sale_id").cast("long").alias("sale_id"), "day", "n_lines", "cents", F.col("total").isNotNull().alias("has"), due.cast("long").alias("due"))


def batch_of(day: Column) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(BATCHES - 1), F.floor((day - FIRST_DAY) * BATCHES / F.lit(DAYS)))).cast("int")


def pack(assemblies: dict[str, np.ndarray]) -> bytes:
    rows = pa.RecordBatch.from_arrays([pa.array(assemblies[c]) for c in OPEN], list(OPEN))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(rows)
    return sink.getvalue().to_pybytes()


def unpack(state: bytes | None) -> dict[str, np.ndarray]:
    if state is None:
        return {c: np.zeros(0, kind) for c, kind in OPEN.items()}
    rows = pa.ipc.open_stream(state).read_all()
    return {c: rows.column(c).to_numpy() for c in OPEN}


def fold(held: dict[str, np.ndarray], came: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """(completed, open) assemblies from open ones and a batch's events (sale_id, day, n_lines, cents, has,
    due), at most one for a sale and day. Sales are segments of sorted arrays; each round closes the first
    completion of every segment that has one, and what follows it begins anew."""
    rows = {c: np.concatenate([held[c], came[{"first_day": "day", "last_day": "day"}.get(c, c)].astype(kind)]) for c, kind in OPEN.items()}
    order = np.lexsort((rows["last_day"], np.arange(len(rows["sale_id"])) >= len(held["sale_id"]), rows["sale_id"]))
    rows = {c: x[order] for c, x in rows.items()}
    closed, left = [], []
    while len(sale := rows["sale_id"]):
        n = len(sale)
        heads = np.flatnonzero(np.concatenate([[True], sale[1:] != sale[:-1]]))
        ends = np.append(heads[1:], n)
        start = np.repeat(heads, ends - heads)
        so_far = lambda x: (total := np.cumsum(x)) - (total - x)[start]
        sold = np.maximum.accumulate(np.where(rows["has"], np.arange(n), -1))
        has = sold >= start
        state = {"sale_id": sale, "first_day": rows["first_day"][start], "last_day": rows["last_day"], "n_lines": so_far(rows["n_lines"]), "cents": so_far(rows["cents"]), "has": has, "due": np.where(has, rows["due"][sold], 0)}
        whole = np.flatnonzero(has & (state["n_lines"] > 0) & (state["cents"] == state["due"]))
        which, at = np.unique(start[whole], return_index=True)  # the first completion of each segment
        closed.append({c: x[whole[at]] for c, x in state.items()})
        done = np.isin(heads, which)
        left.append({c: x[ends[~done] - 1] for c, x in state.items()})
        until = np.full(n, n)
        until[which] = whole[at]
        again = np.arange(n) > until[start]
        rows = {c: x[again] for c, x in rows.items()}
    join = lambda parts: {c: np.concatenate([np.zeros(0, kind), *(p[c] for p in parts)]).astype(kind) for c, kind in OPEN.items()}
    return join(closed), join(left)


@dataclass(frozen=True)
class Assembler:
    """What the stream does with a bucket's rows of a batch."""

    wait: int = WAIT

    def __call__(self, key: tuple, frames, state: GroupState):
        rows = pd.concat(list(frames), ignore_index=True)
        ticks = rows[rows["bucket"] >= 0]
        if len(ticks) != 1:
            raise ValueError(f"bucket {key[0]} has {len(ticks)} ticks in a batch, not one")
        prior, batch, last = (ticks[c].iloc[0] for c in ("prior", "batch", "last"))
        rows = rows[rows["bucket"] < 0]
        whole, held = fold(unpack(bytes(state.get[0]) if state.exists else None), {c: rows[c].to_numpy() for c in ("sale_id", "day", "n_lines", "cents", "has", "due")})
        over = np.full(len(held["sale_id"]), bool(last)) | (held["first_day"].astype(np.int64) + self.wait <= prior)
        late = {c: x[over] for c, x in held.items()}
        status = np.where(~late["has"], "headless", np.where(late["n_lines"] == 0, "orphan", np.where(late["cents"] < late["due"], "short", "over")))
        if over.all():
            if state.exists:
                state.remove()
        else:
            state.update((pack({c: x[~over] for c, x in held.items()}),))
        parts = [(whole, np.full(len(whole["sale_id"]), "complete")), (late, status)]
        for found, word in parts:
            if len(word):
                out = pd.DataFrame({c: found[c] for c in ("sale_id", "first_day", "last_day", "n_lines", "cents")})
                out["due"] = pd.Series(found["due"], dtype="Int64").mask(~found["has"])
                yield out.assign(status=word.astype(object), closing_batch=np.int32(batch))


def assemble(spark: SparkSession, rows: DataFrame, wait: int = WAIT) -> DataFrame:
    """(sale_id, first_day, last_day, n_lines, cents, due, status, closing_batch) of every closing, from
    EVENTS, cut into batches by day and fed in order; see Assembler and fold. No rows, no closings.

    All that is written goes to a new folder below the shared one: events by batch, the folder that the stream
    reads, its checkpoint and its results. Nothing but a count and a day per batch reaches the driver."""
    base = f"{shared_dir(spark)}/assembly-{uuid.uuid4().hex}"
    kept = rows.withColumn("bucket", F.lit(-1)).withColumn("prior", F.lit(NEVER)).withColumn("last", F.lit(False)).withColumn("batch", batch_of(F.col("day")))
    kept.write.partitionBy("batch").parquet(f"{base}/events")
    known = {r["batch"]: r for r in spark.read.schema(FED).parquet(f"{base}/events").groupBy("batch").agg(F.count("*").alias("n"), F.max("day").alias("day")).collect()}
    buckets = max(1, math.ceil(sum(r["n"] for r in known.values()) / ROWS_PER_BUCKET))
    files = spark._jvm.org.apache.hadoop.fs.Path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    path = lambda name: spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{name}")
    prior = NEVER
    for batch in range(BATCHES):
        ticks = spark.range(0, buckets, 1, max(1, buckets >> 16)).select(*(F.lit(v).cast(k).alias(c) for c, k, v in (("sale_id", "long", 0), ("day", "int", 0), ("n_lines", "long", 0), ("cents", "long", 0), ("has", "boolean", False), ("due", "long", 0))), F.col("id").cast("int").alias("bucket"), F.lit(prior).alias("prior"), F.lit(batch).alias("batch"), F.lit(batch == BATCHES - 1).alias("last"))
        ticks.write.parquet(f"{base}/fed/ticks-{batch}")
        if batch in known:
            if not files.rename(path(f"events/batch={batch}"), path(f"fed/events-{batch}")):
                raise OSError(f"{base}/events/batch={batch} cannot be moved")
            prior = max(prior, known[batch]["day"])
        fed = spark.readStream.schema(FED).option("recursiveFileLookup", "true").parquet(f"{base}/fed")
        own = F.when(F.col("bucket") >= 0, F.col("bucket")).otherwise(F.pmod(F.xxhash64("sale_id"), F.lit(buckets)).cast("int"))
        closings = fed.withColumn("own", own).groupBy("own").applyInPandasWithState(Assembler(wait), CLOSED, "open binary", "append", GroupStateTimeout.NoTimeout)
        query = closings.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start(f"{base}/closings")
        query.awaitTermination()
    return spark.read.schema(CLOSED).parquet(f"{base}/closings")


def op12_sale_assembly(spark, sf_dir: str) -> DataFrame:
    """Every closing of an assembly of a sale and its lines."""
    return assemble(spark, events(table(spark, sf_dir, "sales"), table(spark, sf_dir, "sale_lines")))


_crc32 = lambda text: f"xor(list_reduce(list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT)), lambda c, b: xor(c >> 8, tab[CAST((xor(c, b) & 255) + 1 AS INT)]), 4294967295), 4294967295)"
_day = lambda time: f"date_diff('day', DATE '1970-01-01', CAST({time} AS DATE))"
_closing = lambda first, batch, following: f"list_filter(range({batch}, coalesce({following}, {BATCHES})), lambda x: x = {BATCHES - 1} OR {first} + {WAIT} <= prior[x + 1])[1]"

#: Event by event of each sale; an assembly that waits too long closes before the next event.
ORACLE = f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS tab
), l AS (
  SELECT sale_id, shipped_at, CAST(coalesce(floor(100 * amount + 0.5), 0) AS BIGINT) AS cents, {_crc32("sale_id || ':' || coalesce(CAST(line_no AS VARCHAR), '')")} AS h
  FROM (SELECT DISTINCT * FROM sale_lines WHERE sale_id IS NOT NULL), crc
), e AS (
  SELECT sale_id, coalesce({_day("shipped_at")} + h % {LATE}, {FIRST_DAY} + h % {SPREAD}) AS d, 1 AS n, cents, CAST(NULL AS BIGINT) AS total FROM l
  UNION ALL
  SELECT sale_id, coalesce({_day("arrived_at")}, {FIRST_DAY}), 0, 0, CAST(coalesce(floor(100 * total + 0.5), 0) AS BIGINT) FROM sales WHERE sale_id IS NOT NULL
), g AS (
  SELECT sale_id, d, sum(n) AS n, sum(cents) AS cents, max(total) AS total, CAST(greatest(0, least({BATCHES - 1}, floor((d - {FIRST_DAY}) * {BATCHES} / {DAYS}.0))) AS INT) AS b FROM e GROUP BY sale_id, d
), w AS (
  SELECT *, max(CASE WHEN n > 0 THEN d END) OVER (PARTITION BY sale_id) AS last_line FROM g
), s AS (
  SELECT sale_id, {_crc32("CAST(sale_id AS VARCHAR)")} % {KINDS} AS kind, coalesce(max(total), 0) AS total, sum(cents) AS whole, coalesce(sum(cents) FILTER (d < last_line), 0) AS early FROM w, crc GROUP BY sale_id, tab
), p AS (
  SELECT list((SELECT max(d) FROM g WHERE g.b < i.b) ORDER BY i.b) AS prior FROM (SELECT unnest(range({BATCHES})) AS b) AS i
), v AS (
  SELECT g.sale_id, d, n, cents, g.total IS NOT NULL AS has, b, CASE kind WHEN 0 THEN s.total WHEN 1 THEN early ELSE whole END AS due,
    row_number() OVER o AS k, lead(b) OVER o AS following FROM g JOIN s USING (sale_id) WINDOW o AS (PARTITION BY sale_id ORDER BY d)
), a AS (
  SELECT sale_id, k, d AS first_day, d AS last_day, n, cents, has, due, b, following, has AND n > 0 AND cents = due AS whole, {_closing("d", "b", "following")} AS closing FROM v, p WHERE k = 1
  UNION ALL
  SELECT sale_id, k, first_day, last_day, n, cents, has, due, b, following, has AND n > 0 AND cents = due, {_closing("first_day", "b", "following")}
  FROM (
    SELECT v.sale_id, v.k, CASE WHEN fresh THEN v.d ELSE a.first_day END AS first_day, v.d AS last_day, v.n + CASE WHEN fresh THEN 0 ELSE a.n END AS n, v.cents + CASE WHEN fresh THEN 0 ELSE a.cents END AS cents, v.has OR (NOT fresh AND a.has) AS has, v.due, v.b, v.following
    FROM (SELECT *, whole OR closing IS NOT NULL AS fresh FROM a) AS a JOIN v ON v.sale_id = a.sale_id AND v.k = a.k + 1
  ), p
)
SELECT sale_id, CAST(first_day AS INT) AS first_day, CAST(last_day AS INT) AS last_day, CAST(n AS BIGINT) AS n_lines, CAST(cents AS BIGINT) AS cents, CASE WHEN has THEN CAST(due AS BIGINT) END AS due,
  CASE WHEN whole THEN 'complete' WHEN NOT has THEN 'headless' WHEN n = 0 THEN 'orphan' WHEN cents < due THEN 'short' ELSE 'over' END AS status, CAST(CASE WHEN whole THEN b ELSE closing END AS INT) AS closing_batch
FROM a WHERE whole OR closing IS NOT NULL
"""
