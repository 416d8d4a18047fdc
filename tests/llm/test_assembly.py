"""Folds against a plain event-by-event version, the stream over odd rows, and the query as its SQL."""

import datetime as dt
import random

import numpy as np
import pytest

from vellumflow.llm import op12_assembly as assembly

SALES = "sale_id long, client_id long, status string, total double, sold_at timestamp_ntz, arrived_at timestamp_ntz, priority string, day int, cents string"
LINES = "sale_id long, line_no int, item_id long, vendor_id long, quantity double, amount double, discount double, flag string, shipped_at timestamp_ntz, n_lines int, due string"


def plain(held, came):
    """(completed, open) of assemblies [sale, first, last, n, cents, has, due] and events, one by one."""
    open_, done = {a[0]: list(a) for a in held}, []
    for sale, day, n, cents, has, due in sorted(came):
        a = open_.setdefault(sale, [sale, day, day, 0, 0, False, 0])
        a[2], a[3], a[4], a[5] = day, a[3] + n, a[4] + cents, a[5] or has
        a[6] = due if has else a[6]
        if a[5] and a[3] > 0 and a[4] == a[6]:
            done.append(tuple(open_.pop(sale)))
    return sorted(done), sorted(map(tuple, open_.values()))


def columns(rows, names):
    return {c: np.array([r[i] for r in rows], assembly.OPEN.get(c, np.int32)) for i, c in enumerate(names)}


@pytest.mark.parametrize("seed", range(20))
def test_fold_as_plain(seed):
    draw = random.Random(seed)
    due = {s: draw.randint(-1, 3) for s in range(12)}
    held = [(s, 1, 2, draw.randint(0, 2), draw.randint(-1, 3), (has := draw.random() < 0.5), due[s] if has else 0) for s in range(0, 12, 2)]
    held = [a for a in held if not (a[5] and a[3] > 0 and a[4] == a[6])]
    came = [(s, d, draw.randint(0, 2), draw.randint(-1, 2), draw.random() < 0.4, due[s]) for s in range(12) for d in draw.sample(range(3, 30), draw.randint(0, 12))]
    draw.shuffle(came)
    whole, left = assembly.fold(columns(held, list(assembly.OPEN)), columns(came, ["sale_id", "day", "n_lines", "cents", "has", "due"]))
    rows = lambda t: sorted(zip(*(t[c].tolist() for c in assembly.OPEN)))
    assert (rows(whole), rows(left)) == plain(held, came)


def test_state_comes_back():
    held = columns([(5, 1, 2, 3, -4, True, 9), (6, 1, 1, 0, 0, False, 0)], list(assembly.OPEN))
    back = assembly.unpack(assembly.pack(held))
    assert all((back[c] == held[c]).all() and back[c].dtype == kind for c, kind in assembly.OPEN.items())
    assert all(len(x) == 0 for x in assembly.unpack(None).values())


def odd_shop():
    """Nulls in each column, repeated rows, a sale of many lines, days beyond both ends of the batches."""
    draw = random.Random(2)
    at = lambda d: dt.datetime(2024, 1, 1) + dt.timedelta(days=d, hours=draw.randint(0, 23))
    sales, lines = [], []
    for s in range(120):
        many = 150 if s == 7 else draw.randint(0, 4)
        own = [(s, n, 1, 1, 1.0, draw.choice([0.005, 1.25, 2.5, -1.0, None]), 0.0, "f", at(draw.randint(-20, 190)) if draw.random() < 0.8 else None, 0, "x") for n in range(many)]
        lines += own + own[:1]
        if s % 9:
            sales.append((s, None, "n", sum((x[5] or 0.0 for x in own), 0.0), at(0), at(draw.randint(-20, 190)), None, 3, "y"))
        if s % 10 == 3:
            sales.append((s, 1, "n", None, None, None, "p", 3, "y"))
    lines += [(None, 1, 1, 1, 1.0, 1.0, 0.0, "f", at(3), 0, "x"), (200, None, None, None, None, None, None, None, None, None, None), (201, None, 1, 1, 1.0, 3.0, 0.0, "f", at(30), 0, "x")]
    return sales + [(None, 1, "n", 1.0, None, at(3), "p", 3, "y")], lines


def test_query_as_its_sql(spark, tables, monkeypatch):
    duckdb = pytest.importorskip("duckdb")
    monkeypatch.setattr(assembly, "ROWS_PER_BUCKET", 60)  # several buckets
    sales, lines = odd_shop()
    at = tables(sales=spark.createDataFrame(sales, SALES), sale_lines=spark.createDataFrame(lines, LINES))
    told = duckdb.connect()
    for name in ("sales", "sale_lines"):
        told.sql(f"CREATE VIEW {name} AS SELECT * FROM '{at}/{name}.parquet/*.parquet'")
    found = assembly.op12_sale_assembly(spark, at)
    want = told.sql(assembly.ORACLE)
    assert found.columns == want.columns
    rows = sorted(map(str, (tuple(r) for r in found.collect())))
    assert rows == sorted(map(str, want.fetchall()))
    assert {s for s in ("complete", "headless", "orphan", "short", "over") if any(s in r for r in rows)} == {"complete", "headless", "orphan", "short", "over"}


def test_nothing(spark):
    sales, lines = spark.createDataFrame([], SALES), spark.createDataFrame([], LINES)
    assert assembly.assemble(spark, assembly.events(sales, lines)).count() == 0
