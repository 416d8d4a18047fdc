import numpy as np
import pytest

from vellumflow.llm import op10_epsilon_grid as grid


def plain(rows, least):
    ok = [v is not None and i is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for i, v in rows]
    linked = np.zeros((len(rows), len(rows)), bool)
    for a in range(len(rows)):
        for b in range(a):
            if ok[a] and ok[b] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
                linked[a, b] = linked[b, a] = x @ y / np.sqrt((x @ x) * (y @ y)) >= least
    out = []
    for a, (i, _) in enumerate(rows):
        seen, todo = {a}, [a]
        while todo:
            for b in np.flatnonzero(linked[todo.pop()]).tolist():
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        least_id = min(rows[b][0] for b in seen) if i is not None else None
        out.append((i, int(linked[a].sum()), least_id, i is not None and i == least_id))
    return sorted(out, key=str)


@pytest.mark.parametrize(("interval", "leaf"), [(8192, 256), (40, 8)])
def test_as_pair_by_pair(spark, monkeypatch, interval, leaf):
    monkeypatch.setattr(grid, "INTERVAL", interval)
    monkeypatch.setattr(grid, "LEAF", leaf)
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(8, 16))
    rows = [(i, (centres[i % 8] + draw.normal(size=16) * (0.1 + 0.05 * (i % 7))).astype(np.float32).tolist()) for i in range(260)]
    rows += [(300 + i, rows[0][1]) for i in range(15)] + [(400 + i, [x * 3 for x in rows[1][1]]) for i in range(3)]
    rows += [(500, None), (501, [0.0] * 16), (502, [None, *rows[2][1][1:]]), (503, [float("nan")] * 16), (504, [float("inf"), *[1.0] * 15]), (505, []), (506, [1.0, 2.0]), (507, [2.0, 4.0]), (None, rows[0][1]), (0, rows[0][1])]
    frame = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "vec_id long, embedding array<float>, n_links int, run int, v string")
    out = grid.near_vectors(frame)
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted((tuple(r) for r in out.collect()), key=str) == plain(rows, 0.9)


def test_nothing(spark):
    assert grid.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    bad = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in grid.near_vectors(bad).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_distant_blocks_are_skipped():
    draw = np.random.default_rng(0)
    raw = np.concatenate([c + draw.normal(size=(512, 12)) * 0.02 for c in np.eye(12)[:6] * 3])
    basis = grid.directions(raw)
    whole = grid.Interval(raw, basis)
    pairs = list(grid.leaf_pairs(whole, whole, 2 - 2 * 0.9 + grid.SLACK, True))
    assert len(pairs) < len(whole.low) ** 2 / 3


def test_query_as_its_sql(spark, tables):
    duckdb = pytest.importorskip("duckdb")
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + draw.normal(size=8) * 0.2).astype(np.float32).tolist()) for i in range(90)]
    rows += [(200, rows[0][1]), (201, None), (202, [0.0] * 8), (203, [float("nan")] * 8), (204, [None] * 8), (None, rows[0][1])]
    at = tables(embeddings=spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    told = duckdb.connect()
    told.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{at}/embeddings.parquet/*.parquet'")
    found = grid.op10_epsilon_grid_join(spark, at)
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, told.sql(grid.ORACLE).fetchall()))


@pytest.mark.parametrize("reach", [0.2, 1.0])
def test_meeting_intervals(spark, reach):
    """The join on cells finds the intervals whose boxes are near, each pair once."""
    draw = np.random.default_rng(5)
    rows = [(int(run), (centre + draw.normal(size=3) * 0.2).tolist()) for run, centre in enumerate(draw.normal(size=(40, 3))) for _ in range(4)]
    boxes = [(np.min(p, axis=0), np.max(p, axis=0)) for p in (np.array([x for r, x in rows if r == run]) for run in range(40))]
    near = {(i, j) for i in range(40) for j in range(i, 40) if grid.apart(*boxes[i], *boxes[j]) <= reach}
    found = [(r["i"], r["j"]) for r in grid._meeting(spark.createDataFrame(rows, "run int, places array<double>"), 3, reach).collect()]
    assert len(found) == len(set(found)) and set(found) == near
