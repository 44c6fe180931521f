import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotwise.llm import neighbours as N

SCHEMA = "vec_id long, embedding array<double>, v int, c int, first int"


def clustered(n=900, width=12, seed=3):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(width)] for _ in range(20)]
    rows = [(i, [x + r.gauss(0, 0.5) for x in r.choice(centres)]) for i in range(n)]
    rows += [(n + i, rows[3][1]) for i in range(200)]
    rows += [(n + 200 + i, [x + r.gauss(0, 1e-4) for x in rows[7][1]]) for i in range(150)]
    return rows


def odd(width=12):
    nan, inf = float("nan"), float("inf")
    return [
        (5000, None), (5050, []), (5100, [1.0, None] + [0.0] * (width - 2)), (5150, [nan] * width), (5200, [inf] * width), (5250, [0.0] * width),
        (5300, [1.0, 2.0]), (5301, [3.0, -1.0]), (5302, [-0.5, 0.1]), (None, [1.0] * width), (5350, [1e200] * width), (5351, [1e-200] + [0.0] * (width - 1)), (5400, [7.0]),
    ]


def brute(rows, k=5, every=50):
    whole = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for q, a in sorted(whole, reverse=True):
        if q % every == 0:
            best = {}
            for i, b in whole:
                if i != q and len(a) == len(b):
                    x, y = (np.ldexp(np.array(z), -np.frexp(max(map(abs, z)))[1]) for z in (a, b))
                    score = float((x * y).sum() / (np.sqrt((x * x).sum()) * np.sqrt((y * y).sum())))
                    best[i] = max(best.get(i, -2), score)
            out[q] = sorted((-s, i) for i, s in best.items())[:k]
    return out


def check(spark, rows, partitions=3):
    data = spark.createDataFrame([(i, v, 0, 1, 2) for i, v in rows], SCHEMA).repartition(partitions)
    got = {}
    for q, rank, i, score in sorted(tuple(r) for r in N.nearest(data, F.col("vec_id") % 50 == 0).collect()):
        got.setdefault(q, []).append((rank, i, score))
    want = brute(rows)
    assert {q: len(v) for q, v in got.items()} == {q: len(v) for q, v in want.items() if v}
    assert all([r for r, _, _ in v] == list(range(1, len(v) + 1)) for v in got.values())
    hits = total = 0
    for q, v in got.items():
        exact = {i: -s for s, i in want[q]}
        hits += sum(i in exact for _, i, _ in v)
        total += len(v)
        assert all(abs(exact[i] - s) < 1e-12 for _, i, s in v if i in exact)
        assert [(-s, i) for _, i, s in v] == sorted((-s, i) for _, i, s in v)
    return hits / total if total else 1


@pytest.mark.parametrize(("rows_a_unit", "block"), [(512, 4096), (32, 40)])
def test_recall_against_brute_force(spark, monkeypatch, rows_a_unit, block):
    """Copies, near copies in one unit, ties, odd vectors and several widths; small blocks cut the hot units."""
    monkeypatch.setattr(N, "UNIT_ROWS", rows_a_unit)
    monkeypatch.setattr(N, "BLOCK_ROWS", block)
    monkeypatch.setattr(N, "BLOCK_QUERIES", 5)
    rows = clustered()
    assert check(spark, rows + odd() + rows[:3] + [(50, rows[60][1])]) >= 0.95


def test_copies_are_exact(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(120)] + [(200 + i, [1.0, 2.0, 3.0 + i]) for i in range(3)]
    assert check(spark, rows) == 1


def test_all_candidates_if_few_and_far(spark, monkeypatch):
    """The probes of one table meet too few; the query then looks everywhere."""
    monkeypatch.setattr(N, "TABLES", 1)
    monkeypatch.setattr(N, "TARGET", 0.01)
    rows = [(50 * i, [math.cos(i), math.sin(i), 0.1 * i, 1.0, -float(i % 3), 0.0]) for i in range(9)]
    assert check(spark, rows) >= 0.6


def test_fewer_candidates_than_k_and_none(spark):
    assert check(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [1.0, 0.1]), (50, [0.9, 0.1])]) == 1
    assert check(spark, [(50, [1.0])]) == 1
    empty = spark.createDataFrame([], SCHEMA)
    assert N.nearest(empty, F.col("vec_id") % 50 == 0).count() == 0
    assert N.nearest(spark.createDataFrame([(1, [1.0], 0, 0, 0)], SCHEMA), F.col("vec_id") % 50 == 0).count() == 0


def test_floats_keep_their_score(spark):
    r = random.Random(1)
    rows = [(i, [float(np.float32(r.gauss(0, 1))) for _ in range(8)]) for i in range(101)]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    want = brute(rows)
    for q, _, i, score in N.nearest(data, F.col("vec_id") % 50 == 0).collect():
        assert dict((i, -s) for s, i in want[q]).get(i, score) == pytest.approx(score, abs=1e-14)


def test_hadamard_turns_keep_angles_and_probes_start_at_home():
    v = np.random.default_rng(2).normal(size=(50, 12))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    h = N.Hashes(12, 100_000)
    y = h.turned(v, 0, 0)[:, :16]
    assert h.axes[0] == 16 and np.allclose(y @ y.T, v @ v.T)
    unit, code = h.codes(v, 1)
    bucket = h.probes(v, 1, 40)
    assert (bucket[:, 0] == unit * 2 * h.axes[-1] + code).all()
    every = h.probes(v, 1, h.buckets)
    assert (np.sort(every, axis=1) == np.arange(h.buckets)).all() and (every[:, :40] == bucket).all()
