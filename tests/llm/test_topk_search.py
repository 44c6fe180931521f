import math

import duckdb
import pytest
from pyspark.sql import functions as F

from slotwise.llm import topk_search as S

SCHEMA = "vec_id long, embedding array<float>, label int, v int, cell int"


def vectors(n=400, width=6):
    import random

    r = random.Random(5)
    rows = [(i, [r.gauss(0, 1) for _ in range(width)]) for i in range(n)]
    rows += [(n + i, rows[3][1]) for i in range(150)]
    rows += [(900, None), (901, []), (902, [1.0, None] + [0.0] * (width - 2)), (903, [float("nan")] * width), (950, [float("inf")] * width)]
    rows += [(1000, [1.0, 2.0]), (1001, [3.0, -1.0]), (None, [0.0] * width), (50, rows[50][1]), (1100, [0.0] * width), (1150, [1e6] * width)]
    return [(i, v, 0, 1, 2) for i, v in rows]


def brute(rows, k, every):
    import numpy as np

    whole = [
        (i, [math.floor(256.0 * float(np.float32(x))) for x in v]) for i, v, *_ in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, a in dict(whole).items():
        if q % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in whole if i != q and len(a) == len(b))[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(scores, 1)]
    return sorted(out)


@pytest.mark.parametrize("block_rows", [2048, 20])
def test_equals_brute_force(spark, monkeypatch, block_rows):
    monkeypatch.setattr(S, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(S, "CHUNK_QUERIES", 7)
    monkeypatch.setattr(S, "STEP", 16)
    rows = vectors()
    got = S.top_k(spark.createDataFrame(rows, SCHEMA).repartition(3), F.col("vec_id") % 50 == 0)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 5, 50)


def test_fewer_candidates_than_k_and_none(spark):
    rows = [(0, [1.0], 0, 0, 0), (1, [2.0], 0, 0, 0), (50, [-1.0], 0, 0, 0)]
    got = S.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 5, 50)
    assert S.top_k(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 50 == 0).count() == 0


def test_bounds_never_lie_below_scores():
    import numpy as np

    r = np.random.default_rng(1)
    x, q, p = np.floor(256 * r.normal(size=(200, 5))), np.floor(256 * r.normal(size=(20, 5))), np.floor(256 * r.normal(size=(8, 5)))
    dist = lambda a: np.linalg.norm(a[:, None] - p[None], axis=2)
    top = S._bounds(dist(q), (q * q).sum(1), dist(x), dist(x), (x * x).sum(1))
    assert (top >= q @ x.T).all() and (top < (q * q).sum(1)[:, None] / 2 + (x * x).sum(1)[None] / 2).any()


def test_oracle(spark):
    folder = "/root/testdata/sf0.001"
    got = S.top_k(spark.read.parquet(f"{folder}/embeddings.parquet"), F.col("vec_id") % 50 == 0)
    db = duckdb.connect()
    db.sql(f"create view embeddings as select * from '{folder}/embeddings.parquet'")
    assert sorted(tuple(r) for r in got.collect()) == sorted(db.sql(S.ORACLE).fetchall())
