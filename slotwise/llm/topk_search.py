"""Exact top-k inner products with a pivot table.

Distances from every vector to a few pivots are computed once. For a query q and a candidate x the largest
``|d(q, p) - d(x, p)|`` over pivots is a lower bound of d(q, x), and because
``q.x = (|q|^2 + |x|^2 - d(q, x)^2) / 2`` it is an upper bound of the score. Blocks of candidates near one pivot
have such a bound, too. A query first meets its best block, which gives it a k-th score to beat; then
only blocks, and in them only candidates in bound order, whose bound reaches that score are evaluated. Nothing
is cut off otherwise, so the result is exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotwise.llm.common import by_group
from slotwise.session import written

SAMPLE = 512
PIVOTS = 32
BLOCK_ROWS = 2048
MOST_BLOCKS = 4096
CHUNK_QUERIES = 4096
STEP = 512
LOWEST = -(1 << 62)


def usable(vectors: DataFrame, ident: str, vector: str, quantum: int) -> DataFrame:
    """(vec_id, v): components as floor(quantum * x); vectors that are null, empty or hold a null or non-finite part are left out."""
    x = F.col(vector)
    whole = x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    scaled = F.transform(x, lambda c: F.floor(c.cast("double") * float(quantum)).cast("double"))
    return vectors.where(F.col(ident).isNotNull() & whole).select(F.col(ident).cast("long").alias("vec_id"), scaled.alias("v"))


def choose_pivots(vectors: DataFrame, count: int = PIVOTS, sample: int = SAMPLE) -> np.ndarray:
    """Farthest-first pivots out of ``sample`` vectors with the smallest id hashes; the bound of what the driver sees."""
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    points = np.unique(np.array([r.v for r in rows], float), axis=0)
    chosen = [points[0]]
    near = np.linalg.norm(points - chosen[0], axis=1)
    while len(chosen) < min(count, len(points)):
        chosen.append(points[int(near.argmax())])
        near = np.minimum(near, np.linalg.norm(points - chosen[-1], axis=1))
    return np.array(chosen)


def _matrix(column: pa.ChunkedArray | pa.Array, rows: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def pivot_table(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    schema = "vec_id long, v array<double>, cell int, dist array<double>, norm double"

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _matrix(batch.column("v"), batch.num_rows)
            dist = np.sqrt(((v[:, None, :] - pivots[None, :, :]) ** 2).sum(axis=2)) if len(v) <= 256 else np.concatenate(
                [np.sqrt(((v[i: i + 256, None, :] - pivots[None, :, :]) ** 2).sum(axis=2)) for i in range(0, len(v), 256)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), pa.array(dist.argmin(axis=1).astype(np.int32)),
                 pa.array(list(dist)), pa.array((v * v).sum(axis=1))],
                ["vec_id", "v", "cell", "dist", "norm"],
            )

    return vectors.mapInArrow(run, schema)


def _bounds(q_dist: np.ndarray, q_norm: np.ndarray, low: np.ndarray, high: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """Upper bound of the score of each query (rows) with what lies between ``low`` and ``high`` distances (columns)."""
    gap = np.zeros((len(q_dist), len(low)))
    for p in range(q_dist.shape[1]):
        d = q_dist[:, p, None]
        np.maximum(gap, np.maximum(low[None, :, p] - d, d - high[None, :, p]), out=gap)
    gap = np.maximum(gap - 1e-6 * (1 + gap), 0)
    top = (q_norm[:, None] + norm[None, :] - gap * gap) / 2
    return top + 1e-9 * (1 + np.abs(top))


def _merged(scores: np.ndarray, ids: np.ndarray, more_scores: np.ndarray, more_ids: np.ndarray, k: int):
    scores, ids = np.concatenate([scores, more_scores], axis=1), np.concatenate([ids, more_ids], axis=1)
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def _evaluate(q: dict, c: dict, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Best k of the candidates for each query: columns in bound order, until no bound reaches a k-th score."""
    n = len(q["id"])
    scores, ids = np.full((n, k), LOWEST, np.int64), np.full((n, k), np.iinfo(np.int64).max)
    top = _bounds(q["dist"], q["norm"], c["dist"], c["dist"], c["norm"])
    best = top.max(axis=0)
    order = np.argsort(-best, kind="stable")
    small = np.abs(q["v"]).max() * np.abs(c["v"]).max() * q["v"].shape[1] < 2.0**53
    for at in range(0, len(order), STEP):
        tau = np.maximum(scores[:, -1], q["tau"])
        columns = order[at: at + STEP]
        live = np.flatnonzero(top[:, columns].max(axis=1) >= tau)
        if best[columns[0]] < tau.min():
            break
        if not len(live):
            continue
        columns = columns[np.argsort(c["id"][columns], kind="stable")]
        if small:
            found = np.rint(q["v"][live] @ c["v"][columns].T).astype(np.int64)
        else:
            found = q["v"][live].astype(np.int64) @ c["v"][columns].T.astype(np.int64)
        found[q["id"][live][:, None] == c["id"][columns][None, :]] = LOWEST
        # Columns stand in order of id, so a stable sort leaves ties to the smaller one.
        first = np.argsort(-found, axis=1, kind="stable")[:, :k]
        scores[live], ids[live] = _merged(scores[live], ids[live], np.take_along_axis(found, first, 1), c["id"][columns][first], k)
    return scores, ids


def _side(group: pa.Table, is_query: bool) -> dict:
    part = group.filter(pa.compute.equal(group.column("is_query"), is_query))
    n = part.num_rows
    out = {"id": part.column("vec_id").to_numpy(), "norm": part.column("norm").to_numpy(), "n": n}
    if n:
        out |= {"v": _matrix(part.column("v"), n), "dist": _matrix(part.column("dist"), n), "tau": part.column("tau").to_numpy()}
    return out


def _search(asked: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """Best k per (query, block) of ``asked`` (block and the query's columns).

    A block goes to as many units as the queries that ask for it fill; a unit holds one block and a bounded
    number of queries.
    """
    spark = asked.sparkSession
    counts = asked.groupBy("block").agg(F.ceil(F.count("*") / CHUNK_QUERIES).cast("int").alias("chunks"))
    chunks = F.broadcast(spark.createDataFrame(counts.collect(), "block int, chunks int"))  # a row per block: at most MOST_BLOCKS and one per pivot
    columns = ["block", "chunk", "is_query", "vec_id", "v", "dist", "norm", "tau"]
    left = asked.join(chunks, "block").withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.col("chunks")).cast("int")).withColumn("is_query", F.lit(True))
    right = (
        blocks.join(chunks, "block").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumn("is_query", F.lit(False)).withColumn("tau", F.lit(0).cast("long"))
    )

    def unit(group: pa.Table):
        q, c = _side(group, True), _side(group, False)
        if not q["n"] or not c["n"]:
            return None
        out_q, out_s, out_i = [], [], []
        for at in range(0, q["n"], 128):
            part = {name: q[name][at: at + 128] for name in ("id", "norm", "v", "dist", "tau")}
            scores, ids = _evaluate(part, c, k)
            real = scores > LOWEST
            out_q.append(np.repeat(part["id"], real.sum(axis=1)))
            out_s.append(scores[real])
            out_i.append(ids[real])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (out_q, out_i, out_s)], ["query_id", "vec_id", "score"])

    return by_group(left.select(columns).union(right.select(columns)), ["block", "chunk"], unit, "query_id long, vec_id long, score long")


def _ask(queries: DataFrame, summary: dict, first_only: bool) -> DataFrame:
    """Blocks to look into: the one of the highest bound, or all others whose bound reaches ``tau``."""
    schema = "block int, vec_id long, v array<double>, dist array<double>, norm double, tau long"

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                n = part.num_rows
                top = _bounds(_matrix(part.column("dist"), n), part.column("norm").to_numpy(), summary["low"], summary["high"], summary["norm"])
                best = top.argmax(axis=1)
                if first_only:
                    rows, columns = np.arange(n), best
                else:
                    wanted = top >= part.column("tau").to_numpy()[:, None]
                    wanted[np.arange(n), best] = False
                    rows, columns = np.nonzero(wanted)
                taken = part.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(summary["block"][columns]), *[taken.column(x) for x in ("vec_id", "v", "dist", "norm", "tau")]],
                    ["block", "vec_id", "v", "dist", "norm", "tau"],
                )

    return queries.mapInArrow(run, schema)


def _one_size(vectors: DataFrame, wanted: Column, k: int, rows: int) -> DataFrame:
    data = written(pivot_table(vectors, choose_pivots(vectors)), "pivots")
    room = max(BLOCK_ROWS, -(-rows // MOST_BLOCKS))
    cells = data.groupBy("cell").agg(F.ceil(F.count("*") / room).cast("int").alias("parts"))
    cells = F.broadcast(data.sparkSession.createDataFrame(cells.collect(), "cell int, parts int"))  # a row per pivot
    blocks = data.join(cells, "cell").withColumn("block", F.col("cell") * (1 << 16) + F.pmod(F.xxhash64("vec_id", "v"), F.col("parts")).cast("int"))
    width = len(data.select("dist").first()[0])
    edges = blocks.groupBy("block").agg(
        F.max("norm"), *[F.min(F.get("dist", F.lit(p))) for p in range(width)], *[F.max(F.get("dist", F.lit(p))) for p in range(width)],
    ).collect()
    flat = np.array([list(r)[1:] for r in edges], float)
    summary = {"block": np.array([r[0] for r in edges], np.int32), "norm": flat[:, 0], "low": flat[:, 1: width + 1], "high": flat[:, width + 1:]}
    queries = data.where(wanted).dropDuplicates(["vec_id"])
    first = written(_search(_ask(queries.withColumn("tau", F.lit(LOWEST)), summary, True), blocks, k), "first")
    kth = first.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("tau"))
    known = queries.join(kth.withColumnRenamed("query_id", "vec_id"), "vec_id", "left").withColumn("tau", F.coalesce("tau", F.lit(LOWEST)))
    return first.union(_search(written(_ask(known, summary, False), "asked"), blocks, k))


def top_k(vectors: DataFrame, wanted: Column, k: int = 5, quantum: int = 256, ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of each row that ``wanted`` (on ``vec_id``) takes.

    All usable rows but the query's own id are candidates; ties go to the smaller vec_id. Vectors that are null, empty or
    hold nulls, NaN or infinities and rows without an id take no part. Vectors of different length have no inner product and
    are searched apart. Rows that repeat an id are candidates each, and one query. Other columns are ignored; an empty table
    gives no rows.
    """
    data = written(usable(vectors, ident, vector, quantum), "vectors")
    sizes = data.groupBy(F.size("v").alias("width")).count().collect()  # a row per vector length
    found = None
    for width, rows in sizes:
        one = _one_size(data.where(F.size("v") == width), wanted, k, rows)
        found = one if found is None else found.union(one)
    if found is None:
        return data.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
with whole as (select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
scored as (select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
  from whole q join whole c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % 50 = 0),
ranked as (select query_id, vec_id, score, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 5"""
