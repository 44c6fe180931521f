"""Approximate nearest neighbours by cosine: cross-polytope hashing over Hadamard pseudo-rotations, probed in many tables.

A hash function flips signs and applies the fast Hadamard transform three times, then takes the signed axis nearest to the
turned vector. In each table the first functions name a *unit* of about ``UNIT_ROWS`` vectors and one more a code within it. A query asks,
in each table, for the ``probes`` (unit, code) pairs of the smallest summed squared gaps to its own axes; the vectors found there are ranked by
their exact cosines. ``probes`` is calibrated on ``SAMPLE`` queries against all vectors: the fewest that find ``TARGET``
of their true neighbours. Every vector is indexed, nothing is capped: units with many vectors or queries are cut into
blocks that meet each other.

Equal vectors are one class with its k + 1 smallest ids, more of which can't be among anyone's k nearest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotwise.llm.common import by_group, small
from slotwise.session import written

TABLES = 8
UNIT_ROWS = 512
#: Codes within a unit are bits of a long.
MOST_CODES = 64
BLOCK_ROWS, BLOCK_QUERIES = 4096, 4096
SAMPLE, TARGET = 128, 0.97
SEED = 11
STEP = 256


def usable(vectors: DataFrame, ident: str, vector: str) -> DataFrame:
    """(vec_id, v): finite vectors that are not all zero, with an id; repeated rows once."""
    x = F.col(vector)
    whole = x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    rows = vectors.where(F.col(ident).isNotNull() & whole & F.exists(x, lambda c: c != 0))
    return rows.select(F.col(ident).cast("long").alias("vec_id"), F.transform(x, lambda c: c.cast("double")).alias("v")).distinct()


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Vectors of a packed column: four bytes a component where that is exact, else eight."""
    out = np.empty((len(column), width))
    for i, x in enumerate(column.to_pylist()):
        out[i] = np.frombuffer(x, np.float32 if len(x) == 4 * width else np.float64)
    return out


def packed(v: np.ndarray) -> pa.Array:
    with np.errstate(over="ignore"):
        short = v.astype(np.float32)
    exact = (short == v).all(axis=1)
    return pa.array([(short if e else v)[i].tobytes() for i, e in enumerate(exact.tolist())], pa.binary())


def even(v: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that squares neither overflow nor vanish; their cosines are the same."""
    return np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1])


def lengths(v: np.ndarray) -> np.ndarray:
    return np.sqrt((v * v).sum(axis=1))


class Hashes:
    """The functions of all tables for vectors of one width."""

    def __init__(self, width: int, rows: int, tables: int = TABLES):
        self.width, self.tables = width, tables
        self.size = 1 << (width - 1).bit_length()
        self.axes, left = [], rows // UNIT_ROWS
        while left >= 2:
            axes = min(self.size, 1 << (left.bit_length() - 2))
            self.axes.append(axes)
            left = left // (2 * axes) if axes == self.size else 0
        self.axes.append(min(self.size, MOST_CODES // 2))
        self.buckets = int(np.prod([2 * a for a in self.axes], dtype=object))

    def turned(self, v: np.ndarray, table: int, function: int) -> np.ndarray:
        """Pseudo-rotated unit vectors, the signed axes of a function side by side."""
        signs = np.random.default_rng([SEED, self.size, table, function]).choice([-1.0, 1.0], (3, self.size))
        out = np.zeros((len(v), self.size))
        out[:, : self.width] = v
        for s in signs:
            out *= s
            half = 1
            while half < self.size:
                parts = out.reshape(len(v), -1, 2, half)
                out = np.concatenate([parts[:, :, :1] + parts[:, :, 1:], parts[:, :, :1] - parts[:, :, 1:]], axis=2).reshape(len(v), self.size)
                half *= 2
            out /= np.sqrt(self.size)
        out = out[:, : self.axes[function]]
        return np.concatenate([out, -out], axis=1)

    def codes(self, v: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        """Unit and code of unit vectors."""
        unit = np.zeros(len(v), np.int64)
        for f, axes in enumerate(self.axes[:-1]):
            unit = unit * (2 * axes) + self.turned(v, table, f).argmax(axis=1)
        return unit, self.turned(v, table, len(self.axes) - 1).argmax(axis=1)

    def probes(self, v: np.ndarray, table: int, count: int) -> np.ndarray:
        """The ``count`` best buckets (unit * codes + code) of each unit vector, best first; all if there are fewer."""
        total = bucket = None
        for f, axes in enumerate(self.axes):
            y = self.turned(v, table, f)
            gap = (y.max(axis=1, keepdims=True) - y) ** 2
            own = np.broadcast_to(np.arange(2 * axes), gap.shape)
            if total is None:
                total, bucket = gap, own
            else:
                total = (total[:, :, None] + gap[:, None, :]).reshape(len(v), -1)
                bucket = (bucket[:, :, None] * (2 * axes) + own[:, None, :]).reshape(len(v), -1)
            if total.shape[1] > count:
                near = np.argpartition(total, count - 1, axis=1)[:, :count]
                # Of equally good buckets at the rim the smaller ones are taken, whatever the partition takes.
                rim = np.take_along_axis(total, near, 1).max(axis=1, keepdims=True)
                tied = np.flatnonzero((total <= rim).sum(axis=1) > count)
                near[tied] = np.lexsort((bucket[tied], total[tied]), axis=1)[:, :count]
                total, bucket = np.take_along_axis(total, near, 1), np.take_along_axis(bucket, near, 1)
        order = np.lexsort((bucket, total), axis=1)
        return np.take_along_axis(bucket, order, 1)


def _unit_vectors(v: np.ndarray) -> np.ndarray:
    v = even(v)
    return v / lengths(v)[:, None]


def _top(q: np.ndarray, x: np.ndarray, first: np.ndarray, k: int, met: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, vector row, cosine) of the k nearest of ``x`` for each of ``q`` among those it has met, ties to the smaller ``first``.

    A product of matrices finds who comes near; cosines are then summed one pair at a time, so equal vectors get equal scores everywhere.
    """
    n_q, n_x = lengths(q), lengths(x)
    rough = (q @ x.T) / (n_q[:, None] * n_x[None, :])
    if met is not None:
        rough[~met] = -2
    if rough.shape[1] > k:
        least = -np.partition(-rough, k - 1, axis=1)[:, k - 1]
    else:
        least = np.full(len(q), -1.5)
    i, j = np.nonzero((rough >= least[:, None] - 1e-9) & (rough > -1.5))
    score = (q[i] * x[j]).sum(axis=1) / (n_q[i] * n_x[j])
    order = np.lexsort((first[j], -score, i))
    i, j, score = i[order], j[order], score[order]
    rank = np.arange(len(i)) - np.searchsorted(i, i)
    return i[rank < k], j[rank < k], score[rank < k]


def classes_of(data: DataFrame, k: int) -> DataFrame:
    """(c, v, first, ids): distinct vectors with their k + 1 smallest ids."""
    order = Window.partitionBy("v").orderBy("vec_id")
    least = data.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    out = least.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return written(out.select(F.monotonically_increasing_id().alias("c"), "v", F.get("ids", F.lit(0)).alias("first"), "ids"), "vector-classes")


def _calibrated(hashes: Hashes, asked: DataFrame, classes: DataFrame, k: int) -> int:
    """The fewest probes a table that find ``TARGET`` of the k nearest other classes of a bounded sample of queries."""
    sample = asked.select("first", "c", "v").orderBy(F.xxhash64("first"), "first", "v").limit(SAMPLE).collect()
    if not sample:
        return 1
    own, queries = np.array([r.c for r in sample]), even(np.array([r.v for r in sample]))

    def nearest(batches: Iterator[pa.RecordBatch]):
        held = None
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                v = part.column("v").flatten().to_numpy().reshape(part.num_rows, -1)
                c, first = part.column("c").to_numpy(), part.column("first").to_numpy()
                i, j, score = _top(queries, even(v), first, k, own[:, None] != c[None, :])
                more = (i, first[j], score, v[j])
                held = more if held is None else tuple(np.concatenate([a, b]) for a, b in zip(held, more, strict=True))
                order = np.lexsort((held[1], -held[2], held[0]))
                held = tuple(a[order] for a in held)
                rank = np.arange(len(order)) - np.searchsorted(held[0], held[0])
                held = tuple(a[rank < k] for a in held)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in held[:3]] + [pa.array(list(held[3]))], ["i", "first", "score", "v"])

    near = classes.select("c", "first", "v").mapInArrow(nearest, "i long, first long, score double, v array<double>")
    order = Window.partitionBy("i").orderBy(F.desc("score"), "first")
    rows = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("i", "v").collect()  # at most SAMPLE * k
    if not rows:
        return 1
    which, x = np.array([r.i for r in rows]), _unit_vectors(np.array([r.v for r in rows]))
    queries = _unit_vectors(queries)
    count = 64
    while True:
        rank = np.full(len(rows), count, np.int64)
        for t in range(hashes.tables):
            unit, code = hashes.codes(x, t)
            wanted = unit * (2 * hashes.axes[-1]) + code
            for i in range(len(queries)):
                mine = np.flatnonzero(which == i)
                hit = hashes.probes(queries[i: i + 1], t, count)[0][None, :] == wanted[mine][:, None]
                rank[mine] = np.minimum(rank[mine], np.where(hit.any(axis=1), hit.argmax(axis=1), count))
        need = int(np.sort(rank)[int(np.ceil(TARGET * len(rank))) - 1]) + 1
        if need <= count or count >= hashes.buckets:
            return min(need, count)
        count *= 4


def _indexed(classes: DataFrame, hashes: Hashes) -> DataFrame:
    """(t, unit, c, first, v, mask): every class in every table; its code as a bit."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                v = part.column("v").flatten().to_numpy().reshape(part.num_rows, -1)
                turned, bits = _unit_vectors(v), packed(v)
                for t in range(hashes.tables):
                    unit, code = hashes.codes(turned, t)
                    mask = np.left_shift(np.uint64(1), code.astype(np.uint64)).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), t, np.int32)), pa.array(unit), part.column("c"), part.column("first"), bits, pa.array(mask)], ["t", "unit", "c", "first", "v", "mask"])

    return classes.select("c", "first", "v").mapInArrow(run, "t int, unit long, c long, first long, v binary, mask long")


def _probed(asked: DataFrame, hashes: Hashes, count: int) -> DataFrame:
    """(t, unit, c, first, v, mask): a row for each unit that a query looks into, with the codes it wants there."""
    codes = 2 * hashes.axes[-1]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 32):
                part = batch.slice(at, 32)
                v = part.column("v").flatten().to_numpy().reshape(part.num_rows, -1)
                turned, bits = _unit_vectors(v), packed(v)
                for t in range(hashes.tables):
                    bucket = hashes.probes(turned, t, count)
                    row = np.repeat(np.arange(len(v)), bucket.shape[1])
                    unit, code = np.divmod(bucket.reshape(-1), codes)
                    order = np.lexsort((unit, row))
                    row, unit, bit = row[order], unit[order], np.left_shift(np.uint64(1), code[order].astype(np.uint64))
                    start = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (unit[1:] != unit[:-1])))
                    mask = np.bitwise_or.reduceat(bit, start).view(np.int64)
                    rows = pa.array(row[start])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(start), t, np.int32)), pa.array(unit[start]), part.column("c").take(rows), part.column("first").take(rows), bits.take(rows), pa.array(mask)],
                        ["t", "unit", "c", "first", "v", "mask"])

    return asked.select("c", "first", "v").mapInArrow(run, "t int, unit long, c long, first long, v binary, mask long")


def _blocked(rows: DataFrame, large: DataFrame, own: str, other: str) -> DataFrame:
    """Rows of large units dealt to one of ``own`` blocks and sent to all of ``other``."""
    known = rows.join(large, ["t", "unit"], "left").withColumns({c: F.coalesce(c, F.lit(1)) for c in (own, other)})
    return known.withColumn(own, F.pmod(F.xxhash64("c"), F.col(own)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))


def _one_width(classes: DataFrame, asked: DataFrame, width: int, rows: int, k: int, everywhere: bool = False) -> DataFrame:
    """(q, c, first, score): for each asked class the k + 1 nearest classes of each block of each unit it looks into.

    ``everywhere``: it looks into all buckets of one table, so nothing is left out.
    """
    hashes = Hashes(width, rows, 1 if everywhere else TABLES)
    count = hashes.buckets if everywhere else _calibrated(hashes, asked, classes, k)
    index, queries = _indexed(classes, hashes), _probed(asked, hashes, count)
    n_rows = index.groupBy("t", "unit").agg(F.count("*").alias("rows")).where(F.col("rows") > BLOCK_ROWS)
    queries = written(queries, "probes")
    n_queries = queries.groupBy("t", "unit").agg(F.count("*").alias("queries")).where(F.col("queries") > BLOCK_QUERIES)
    blocks = [F.ceil(F.coalesce(c, F.lit(1)) / most).cast("int").alias(name) for c, most, name in (("rows", BLOCK_ROWS, "part"), ("queries", BLOCK_QUERIES, "chunk"))]
    large = small(written(n_rows.join(n_queries, ["t", "unit"], "full").select("t", "unit", *blocks), "large-units"))
    keys = ["t", "unit", "part", "chunk"]
    left = _blocked(queries, large, "chunk", "part").withColumn("is_query", F.lit(True))
    right = _blocked(index, large, "part", "chunk").withColumn("is_query", F.lit(False))

    def unit(group: pa.Table) -> pa.RecordBatch | None:
        asks = group.column("is_query").to_numpy()
        if asks.all() or not asks.any():
            return None
        v, mask = even(matrix(group.column("v"), width)), group.column("mask").to_numpy()
        c, first = group.column("c").to_numpy(), group.column("first").to_numpy()
        q, x = np.flatnonzero(asks), np.flatnonzero(~asks)
        out = []
        for at in range(0, len(q), STEP):
            own = q[at: at + STEP]
            i, j, score = _top(v[own], v[x], first[x], k + 1, (mask[own][:, None] & mask[x][None, :]) != 0)
            out.append((c[own[i]], c[x[j]], first[x[j]], score))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)) for a in zip(*out, strict=True)], ["q", "c", "first", "score"])

    names = [*keys, "is_query", "c", "first", "v", "mask"]
    return by_group(left.select(names).union(right.select(names)), keys, unit, "q long, c long, first long, score double")


def nearest(vectors: DataFrame, wanted: Column, k: int = 5, ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found by cosine, for each row that ``wanted`` (on ``vec_id``) takes.

    Candidates are all rows but those of the query's own id; a query whose probes meet fewer than k looks into all buckets, so
    it gets k, or all there are; ties go to the smaller vec_id. Vectors that are null, empty, zero or hold nulls, NaN or infinities and rows without an id take no part. Vectors of
    different length have no cosine and are searched apart. Repeated rows count once; an id with several vectors
    is one candidate with its best score, and as a query has the vector of the smallest components. Other columns are ignored; an
    empty table gives no rows. Scores are exact, which neighbours are found is not: recall is calibrated to ``TARGET`` and tested.
    """
    data = written(usable(vectors, ident, vector), "vectors")
    classes = classes_of(data, k)
    own = data.where(wanted).groupBy("vec_id").agg(F.min("v").alias("v")).withColumnRenamed("vec_id", "query_id")
    own = written(own.join(classes.select("c", "v"), "v").select("query_id", F.col("c").alias("q")), "queries")
    asked = written(classes.join(own.select(F.col("q").alias("c")).distinct(), "c", "left_semi"), "asked")
    widths = classes.groupBy(F.size("v").alias("width")).count().collect()  # a row per vector length
    if not widths:
        return data.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    def searched(asked: DataFrame, everywhere: bool) -> DataFrame:
        found = None
        for width, rows in widths:
            of = F.size("v") == width
            one = _one_width(classes.where(of), asked.where(of), width, rows, k, everywhere)
            found = one if found is None else found.union(one)
        once = found.groupBy("q", "c").agg(F.max("score").alias("score"), F.min("first").alias("first"))
        order = Window.partitionBy("q").orderBy(F.desc("score"), "first", "c")
        best = once.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1).join(classes.select("c", "ids"), "c")
        best = small(written(best.select("q", "score", "ids"), "best-classes"))
        pairs = own.join(best, "q").select("query_id", "q", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
        return pairs.groupBy("query_id", "q", "vec_id").agg(F.max("score").alias("score"))

    pairs = written(searched(asked, False), "neighbours")
    # Queries that met fewer than k candidates look everywhere.
    few = pairs.groupBy("query_id").count().where(F.col("count") < k).select("query_id")
    few = own.join(pairs.select("query_id").distinct(), "query_id", "left_anti").select("query_id").union(few)
    few = written(own.join(few, "query_id", "left_semi").select(F.col("q").alias("c")).distinct(), "few-met")
    if not few.isEmpty():
        more = searched(asked.join(few, "c", "left_semi"), True)
        pairs = pairs.union(more).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
