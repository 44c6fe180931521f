"""Helpers shared by the corpus operators: Spark plumbing and vectorised word handling."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.session import written

BROADCAST_BYTES = 24 << 20
SLICE_CHARS = 2 << 20
U64 = np.uint64


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def estimated_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint for a *written* frame whose files, times the usual unpacking, fit ``limit``.

    Beyond it the frame is returned as it is and Spark shuffles both sides; results are equal.
    """
    return F.broadcast(df) if estimated_bytes(df) * 3 <= limit else df


def text_key() -> Column:
    """Tells rows apart that share a doc_id but not their text."""
    return F.xxhash64("text")


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each slice holds about ``most`` bytes of text, or a single row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LONG_WORD = 64


class Words:
    """The words (runs without ASCII white space) of the texts of one slice.

    ``offsets[i]:offsets[i + 1]`` are the words of text i; ``start`` and ``length`` are bytes of ``data``.
    A null text has no words. ``between`` tells which bytes stand between words, white space if not given.
    """

    def __init__(self, texts: pa.Array, between: np.ndarray = SPACE):
        texts = pc.fill_null(texts, "")
        if pa.types.is_large_string(texts.type):
            texts = texts.cast(pa.string())
        edges = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset: texts.offset + len(texts) + 1].astype(np.int64)
        size = int(edges[-1] - edges[0])
        self.data = np.zeros(size + 8, np.uint8)
        if size:
            self.data[:size] = np.frombuffer(texts.buffers()[2], np.uint8)[edges[0]: edges[-1]]
        self.edges = edges - edges[0]
        inside = ~between[self.data[:size]]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        cuts = self.edges[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < size)]
        first[cuts] = inside[cuts]
        last[cuts - 1] = inside[cuts - 1]
        self.start = np.flatnonzero(first)
        self.length = np.flatnonzero(last) + 1 - self.start
        self.offsets = np.searchsorted(self.start, self.edges)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word, eight bytes at a time."""
        lanes = np.ndarray((max(1, len(self.data) - 7),), "<u8", self.data, strides=(1,))
        out = self.length.astype(U64) * U64(0x9E3779B97F4A7C15)
        live, at, left = np.arange(len(out)), self.start, self.length
        long = self.length > LONG_WORD
        if long.any():
            raw = self.data.tobytes()
            for i in np.flatnonzero(long):
                out[i] = xxhash.xxh3_64_intdigest(raw[self.start[i]: self.start[i] + self.length[i]])
            keep = ~long
            live, at, left = live[keep], at[keep], left[keep]
        while len(live):
            lane = lanes[at] & (U64(0xFFFFFFFFFFFFFFFF) >> (U64(8) * (8 - np.minimum(left, 8)).astype(U64)))
            out[live] = mixed((out[live] ^ lane) * U64(0xD6E8FEB86659FD93))
            more = left > 8
            live, at, left = live[more], at[more] + 8, left[more] - 8
        return out

    def of(self, i: int) -> bytes:
        return self.data[self.edges[i]: self.edges[i + 1]].tobytes()


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit over all others."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


class Rolling:
    """Hashes of any run of words from prefix sums of ``hash * base**i``; ``base`` is odd, so it has an inverse."""

    def __init__(self, hashes: np.ndarray, base: int = 0x9E3779B97F4A7C15):
        n = len(hashes) + 1
        self.down = _powers(pow(base, -1, 1 << 64), n)
        self.sums = np.concatenate([np.zeros(1, U64), np.cumsum(hashes * _powers(base, n)[:-1], dtype=U64)])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        """Hash of ``length`` words (a number or one per start) from each start."""
        end = start + length
        raw = (self.sums[end] - self.sums[start]) * self.down[start]
        return mixed(raw + np.asarray(length).astype(U64) * U64(0x165667B19E3779F9))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


def spread(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return np.repeat(values, counts)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, ...`` for each i, one after the other."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) - np.repeat(first - starts, counts)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def keyed_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Groups of rows with equal keys from batches that are sorted by them."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        part = pa.Table.from_batches([batch])
        columns = [part.column(k).combine_chunks() for k in keys]
        change = np.zeros(part.num_rows, bool)
        for c in columns:
            v = c.to_numpy(zero_copy_only=False)
            change[1:] |= v[1:] != v[:-1]
        first = tuple(c[0].as_py() for c in columns)
        if held and first != last:
            yield pa.concat_tables(held)
            held = []
        edges = [0, *np.flatnonzero(change).tolist(), part.num_rows]
        for a, b in zip(edges, edges[1:], strict=False):
            if a and held:
                yield pa.concat_tables(held)
                held = []
            held.append(part.slice(a, b - a))
        last = tuple(c[-1].as_py() for c in columns)
    if held:
        yield pa.concat_tables(held)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups, about a batch each, from batches sorted by ``keys``, and where their groups start."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        new = np.zeros(table.num_rows, bool)
        new[0] = True
        for k in keys:
            v = table.column(k).to_numpy()
            new[1:] |= v[1:] != v[:-1]
        starts = np.flatnonzero(new)
        if starts[-1]:
            yield table.slice(0, starts[-1]), starts[:-1]
        held = table.slice(starts[-1])
    if held is not None:
        yield held, np.zeros(1, np.int64)


def pairs_in_groups(starts: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Every two rows of a group, for all groups at once; meant for groups of bounded size."""
    size = np.diff(np.append(starts, rows))
    left = np.repeat(starts + size, size) - np.arange(rows) - 1
    return np.repeat(np.arange(rows), left), ranges(np.arange(rows) + 1, left)


def by_group(df: DataFrame, keys: list[str], fn: Callable[[pa.Table], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``fn`` for each group of rows with equal, non-null keys, many small groups to a task.

    ``applyInPandas`` costs about a millisecond a group; here groups are cut from sorted batches.
    """

    def run(batches):
        for group in keyed_groups(batches, keys):
            out = fn(group)
            if out is not None and out.num_rows:
                yield out

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def in_blocks(df: DataFrame, group: str, ident: str, size: str, block_rows: int) -> DataFrame:
    """Units that hold two blocks of a group each, so that every pair of a group meets in a unit.

    A group of ``size`` rows has ceil(size / block_rows) blocks by the hash of ``ident``; a row goes to
    as many units, never to all other rows. Adds ``unit_a <= unit_b`` and the row's own ``block``.
    """
    blocks = F.ceil(F.col(size) / block_rows).cast("int")
    own = F.pmod(F.xxhash64(ident, F.lit(7)), blocks).cast("int")
    return (
        df.withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("unit_a", F.least("block", "other"))
        .withColumn("unit_b", F.greatest("block", "other"))
        .drop("other")
    )


def components(edges: DataFrame, label: str) -> DataFrame:
    """Connected groups of ``edges`` (a long, b long): ``node``, ``root`` (smallest node of its group).

    Large-star and small-star rounds; every round is written, so nothing is kept on executors, and nothing is collected but
    whether a round is the last: each node has one edge then, and no node with an edge is the end of another's.
    """
    state = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    while True:
        several = state.groupBy("a").count().where("count > 1").select("a")
        inner = state.select("a").join(state.select(F.col("b").alias("a")).distinct(), "a", "left_semi")
        if several.union(inner).isEmpty():
            break
        both = state.union(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.where("a <> b").distinct(), label)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small_star = large.join(least, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        ).select("e.*").where("a <> b").distinct()
        state = written(small_star, label)
    return state.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def local_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the links a-b, as many as join what they join: each node of a link with its group's smallest node."""
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = index[: len(a)], index[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]
