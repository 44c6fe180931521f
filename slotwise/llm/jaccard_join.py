"""Self join of documents on the Jaccard similarity of word n-grams, with Bayesian pruning of MinHash candidates.

1. Documents with the same set of n-grams are one class; only classes are compared.
2. MinHash values in bands propose candidates: at similarity 0.8 a pair shares none of 32 bands of 4 with probability 5e-8.
   Buckets with the same members are looked at once.
3. Candidates compare their values 16 at a time. With a uniform prior the posterior after m of n equal values is
   Beta(m + 1, n - m + 1); a pair is dropped as soon as P(similarity >= threshold) falls below the tolerance.
4. What is left joins classes to clusters, and within a cluster every pair is verified by its exact intersection.

Nothing here emits the pairs of a group: buckets and clusters are cut into blocks, two blocks meet in a unit, and
a unit gives counts of links and a spanning forest, at most one row for each of its members.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import U64, Rolling, Words, by_group, components, in_blocks, local_forest, mixed, ranges, signed, slices, small, text_key
from slotwise.session import written

GRAM = 5
THRESHOLD = 0.8
BANDS, BAND_ROWS = 32, 4
VALUES = BANDS * BAND_ROWS
STEP = 16
TOLERANCE = 1e-9
BUCKET_BLOCK = 512
VERIFY_BLOCK = 128
COLUMNS = 8192

_SEEDS = mixed(np.arange(1, 2 * VALUES + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word n-grams of all texts, and how many each has; a text of fewer words is one n-gram, none has none."""
    hashes = words.hashes()
    first, size = words.offsets[:-1], np.diff(words.offsets)
    count = np.where(size == 0, 0, np.maximum(size - n + 1, 1))
    starts = ranges(first, count)
    return Rolling(hashes).of(starts, np.minimum(np.repeat(size, count), n)), count


def minhashes(grams: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``VALUES`` 32-bit minima for each text; texts without n-grams get the largest value."""
    out = np.full((len(count), VALUES), 0xFFFFFFFF, np.uint32)
    some = np.flatnonzero(count)
    if len(some):
        first = (np.cumsum(count) - count)[some]
        for k in range(VALUES):
            low = np.minimum.reduceat((grams ^ _SEEDS[2 * k]) * (_SEEDS[2 * k + 1] | U64(1)), first)
            out[some, k] = (low >> U64(32)).astype(np.uint32)
    return out


def signed_documents(docs: DataFrame, n: int) -> DataFrame:
    schema = "doc_id long, tk long, s long, n int, sig binary"

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                grams, count = shingles(Words(part.column("text")), n)
                sigs = minhashes(grams, count)
                ends = np.cumsum(count)
                size, key = np.zeros(len(count), np.int32), np.zeros(len(count), U64)
                for i, (c, e) in enumerate(zip(count.tolist(), ends.tolist(), strict=True)):
                    own = np.unique(grams[e - c: e])
                    size[i] = len(own)
                    # Sum of well mixed values: the same for the same set, whatever the order.
                    key[i] = mixed(own ^ _SEEDS[0]).sum(dtype=U64) if c else 0
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("tk"), pa.array(signed(mixed(key))), pa.array(size), pa.array([s.tobytes() for s in sigs], pa.binary())],
                    ["doc_id", "tk", "s", "n", "sig"],
                )

    return docs.select("doc_id", "text", "tk").mapInArrow(run, schema)


def _matrix(column, kind=np.uint32) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def bands(classes: DataFrame) -> DataFrame:
    """(key, s) for each band of each class."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = _matrix(batch.column("sig")).reshape(batch.num_rows, BANDS, BAND_ROWS).astype(U64)
            key = np.broadcast_to(_SEEDS[:BANDS], parts.shape[:2]).copy()
            for r in range(BAND_ROWS):
                key = mixed(key ^ (parts[:, :, r] + U64(r + 1)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(key.reshape(-1))), batch.column("s").take(pa.array(np.repeat(np.arange(batch.num_rows), BANDS)))], ["key", "s"])

    return classes.where("n > 0").select("s", "sig").mapInArrow(run, "key long, s long")


def needed(threshold: float, tolerance: float = TOLERANCE) -> list[int]:
    """Equal values a pair must have after each number of compared values to stay.

    P(similarity >= t | m of n) under Beta(m + 1, n - m + 1) is P(Binomial(n + 1, t) <= m).
    """
    out = [0]
    for n in range(1, VALUES + 1):
        total, m = 0.0, 0
        while True:
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if total >= tolerance or m == n:
                break
            m += 1
        out.append(m)
    return out


def _survivors(left: np.ndarray, right: np.ndarray, own: bool, need: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of two signature blocks (or of one with itself) that no step drops."""
    found_a, found_b = [], []
    for i in range(len(left)):
        live = np.arange(i + 1 if own else 0, len(right))
        agree = np.zeros(len(live), np.int64)
        for at in range(0, VALUES, STEP):
            if not len(live):
                break
            agree = agree + (right[live, at: at + STEP] == left[i, at: at + STEP]).sum(axis=1)
            keep = agree >= need[at + STEP]
            live, agree = live[keep], agree[keep]
        found_a.append(np.full(len(live), i))
        found_b.append(live)
    return np.concatenate(found_a), np.concatenate(found_b)


def _two_blocks(group: pa.Table) -> tuple[bool, np.ndarray, np.ndarray]:
    """Whether a unit is one block with itself, and the rows of its first and second block, each class once."""
    a, b = group.column("unit_a")[0].as_py(), group.column("unit_b")[0].as_py()
    block = group.column("block").to_numpy()
    once = np.zeros(group.num_rows, bool)
    once[np.unique(group.column("s").to_numpy(), return_index=True)[1]] = True
    return a == b, np.flatnonzero((block == a) & once), np.flatnonzero((block == b) & once)


def candidate_links(classes: DataFrame, threshold: float) -> DataFrame:
    """A spanning forest (a, b) of the candidate pairs that Bayesian pruning leaves."""
    need = needed(threshold)
    banded = bands(classes)
    buckets = banded.groupBy("key").agg(F.count("*").alias("size"), F.min("s").alias("lo"), F.max("s").alias("hi"), F.bit_xor("s").alias("all")).where("size > 1")
    buckets = written(buckets.groupBy("size", "lo", "hi", "all").agg(F.min("key").alias("key")).select("key", "size"), "buckets")
    members = banded.join(buckets, "key").join(classes.select("s", "sig"), "s")

    def unit(group: pa.Table):
        own, left, right = _two_blocks(group)
        if len(left) + (0 if own else len(right)) < 2 or not len(left) or not len(right):
            return None
        s, sig = group.column("s").to_numpy(), _matrix(group.column("sig"))
        a, b = _survivors(sig[left], sig[right], own, need)
        x, y = local_forest(s[left][a], s[right][b])
        return pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["a", "b"])

    cut = in_blocks(members, "key", "s", "size", BUCKET_BLOCK).select("key", "unit_a", "unit_b", "block", "s", "sig")
    return by_group(cut, ["key", "unit_a", "unit_b"], unit, "a long, b long")


def _intersections(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of each left set with each right set, from an incidence matrix in column blocks."""
    who = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    who, column = who[shared], np.cumsum(times > 1)[column[shared]] - 1
    order = np.argsort(column, kind="stable")
    who, column = who[order], column[order]
    out = np.zeros((len(left), len(right)), np.float64)
    for at in range(0, int((times > 1).sum()), COLUMNS):
        lo, hi = np.searchsorted(column, [at, at + COLUMNS])
        dense = np.zeros((len(sets), COLUMNS), np.float32)
        dense[who[lo:hi], column[lo:hi] - at] = 1
        out += dense[left] @ dense[right].T
    return out.astype(np.int64)


def verified_links(docs: DataFrame, clusters: DataFrame, n: int, threshold: float) -> DataFrame:
    """(s, links, parent): for each unit a class is in, its links found there and its parent in their spanning forest.

    ``clusters``: s, root, size and the doc_id and tk of a document of the class.
    """

    def sets(batches):
        for batch in batches:
            for part in slices(batch):
                grams, count = shingles(Words(part.column("text")), n)
                ends = np.cumsum(count)
                own = [signed(np.unique(grams[e - c: e])) for c, e in zip(count.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("s"), part.column("root"), part.column("size"), pa.array([x.tobytes() for x in own], pa.binary())], ["s", "root", "size", "grams"])

    def unit(group: pa.Table):
        own, left, right = _two_blocks(group)
        if not len(left) or not len(right) or (own and len(left) < 2):
            return None
        s = group.column("s").to_numpy()
        held = [np.frombuffer(x, np.int64) for x in group.column("grams").to_pylist()]
        size = np.array([len(x) for x in held])
        both = _intersections(held, left, right)
        union = size[left][:, None] + size[right][None, :] - both
        linked = both >= threshold * union - 1e-9
        if own:
            linked &= np.triu(np.ones_like(linked), 1)
        a, b = np.nonzero(linked)
        if not len(a):
            return None
        nodes, times = np.unique(np.concatenate([s[left][a], s[right][b]]), return_counts=True)
        child, parent = local_forest(s[left][a], s[right][b])
        above = dict(zip(child.tolist(), parent.tolist(), strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes), pa.array(times.astype(np.int64)), pa.array([above.get(x) for x in nodes.tolist()], pa.int64())], ["s", "links", "parent"])

    texts = docs.select("doc_id", "text", "tk").join(clusters, ["doc_id", "tk"]).select("text", "s", "root", "size")
    held = texts.mapInArrow(sets, "s long, root long, size long, grams binary")
    cut = in_blocks(held, "root", "s", "size", VERIFY_BLOCK).select("root", "unit_a", "unit_b", "block", "s", "grams")
    return by_group(cut, ["root", "unit_a", "unit_b"], unit, "s long, links long, parent long")


def near_duplicates(docs: DataFrame, n: int = GRAM, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): class_id, group_id, n_links.

    ``class_id`` is the smallest doc_id whose text has the same set of word n-grams, ``n_links`` the number of other
    classes of similarity ``threshold`` or more, ``group_id`` the smallest doc_id of all that links connect. Words are
    runs without ASCII white space; a text of 1 to n - 1 words is a single n-gram. Null, empty and blank texts share one
    class without links. Rows without doc_id are left out; rows that repeat a doc_id are answered each, by their own
    text. Other columns are ignored; an empty table gives no rows.
    """
    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("tk", text_key())
    signed_rows = written(signed_documents(rows, n), "signatures")
    classes = written(signed_rows.groupBy("s").agg(
        F.min("doc_id").alias("class_id"), F.min_by("tk", "doc_id").alias("tk"), F.first("n").alias("n"), F.first("sig").alias("sig")), "classes")
    clusters = components(candidate_links(classes, threshold), "clusters")
    sizes = clusters.groupBy("root").agg(F.count("*").alias("size"))
    clusters = (
        clusters.join(sizes, "root").withColumnRenamed("node", "s")
        .join(classes.select("s", F.col("class_id").alias("doc_id"), "tk"), "s")
    )
    links = written(verified_links(rows, small(written(clusters, "cluster-texts")), n, threshold), "links")
    joined = components(links.where("parent is not null").select(F.col("s").alias("a"), F.col("parent").alias("b")), "groups")
    found = (
        links.groupBy("s").agg(F.sum("links").alias("links"))
        .join(joined.withColumnRenamed("node", "s"), "s").join(classes.select("s", "class_id"), "s")
    )
    groups = found.groupBy("root").agg(F.min("class_id").alias("group_id"))
    found = found.join(groups, "root").select("s", "links", "group_id")
    each = written(classes.select("s", "class_id").join(found, "s", "left").select(
        "s", "class_id", F.coalesce("group_id", "class_id").alias("group_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links")), "classified")
    return signed_rows.select("doc_id", "s").join(each, "s").select("doc_id", "class_id", "group_id", "n_links")


ORACLE = r"""
with recursive split as (select row_number() over () as row, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x09-\x0D\x20]+'), lambda x: x <> '') as w
  from documents where doc_id is not null),
grams as (select row, doc_id, list_sort(list_distinct(list_transform(range(1, case when len(w) = 0 then 1 else greatest(len(w) - 4, 1) + 1 end),
  lambda i: array_to_string(w[i:i + 4], ' ')))) as g from split),
classes as (select g, min(doc_id) as class_id from grams group by g),
keyed as (select row_number() over () as k, g, class_id from classes),
flat as (select k, len(g) as n, unnest(g) as x from keyed),
pairs as (select a.k as a, b.k as b from flat a join flat b on a.x = b.x and a.k < b.k group by a.k, b.k, a.n, b.n
  having count(*) >= 0.8 * (a.n + b.n - count(*)) - 1e-9),
links as (select a, b from pairs union all select b, a from pairs),
reach as (select k as a, k as b from keyed union select r.a, l.b from reach r join links l on r.b = l.a),
grouped as (select r.a as k, min(o.class_id) as group_id from reach r join keyed o on o.k = r.b group by r.a),
counted as (select a as k, count(*) as n_links from links group by a)
select grams.doc_id, keyed.class_id, grouped.group_id, coalesce(n_links, 0) as n_links
from grams join keyed using (g) join grouped using (k) left join counted using (k)"""
