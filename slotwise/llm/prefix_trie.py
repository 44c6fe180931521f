"""Prefix trie of conversations: balanced parentheses per shard, range min-max blocks over their excess, merged spines.

Conversations are paths of turn hashes; equal paths are one. Sorted paths, dealt to shards by range, are the trie in
depth-first order, so a shard writes its part as parentheses: ``(`` for each node it enters, ``)`` for each it
leaves. ``findclose`` over blocks of minimal excess delimits subtrees, ranks over ``()`` count leaves, and differences of cumulative arrays
give members and savings. Only the nodes on a path that two shards share (a shard's *spine*) are seen
by several shards. A shard counts of them what is its own: a node belongs to the first shard whose paths pass it, which a shard knows from
the last path before its first one. So all figures add up, and shared spines merge in one aggregation.

Saved tokens of a subtree are the bytes of all its members' turns less those of its distinct nodes, which adds up over shards, too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotwise.llm.common import keyed_groups, ranges, small, whole_groups
from slotwise.session import written

#: Bytes of a turn's hash in a path.
HASH = 16
#: Turns of a shard, about; a shard is worked on in memory.
SHARD_TURNS = 1 << 20
#: Ids of equal conversations that are put in order at a time.
CHUNK_IDS = 1 << 13
BLOCK = 64
EMPTY = hashlib.sha256(b"").hexdigest()


class Parentheses:
    """A balanced sequence with a tree of block minima over its excess."""

    def __init__(self, opens: np.ndarray):
        self.opens = opens
        self.excess = np.cumsum(np.where(opens, 1, -1))
        size = 1 << max(0, -(-len(opens) // BLOCK) - 1).bit_length()
        padded = np.full(size * BLOCK, np.iinfo(np.int64).max)
        padded[: len(opens)] = self.excess
        self.padded, self.size = padded, size
        #: Node i has the children 2i and 2i + 1; the leaves are the blocks.
        self.least = np.empty(2 * size, np.int64)
        self.least[size:] = padded.reshape(size, BLOCK).min(axis=1)
        low = size
        while low > 1:
            self.least[low // 2: low] = np.minimum(self.least[low: 2 * low: 2], self.least[low + 1: 2 * low: 2])
            low //= 2

    def _scan(self, at: np.ndarray, stop: np.ndarray, goal: np.ndarray) -> np.ndarray:
        """The first place from ``at`` on, before ``stop``, of an excess of at most ``goal``; -1 if there is none."""
        out = np.full(len(at), -1, np.int64)
        live = np.arange(len(at))
        at = at.copy()
        while len(live):
            inside = at[live] < stop[live]
            live = live[inside]
            hit = self.padded[at[live]] <= goal[live]
            out[live[hit]] = at[live[hit]]
            live = live[~hit]
            at[live] += 1
        return out

    def findclose(self, at: np.ndarray) -> np.ndarray:
        """Where the parentheses that open at ``at`` close."""
        goal = self.excess[at] - 1
        block = at // BLOCK
        out = self._scan(at + 1, (block + 1) * BLOCK, goal)
        live = np.flatnonzero(out < 0)
        node = block[live] + self.size
        # Up to the first right neighbour that goes as low, then down to its first block that does.
        up = np.ones(len(live), bool)
        while up.any():
            right = node | 1
            found = up & (node % 2 == 0) & (self.least[np.minimum(right, 2 * self.size - 1)] <= goal[live])
            node = np.where(found, right, np.where(up, node // 2, node))
            up &= ~found
        while (above := node < self.size).any():
            left = np.where(above, 2 * node, node)
            node = np.where(above, left + (self.least[left] > goal[live]), node)
        start = (node - self.size) * BLOCK
        out[live] = self._scan(start, start + BLOCK, goal[live])
        return out


def common_turns(a: bytes, b: bytes) -> int:
    """Turns that two paths begin with in common."""
    n = min(len(a), len(b)) // HASH
    x, y = (np.frombuffer(p, f"V{HASH}", n) for p in (a, b))
    different = np.flatnonzero(x != y)
    return int(different[0]) if len(different) else n


def _beginnings(paths: list[bytes], depth: np.ndarray) -> np.ndarray:
    """Turns that each path shares with the one before it, 0 for the first."""
    flat = np.frombuffer(b"".join(paths), "<u8").reshape(-1, HASH // 8)
    start = np.cumsum(depth) - depth
    n = np.minimum(depth[1:], depth[:-1])
    i, j = ranges(start[1:], n), ranges(start[:-1], n)
    same = (flat[i] == flat[j]).all(axis=1)
    owner, place = np.repeat(np.arange(len(n)), n), ranges(np.zeros(len(n), np.int64), n)
    out = n.copy()
    np.minimum.at(out, owner[~same], place[~same])
    return np.append(0, out)


class Shard:
    """The trie of sorted distinct paths: figures of each node that is the shard's own share.

    ``before`` and ``after`` are the paths next to the shard's own, None at the rim.
    """

    def __init__(self, paths: list[bytes], sizes: list[bytes], members: np.ndarray, first: np.ndarray, before: bytes | None, after: bytes | None):
        depth = np.array([len(p) // HASH for p in paths], np.int64)
        shared = _beginnings(paths, depth)
        #: New nodes of each path; the first also enters the root.
        new = depth - shared
        new[0] += 1
        self.owner = np.repeat(np.arange(len(paths)), new)
        base = shared + 1
        base[0] = 0
        self.depth = ranges(base, new)
        nodes = len(self.depth)
        text = np.frombuffer(b"".join(sizes), np.int64)
        at = np.cumsum(depth) - depth
        self.bytes = np.zeros(nodes, np.int64)
        inner = self.depth > 0
        self.bytes[inner] = text[at[self.owner[inner]] + self.depth[inner] - 1]

        closes = np.append(0, depth[:-1] - shared[1:])
        runs = np.stack([closes, new], axis=1).reshape(-1)
        opens = np.append(np.repeat(np.tile([False, True], len(paths)), runs), np.zeros(depth[-1] + 1, bool))
        tree = Parentheses(opens)
        place = np.flatnonzero(opens)
        stop = tree.findclose(place)
        #: Nodes of each subtree, in order of their openings.
        end = np.arange(nodes) + (stop - place + 1) // 2

        self.ends_at = np.cumsum(new) - 1
        own_members = np.zeros(nodes, np.int64)
        own_members[self.ends_at] = members
        least = np.full(nodes, np.iinfo(np.int64).max)
        least[self.ends_at] = first
        leaf = np.append(~opens[1:], False) & opens
        last = int(self.ends_at[-1])
        self.right = common_turns(paths[-1], after) if after is not None else -1
        if after is not None and self.right == depth[-1]:
            leaf[place[last]] = False
        leaves = np.concatenate([[0], np.cumsum(leaf)])

        self.left = common_turns(paths[0], before) if before is not None else -1
        own = np.ones(nodes, bool)
        own[: self.left + 1] = False
        self.parent = self._parents(nodes)
        #: Bytes of all members' turns from a node on, members' own path included.
        along = np.concatenate([[0], np.cumsum(self._member_bytes(own_members, end))])
        once = np.concatenate([[0], np.cumsum(np.where(own, self.bytes, 0))])
        index = np.arange(nodes)
        total = np.concatenate([[0], np.cumsum(own_members)])
        self.figures = {
            "n_convs": total[end] - total[index],
            "n_children": np.bincount(self.parent[own & inner], minlength=nodes),
            "n_leaves": leaves[stop + 1] - leaves[place],
            "saved_tokens": along[end] - along[index] - (once[end] - once[index]),
        }
        self.first = self._least(least)
        self.spine = np.zeros(nodes, bool)
        self.spine[: self.left + 1] = True
        if self.right >= 0:
            self.spine[self.way(len(paths) - 1)[: self.right + 1]] = True

    def _parents(self, nodes: int) -> np.ndarray:
        """The node before at a depth less by one: nearest opening on the way."""
        out = np.full(nodes, -1, np.int64)
        chain = np.flatnonzero(np.append(False, self.depth[1:] == self.depth[:-1] + 1))
        out[chain] = chain - 1
        rest = np.flatnonzero(out < 0)
        by_depth = np.lexsort((np.arange(nodes), self.depth))
        ordered = self.depth[by_depth] * nodes + by_depth
        at = np.searchsorted(ordered, (self.depth[rest] - 1) * nodes + rest) - 1
        out[rest] = np.where(self.depth[rest] > 0, by_depth[np.maximum(at, 0)], -1)
        return out

    def _member_bytes(self, members: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Bytes of a node's last text times the members that pass it."""
        total = np.concatenate([[0], np.cumsum(members)])
        return self.bytes * (total[end] - total[np.arange(len(end))])

    def _least(self, least: np.ndarray) -> np.ndarray:
        order = np.argsort(-self.depth, kind="stable")
        edges = np.flatnonzero(np.append(True, np.diff(self.depth[order]) != 0)).tolist()
        for a, b in zip(edges, [*edges[1:], len(order)], strict=True):
            at = order[a:b]
            at = at[self.parent[at] >= 0]
            np.minimum.at(least, self.parent[at], least[at])
        return least

    def way(self, path: int) -> np.ndarray:
        """Nodes from the root to the end of a path."""
        node, out = int(self.ends_at[path]), []
        while node >= 0:
            out.append(node)
            node = int(self.parent[node])
        return np.array(out[::-1], np.int64)


def turns_of(conversations: DataFrame) -> DataFrame:
    """(base, conv_id, turn, key, bytes): hashed turns; rows without conv_id belong to no conversation."""
    c = F.col("conv_id").cast("long")
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in ("role", "text"))
    # The role's length keeps "a" + "bc" apart from "ab" + "c".
    key = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    rows = conversations.where(c.isNotNull()).select(c.alias("conv_id"), F.col("turn").cast("long").alias("turn"), key.alias("key"), F.octet_length(text).cast("long").alias("bytes"))
    head = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(9)).cast("int")
    return rows.withColumn("base", F.col("conv_id") - F.col("conv_id") % 5).withColumn("head", head)


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, path, sizes): each conversation's turns after the first ``head`` follow so many of its base's.

    Turns stand in order of number (null first), equal numbers in order of their hash. Conversations of one base share
    a task; of a turn only hash and size travel.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        for table, starts in whole_groups(batches, ["base"]):
            base, conv = table.column("base").to_numpy(), table.column("conv_id").to_numpy()
            keys = np.frombuffer(b"".join(table.column("key").to_pylist()), f"V{HASH}")
            sizes, head = table.column("bytes").to_numpy(), table.column("head").to_numpy()
            group = np.searchsorted(starts, np.arange(len(conv)), side="right") - 1
            begin = np.flatnonzero(np.append(True, (conv[1:] != conv[:-1]) | (group[1:] != group[:-1])))
            count = np.diff(np.append(begin, len(conv)))
            # The base's own place in its group, nowhere if it has no turns.
            at = np.zeros(len(starts), np.int64)
            held = np.zeros(len(starts), np.int64)
            bases = np.flatnonzero(conv[begin] == base[begin])
            at[group[begin[bases]]], held[group[begin[bases]]] = begin[bases], count[bases]
            own_group, h = group[begin], head[begin].astype(np.int64)
            lent = np.minimum(h, held[own_group])
            rest = np.maximum(count - h, 0)
            rows = ranges(np.stack([at[own_group], begin + h], axis=1).reshape(-1), np.stack([lent, rest], axis=1).reshape(-1))
            edges = np.concatenate([[0], np.cumsum(lent + rest)])
            path, size = keys[rows].tobytes(), sizes[rows].tobytes()
            both = list(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(conv[begin]), pa.array([path[a * HASH: b * HASH] for a, b in both], pa.binary()), pa.array([size[a * 8: b * 8] for a, b in both], pa.binary())],
                ["conv_id", "path", "sizes"])

    order = [F.col("base"), F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("key"), F.col("bytes")]
    return turns.repartition("base").sortWithinPartitions(*order).mapInArrow(run, "conv_id long, path binary, sizes binary")


def sorted_shards(paths: DataFrame) -> DataFrame:
    """(shard, path, sizes, members, first, ends_sha256): distinct paths, each shard a range of them.

    Ids of equal conversations are put in order in chunks, and a chunk at a time is hashed.
    """
    turns = paths.agg(F.sum(F.octet_length("path"))).first()[0] or 0
    shards = max(paths.sparkSession.sparkContext.defaultParallelism, -(-turns // (HASH * SHARD_TURNS)))
    chunk = F.floor(F.col("conv_id") / CHUNK_IDS)
    ids = F.sort_array(F.collect_list("conv_id"))
    chunks = paths.groupBy("path", "sizes", chunk.alias("chunk")).agg(F.count("*").alias("members"), F.min("conv_id").alias("first"), ids.alias("ids"))
    chunks = chunks.withColumn("ids", F.array_join(F.transform("ids", lambda i: i.cast("string")), ","))

    def run(batches):
        held = None
        for batch in batches:
            out = []
            for path, sizes, members, first, ids in zip(*[batch.column(c).to_pylist() for c in ("path", "sizes", "members", "first", "ids")], strict=True):
                if held and held[0] == path:
                    held[2] += members
                    held[3] = min(held[3], first)
                    held[4].update(b"," + ids.encode())
                    continue
                if held:
                    out.append(held)
                held = [path, sizes, members, first, hashlib.sha256(ids.encode())]
            if out:
                yield _paths(out)
        if held:
            yield _paths([held])

    dealt = chunks.repartitionByRange(shards, "path").sortWithinPartitions("path", "chunk").select("path", "sizes", "members", "first", "ids")
    out = dealt.mapInArrow(run, "path binary, sizes binary, members long, first long, ends_sha256 string")
    return out.select(F.spark_partition_id().alias("shard"), "*")


def _paths(rows: list[list]) -> pa.RecordBatch:
    path, sizes, members, first, sha = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(path, pa.binary()), pa.array(sizes, pa.binary()), pa.array(members), pa.array(first), pa.array([s.hexdigest() for s in sha])],
        ["path", "sizes", "members", "first", "ends_sha256"])


FIGURES = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
NODE = "first long, depth long, parent_first long, " + ", ".join(f"{c} long" for c in FIGURES) + ", ends_sha256 string, spine binary, parent_spine binary"


def shard_nodes(shards: DataFrame) -> DataFrame:
    """Nodes of all shards. Those on a spine have its ``spine`` key and are parts; nodes right below one name it in ``parent_spine``."""
    rims = shards.groupBy("shard").agg(F.min("path").alias("lo"), F.max("path").alias("hi"))
    order = Window.orderBy("shard")  # a row per shard
    rims = rims.select("shard", F.lag("hi").over(order).alias("before"), F.lead("lo").over(order).alias("after"))
    rows = shards.join(small(written(rims, "shard-rims")), "shard")

    def nodes(group: pa.Table) -> pa.RecordBatch:
        paths = group.column("path").to_pylist()
        before, after = group.column("before")[0].as_py(), group.column("after")[0].as_py()
        shard = Shard(paths, group.column("sizes").to_pylist(), group.column("members").to_numpy(), group.column("first").to_numpy(), before, after)
        n = len(shard.depth)
        sha = np.full(n, EMPTY, object)
        sha[shard.ends_at] = group.column("ends_sha256").to_pylist()
        key = np.full(n + 1, None, object)
        for i in np.flatnonzero(shard.spine).tolist():
            key[i] = hashlib.blake2b(paths[shard.owner[i]][: shard.depth[i] * HASH], digest_size=16).digest()
        top = shard.parent
        parent = np.where(top >= 0, shard.first[top], -1)
        known = (top >= 0) & ~shard.spine[top]
        return pa.RecordBatch.from_arrays(
            [pa.array(shard.first), pa.array(shard.depth), pa.array(parent, mask=~known), *[pa.array(shard.figures[c].astype(np.int64)) for c in FIGURES],
             pa.array(sha, pa.string()), pa.array(key[:-1], pa.binary()), pa.array(np.where(top >= 0, key[top], None), pa.binary())],
            names=["first", "depth", "parent_first", *FIGURES, "ends_sha256", "spine", "parent_spine"])

    def run(batches):
        for group in keyed_groups(batches, ["shard"]):
            out = nodes(group)
            for at in range(0, out.num_rows, 20_000):
                yield out.slice(at, 20_000)

    return rows.repartition("shard").sortWithinPartitions("shard", "path").mapInArrow(run, NODE)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """Per node of the trie of rebuilt conversations: conv_id (smallest member), depth, parent_conv_id (root: null), n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.

    Takes conv_id, turn, role, text; other columns are ignored. Null roles and texts are empty. Turns stand in order of number, null
    first; turns that share a number, repeated rows included, all count and stand in order of their MD5. Rows without conv_id belong to
    no conversation; an empty table gives no rows. A conversation is one row of 24 bytes a turn, texts of any length are only hashed.
    """
    paths = written(rebuilt(turns_of(conversations)), "paths")
    parts = written(shard_nodes(written(sorted_shards(paths), "shards")), "trie-parts")
    sums = [F.sum(c).cast("long").alias(c) for c in FIGURES]
    # A path ends in one shard; elsewhere its node has the empty digest.
    ends = F.coalesce(F.max(F.when(F.col("ends_sha256") != EMPTY, F.col("ends_sha256"))), F.lit(EMPTY)).alias("ends_sha256")
    spine = parts.where("spine is not null").groupBy("spine", "depth").agg(F.min("first").alias("first"), F.first("parent_spine").alias("parent_spine"), *sums, ends)
    spine = written(spine, "spine")
    columns = ["first", "depth", "parent_first", "parent_spine", *FIGURES, "ends_sha256"]
    rows = parts.where("spine is null").select(columns).union(spine.withColumn("parent_first", F.lit(None).cast("long")).select(columns))
    names = small(spine.select(F.col("spine").alias("parent_spine"), F.col("first").alias("spine_first")))
    below = rows.where("parent_spine is not null").join(names, "parent_spine").withColumn("parent_first", F.col("spine_first")).select(columns)
    whole = rows.where("parent_spine is null").union(below)
    return whole.select(F.col("first").alias("conv_id"), "depth", F.col("parent_first").alias("parent_conv_id"), *FIGURES, "ends_sha256")


ORACLE = """
with recursive turns as (select cast(conv_id as bigint) as c, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
placed as (select c, md5(strlen(role) || ':' || role || text) as k, strlen(text) as b,
    row_number() over (partition by c order by turn nulls first, md5(strlen(role) || ':' || role || text)) as p from turns),
heads as (select c, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(c::varchar, ''), lambda x: ord(x)::bigint)),
    lambda a, x: list_reduce([xor(a, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, i: xor(y >> 1, 3988292384 * (y & 1)))) as state from (select distinct c from turns)),
convs as (select c, c - c % 5 as base, xor(state, 4294967295) % 9 as h from heads),
steps as (select v.c, least(p, h) as p, p as q, k, b, 0 as own from convs v join placed t on t.c = v.base and t.p <= v.h
  union all select v.c, p, p, k, b, 1 from convs v join placed t on t.c = v.c and t.p > v.h),
numbered as (select c, k, b, row_number() over (partition by c order by own, q) as d from steps),
chained as (select c, d, b, md5(string_agg(k, '') over (partition by c order by d)) as node from numbered),
nodes as (select c, d, b, node from chained union all select c, 0, 0, '' from convs),
depths as (select c, max(d) as len from nodes group by c),
trie as (select node, any_value(d) as d, any_value(b) as b, min(n.c) as conv_id, count(*) as n_convs,
    list(n.c order by n.c) filter (d = len) as ends from nodes n join depths using (c) group by node),
up as (select distinct n.node, m.node as top from nodes n join nodes m on n.c = m.c and m.d = n.d - 1),
below as (select distinct n.node, m.node as top from nodes n join nodes m on n.c = m.c and m.d <= n.d),
kids as (select top, count(*) as n_children from up group by top),
sums as (select w.top, sum(case when k.top is null then 1 else 0 end) as n_leaves, sum((t.n_convs - 1) * t.b) as saved
  from below w join trie t on t.node = w.node left join kids k on k.top = w.node group by w.top)
select t.conv_id, cast(t.d as bigint) as depth, p.conv_id as parent_conv_id, t.n_convs, coalesce(k.n_children, 0) as n_children, cast(s.n_leaves as bigint) as n_leaves,
  cast(s.saved as bigint) as saved_tokens, sha256(coalesce(array_to_string(t.ends, ','), '')) as ends_sha256
from trie t left join up u on u.node = t.node left join trie p on p.node = u.top left join kids k on k.top = t.node join sums s on s.top = t.node"""
