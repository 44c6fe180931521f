import hashlib
import itertools
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from slotwise.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string, base long, path string, first int, depth int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", *P.FIGURES, "ends_sha256"]


def conversations(seed=2, n=60):
    r = random.Random(seed)
    texts = ["hello there", "tell me more", "", "why?", "naïve café", "a long answer " * 30]
    rows = []
    for c in range(n):
        for t in range(r.randrange(0, 12)):
            rows.append((c, t, r.choice(["user", "assistant"]), r.choice(texts[: 2 + t % 5])))
    for c in range(200, 260):
        rows += [(c, t, "user", f"same {t}") for t in range(12)]
    rows += [(300 + i, t, "user", f"same {min(t, i)}") for i in range(20) for t in range(14)]
    rows += [(400, t, "user", f"turn {t}") for t in range(500)]
    rows += [(500, None, "user", "no number"), (500, 3, None, None), (501, -2, None, "x"), (-7, 0, "user", "below zero"), (-5, 0, "user", "base of it"), (None, 0, "user", "no conversation")]
    rows += [(600, 1, "user", "twice"), (600, 1, "user", "twice"), (600, 1, "assistant", "same number"), (601, 0, "a", "bc"), (602, 0, "ab", "c"), (603, 0, "ab", "c")]
    return rows


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn, role or "", text or ""))
    md5 = lambda x: hashlib.md5(f"{len(x[1].encode())}:{x[1]}{x[2]}".encode()).digest()
    for c in own:
        own[c] = [(r, t) for _, r, t in sorted(own[c], key=lambda x: (x[0] is not None, x[0] or 0, md5(x)))]
    members, text = {}, {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c > 0 else -1)
        path = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append((c, d == len(path)))
            text[path[:d]] = len(path[d - 1][1].encode()) if d else 0
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    out, below = [], {}
    for p in sorted(members, key=len, reverse=True):
        leaves = sum(below[k][0] for k in kids.get(p, [])) or 1
        saved = (len(members[p]) - 1) * text[p] + sum(below[k][1] for k in kids.get(p, []))
        below[p] = leaves, saved
        ends = ",".join(str(c) for c, last in sorted(members[p]) if last)
        least = lambda q: min(c for c, _ in members[q])
        out.append((least(p), len(p), least(p[:-1]) if p else None, len(members[p]), len(kids.get(p, [])), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0, "p", 1, 2) for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize(("turns", "chunk"), [(1 << 20, 1 << 13), (30, 4), (1, 1)])
def test_equals_brute_force(spark, monkeypatch, turns, chunk):
    """One shard and many, down to one path each, so that spines run through all of them."""
    monkeypatch.setattr(P, "SHARD_TURNS", turns)
    monkeypatch.setattr(P, "CHUNK_IDS", chunk)
    rows = conversations()
    got = P.prefix_trie(frame(spark, rows)).select(COLUMNS)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_empty_tables(spark):
    assert P.prefix_trie(frame(spark, [(None, 0, "user", "x")])).count() == 0
    empty = spark.createDataFrame([], SCHEMA)
    assert P.prefix_trie(empty).count() == 0
    # A base that is absent and no turns left: a textless conversation ends at the root.
    c = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9)
    rows = [(c, 0, "user", "gone")]
    got = [tuple(r) for r in P.prefix_trie(frame(spark, rows)).select(COLUMNS).collect()]
    assert got == brute(rows) and len(got) == 1


@pytest.mark.parametrize("seed", range(5))
def test_findclose(seed):
    r = np.random.default_rng(seed)
    opens, depth = [True], 1
    while depth:
        opens.append(bool(r.random() < 0.499) and len(opens) < 40_000)
        depth += 1 if opens[-1] else -1
    opens += [False] * depth
    stack, want = [], {}
    for i, o in enumerate(opens):
        if o:
            stack.append(i)
        else:
            want[stack.pop()] = i
    at = np.array(sorted(want))
    assert P.Parentheses(np.array(opens)).findclose(at).tolist() == [want[i] for i in at.tolist()]


def test_deep_chain_closes():
    n = 5000
    opens = np.repeat([True, False], n)
    assert (P.Parentheses(opens).findclose(np.arange(n)) == 2 * n - 1 - np.arange(n)).all()


def test_any_cut_into_shards_adds_up():
    r = random.Random(4)
    paths = sorted({b"".join(bytes([r.randrange(3)]) * P.HASH for _ in range(r.randrange(0, 7))) for _ in range(200)})
    sizes = [b"".join(int(p[i * P.HASH] + 1).to_bytes(8, "little") for i in range(len(p) // P.HASH)) for p in paths]
    members, first = np.arange(1, len(paths) + 1), np.arange(len(paths))[::-1].copy()

    def nodes(cuts):
        out = {}
        for a, b in itertools.pairwise([0, *cuts, len(paths)]):
            shard = P.Shard(paths[a:b], sizes[a:b], members[a:b], first[a:b], paths[a - 1] if a else None, paths[b] if b < len(paths) else None)
            for i, d in enumerate(shard.depth.tolist()):
                key = paths[a + shard.owner[i]][: d * P.HASH]
                assert key not in out or shard.spine[i]
                held = out.setdefault(key, dict.fromkeys(P.FIGURES, 0))
                for c in P.FIGURES:
                    held[c] += int(shard.figures[c][i])
        return out

    whole = nodes([])
    for _ in range(10):
        assert nodes(sorted(r.sample(range(1, len(paths)), r.randrange(1, 12)))) == whole


def test_oracle(spark):
    folder = "/root/testdata/sf0.001"
    got = P.prefix_trie(spark.read.parquet(f"{folder}/conversations.parquet").withColumn("members", F.lit(1))).select(COLUMNS)
    db = duckdb.connect()
    db.sql(f"create view conversations as select * from '{folder}/conversations.parquet'")
    want = [tuple(r) for r in db.sql(f"select {', '.join(COLUMNS)} from ({P.ORACLE})").fetchall()]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)
