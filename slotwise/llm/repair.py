"""Token ids on disk in Re-Pair grammars.

Documents are encoded in order of doc_id. A shard is a partition; it is written in blocks of whole documents, and every block
has its own grammar: pairs of neighbouring ids that occur often become one new symbol, again and again, until a
round saves too little. In a round a place takes its pair if that is more frequent than the pairs
that overlap it, so many pairs are replaced at once. A block holds what is left of its ids, the two
symbols of each rule, and the expansion lengths of the rules, which locate any id without expanding what comes before.

The files are a Parquet table, so that they live in whatever store Spark writes to: shard, block, doc_ids, lengths,
sequence, rules, expansions, n_ids.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slotwise.llm.tokens import default_tokenizer, encoded, in_order
from slotwise.session import shared_dir

BLOCK_IDS = 1 << 18
END = 2
#: Uses a rule needs, and the share of symbols a round must save for another one.
LEAST_USES = 4
LEAST_SAVING = 0.02
FIRST_SYMBOL = 1 << 16
_BUCKETS = 18

SCHEMA = "shard int, block int, doc_ids array<long>, lengths array<int>, sequence binary, rules binary, expansions binary, n_ids long"


def _chosen(seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose pair is replaced, and the pairs' codes. Counts are those of hash buckets; exact ones follow."""
    code = seq[:-1].astype(np.uint64) << np.uint64(32) | seq[1:]
    bucket = (code * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - _BUCKETS)).astype(np.int64)
    count = np.bincount(bucket, minlength=1 << _BUCKETS)
    rank = (count[bucket] << _BUCKETS) | bucket
    # Runs of equal rank, as in repeated ids, take every other place if both neighbours are less frequent.
    first = np.flatnonzero(np.concatenate([[True], rank[1:] != rank[:-1]]))
    top = rank[first]
    good = top >= LEAST_USES << _BUCKETS
    good[1:] &= top[1:] > top[:-1]
    good[:-1] &= top[:-1] > top[1:]
    size = np.diff(np.append(first, len(rank)))[good]
    at = np.repeat(first[good], (size + 1) // 2)
    at += 2 * (np.arange(len(at)) - np.repeat(np.cumsum((size + 1) // 2) - (size + 1) // 2, (size + 1) // 2))
    return at, code[at]


def compress(ids: np.ndarray, first_symbol: int = FIRST_SYMBOL) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence, rules (n x 2; rule i is symbol ``first_symbol + i``) and expansion lengths of the rules."""
    seq, rules, lengths = ids.astype(np.uint32), [np.zeros((0, 2), np.uint32)], np.zeros(0, np.int64)
    while len(seq) > 1:
        at, code = _chosen(seq)
        pairs, index, uses = np.unique(code, return_inverse=True, return_counts=True)
        good = uses >= LEAST_USES
        keep = good[index]
        at = at[keep]
        if not len(at) or len(at) < LEAST_SAVING * len(seq):
            break
        symbol = (np.cumsum(good) - 1)[index[keep]] + first_symbol + len(lengths)
        left, right = (pairs[good] >> np.uint64(32)).astype(np.uint32), (pairs[good] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        lengths = np.concatenate([lengths, _expansion(left, lengths, first_symbol) + _expansion(right, lengths, first_symbol)])
        rules.append(np.stack([left, right], axis=1))
        seq[at] = symbol
        stay = np.ones(len(seq), bool)
        stay[at + 1] = False
        seq = seq[stay]
    return seq, np.concatenate(rules), lengths


def _expansion(symbols: np.ndarray, lengths: np.ndarray, first_symbol: int) -> np.ndarray:
    out = np.ones(len(symbols), np.int64)
    rule = symbols >= first_symbol
    out[rule] = lengths[symbols[rule] - first_symbol]
    return out


def decompress(seq: np.ndarray, rules: np.ndarray, lengths: np.ndarray, first_symbol: int = FIRST_SYMBOL) -> np.ndarray:
    """Ids of a sequence. Each pass writes both symbols of every rule at its place, until none is left."""
    size = _expansion(seq, lengths, first_symbol)
    place = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint32)
    while len(seq):
        plain = seq < first_symbol
        out[place[plain]] = seq[plain]
        rule, at = seq[~plain] - first_symbol, place[~plain]
        left, right = rules[rule, 0], rules[rule, 1]
        seq = np.concatenate([left, right])
        place = np.concatenate([at, at + _expansion(left, lengths, first_symbol)])
    return out


def decode_range(seq: np.ndarray, rules: np.ndarray, lengths: np.ndarray, start: int, stop: int, first_symbol: int = FIRST_SYMBOL) -> np.ndarray:
    """Ids ``start:stop`` of a block; only the symbols that cover them are expanded."""
    ends = np.cumsum(_expansion(seq, lengths, first_symbol))
    lo, hi = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop, side="left") + 1
    before = int(ends[lo - 1]) if lo else 0
    return decompress(seq[lo:hi], rules, lengths, first_symbol)[start - before: stop - before]


def _row(shard: int, block: int, held: list) -> pa.RecordBatch:
    ids = np.concatenate([x for _, x, _ in held])
    seq, rules, lengths = compress(ids)
    doc_ids = pa.concat_arrays([d for d, _, _ in held])
    sizes = np.concatenate([n for _, _, n in held]).astype(np.int32)
    wrap = lambda values, kind: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values.cast(kind))
    return pa.RecordBatch.from_arrays(
        [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), wrap(doc_ids, pa.int64()), wrap(pa.array(sizes), pa.int32()),
         *[pa.array([x.astype("<u4").tobytes()], pa.binary()) for x in (seq, rules, lengths)], pa.array([len(ids)], pa.int64())],
        ["shard", "block", "doc_ids", "lengths", "sequence", "rules", "expansions", "n_ids"])


def write_ids(docs: DataFrame, path: str, end: int = END, tokenizer: str | None = None, block_ids: int = BLOCK_IDS) -> None:
    """Encode ``docs`` (doc_id, text) in order of doc_id, ``end`` after each document, and write the blocks to ``path``.

    Null and empty texts are a lone ``end``; null doc_ids come first; repeated rows are written each; other columns
    are ignored. A document never spans blocks, so a very long one makes a long block.
    """
    tokenizer = tokenizer or default_tokenizer()

    def run(batches):
        shard, block, held, size = TaskContext.get().partitionId(), 0, [], 0
        for doc_ids, ids, lengths, _ in encoded(batches, tokenizer, end):
            stops = np.cumsum(lengths)
            start = 0
            while start < len(lengths):
                base = int(stops[start - 1]) if start else 0
                stop = int(np.searchsorted(stops, base + block_ids - size, side="left")) + 1
                stop = min(stop, len(lengths))
                held.append((doc_ids.slice(start, stop - start), ids[base: stops[stop - 1]], lengths[start:stop]))
                size += int(stops[stop - 1]) - base
                start = stop
                if size >= block_ids:
                    yield _row(shard, block, held)
                    block, held, size = block + 1, [], 0
        if held:
            yield _row(shard, block, held)

    in_order(docs).mapInArrow(run, SCHEMA).write.option("compression", "zstd").parquet(path)


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Documents decoded from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, if asked
    for, ids."""
    blocks = spark.read.parquet(path)
    schema = "shard int, block int, doc_id long, at long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                seq, rules, lengths = (np.frombuffer(row[c], "<u4") for c in ("sequence", "rules", "expansions"))
                ids = decompress(seq, rules.reshape(-1, 2), lengths.astype(np.int64)).astype("<u4")
                n = np.array(row["lengths"], np.int64)
                stops = np.cumsum(n)
                starts = stops - n
                raw = ids.tobytes()
                crc = [zlib.crc32(raw[4 * a: 4 * b]) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]
                arrays = [pa.array([row["shard"]] * len(n), pa.int32()), pa.array([row["block"]] * len(n), pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                          pa.array(starts), pa.array(n), pa.array(crc, pa.int64())]
                names = ["shard", "block", "doc_id", "at", "n_tokens", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.ListArray.from_arrays(pa.array(np.append(0, stops).astype(np.int32)), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    # A row per shard, then a row per block of a shard.
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = totals.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("shard_start"))
    inside = Window.partitionBy("shard").orderBy("block")
    base = (
        blocks.select("shard", "block", (F.sum("n_ids").over(inside) - F.col("n_ids")).alias("block_start")).join(before, "shard")
        .select("shard", "block", (F.col("shard_start") + F.col("block_start")).alias("base"))
    )
    columns = ["doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"] + (["ids"] if with_ids else [])
    return blocks.mapInArrow(run, schema).join(base, ["shard", "block"]).select(*columns)


def repair_round_trip(docs: DataFrame) -> DataFrame:
    """Write ``docs`` into new files of the shared folder and read them back."""
    path = shared_dir(docs.sparkSession, "token-ids")
    write_ids(docs, path)
    return read_ids(docs.sparkSession, path)
