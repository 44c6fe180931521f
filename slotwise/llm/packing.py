"""Order-preserving packing of token ids into sequences, by dynamic programming.

Documents follow each other in order of doc_id. Sequences are cut at document ends, at sentence ends, and inside a sentence
only where it is longer than a sequence. The cuts minimise padding + truncation penalties + a small cost of each sequence. For
a cut at ``p`` the best earlier cut ``o`` has ``p - o <= size``; as padding is ``size - (p - o)``, it is the smallest
``cost(o) + o`` of a sliding window, which a monotone queue keeps in constant time. A sequence whose length is a power of
two needs no padding; these few earlier cuts are looked up besides.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from slotwise.llm.tokens import default_tokenizer, encoded, in_order

SIZE = 2048
END = 1
#: Ids of padding that a cut at a sentence end, a cut inside a sentence and another sequence are worth.
SENTENCE, INSIDE, SEQUENCE = 24, 192, 16
#: A plan ends with the first document that ends beyond this many ids.
SEGMENT = 1 << 21


def _cuts(ends: np.ndarray, sentences: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where a cut may be, from 0, and their penalties."""
    place = np.union1d(np.append(0, ends), sentences)
    gap = np.diff(place)
    far = np.flatnonzero(gap > size)
    if len(far):
        more = np.concatenate([np.arange(place[i] + size, place[i + 1], size) for i in far])
        place = np.union1d(place, more)
    else:
        more = np.zeros(0, np.int64)
    penalty = np.full(len(place), SENTENCE)
    penalty[np.isin(place, more)] = INSIDE
    penalty[np.isin(place, ends)] = 0
    return place.astype(np.int64), penalty


def plan(ends: np.ndarray, sentences: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Ends of the sequences for documents that end at ``ends``; ``sentences`` are the other natural cuts."""
    place, penalty = _cuts(ends, sentences, size)
    # Earlier cuts at the distance of a power of two, in order of the later cut.
    later, earlier, step = [], [], 1
    while step < size:
        at = np.searchsorted(place, place - step)
        hit = np.flatnonzero(place[np.minimum(at, len(place) - 1)] == place - step)
        later.append(hit)
        earlier.append(at[hit])
        step *= 2
    later, earlier = np.concatenate(later), np.concatenate(earlier)
    order = np.argsort(later, kind="stable")
    earlier = earlier[order].tolist()
    upto = np.searchsorted(later[order], np.arange(len(place)), side="right").tolist()
    places, fees = place.tolist(), (penalty + SEQUENCE).tolist()
    cost, back = [0] * len(places), [0] * len(places)
    # Monotone queue of cuts with ascending cost + place; ``head`` is its first live entry.
    keys, cuts, head, seen = [0], [0], 0, upto[0]
    for j in range(1, len(places)):
        p = places[j]
        far = p - size
        while places[cuts[head]] < far:
            head += 1
        origin = cuts[head]
        best = keys[head] - far
        if upto[j] > seen:
            for i in earlier[seen: upto[j]]:
                if cost[i] < best:
                    best, origin = cost[i], i
            seen = upto[j]
        best += fees[j]
        cost[j], back[j] = best, origin
        key = best + p
        while len(keys) > head and keys[-1] >= key:
            keys.pop()
            cuts.pop()
        keys.append(key)
        cuts.append(j)
    out, j = [], len(places) - 1
    while j:
        out.append(places[j])
        j = back[j]
    return np.array(out[::-1], np.int64)


def _pieces(doc_ids: pa.Array, ids: np.ndarray, lengths: np.ndarray, sentences: np.ndarray, size: int):
    ends = np.cumsum(lengths)
    cuts = plan(ends, sentences, size)
    edges = np.union1d(ends, cuts)
    starts = np.concatenate([[0], edges[:-1]])
    document, sequence = np.searchsorted(ends, starts, side="right"), np.searchsorted(cuts, starts, side="right")
    first = np.concatenate([[0], ends[:-1]])[document]
    begin = np.concatenate([[0], cuts[:-1]])[sequence]
    raw = ids.astype("<u4").tobytes()
    crc = [zlib.crc32(raw[4 * a: 4 * b]) for a, b in zip(starts.tolist(), edges.tolist(), strict=True)]
    return [
        doc_ids.take(pa.array(document)), pa.array(starts - first), pa.array(edges - starts), pa.array(crc, pa.int64()),
        pa.array(lengths[document]), sequence, pa.array(starts - begin),
    ], len(cuts)


def pack(docs: DataFrame, size: int = SIZE, end: int = END, tokenizer: str | None = None, segment: int = SEGMENT) -> DataFrame:
    """One row for each piece of a document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    The documents of a partition are planned in segments of at least ``segment`` ids, each to its end, so only the last
    sequence of a segment can be much shorter than the rest. ``sequence_id`` ascends with the documents: partition, then
    number there. Null and empty texts are the lone ``end`` id; null doc_ids come first; repeated rows are packed each;
    other columns are ignored; an empty table gives no rows.
    """
    tokenizer = tokenizer or default_tokenizer()
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

    def run(batches):
        base = TaskContext.get().partitionId() << 32
        held, size_held = [], 0

        def flush():
            nonlocal base
            at = np.cumsum([0, *[len(x[1]) for x in held]])
            columns, used = _pieces(
                pa.concat_arrays([x[0] for x in held]), np.concatenate([x[1] for x in held]), np.concatenate([x[2] for x in held]),
                np.concatenate([x[3] + a for x, a in zip(held, at, strict=False)]), size)
            columns[5] = pa.array(columns[5] + base)
            base += used
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        for slice_ in encoded(batches, tokenizer, end):
            held.append(slice_)
            size_held += len(slice_[1])
            if size_held >= segment:
                yield flush()
                held.clear()
                size_held = 0
        if held:
            yield flush()

    return in_order(docs).mapInArrow(run, schema)
