"""Removal of passages that repeat across documents, by prefix-partitioned suffix groups.

A suffix starts at every word. Two suffixes that share their first ``window`` words meet below an
internal node of the suffix tree whose path holds at least ``window`` words: such deep nodes are the
repeats. The tree is split by prefixes of growing length, and a subtree is only split further while
it branches, so most suffixes never leave their document:

1. *Anchor prefix.* Of the ``gram``-word prefixes inside each window the one with the smallest hash is
   its anchor; equal windows have equal anchors. Runs of windows with one anchor are one row.
2. *Context prefix.* Below an anchor, the words that a run covers. An anchor with one context does not branch:
   all its rows are one leaf path, and only its smallest document is needed.
3. *Full prefix.* Only where an anchor has several contexts, the runs of each context in its smallest document (all
   places, all rows of that doc_id) are cut into single suffixes of ``window`` words, and these are grouped.

Groups are kept as (path hash of 128 bits, smallest doc_id), an aggregate that Spark combines before it
shuffles, so a passage held by a third of all documents is a row per task and no group is collected.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import U64, Rolling, Words, mixed, ranges, signed, slices, text_key
from slotwise.session import written

WINDOW = 50
GRAM = 8
OTHER_BASE = 0xC2B2AE3D27D4EB4F


def _runs(words: Words, hashes: np.ndarray, window: int, gram: int):
    """Runs of window starts with one anchor: document index, first and last start, anchor hash, both context hashes."""
    n = len(hashes)
    first, stop = words.offsets[:-1], words.offsets[1:]
    counts = np.maximum(stop - first - window + 1, 0)
    starts = ranges(first, counts)
    if not len(starts):
        return None
    rolling = Rolling(hashes)
    grams = np.full(n, np.iinfo(np.uint64).max, U64)
    grams[: n - gram + 1] = rolling.of(np.arange(n - gram + 1), gram)
    # Smallest hash of each span of window - gram + 1 grams, and its place: the first one of equals.
    low, place = grams.copy(), np.arange(n)

    def look(ahead: int) -> None:
        better = low[ahead:] < low[: n - ahead]
        place[: n - ahead] = np.where(better, place[ahead:], place[: n - ahead])
        low[: n - ahead] = np.where(better, low[ahead:], low[: n - ahead])

    span, width = 1, window - gram + 1
    while span * 2 <= width:
        look(span)
        span *= 2
    if span < width:
        look(width - span)
    anchor = place[starts]
    document = np.repeat(np.arange(len(first)), counts)
    new = np.ones(len(starts), bool)
    new[1:] = (document[1:] != document[:-1]) | (anchor[1:] != anchor[:-1])
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(starts)) - 1
    lo, hi, document, anchor = starts[at], starts[last], document[at], anchor[at]
    size = hi - lo + window
    again = Rolling(mixed(hashes), OTHER_BASE)
    return document, lo - first[document], hi - first[document], grams[anchor], rolling.of(lo, size), again.of(lo, size)


def anchored_runs(docs: DataFrame, window: int, gram: int) -> DataFrame:
    schema = "anchor long, c1 long, c2 long, doc_id long, tk long, lo int, hi int"

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                words = Words(part.column("text"))
                found = _runs(words, words.hashes(), window, gram)
                if found is None:
                    continue
                document, lo, hi, anchor, c1, c2 = found
                rows = pa.array(document)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(anchor)), pa.array(signed(c1)), pa.array(signed(c2)), part.column("doc_id").take(rows),
                     part.column("tk").take(rows), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))],
                    ["anchor", "c1", "c2", "doc_id", "tk", "lo", "hi"],
                )

    return docs.where("doc_id is not null and text is not null").select("doc_id", "text", "tk").mapInArrow(run, schema)


def single_windows(docs: DataFrame, window: int) -> DataFrame:
    """Each window of the ``parts`` (runs of starts) of a document with its 128-bit hash."""
    schema = "w1 long, w2 long, doc_id long, tk long, at int"

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                words = Words(part.column("text"))
                hashes = words.hashes()
                lists = part.column("parts")
                edges = lists.offsets.to_numpy()
                document = np.repeat(np.arange(part.num_rows), np.diff(edges))
                flat = lists.flatten()
                lo = flat.field("lo").to_numpy().astype(np.int64)
                count = flat.field("hi").to_numpy().astype(np.int64) - lo + 1
                starts = ranges(lo + words.offsets[:-1][document], count)
                rows = np.repeat(document, count)
                ids = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(Rolling(hashes).of(starts, window))),
                     pa.array(signed(Rolling(mixed(hashes), OTHER_BASE).of(starts, window))),
                     part.column("doc_id").take(ids), part.column("tk").take(ids),
                     pa.array((starts - words.offsets[:-1][rows]).astype(np.int32))],
                    ["w1", "w2", "doc_id", "tk", "at"],
                )

    return docs.select("doc_id", "text", "tk", "parts").mapInArrow(run, schema)


def repeated_ranges(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, tk, spans): the words ``[lo, hi)`` of a document that windows of smaller documents cover."""
    runs = written(anchored_runs(docs, window, gram), "runs")
    contexts = runs.groupBy("anchor", "c1", "c2").agg(
        F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"),
    )
    contexts = written(contexts, "contexts")
    branching = contexts.groupBy("anchor").agg(F.min("first_doc").alias("low"), F.max("last_doc").alias("high"), F.count("*").alias("n"))
    branching = written(branching.where("n > 1 and low < high").select("anchor"), "branching")
    # The smallest document of each context below a branching anchor stands for all others, with every place and row that holds it.
    firsts = contexts.join(branching, "anchor", "left_semi").select("anchor", "c1", "c2", F.col("first_doc").alias("doc_id"))
    holders = runs.join(firsts, ["anchor", "c1", "c2", "doc_id"]).groupBy("doc_id", "tk").agg(F.collect_set(F.struct("lo", "hi")).alias("parts"))
    holders = written(holders, "holders")
    cut = written(single_windows(docs.join(holders, ["doc_id", "tk"]), window), "windows")
    least = cut.groupBy("w1", "w2").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    least = written(least, "repeats")
    below = cut.join(least, ["w1", "w2"]).where("doc_id > low").select("doc_id", "tk", F.col("at").alias("lo"), (F.col("at") + window).alias("hi"))
    held = written(contexts.where("first_doc < last_doc").select("anchor", "c1", "c2", "first_doc"), "held")
    whole = (
        runs.join(held, ["anchor", "c1", "c2"]).where("doc_id > first_doc")
        .select("doc_id", "tk", "lo", (F.col("hi") + window).alias("hi"))
    )
    # Windows of a context's holder lie in every other document with that context, too, but there the
    # whole run is covered already.
    return whole.union(below).groupBy("doc_id", "tk").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))


def _kept(words: list[bytes], spans) -> list[bytes]:
    if spans is None:
        return words
    edge = np.zeros(len(words) + 1, np.int32)
    for lo, hi in zip(spans.field("lo").to_numpy(), spans.field("hi").to_numpy(), strict=True):
        edge[lo] += 1
        edge[hi] -= 1
    keep = np.cumsum(edge)[:-1] == 0
    return [w for w, k in zip(words, keep, strict=True) if k]


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, with_text: bool = True) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_words, n_removed, kept_sha256 and, if asked for, kept_text.

    A word goes if a window of ``window`` consecutive words that covers it also starts in a document with a
    smaller doc_id; windows are those of the input. Words are runs without ASCII white space. Null and empty texts
    have no words; a null doc_id is compared with nothing and keeps all words; rows that share a doc_id
    are one document for "smaller" and are each answered; other columns are ignored. A text with fewer
    words than the window is kept.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("tk", text_key())
    spans = written(repeated_ranges(rows, window, gram), "spans")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if with_text else "")

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                texts, lists = part.column("text"), part.column("spans")
                out = []
                for i in range(part.num_rows):
                    raw = texts[i].as_buffer() if texts[i].is_valid else b""
                    words = bytes(raw or b"").split()
                    kept = _kept(words, lists[i].values if lists[i].is_valid else None)
                    joined = b" ".join(kept)
                    row = [len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest()]
                    out.append([*row, joined.decode()] if with_text else row)
                columns = list(zip(*out, strict=True))
                arrays = [part.column("doc_id"), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())]
                if with_text:
                    arrays.append(pa.array(columns[3], pa.string()))
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"][: len(arrays)])

    return rows.join(spans, ["doc_id", "tk"], "left").select("doc_id", "text", "spans").mapInArrow(run, schema)
