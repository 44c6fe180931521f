"""Benchmark items inside training texts: a BM25 index of the items, asked with every passage of every text.

Terms of an item weigh ``idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / mean length))``, divided by their sum, so
an item's score with a passage lies in 0..1 and one threshold serves all items. Retrieval is block-max WAND
for many passages at a time: first the sum of the passage's term maxima, then the sums of the maxima within
each block of items; only blocks whose bound reaches the threshold are scored item by item. Bounds never lie below
scores, so nothing above the threshold is lost. What is retrieved is verified: enough of the question's and of the answer's
word n-grams must stand in the passage, or enough of those of the whole item, as a changed word can take all n-grams of a short answer.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import SPACE, Rolling, Words, ranges, slices

K1, B = 1.2, 0.75
SCORE = 0.6
OVERLAP = 0.7
WHOLE = 0.7
GRAM = 3
BLOCK_ITEMS = 8
SHARD_WORDS = 500_000
LEAST_STRIDE = 64
SLACK = 1e-9

#: ASCII white space and punctuation.
BETWEEN = SPACE.copy()
BETWEEN[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


class ItemIndex:
    """Postings of a bounded number of items by term hash, with their maxima over all items and within blocks of items."""

    def __init__(self, ids: np.ndarray, words: list[np.ndarray], answers: list[int], df: dict[int, int], total: int, mean: float):
        # Items of like vocabulary next to each other would tighten the blocks; order of length does as well.
        order = sorted(range(len(ids)), key=lambda i: (len(words[i]), int(ids[i])))
        self.ids = np.array([ids[i] for i in order], np.int64)
        self.words = [words[i] for i in order]
        self.answers = [answers[i] for i in order]
        self.stride = max([LEAST_STRIDE, *(len(w) for w in self.words)])
        terms, items, weights = [], [], []
        for i, w in enumerate(self.words):
            distinct, tf = np.unique(w, return_counts=True)
            n = np.array([df[t] for t in distinct.tolist()], float)
            idf = np.log(1 + (total - n + 0.5) / (n + 0.5))
            weight = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(w) / mean))
            terms.append(distinct)
            items.append(np.full(len(distinct), i))
            weights.append(weight / weight.sum())
        terms, items, weights = np.concatenate(terms), np.concatenate(items), np.concatenate(weights)
        by_term = np.lexsort((items, terms))
        terms, self.items, self.weights = terms[by_term], items[by_term], weights[by_term]
        self.terms, first = np.unique(terms, return_index=True)
        self.first = np.append(first, len(terms))
        self.most = np.maximum.reduceat(self.weights, first)
        block = self.items // BLOCK_ITEMS
        new = np.ones(len(terms), bool)
        new[1:] = (terms[1:] != terms[:-1]) | (block[1:] != block[:-1])
        at = np.flatnonzero(new)
        self.blocks, self.block_most = block[at], np.maximum.reduceat(self.weights, at)
        self.block_first = np.searchsorted(at, self.first)
        self.n_blocks = int(block.max()) + 1

    def known(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the words that are terms, and their terms."""
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        places = np.flatnonzero(self.terms[at] == hashes)
        return places, at[places]

    def retrieve(self, passage: np.ndarray, term: np.ndarray, passages: int, least: float):
        """(passage, item, score) of at least ``least`` from distinct (passage, term) pairs, sorted by passage."""
        bound = np.bincount(passage, self.most[term], passages)
        live = bound[passage] >= least - SLACK
        passage, term = passage[live], term[live]
        count = self.block_first[term + 1] - self.block_first[term]
        at = ranges(self.block_first[term], count)
        key = np.repeat(passage, count) * self.n_blocks + self.blocks[at]
        pairs, index = np.unique(key, return_inverse=True)
        pairs = pairs[np.bincount(index, self.block_most[at], len(pairs)) >= least - SLACK]
        live = np.isin(passage, pairs // self.n_blocks)
        passage, term = passage[live], term[live]
        count = self.first[term + 1] - self.first[term]
        at = ranges(self.first[term], count)
        owner = np.repeat(passage, count)
        live = np.isin(owner * self.n_blocks + self.items[at] // BLOCK_ITEMS, pairs)
        at, owner = at[live], owner[live]
        both, index = np.unique(owner * len(self.ids) + self.items[at], return_inverse=True)
        score = np.bincount(index, self.weights[at], len(both))
        live = score >= least
        return both[live] // len(self.ids), both[live] % len(self.ids), score[live]


def _share(part: np.ndarray, passage: np.ndarray) -> float:
    """Share of the n-grams of ``part`` that stand in the passage; 1 if it has none."""
    n = min(GRAM, len(part))
    if not n:
        return 1.0
    if len(passage) < n:
        return 0.0
    asked = Rolling(part).of(np.arange(len(part) - n + 1), n)
    there = Rolling(passage).of(np.arange(len(passage) - n + 1), n)
    return float(np.isin(asked, there).mean())


def _answer_words(text: str, words: int) -> int:
    """Words of the last of several sentences, of a single sentence its last quarter."""
    ends = [i for i, c in enumerate(text.rstrip()[:-1]) if c in ".?!" and text[i + 1].isspace()]
    if ends:
        tail = Words(pa.array([text[ends[-1] + 1:]]), BETWEEN)
        if 0 < len(tail.start) < words:
            return len(tail.start)
    return math.ceil(words / 4)


def build_indexes(items: DataFrame, ident: str = "item_id") -> list[ItemIndex]:
    """One index for each ``SHARD_WORDS`` words of items; items are read shard by shard, statistics cover all items.

    Items without id, text or words are left out; of items that repeat an id, each is kept once per text.
    """
    clean = items.where(F.col(ident).isNotNull() & F.col("text").isNotNull()).select(F.col(ident).cast("long").alias("item_id"), F.lower(F.col("text").cast("string")).alias("text")).distinct()
    total = clean.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    shards = max(1, -(-total // SHARD_WORDS))
    parts = []
    df: dict[int, int] = {}
    for s in range(shards):
        rows = clean.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == s).orderBy("item_id", "text").collect()
        words = Words(pa.array([r.text for r in rows], pa.string()), BETWEEN)
        hashes = words.hashes()
        own = [hashes[a:b] for a, b in zip(words.offsets, words.offsets[1:], strict=False)]
        kept = [(r.item_id, w, _answer_words(r.text, len(w))) for r, w in zip(rows, own, strict=True) if len(w)]
        for _, w, _ in kept:
            for t in np.unique(w).tolist():
                df[t] = df.get(t, 0) + 1
        if kept:
            parts.append(kept)
    count = sum(map(len, parts))
    mean = sum(len(w) for p in parts for _, w, _ in p) / max(count, 1)
    return [ItemIndex(np.array([i for i, _, _ in p]), [w for _, w, _ in p], [a for _, _, a in p], df, count, mean) for p in parts]


def _search(part: pa.RecordBatch, index: ItemIndex, least: float, overlap: float, whole: float):
    words = Words(part.column("text"), BETWEEN)
    hashes = words.hashes()
    first, counts = words.offsets[:-1], np.diff(words.offsets)
    # A text of n words has chunks of ``stride`` words; a passage is a chunk and the next one.
    chunks = np.maximum(-(-counts // index.stride), 1)
    base = np.cumsum(chunks) - chunks
    places, term = index.known(hashes)
    text = np.searchsorted(words.offsets, places, side="right") - 1
    chunk = base[text] + (places - first[text]) // index.stride
    pairs = np.unique(np.concatenate([chunk, np.where(chunk > base[text], chunk - 1, chunk)]) * len(index.terms) + np.concatenate([term, term]))
    passage, item, score = index.retrieve(pairs // len(index.terms), pairs % len(index.terms), int(chunks.sum()), least)
    out = []
    for p, i, s in zip(passage.tolist(), item.tolist(), score.tolist(), strict=True):
        t = int(np.searchsorted(base, p, side="right")) - 1
        lo = first[t] + (p - base[t]) * index.stride
        window = hashes[lo: min(lo + 2 * index.stride, words.offsets[t + 1])]
        cut = len(index.words[i]) - index.answers[i]
        question, answer = _share(index.words[i][:cut], window), _share(index.words[i][cut:], window)
        if (question >= overlap and answer >= overlap) or _share(index.words[i], window) >= whole:
            out.append((t, int(index.ids[i]), s, question, answer))
    return out


def contaminated(docs: DataFrame, items: DataFrame, least: float = SCORE, overlap: float = OVERLAP, ident: str = "item_id", whole: float = WHOLE) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap): items that a passage of a document holds.

    It holds an item if ``overlap`` of the n-grams of the question and of the answer stand in it, or ``whole`` of all the item's.

    Words are lower-case runs without ASCII white space and punctuation. A passage has twice as many words as the longest
    item, in steps of half its size, so an item that is there lies whole in one. Of several passages the best
    figures stay. Null and empty texts hold nothing; a document or item without id is left out; rows that repeat a doc_id
    are one document; an empty table on either side gives no rows. Other columns are ignored.
    """
    rows = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.lower(F.col("text").cast("string")).alias("text"))
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    found = None
    for index in build_indexes(items, ident):

        def run(batches, index=index):
            for batch in batches:
                for part in slices(batch):
                    if out := _search(part, index, least, overlap, whole):
                        t, i, s, q, a = zip(*out, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [part.column("doc_id").take(pa.array(t)), pa.array(i, pa.int64()), *[pa.array(x, pa.float64()) for x in (s, q, a)]],
                            ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"],
                        )

        one = rows.mapInArrow(run, schema)
        found = one if found is None else found.union(one)
    if found is None:
        return docs.sparkSession.createDataFrame([], schema)
    best = [F.round(F.max(c), 6).alias(c) for c in ("score", "question_overlap", "answer_overlap")]
    return found.groupBy("doc_id", "item_id").agg(*best)
