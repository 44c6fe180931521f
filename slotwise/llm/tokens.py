"""Token ids of whole texts, and documents in order.

The vocabulary's text rules end every piece at white space, so a text's ids are those of its words (runs
without ASCII white space) one after the other. Each distinct word of a slice is encoded once by the
tokenizers library and remembered by its process; ids of a text are gathered from there. To have fewer distinct words, words
of ASCII only are put in lower case, as the vocabulary's own rules do, and a full stop or comma after a letter, which is a
piece of its own, is set apart.
"""

from __future__ import annotations

import copy
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import Words, ranges, slices, text_key

#: Words a process remembers before it starts anew.
REMEMBERED = 1_000_000
#: Words of a text that the library encodes at once, and texts of a call.
TOGETHER, CALL = 64, 256
#: Bytes that end a sentence when they end a word.
ENDS = np.zeros(256, bool)
ENDS[[ord(c) for c in ".?!"]] = True


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
#: Bytes of words that stay as they are: not ASCII, or part of a special token's name.
_FIXED = np.arange(256) >= 128
_FIXED[ord("<")] = True
_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The process's encoder, with what it remembers from earlier tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Ids of the two signs on their own; 0 if a vocabulary has no single id for them and they must stay.
        self.sign = np.zeros(256, np.int32)
        for c in ".,":
            ids = self.tokenizer.encode(c, add_special_tokens=False).ids
            if len(ids) == 1:
                self.sign[ord(c)] = ids[0]
        self.forget()

    def forget(self) -> None:
        # Remembered words by ascending hash, and the row of each in ``first`` and ``count``.
        self.known, self.row = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.first, self.count, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and how many each has, without an object of the library's for every text of a slice."""
        flat, count = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for at in range(0, len(texts), CALL):
            coded = [e.ids for e in self.tokenizer.encode_batch_fast(texts[at: at + CALL], add_special_tokens=False)]
            count.append(np.fromiter(map(len, coded), np.int64, len(coded)))
            flat.append(np.fromiter(chain.from_iterable(coded), np.int32, int(count[-1].sum())))
        return np.concatenate(flat), np.concatenate(count)

    def _coded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, and how many each has. Words of ASCII letters and digits are encoded many in a text, with full stops between them."""
        stop = self.sign[ord(".")]
        plain = np.fromiter((bool(stop) and w.isascii() and w.isalnum() for w in words), bool, len(words))
        some = [w for w, p in zip(words, plain.tolist(), strict=True) if p]
        ids, size = self._ids([" . ".join(some[at: at + TOGETHER]) + " ." for at in range(0, len(some), TOGETHER)])
        ends = np.flatnonzero(ids == stop) if len(some) else np.zeros(0, np.int64)
        rest, other = self._ids([w for w, p in zip(words, plain.tolist(), strict=True) if not p])
        count = np.empty(len(words), np.int64)
        count[~plain], count[plain] = other, np.diff(ends, prepend=-1) - 1
        owner = np.repeat(plain, count)
        out = np.empty(len(owner), np.int32)
        out[owner], out[~owner] = (ids[ids != stop] if len(some) else ids), rest
        return out, count

    def _learn(self, words: Words, keys: np.ndarray, at: np.ndarray) -> None:
        raw = words.data.tobytes()
        texts = [raw[s: s + n].decode() for s, n in zip(words.start[at].tolist(), words.length[at].tolist(), strict=True)]
        ids, count = self._coded(texts)
        place = np.searchsorted(self.known, keys)
        self.row = np.insert(self.row, place, np.arange(len(self.count), len(self.count) + len(keys)))
        self.known = np.insert(self.known, place, keys)
        self.first = np.concatenate([self.first, len(self.ids) + np.cumsum(count) - count])
        self.count, self.ids = np.concatenate([self.count, count]), np.concatenate([self.ids, ids])

    def _stems(self, words: Words) -> tuple[Words, np.ndarray]:
        """The words as they are looked up, and the id of the sign set apart from each, 0 for none."""
        fixed = np.concatenate([[0], np.cumsum(_FIXED[words.data])])
        plain = fixed[words.start + words.length] == fixed[words.start]
        last = words.data[words.start + words.length - 1]
        before = words.data[np.maximum(words.start + words.length - 2, 0)]
        sign = np.where((words.length > 1) & _LETTER[before], self.sign[last], 0)
        stems = copy.copy(words)
        stems.data = np.concatenate([_LOWER[words.data], words.data])
        stems.start = np.where(plain, words.start, words.start + len(words.data))
        stems.length = words.length - (sign > 0)
        return stems, sign

    def encode(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, and how many each word has."""
        stems, sign = self._stems(words)
        keys, at, index = np.unique(stems.hashes(), return_index=True, return_inverse=True)
        if len(self.known) + len(keys) > REMEMBERED:
            self.forget()
        new = np.flatnonzero(~np.isin(keys, self.known, assume_unique=True)) if len(self.known) else np.arange(len(keys))
        if len(new):
            self._learn(stems, keys[new], at[new])
        rows = self.row[np.searchsorted(self.known, keys)][index]
        first, count = self.first[rows], self.count[rows]
        whole = count + (sign > 0)
        stops = np.cumsum(whole)
        out = np.empty(int(stops[-1]) if len(stops) else 0, np.int32)
        stem = np.ones(len(out), bool)
        ends = stops[sign > 0] - 1
        stem[ends] = False
        out[ends] = sign[sign > 0]
        out[stem] = self.ids[ranges(first, count)]
        return out, whole


def encoded(batches: Iterator[pa.RecordBatch], path: str, end: int):
    """For each slice of (doc_id, text) batches: doc ids, all ids with ``end`` after each document, document lengths, and the
    number of ids up to each sentence end, counted from the slice's first id."""
    coder = encoder(path)
    for batch in batches:
        for part in slices(batch):
            words = Words(part.column("text"))
            ids, count = coder.encode(words)
            upto = np.concatenate([[0], np.cumsum(count)])
            edges = upto[words.offsets]
            lengths = np.diff(edges) + 1
            stops = np.cumsum(lengths)
            out = np.full(int(stops[-1]), end, np.int32)
            document = np.repeat(np.arange(len(lengths)), np.diff(words.offsets))
            inside = np.ones(len(out), bool)
            inside[stops - 1] = False
            out[inside] = ids
            last = words.data[words.start + words.length - 1]
            sentence = np.flatnonzero(ENDS[last])
            yield part.column("doc_id"), out, lengths, upto[sentence + 1] + document[sentence]


def in_order(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in ascending order of doc_id over partitions and rows; null texts are empty, null ids come first.

    Equal doc_ids are ordered by their text's hash, so a doc_id that many rows share can be dealt to several partitions.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("tk", text_key())
    return rows.repartitionByRange("doc_id", "tk").sortWithinPartitions("doc_id", "tk").select("doc_id", "text")
