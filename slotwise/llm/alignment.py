"""Alignment of two tokenizers over the same bytes: groups between common token ends, and links of overlapping tokens.

A byte range of a text is a ``Fragment``: the open tokens before its first common end, what its closed groups
add up to, and the open tokens after its last one. Joining two neighbours closes the group that spans them; the join is associative,
so fragments of a very long text are joined in a tree across tasks, ``FAN`` at a time.

Tokens never span certain white space (``Segments``), so texts are encoded in segments that end there. Each distinct
segment of a process is encoded and aligned once; a document adds up its segments. A text of more than ``PIECE_BYTES`` is cut into
pieces that are dealt to all tasks, its exact copies only once.

Corpus-wide counts of linked ids come from a first pass. The second looks them up where they are
few enough (``MOST_PAIRS``) to be sent to every task, and joins them to each document's links beyond; results are equal.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotwise.llm.common import Words, by_group, ranges, slices, small
from slotwise.session import written

PIECE_BYTES = 1 << 16
FAN = 8
MOST_PAIRS = 2_000_000
#: Segments, and bytes of them, that a process remembers; beyond them it keeps the quarter that it met most often.
REMEMBERED, REMEMBERED_BYTES = 400_000, 32 << 20
SLICE_BYTES = 2 << 20
#: New segments that are encoded as one text, as tokens end where segments do.
TOGETHER = 1000

_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True


def white_bytes(data: np.ndarray) -> np.ndarray:
    """Bytes of white-space characters, those of Unicode included."""
    out = _WHITE[data]
    if len(data) < 2 or not (data >= 0xC2).any():
        return out
    two = np.flatnonzero(data[:-1] == 0xC2)
    two = two[np.isin(data[two + 1], (0x85, 0xA0))]
    out[two] = out[two + 1] = True
    lead = np.flatnonzero(np.isin(data[:-2], (0xE1, 0xE2, 0xE3)))
    a, b, c = data[lead], data[lead + 1], data[lead + 2]
    spaces = (a == 0xE1) & (b == 0x9A) & (c == 0x80) | (a == 0xE3) & (b == 0x80) & (c == 0x80)
    spaces |= (a == 0xE2) & (b == 0x80) & ((c >= 0x80) & (c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
    spaces |= (a == 0xE2) & (b == 0x81) & (c == 0x9F)
    for k in range(3):
        out[lead[spaces] + k] = True
    return out


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Encoders:
    """Both tokenizers, and the bytes of their ids."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte = _byte_of()
        self.bytes_a = {i: bytes(byte[c] for c in p) if all(c in byte for c in p) else p.encode() for p, i in self.a.get_vocab(False).items()}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = {i: bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)}
        most = max(*self.bytes_a, *self.bytes_b) + 1
        self.size_a, self.size_b = (np.array([len(of.get(i, b"")) for i in range(most)], np.int64) for of in (self.bytes_a, self.bytes_b))
        #: Decimal ids with what follows them in a group's text: 4 * id + place in the list of separators.
        self.shown = [b"%d%c" % (i, c) for i in range(most) for c in b",|;\n"]
        # A blank or line break between two other characters ends a token of either vocabulary if no piece goes on over it.
        plain = self.a.normalizer is None and "ByteLevel" in str(self.a.pre_tokenizer)
        blank = plain and not any("▁" in p.lstrip("▁") for p in pieces) and self._as_it_is()
        self.cut_at = np.zeros(256, bool)
        self.cut_at[32] = blank
        self.cut_at[10] = blank and not any("\n" in p for p in pieces)

    def _as_it_is(self) -> bool:
        """Whether B's pieces give back the bytes of odd texts, so that no rule of its own rewrites them."""
        odd = ["a  b", " a", "a ", "ﬁ ①", "é", "　x"]
        return all(b"".join(self.bytes_b[i] for i in self.b.encode(t)) == b" " + t.encode() for t in odd)

    def encode(self, segments: list[bytes]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of segments that begin with a blank or a line break."""
        texts = [s.decode("utf-8", "replace") for s in segments]
        a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        b = self.b.encode([t[1:] if t[0] == " " else t for t in texts], num_threads=1)
        # B puts a blank of its own before a segment that begins otherwise.
        return a, [ids if t[0] == " " else ids[1:] for t, ids in zip(texts, b, strict=True)]


_ENCODERS: dict[tuple[str, str], Encoders] = {}


def encoders(paths: tuple[str, str]) -> Encoders:
    if paths not in _ENCODERS:
        _ENCODERS[paths] = Encoders(*paths)
    return _ENCODERS[paths]


@dataclass
class Open:
    """Tokens of a group that is not closed yet: ids and absolute byte ends."""

    a: list = field(default_factory=list)
    ends_a: list = field(default_factory=list)
    b: list = field(default_factory=list)
    ends_b: list = field(default_factory=list)

    def __add__(self, other: Open) -> Open:
        return Open(self.a + other.a, self.ends_a + other.ends_a, self.b + other.b, self.ends_b + other.ends_b)

    def text(self) -> bytes:
        return (",".join(map(str, self.a)) + "|" + ",".join(map(str, self.b))).encode()

    def links(self) -> list[tuple[int, int]]:
        """Id pairs of tokens that overlap: one for each stretch between two ends of either side."""
        out, i, j = [], 0, 0
        while i < len(self.a) and j < len(self.b):
            out.append((self.a[i], self.b[j]))
            x, y = self.ends_a[i], self.ends_b[j]
            i += x <= y
            j += y <= x
        return out


@dataclass
class Fragment:
    """A byte range's tokens, each where it ends. Without a common end everything is in ``head``."""

    closed: bool
    head: Open
    tail: Open
    tail_at: int
    n_groups: int = 0
    n_links: int = 0

    def join(self, right: Fragment) -> tuple[Fragment, tuple[int, Open] | None]:
        """Both ranges as one, and the group (its first byte, tokens) that closes between them."""
        if not right.closed:
            if not self.closed:
                return Fragment(False, self.head + right.head, Open(), 0), None
            return Fragment(True, self.head, self.tail + right.head, self.tail_at, self.n_groups, self.n_links), None
        if not self.closed:
            return Fragment(True, self.head + right.head, right.tail, right.tail_at, right.n_groups, right.n_links), None
        group = self.tail + right.head
        return Fragment(
            True, self.head, right.tail, right.tail_at, self.n_groups + right.n_groups + 1, self.n_links + right.n_links + len(group.links()),
        ), (self.tail_at, group)


def fragment(a: list[int], ends_a: list[int], b: list[int], ends_b: list[int]) -> tuple[Fragment, list[tuple[int, Open]]]:
    """The fragment of the tokens that end in a range, and its closed groups with their first bytes."""
    common = sorted(set(ends_a) & set(ends_b))
    if not common:
        return Fragment(False, Open(a, ends_a, b, ends_b), Open(), 0), []
    parts, i, j = [], 0, 0
    for end in common:
        x, y = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
        parts.append(Open(a[i:x], ends_a[i:x], b[j:y], ends_b[j:y]))
        i, j = x, y
    groups = list(zip(common[:-1], parts[1:], strict=True))
    tail = Open(a[i:], ends_a[i:], b[j:], ends_b[j:])
    return Fragment(True, parts[0], tail, common[-1], len(groups), sum(len(g.links()) for _, g in groups)), groups


class Segments(Words):
    """Segments of the contents (each a blank and a text, or a later part of it) of one slice."""

    def __init__(self, contents: pa.Array, cut_at: np.ndarray):
        super().__init__(contents, np.ones(256, bool))
        size = int(self.edges[-1])
        data = self.data[:size]
        first = np.zeros(size + 1, bool)
        if size > 2:
            white = white_bytes(data)
            first[1: size - 1] = cut_at[data[1:-1]] & ~white[:-2] & ~white[2:]
            inner = self.edges[1:-1]
            first[inner[inner > 0] - 1] = False
        first[self.edges[:-1][np.diff(self.edges) > 0]] = True
        self.start = np.flatnonzero(first[:size])
        self.length = np.diff(np.append(self.start, size))
        self.offsets = np.searchsorted(self.start, self.edges)
        #: Whether a segment may stand between others: a cut at its start, and no white space at its end.
        self.plain = np.zeros(len(self.start), bool)
        if size > 2:
            self.plain = (self.length > 1) & cut_at[data[self.start]] & ~white[np.minimum(self.start + 1, size - 1)] & ~white[self.start + self.length - 1]


def next_cut(data: np.ndarray, at: int, cut_at: np.ndarray) -> int:
    """The first place from ``at`` on where a segment may begin, the end if there is none."""
    step = 4096
    while at < len(data) - 1:
        low, high = max(at - 4, 0), min(at + step + 4, len(data))
        part = data[low:high]
        white = white_bytes(part)
        good = np.flatnonzero(cut_at[part[1:-1]] & ~white[:-2] & ~white[2:]) + 1 + low
        # Bytes at the rim may belong to a character that is cut there.
        good = good[(good >= max(at, 1)) & (good < (high - 3 if high < len(data) else high))]
        if len(good):
            return int(good[0])
        at += step
    return len(data)


class Aligner:
    """A process's remembered segments: tokens, groups, links and, once counts are known, their sums."""

    def __init__(self, paths: tuple[str, str]):
        self.coder, self.counts = encoders(paths), None
        self.place: dict[int, int] = {}
        self.text: list[bytes] = []
        #: ok, n_a, n_b, n_groups, n_links, n_best, count_sum of each segment.
        self.figures = np.zeros((0, 7), np.int64)
        self.pairs, self.first = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.keys, self.sizes = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.used, self.met = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def begin(self, counts: Counts | None) -> None:
        """A new task: nothing is used yet, and counts may be others than the last task's."""
        self.used[:] = 0
        if counts is not None and (self.counts is None or counts.name != self.counts.name):
            self.counts = counts
            self._weigh(0)
        elif counts is None:
            self.counts = None

    def _weigh(self, start: int) -> None:
        """n_best and count_sum of the segments from ``start`` on."""
        if self.counts is None or start == len(self.first):
            return
        at = self.first[start]
        total, best = self.counts.of(self.pairs[at:])
        edges = np.append(self.first[start:], len(self.pairs)) - at
        for column, values in ((5, best), (6, total)):
            upto = np.concatenate([[0], np.cumsum(values)])
            self.figures[start:, column] = upto[edges[1:]] - upto[edges[:-1]]

    def rows(self, segments: Segments) -> np.ndarray:
        """Where each segment is remembered."""
        keys, at, index, count = np.unique(segments.hashes(), return_index=True, return_inverse=True, return_counts=True)
        rows = np.fromiter((self.place.get(k, -1) for k in keys.tolist()), np.int64, len(keys))
        new = np.flatnonzero(rows < 0)
        if len(new):
            plain = segments.plain[at[new]]
            new = np.concatenate([new[plain], new[~plain]])
            rows[new] = np.arange(len(self.text), len(self.text) + len(new))
            self.place.update(zip(keys[new].tolist(), rows[new].tolist(), strict=True))
            raw = segments.data.tobytes()
            self._learn([raw[s: s + n] for s, n in zip(segments.start[at[new]].tolist(), segments.length[at[new]].tolist(), strict=True)], int(plain.sum()))
            self.keys = np.concatenate([self.keys, keys[new]])
        self.met[rows] += count
        return rows[index]

    def full(self) -> bool:
        return len(self.text) > REMEMBERED or int(self.sizes.sum()) > REMEMBERED_BYTES

    def forget(self) -> None:
        """Keep the segments met most often, as far as a quarter of the room goes; their counts of meetings are halved."""
        order = np.argsort(-self.met, kind="stable")[: REMEMBERED // 4]
        order = np.sort(order[np.cumsum(self.sizes[order]) <= REMEMBERED_BYTES // 4])
        size = self.figures[order, 4]
        self.pairs = self.pairs[ranges(self.first[order], size)]
        self.first = np.cumsum(size) - size
        self.text = [self.text[i] for i in order.tolist()]
        self.figures, self.keys, self.sizes, self.used = self.figures[order], self.keys[order], self.sizes[order], self.used[order]
        self.met = self.met[order] // 2
        self.place = dict(zip(self.keys.tolist(), range(len(order)), strict=True))

    def _encoded(self, segments: list[bytes], plain: int) -> list[tuple[int, list[int], list[int]]]:
        """(segments, ids of A, ids of B) of runs of segments, no ids where they don't give the bytes back. The first ``plain`` segments are encoded together."""
        of_a, of_b = self.coder.bytes_a, self.coder.bytes_b
        runs = [(i, min(i + TOGETHER, plain)) for i in range(0, plain, TOGETHER)] + [(i, i + 1) for i in range(plain, len(segments))]
        texts = [b"".join(segments[i:j]) for i, j in runs]
        out = []
        for (i, j), text, a, b in zip(runs, texts, *self.coder.encode(texts), strict=True):
            if b"".join([of_a[t] for t in a]) == text == b"".join([of_b[t] for t in b]):
                out.append((j - i, a, b))
            elif j - i > 1:
                out += self._encoded(segments[i:j], 0)
            else:
                out.append((1, [], []))
        return out

    def _learn(self, segments: list[bytes], plain: int) -> None:
        """Encode and align new segments, all at once."""
        runs = self._encoded(segments, plain)
        good = np.repeat([bool(a) for _, a, _ in runs], [n for n, _, _ in runs])
        a, b = (np.fromiter((i for run in runs for i in run[k]), np.int64) for k in (1, 2))
        ends_a, ends_b = np.cumsum(self.coder.size_a[a]), np.cumsum(self.coder.size_b[b])
        sizes = np.array([len(s) for s in segments], np.int64)
        stop = np.cumsum(sizes[good])
        either, common = np.union1d(ends_a, ends_b), np.intersect1d(ends_a, ends_b, assume_unique=True)
        if plain and not np.isin(stop, common).all():
            return self._learn(segments, 0)
        figures = np.zeros((len(segments), 7), np.int64)
        figures[good, 0] = 1
        for column, ends in ((1, ends_a), (2, ends_b), (3, common), (4, either)):
            figures[good, column] = np.diff(np.searchsorted(ends, stop, side="right"), prepend=0)
        # A group's A ids, then its B ids, stand one after the other in the text.
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        shown = np.empty(len(a) + len(b), np.int64)
        shown[np.arange(len(a)) + np.searchsorted(group_b, group_a)] = 4 * a + (common[group_a] == ends_a)
        last = np.where(common[group_b] == ends_b, 2 + np.isin(ends_b, stop), 0)
        shown[np.arange(len(b)) + np.searchsorted(group_a, group_b, side="right")] = 4 * b + last
        table = self.coder.shown
        texts = iter(b"".join([table[i] for i in shown.tolist()]).split(b"\n"))
        self.text += [next(texts) if g else b"" for g in good.tolist()]
        start, count = len(self.first), figures[:, 4]
        self.first = np.concatenate([self.first, len(self.pairs) + np.cumsum(count) - count])
        self.pairs = np.concatenate([self.pairs, a[np.searchsorted(ends_a, either)] << 32 | b[np.searchsorted(ends_b, either)]])
        self.figures = np.concatenate([self.figures, figures])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.used, self.met = (np.concatenate([x, np.zeros(len(segments), np.int64)]) for x in (self.used, self.met))
        self._weigh(start)

    def sums(self, rows: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Figures of each content; zeros where a segment does not give its bytes back, or there is none."""
        total = np.concatenate([np.zeros((1, 7), np.int64), np.cumsum(self.figures[rows], axis=0)])
        out = total[offsets[1:]] - total[offsets[:-1]]
        size = np.diff(offsets)
        out[(out[:, 0] < size) | (size == 0)] = 0
        out[:, 0] = out[:, 0] > 0
        return out

    def linked(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Id pairs of some segments, and how often each is linked."""
        return np.unique(self.pairs[ranges(self.first[rows], self.figures[rows, 4])], return_counts=True)

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        """Id pairs of all segments as often as ``used`` says, which is set back."""
        at = np.flatnonzero(self.used)
        size = self.figures[at, 4]
        pairs, index = np.unique(self.pairs[ranges(self.first[at], size)], return_inverse=True)
        total = np.zeros(len(pairs), np.int64)
        np.add.at(total, index, np.repeat(self.used[at], size))
        self.used[:] = 0
        return pairs, total


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner_of(paths: tuple[str, str], counts: Counts | None = None) -> Aligner:
    """The process's aligner, with what it remembers from earlier tasks."""
    if paths not in _ALIGNERS:
        _ALIGNERS[paths] = Aligner(paths)
    _ALIGNERS[paths].begin(counts)
    return _ALIGNERS[paths]


class Counts:
    """Corpus-wide counts of id pairs, and whether each is the highest of its B id."""

    def __init__(self, pairs: np.ndarray, counts: np.ndarray, best: np.ndarray):
        self.name = uuid.uuid4().hex
        order = np.argsort(pairs)
        self.pairs, self.counts, self.best = pairs[order], counts[order], best[order]

    def of(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts and marks of pairs; 0 for those of other corpora, which a process may still remember."""
        if not len(self.pairs):
            return np.zeros((2, len(pairs)), np.int64)
        at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        known = self.pairs[at] == pairs
        return np.where(known, self.counts[at], 0), known & self.best[at]


def _contents(column: pa.Array) -> pa.Array:
    """A blank and the text, empty for empty and null texts."""
    some = pc.greater(pc.fill_null(pc.binary_length(column), 0), 0)
    return pc.if_else(some, pc.binary_join_element_wise(pa.scalar(" "), pc.fill_null(column, ""), ""), "")


def _each(batches: Iterator[pa.RecordBatch], column: str, aligner: Aligner, flush=lambda: iter(())) -> Iterator:
    """For each slice: the slice, rows and offsets of its segments."""
    for batch in batches:
        for part in slices(batch, column, SLICE_BYTES):
            if aligner.full():
                yield from flush()
                aligner.forget()
            contents = part.column(column) if column == "content" else _contents(part.column(column))
            segments = Segments(contents, aligner.coder.cut_at)
            yield part, aligner.rows(segments), segments.offsets


PAIRS = "a int, b int, n long"


def _pair_batch(pairs: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array((pairs >> 32).astype(np.int32)), pa.array((pairs & 0xFFFFFFFF).astype(np.int32)), pa.array(n)], ["a", "b", "n"])


def _pairs_of_texts(texts: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """Links of whole texts, added up per task."""

    def run(batches):
        aligner = aligner_of(paths)
        flush = lambda: iter([_pair_batch(*aligner.take())])
        for item in _each(batches, "text", aligner, flush):
            if isinstance(item, pa.RecordBatch):
                yield item
                continue
            _, rows, offsets = item
            good = np.repeat(aligner.sums(rows, offsets)[:, 0] > 0, np.diff(offsets))
            np.add.at(aligner.used, rows[good], 1)
        yield from flush()

    return texts.select("text").mapInArrow(run, PAIRS)


FIGURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
RESULT = "doc_id long, " + ", ".join(f"{c} long" for c in FIGURES) + ", groups_sha256 string"


def _documents(texts: DataFrame, paths: tuple[str, str], counts=None) -> DataFrame:
    """Figures of whole texts. Without ``counts`` (a broadcast) each row has its links, and the last two figures are 0."""
    schema = RESULT if counts is not None else RESULT + ", links binary"

    def run(batches):
        aligner = aligner_of(paths, counts.value if counts is not None else None)
        for part, rows, offsets in _each(batches, "text", aligner):
            figures = aligner.sums(rows, offsets)
            sha, links, which, text = [], [], rows.tolist(), aligner.text
            for i, (low, high) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                good = figures[i, 0]
                sha.append(hashlib.sha256(b";".join([text[k] for k in which[low:high]])).hexdigest() if good else "")
                if counts is None:
                    links.append(_packed(*aligner.linked(rows[low:high])) if good else None)
            columns = [part.column("doc_id"), *[pa.array(figures[:, k]) for k in range(1, 7)], pa.array(sha, pa.string())]
            names = ["doc_id", *FIGURES, "groups_sha256"]
            if counts is None:
                columns.append(pa.array(links, pa.binary()))
                names.append("links")
            yield pa.RecordBatch.from_arrays(columns, names)

    return texts.select("doc_id", "text").mapInArrow(run, schema)


def _packed(pairs: np.ndarray, n: np.ndarray) -> bytes:
    return np.stack([pairs, n.astype(np.int64)], axis=1).tobytes()


def _unpacked(rows: DataFrame, key: list[str], types: str) -> DataFrame:
    """A row for each id pair of the packed ``links``."""

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                held = [np.frombuffer(x, np.int64).reshape(-1, 2) for x in pc.fill_null(part.column("links"), b"").to_pylist()]
                rows = pa.array(np.repeat(np.arange(len(held)), [len(x) for x in held]))
                pairs = _pair_batch(*np.concatenate(held).T)
                yield pa.RecordBatch.from_arrays([*[part.column(k).take(rows) for k in key], *pairs.columns], [*key, "a", "b", "n"])

    return rows.select(*key, "links").mapInArrow(run, f"{types}, {PAIRS}")


OPEN = ["a", "ends_a", "b", "ends_b"]
KEY = ["k1", "k2"]
FRAGMENT = (
    "k1 long, k2 long, idx long, ok boolean, closed boolean, tail_at long, n_a long, n_b long, n_groups long, n_links long, "
    + ", ".join(f"{side}_{c} array<long>" for side in ("head", "tail") for c in OPEN) + ", at long, text binary, links binary"
)


def _pieces(texts: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """Parts of long texts (with the blank before them) that begin where a segment may: number, first byte, content."""

    def run(batches):
        coder = encoders(paths)
        for batch in batches:
            for k1, k2, text in zip(*[batch.column(c) for c in ("k1", "k2", "text")], strict=True):
                raw = np.frombuffer(b" " + text.as_buffer().to_pybytes(), np.uint8)
                at, idx = 0, 0
                while at < len(raw):
                    end = next_cut(raw, at + PIECE_BYTES, coder.cut_at)
                    content = pa.array([raw[at:end].tobytes()], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array([k1.as_py()]), pa.array([k2.as_py()]), pa.array([idx]), pa.array([at]), content], [*KEY, "idx", "start", "content"])
                    at, idx = end, idx + 1

    return texts.mapInArrow(run, "k1 long, k2 long, idx long, start long, content binary")


def _row(key: tuple, idx: int, ok: bool, f: Fragment, n_a: int, n_b: int, at: int | None, text: bytes | None, links: bytes | None) -> tuple:
    opened = [getattr(side, c) for side in (f.head, f.tail) for c in OPEN]
    return (*key, idx, ok, f.closed, f.tail_at, n_a, n_b, f.n_groups, f.n_links, *opened, at, text, links)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _arrow_schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in FRAGMENT.split(", "))])


def _leaves(pieces: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """The fragment of each piece: its first group stays open, all others are closed."""

    def run(batches):
        aligner, schema = aligner_of(paths), _arrow_schema()
        texts = (b.set_column(4, "content", b.column("content").cast(pa.string(), safe=False)) for b in batches)
        for part, rows, offsets in _each(texts, "content", aligner):
            figures = aligner.sums(rows, offsets)
            out = []
            for i, (k1, k2, idx, start, content) in enumerate(zip(*[part.column(c).to_pylist() for c in (*KEY, "idx", "start")], part.column("content"), strict=True)):
                key, own = (k1, k2), rows[offsets[i]: offsets[i + 1]]
                if not figures[i, 0]:
                    out.append(_row(key, idx, False, Fragment(False, Open(), Open(), 0), 0, 0, None, None, None))
                    continue
                size = content.as_buffer().size
                first, _, rest = aligner.text[own[0]].partition(b";")
                a, b = ([int(t) for t in side.split(b",")] for side in first.split(b"|"))
                coder = aligner.coder
                ends_a = (start + np.cumsum([len(coder.bytes_a[t]) for t in a])).tolist()
                ends_b = (start + np.cumsum([len(coder.bytes_b[t]) for t in b])).tolist()
                head = Open(a, ends_a, b, ends_b)
                links = head.links()
                f = Fragment(True, head, Open(), start + size, int(figures[i, 3]) - 1, int(figures[i, 4]) - len(links))
                pairs, n = aligner.linked(own)
                np.subtract.at(n, np.searchsorted(pairs, [x << 32 | y for x, y in links]), 1)
                closed = b";".join([*([rest] if rest else []), *[aligner.text[k] for k in own[1:].tolist()]])
                out.append(_row(key, idx, True, f, int(figures[i, 1]), int(figures[i, 2]), ends_a[-1] if closed else None, closed or None, _packed(pairs[n > 0], n[n > 0])))
            if out:
                yield _batch(out, schema)

    return pieces.repartition(*KEY, "idx").mapInArrow(run, FRAGMENT)


def _joined(level: DataFrame) -> DataFrame:
    """Fragments of neighbours, ``FAN`` to one; a group that closes between them is a row of its own (``closed`` null)."""

    def unit(group: pa.Table) -> pa.RecordBatch:
        rows = sorted(group.to_pylist(), key=lambda r: r["idx"])
        key, idx, found = (rows[0]["k1"], rows[0]["k2"]), rows[0]["idx"] // FAN, []
        whole = None
        for r in rows:
            f = Fragment(r["closed"], *[Open(*[r[f"{side}_{c}"] for c in OPEN]) for side in ("head", "tail")], r["tail_at"], r["n_groups"], r["n_links"])
            if whole is None:
                whole = f
                continue
            whole, group_closed = whole.join(f)
            if group_closed:
                at, tokens = group_closed
                pairs, n = np.unique([x << 32 | y for x, y in tokens.links()], return_counts=True)
                found.append((*key, None, True, None, *[None] * 13, at, tokens.text(), _packed(pairs, n)))
        found.append(_row(key, idx, all(r["ok"] for r in rows), whole, sum(r["n_a"] for r in rows), sum(r["n_b"] for r in rows), None, None, None))
        return _batch(found, _arrow_schema())

    return by_group(level.withColumn("unit", F.floor(F.col("idx") / FAN)), [*KEY, "unit"], lambda g: unit(g.drop_columns(["unit"])), FRAGMENT)


def _last(level: DataFrame) -> DataFrame:
    """A text is closed at both ends: its head is its first group."""

    def run(batches):
        schema = _arrow_schema()
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                head = Open(*[r[f"head_{c}"] for c in OPEN])
                if not r["ok"] or r["tail_a"] or r["tail_b"]:
                    continue
                links = head.links()
                pairs, n = np.unique([x << 32 | y for x, y in links], return_counts=True)
                f = Fragment(True, Open(), Open(), r["tail_at"], r["n_groups"] + 1, r["n_links"] + len(links))
                out.append(_row((r["k1"], r["k2"]), 0, True, f, r["n_a"], r["n_b"], 0, head.text(), _packed(pairs, n)))
            if out:
                yield _batch(out, schema)

    return level.mapInArrow(run, FRAGMENT)


def _digests(closed: DataFrame) -> DataFrame:
    """SHA-256 of each text's groups in order of bytes; only one part is held at a time."""

    def run(batches):
        key, sha = None, None
        done = lambda: pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]]), pa.array([sha.hexdigest()])], [*KEY, "groups_sha256"])
        for batch in batches:
            for k1, k2, text in zip(*[batch.column(c).to_pylist() for c in (*KEY, "text")], strict=True):
                if (k1, k2) != key:
                    if key is not None:
                        yield done()
                    key, sha = (k1, k2), hashlib.sha256(text)
                else:
                    sha.update(b";" + text)
        if key is not None:
            yield done()

    return closed.select(*KEY, "at", "text").repartition(*KEY).sortWithinPartitions(*KEY, "at").mapInArrow(run, "k1 long, k2 long, groups_sha256 string")


def _long_texts(rows: DataFrame, paths: tuple[str, str]) -> tuple[DataFrame, DataFrame] | None:
    """(figures and copies of each distinct long text whose bytes agree, its links), or None if there is none."""
    texts = written(rows.groupBy(*KEY).agg(F.first("text").alias("text"), F.count("*").alias("copies")), "long-texts")
    level = written(_leaves(_pieces(texts.select(*KEY, "text"), paths), paths), "fragments")
    most = level.agg(F.max("idx")).first()[0]
    if most is None:
        return None
    parts, structure = [level], level.drop("at", "text", "links")
    blank = [F.lit(None).cast(t).alias(c) for c, t in (("at", "long"), ("text", "binary"), ("links", "binary"))]
    while most:
        joined = written(_joined(structure.select("*", *blank)), "fragments")
        parts.append(joined.where("closed is null"))
        structure = joined.where("closed is not null").drop("at", "text", "links")
        most //= FAN
    whole = written(_last(structure.select("*", *blank)), "whole")
    parts.append(whole)
    closed = parts[0]
    for more in parts[1:]:
        closed = closed.union(more)
    good = small(written(whole.select(*KEY), "good-texts"))
    closed = closed.join(good, KEY, "left_semi").where("links is not null")
    figures = whole.select(*KEY, *FIGURES[:4]).join(_digests(closed.where("text is not null")), KEY).join(texts.select(*KEY, "copies"), KEY)
    links = _unpacked(closed, KEY, "k1 long, k2 long").groupBy(*KEY, "a", "b").agg(F.sum("n").alias("n"))
    return written(figures, "long-figures"), written(links, "long-links")


def _weighed(links: DataFrame, counts: DataFrame, key: list[str]) -> DataFrame:
    """(key, n_best, count_sum) by a join."""
    found = links.join(counts, ["a", "b"])
    return found.groupBy(*key).agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("total")).alias("count_sum"))


def align(docs: DataFrame, paths: tuple[str, str] | None = None, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256).

    A encodes a blank and the text, B the text, before which it puts that blank. Null and empty texts, and texts whose tokens do
    not give these bytes back (the sign U+2581, bytes that are no UTF-8), have zeros and an empty digest and add nothing to the counts. Rows that
    repeat an id or a text are rows each and count each; a null id stays null. Equal counts all are the highest. Other
    columns are ignored; an empty table gives no rows.
    """
    paths = paths or default_paths()
    spark = docs.sparkSession
    rows = docs.select(F.col(ident).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    is_long = F.coalesce(F.octet_length("text") > PIECE_BYTES, F.lit(False))
    short = rows.where(~is_long)
    keyed = rows.where(is_long).select("doc_id", "text", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2"))
    long = _long_texts(keyed, paths)
    pairs = _pairs_of_texts(short, paths)
    if long is not None:
        figures, links = long
        pairs = pairs.union(links.join(figures.select(*KEY, "copies"), KEY).select("a", "b", F.col("n") * F.col("copies")))
    pairs = pairs.groupBy("a", "b").agg(F.sum("n").alias("total"))
    counts = written(pairs.withColumn("best", F.col("total") == F.max("total").over(Window.partitionBy("b"))), "pair-counts")
    if counts.count() <= MOST_PAIRS:
        held = counts.toArrow()
        a, b, total, best = (held.column(c).to_numpy() for c in ("a", "b", "total", "best"))
        sent = spark.sparkContext.broadcast(Counts(a.astype(np.int64) << 32 | b, total, best))
        out = _documents(short, paths, sent)
    else:
        found = written(_documents(short, paths).withColumn("rid", F.monotonically_increasing_id()), "documents")
        sums = _weighed(_unpacked(found, ["rid"], "rid long"), counts, ["rid"])
        out = found.drop("n_best", "count_sum", "links").join(sums, "rid", "left").select(*_columns(FIGURES[:4]))
    if long is None:
        return out
    known = small(written(figures.join(_weighed(links, counts, KEY), KEY), "long-known"))
    return out.union(keyed.select("doc_id", *KEY).join(known, KEY, "left").select(*_columns([])))


def _columns(sure: list[str]) -> list:
    return ["doc_id", *sure, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in FIGURES if c not in sure], F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")]
