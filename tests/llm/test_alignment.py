import bisect
import collections
import hashlib
import itertools
import random
from functools import reduce

import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tests.llm.frames import corpus, frame, with_clashes
from tokenizers import Tokenizer

from slotwise.llm import alignment as A

ODD = [
    "a  b", " a", "a ", "\n", " \n ", "a\nb", "a\n\nb", "\na", "a\r\nb c", "tab\there now", "one two　three four été naïve",
    "▁ sign", "sign▁s", "<|endoftext|> and <s> </s> <unk> <0x41>", "it's they'll 've", "你好世界 " * 3, "\U0001f600 \U0001f9d1‍\U0001f33e", "x\x00y \x1f z", "é ́e", " a b",
    "é", " ", "  ", "123 456,789 !!", "word\n next", "end.\u0085 next a", "\x85a \xa0", "a  b  c",
]


def brute(rows):
    path_a, path_b = A.default_paths()
    ta = Tokenizer.from_file(path_a)
    ta.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=path_b)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    raw_a = lambda i: bytes(table[c] for c in ta.id_to_token(i))
    raw_b = lambda i: bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()
    count, found = collections.Counter(), []
    for doc_id, text in rows:
        if not text:
            found.append((doc_id, None))
            continue
        a, b = ta.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
        x, y = [raw_a(i) for i in a], [raw_b(i) for i in b]
        if not b"".join(x) == b"".join(y) == (" " + text).encode():
            found.append((doc_id, None))
            continue
        ends_a, ends_b = list(itertools.accumulate(map(len, x))), list(itertools.accumulate(map(len, y)))
        common = sorted(set(ends_a) & set(ends_b))
        groups = collections.defaultdict(lambda: ([], []))
        for side, ids, ends in ((0, a, ends_a), (1, b, ends_b)):
            for i, end in zip(ids, ends, strict=True):
                groups[bisect.bisect_left(common, end)][side].append(str(i))
        links, k, m = [], 0, 0
        for end in sorted({*ends_a, *ends_b}):
            links.append((a[k], b[m]))
            k, m = k + (ends_a[k] == end), m + (ends_b[m] == end)
        count.update(links)
        text = ";".join(f"{','.join(g)}|{','.join(h)}" for g, h in (groups[i] for i in range(len(common))))
        found.append((doc_id, (len(a), len(b), len(common), links, hashlib.sha256(text.encode()).hexdigest())))
    best = collections.Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    out = []
    for doc_id, r in found:
        if r is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
        else:
            out.append((doc_id, *r[:3], len(r[3]), sum(count[p] == best[p[1]] for p in r[3]), sum(count[p] for p in r[3]), r[4]))
    return sorted(out, key=repr)


def rows():
    odd = [(1000 + i, t) for i, t in enumerate(ODD)]
    return corpus(count=12) + odd + [(2000, ("abc def\n" * 700)), (2000, ("abc def\n" * 700)), (2001, "▁" + "a b " * 2000), (2002, "你好" * 3000)]


@pytest.mark.parametrize(("piece", "pairs"), [(1 << 16, 1 << 20), (500, 1 << 20), (500, 0)])
def test_equals_whole_text_alignment(spark, monkeypatch, piece, pairs):
    """Whole short texts, long texts in pieces joined over several rounds, and counts by a join."""
    monkeypatch.setattr(A, "PIECE_BYTES", piece)
    monkeypatch.setattr(A, "MOST_PAIRS", pairs)
    data = rows()
    got = A.align(with_clashes(frame(spark, data)).withColumn("k1", F.lit(1)).withColumn("n_a", F.lit(2)))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(data)


def test_empty_table(spark):
    assert A.align(frame(spark, [])).count() == 0
    assert [tuple(r) for r in A.align(frame(spark, [(1, None)])).collect()] == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_forgetting_changes_nothing(spark, monkeypatch):
    data = corpus(count=12)
    monkeypatch.setattr(A, "REMEMBERED", 50)
    monkeypatch.setattr(A, "SLICE_BYTES", 2000)
    aligner = A.Aligner(A.default_paths())

    seen = {}
    for _ in range(2):
        forgotten = len(aligner.text)
        for part, rows_, offsets in A._each([pa.RecordBatch.from_pydict({"text": [t for _, t in data]})], "text", aligner):
            for text, f in zip(part.column("text").to_pylist(), aligner.sums(rows_, offsets)[:, 1:5].tolist(), strict=True):
                assert seen.setdefault(text, f) == f
        assert forgotten <= len(aligner.text) < 4000


@pytest.mark.parametrize("seed", range(6))
def test_joining_is_associative(seed):
    """Byte ranges cut anywhere, joined in any order, close the groups of the whole."""
    r = random.Random(seed)
    size = 200
    ends_a = sorted({*r.sample(range(1, size), 60), size})
    ends_b = sorted({*r.sample(range(1, size), 25), size})
    a, b = list(range(len(ends_a))), list(range(1000, 1000 + len(ends_b)))
    whole, groups = A.fragment(a, ends_a, b, ends_b)
    cuts = [0, *sorted(r.sample(range(1, size), 15)), size]
    parts, closed = [], []
    for low, high in itertools.pairwise(cuts):
        own = [(ids[bisect.bisect_right(ends, low): bisect.bisect_right(ends, high)], ends[bisect.bisect_right(ends, low): bisect.bisect_right(ends, high)]) for ids, ends in ((a, ends_a), (b, ends_b))]
        f, found = A.fragment(*own[0], *own[1])
        parts.append(f)
        closed += found

    def join(x, y):
        both, found = x.join(y)
        if found:
            closed.append(found)
        return both

    left = reduce(join, parts)
    first = sorted((at, g.a, g.b) for at, g in closed)
    closed = closed[: sum(f.n_groups for f in parts)]
    while len(parts) > 1:
        i = r.randrange(len(parts) - 1)
        parts[i: i + 2] = [join(parts[i], parts[i + 1])]
    assert left == parts[0] == whole
    assert first == sorted((at, g.a, g.b) for at, g in closed) == sorted((at, g.a, g.b) for at, g in groups)
