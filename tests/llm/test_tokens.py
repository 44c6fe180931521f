import zlib

import numpy as np
import pytest

from slotwise.llm import packing, repair
from slotwise.llm.tokens import default_tokenizer
from tests.llm.frames import corpus, frame, with_clashes


@pytest.fixture(scope="module")
def encode():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(default_tokenizer())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def rows_of():
    odd = ["It's <|endoftext|> a<|startoftext|>b", "é ́x y\u0085z \x1c q", "ΑΣ ΣΑΣ 12345 ½ ǅ", "don't we'll ​﻿", "🙂 a🙂b", "\x0b\x0c", "ﬁ Ⅷ K"]
    return corpus(6) + [(800 + i, t) for i, t in enumerate(odd)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_files_read_back(spark, encode):
    rows = rows_of()
    got = [tuple(r) for r in repair.repair_round_trip(with_clashes(frame(spark, rows))).collect()]
    coded = {}
    for i, t in rows:
        coded.setdefault(i, []).append([*encode(t), 2])
    got.sort(key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    start = 0
    for i, at, n, c in got:
        assert at == start
        match = next(x for x in coded[i] if (len(x), crc(x)) == (n, c))
        coded[i].remove(match)
        start += n
    assert not any(coded.values())


def test_files_in_small_blocks(spark, folder, encode):
    rows = [r for r in rows_of() if r[0] is not None and r[0] not in (503, 504)]
    repair.write_ids(frame(spark, rows), f"{folder}/ids", block_ids=200)
    assert spark.read.parquet(f"{folder}/ids").count() > 20
    got = repair.read_ids(spark, f"{folder}/ids", with_ids=True).collect()
    assert {r.doc_id: r.ids for r in got} == {i: [*encode(t), 2] for i, t in rows}
    repair.write_ids(frame(spark, []), f"{folder}/none")
    assert repair.read_ids(spark, f"{folder}/none").count() == 0


@pytest.mark.parametrize("kind", ["random", "few", "runs", "periodic", "one", "none"])
def test_grammar_round_trip(kind):
    r = np.random.default_rng(1)
    ids = {
        "random": r.integers(0, 49_000, 5000), "few": r.integers(0, 4, 20_000), "runs": np.repeat(r.integers(0, 9, 300), r.integers(1, 90, 300)),
        "periodic": np.tile(np.arange(37), 500), "one": np.array([7]), "none": np.zeros(0, int),
    }[kind].astype(np.int32)
    seq, rules, lengths = repair.compress(ids)
    assert np.array_equal(repair.decompress(seq, rules, lengths), ids)
    if kind in ("few", "runs", "periodic"):
        assert len(seq) + 2 * len(rules) < len(ids) / 2
    for a, b in ((0, 1), (3, 3), (10, 500), (len(ids) - 5, len(ids))):
        if 0 <= a < b <= len(ids):
            assert np.array_equal(repair.decode_range(seq, rules, lengths, a, b), ids[a:b])


def test_pieces(spark, encode):
    rows = [r for r in rows_of() if r[0] is not None and r[0] not in (503, 504)]
    got = packing.pack(with_clashes(frame(spark, rows))).collect()
    ids = {i: [*encode(t), 1] for i, t in rows}
    place = dict.fromkeys(ids, 0)
    sequences = {}
    for r in sorted(got, key=lambda r: (r.doc_id, r.start)):
        assert r.start == place[r.doc_id] and r.doc_tokens == len(ids[r.doc_id]) and r.length > 0
        assert r.ids_crc32 == crc(ids[r.doc_id][r.start: r.start + r.length])
        place[r.doc_id] += r.length
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length, r.doc_id, r.start))
    assert place == {i: len(x) for i, x in ids.items()}
    order = []
    for _, pieces in sorted(sequences.items()):
        at = 0
        for offset, length, doc, start in sorted(pieces):
            assert offset == at
            at += length
            order.append((doc, start))
        assert at <= 2048
    assert order == sorted(order)


def test_pieces_of_repeated_rows_and_empty_table(spark, encode):
    rows = rows_of()
    got = packing.pack(frame(spark, rows))
    assert sum(r.length for r in got.collect()) == sum(len(encode(t)) + 1 for _, t in rows)
    assert packing.pack(frame(spark, [])).count() == 0


def cost(cuts, place, penalty, size):
    total, at = 0, 0
    for c in cuts:
        n = c - at
        assert 0 < n <= size
        total += (0 if n & (n - 1) == 0 and n < size or n == size else size - n) + penalty[c] + packing.SEQUENCE
        at = c
    return total


def test_plan_is_optimal():
    """Against the plain quadratic recursion over all earlier cuts."""
    r = np.random.default_rng(3)
    for _ in range(60):
        size = 16
        ends = np.cumsum(r.integers(1, 40, r.integers(1, 8)))
        sentences = np.unique(r.integers(1, ends[-1] + 1, r.integers(0, 14)))
        place, penalty = packing._cuts(ends, sentences, size)
        fee = dict(zip(place.tolist(), penalty.tolist(), strict=True))
        best = {0: 0}
        for p in place.tolist()[1:]:
            best[p] = min(
                best[o] + (0 if (p - o) & (p - o - 1) == 0 else size - (p - o)) + fee[p] + packing.SEQUENCE for o in place.tolist() if 0 < p - o <= size
            )
        cuts = packing.plan(ends, sentences, size).tolist()
        assert cuts[-1] == ends[-1] and cost(cuts, place, fee, size) == best[int(ends[-1])]


def test_new_words_are_encoded_many_in_a_text(encode):
    import pyarrow as pa

    from slotwise.llm.common import Words
    from slotwise.llm.tokens import Encoder

    class Counting:
        def __init__(self, inner):
            self.inner, self.texts = inner, 0

        def encode_batch_fast(self, texts, **more):
            self.texts += len(texts)
            return self.inner.encode_batch_fast(texts, **more)

    coder = Encoder(default_tokenizer())
    coder.tokenizer = counting = Counting(coder.tokenizer)
    texts = [" ".join(f"{'xyz'[i % 3]}ord{i * 7919 % 5003}q{'.' * (i % 5 == 0)}" for i in range(k, k + 1000)) for k in range(0, 5000, 1000)]
    texts += ["", ". . .", "a.b c.d 1.2, x.", "é a\u0301 e. É", "don't . (x) 7"]
    for part in (texts[:3], texts[2:]):
        ids, count = coder.encode(Words(pa.array(part)))
        assert ids.tolist() == [i for t in part for i in encode(t)] and count.sum() == len(ids)
    assert counting.texts < 200
