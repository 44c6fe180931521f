import hashlib
import re

import numpy as np
import pytest

from slotwise.llm.substring_dedup import _runs, remove_repeats
from tests.llm.frames import corpus, frame, tuples, with_clashes


def brute(rows, window):
    first = {}
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    for i, w in words:
        for p in range(len(w) - window + 1):
            key = tuple(w[p: p + window])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        keep = [True] * len(w)
        for p in range(len(w) - window + 1):
            if i is not None and first[tuple(w[p: p + window])] < i:
                keep[p: p + window] = [False] * window
        kept = [x for x, k in zip(w, keep, strict=True) if k]
        out.append((i, len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest(), " ".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("window", "gram"), [(50, 8), (20, 8), (9, 8), (8, 8)])
def test_equals_brute_force(spark, window, gram):
    rows = corpus(2)
    got = tuples(remove_repeats(frame(spark, rows), window, gram), "doc_id", "n_words", "n_removed", "kept_sha256", "kept_text")
    assert got == brute(rows, window)


def test_overlapping_contexts_and_repetition(spark):
    """Windows that share an anchor with different surroundings, and texts that repeat themselves."""
    common = [f"c{i}" for i in range(70)]
    rows = [(i, " ".join([f"a{i}"] * (i % 4) + common[i % 7: 60 + i % 9] + [f"b{i}"] * (i % 3))) for i in range(25)]
    rows += [(100, "same " * 300), (101, "same " * 120), (102, "same " * 49)]
    got = tuples(remove_repeats(with_clashes(frame(spark, rows)), with_text=False), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == [r[:4] for r in brute(rows, 50)]


@pytest.mark.parametrize("length", [55, 80, 120])
def test_smallest_document_holds_a_context_at_several_places(spark, length):
    """A passage that a smaller document holds goes at every place and row of a document that repeats it with its surroundings."""
    passage = " ".join(f"p{i}" for i in range(length))
    before, after = " ".join(f"u{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    around = f"{before} {passage} {after}"
    rows = [(1, f"one {passage} two"), (2, f"{around} {around}"), (2, f"another row {around} of that document"), (3, around)]
    got = tuples(remove_repeats(frame(spark, rows)), "doc_id", "n_words", "n_removed", "kept_sha256", "kept_text")
    assert got == brute(rows, 50)
    assert {r[2] for r in got if r[0] == 2} == {length, 2 * length}


def test_empty_table(spark):
    assert remove_repeats(frame(spark, [])).count() == 0


def test_anchor_does_not_depend_on_the_place():
    """The same 60 words behind few and behind more than 2**24 others have the same anchors and contexts."""
    from types import SimpleNamespace

    r = np.random.default_rng(8)
    words = r.integers(0, 1 << 63, (1 << 24) + 6000).astype(np.uint64)
    passage = words[-60:].copy()
    anchors = []
    for text in (words, np.concatenate([words[:5000], passage]), passage):
        _, lo, hi, anchor, _, _ = _runs(SimpleNamespace(offsets=np.array([0, len(text)])), text, 50, 8)
        # Runs that reach the windows inside the passage.
        anchors.append(set(anchor[hi >= len(text) - 60].tolist()))
    assert anchors[0] == anchors[1] == anchors[2]
