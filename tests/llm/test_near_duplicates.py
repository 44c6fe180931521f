import re

import numpy as np
import pytest

from slotwise.llm import jaccard_join as J
from slotwise.llm import line_dedup as L
from slotwise.llm.common import components
from tests.llm.frames import corpus, frame, tuples, with_clashes

SPACE = r"[\x20\x09-\x0D]+"


def groups(nodes, links):
    above = {n: n for n in nodes}

    def top(n):
        while above[n] != n:
            n = above[n]
        return n

    for a, b in links:
        above[top(a)] = top(b)
    return {n: top(n) for n in nodes}


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (9, 9), (7, 8), (8, 6), (3, 7)] + [(100 + i, 101 + i) for i in range(40)] + [(500, 500 + i) for i in range(1, 30)]
    found = dict(tuples(components(spark.createDataFrame(edges, "a long, b long"), "t"), "node", "root"))
    own = groups({n for e in edges if e[0] != e[1] for n in e}, [e for e in edges if e[0] != e[1]])
    low = {}
    for n, t in own.items():
        low[t] = min(low.get(t, n), n)
    assert found == {n: low[t] for n, t in own.items()}
    assert components(spark.createDataFrame([], "a long, b long"), "t").count() == 0


def brute_jaccard(rows, n=5, threshold=0.8):
    sets = {}
    for i, t in rows:
        if i is not None:
            w = [x for x in re.split(SPACE, t or "") if x]
            g = frozenset(" ".join(w[k: k + n]) for k in range(max(len(w) - n + 1, 1))) if w else frozenset()
            sets.setdefault(g, []).append(i)
    keys = list(sets)
    links = [
        (a, b) for x, a in enumerate(keys) for b in keys[:x]
        if a and b and len(a & b) >= threshold * len(a | b) - 1e-9
    ]
    top = groups(keys, links)
    low = {}
    for k in keys:
        low[top[k]] = min(low.get(top[k], min(sets[k])), min(sets[k]))
    count = {k: sum(k in e for e in links) for k in keys}
    return sorted(((i, min(sets[k]), low[top[k]], count[k]) for k in keys for i in sets[k]), key=repr)


COLUMNS = ("doc_id", "class_id", "group_id", "n_links")


@pytest.mark.parametrize("clashes", [False, True])
def test_jaccard_equals_brute_force(spark, clashes):
    rows = corpus()
    docs = frame(spark, rows)
    assert tuples(J.near_duplicates(with_clashes(docs) if clashes else docs), *COLUMNS) == brute_jaccard(rows)


def test_jaccard_large_near_group_in_blocks(spark, monkeypatch):
    """A group of near copies larger than the blocks loses no link and makes no pair rows."""
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join([*base[: i % 60], f"other{i}", *base[i % 60:]])) for i in range(90)] + [(1000, "alone is this text here now")]
    monkeypatch.setattr(J, "BUCKET_BLOCK", 16)
    monkeypatch.setattr(J, "VERIFY_BLOCK", 16)
    assert tuples(J.near_duplicates(frame(spark, rows)), *COLUMNS) == brute_jaccard(rows)


def test_jaccard_empty_table(spark):
    assert J.near_duplicates(frame(spark, [])).count() == 0


def test_posterior_bound():
    """The integer rule equals the tail of the beta posterior, integrated numerically."""
    need = J.needed(0.8, 1e-6)
    grid = np.linspace(0, 1, 200_001)
    for n in (16, 48, 128):
        for m in (need[n] - 1, need[n]):
            density = np.exp(m * np.log(grid[1:-1]) + (n - m) * np.log(1 - grid[1:-1]) - (m * np.log(0.8) + (n - m) * np.log(0.2)))
            tail = density[grid[1:-1] >= 0.8].sum() / density.sum()
            assert (tail >= 1e-6) == (m >= need[n])


# --- lines ---------------------------------------------------------------------------


def normal(line):
    return " ".join(re.sub("[0-9]", "0", w) for w in re.split(r"[\x09-\x0D\x20!-/:-@\[-`{-~]+", line.lower()) if w)


def brute_lines(rows):
    import pyarrow as pa

    places = {}
    for i, t in {(i, t) for i, t in rows if i is not None and t is not None}:
        for n, line in enumerate(t.split("\n")):
            if len(normal(line).split()) >= L.LEAST_WORDS:
                places.setdefault(normal(line), []).append((i, n, t))
    keys = list(places)
    sim = {k: int(L.Lines(pa.array([k])).simhashes(np.array([0]))[0]) for k in keys}
    links = [(a, b) for x, a in enumerate(keys) for b in keys[:x] if (sim[a] ^ sim[b]).bit_count() <= L.MOST_BITS and L.similar(a, b, L.SIMILARITY)]
    top = groups(keys, links)
    first = {}
    for k in keys:
        first[top[k]] = min([first.get(top[k], (10**9, 0)), *(p[:2] for p in places[k])])
    gone = {(p[0], p[2], p[1]) for k in keys for p in places[k] if p[:2] != first[top[k]]}
    out = []
    for i, t in rows:
        lines = [] if t is None else t.split("\n")
        kept = [x for n, x in enumerate(lines) if (i, t, n) not in gone]
        out.append((i, len(lines), len(lines) - len(kept), None if t is None else "\n".join(kept)))
    return sorted(out, key=repr), len(links)


def line_corpus():
    rows = [r for r in corpus(4) if r[0] != 503]
    long = "the quick brown fox jumps over the lazy dog while seventeen other animals watch from the distant hill and say nothing at all today"
    rows += [(700 + i, f"short\n{long.replace('hill', 'hills' if i % 3 else 'hill')} {i}\nkept line number by number {'abcdefghij'[i]} xyz") for i in range(8)]
    return rows


@pytest.mark.parametrize("clashes", [False, True])
def test_lines_equal_brute_force(spark, clashes):
    rows = line_corpus()
    docs = frame(spark, rows)
    want, _ = brute_lines(rows)
    got = tuples(L.line_dedup(with_clashes(docs) if clashes else docs), "doc_id", "n_lines", "n_removed", "kept_text")
    assert got == want


def test_fuzzy_lines_in_blocks(spark, monkeypatch):
    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    rows = [(i, " ".join(words[:i] + words[i + 1:])) for i in range(40)] + [(90, "nothing like the other lines at all")]
    want, links = brute_lines(rows)
    monkeypatch.setattr(L, "PAIR_BLOCK", 8)
    got = tuples(L.line_dedup(frame(spark, rows)), "doc_id", "n_lines", "n_removed", "kept_text")
    assert links > 20 and got == want


def test_pipeline_form_keeps_columns(spark):
    rows = line_corpus()
    docs = with_clashes(frame(spark, rows))
    out = L.without_repeated_lines(docs)
    assert out.columns == docs.columns
    assert tuples(out, "doc_id", "text") == sorted(((i, k) for i, _, _, k in brute_lines(rows)[0]), key=repr)
    assert out.where("text is not null and n_chars <> length(text)").count() == 0
    assert L.line_dedup(frame(spark, [])).count() == 0


def test_edit_distance():
    import random

    r = random.Random(2)
    for _ in range(300):
        a, b = ("".join(r.choice("ab c") for _ in range(r.randrange(0, 60))) for _ in range(2))
        if r.random() < 0.6:
            b = a[:10] + b[:3] + a[12:]
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        assert L.edit_distance(a, b) == row[-1]


def test_lines_found_by_edit_similarity_alone(spark):
    """Recall against links that know nothing but the edit similarity, for lines of 8 to 60 words, one replaced or misspelt."""
    import random

    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randrange(3, 9)))
    rows = []
    for i in range(200):
        words = [word() for _ in range((8, 12, 20, 30, 60)[i % 5])]
        other = list(words)
        other[r.randrange(len(words))] = word() if i % 2 else words[3][:-1] + "z"
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
    alike = [i for i in range(0, 400, 2) if L.similar(rows[i][1], rows[i + 1][1], L.SIMILARITY)]
    gone = {r.doc_id for r in L.line_dedup(frame(spark, rows)).where("n_removed = 1").collect()}
    assert len(alike) > 190 and gone <= {i + 1 for i in alike}
    assert sum(i + 1 in gone for i in alike) >= 0.97 * len(alike)


def test_short_lines_and_lines_without_blanks_go(spark):
    """Copies of lines of one to three words, and of sentences whose script puts no blanks between words."""
    lines = ["Home", "contact us", "all rights reserved", "今天天气很好我们去公园散步吧", "สวัสดีครับ", "ok"]
    rows = [(i, "\n".join([*lines, "", f"line of document {'abcd'[i]} {'xyzuvw'[i] * 9}"])) for i in range(4)]
    got = {r.doc_id: r for r in L.line_dedup(frame(spark, rows)).collect()}
    assert [got[i].n_removed for i in range(4)] == [0, 6, 6, 6]
    assert got[3].kept_text == "\nline of document d uuuuuuuuu"


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_bounded_edit_distance_stops_early_and_loses_nothing(monkeypatch):
    monkeypatch.setattr(L, "LOOK", 2)
    rng, early = np.random.default_rng(3), 0
    for _ in range(300):
        a, b = ("".join(rng.choice(list("abcé 早"), rng.integers(0, 70))) for _ in range(2))
        if rng.random() < 0.5:
            b = a[: len(a) // 2] + b[: rng.integers(0, 9)] + a[len(a) // 2 + rng.integers(0, 9):]
        true = plain_distance(a, b)
        assert L.edit_distance(a, b) == true
        for most in (0, 3, max(true - 1, 0), true, true + 5):
            found = L.edit_distance(a, b, most)
            assert found == true if true <= most else found > most
            early += found != true
        longest = max(len(a), len(b))
        assert L.similar(a, b, 0.8) == (longest - true >= 0.8 * longest - 1e-9)
    assert early > 100


def test_pairs_compared_at_once_equal_pairs_compared_singly(monkeypatch):
    """Batches of many word counts, with small tables and early looks too, and a spanning forest that joins what all similar pairs join."""
    rng, tried, alike = np.random.default_rng(4), 0, 0
    one_by_one = L.similar
    for length, letters, look in ((70, "abcdefgh ", 96), (300, "abcé 早", 4), (2200, "abcdefghijkl ", 8)):
        texts = []
        for _ in range(14):
            base = list(rng.choice(list(letters), rng.integers(1, length)))
            for share in (0, 0.1, 0.2, 0.3):
                new = list(base)
                for at in rng.integers(0, len(base), int(share * len(base))).tolist():
                    new[at] = ("", "z", new[at] + "y")[at % 3]
                texts.append("".join(new) or "a")
        a, b = np.triu_indices(len(texts), 1)
        want = np.array([one_by_one(texts[i], texts[j], 0.8) for i, j in zip(a.tolist(), b.tolist(), strict=True)])
        monkeypatch.setattr(L, "LOOK", look)
        monkeypatch.setattr(L, "FEW_PAIRS", 1)
        for places in (1 << 20, 2000):
            monkeypatch.setattr(L, "PLACES", places)
            calls = []
            monkeypatch.setattr(L, "similar", lambda *x, calls=calls: calls.append(x) or one_by_one(*x))
            assert np.array_equal(L.Spelled(texts).similar(a, b, 0.8), want)
            assert len(calls) < len(a) / 4
            monkeypatch.setattr(L, "similar", one_by_one)
            x, y = L._spanning(texts, a, b, 0.8)
            top = groups(range(len(texts)), list(zip(a[want].tolist(), b[want].tolist(), strict=True)))
            got = groups(range(len(texts)), list(zip(x.tolist(), y.tolist(), strict=True)))
            assert len(set(top.values())) == len(set(got.values())) == len(set((top[i], got[i]) for i in top)) == len(texts) - len(x)
        tried, alike = tried + len(a), alike + int(want.sum())
    assert alike > 60 and tried > 4000


def test_lines_that_no_other_can_be_similar_to_get_no_rows(spark):
    rng = np.random.default_rng(4)
    chars = rng.integers(40, 2000, 300).tolist()
    own = rng.integers(0, 6, (300, L.MINIMA // 2)).astype(np.uint32)
    own[::4] = rng.integers(0, 1 << 32, own[::4].shape)
    data = [(i, n, bytearray(x.tobytes()), None) for i, (n, x) in enumerate(zip(chars, own, strict=True))]
    distinct = spark.createDataFrame(data, "rid long, chars int, long binary, short binary").repartition(3)
    rows = L._shared_keys(distinct, 0.8).collect()
    found = {(r.key, r.rid) for r in rows}
    groups = {}
    for i, x in enumerate(own.tolist()):
        for k, v in enumerate(x):
            groups.setdefault(v | k << 33, []).append(i)
    alike = lambda a, b: min(chars[a], chars[b]) >= 0.8 * max(chars[a], chars[b])
    needed = {(k, i) for k, g in groups.items() for i in g if any(i != j and alike(i, j) for j in g)}
    shared = {(k, i) for k, g in groups.items() for i in g if len(g) > 1}
    assert needed <= found < shared and len(rows) == len(found)
    sizes = {}
    for r in rows:
        sizes.setdefault(r.key, []).append(r.size)
    assert all(set(s) == {len(s)} for s in sizes.values())
    # Lengths of which none is within a quarter of another leave nothing.
    apart = [(i, 40 * 2**i, bytearray(own[1].tobytes()), None) for i in range(5)]
    assert L._shared_keys(spark.createDataFrame(apart, distinct.schema), 0.8).count() == 0
