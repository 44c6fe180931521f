import math
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from slotwise.llm import decontaminate as D
from slotwise.llm import language_id as L
from slotwise.llm.common import Rolling, Words
from tests.llm.frames import corpus, frame, tuples, with_clashes


def test_words_and_rolling_hashes():
    texts = ["a b  c\n", None, "", " x", "é\tß a", "abc", "abc d " + "y" * 100, "z"]
    words = Words(pa.array(texts))
    want = [t.split() if t else [] for t in texts]
    assert np.diff(words.offsets).tolist() == [len(w) for w in want]
    flat = [x for w in want for x in w]
    code = {}
    assert all(code.setdefault(w, h) == h for w, h in zip(flat, words.hashes().tolist(), strict=True)) and len(set(code.values())) == len(code)
    sliced = Words(pa.array(texts).slice(4, 3))
    assert sliced.hashes().tolist() == [code[x] for w in want[4:7] for x in w]
    values = np.array([3, 5, 3, 5, 3, 7], np.uint64)
    h = Rolling(values).of(np.arange(5), 2)
    assert h[0] == h[2] and h[1] == h[3] and len({*h.tolist()}) == 3


# --- benchmark -----------------------------------------------------------------------

ITEMS = [
    (1, "Which river runs through the old town of Kell? It is the slow Brenna river."), (2, "one two three four five six seven eight nine ten eleven twelve"),
    (3, "Die Antwort ist immer gleich. Sie lautet zweiundvierzig und nichts anderes."), (4, None), (5, "   "), (None, "some item without id at all"),
    (6, "Which lake lies behind the new town of Kell? It is the wide Marn lake."), (2, "one two three four five six seven eight nine ten eleven twelve"),
]


def plain(text):
    return [w for w in re.split(r"[\x09-\x0D\x20!-/:-@\[-`{-~]+", text.lower()) if w]


def share(part, window):
    n = min(3, len(part))
    grams = lambda w: [tuple(w[i: i + n]) for i in range(len(w) - n + 1)]
    there = set(grams(window))
    return sum(g in there for g in grams(part)) / len(grams(part)) if n else 1.0


def brute(rows, items, least, overlap):
    kept = sorted({(i, t) for i, t in items if i is not None and t is not None and plain(t)})
    words = [plain(t) for _, t in kept]
    total, mean = len(kept), sum(map(len, words)) / max(len(kept), 1)
    df = {}
    for w in words:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    stride = max([D.LEAST_STRIDE, *map(len, words)])
    best = {}
    for (item, text), w in zip(kept, words, strict=True):
        weight = {}
        for t in set(w):
            tf = w.count(t)
            weight[t] = math.log(1 + (total - df[t] + 0.5) / (df[t] + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / mean))
        answer = D._answer_words(text.lower(), len(w))
        for doc, body in rows:
            d = plain(body or "")
            for at in range(0, len(d), stride) if doc is not None else ():
                window = d[at: at + 2 * stride]
                score = sum(weight[t] for t in set(window) & set(weight)) / sum(weight.values())
                q, a = share(w[: len(w) - answer], window), share(w[len(w) - answer:], window)
                if score >= least and q >= overlap and a >= overlap:
                    best[doc, item] = [max(x) for x in zip(best.get((doc, item), (0, 0, 0)), (score, q, a), strict=True)]
    return sorted((*k, *[round(x, 6) for x in v]) for k, v in best.items())


@pytest.mark.parametrize(("least", "overlap"), [(0.6, 0.7), (0.2, 0.1)])
def test_decontamination_equals_brute_force(spark, monkeypatch, least, overlap):
    body = dict(corpus(8))
    filler = body[600].split()
    rows = [r for r in corpus(8) if r[0] not in (503, 504)]
    rows += [(700 + k, " ".join([*filler[: 37 * k], *t.upper().split(), *filler[5000: 5100 + k]])) for k, (_, t) in enumerate(ITEMS) if t]
    rows += [(720, ITEMS[0][1][:44]), (721, ITEMS[0][1].replace("river", "stream")), (722, ITEMS[6][1].replace(" ", ", "))]
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, doc_id int")
    columns = ("doc_id", "item_id", "score", "question_overlap", "answer_overlap")
    want = brute(rows, ITEMS, least, overlap)
    assert len(want) >= 5
    for words in (500_000, 20):
        monkeypatch.setattr(D, "SHARD_WORDS", words)
        got = D.contaminated(with_clashes(frame(spark, rows)), items, least, overlap).collect()
        rows_got = [tuple(r[c] for c in columns) for r in sorted(got, key=lambda r: (r.doc_id, r.item_id))]
        assert [r[:2] for r in rows_got] == [r[:2] for r in want]
        assert np.abs(np.array(rows_got) - np.array(want)).max() < 2e-6


def test_decontamination_of_nothing(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert D.contaminated(frame(spark, []), items).count() == 0
    assert D.contaminated(frame(spark, corpus()), items.where("item_id is null")).count() == 0


# --- language ------------------------------------------------------------------------


def tongues(count=240):
    import random

    r = random.Random(2)
    parts = {"aa": ["the", "ing", "tion", "wh", "sh", "and"], "bb": ["sch", "ung", "keit", "der", "ein", "ver"], "cc": ["que", "eau", "ment", "oi", "les", "aux"]}
    rows = []
    for i in range(count):
        lang = sorted(parts)[i % 3]
        rows.append((i, " ".join("".join(r.choice(parts[lang]) for _ in range(r.randrange(1, 4))) for _ in range(r.randrange(20, 200))), lang))
    return rows


def test_held_out_accuracy_and_odd_rows(spark):
    rows = tongues() + [(1000, None, "aa"), (1001, "", "bb"), (1002, "123 !?", "cc"), (1003, "keit " * 40_000, None), (None, "the and the shing", "aa"), (1004, "ung ein keit verung", None), (0, "ung ein keit " * 20, "bb")]
    docs = spark.createDataFrame([(*x, 1, 2) for x in rows], "doc_id long, text string, lang string, row int, low int").repartition(3)
    got = L.predict_languages(docs)
    by = {}
    for r in got.collect():
        by.setdefault(r.doc_id, []).append(r)
        assert 0 <= r.score <= 1
    assert sum(map(len, by.values())) == len(rows)
    assert all(by[i][0].lang_pred == "und" and by[i][0].rejected for i in (1000, 1001, 1002))
    held = [i for i, _, _ in tongues() if by[i][0].held_out]
    assert len(held) > 30
    langs = {i: x for i, _, x in tongues()}
    assert np.mean([by[i][0].lang_pred == langs[i] for i in held]) >= 0.97
    assert by[1003][0].lang_pred == "bb"
    import zlib

    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, rs in by.items() if i is not None for r in rs)


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs = spark.createDataFrame(tongues(), "doc_id long, text string, lang string")
    other = docs.withColumn("lang", F.when(L.held_out(F.col("doc_id")), "zz").otherwise(F.col("lang")))
    assert tuples(L.predict_languages(docs), "*") == tuples(L.predict_languages(other), "*")


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert tuples(L.predict_languages(docs), "*") == [(1, False, "und", 0.0, True)]
    assert L.predict_languages(docs.limit(0)).count() == 0


def test_whole_groups_and_their_pairs():
    """Groups stay whole whatever the batches, and every two rows of a group meet once."""
    from slotwise.llm.common import pairs_in_groups, whole_groups

    keys = [1, 1, 1, 2, 3, 3, 4, 5, 5, 5, 5]
    whole = pa.RecordBatch.from_pydict({"k": keys, "u": [0] * len(keys), "v": list(range(len(keys)))})
    for size in (1, 2, 3, 11):
        met = set()
        for table, starts in whole_groups((whole.slice(i, size) for i in range(0, len(keys), size)), ["k", "u"]):
            v = table.column("v").to_numpy()
            a, b = pairs_in_groups(starts, table.num_rows)
            assert len(a) == len({*zip(a.tolist(), b.tolist(), strict=True)})
            met |= {*zip(v[a].tolist(), v[b].tolist(), strict=True)}
        assert met == {(i, j) for j in range(len(keys)) for i in range(j) if keys[i] == keys[j]}
    assert list(whole_groups(iter([]), ["k"])) == []


def test_more_languages_than_full_samples(spark):
    """Every language is learned, also the rarer ones beyond the bound, with smaller samples."""
    import random

    r = random.Random(4)
    rows = []
    for k in range(70):
        own = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(12)]
        rows += [(100 * k + i, " ".join(r.choice(own) for _ in range(40)), f"l{k:02}") for i in range(12 if k < 64 else 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    found = {x.doc_id: x.lang_pred for x in L.predict_languages(docs).collect()}
    assert len(found) == len(rows) and all(found[i] == lang for i, _, lang in rows)
    few = L.fit(docs.select("text", "lang"), pieces=6, languages=35)
    assert len(few) == 70 and all(0 < len(x) < 3 * 400 for x in few.values())


@pytest.mark.parametrize("ending", ["It is Brenno.", "It was Brenna.", "Is Brenna.", ""])
def test_short_answer_changed_or_missing(spark, ending):
    """An item stands in a text though a word of its short answer is another one, or the answer is left out."""
    question = "Which slow river with three stone bridges runs through the old market town of Kell in summer?"
    items = [(1, f"{question} It is Brenna."), *[x for x in ITEMS if x[0] in (2, 3)]]
    rows = [(1, f"before this {question} {ending} and after that"), (2, "Which slow river has three bridges? It is Brenna.")]
    got = D.contaminated(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    assert tuples(got, "doc_id", "item_id") == [(1, 1)]
