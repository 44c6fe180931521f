"""Small corpora with the odd rows that every operator must take."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(seed=1, count=40):
    """Texts with exact and near copies, shared passages, repeated rows and ids, nulls, empties and a very long text."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 7))) for _ in range(400)]
    sentence = lambda n: " ".join(r.choice(vocabulary) for _ in range(n)).capitalize() + "."
    passage = " ".join(sentence(12) for _ in range(6))
    rows = []
    for i in range(count):
        rows.append((i * 3 + 1, "\n".join(sentence(r.randrange(4, 30)) for _ in range(r.randrange(1, 9)))))
    texts = [t for _, t in rows]
    rows += [(200 + i, texts[i % 5]) for i in range(10)]
    rows += [(300 + i, texts[7] + "\n" + " ".join(r.choice(vocabulary) for _ in range(i))) for i in range(6)]
    rows += [(400 + i, sentence(9) + " " + passage + " " + sentence(i + 3)) for i in range(6)]
    rows += [(500, None), (501, ""), (502, "   \n\t "), (503, "ein wort"), (503, "ein anderes wort mit derselben kennung"), (504, texts[0]), (504, texts[0])]
    rows += [(None, texts[1]), (None, None), (600, " ".join(r.choice(vocabulary) for _ in range(30_000))), (601, "x" * 50_000)]
    return rows


def frame(spark, rows, partitions=3):
    data = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
    return spark.createDataFrame(data, SCHEMA).repartition(partitions)


def with_clashes(docs):
    """Columns whose names the operators use themselves."""
    names = ["s", "tk", "row", "spans", "low", "gone", "score", "key", "sig", "kept", "shard", "rank"]
    return docs.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])


def tuples(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
