from pyspark.sql import functions as F

import corpus_pipeline as C
from slotwise.llm.common import table
from slotwise.llm.decontaminate import contaminated
from slotwise.llm.jaccard_join import near_duplicates
from slotwise.llm.language_id import classify, fit, held_out
from tests.llm.frames import frame

FOLDER = "/root/testdata/sf0.001"


def test_stages_on_their_own_input(spark):
    """Each stage takes away what its operator says and keeps the columns; whatever else stays."""
    docs = table(spark, FOLDER, "documents")
    columns = docs.columns
    stages = dict(C.STAGES)
    assert list(stages) == ["language_id", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "packing"]

    kept = stages["language_id"](spark, docs, FOLDER)
    contents = fit(docs.where(~held_out(F.col("doc_id"))).select("text", "lang"))
    rejected = {r[0] for r in classify(docs, contents).where("rejected").select("row.doc_id").collect()}
    assert kept.columns == columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - rejected

    lines = stages["line_dedup"](spark, kept, FOLDER)
    assert lines.columns == columns and lines.count() == kept.count()
    seen = [x for r in lines.collect() for x in (r.text or "").split("\n") if len(x.split()) >= 8]
    assert len(seen) == len(set(seen))

    single = stages["ngram_jaccard_join"](spark, lines, FOLDER)
    assert single.columns == columns
    assert single.count() == near_duplicates(lines).select("group_id").distinct().count()
    assert near_duplicates(single).where("n_links > 0 or class_id <> doc_id").count() == 0

    clean = stages["benchmark_decontamination"](spark, single, FOLDER)
    items = [r.text for r in table(spark, FOLDER, "benchmark").collect()]
    held = {r.doc_id for r in single.collect() if any(i in (r.text or "") for i in items)}
    left = {r.doc_id for r in clean.collect()}
    assert clean.columns == columns and not held & left
    assert contaminated(clean, table(spark, FOLDER, "benchmark")).count() == 0

    packed = stages["packing"](spark, clean, FOLDER)
    whole = {r.doc_id: (r.n, r.t) for r in packed.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).collect()}
    assert set(whole) == left and all(n == t for n, t in whole.values())


def test_copies_and_odd_rows(spark):
    """Hand-made documents: an exact copy, near copies, null and empty texts, repeated and missing ids, more columns."""
    words = [f"word{i}" for i in range(60)]
    text = " ".join(words)
    rows = [(1, text), (2, text), (3, text.replace("word30", "other")), (4, "quite different words in a document of its own here"), (5, None), (6, ""), (None, text), (4, "another text with the same identifier as before")]
    docs = frame(spark, rows).withColumn("row", F.lit(1)).withColumn("gone", F.lit(2))
    out = C.dedup_documents(spark, docs, FOLDER)
    assert out.columns == docs.columns
    assert sorted((r.doc_id for r in out.collect()), key=repr) == sorted([1, 4, 4, 5, None], key=repr)
    lines = C.dedup_lines(spark, docs, FOLDER)
    texts = {r.doc_id: r.text for r in lines.where("doc_id in (1, 2, 5, 6)").collect()}
    assert texts == {1: text, 2: "", 5: None, 6: ""}
    for _, stage in C.STAGES:
        assert stage(spark, docs.limit(0), FOLDER).count() == 0


def test_run_equals_stages(spark):
    got = C.run(spark, FOLDER)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(got.columns) and got.count() > 100
    assert C.ORACLE_SQL is None
