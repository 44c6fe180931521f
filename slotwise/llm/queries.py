"""One registered query for each corpus operator, with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.llm import jaccard_join, prefix_trie, secrets, topk_search
from slotwise.llm.alignment import align
from slotwise.llm.common import table
from slotwise.llm.decontaminate import contaminated
from slotwise.llm.language_id import predict_languages
from slotwise.llm.line_dedup import line_dedup
from slotwise.llm.neighbours import nearest
from slotwise.llm.packing import pack
from slotwise.llm.personal_data import find_personal_data
from slotwise.llm.repair import repair_round_trip
from slotwise.llm.substring_dedup import remove_repeats

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_ngram_jaccard_join(spark, d):
    return jaccard_join.near_duplicates(table(spark, d, "documents"))


ORACLES["op1_ngram_jaccard_join"] = jaccard_join.ORACLE


@query
def op2_topk_search(spark, d):
    return topk_search.top_k(table(spark, d, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLES["op2_topk_search"] = topk_search.ORACLE


@query
def op3_personal_data(spark, d):
    return find_personal_data(table(spark, d, "documents"))


@query
def op4_line_dedup(spark, d):
    return line_dedup(table(spark, d, "documents"), with_text=False)


@query
def op5_repair_ids(spark, d):
    return repair_round_trip(table(spark, d, "documents"))


@query
def op6_language_id(spark, d):
    return predict_languages(table(spark, d, "documents"))


@query
def op7_packing(spark, d):
    return pack(table(spark, d, "documents"))


@query
def op8_secret_scan(spark, d):
    return secrets.scan_secrets(table(spark, d, "documents"))


ORACLES["op8_secret_scan"] = secrets.oracle()


@query
def op9_decontaminate(spark, d):
    return contaminated(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query
def op10_substring_dedup(spark, d):
    return remove_repeats(table(spark, d, "documents"), with_text=False)


@query
def op11_prefix_trie(spark, d):
    return prefix_trie.prefix_trie(table(spark, d, "conversations"))


ORACLES["op11_prefix_trie"] = prefix_trie.ORACLE


@query
def op12_tokenizer_alignment(spark, d):
    return align(table(spark, d, "documents"))


@query
def op13_nearest_neighbours(spark, d):
    return nearest(table(spark, d, "embeddings"), F.col("vec_id") % 50 == 0)
