"""Language by compression: the zstandard dictionary of the right language makes a text smallest.

One raw-content dictionary for each language is filled with pieces of a bounded sample of labelled rows. A text is
encoded whole, in chunks, with every dictionary, and the language of the smallest sum wins. Where the two smallest sums
lie close together the text is rejected.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import slices

#: Bounds of the sample: pieces for each language, bytes of a piece, languages that get all their pieces.
PIECES, PIECE_BYTES, LANGUAGES = 224, 512, 64
CHUNK = 4096
LEVEL = 5
MARGIN = 0.005
UNKNOWN = "und"

_LETTERS = bytes(c if c > 127 or chr(c).isalpha() else 32 for c in range(256))


def normal(text: str) -> bytes:
    """Words of a lower-case text without ASCII digits and punctuation."""
    return b" ".join(text.encode().translate(_LETTERS).split())


def held_out(ident: Column) -> Column:
    """Documents that nothing is learned from."""
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(labelled: DataFrame, pieces: int = PIECES, piece_bytes: int = PIECE_BYTES, languages: int = LANGUAGES) -> dict[str, bytes]:
    """Dictionary content by language from (text, lang).

    ``pieces`` hash classes of a language give one text each, that of the smallest hash: a sample found with an aggregation
    over all rows and fetched with a second pass. Every language is learned; if there are more than ``languages``, each
    has fewer pieces, so that the sample stays at ``languages * pieces`` rows or one a language.
    """
    rows = labelled.where("text is not null and lang is not null").select("lang", "text", F.xxhash64("text").alias("h"))
    known = [r.lang for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()]
    if not known:
        return {}
    pieces = max(1, pieces * languages // max(languages, len(known)))
    least = rows.groupBy("lang", F.pmod("h", F.lit(pieces)).alias("class")).agg(F.min("h").alias("h"))
    wanted = labelled.sparkSession.createDataFrame(least.select("lang", "h").collect(), "lang string, h long")
    piece = F.substring(F.lower("text"), 1, 4 * piece_bytes)
    found = rows.join(F.broadcast(wanted), ["lang", "h"]).select("lang", "h", piece.alias("piece")).dropDuplicates(["lang", "h"]).collect()
    own = {lang: [] for lang in known}
    for r in sorted(found, key=lambda r: r.h):
        own[r.lang].append(normal(r.piece)[:piece_bytes])
    out = {lang: b" ".join(p for p in parts if p) for lang, parts in own.items()}
    return {lang: content for lang, content in out.items() if content}


class Sizes:
    """Compressed size of a text by language."""

    def __init__(self, contents: dict[str, bytes]):
        self.languages = list(contents)  # the most frequent first, so it takes ties
        self.coders = []
        for lang in self.languages:
            dictionary = zstandard.ZstdCompressionDict(contents[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(level=LEVEL)
            self.coders.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False))

    def best(self, text: bytes) -> tuple[str, float]:
        """Language and margin between its size and the next one, as a share of the latter."""
        chunks = [text[i: i + CHUNK] for i in range(0, len(text), CHUNK)]
        sizes = np.array([sum(len(c.compress(x)) for x in chunks) for c in self.coders])
        first = int(sizes.argmin())
        if len(sizes) == 1:
            return self.languages[0], 1.0
        second = np.partition(sizes, 1)[1]
        return self.languages[first], float(second - sizes[first]) / float(second)


def classify(docs: DataFrame, contents: dict[str, bytes], margin: float = MARGIN) -> DataFrame:
    """(row, lang_pred, score, rejected) for each row of ``docs``; ``row`` holds all its columns, whatever their names.

    ``score`` is the margin, 0 to 1. A text that is null or has no letter, and every text if nothing was learned, is
    ``und`` with score 0. Rejected are texts without language and those whose margin lies below ``margin``.
    """
    text = F.col("text").cast("string")
    rows = docs.select(F.struct("*").alias("row"), F.when(text.rlike(r"\p{L}"), F.lower(text)).alias("low"))

    def run(batches):
        sizes = Sizes(contents)
        for batch in batches:
            for part in slices(batch, "low"):
                found = [sizes.best(normal(x)) if x is not None and sizes.coders else (UNKNOWN, 0.0) for x in part.column("low").to_pylist()]
                score = [round(s, 9) for _, s in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array([x for x, _ in found], pa.string()), pa.array(score, pa.float64()),
                     pa.array([x == UNKNOWN or s < margin for (x, _), s in zip(found, score, strict=True)], pa.bool_())],
                    ["row", "lang_pred", "score", "rejected"])

    schema = f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double, rejected boolean"
    return rows.mapInArrow(run, schema)


def predict_languages(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, lang): doc_id, held_out, lang_pred, score, rejected.

    Languages are learned from rows with text and lang that ``held_out`` does not take; a null doc_id is not held out, but
    nothing is learned from it either. Only the text enters a prediction. Repeated rows are answered each; other columns are
    ignored; an empty table gives no rows.
    """
    contents = fit(docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("text", "lang"))
    return classify(docs.select("doc_id", "text"), contents).select(
        F.col("row.doc_id").alias("doc_id"), held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
