"""Secret scan with Spark expressions only: fixed patterns, and windows of high Shannon entropy."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"

WINDOW = 20
#: Class of a candidate: the strings it takes, and the bits per character a window must reach.
CLASSES = (
    ("entropy_hex", "^[0-9A-Fa-f]+$", 3.0),
    ("entropy_alnum", "^[0-9A-Za-z]+$", 3.6),
    ("entropy_base64", "^[0-9A-Za-z+/_=-]+$", 3.8),
)
KINDS = ("assign", "access", "hex", *(name for name, _, _ in CLASSES))
#: Candidates that are no secrets though they look random: UUIDs, dashed words, dates and numbers, paths, samples.
ALLOWED = (
    r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",
    r"^[A-Za-z]*([-_/][A-Za-z]*)*([-_/=]?[0-9]{1,4})?$",
    r"^[0-9+/_=-]+$",
    r"(?i)example|sample|placeholder|dummy|changeme|xxxx",
)
UNIT = 1_000_000
FIRST_CODE, CODES = 43, 80


def _weight(count: int) -> int:
    """count * log2(count) in millionths, so that sums are exact whatever their order."""
    return round(count * math.log2(count) * UNIT) if count else 0


def _most(bits: float, window: int) -> int:
    """Entropy of at least ``bits`` in a window of ``window`` means a sum of weights of at most this."""
    return math.floor(window * (math.log2(window) - bits) * UNIT)


def _located(text: Column, pattern: str) -> Column:
    """array<struct<start, end, hit>> of the matches, in code points.

    What lies between matches (``split``) and the matches (``regexp_extract_all``) come from the same
    leftmost search, so their lengths add up to the places.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    none = F.expr("cast(array() as array<struct<start: int, end: int, hit: string>>)")
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), hits, lambda g, h: F.struct(F.char_length(g).alias("g"), h.alias("h")))
    walked = F.aggregate(
        steps, F.struct(F.lit(0).alias("at"), none.alias("out")),
        lambda a, s: F.struct(
            (a["at"] + s["g"] + F.char_length(s["h"])).alias("at"),
            F.concat(a["out"], F.array(F.struct(
                (a["at"] + s["g"]).alias("start"), (a["at"] + s["g"] + F.char_length(s["h"])).alias("end"), s["h"].alias("hit"),
            ))).alias("out"),
        ),
    )
    return F.when(text.rlike(pattern), walked["out"]).otherwise(none)


def _least_weight(candidate: Column, window: int) -> Column:
    """Smallest sum of weights over the windows of ``candidate``: entropy is highest there.

    One pass; the counts of the window change by the character that enters and the one that leaves.
    """
    weights = F.array(*[F.lit(_weight(c)).cast("long") for c in range(window + 2)])
    codes = F.transform(F.split(candidate, ""), lambda c: F.ascii(c) - FIRST_CODE)
    steps = F.transform(codes, lambda c, i: F.struct(c.alias("c"), F.when(i >= window, F.get(codes, i - window)).otherwise(-1).alias("gone"), i.alias("i")))
    start = F.struct(
        F.array_repeat(F.lit(0), CODES).alias("counts"), F.lit(0).cast("long").alias("sum"), F.lit(None).cast("long").alias("least"),
    )

    def step(a: Column, s: Column) -> Column:
        came, gone = F.get(a["counts"], s["c"]), F.get(a["counts"], s["gone"])
        counts = F.transform(a["counts"], lambda n, k: n + (k == s["c"]).cast("int") - (k == s["gone"]).cast("int"))
        change = F.when(s["c"] == s["gone"], F.lit(0).cast("long")).otherwise(
            F.get(weights, came + 1) - F.get(weights, came)
            + F.when(s["gone"] >= 0, F.get(weights, gone - 1) - F.get(weights, gone)).otherwise(0)
        )
        now = a["sum"] + change
        least = F.when(s["i"] >= window - 1, F.least(a["least"], now)).otherwise(a["least"])
        return F.struct(counts.alias("counts"), now.alias("sum"), least.alias("least"))

    return F.aggregate(steps, start, step)["least"]


def _spans(found: Column, kind: str) -> Column:
    return F.transform(found, lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), x["end"].alias("end")))


def _text(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.get(kinds, x["kind"]), x["start"], x["end"])), ",")


def scan_secrets(docs: DataFrame, window: int = WINDOW, classes: Sequence = CLASSES, allowed: Sequence[str] = ALLOWED) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_assign, n_access, n_hex, base_sha256, spans, n_added.

    Base spans follow fixed patterns. A candidate (a run of 20 or more of ``A-Za-z0-9+/_=-`` with a
    letter and a digit) that meets no base span and no pattern of ``allowed`` is added if a window of ``window``
    characters reaches the entropy of the first class that takes it. Offsets are code points, ends exclusive.
    Null and empty texts have no spans; rows are answered one by one, so repeated rows and ties in doc_id are kept;
    other columns are ignored. A candidate shorter than ``window`` has no window and is not added.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    located = rows.select(
        "doc_id",
        F.filter(_located(F.col("text"), ASSIGN), lambda x: F.char_length(F.regexp_extract(x["hit"], ASSIGN, 2)) >= 6).alias("assign"),
        _located(F.col("text"), ACCESS).alias("access"),
        _located(F.col("text"), HEX).alias("hex"),
        F.filter(
            _located(F.col("text"), CANDIDATE),
            lambda x: x["hit"].rlike("[0-9]") & x["hit"].rlike("[A-Za-z]")
            & ~F.array_contains(F.array(*[x["hit"].rlike(p) for p in allowed] or [F.lit(False)]), True),
        ).alias("candidates"),
    )
    base = F.concat(*[_spans(F.col(k), k) for k in KINDS[:3]])
    located = located.withColumn("base", base).withColumn(
        "free", F.filter("candidates", lambda x: ~F.exists("base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))),
    )
    scored = located.withColumn(
        "scored", F.transform("free", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["hit"].alias("hit"), _least_weight(x["hit"], window).alias("least"))),
    )
    kind = lambda x: F.coalesce(*[
        F.when(x["hit"].rlike(p), F.when(x["least"] <= _most(bits, window), KINDS.index(name)).otherwise(-1)) for name, p, bits in classes
    ], F.lit(-1))
    added = F.filter(
        F.transform("scored", lambda x: F.struct(x["start"].alias("start"), kind(x).alias("kind"), x["end"].alias("end"))), lambda x: x["kind"] >= 0,
    )
    full = scored.withColumn("added", added)
    return full.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(_text(F.col("base")), 256).alias("base_sha256"),
        _text(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


def oracle() -> str:
    """The same rows in DuckDB, every window's entropy counted anew."""
    located = []
    for kind, pattern in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX.split(")", 1)[1]), ("candidate", CANDIDATE.split(")", 1)[1])):
        p = pattern.replace("'", "''")
        located.append(
            f"select row, '{kind}' as kind, list_transform(range(1, len(h) + 1), lambda i: {{'start': list_sum(list_transform(s[1:i], lambda x: length(x))) "
            f"+ coalesce(list_sum(list_transform(h[1:i - 1], lambda x: length(x))), 0), 'hit': h[i]}}) as found from "
            f"(select row, regexp_extract_all(text, '{p}') as h, string_split_regex(text, '{p}') as s from docs)"
        )
    assign = ASSIGN.replace("'", "''")
    allowed = " or ".join(f"regexp_matches(hit, '{p}')" for p in ALLOWED)
    names = "['" + "', '".join(KINDS) + "']"
    classes = " ".join(f"when regexp_matches(hit, '{p}') then case when least <= {_most(bits, WINDOW)} then '{name}' end" for name, p, bits in CLASSES)
    text = f"coalesce(string_agg(kind || ':' || start || ':' || stop, ',' order by start, list_position({names}, kind)), '')"
    return f"""
with docs as (select row_number() over () as row, doc_id, coalesce(text, '') as text from documents),
lists as ({' union all '.join(located)}),
hits as (select row, kind, cast(f.start as bigint) as start, f.hit as hit, cast(f.start + length(f.hit) as bigint) as stop from (select row, kind, unnest(found) as f from lists)),
base as (select * from hits where kind in ('access', 'hex') or (kind = 'assign' and length(regexp_extract(hit, '{assign}', 2)) >= 6)),
free as (select * from hits c where kind = 'candidate' and regexp_matches(hit, '[0-9]') and regexp_matches(hit, '[A-Za-z]') and not ({allowed})
  and not exists (select 1 from base b where b.row = c.row and b.start < c.stop and c.start < b.stop)),
windows as (select row, start, stop, hit, unnest(range(1, length(hit) - {WINDOW} + 2)) as pos from free),
sums as (select row, start, stop, hit, list_sum(list_transform(map_values(list_histogram(string_split(substr(hit, pos, {WINDOW}), ''))),
  lambda c: cast(round(c * log2(c) * {UNIT}) as bigint))) as weight from windows),
added as (select row, start, stop, case {classes} end as kind from (select row, start, stop, hit, min(weight) as least from sums group by all)),
spans as (select row, kind, start, stop from base union all select row, kind, start, stop from added where kind is not null),
counted as (select row, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access, count(*) filter (kind = 'hex') as n_hex,
  count(*) filter (kind like 'entropy%') as n_added, {text} as spans, {text.replace("order by", "order by").replace("kind))", "kind)) filter (kind not like 'entropy%')", 1)} as base
  from spans group by row)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(n_added, 0) as n_added
from docs left join counted using (row)"""
