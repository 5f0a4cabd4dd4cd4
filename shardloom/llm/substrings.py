"""Substring dedup by hashing units of text: sentences within lines (or whole lines, or paragraphs).

A text is cut into units whose concatenation is the text: a sentence reaches to the end of a run of `.`, `!`, `?` and line
ends. A unit is normalised (A-Z lower-cased, runs of ASCII blanks to one, trimmed) and digested to 128 bits. Digests are
grouped over all rows with partial aggregation, and each keeps its occurrence of lowest rank: doc_id (nulls last), then a
hash of the row, then the place in the text. All other occurrences are later copies.

A passage that repeats is a run of neighbouring later copies. It goes where its units of SHORT words or more hold
RUN_WORDS words or more together; shorter runs are what strangers share by chance or as boilerplate, and stay. So what
repeats is found wherever it stands in a line, but for the words that share a unit with the text around it.

The texts are cut once; a row gives its distinct digests, and only places in that list travel back. Units that repeat
within their own text are told when the text is cut, so between rows one number, the place of the row, orders all
occurrences. A row is known by 128 bits of its doc_id and text; where equal rows repeat, the first keeps what the group
keeps, and in the others every unit is a later copy.

Defined cases: null text is the empty text, which has no units; units without words never match, stay, and neither break
nor lengthen a run; a text all of whose units go becomes the empty text; very long texts are cut like others, a task
holds one text and its units at a time; doc_id is an integer of at most 64 bits; an empty table gives an empty result; a
column of docs with an output's name (text, n_units, n_removed, removed_words, removed) gives way to the output, and one
with a name of KEY, `_ll_text` or `_ll_copy` is refused.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Words of the shortest run that goes, and of the shortest unit that counts towards it.
RUN_WORDS, SHORT = 25, 3
UNITS = {
    "sentence": re.compile(rb"[^.!?\n]*[.!?\n]+|[^.!?\n]+"),
    "line": re.compile(rb"[^\n]*\n|[^\n]+"),
    "paragraph": re.compile(rb"(?:[^\n]|\n(?!\n))*\n\n+|(?:[^\n]|\n(?!\n))+"),
}
KEY = ["_ll_k1", "_ll_k2"]
OUTPUTS = ("text", "n_units", "n_removed", "removed_words", "removed")
_TOLD = "n_units long, own boolean, h1 array<long>, h2 array<long>"
_LEFT = "text string, removed array<struct<start: long, end: long>>, removed_words long"


def plain(units: list[bytes]) -> list[bytes]:
    """The units normalised."""
    return [b" ".join(u.lower().split()) for u in units]


def gone(said: list[bytes], later: list[bool], run_words: int) -> list[bool]:
    """Which units go: those in runs of later copies that hold run_words words or more. said: the units normalised."""
    out, run, words = [False] * len(said), [], 0
    for i, p in enumerate(said):
        if p and later[i]:
            n = p.count(b" ") + 1
            run.append(i)
            words += n if n >= SHORT else 0
        if p and not later[i] or i == len(said) - 1:
            if words >= run_words:
                for j in run:
                    out[j] = True
            run, words = [], 0
    return out


def repeats(said: list[bytes]) -> list[bool]:
    """Which units stand earlier in the same text."""
    seen: set[bytes] = set()
    return [p in seen or bool(seen.add(p)) for p in said]


def teller(unit: str, run_words: int):
    """Column function text -> struct: number of units, whether runs within the text alone go, digests of the distinct
    units in order of first occurrence."""
    find = UNITS[unit].findall

    def work(texts: pa.Array) -> pa.Array:
        n, own, sizes, digests = [], [], [0], []
        for text in texts.cast(pa.binary()):
            said = plain(find(text.as_py() or b""))
            order = dict.fromkeys(said)
            order.pop(b"", None)
            n.append(len(said))
            own.append(len(order) < len(said) and any(gone(said, repeats(said), run_words)))
            sizes.append(len(order))
            digests.append(b"".join(map(xxhash.xxh3_128_digest, order)))
        flat, offsets = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2), pa.array(np.cumsum(sizes).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(flat[:, i]))) for i in (0, 1)]
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(own, pa.bool_()), *lists], ["n_units", "own", "h1", "h2"])

    return F.arrow_udf(work, _TOLD)


def remover(unit: str, run_words: int):
    """Column function (text, places of the distinct units that are later copies, whether all are) -> struct: the text that
    is left, start and end of each unit removed in characters of the original, and the words removed."""
    find = UNITS[unit].findall

    def one(text: bytes, places: list[int], copy: bool) -> dict:
        us = find(text)
        said = plain(us)
        later = repeats(said)
        order = dict.fromkeys(said)
        order.pop(b"", None)
        names = [*order]
        known = {names[i] for i in places}
        goes = gone(said, [copy or a or p in known for p, a in zip(said, later, strict=True)], run_words)
        at, spans = 0, []
        for u, g in zip(us, goes, strict=True):
            n = len(u.decode())
            if g:
                spans.append({"start": at, "end": at + n})
            at += n
        return {"text": b"".join(u for u, g in zip(us, goes, strict=True) if not g).decode(), "removed": spans, "removed_words": sum(p.count(b" ") + 1 for p, g in zip(said, goes, strict=True) if g)}

    def work(texts: pa.Array, places: pa.Array, copies: pa.Array) -> pa.Array:
        rows = zip(texts.cast(pa.binary()), places, copies, strict=True)
        return pa.array([None if (t := text.as_py()) is None else one(t, some.as_py() or [], copy.as_py()) for text, some, copy in rows], pa.struct([("text", pa.string()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("removed_words", pa.int64())]))

    return F.arrow_udf(work, _LEFT)


def keyed(docs: DataFrame) -> DataFrame:
    common.refuse(docs, *KEY, "_ll_text", "_ll_copy")
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumns({"_ll_text": text, "_ll_k1": F.xxhash64("doc_id", text), "_ll_k2": F.xxhash64(F.lit(7), text, "doc_id")})


def place() -> Column:
    """A row's place among all rows as one number of at most 38 digits, which a hash aggregation can take the least of:
    doc_id, then 63 bits of the row's hash; null ids come after all others."""
    big = lambda n: F.lit(f"{n}").cast("decimal(38,0)")
    low = F.col("_ll_k1").bitwiseAND(F.lit(2**63 - 1)).cast("decimal(38,0)")
    high = F.col("doc_id").cast("long").cast("decimal(19,0)") * F.lit(f"{10**19}").cast("decimal(20,0)")
    return (F.coalesce(high.cast("decimal(38,0)"), big(95 * 10**36)) + low).cast("decimal(38,0)")


def dedup_units(docs: DataFrame, unit: str = "sentence", run_words: int = RUN_WORDS) -> DataFrame:
    """docs without later copies of passages: columns of docs with text cleaned, and n_units, n_removed, removed_words,
    removed (start and end of each removed unit in characters of the original text)."""
    rows = keyed(docs)
    told = rows.select(*KEY, place().alias("place"), teller(unit, run_words)("_ll_text").alias("s"))
    told = common.cut(told.select(*KEY, "place", "s.*"), "units")
    each = told.select(*KEY, "place", "h2", F.posexplode("h1").alias("at", "a")).select(*KEY, "place", "at", "a", F.get("h2", F.col("at")).alias("b"))
    firsts = each.groupBy("a", "b").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("a", "b", "first")
    later = each.join(common.cut(firsts, "firsts"), ["a", "b"]).where("place > first").select(*KEY, "at")
    # what is known of each row, one row for a row's digests and one for each later copy
    known = told.select(*KEY, "n_units", "own", F.lit(None).cast("int").alias("at")).unionByName(later.select(*KEY, F.lit(None).cast("long").alias("n_units"), F.lit(None).cast("boolean").alias("own"), "at"))
    known = known.groupBy(*KEY).agg(F.max("n_units").alias("_ll_n"), F.max("own").alias("_ll_own"), F.collect_list("at").alias("_ll_at"))
    found = rows.withColumn("_ll_copy", F.row_number().over(Window.partitionBy(*KEY).orderBy(F.lit(1))) > 1).join(known, KEY)
    # only texts that may lose something go through Python
    touched = F.col("_ll_copy") | F.col("_ll_own") | (F.size("_ll_at") > 0)
    found = found.withColumn("_ll_left", remover(unit, run_words)(F.when(touched, F.col("_ll_text")), "_ll_at", "_ll_copy"))
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in OUTPUTS]
    spans = F.coalesce("_ll_left.removed", F.array().cast("array<struct<start: bigint, end: bigint>>"))
    return found.select(*kept, F.coalesce("_ll_left.text", "_ll_text").alias("text"), F.col("_ll_n").alias("n_units"), F.size(spans).cast("long").alias("n_removed"), F.coalesce("_ll_left.removed_words", F.lit(0)).cast("long").alias("removed_words"), spans.alias("removed"))


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return common.spans_as_text(dedup_units(common.read(spark, sf_dir, "documents").select("doc_id", "text")))


#: DuckDB twin: units of all rows with their places (equal rows told by number), later copies, runs of them, and the rest.
ORACLE = rf"""
with d as (select *, row_number() over (order by doc_id, text) r from (select doc_id, coalesce(text, '') text from documents)),
u as (select doc_id, r, unnest(us) u, unnest(range(len(us))) i from (select doc_id, r, regexp_extract_all(text, '[^.!?\n]*[.!?\n]+|[^.!?\n]+') us from d)),
p as (select *, trim(regexp_replace(translate(u, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x09-\x0D ]+', ' ', 'g'), ' ') p,
  sum(len(u)) over (partition by r order by i) - len(u) a from u),
w as (select *, len(p) - len(replace(p, ' ', '')) + 1 words, row_number() over (partition by p order by doc_id, r, i) > 1 later,
  row_number() over (partition by r order by i) j from p where p <> ''),
g as (select *, j - row_number() over (partition by r, later order by j) run from w),
s as (select *, later and sum(case when words >= {SHORT} then words else 0 end) over (partition by r, later, run) >= {RUN_WORDS} gone from g),
f as (select p.r, p.i, p.u, p.a, coalesce(s.gone, false) gone, coalesce(s.words, 0) words from p left join s using (r, i)),
k as (select r, string_agg(u, '' order by i) filter (not gone) text, count(*)::bigint n_units, (count(*) filter (gone))::bigint n_removed, coalesce(sum(words) filter (gone), 0)::bigint removed_words,
  string_agg(a::bigint || '-' || (a + len(u))::bigint, ',' order by i) filter (gone) removed from f group by r)
select d.doc_id, coalesce(k.text, '') text, coalesce(n_units, 0)::bigint n_units, coalesce(n_removed, 0)::bigint n_removed, coalesce(removed_words, 0)::bigint removed_words, coalesce(removed, '') removed
from d left join k using (r)
"""
