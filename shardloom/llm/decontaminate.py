"""Benchmark decontamination with one Aho-Corasick automaton over the benchmark's windows.

Words follow the rule `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after A-Z are lower-cased. A window is ten consecutive words
of an item; an item of fewer words (but not none) is one window. Each distinct word of the benchmark becomes one
character and every other word one reserved character, so a text is a string with a character for each word: the
automaton scans it once and its matches are word places, which map to offsets in the original text.

The benchmark is collected and broadcast behind a check of its size. Beyond the limit (of bytes, or of the distinct words
that characters can stand for) its items are dealt into blocks, each with an automaton of its own, and every text is
scanned once for each block; only the hits of further blocks are written, and joined back in the end.

Defined cases: a null text has no words; null or empty items have no windows; items of null item_id hit like others and
count as one item without an id in the list; items with equal text are each counted; very long texts and items are
scanned whole; repeated documents each get a row; an empty benchmark hits nothing; extra columns pass through, but a
column named `_ll_hit`, `_ll_k1` or `_ll_k2` is refused.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

WINDOW = 10
#: Bytes of benchmark text in one automaton. It takes about 70 bytes for each of them in a worker, so 280 MB at most.
MOST_BLOCK_BYTES = 4 << 20
#: Every byte that no word holds becomes a space; A-Z are lower-cased before.
TO_SPACES = bytes(32 if b < 0x30 or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F else b for b in range(256))
A_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: The reserved character, and the first that stands for a word of the benchmark, beyond the surrogates.
OTHER, FIRST = "\x01", 0xE000
MOST_WORDS = 0x10FFFF - FIRST


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().translate(TO_SPACES).split()


class Windows:
    """The automaton of some items [(item_id, text)]."""

    def __init__(self, items: list[tuple[int, str]], size: int = WINDOW):
        self.letters: dict[bytes, str] = {}
        self.automaton = ahocorasick.Automaton()
        at: dict[str, set] = {}
        for item, text in items:
            ws = words(text.encode())
            for w in ws:
                if w not in self.letters:
                    if len(self.letters) >= MOST_WORDS:
                        raise ValueError("too many distinct words for one automaton; use smaller blocks")
                    self.letters[w] = chr(FIRST + len(self.letters))
            line = "".join([self.letters[w] for w in ws])
            for i in range(max(len(line) - size, 0) + 1):
                if line:
                    at.setdefault(line[i : i + size], set()).add(item)
        for window, ids in at.items():
            self.automaton.add_word(window, (len(window), tuple(ids)))
        self.empty = not at
        if at:
            self.automaton.make_automaton()

    def scan(self, text: bytes | None) -> tuple[int, list[tuple[int, int]], set]:
        """Number of words, runs of hit words [start, end), item ids."""
        ws = words(text)
        if self.empty:
            return len(ws), [], set()
        letter = self.letters.get
        runs, ids = [], set()
        for end, (n, found) in self.automaton.iter("".join([letter(w, OTHER) for w in ws])):
            ids.update(found)
            start = end - n + 1
            while runs and runs[-1][1] >= start:  # matches come by their ends; a longer one may reach further back
                start = min(start, runs.pop()[0])
            runs.append((start, end + 1))
        return len(ws), runs, ids


def scanner(spark: SparkSession, items: list[tuple[int, str]]):
    """Column function text -> struct(n_words, runs array<array<int>>, items array<long>, spans array<array<int>>); spans
    are offsets in characters of the original text."""
    rows, key = spark.sparkContext.broadcast(items), "aho" + common.digest_of(repr(sorted(items, key=repr)).encode())

    def work(texts: pa.Array) -> pa.Array:
        w = common.per_worker(lambda: Windows(rows.value), key, "aho")
        out = []
        for text in texts.cast(pa.binary()).to_pylist():
            n, runs, ids = w.scan(text)
            spans = []
            if runs:
                places = [m.span() for m in A_WORD.finditer(text.decode())]
                spans = [[places[a][0], places[b - 1][1]] for a, b in runs]
            out.append({"n_words": n, "runs": [[*r] for r in runs], "items": sorted(ids, key=lambda i: (i is None, i or 0)), "spans": spans})
        return pa.array(out, pa.struct([("n_words", pa.int64()), ("runs", pa.list_(pa.list_(pa.int32()))), ("items", pa.list_(pa.int64())), ("spans", pa.list_(pa.list_(pa.int32())))]))

    return F.arrow_udf(work, "n_words long, runs array<array<int>>, items array<long>, spans array<array<int>>")


def pieces(item_id: int | None, text: str, most_words: int) -> Iterator[tuple[int | None, str]]:
    """An item in pieces of at most most_words words that overlap so that each window is whole in one."""
    ws = words(text.encode())
    if len(ws) <= most_words:
        yield item_id, text
        return
    for at in range(0, len(ws) - WINDOW + 1, most_words - WINDOW + 1):
        yield item_id, b" ".join(ws[at : at + most_words]).decode()


def blocks_of(items: DataFrame, most_bytes: int, most_words: int = MOST_WORDS) -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks that each fit an automaton; at least one block."""
    items = items.select(F.col("item_id").cast("long"), "text").where("text is not null")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = -(-size // most_bytes) or 1
    dealt = items.withColumn("b", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
    for b in range(n):
        block, known = [], set()
        for row in dealt.where(F.col("b") == b).collect():
            for piece in pieces(row[0], row[1], max(most_words // 2, WINDOW)):
                new = {*words(piece[1].encode())}
                if block and len(known | new) > most_words:
                    yield block
                    block, known = [], set()
                block.append(piece)
                known |= new
        yield block


def scan(docs: DataFrame, items: DataFrame, most_bytes: int = MOST_BLOCK_BYTES, most_words: int = MOST_WORDS) -> DataFrame:
    """docs with _ll_hit: struct(n_words, runs, items, spans). No shuffle while the benchmark is one block."""
    common.refuse(docs, "_ll_hit", "_ll_k1", "_ll_k2")
    spark, blocks, more = docs.sparkSession, blocks_of(items, most_bytes, most_words), []
    first = docs.withColumn("_ll_hit", scanner(spark, next(blocks))("text"))
    text = F.coalesce("text", F.lit(""))
    key = {"_ll_k1": F.xxhash64(text), "_ll_k2": F.xxhash64(F.lit(7), text)}
    for block in blocks:
        found = docs.select(*[v.alias(k) for k, v in key.items()], scanner(spark, block)("text").alias("h")).where(F.size("h.runs") > 0)
        more.append(common.cut(found.select(*key, "h.runs", "h.items", "h.spans"), "hits"))
    if not more:
        return first
    all_hits = reduce(DataFrame.unionByName, more).groupBy(*key).agg(*[F.array_distinct(F.flatten(F.collect_set(k))).alias(k) for k in ("runs", "items", "spans")])
    both = first.withColumns(key).join(common.cut(all_hits, "hits").hint("merge"), [*key], "left")
    merged = {k: F.concat(f"_ll_hit.{k}", F.coalesce(F.col(k), F.expr(f"slice(_ll_hit.{k}, 1, 0)"))) for k in ("runs", "items", "spans")}
    return both.select(*[F.col(f"`{c}`") for c in docs.columns], F.struct(F.col("_ll_hit.n_words").alias("n_words"), *[v.alias(k) for k, v in merged.items()]).alias("_ll_hit"))


def n_hit(runs: Column) -> Column:
    """Words that any run holds: runs of several blocks may overlap, so they are put in order and counted once."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("to"))
    step = lambda s, r: F.struct((s["n"] + F.greatest(r[1] - F.greatest(r[0], s["to"]), F.lit(0))).alias("n"), F.greatest(s["to"], r[1]).alias("to"))
    return F.aggregate(F.array_sort(runs), start, step, lambda s: s["n"])


def told(hit: DataFrame) -> DataFrame:
    ids = F.array_sort(F.transform(F.array_distinct("_ll_hit.items"), lambda x: x.cast("string")))
    return hit.select(
        "doc_id", F.col("_ll_hit.n_words").alias("n_words"), n_hit(F.col("_ll_hit.runs")).alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.size("_ll_hit.runs") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of docs that no window hits, with docs' columns."""
    return scan(docs, items).where(F.size("_ll_hit.runs") == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return told(scan(common.read(spark, sf_dir, "documents").select("doc_id", "text"), common.read(spark, sf_dir, "benchmark")))


#: Words of both tables in DuckDB; every occurrence of a window marks its words.
ORACLE = r"""
with d as (select doc_id, row_number() over (order by doc_id) r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark),
win as (select distinct item_id, least(len(w), 10) n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') g from (select *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) i from b where len(w) > 0)),
lens as (select distinct n from win),
pos as (select r, n, unnest(range(1, len(w) - n + 2)) i, w from d, lens),
hit as (select r, i, n, item_id from (select r, i, n, array_to_string(w[i:i + n - 1], ' ') g from pos) join win using (n, g)),
marked as (select r, count(distinct p) n_hit from (select r, unnest(range(i, i + n)) p from hit) group by r),
its as (select r, count(*) n_items, string_agg(s, ',' order by s) ids from (select distinct r, item_id::varchar s from hit) group by r)
select doc_id, len(w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items, sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join marked using (r) left join its using (r)
"""
