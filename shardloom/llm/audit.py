"""How filters interact: what each of them removes at each step of every order in which they can be applied.

Each document is told by the filters that it fails. Four of them are functions of its text and are evaluated as column
expressions; the fifth needs the whole table: a text fails it if some smaller doc_id has the same one. Digests are
grouped for their smallest doc_id with a partial aggregate, and the digests that occur more than once come back by a join
of two freshly exchanged tables, so a text with a third of all rows is split by adaptive execution.

The rest is a packed bitmap index, made within each partition: the rows of an Arrow batch are laid out by part, each part
in 64-bit words of its own, with one bit a row in a bitset for each filter and each label; a part is the range of its words,
so any number of parts costs one pass. For each set S of filters the bitset of the rows that are left after S is an AND-NOT
of two others, and for each filter outside S its counts are popcounts of ANDs, summed over the words of each part. What a
step does depends on the set of filters before it and not on their order, so 5 * 2^4 counts answer all 5! orders. Partitions'
counts are summed by Spark, and orders are joined to them at last.

Defined cases: null text is the empty text (it has no words: it fails A, and as a copy E); null source is the part '';
a null doc_id is compared with none: it never fails E, makes no other row fail it, and has no labels; rows of one doc_id and
text don't fail E by one another; a document without labels counts as labelled 0; labels that repeat a doc_id count as 1
if any of them is 1; an empty table gives an empty result. Very long texts are worked on whole; only their digests are
shuffled. Extra columns of documents are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Separators of words, as a character class.
BLANKS = r"[\x20\x09-\x0D]+"
COUNTS = ["removed", "kept", "redundant", "good_lost", "toxic_lost"]
#: Parts whose counts a task holds before it gives them on.
MOST_PARTS = 2_000


def text_filters(text: Column) -> dict[str, Column]:
    """Filters that a text fails by itself: A, fewer than 50 words; B, under 65 % of them distinct; C, more than 5 % of the
    characters A-Z; D, a mark that prose lacks."""
    words = F.array_remove(F.split(text, BLANKS), "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < 50,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 65,
        "C": capitals.cast("long") * 100 > F.length(text).cast("long") * 5,
        "D": text.rlike("[#$%&*|]"),
    }


def failed(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs (doc_id, text, source), labels (doc_id, quality, toxic) -> doc_id, part, mask (bit i: fails the i-th of ABCDE),
    good, toxic (both boolean)."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text.alias("text"))
    mask = sum((F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(text_filters(F.col("text")).values())), F.lit(0))
    narrow = common.cut(rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.cast("int").alias("mask")), "audit-rows")
    copied = narrow.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("digest", "first")
    told = narrow.join(common.cut(copied, "audit-copied").hint("merge"), "digest", "left")
    later = F.when(F.col("doc_id") > F.col("first"), F.lit(16)).otherwise(F.lit(0))
    told = told.select("doc_id", "part", (F.col("mask") + later).cast("int").alias("mask"))
    said = common.cut(labels.groupBy("doc_id").agg(F.max((F.col("quality") == 1)).alias("good"), F.max((F.col("toxic") == 1)).alias("toxic")), "audit-labels")
    flag = lambda c: F.coalesce(c, F.lit(False)).alias(c)
    return told.join(said.hint("merge"), "doc_id", "left").select("doc_id", "part", "mask", flag("good"), flag("toxic"))


def counted(parts: pa.Array, masks: np.ndarray, labels: Sequence[np.ndarray], filters: int) -> tuple[list, np.ndarray]:
    """The distinct parts of a batch and their counts, an array (part, set of filters before, filter, COUNTS); cells whose
    filter is in the set stay 0."""
    coded = parts.dictionary_encode()
    names, code = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
    sizes = np.bincount(code, minlength=len(names))
    words = -(-sizes // 64)
    starts = np.cumsum(words) - words  # each part has words of its own
    order = np.argsort(code, kind="stable")
    place = np.repeat(starts * 64 - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(order))

    def bitset(flags: np.ndarray) -> np.ndarray:
        bits = np.zeros(int(words.sum()) * 64, np.uint8)
        bits[place] = flags[order]
        return np.packbits(bits, bitorder="little").view(np.uint64)

    def popcount(bits: np.ndarray) -> np.ndarray:
        return np.add.reduceat(np.bitwise_count(bits).astype(np.int64), starts)

    fails = [bitset(masks >> i & 1) for i in range(filters)]
    labelled = [bitset(x) for x in labels]
    left = [bitset(np.ones(len(masks), np.uint8))]
    for s in range(1, 1 << filters):
        low = (s & -s).bit_length() - 1
        left.append(left[s & s - 1] & ~fails[low])
    out = np.zeros((len(names), 1 << filters, filters, len(COUNTS)), np.int64)
    for s in range(1 << filters):
        for f in range(filters):
            if s >> f & 1:
                continue
            gone = left[s] & fails[f]
            for k, bits in enumerate((gone, left[s] & ~fails[f], fails[f] & ~left[s], *(gone & x for x in labelled))):
                out[:, s, f, k] = popcount(bits)
    return names, out


def prefix_counts(rows: DataFrame, filters: int = 5) -> DataFrame:
    """rows (part, mask, good, toxic) -> part, before (set of filters as bits), filter (its place), COUNTS: one row for each
    part, set and filter outside it."""
    cells = [(s, f) for s in range(1 << filters) for f in range(filters) if not s >> f & 1]
    sets, places = (np.array(x, np.int32) for x in zip(*cells, strict=True))
    names = ["part", "before", "filter", *COUNTS]

    def work(batches):
        held: dict[str, np.ndarray] = {}

        def given():
            counts = np.stack([v[sets, places] for v in held.values()]).reshape(-1, len(COUNTS))
            part = pa.array(np.repeat(np.array([*held], object), len(cells)), pa.string())
            columns = [part, pa.array(np.tile(sets, len(held))), pa.array(np.tile(places, len(held))), *(pa.array(counts[:, k]) for k in range(len(COUNTS)))]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        for whole in batches:
            for at in range(0, whole.num_rows, MOST_PARTS):
                batch = whole.slice(at, MOST_PARTS)
                flags = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.uint8) for c in ("good", "toxic")]
                found, counts = counted(batch.column("part"), batch.column("mask").to_numpy(), flags, filters)
                for name, own in zip(found, counts, strict=True):
                    held[name] = held[name] + own if name in held else own
                if len(held) >= MOST_PARTS:
                    yield given()
        if held:
            yield given()

    summed = rows.select("part", "mask", "good", "toxic").mapInArrow(work, "part string, before int, filter int, " + ", ".join(f"{c} long" for c in COUNTS))
    return summed.groupBy("part", "before", "filter").agg(*[F.sum(c).alias(c) for c in COUNTS])


def orders(spark: SparkSession, letters: str) -> DataFrame:
    """filter_order, step, filter, before: a row for each step of each order."""
    rows = [("".join(letters[i] for i in p), k + 1, p[k], sum(1 << i for i in p[:k])) for p in permutations(range(len(letters))) for k in range(len(letters))]
    return spark.createDataFrame(rows, "filter_order string, step int, filter int, before int")


def report(counts: DataFrame, letters: str) -> DataFrame:
    """Counts by set -> a row for each part, order and step, with the filter's own totals: unique_fails (what only it
    removes: its count after all others) and shapley (its removals summed over all orders)."""
    n = len(letters)
    size = F.bit_count("before")
    weight = F.element_at(F.array(*[F.lit(math.factorial(k) * math.factorial(n - 1 - k)) for k in range(n)]), size + 1)
    own = counts.groupBy("part", "filter").agg(F.sum(F.when(size == n - 1, F.col("removed")).otherwise(0)).alias("unique_fails"), F.sum(F.col("removed") * weight).cast("long").alias("shapley"))
    steps = F.broadcast(orders(counts.sparkSession, letters))  # n! * n rows, whatever the tables
    return counts.join(own, ["part", "filter"]).join(steps, ["filter", "before"]).select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return report(common.cut(prefix_counts(failed(docs, labels)), "audit-counts"), "ABCDE")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(common.read(spark, sf_dir, "documents").select("doc_id", "text", "source"), common.read(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"))


ORACLE = r"""
with d as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as text from documents),
w as (select *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from d),
firsts as (select text as t, min(doc_id) as first_id from d group by text),
said as (select doc_id, max(quality) = 1 as good, max(toxic) = 1 as toxic from labels group by doc_id),
told as (
  select part,
    (case when len(ws) < 50 then 1 else 0 end)
    + (case when 100 * len(list_distinct(ws)) < 65 * len(ws) then 2 else 0 end)
    + (case when 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) then 4 else 0 end)
    + (case when regexp_matches(text, '[#$%&*|]') then 8 else 0 end)
    + (case when w.doc_id > first_id then 16 else 0 end) as mask,
    coalesce(good, false) as good, coalesce(toxic, false) as toxic
  from w join firsts on w.text = firsts.t left join said on w.doc_id = said.doc_id
),
cells as (select part, mask, count(*) as n, count(*) filter (where good) as g, count(*) filter (where toxic) as t from told group by part, mask),
letters as (select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(letter, bit)),
perms as (
  select a.letter || b.letter || c.letter || d.letter || e.letter as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
  from letters a, letters b, letters c, letters d, letters e where a.bit | b.bit | c.bit | d.bit | e.bit = 31
),
steps as (select filter_order, s.step, bits[s.step] as bit, list_sum(bits[1:s.step]) - bits[s.step] as before from perms, (select unnest(range(1, 6)) as step) s),
counts as (
  select part, filter_order, step, bit,
    sum(case when mask & (before | bit) = 0 then n else 0 end) as kept,
    sum(case when mask & before = 0 and mask & bit <> 0 then n else 0 end) as removed,
    sum(case when mask & before <> 0 and mask & bit <> 0 then n else 0 end) as redundant,
    sum(case when mask = bit then n else 0 end) as unique_fails,
    sum(case when mask & before = 0 and mask & bit <> 0 then g else 0 end) as good_lost,
    sum(case when mask & before = 0 and mask & bit <> 0 then t else 0 end) as toxic_lost
  from (select cells.*, filter_order, step, bit, cast(before as integer) as before from cells, steps) group by part, filter_order, step, bit
)
select part, filter_order, cast(step as integer) as step, cast(kept as bigint) as kept, cast(removed as bigint) as removed, cast(redundant as bigint) as redundant,
  cast(unique_fails as bigint) as unique_fails, cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
  cast(sum(removed) over (partition by part, bit) as bigint) as shapley
from counts
"""
