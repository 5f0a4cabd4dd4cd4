"""Line dedup by a suffix array over the line ids of all texts.

A text's lines are normalised (lower case, runs of blanks to one, trimmed) and digested to 128 bits; empty lines are left
out. A text is then a sequence of digests. Equal sequences are one from the start, so a group of copies costs a row for
each copy and no more. All distinct sequences, in the order of their first rows (doc_id, nulls last, then a hash of the
row), stand one after the other with a gap between, so that one number p is the place of a line among all lines.

Lines that stand once match nothing; the suffix at p reaches to the next such line or the end of its sequence. Line ids
are the ranks of the digests that repeat. Prefix doubling ranks the suffixes by their first 1, 2, 4, ... lines: a round
sorts the pairs (rank at p, rank at p + s) by a distributed range sort, until every rank is one suffix's or that of equal
whole suffixes. The last ranks are the suffix array; all rounds' ranks are kept. For neighbours in the array the longest
common prefix follows from them: from the longest step to the shortest, where both ranks agree both move on by it.

The suffixes that share their first min_lines lines are an interval of the array whose common prefix is that long. All
its occurrences but the first are later copies and their lines are removed; a longer repeated run is the union of the
windows it holds, so longer intervals remove nothing more. A run is maximal where it reaches as far as any interval of
its start does and no run from the line before reaches as far. A single line of run_words words or more counts as a run.
The first occurrence of every line stays.

Defined cases: null text is the empty text; empty lines never match and stay; a text all of whose lines go becomes the
empty text; equal rows are copies, of which the first keeps what the group keeps; very long texts are cut like others, a
task holds one text and its lines at a time; doc_id is an integer of at most 64 bits; an empty table gives an empty
result; a column of docs with an output's name (text, n_units, n_removed, removed, runs) gives way to the output, and one
with a name of KEY, `_ll_text` or `_ll_copy` is refused.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .substrings import KEY, keyed, place

#: Lines of the shortest run that op8 removes, and words from which one line is a run.
MIN_LINES, RUN_WORDS = 2, 30
OUTPUTS = ("text", "n_units", "n_removed", "removed", "runs")
_TOLD = "n_units long, n int, s1 long, s2 long, h1 array<long>, h2 array<long>, words array<int>"
_LEFT = "text string, removed array<struct<start: long, end: long>>"


def plain(text: str) -> list[str]:
    """The lines normalised."""
    low = text.lower().replace("\t", " ").replace("\r", " ").replace("\f", " ")
    return [" ".join([w for w in line.split(" ") if w]) for line in low.split("\n")]


def tell(texts: pa.Array) -> pa.Array:
    """text -> number of lines, of those that are not empty, the sequence's digest, and digests and words of its lines."""
    n, full, seqs, sizes, digests, words = [], [], [], [0], [], []
    for text in texts:
        lines = plain(text.as_py() or "")
        said = [p for p in lines if p]
        n.append(len(lines))
        full.append(len(said))
        blob = b"".join([xxhash.xxh3_128_digest(p) for p in said])
        seqs.append(xxhash.xxh3_128_digest(blob))
        sizes.append(len(said))
        digests.append(blob)
        words += [p.count(" ") + 1 for p in said]
    both = lambda blobs: np.frombuffer(b"".join(blobs), "<i8").reshape(-1, 2)
    column = lambda a, i: pa.array(np.ascontiguousarray(a[:, i]))
    flat, seq, offsets = both(digests), both(seqs), pa.array(np.cumsum(sizes).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, values) for values in (column(flat, 0), column(flat, 1), pa.array(words, pa.int32()))]
    return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(full, pa.int32()), column(seq, 0), column(seq, 1), *lists], ["n_units", "n", "s1", "s2", "h1", "h2", "words"])


def remover(min_lines: int, run_words: int):
    """Column function (text, places among the lines that are not empty of those that go, whether the text is a later
    copy of its whole sequence) -> struct: the text that is left, start and end of each line removed in characters of the
    original."""

    def one(text: str, places: set[int], copy: bool) -> dict:
        lines, j, at, kept, spans = text.split("\n"), -1, 0, [], []
        said = plain(text)
        full = sum(1 for p in said if p)
        for line, p in zip(lines, said, strict=True):
            j += bool(p)
            if p and (j in places or copy and (full >= min_lines or p.count(" ") + 1 >= run_words)):
                spans.append({"start": at, "end": at + len(line)})
            else:
                kept.append(line)
            at += len(line) + 1
        return {"text": "\n".join(kept), "removed": spans}

    def work(texts: pa.Array, places: pa.Array, copies: pa.Array) -> pa.Array:
        rows = [None if (t := text.as_py()) is None else one(t, set(some.as_py() or []), copy.as_py()) for text, some, copy in zip(texts, places, copies, strict=True)]
        return pa.array(rows, pa.struct([("text", pa.string()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]))

    return F.arrow_udf(common.sliced(work), _LEFT)


def in_order(rows: DataFrame, *cols: str, weight: str | None = None, last: str | None = None, most: int | None = None) -> DataFrame:
    """rows (distinct in cols) with before: the sum of weight (else the number) of the rows that come earlier in the order
    of cols; with last, also that column of the row just before. Rows are dealt by range and sorted within each range;
    only one row for each range comes to the driver. most: the number of rows at most, where it is known."""
    spark = rows.sparkSession
    one = F.col(weight) if weight else F.lit(1)
    dealt = common.cut(rows.withColumn("one", one.cast("long")).repartitionByRange(common.partitions(spark), *cols).withColumn("part", F.spark_partition_id()), "ordered", most)
    ends = F.max_by(F.col(last), F.struct(*cols)) if last else F.lit(None).cast("long")
    sizes = sorted((r[0], r[1], r[2]) for r in dealt.groupBy("part").agg(F.sum("one"), ends).collect())
    starts, at, end = [], 0, None
    for part, size, final in sizes:
        starts.append((part, at, end))
        at, end = at + size, final
    if not starts:
        return dealt.drop("part", "one").withColumn("before", F.lit(0).cast("long")).withColumn("previous", F.lit(None).cast("long"))
    within = Window.partitionBy("part").orderBy(*cols)
    own = F.sum("one").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("one")
    out = dealt.withColumn("own", own).withColumn("previous", F.lag(last or "one").over(within))
    out = out.join(F.broadcast(spark.createDataFrame(starts, "part int, start long, end long")), "part")  # a row for each range
    return out.withColumn("before", F.col("own") + F.col("start")).withColumn("previous", F.coalesce("previous", "end")).drop("part", "one", "own", "start", "end")


def doubled(ranked: DataFrame, most: int) -> list[DataFrame]:
    """The tables of ranks by the first 1, 2, 4, ... lines. ranked: p, rank by the first line, n suffixes of that rank,
    closed (whether the suffix ends before that many lines: False); most: its rows."""
    levels, size = [ranked], 1
    while levels[-1].where("n > 1 and not closed").limit(1).count():
        now = levels[-1].drop("n")
        after = now.select((F.col("p") - size).alias("p"), F.col("rank").alias("r2"), F.col("closed").alias("c2"))
        pairs = now.join(after.hint("merge"), "p", "left").select("p", F.col("rank").alias("r1"), F.when(F.col("closed") | F.col("r2").isNull(), 0).otherwise(F.col("r2")).alias("r2"), (F.col("closed") | F.coalesce("c2", F.lit(True))).alias("closed"))
        pairs = common.cut(pairs, "pairs", most)
        named = in_order(pairs.groupBy("r1", "r2").agg(F.count(F.lit(1)).alias("n")), "r1", "r2", most=most).select("r1", "r2", "n", (F.col("before") + 1).alias("rank"))
        levels.append(common.cut(pairs.join(named.hint("merge"), ["r1", "r2"]).select("p", "rank", "n", "closed"), "run-level", most))
        common.drop(pairs)
        size *= 2
    return levels


def common_prefixes(levels: list[DataFrame], least: int, most: int) -> DataFrame:
    """p, q, lcp for neighbours p and q of the suffix array whose longest common prefix has least lines or more."""
    k = least.bit_length() - 1
    some = levels[k].where("n > 1 and not closed").select("p")
    array = in_order(levels[-1].select("p", "rank").join(some.hint("merge"), "p"), "rank", "p", last="p", most=most)
    pairs = array.where("previous is not null").select("p", F.col("previous").alias("q"), F.lit(0).cast("long").alias("lcp"))
    for step, at in enumerate(reversed(range(len(levels)))):
        open_ = levels[at].where("not closed")
        mine = open_.select((F.col("p")).alias("x"), F.col("rank").alias("rx")).hint("merge")
        other = open_.select((F.col("p")).alias("y"), F.col("rank").alias("ry")).hint("merge")
        pairs = pairs.withColumns({"x": F.col("p") + F.col("lcp"), "y": F.col("q") + F.col("lcp")}).join(mine, "x", "left").join(other, "y", "left")
        pairs = pairs.select("p", "q", (F.col("lcp") + F.when(F.col("rx") == F.col("ry"), 1 << at).otherwise(0)).alias("lcp"))
        if step % 4 == 3:
            pairs = common.cut(pairs, "prefixes", most)
    return common.cut(pairs.where(F.col("lcp") >= least), "prefixes", most)


def maximal_runs(prefixes: DataFrame, most: int) -> DataFrame:
    """p, lines: the maximal repeated runs."""
    longest = prefixes.select("p", "lcp").union(prefixes.select("q", "lcp")).groupBy("p").agg(F.max("lcp").alias("lines"))
    longest = common.cut(longest, "longest", most)
    before = longest.select((F.col("p") + 1).alias("p"), (F.col("lines") - 1).alias("held"))
    return longest.join(before.hint("merge"), "p", "left").where("held is null or held < lines").select("p", "lines")


def later_lines(levels: list[DataFrame], min_lines: int, long_lines: DataFrame, most: int) -> DataFrame:
    """p of the lines of later copies of runs of min_lines, and of the lines of long_lines (p) that are later copies."""
    k = min_lines.bit_length() - 1
    rest = min_lines - (1 << k)  # two windows of a power of two that overlap
    open_ = levels[k].where("n > 1 and not closed").select("p", "rank")
    named = open_.join(open_.select((F.col("p") - rest).alias("p"), F.col("rank").alias("r2")).hint("merge"), "p") if rest else open_.withColumn("r2", F.lit(0))
    firsts = common.cut(named.groupBy("rank", "r2").agg(F.min("p").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"), "intervals", most)
    starts = named.join(firsts.hint("merge"), ["rank", "r2"]).where("p > first").select("p")
    runs = starts.select(F.explode(F.sequence("p", F.col("p") + (min_lines - 1))).alias("p"))
    alone = levels[0].select("p", "rank")
    first = common.cut(alone.groupBy("rank").agg(F.min("p").alias("first")), "firsts", most)
    single = alone.join(long_lines.hint("merge"), "p").join(first.hint("merge"), "rank").where("p > first").select("p")
    return runs.union(single).distinct()


def dedup_runs(docs: DataFrame, min_lines: int = MIN_LINES, run_words: int = RUN_WORDS) -> DataFrame:
    """docs without later copies of repeated runs of lines: columns of docs with text cleaned, and n_units, n_removed,
    removed (start and end of each removed line in characters of the original), runs (the text's maximal repeated runs:
    first, the run's first line among those that are not empty, from 0, and its lines)."""
    rows = keyed(docs)
    told = common.cut(rows.select(*KEY, place().alias("place"), F.arrow_udf(common.sliced(tell), _TOLD)("_ll_text").alias("s")).select(*KEY, "place", "s.*"), "lines")
    seqs = told.groupBy("s1", "s2").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"), F.first("n").alias("n"), F.first("h1").alias("h1"), F.first("h2").alias("h2"), F.first("words").alias("words"))
    seqs = common.cut(in_order(seqs.withColumn("room", F.col("n") + 1), "first", weight="room").select("s1", "s2", "first", (F.col("rows") > 1).alias("copied"), "n", "h1", "h2", "words", F.col("before").alias("offset")), "sequences")
    each = seqs.select("offset", "h2", "words", F.posexplode("h1").alias("j", "a")).select((F.col("offset") + F.col("j")).alias("p"), "a", F.get("h2", F.col("j")).alias("b"), F.get("words", F.col("j")).alias("w"))
    again = each.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    ids = common.cut(in_order(again, "a", "b").select("a", "b", "n", (F.col("before") + 1).alias("rank")), "line-ids")
    at = common.cut(each.join(ids.hint("merge"), ["a", "b"]).select("p", "rank", "n", "w"), "line-ranks")
    most = at.count()
    levels = doubled(at.select("p", "rank", "n", F.lit(False).alias("closed")), most)
    while len(levels) < min_lines.bit_length():  # nothing repeats that far
        levels.append(levels[-1].where("false"))
    gone = later_lines(levels, min_lines, at.where(F.col("w") >= run_words).select("p"), most).select("p", F.lit(None).cast("long").alias("lines"))
    runs = maximal_runs(common_prefixes(levels, min_lines, most), most).select("p", "lines")
    # back to sequences, through the places of all their lines
    owner = seqs.where("n > 0").select("s1", "s2", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("j"), "offset").select("s1", "s2", "j", (F.col("offset") + F.col("j")).alias("p"))
    told_of = gone.withColumn("goes", F.lit(True)).unionByName(runs.withColumn("goes", F.lit(False)))
    held = owner.join(told_of.hint("merge"), "p").groupBy("s1", "s2").agg(F.collect_list(F.when(F.col("goes"), F.col("j"))).alias("gone"), F.array_sort(F.collect_list(F.when(~F.col("goes"), F.struct(F.col("j").alias("first"), F.col("lines").cast("int").alias("lines"))))).alias("runs"))
    whole = F.array(F.struct(F.lit(0).alias("first"), F.col("n").alias("lines")))
    none = F.array().cast("array<struct<first: int, lines: int>>")
    known = seqs.select("s1", "s2", "first", "copied", "n").join(held.hint("merge"), ["s1", "s2"], "left")
    known = common.cut(known.select("s1", "s2", "first", "gone", F.when(F.col("copied"), F.when(F.col("n") >= min_lines, whole).otherwise(none)).otherwise(F.coalesce("runs", none)).alias("runs")), "known")
    info = told.select(*KEY, "place", "n_units", "s1", "s2").join(known.hint("merge"), ["s1", "s2"])
    later = F.col("place") > F.col("first")
    info = info.groupBy(*KEY).agg(F.first("n_units").alias("_ll_n"), F.max(later).alias("_ll_later"), F.first(F.when(~later, F.col("gone"))).alias("_ll_at"), F.first("runs").alias("_ll_runs"))
    found = rows.withColumn("_ll_copy", F.row_number().over(Window.partitionBy(*KEY).orderBy(F.lit(1)))).join(info, KEY)
    copy = F.col("_ll_later") | (F.col("_ll_copy") > 1)
    touched = copy | F.coalesce(F.size("_ll_at") > 0, F.lit(False))
    found = found.withColumn("_ll_left", remover(min_lines, run_words)(F.when(touched, F.col("_ll_text")), "_ll_at", copy))
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in OUTPUTS]
    spans = F.coalesce("_ll_left.removed", F.array().cast("array<struct<start: bigint, end: bigint>>"))
    return found.select(*kept, F.coalesce("_ll_left.text", "_ll_text").alias("text"), F.col("_ll_n").alias("n_units"), F.size(spans).cast("long").alias("n_removed"), spans.alias("removed"), F.col("_ll_runs").alias("runs"))


def cleaned(docs: DataFrame, found: DataFrame) -> DataFrame:
    """found with the columns of docs, and n_chars, where docs has it, counted anew."""
    out = [F.length("text").cast(docs.schema[c].dataType).alias(c) if c.lower() == "n_chars" else F.col(f"`{c}`") for c in docs.columns]
    return found.select(*out)


def op8_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_runs(common.read(spark, sf_dir, "documents").select("doc_id", "text"))
    longest = F.coalesce(F.array_max(F.transform("runs", lambda r: r["lines"])), F.lit(0)).cast("long")
    return common.spans_as_text(found).withColumns({"n_runs": F.size("runs").cast("long"), "longest_run": longest}).drop("runs")


#: DuckDB twin. Lines that go follow from windows of two lines; the longest repeated runs from windows made longer by one
#: line in each round.
ORACLE = rf"""
with recursive d as (select *, row_number() over (order by doc_id, text) r from (select doc_id, coalesce(text, '') text from documents)),
s as (select doc_id, r, string_split(text, chr(10)) us from d),
u as (select doc_id, r, unnest(us) u, unnest(range(len(us))) i from s),
p as (select *, trim(regexp_replace(lower(u), '[ \t\r\f]+', ' ', 'g'), ' ') p from u),
w as (select *, case when p = '' then 0 else len(p) - len(replace(p, ' ', '')) + 1 end words,
  sum(len(u) + 1) over (partition by r order by i) - len(u) - 1 a from p),
l as (select *, row_number() over (partition by r order by i) j from w where p <> ''),
b as (select *, lead(p) over (partition by r order by j) p2 from l),
f as (select *, p2 is not null and row_number() over (partition by p, p2 order by doc_id, i) > 1 later,
  words >= {RUN_WORDS} and row_number() over (partition by p order by doc_id, i) > 1 alone from b),
h as (select r, i, alone or later or coalesce(lag(later) over (partition by r order by j), false) gone from f),
g as (select w.*, coalesce(gone, false) gone from w left join h using (r, i)),
k as (select r, coalesce(string_agg(u, chr(10) order by i) filter (not gone), '') text, count(*)::bigint n_units, (count(*) filter (gone))::bigint n_removed,
  coalesce(string_agg(a::bigint || '-' || (a + len(u))::bigint, ',' order by i) filter (gone), '') removed from g group by r),
x(r, j, len, name) as (select r, j, 1, dense_rank() over (order by p) from (select r, j, p, count(*) over (partition by p) c from l) where c > 1
  union all
  select r, j, len + 1, dense_rank() over (order by name, p2) from (select x.r, x.j, x.len, x.name, l.p p2, count(*) over (partition by x.name, l.p) c
    from x join l on l.r = x.r and l.j = x.j + x.len) where c > 1),
e as (select r, j, max(len) len from x group by r, j having max(len) >= {MIN_LINES}),
m as (select r, len, lag(j + len) over (partition by r order by j) before, lag(j) over (partition by r order by j) jb, j from e),
n as (select r, count(*)::bigint n_runs, max(len)::bigint longest_run from m where jb is null or jb < j - 1 or before < j + len group by r)
select doc_id, k.text, n_units, n_removed, removed, coalesce(n_runs, 0)::bigint n_runs, coalesce(longest_run, 0)::bigint longest_run from k join d using (r) left join n using (r)
"""
