"""Document fingerprints by SimHash, in DataFrame functions only.

A text's terms are its runs of five words (a shorter text is one term, an empty one the empty term). Every occurrence
of a term is hashed to 128 bits and votes on each bit, so a term weighs as often as it stands; a bit of the fingerprint
is set if more than half of the votes set it. Votes are counted two to a 64-bit sum: bits j and j + 32 of a hash are
added as `(hash >> j) & 0x100000001`, which cannot overflow, since a string has fewer than 2^31 characters.

near() finds all fingerprints within a Hamming radius by block tables, one for each block of the 128 bits. The blocks
are given flips t_1, t_2, ... whose t + 1 add up to radius + 1: if every block differed in more than its flips, the whole
would differ in more than radius bits, so some block differs in its flips at most. A query looks up each of its blocks
with every choice of that many bits turned, which finds every pair within the radius; the distance is then counted
exactly.

Neighbours in doc_id order are found without a sort of the texts: ids and sizes alone are sorted, which gives an id for
every BUCKET_BYTES of text, however large the table. These cut the rows into buckets of close ids, the first row of each
bucket is also sent, marked, to the end of the bucket before it, and each bucket is ordered by itself. One shuffle of the
texts serves the order, the lead and the votes.

Defined cases: null text is the empty text; rows of equal doc_id are ordered by text; null doc_ids come last; repeated
rows each give a row; one single row is its own next; a very long text is a bucket of its own; columns other than doc_id
and text are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .units import in_order

SHINGLE = 5
LANES = 0x100000001
#: Hamming radius of near() in the query, and the number of blocks: eight tables, each keyed by one block of 16 bits.
#: Texts of similarity 0.8 (a cosine of 0.89) are expected 19 bits apart, with a deviation of 4.
RADIUS, BLOCKS = 27, 8
#: Bytes of text of the documents that one task orders, about, and how many cuts are worth more of them.
BUCKET_BYTES, MOST_CUTS = 8 << 20, 1_000_000


def id_cuts(docs: DataFrame, bucket_bytes: int) -> list[int]:
    """Ids that cut the rows, in descending order of id, into buckets of about bucket_bytes of text; the first is the
    largest. Only ids and sizes are sorted; one id for each bucket comes to the driver."""
    sizes = docs.where("doc_id is not null").groupBy("doc_id").agg((F.sum(F.octet_length("text")) + 16).alias("size"))
    sizes = common.cut(sizes.select(F.bitwise_not("doc_id").alias("below"), "size"), "sizes")
    total = sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    bucket = F.floor(F.col("before") / max(bucket_bytes, -(-total // MOST_CUTS)))
    return sorted((~r.below for r in in_order(sizes, "below", weight="size").groupBy(bucket.alias("b")).agg(F.min("below").alias("below")).collect()), reverse=True)


def with_next(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, text) -> bucket, rn, last, doc_id, text, next_text: each text beside that of the next document in
    descending order of doc_id, the first after the last. Rows with `last` true repeat the head of the next bucket."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    cuts = id_cuts(rows, bucket_bytes)
    if cuts:
        heads = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<bigint>")  # folded to a constant

        def halved(s: Column, _: Column) -> Column:
            middle = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
            up = (s["lo"] < s["hi"]) & (F.get(heads, middle) >= F.col("doc_id"))
            return F.struct(F.when(up, middle + 1).otherwise(s["lo"]).alias("lo"), F.when(up | (s["lo"] >= s["hi"]), s["hi"]).otherwise(middle).alias("hi"))

        # how many heads are as large as the id or larger, by bisection
        above = F.aggregate(F.sequence(F.lit(0), F.lit(len(cuts).bit_length())), F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi")), halved, lambda s: s["lo"])
        rows = rows.withColumn("above", F.when(F.col("doc_id").isNull(), F.lit(len(cuts))).otherwise(above))
        own = F.struct((F.col("above") - 1).alias("bucket"), F.lit(False).alias("last"))
        before = F.when(F.col("above") == 1, F.lit(len(cuts) - 1)).otherwise(F.col("above") - 2)
        is_head = F.get(heads, F.col("above") - 1) == F.col("doc_id")
        to = F.when(is_head, F.array(own, F.struct(before.alias("bucket"), F.lit(True).alias("last")))).otherwise(F.array(own))
    else:
        to = F.array(F.struct(F.lit(0).alias("bucket"), F.lit(False).alias("last")))
    dealt = rows.select("doc_id", "text", F.inline(to))
    order = Window.partitionBy("bucket").orderBy("last", F.col("doc_id").desc_nulls_last(), "text")
    following = F.lead("text").over(order)
    if not cuts:
        following = F.coalesce(following, F.first("text").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return dealt.select("bucket", F.row_number().over(order).alias("rn"), "last", "doc_id", "text", following.alias("next_text"))


def terms(rows: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """keep, h1, h2: one row for each occurrence of a term. The words are worked out once, below the generator, and the
    run at each place is hashed in generated code; no array of runs is built."""
    words = rows.select(*keep, common.words_of(F.col(text)).alias("w"))
    at = words.select(*keep, "w", F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - SHINGLE, F.lit(0)))).alias("p"))
    run = [F.try_element_at("w", F.col("p") + i + 1) for i in range(SHINGLE)]
    return at.select(*keep, F.xxhash64(*run).alias("h1"), F.xxhash64(*run, F.lit(1)).alias("h2"))


def votes(hashed: DataFrame, keys: list[str]) -> DataFrame:
    """keys, f1, f2: the two halves of the fingerprint."""
    sums = [F.sum(F.shiftrightunsigned(h, j).bitwiseAND(F.lit(LANES).cast("long"))).alias(f"{h}_{j}") for h in ("h1", "h2") for j in range(32)]
    counted = hashed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *sums)

    def half(h: str) -> Column:
        out = F.lit(0).cast("long")
        for j in range(32):
            low, high = F.col(f"{h}_{j}").bitwiseAND(F.lit(0xFFFFFFFF).cast("long")), F.shiftrightunsigned(f"{h}_{j}", 32)
            out = out.bitwiseOR(F.when(low * 2 > F.col("n"), F.lit(1 << j).cast("long")).otherwise(F.lit(0).cast("long")))
            top = (1 << (32 + j)) - (1 << 64 if j == 31 else 0)
            out = out.bitwiseOR(F.when(high * 2 > F.col("n"), F.lit(top).cast("long")).otherwise(F.lit(0).cast("long")))
        return out

    return counted.select(*keys, half("h1").alias("f1"), half("h2").alias("f2"))


def as_text(f1: Column, f2: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(f1), 16, "0"), F.lpad(F.hex(f2), 16, "0")))


def likeness(a1: Column, a2: Column, b1: Column, b2: Column) -> Column:
    """1 less the share of the 128 bits that differ."""
    return F.lit(1.0) - (F.bit_count(a1.bitwiseXOR(b1)) + F.bit_count(a2.bitwiseXOR(b2))) / F.lit(128.0)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of every text of docs (doc_id, text): doc_id, f1, f2, fingerprint; repeated rows each give a row."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keyed = rows.select("doc_id", F.md5("text").alias("m"), "text").groupBy("doc_id", "m").agg(F.count(F.lit(1)).alias("copies"), F.first("text").alias("text"))
    found = votes(terms(keyed, "text", ["doc_id", "m", "copies"]), ["doc_id", "m", "copies"])
    return found.select("doc_id", "f1", "f2", as_text(F.col("f1"), F.col("f2")).alias("fingerprint"), F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_c")).drop("_c")


def flips_of(radius: int, blocks: int) -> list[int]:
    """Bits that may differ in each block's table; -1: the block needs no table."""
    each, more = divmod(radius + 1 - blocks, blocks)
    return [each + (i < more) for i in range(blocks)]


def block_of(f1: Column, f2: Column, i: int, blocks: int) -> Column:
    bits = 128 // blocks
    if bits >= 64:
        return F.xxhash64(f1, f2) if bits == 128 else (f1, f2)[i]  # a clash of hashes costs only time
    half, at = (f1, i * bits) if i * bits < 64 else (f2, i * bits - 64)
    return F.shiftrightunsigned(half, at).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))


def turned(bits: int, flips: int) -> list[int]:
    """Every choice of at most `flips` of the bits, as signed 64-bit masks."""
    masks = [sum(1 << j for j in chosen) for k in range(flips + 1) for chosen in combinations(range(bits), k)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def near(queries: DataFrame, index: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """All pairs of distinct fingerprints (q1, q2) of queries and (f1, f2) of index within the radius: q1, q2, f1, f2,
    distance. Both sides hold each fingerprint once, so a group of equal texts is one row here, whatever its size."""
    if radius < 0 or blocks < 1 or 128 % blocks or (blocks == 1 and radius):
        raise ValueError("blocks must divide 128, and be more than one for a radius above 0")
    flips = flips_of(radius, blocks)
    used = [i for i in range(blocks) if flips[i] >= 0]
    keys = lambda a, b: F.explode(F.array(*[F.struct(F.lit(i).alias("table"), F.lit(flips[i]).alias("flips"), block_of(F.col(a), F.col(b), i, blocks).alias("k")) for i in used])).alias("_k")
    masks = F.lit(None)
    for t in sorted({flips[i] for i in used}):
        masks = F.when(F.col("_k.flips") == t, F.array(*[F.lit(m).cast("long") for m in turned(128 // blocks, t)])).otherwise(masks)
    asked = queries.select("q1", "q2", keys("q1", "q2")).select("q1", "q2", "_k", F.explode(masks).alias("m")).select("q1", "q2", "_k.table", F.col("_k.k").bitwiseXOR(F.col("m")).alias("k"))
    held = index.select("f1", "f2", keys("f1", "f2")).select("f1", "f2", "_k.table", "_k.k")
    distance = F.bit_count(F.col("q1").bitwiseXOR(F.col("f1"))) + F.bit_count(F.col("q2").bitwiseXOR(F.col("f2")))
    # thousands of rows for each query: never a table to broadcast, however small it is packed
    pairs = asked.hint("merge").join(held, ["table", "k"]).where(distance <= radius)
    return pairs.select("q1", "q2", "f1", "f2", distance.alias("distance")).distinct()


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Columns of op1 without the search."""
    n, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    rows = with_next(docs).withColumn("edited", F.concat(F.substring("text", F.lit(1), n - half), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half)))
    keys = ["bucket", "rn", "last", "doc_id", "n_chars", "edited_sha256"]
    both = rows.select("bucket", "rn", "last", "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), F.inline(F.array(F.struct(F.lit(False).alias("is_edited"), F.col("text").alias("t")), F.struct(F.lit(True).alias("is_edited"), F.coalesce("edited", F.lit("")).alias("t")))))
    found = votes(terms(both, "t", [*keys, "is_edited"]), [*keys, "is_edited"])
    one = Window.partitionBy("bucket").orderBy("rn", "is_edited")
    c = F.col
    beside = found.withColumns({f"{x}{i}": F.lead(x, i).over(one) for x in ("f1", "f2") for i in (1, 2)}).where(~c("is_edited"))
    first = {x: F.first(x).over(one.rowsBetween(Window.unboundedPreceding, Window.currentRow)) for x in ("f1", "f2")}
    beside = beside.withColumns({f"{x}2": F.coalesce(c(f"{x}2"), first[x]) for x in ("f1", "f2")}).where(~c("last"))
    return beside.select(
        "doc_id", "n_chars", "edited_sha256", as_text(c("f1"), c("f2")).alias("fingerprint"), as_text(c("f11"), c("f21")).alias("edited_fingerprint"),
        likeness(c("f1"), c("f2"), c("f11"), c("f21")).alias("near_edited"), likeness(c("f1"), c("f2"), c("f12"), c("f22")).alias("near_next"), "f1", "f2",
    )


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns, and n_near: for the queries (doc_id divisible by 100) the number of other documents
    whose fingerprint is within the radius, else null."""
    rows = common.cut(edited_fingerprints(common.read(spark, sf_dir, "documents").select("doc_id", "text")), "simhash")
    index = rows.groupBy("f1", "f2").agg(F.count(F.lit(1)).alias("copies"))
    queries = rows.where(F.col("doc_id") % 100 == 0).select(F.col("f1").alias("q1"), F.col("f2").alias("q2")).distinct()
    found = near(queries, index.select("f1", "f2")).join(index, ["f1", "f2"]).groupBy("q1", "q2").agg((F.sum("copies") - 1).alias("n_near"))
    counted = rows.where(F.col("doc_id") % 100 == 0).join(found, (F.col("f1") == F.col("q1")) & (F.col("f2") == F.col("q2"))).drop("q1", "q2")
    rest = rows.where((F.col("doc_id") % 100 != 0) | F.col("doc_id").isNull()).withColumn("n_near", F.lit(None).cast("long"))
    return counted.unionByName(rest).drop("f1", "f2")
