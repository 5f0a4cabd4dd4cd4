"""Near-duplicate classes by BagMinHash.

A text is the multiset of its runs of five words (a text of fewer words is one run; no words: the empty multiset). A
signature has REGISTERS registers. Each element throws points at random times of a Poisson process into random
registers, and a register keeps its earliest point, so two signatures agree in a register with the probability of the
multisets' Jaccard similarity, the sum of the smaller over the sum of the larger multiplicities.

Weights are discretised at the whole numbers and put together hierarchically: the levels (0, w] of an element are cut
into the blocks (0,1], (1,2], (2,4], (4,8], ..., each with a process of its own at the rate of its length. A block that
lies below the weight keeps all its points, the block that holds the weight thins them (a point's level is drawn with
it), and blocks above it are never opened. Points come in order of time, so an element is dropped as soon as its next
point is later than the latest register.

Signatures are cut into bands; texts that agree in a band are candidates. Equal multisets are one node from the start,
so exact copies cost a row each and no pair. Members of a band's bucket are first compared with a few centres (the
smallest node, then others drawn by a hash), which joins most of a large group of copies at one comparison each. What
that leaves is compared exactly, without a row for any pair: the members of a bucket that still holds several classes
are dealt into blocks of bounded size, those of its largest class apart from the rest; a task gets two blocks of bags,
multiplies them as 0/1 matrices and gives back a spanning forest of the links that join different classes. Two blocks of
the largest class are never laid against each other. So any two texts that share a bucket are compared, or are linked
through others already.

Every link is verified by the true overlap of the multisets, and classes are the connected components of verified links.
All groupings aggregate before they shuffle. Joins whose small side grows with the corpus are sort-merge joins at every
size, between freshly exchanged tables, so that adaptive execution can split hot keys.

Defined cases: null text is the empty text; texts without words are one class; rows of equal text are in one class;
a class's id is its smallest doc_id (null if it has none); very long texts are compared in blocks of their own; an empty
table gives an empty result. dedup() keeps all columns of docs; a column with a name of KEY or `_ll_r` is refused.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .decontaminate import words

SHINGLE, LEAST = 5, 0.8
#: 24 bands of 5 registers: two texts of similarity 0.8 miss all bands with probability (1 - 0.8^5)^24 < 1e-4.
BANDS, BAND = 24, 5
REGISTERS = BANDS * BAND
#: Rounds of centres before the exact comparison.
ROUNDS = 2
#: Members and elements of a block, about (a single text may be larger), and columns of a matrix at a time.
BLOCK_MEMBERS, BLOCK_ELEMENTS, BLOCK_COLUMNS = 256, 400_000, 4_096
#: Words whose hashes a worker keeps, in each of two generations.
KEPT_WORDS = 150_000

_U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads their bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def bag(text: bytes | None, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct runs as 64-bit hashes in order, and their multiplicities."""
    known = common.per_worker(lambda: common.Kept(xxhash.xxh64_intdigest, KEPT_WORDS), "words", "minhash")
    ws = words(text)
    n = len(ws)
    if not n:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    h = np.array([*map(known.__getitem__, ws)], _U)
    m = max(n - size + 1, 1)
    s = np.full(m, min(n, size), _U)
    with np.errstate(over="ignore"):
        for i in range(min(n, size)):
            s = s * _U(0x9E3779B97F4A7C15) + h[i : i + m]
    return np.unique(mixed(s), return_counts=True)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Jaccard similarity of two multisets; two empty ones are equal."""
    total = int(a[1].sum() + b[1].sum())
    if not total:
        return 1.0
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    return both / (total - both)


def signature(elements: np.ndarray, weights: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """The earliest time of each register (infinite for the empty multiset)."""
    out = np.full(registers, np.inf)
    if not len(elements):
        return out
    # blocks: (0,1] for all, then (2^(k-1), 2^k] for the elements whose weight is above 2^(k-1)
    seeds, lengths, below = [mixed(elements ^ _U(0xA076_1D64_78BD_642F))], [np.ones(len(elements))], [np.ones(len(elements))]
    k = 1
    while (above := weights > (low := 1 << (k - 1))).any():
        with np.errstate(over="ignore"):
            seeds.append(mixed(elements[above] ^ (_U(0xE703_7ED1_A0B4_28DB) * _U(k))))
        lengths.append(np.full(above.sum(), float(low)))
        below.append(np.minimum((weights[above] - low) / low, 1.0))
        k += 1
    seed, rate, kept, now = np.concatenate(seeds), np.concatenate(lengths), np.concatenate(below), np.zeros(sum(map(len, seeds)))
    done, latest = 0, np.inf
    while len(seed):
        # after about REGISTERS * ln(REGISTERS) points all registers hold one
        step = max(1, min(64, -(-registers * 6 // len(seed)))) if np.isinf(latest) else 1
        with np.errstate(over="ignore"):
            x = mixed(seed[:, None] + _U(0x9E3779B97F4A7C15) * np.arange(done + 1, done + 1 + step, dtype=_U)[None, :])
            y = mixed(x ^ _U(0x8EBC_6AF0_9C88_C6E3))
        gaps = -np.log(((x >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate[:, None]
        times = now[:, None] + np.cumsum(gaps, axis=1)
        use = (times < latest) & (((y & _U(0xFFFFFFFF)).astype(np.float64) * 2.0**-32) < kept[:, None])
        place = (((y >> _U(32)) * _U(registers)) >> _U(32)).astype(np.int64)
        np.minimum.at(out, place[use], times[use])
        latest = out.max()
        now = times[:, -1]
        go = now < latest
        seed, rate, kept, now = seed[go], rate[go], kept[go], now[go]
        done += step
    return out


def bands_of(registers: np.ndarray, bands: int = BANDS) -> list[int]:
    """A signed 64-bit hash of each band."""
    raw = registers.reshape(bands, -1)
    return [xxhash.xxh64_intdigest(r.tobytes(), i) - (1 << 63) for i, r in enumerate(raw)]


def expanded(elements: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The multiset as a sorted set: the k-th occurrence of an element is an element of its own."""
    if not len(elements) or weights.max() == 1:
        return elements
    nth = np.arange(weights.sum()) - np.repeat(np.cumsum(weights) - weights, weights)
    with np.errstate(over="ignore"):
        return np.sort(np.where(nth > 0, mixed(np.repeat(elements, weights) + nth.astype(_U) * _U(0x9FB2_1C65_1E98_DF25)), np.repeat(elements, weights)))


def signed(texts: pa.Array) -> pa.Array:
    """text -> struct(node, n, bands). The node is 63 bits of a hash of the multiset: equal multisets have equal nodes."""
    out = []
    for text in texts.cast(pa.binary()):
        e, w = bag(text.as_py())
        node = xxhash.xxh3_64_intdigest(e.tobytes() + w.tobytes()) >> 1
        out.append({"node": node, "n": int(w.sum()), "bands": bands_of(signature(e, w)) if len(e) else []})
    return pa.array(out, pa.struct([("node", pa.int64()), ("n", pa.int64()), ("bands", pa.list_(pa.int64()))]))


def bagged(texts: pa.Array) -> pa.Array:
    return pa.array([expanded(*bag(text.as_py())).tobytes() for text in texts.cast(pa.binary())], pa.binary())


def alike(a: pa.Array, b: pa.Array) -> pa.Array:
    out = []
    for x, y in zip(a, b, strict=True):
        x, y = np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U)
        both = len(np.intersect1d(x, y, assume_unique=True))
        out.append(both / (len(x) + len(y) - both) if len(x) + len(y) else 1.0)
    return pa.array(out, pa.float64())


def forest(nodes: np.ndarray, classes: np.ndarray, second: np.ndarray, cross: bool, bags: list[np.ndarray], least: float) -> list[tuple[int, int]]:
    """Links (a, b) of overlap least or more that join the members' classes as far as their overlaps do, at most one less
    than there are members. cross: only members that differ in second are compared."""
    if not len(nodes) or (classes == classes[0]).all():
        return []
    sizes = np.array([len(b) for b in bags])
    values, column = np.unique(np.concatenate(bags), return_inverse=True)
    owner = np.repeat(np.arange(len(bags)), sizes)
    shared = np.bincount(column, minlength=len(values)) > 1
    place = np.cumsum(shared) - 1
    keep = shared[column]
    column, owner = place[column[keep]], owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    both = np.zeros((len(bags), len(bags)), np.float32)
    for at in range(0, int(shared.sum()), BLOCK_COLUMNS):
        a, b = np.searchsorted(column, [at, at + BLOCK_COLUMNS])
        m = np.zeros((len(bags), BLOCK_COLUMNS), np.float32)
        m[owner[a:b], column[a:b] - at] = 1
        both += m @ m.T
    linked = both >= least * (sizes[:, None] + sizes[None, :] - both.astype(np.float64)) - 1e-9
    if cross:
        linked &= second[:, None] != second[None, :]
    known = classes[:, None] == classes[None, :]
    out, todo, seen = [], [], np.zeros(len(bags), bool)
    for start in range(len(bags)):
        if seen[start]:
            continue
        seen[start] = True
        todo = [start]
        while todo:
            i = todo.pop()
            for how in (known, linked):
                new = np.flatnonzero(how[i] & ~seen)
                seen[new] = True
                todo += new.tolist()
                if how is linked:
                    out += [(int(nodes[i]), int(nodes[j])) for j in new]
    return out


def linker(least: float):
    """mapInArrow function: rows sorted by pair of blocks (band, key, kind, i, j), with node, class, second, bag -> links."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def work(batches):
        at, held = None, []

        def links():
            cols = [np.array(x) for x in zip(*((r[5], r[6], r[7]) for r in held), strict=True)]
            found = forest(cols[0], cols[1], cols[2], at[2] == 1 or at[3] != at[4], [np.frombuffer(r[8], _U) for r in held], least)
            return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], schema=schema)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:5] != at:
                    if held:
                        yield links()
                    at, held = row[:5], []
                held.append(row)
        if held:
            yield links()

    return work


def components(links: DataFrame) -> DataFrame:
    """links (a, b) -> node, class (the smallest node that it is linked to, through any number of links): each node takes
    the smallest label among its neighbours and then its label's label, until nothing changes."""
    both = common.cut(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "links")
    most = both.count()
    labels = common.cut(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("class")), "labels", most)
    while True:
        seen = both.join(labels.select(F.col("node").alias("b"), F.col("class").alias("c")), "b").groupBy(F.col("a").alias("node")).agg(F.min("c").alias("c"))
        near = labels.join(seen, "node", "left").select("node", "class", F.least("class", F.coalesce("c", "class")).alias("new"))
        near = common.cut(near, "near", most)  # so that both sides of the next join, whose keys are hot, are exchanged afresh
        jump = near.select(F.col("node").alias("new"), F.col("new").alias("far"))
        after = near.join(jump, "new", "left").select("node", "class", F.least(F.col("new"), F.coalesce("far", "new")).alias("new"))
        after = common.cut(after, "labels", most)
        changed = after.where("class <> new").limit(1).count()
        common.drop(labels, near)
        labels = common.same_table(after, after.select("node", F.col("new").alias("class")))
        if not changed:
            common.drop(both)
            return labels


KEY = ["_ll_k1", "_ll_k2"]


def keyed(docs: DataFrame) -> DataFrame:
    """docs with 128 bits that tell a row by its doc_id and text."""
    common.refuse(docs, *KEY, "_ll_r")
    text = F.coalesce("text", F.lit(""))
    return docs.withColumns({"_ll_k1": F.xxhash64("doc_id", text), "_ll_k2": F.xxhash64(F.lit(7), text, "doc_id")})


def blocked(held: DataFrame) -> DataFrame:
    """held (band, key, node, n, class) -> band, key, kind, i, j, node, class, second: the members of buckets that hold
    several classes, once for each pair of blocks that must be compared. Kind 0: two blocks (or one, i = j) of members
    outside the bucket's largest class; kind 1: such a block and one of the largest class."""
    sizes = held.groupBy("band", "key", "class").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("e"))
    split = sizes.groupBy("band", "key").agg(F.count(F.lit(1)).alias("classes"), F.sum("m").alias("m"), F.sum("e").alias("e"), F.max(F.struct("m", "class", "e")).alias("big"))
    split = split.where("classes > 1 and m > 2")  # of two members one was the centre
    blocks = lambda m, e: F.greatest(F.ceil(m / BLOCK_MEMBERS), F.ceil(e / BLOCK_ELEMENTS), F.lit(1)).cast("int")
    one = blocks(F.col("m"), F.col("e")) == 1
    split = split.select("band", "key", F.when(~one, F.col("big.class")).alias("largest"), F.when(one, 1).otherwise(blocks(F.col("m") - F.col("big.m"), F.col("e") - F.col("big.e"))).alias("rest"), F.when(one, 0).otherwise(blocks(F.col("big.m"), F.col("big.e"))).alias("own"))
    dealt = held.join(common.cut(split, "split").hint("merge"), ["band", "key"]).withColumn("large", F.coalesce(F.col("class") == F.col("largest"), F.lit(False)))
    spot = F.pmod(F.xxhash64("node", F.lit(3)), F.when(F.col("large"), F.col("own")).otherwise(F.col("rest"))).cast("int")
    dealt = dealt.withColumn("spot", spot)
    upto = lambda n: F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))
    pair = lambda kind, i, j, second: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), second.alias("second"))
    among = F.transform(upto("rest"), lambda j: pair(0, F.least("spot", j), F.greatest("spot", j), (F.col("spot") > j).cast("int")))
    against = F.transform(upto("own"), lambda j: pair(1, F.col("spot"), j, F.lit(0)))
    large = F.transform(upto("rest"), lambda j: pair(1, j, F.col("spot"), F.lit(1)))
    each = F.explode(F.when(F.col("large"), large).otherwise(F.concat(among, against)))
    return dealt.select("band", "key", "node", "class", each.alias("p")).select("band", "key", "p.kind", "p.i", "p.j", "node", "class", "p.second")


def classes(docs: DataFrame, least: float = LEAST, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, class, node, keys: one row for each row of docs (doc_id, text), with its class, a node of it."""
    spark = docs.sparkSession
    rows = keyed(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    # signatures once for each row, kept without the text
    known = rows.withColumn("s", F.arrow_udf(signed, "node long, n long, bands array<long>")("text")).select("doc_id", *KEY, "s.node", "s.n", "s.bands")
    known = common.cut(known, "signatures")
    nodes = common.cut(known.groupBy("node").agg(F.first("bands").alias("bands"), F.first("n").alias("n"), F.min(F.struct(*KEY)).alias("k")), "nodes")
    keys = nodes.select("node", "n", F.posexplode("bands").alias("band", "key"))
    crowded = keys.groupBy("band", "key").agg(F.min("node").alias("centre"), F.max("node").alias("last")).where("centre <> last").select("band", "key", "centre")
    members = common.cut(keys.hint("merge").join(common.cut(crowded, "buckets"), ["band", "key"]), "members")
    # one bag for each node that has a candidate, from the text of one row that is known by its keys
    some = members.select("node").distinct().join(nodes, "node").select("node", "k.*")
    texts = rows.select(*KEY, "text").hint("merge").join(some, KEY).groupBy("node").agg(F.first("text").alias("text"))
    bags = common.cut(texts.select("node", F.arrow_udf(bagged, "binary")("text").alias("bag")), "bags")

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs (node, b) whose multisets overlap by least or more, as links (a, b)."""
        new = pairs.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()
        first = new.join(bags.select(F.col("node").alias("a"), F.col("bag").alias("x")).hint("merge"), "a")
        both = first.join(bags.select(F.col("node").alias("b"), F.col("bag").alias("y")).hint("merge"), "b")
        return common.cut(both.where(F.arrow_udf(alike, "double")("x", "y") >= least).select("a", "b"), "links")

    def classed() -> DataFrame:
        return common.cut(members.select("band", "key", "node", "n").join(own, "node", "left").withColumn("class", F.coalesce("class", "node")), "held")

    links = verified(members.where("node <> centre").select("node", F.col("centre").alias("b")))
    own = components(links)
    for t in range(1, rounds):
        held = classed()
        split = held.groupBy("band", "key").agg(F.min("class").alias("lo"), F.max("class").alias("hi"), F.min(F.struct(F.xxhash64("node", F.lit(t)).alias("x"), "node", "class")).alias("c"), F.count(F.lit(1)).alias("m")).where("lo <> hi and m > 2").select("band", "key", F.col("c.node").alias("b"), F.col("c.class").alias("bc"))
        links = links.union(verified(held.join(common.cut(split, "centres"), ["band", "key"]).where("class <> bc").select("node", "b")))
        own = components(links)
        common.drop(held)
    pairs = blocked(classed()).join(bags.hint("merge"), "node").select("band", "key", "kind", "i", "j", "node", "class", "second", "bag")
    order = ["band", "key", "kind", "i", "j"]
    dealt = pairs.repartition(common.partitions(spark), *order).sortWithinPartitions(*order)
    more = common.cut(dealt.mapInArrow(linker(least), "a long, b long"), "links")
    own = components(links.union(more))
    return common.cut(known.drop("bands", "n").join(own, "node", "left").withColumn("class", F.coalesce("class", "node")), "classes")


def with_ids(found: DataFrame) -> DataFrame:
    """doc_id, class_id (smallest doc_id of the class), class_size."""
    ids = found.groupBy("class").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return found.join(common.cut(ids, "class-ids"), "class").select("doc_id", "class_id", "class_size")


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_ids(classes(common.read(spark, sf_dir, "documents").select("doc_id", "text")))


def dedup(docs: DataFrame) -> DataFrame:
    """docs' rows with docs' columns, one of each class: the row of smallest doc_id (nulls last), of rows that share it
    one, and of equal rows one."""
    kept = classes(docs).groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), *KEY)).alias("k"))
    keep = common.cut(kept.select(*[F.col(f"k.{c}").alias(c) for c in KEY]), "keepers")
    first = F.row_number().over(Window.partitionBy(*KEY).orderBy(F.lit(1)))
    rows = keyed(docs).join(keep, KEY).withColumn("_ll_r", first)
    return rows.where("_ll_r = 1").select(*[F.col(f"`{c}`") for c in docs.columns])
