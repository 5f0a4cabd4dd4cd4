"""Exact Jaccard join of shingle sets by adaptive multi-match prefixes, and the components of its links.

A text is the set of its runs of four words (a text of fewer words is one run of all of them). Two texts link when their
sets' similarity is PERCENT or more.

Runs have one global order, the rarest first. If a set of n runs has a partner, they share at least t = ceil(n * PERCENT /
100) runs, so among the first n - t + 1 runs of both (the index prefix) there is one that they share. A prefix that is longer
by l - 1 runs must hold more of them: two sets whose prefixes leave out t_a - l_a and t_b - l_b of their runs share at least
max(t_a, t_b) - max(t_a - l_a, t_b - l_b) runs within their prefixes. Every set chooses its own l once the index has told how
many postings its index prefix meets: a longer prefix costs more for each candidate and is passed by fewer of them (each takes
l of the postings), and of l = 1, 2, 4, ... up to t, where counting is verification, the one of least estimated cost is
taken. So a set with one near copy has a short prefix, and one among many of its like a long prefix that few strangers
pass. The index itself holds only the index prefixes, whatever l is.

The order comes from one count for each of SLOTS hashes over all documents, summed by task and then over tasks: a table of
fixed size, which alone is broadcast. An order by any counts gives the same links.

Equal sets are one node. Buckets are the runs that several nodes have in their index prefix, each cut by size: a node stands
in the band of its size and the next one, so that only sizes which may link meet. Buckets with the same members are one.
Members are first compared with a few centres of their bucket: candidates are pairs of different classes whose sizes fit,
then those whose prefixes share enough runs, then those whose sets are verified. What that leaves in a bucket with
several classes is compared exactly in blocks of bounded size without a row for any pair (minhash.blocked): prefixes are
counted against each other first, each two in one of the buckets that they share, and only nodes that have a partner
there are compared with whole sets (minhash.forest). So any two texts that share a run of both index prefixes are compared, or are linked through others
already. Components are found by minhash.components.

Defined cases: null text is the empty text; a text without words has the empty set and is linked with nothing, not even
another empty one; rows of equal sets are linked; component_id is the smallest doc_id of the component, null if it has none;
very long texts are compared in blocks of their own; an empty table gives an empty result. joined() reads doc_id and text
alone, so further columns may have any names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, minhash
from .minhash import KEY, mixed

SHINGLE, PERCENT = 4, 85
#: Slots of the table of counts, and slots of a row of it on its way.
SLOTS, SLOT_ROW = 1 << 18, 1 << 14
#: Bytes whose words are hashed at a time; longer words are hashed by another function wherever a text is that long.
SEGMENT, LONG_WORD = 1 << 19, 1 << 16
#: What it costs to send a run of a prefix, in merges of it.
SENT = 10
#: Pairs of a centre that one task compares, about.
CENTRE_PAIRS = 1_000
#: Nodes that are broadcast to find their texts and prefixes (up to 40 bytes each); more are joined by a shuffle.
MOST_BROADCAST_NODES = 500_000
#: Rounds of centres before the exact comparison.
ROUNDS = 3

_U = np.uint64


class Words:
    """Hashes of the words of many texts at once. A word's hash is the sum of a random number for each of its bytes, times
    the powers of an odd base, modulo 2^64: running sums give all words of a segment without a loop over them."""

    def __init__(self):
        r = np.random.default_rng(11)
        self.byte = r.integers(0, 1 << 64, 256, _U)
        self.power = np.full(SEGMENT + LONG_WORD + 1, r.integers(0, 1 << 63, dtype=_U) * _U(2) + _U(1))
        self.power[0] = 1
        with np.errstate(over="ignore"):
            self.power = np.cumprod(self.power, dtype=_U)

    def of_segment(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(hash, first byte) of each word of lower-case data of at most SEGMENT + LONG_WORD bytes."""
        raw = np.frombuffer(data, np.uint8)
        blank = (raw == 32) | (raw - np.uint8(9) <= 4)
        edge = np.flatnonzero(np.diff(blank, prepend=True, append=True))
        starts, ends = edge[::2], edge[1::2]
        sums = np.zeros(len(raw) + 1, _U)
        with np.errstate(over="ignore"):
            np.cumsum(self.byte[raw] * self.power[: len(raw)], dtype=_U, out=sums[1:])
            return mixed((sums[ends] - sums[starts]) * self.power[SEGMENT + LONG_WORD - starts]), starts

    def of_text(self, data: bytes) -> np.ndarray:
        """Hashes of the words of one text of any length, segment by segment."""
        data = data.lower()
        if len(data) <= SEGMENT:
            return self.of_segment(data)[0]
        out, run, size = [], [], 0
        for word in data.split():
            if len(word) > LONG_WORD:  # has a hash of another kind, wherever it stands
                out += [self.of_segment(b" ".join(run))[0], np.array([xxhash.xxh64_intdigest(word)], _U)]
                run, size = [], 0
                continue
            run.append(word)
            size += len(word) + 1
            if size > SEGMENT:
                out.append(self.of_segment(b" ".join(run))[0])
                run, size = [], 0
        return np.concatenate([*out, self.of_segment(b" ".join(run))[0]])


def runs_of(h: np.ndarray) -> np.ndarray:
    """The distinct runs of a text's words, sorted."""
    n = len(h)
    if not n:
        return h
    s = np.full(max(n - SHINGLE + 1, 1), min(n, SHINGLE), _U)
    with np.errstate(over="ignore"):
        for i in range(min(n, SHINGLE)):
            s = s * _U(0x9E3779B97F4A7C15) + h[i : i + len(s)]
    return np.unique(mixed(s))


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The set of each text, as sorted 64-bit hashes; short texts are hashed many at a time."""
    words = common.per_worker(Words, "words", "jaccard")
    texts = texts.cast(pa.binary())
    held: list[bytes] = []
    size = 0

    def given():
        whole = b" ".join(held).lower()
        hashes, starts = words.of_segment(whole)
        ends = np.cumsum([len(t) + 1 for t in held])
        for own in np.split(hashes, np.searchsorted(starts, ends[:-1])):
            yield runs_of(own)

    for text in texts:
        data = text.as_py() or b""
        if len(data) > SEGMENT // 4:
            yield from given() if held else ()
            held, size = [], 0
            yield runs_of(words.of_text(data))
            continue
        if size + len(data) >= SEGMENT:
            yield from given()
            held, size = [], 0
        held.append(data)
        size += len(data) + 1
    if held:
        yield from given()


def shingles(text: bytes | None) -> np.ndarray:
    return next(shingle_sets(pa.array([text], pa.binary())))


def least_shared(n: int) -> int:
    """Runs that a set of n has in common with any partner, at least."""
    return -(-n * PERCENT // 100)


def node_of(runs: np.ndarray) -> int | None:
    return xxhash.xxh3_64_intdigest(runs.tobytes()) >> 1 if len(runs) else None


def slot(runs: np.ndarray) -> np.ndarray:
    return (runs & _U(SLOTS - 1)).astype(np.int64)


def nodes_and_counts(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, KEY) -> rows of two kinds: for each row of docs its doc_id, KEY, node (63 bits of a hash of the set;
    null for the empty one) and n, and for each task its counts (at: first slot; counts: SLOT_ROW of them as 64-bit)."""
    names = ["doc_id", *KEY, "node", "n", "at", "counts"]

    def work(batches):
        total, kind = np.zeros(SLOTS, np.int64), None
        for batch in batches:
            kind = batch.column("doc_id").type
            node, n = [], []
            for runs in shingle_sets(batch.column("text")):
                node.append(node_of(runs))
                n.append(len(runs))
                np.add.at(total, slot(runs), 1)
            told = [batch.column("doc_id"), *(batch.column(k) for k in KEY), pa.array(node, pa.int64()), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays([*told, pa.nulls(len(n), pa.int64()), pa.nulls(len(n), pa.binary())], names=names)
        if kind is not None:
            at = range(0, SLOTS, SLOT_ROW)
            none = [pa.nulls(len(at), k) for k in (kind, *[pa.int64()] * 4)]
            yield pa.RecordBatch.from_arrays([*none, pa.array(at, pa.int64()), pa.array([total[i : i + SLOT_ROW].tobytes() for i in at], pa.binary())], names=names)

    return docs.mapInArrow(work, f"doc_id {dict(docs.dtypes)['doc_id']}, {KEY[0]} long, {KEY[1]} long, node long, n long, at long, counts binary")


def summed_counts(rows: DataFrame) -> np.ndarray:
    """The table of counts of all tasks: summed within the tasks that read it, then by row of the table, then fetched
    (SLOTS numbers, whatever the corpus)."""

    def work(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = np.frombuffer(counts.as_buffer(), np.int64)
                total[at] = total[at] + own if at in total else own
        yield pa.RecordBatch.from_arrays([pa.array([*total], pa.int64()), pa.array([v.tobytes() for v in total.values()], pa.binary())], names=["at", "counts"])

    schema = "at long, counts binary"
    once = rows.where("at is not null").select("at", "counts").mapInArrow(work, schema)
    out = np.zeros(SLOTS, np.int64)
    for row in once.repartition(SLOTS // SLOT_ROW, "at").mapInArrow(work, schema).collect():
        out[row["at"] : row["at"] + SLOT_ROW] += np.frombuffer(row["counts"], np.int64)
    return out


def matches(n: int, postings: int) -> int:
    """The l of a set of n runs whose index prefix meets so many postings: the power of two (or t) of least cost. The prefix
    is sent SENT times over; each candidate costs its merge, and the merge of the sets if it passes. Postings are taken to
    go on as in the index prefix, and a candidate that passes takes l of them."""
    t = least_shared(n)
    ls = np.unique(np.minimum(1 << np.arange(t.bit_length() + 1), t))
    ends = n - t + ls
    passing = np.minimum(postings, postings * ends / ((n - t + 1) * ls))
    return int(ls[np.argmin(ends * float(SENT) + postings * ends + passing * n)])


def ordered(runs: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A set's runs (sorted by hash) in the global order: by count, then hash."""
    own = count[slot(runs)].astype(_U)
    return runs[np.argsort((own << _U(24)) | (runs >> _U(40)), kind="stable")]  # ties keep the order of their hashes


def prefixes(docs: DataFrame, counts: np.ndarray) -> DataFrame:
    """docs (text) -> node, n, prefix: the index prefix. A task gives a node again only if it has met very many since."""
    told = docs.sparkSession.sparkContext.broadcast(counts)

    def work(batches):
        seen = common.Kept(lambda node: True, 200_000)
        for batch in batches:
            rows = []
            for runs in shingle_sets(batch.column("text")):
                node = node_of(runs)
                if node is None or (key := node.to_bytes(8, "little")) in seen or key in seen.old:
                    continue
                seen[key]
                rows.append((node, len(runs), ordered(runs, told.value)[: len(runs) - least_shared(len(runs)) + 1].view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.list_(pa.int64()))], names=["node", "n", "prefix"])

    found = docs.select("text").mapInArrow(work, "node long, n long, prefix array<long>")
    return found.groupBy("node").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"))


def lengthened(texts: DataFrame, counts: np.ndarray) -> DataFrame:
    """texts (node, postings, text) -> node, n, l, prefix, lost: the runs as far as l asks, by 32 of their bits, and how many
    of them that makes equal. It is a filter alone: two prefixes share as many of these as runs, or fewer by what is lost."""
    told = texts.sparkSession.sparkContext.broadcast(counts)

    def work(batches):
        for batch in batches:
            sets = [*shingle_sets(batch.column("text"))]
            ls = [matches(len(x), p) for x, p in zip(sets, batch.column("postings").to_pylist(), strict=True)]
            long = [ordered(x, told.value)[: len(x) - least_shared(len(x)) + m] for x, m in zip(sets, ls, strict=True)]
            cut = [np.unique(x.astype(np.uint32)).view(np.int32) for x in long]
            lost = [len(x) - len(y) for x, y in zip(long, cut, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([*map(len, sets)], pa.int64()), pa.array(ls, pa.int64()), pa.array(cut, pa.list_(pa.int32())), pa.array(lost, pa.int64())], names=["node", "n", "l", "prefix", "lost"])

    return texts.mapInArrow(work, "node long, n long, l long, prefix array<int>, lost long")


def t_of(n: str):
    return F.expr(f"({n} * {PERCENT} + 99) div 100")


def shared(posted: DataFrame, *keys: str) -> DataFrame:
    """keys, centre (the smallest node), m: the groups of several nodes, one of those with the same members."""
    held = posted.groupBy(*keys).agg(F.min("node").alias("centre"), F.max("node").alias("last"), F.count(F.lit(1)).alias("m"), F.bit_xor(F.xxhash64("node")).alias("x")).where("centre <> last")
    return held.groupBy("centre", "last", "m", "x").agg(F.min(F.struct(*keys)).alias("k")).select("k.*", "centre", "m")


def buckets(known: DataFrame) -> DataFrame:
    """prefixes -> band (of size), key, node, n, centre, m."""
    posted = known.select("node", "n", F.explode("prefix").alias("key"))
    several = posted.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi").select("key")
    crowded = posted.hint("merge").join(common.cut(several, "runs"), "key")
    wide = math.log(100 / PERCENT) * (1 + 1e-9)  # sizes that may link are in one band or in neighbours
    band = F.floor(F.log(F.col("n").cast("double")) / wide).cast("int")
    banded = common.cut(crowded.select("key", "node", "n", F.explode(F.array(band, band + 1)).alias("band")), "banded")
    most = banded.count()
    return common.cut(banded.hint("merge").join(common.cut(shared(banded, "band", "key"), "buckets", most), ["band", "key"]), "members", most)


def is_link(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


def compared(batches):
    """mapInArrow function: rows (b, salt, node, text) sorted so that a centre's own row (node = b) comes first in its group
    -> links (a, b)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    at, centre = None, None
    for batch in batches:
        out = []
        rows = zip(*(batch.column(c).to_pylist() for c in ("b", "salt", "node")), strict=True)
        for (b, salt, node), runs in zip(rows, shingle_sets(batch.column("text")), strict=True):
            if (b, salt) != at:
                at, centre = (b, salt), runs if node == b else None
            elif node != b and centre is not None and is_link(runs, centre):
                out.append((min(node, b), max(node, b)))
        yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in (0, 1)], schema=schema)


BLOCK = ["band", "key", "kind", "i", "j"]


def by_block(batches, columns: list[str], sets) -> Iterator[tuple[tuple, list[tuple], list[np.ndarray]]]:
    """The blocks of sorted rows: BLOCK, the rows' columns, and the arrays that sets(batch) gives for them."""
    at, rows, held = None, [], []
    for batch in batches:
        told = zip(*(batch.column(c).to_pylist() for c in (*BLOCK, *columns)), strict=True)
        for row, own in zip(told, sets(batch), strict=True):
            if row[:5] != at:
                if held:
                    yield at, rows, held
                at, rows, held = row[:5], [], []
            rows.append(row[5:])
            held.append(own)
    if held:
        yield at, rows, held


def common_runs(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each two of the sets share, by products of 0/1 matrices of some columns at a time."""
    values, column = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    shared = np.bincount(column, minlength=len(values)) > 1
    keep = shared[column]
    column, owner = (np.cumsum(shared) - 1)[column[keep]], owner[keep]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, int(shared.sum()), minhash.BLOCK_COLUMNS):
        here = (column >= at) & (column < at + minhash.BLOCK_COLUMNS)
        m = np.zeros((len(sets), minhash.BLOCK_COLUMNS), np.float32)
        m[owner[here], column[here] - at] = 1
        out += m @ m.T
    return out


def passing(batches):
    """mapInArrow function: rows sorted by BLOCK, with node, class, second, n, l, lost, bucket (a number for it), buckets (those of
    the node, sorted) and prefix -> BLOCK, node of those that have a partner of another class whose size fits and whose
    prefix shares as many runs as a link would. Two nodes that meet in several buckets are partners in the least of them."""
    schema = pa.schema([("band", pa.int32()), ("key", pa.int64()), ("kind", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("node", pa.int64())])
    arrays = lambda batch: zip(*([np.asarray(x.values) for x in batch.column(c)] for c in ("prefix", "buckets")), strict=True)
    for at, rows, held in by_block(batches, ["node", "class", "second", "n", "l", "lost", "bucket"], arrays):
        nodes, classes, second, n, m, lost, bucket = (np.array(x) for x in zip(*rows, strict=True))
        t = -(-n * PERCENT // 100)
        both = lambda f, x: f(x[:, None], x[None, :])
        fit = both(np.not_equal, classes) & (100 * both(np.minimum, n) >= PERCENT * both(np.maximum, n))
        if at[2] == 1 or at[3] != at[4]:
            fit &= both(np.not_equal, second)
        fit &= common_runs([b[b < bucket[0]] for _, b in held]) == 0
        fit &= common_runs([p for p, _ in held]) + both(np.add, lost) >= both(np.maximum, t) - both(np.maximum, t - m)
        kept = nodes[fit.any(axis=1)]
        yield pa.RecordBatch.from_arrays([*(pa.array([x] * len(kept), k) for x, k in zip(at, schema.types, strict=False)), pa.array(kept, pa.int64())], schema=schema)


def linker(batches):
    """mapInArrow function: rows sorted by BLOCK, with node, class, second, text -> links (a, b)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    for at, rows, held in by_block(batches, ["node", "class", "second"], lambda batch: shingle_sets(batch.column("text"))):
        nodes, classes, second = (np.array(x) for x in zip(*rows, strict=True))
        links = minhash.forest(nodes, classes, second, at[2] == 1 or at[3] != at[4], held, PERCENT / 100)
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], schema=schema)


def of_nodes(table: DataFrame, nodes: DataFrame, most: int) -> DataFrame:
    """The rows of some nodes (at most `most`): by a broadcast of the nodes where their counted number allows it, else by a
    shuffle that what follows can use."""
    some = common.cut(nodes.select("node").distinct(), "some", most)
    return table.join(F.broadcast(some) if some.count() <= MOST_BROADCAST_NODES else some.hint("merge"), "node", "left_semi")


def promising(pairs: DataFrame, known: DataFrame, most: int) -> DataFrame:
    """Of the pairs (node, b) of nodes those whose sizes fit and whose prefixes share as many runs as a link would."""
    some = of_nodes(known, pairs.select("node").union(pairs.select("b")), 2 * most)
    side = lambda name, s: some.select(F.col("node").alias(name), *[F.col(c).alias(f"{c}_{s}") for c in ("n", "l", "prefix", "lost")]).hint("merge")
    both = pairs.join(side("node", "a"), "node").join(side("b", "b"), "b").where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * PERCENT)
    needed = F.greatest(t_of("n_a"), t_of("n_b")) - F.greatest(t_of("n_a") - F.col("l_a"), t_of("n_b") - F.col("l_b"))
    return both.where(F.size(F.array_intersect("prefix_a", "prefix_b")) + F.col("lost_a") + F.col("lost_b") >= needed).select("node", "b")


def verified(pairs: DataFrame, known: DataFrame, texts: DataFrame, most: int) -> DataFrame:
    """pairs (node, b: a centre; at most `most`) -> the links (a, b) among them. Each node's text goes to its centre's group; a centre with
    many pairs has several groups, each with its own text."""
    new = common.cut(pairs.select("node", "b").distinct(), "pairs", most)
    some = common.cut(promising(new, known, most), "promising")
    most = some.count()
    salts = some.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / CENTRE_PAIRS).cast("int").alias("salts"))
    salts = common.cut(salts, "salts", most)
    members = some.join(salts.hint("merge"), "b").select("b", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int").alias("salt"), "node")
    centres = salts.select("b", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("b").alias("node"))
    groups = common.cut(members.union(centres), "groups", 3 * most)
    rows = groups.join(of_nodes(texts, groups, 3 * most).hint("merge"), "node").select("b", "salt", "node", (F.col("node") != F.col("b")).alias("later"), "text")
    dealt = rows.repartition(common.partitions(texts.sparkSession), "b", "salt").sortWithinPartitions("b", "salt", "later")
    return common.cut(dealt.mapInArrow(compared, "a long, b long"), "links")


def links(texts: DataFrame, known: DataFrame, members: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """node, class: of the nodes with links. texts (node, text): of each member; known: lengthened(); members: buckets()."""

    most = members.count()

    def classed() -> DataFrame:
        held = members.select("band", "key", "node", "n").join(own, "node", "left").withColumn("class", F.coalesce("class", "node"))
        held = common.cut(held, "held", most)  # buckets of one class are done
        split = held.groupBy("band", "key").agg(F.min("class").alias("lo"), F.max("class").alias("hi"), F.count(F.lit(1)).alias("m")).where("lo <> hi and m > 2")
        out = common.cut(held.join(common.cut(split.select("band", "key"), "split", most).hint("merge"), ["band", "key"]), "open", most)
        common.drop(held)
        return out

    found = verified(members.where("node <> centre").select("node", F.col("centre").alias("b")), known, texts, most)
    own = minhash.components(found)
    for t in range(1, rounds):
        members = classed()
        centre = members.groupBy("band", "key").agg(F.min(F.struct(F.xxhash64("node", F.lit(t)).alias("x"), "node", "class")).alias("c")).select("band", "key", F.col("c.node").alias("b"), F.col("c.class").alias("bc"))
        found = found.union(verified(members.join(common.cut(centre, "centres", most), ["band", "key"]).where("class <> bc").select("node", "b"), known, texts, most))
        own = minhash.components(found)
    members = classed()
    of = members.groupBy("node").agg(F.sort_array(F.collect_list(F.xxhash64("band", "key"))).alias("buckets"))
    blocks = common.cut(minhash.blocked(members), "blocks")
    dealt = lambda rows: rows.repartition(common.partitions(texts.sparkSession), *BLOCK).sortWithinPartitions(*BLOCK)
    told = blocks.join(of_nodes(known, members, most).join(of, "node").hint("merge"), "node").select(*BLOCK, "node", "class", "second", "n", "l", "lost", F.xxhash64("band", "key").alias("bucket"), "buckets", "prefix")
    some = common.cut(dealt(told).mapInArrow(passing, "band int, key long, kind int, i int, j int, node long"), "passing")
    blocks = common.cut(blocks.join(some.hint("merge"), [*BLOCK, "node"], "left_semi"), "blocks")
    told = blocks.join(of_nodes(texts, blocks, blocks.count()).hint("merge"), "node").select(*BLOCK, "node", "class", "second", "text")
    return minhash.components(found.union(common.cut(dealt(told).mapInArrow(linker, "a long, b long"), "links")))


def joined(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, n_shingles, component_id, component_size: one row for each row of docs (doc_id, text)."""
    rows = minhash.keyed(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    both = common.cut(nodes_and_counts(rows), "sets")
    counts = summed_counts(both)
    sets = both.where("at is null").select("doc_id", *KEY, "node", "n")
    members = buckets(common.cut(prefixes(rows, counts), "prefixes"))
    # the text of one row for each node that has a candidate, by the keys of the row
    met = common.cut(members.groupBy("node").agg(F.sum(F.col("m") - 1).alias("postings")), "met", members.count())
    keys = sets.join(met.hint("merge"), "node").groupBy("node", "postings").agg(F.min(F.struct(*KEY)).alias("k")).select("node", "postings", "k.*")
    keys = common.cut(keys, "keys", met.count())
    keys = F.broadcast(keys) if keys.count() <= MOST_BROADCAST_NODES else keys.hint("merge")
    texts = rows.select(*KEY, "text").join(keys, KEY).groupBy("node").agg(F.first("postings").alias("postings"), F.first("text").alias("text"))
    texts = common.cut(texts, "texts")
    own = links(texts.select("node", "text"), common.cut(lengthened(texts, counts), "lengthened"), members, rounds)
    classed = common.cut(sets.join(own.hint("merge"), "node", "left").withColumn("class", F.coalesce("class", "node")), "classes")
    ids = classed.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("component_size"))
    told = classed.join(common.cut(ids, "component-ids").hint("merge"), "class", "left")
    alone = F.col("class").isNull()
    return told.select("doc_id", F.col("n").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), F.when(alone, F.lit(1)).otherwise(F.col("component_size")).cast("long").alias("component_size"))


def op13_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(common.read(spark, sf_dir, "documents").select("doc_id", "text"))
