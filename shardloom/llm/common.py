"""Helpers that the training-data operators share."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Separators of the word rule `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` once A-Z are lower-cased, as a character class.
WORD_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


#: Vectored reads take a buffer outside the heap for each column chunk and thread, and keep it; executors' memory is
#: better spent elsewhere.
PLAIN_READS = {"parquet.hadoop.vectored.io.enabled": "false"}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.options(**PLAIN_READS).parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir, or, where it is unset, a folder of
    this machine, which only local mode may use."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.conf.set("spark.checkpoint.dir", found := "file://" + tempfile.mkdtemp(prefix="shardloom-"))
    return found


#: Narrow rows that one task writes, where their number is known.
ROWS_A_FILE = 500_000


def cut(df: DataFrame, name: str = "cut", rows: int | None = None) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: lineage ends here, so a lost executor costs no more
    than the tasks it ran, and what follows may read it many times. rows: how many narrow rows df has at most, where
    that is known; then so few tasks write them that no file is tiny."""
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_A_FILE)))
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    # partitions are put together to the advised size, so that a small table is few files
    first = "spark.sql.adaptive.coalescePartitions.parallelismFirst"
    before = spark.conf.get(first)
    spark.conf.set(first, "false")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(first, before)
    out = spark.read.options(**PLAIN_READS).schema(df.schema).parquet(path)
    return same_table(path, out)


def same_table(table: DataFrame | str, view: DataFrame) -> DataFrame:
    """view, for drop() the same as the table of cut() that it reads."""
    view.__dict__["_ll_path"] = table if isinstance(table, str) else table.__dict__["_ll_path"]
    return view


def drop(*tables: DataFrame) -> None:
    """Delete tables of cut() that nothing reads any more."""
    for table in tables:
        context = table.sparkSession.sparkContext
        at = context._jvm.org.apache.hadoop.fs.Path(table.__dict__["_ll_path"])
        at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)


def ascii_lower(text: Column) -> Column:
    """Lower case for matching words of A-Z. Only two letters outside ASCII have a lower case with ASCII in it (the
    dotted capital I and the Kelvin sign); they become other letters first, so they never match."""
    return F.lower(F.replace(F.replace(text, F.lit("\u0130"), F.lit("\u0131")), F.lit("\u212a"), F.lit("\u03ba")))


def words_of(text: Column) -> Column:
    """The words of a text as an array: A-Z lower-cased, split at WORD_SEPARATORS, no empty strings."""
    return F.array_remove(F.split(ascii_lower(text), WORD_SEPARATORS), "")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def doc_crc(doc_id: Column) -> Column:
    """crc32 of the id as text, by which held-out rows are told; a null id counts as the empty string."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")))


def per_worker(build: Callable[[], object], key: str, group: str = "") -> object:
    """build(), once per Python worker and key. Workers serve one operator after another: what another group has built
    is let go, so caches don't add up."""
    if _GROUP != [group]:
        _BUILT.clear()
        _GROUP[:] = [group]
    if key not in _BUILT:
        while len(_BUILT) > 4:
            _BUILT.pop(next(iter(_BUILT)))
        _BUILT[key] = build()
    return _BUILT[key]


#: Characters (or bytes) of the longest key that Kept keeps.
KEPT_KEY = 64


class Kept(dict):
    """work(key) by key, for the keys that come again: two generations of at most `most` results each, of keys of
    KEPT_KEY characters at most, so the memory is bounded whatever the texts hold. A key that is asked for after its
    generation has aged is taken over into the new one; the rest of the old one goes."""

    def __init__(self, work: Callable[[object], object], most: int):
        super().__init__()
        self.work, self.most, self.old = work, most, {}

    def __missing__(self, key):
        if len(key) > KEPT_KEY:
            return self.work(key)
        out = self.old.get(key)
        if out is None:
            out = self.work(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = out
        return out


_BUILT: dict[str, object] = {}
_GROUP: list[str] = []


def sampled(rows: DataFrame, most: int, *keys: str) -> DataFrame:
    """At most `most` rows, those of the lowest hashes of keys. Beyond that number a bound on the hash, from a count,
    leaves about 1.3 times as many, so that tasks send few rows however many tasks there are."""
    n = rows.count()
    hashed = rows.withColumn("_ll_h", F.xxhash64(*keys))
    if n > 1.3 * most:
        hashed = hashed.where(F.col("_ll_h") <= int(-(2**63) + 2**64 * (1.3 * most / n)))
    return hashed.orderBy("_ll_h", *keys).limit(most).drop("_ll_h")


def refuse(docs: DataFrame, *names: str) -> None:
    """Raise if docs has a column of one of these names, which an operator needs for itself."""
    clash = sorted({c.lower() for c in docs.columns} & {n.lower() for n in names})
    if clash:
        raise ValueError(f"columns of these names are the operator's own: {', '.join(clash)}")


def spans_as_text(found: DataFrame) -> DataFrame:
    """removed as text: start-end of each span, comma-joined."""
    return found.withColumn("removed", F.array_join(F.transform("removed", lambda x: F.concat(x["start"].cast("string"), F.lit("-"), x["end"].cast("string"))), ","))


#: Rows that a function of Arrow arrays works on at a time, of a batch of up to 10,000.
SLICE_ROWS = 512


def sliced(work: Callable[..., pa.Array]) -> Callable[..., pa.Array]:
    """work over SLICE_ROWS rows of its arrays at a time, so that what it makes of texts in Python does not stand there for
    a whole Arrow batch."""

    def each(*columns: pa.Array) -> pa.Array:
        return pa.concat_arrays([work(*(c.slice(at, SLICE_ROWS) for c in columns)) for at in range(0, max(len(columns[0]), 1), SLICE_ROWS)])

    return each


def digest_of(blob: bytes) -> str:
    return hashlib.sha256(blob).hexdigest()


def chunks(rows: list, most_chars: int = 4_000_000) -> Iterator[list]:
    """Runs of rows of about most_chars together, so that a batch of very long texts is worked on in parts."""
    run, size = [], 0
    for row in rows:
        run.append(row)
        size += len(row)
        if size >= most_chars:
            yield run
            run, size = [], 0
    if run:
        yield run
