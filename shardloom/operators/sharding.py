"""Positional shards: every N rows of a file, in file order, numbered across the files in order of their names; or every N
rows of a table whose files are parts of one list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import sample_key, shard_count
from ..sources.tables import BLOCK, FILE, INDEX, kept

#: Files whose offsets are broadcast; more are joined by a shuffle.
MOST_BROADCAST_FILES = 1_000_000


def with_row_index(df: DataFrame) -> DataFrame:
    """Rows numbered from 0 within their file; df comes straight from a scan. Parquet scans and delimited text know the
    number. Rows of other formats have a running number within their task, where a split's rows stand together, so a row
    for each split is enough to know what comes before it: rows are not shuffled, however large a file is. The rows are
    written once with their running numbers: a second scan may be split otherwise, as when executors join in between. A
    row whose split is not known raises."""
    if INDEX in df.columns:
        return df
    rows = kept(df.withColumn("_seq", F.monotonically_increasing_id()), "rows")
    splits = rows.groupBy(FILE, BLOCK).agg(F.count(F.lit(1)).alias("_n"), F.min("_seq").alias("_least"))
    before = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select(FILE, BLOCK, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_least")).alias("_start"))
    return placed(rows, starts)


def placed(rows: DataFrame, starts: DataFrame) -> DataFrame:
    """rows (FILE, BLOCK, _seq) with INDEX; starts (FILE, BLOCK, _start): what to add in each split."""
    known = F.coalesce("_start", F.raise_error(F.lit("a row's split is not known")).cast("long"))
    return rows.join(starts, [FILE, BLOCK], "left").withColumn(INDEX, (F.col("_seq") + known).cast("long")).drop("_seq", "_start")


def by_numbers(name: Column) -> Column:
    """What puts names in order with the numbers in them by value, so that part-9 comes before part-10: every number has 20
    digits."""
    return F.regexp_replace(F.regexp_replace(name, r"(\d+)", "0" * 20 + "$1"), r"0*(\d{20,})", "$1")


def file_offsets(files: DataFrame, size: int, start_shard_id: int = 0, start_file_id: int = 0, numbered: bool = False) -> DataFrame:
    """files (FILE, n_rows) -> FILE, n_rows, n_shards, first_shard: shards of the files before it, in order of names, or if
    numbered with the numbers in them by value. Files before start_file_id are left out but keep their numbers. A row for each
    file goes through one window."""
    order = Window.orderBy(*([by_numbers(F.col(FILE))] if numbered else []), FILE)
    counted = files.withColumns({"n_shards": shard_count(F.col("n_rows"), size), "file_idx": F.row_number().over(order) - 1})
    before = F.coalesce(F.sum("n_shards").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return counted.withColumn("first_shard", (before + F.lit(start_shard_id)).cast("long")).where(F.col("file_idx") >= start_file_id).drop("file_idx")


def with_shards(df: DataFrame, size: int, start_shard_id: int = 0, start_file_id: int = 0, one_list: bool = False) -> DataFrame:
    """df with shard_id and idx (place in the shard). Only a row for each file is aggregated and joined back. one_list: the
    files are parts of one list, in order of the numbers in their names, so that a shard runs on into the next file instead of
    ending with its own."""
    rows = with_row_index(df)
    unit = 1 if one_list else size  # a file's first row, or its first shard
    offsets = file_offsets(rows.groupBy(FILE).agg(F.count(F.lit(1)).alias("n_rows")), unit, 0, start_file_id, one_list).select(FILE, F.col("first_shard").alias("_first"))
    joined = rows.join(F.broadcast(offsets) if len(df.inputFiles()) <= MOST_BROADCAST_FILES else offsets, FILE)
    place = F.col("_first") * unit + F.col(INDEX)
    shard, idx = positions(place, size)
    return joined.select(*[c for c in df.columns if c not in (FILE, BLOCK, INDEX)], (shard + F.lit(start_shard_id)).cast("long").alias("shard_id"), idx.alias("idx"))


def positions(row_number: Column, size: int) -> tuple[Column, Column]:
    """Shard and place of a row numbered from 0 in one file."""
    return F.floor(row_number / size).cast("long"), (row_number % size).cast("long")


def with_key(df: DataFrame, magnitude: int, shard_digits: int) -> DataFrame:
    return df.withColumn("key", sample_key(F.col("shard_id"), F.col("idx"), magnitude, shard_digits))


def remaining(df: DataFrame, done: DataFrame) -> DataFrame:
    """Rows of shards that are not done; done (shard_id) comes from the stats files, and Spark broadcasts it if it is
    small."""
    return df.join(done.select("shard_id").distinct(), "shard_id", "left_anti")


def next_shard(done: DataFrame) -> DataFrame:
    """start_shard_id: the largest done id and one, 0 without any."""
    return done.agg((F.coalesce(F.max("shard_id"), F.lit(-1)) + 1).cast("long").alias("start_shard_id"))


def manifest(df: DataFrame) -> DataFrame:
    """A row for each shard: its rows, first and last key."""
    return df.groupBy("shard_id").agg(F.count(F.lit(1)).alias("n_rows"), F.min("idx").alias("first_idx"), F.max("idx").alias("last_idx"))
