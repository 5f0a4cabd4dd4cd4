"""The whole job: URL table -> shards and keys -> shards not yet done -> fetch, write and commit, shard by shard.

A shard is fetched, written and committed in one task (sinks.commit), its statistics last: they mark it as done. Nothing of
a job is kept elsewhere, so one that dies keeps each shard it finished and fetches the rest alone when it is run again. The
rows of the ledger tell what became of each shard; shards that failed are tried again, up to max_shard_retry times, and
those that fail to the end stand in the table _failed_shards of the output folder with their error.
"""

from __future__ import annotations

import functools
import time
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from ..config import Options
from ..operators import classify, fetch, images, sharding
from ..sinks import commit
from ..sources.containers import manifest
from ..sources.tables import url_table
from ..streaming import monitor
from ..streaming.monitor import done_shards

#: Tasks of a pass at most, and seconds after which what a dead run has staged is deleted.
MOST_TASKS, STALE = 100_000, 7 * 24 * 3600


def _path(spark: SparkSession, folder: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(folder)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def planned(spark: SparkSession, options: Options, done: DataFrame | None = None) -> DataFrame:
    """The canonical table with shard_id, idx and key, without shards that are done."""
    table = url_table(spark, options.url_list, options.input_format, options.url_col, options.caption_col, options.extras)
    sharded = sharding.with_shards(table, options.number_sample_per_shard, options.start_shard_id, options.start_file_id, options.one_list)
    if done is not None:
        sharded = sharding.remaining(sharded, done)
    return sharding.with_key(sharded, options.magnitude, options.oom_shard_count)


def outcome(options: Options, codecs: dict | None = None) -> commit.Outcome:
    """What is made of a body. codecs: decoders, encoders and blurrer of images.Resizer beyond the built-in ones."""
    resizer = None
    if not options.disable_all_reencoding:
        resizer = images.Resizer(
            size=options.image_size, mode=options.resize_mode, only_if_bigger=options.resize_only_if_bigger, up=options.upscale_interpolation, down=options.downscale_interpolation, encode_format=options.encode_format, quality=options.encode_quality,
            skip_reencode=options.skip_reencode, min_size=options.min_image_size, max_area=options.max_image_area, max_aspect=options.max_aspect_ratio, **(codecs or {}),
        )
    return commit.Outcome(options.encode_format, options.verify_hash, options.compute_hash, resizer, options.bbox_col)


def target(options: Options, rows: DataFrame, made: commit.Outcome, run: str) -> commit.Target:
    """Where a run writes, and the metadata of its rows: columns of the table, those that outcomes add, key and status."""
    plain = to_arrow_schema(rows.drop("shard_id", "key").schema)
    schema = pa.schema([*plain, *made.columns, pa.field("key", pa.string()), pa.field("status", pa.string()), pa.field("error_message", pa.string())])
    return commit.Target(options.output_folder, run, options.output_format, options.encode_format, bool(options.caption_col), options.oom_shard_count, schema, options.commit == "manifest")


def looked_up(rows: DataFrame, store: DataFrame, options: Options) -> DataFrame:
    """rows with payload and error_message from a table (url and what else tells rows apart, body)."""
    payload = options.encode_format
    got = fetch.fetch_lookup(rows, store, payload)
    got = got.withColumn("error_message", F.coalesce("error_message", classify.size_error(F.octet_length(F.col(payload)), options.max_bytes)))
    return got.withColumn(payload, F.when(F.col("error_message").isNull(), F.col(payload)))


def swept(spark: SparkSession, folder: str, run: str | None = None) -> None:
    """Delete what this run has staged, and what runs have left that have been dead for long; other runs' work stays."""
    fs, at = _path(spark, f"{folder}/_staging")
    if not fs.exists(at):
        return
    for status in fs.listStatus(at):
        if status.getPath().getName() == run or status.getModificationTime() < (time.time() - STALE) * 1000:
            fs.delete(status.getPath(), True)


def ledger(spark: SparkSession, folder: str, run: str) -> DataFrame:
    """A row for each shard and pass of a run, with pass (from 0)."""
    passes = spark.read.schema(commit.LEDGER + ", pass int").option("basePath", f"{folder}/_ledger/{run}")
    return passes.parquet(f"{folder}/_ledger/{run}")


def materialize(spark: SparkSession, options: Options, fetcher=None, store: DataFrame | None = None, codecs: dict | None = None, monitoring: bool | Callable = False) -> DataFrame:
    """Run the job; returns the metadata of the rows that it wrote. store (url, body) replaces the network; columns
    of the table besides url tell bodies of one url apart. With
    monitoring, totals of the statistics files go to the in-memory table job_totals while shards finish, and once more in
    the end; a function is given (kind, rows) instead: `totals`, `statuses` (every 60 seconds), `bad` shards and `line`s."""
    folder, run = options.output_folder, uuid.uuid4().hex
    fs, at = _path(spark, folder)
    if options.incremental_mode == "overwrite" and fs.exists(at):
        fs.delete(at, True)
    fs.mkdirs(at)
    swept(spark, folder)
    if options.incremental_mode == "extend":
        options.start_shard_id = sharding.next_shard(done_shards(spark, folder)).first()[0]
    watch = None
    if monitoring:
        before = f"{folder}/_monitor_{run}/done"
        done_shards(spark, folder).write.parquet(before)  # as it is now: what this run adds is not in it
        known, state = spark.read.schema("shard_id long").parquet(before), f"{folder}/_monitor_{run}/state"
        if callable(monitoring):
            given = {kind: functools.partial(monitoring, kind) for kind in ("totals", "statuses", "bad")}
            watch = monitor.Monitor(spark, folder, state, **given, say=functools.partial(monitoring, "line"), done=known, interval="1 second")
        else:
            watch = monitor.start(spark, folder, "job_totals", state, done=known)
    try:
        every = planned(spark, options).drop("idx")
        made = outcome(options, codecs)
        where = target(options, every, made, run)
        if store is None and fetcher is None:
            fetcher = fetch.HttpFetcher(options.timeout, options.user_agent_token, options.disallowed_header_directives, options.max_bytes)
        for k in range(options.max_shard_retry + 1):
            rows = sharding.remaining(every, done_shards(spark, folder)) if options.incremental_mode != "extend" or k else every
            n = rows.agg(F.count_distinct("shard_id")).first()[0]
            if store is not None:
                rows = looked_up(rows, store, options)
            told = commit.commit_shards(commit.dealt(rows, min(max(n, 1), MOST_TASKS)), where, made, None if store is not None else fetcher, options.thread_count, options.retries, options.max_bytes_in_flight)
            told.write.parquet(f"{folder}/_ledger/{run}/pass={k}")
            bad = spark.read.schema(commit.LEDGER).parquet(f"{folder}/_ledger/{run}/pass={k}").where("error is not null")
            if not bad.limit(1).count():
                break
        bad.select("shard_id", "error").write.mode("overwrite").parquet(f"{folder}/_failed_shards")
    finally:
        swept(spark, folder, run)
        if isinstance(watch, monitor.Monitor):
            watch.stop()
        elif watch:
            watch.processAllAvailable()  # the final count
            watch.stop()
    return written(spark, where)


def written(spark: SparkSession, where: commit.Target) -> DataFrame:
    """The metadata of the shards that a run has committed."""
    schema = from_arrow_schema(where.schema.append(pa.field("shard", pa.string())))
    mine = ledger(spark, where.folder, where.run).where("error is null").select("shard")
    if where.manifest:
        paths = [r.table for r in manifest(spark, where.folder).join(mine.distinct(), "shard").select("table").orderBy("shard").collect()]
        rows = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
        return rows.select(*where.schema.names)
    fs, at = _path(spark, f"{where.folder}/{where.tables}")
    if not fs.exists(at):
        return spark.createDataFrame([], schema).drop("shard")
    return spark.read.schema(schema).parquet(at.toString()).join(mine.distinct(), "shard", "left_semi").select(*where.schema.names)


def download(spark: SparkSession, url_list: str, fetcher=None, store: DataFrame | None = None, codecs: dict | None = None, monitoring: bool | Callable = False, **parameters) -> DataFrame:
    """Fetch the URLs of url_list and write them as sharded containers; parameters are those of Options."""
    return materialize(spark, Options(url_list, **parameters), fetcher, store, codecs, monitoring)
