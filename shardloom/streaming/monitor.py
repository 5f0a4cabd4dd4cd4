"""The monitor: statistics files as a stream, folded into running totals and a table of statuses.

start() keeps the totals alone, as a table. Monitor reports: totals, statuses and files that cannot be parsed are one state
of one stream, and each output has an interval of its own and a last flush.

The file source reads each file once (its checkpoint remembers them), the totals are the state of an ordinary streaming
aggregate, and the trigger interval is the throttle. A file that cannot be parsed is reported and left out. Shards that
were done before the run are left out by id.
"""

from __future__ import annotations

import queue
import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..functions.scalars import shard_of_name
from ..operators.stats import STATS_SCHEMA, merged_status, speed_report, status_table, summed, with_ratios

CORRUPT = "_corrupt_record"
_SCHEMA = STATS_SCHEMA + f", {CORRUPT} string"


def _read(reader, folder: str) -> DataFrame:
    df = reader.schema(_SCHEMA).options(multiLine=True, pathGlobFilter="*_stats.json", recursiveFileLookup=True, columnNameOfCorruptRecord=CORRUPT).json(folder)
    return df.withColumn("shard_id", shard_of_name(F.col("_metadata.file_name")))


def read_stats(spark: SparkSession, folder: str) -> DataFrame:
    """All statistics files of a folder, with shard_id from their names; files that cannot be parsed have CORRUPT."""
    return _read(spark.read, folder)


def stream_stats(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.option("maxFilesPerTrigger", max_files) if max_files else spark.readStream
    return _read(reader, folder)


def good(stats: DataFrame) -> DataFrame:
    return stats.where(F.col(CORRUPT).isNull() & F.col("count").isNotNull()).drop(CORRUPT)


def bad(stats: DataFrame) -> DataFrame:
    return stats.where(F.col(CORRUPT).isNotNull() & F.col("count").isNull()).select("shard_id", CORRUPT)


def done_shards(spark: SparkSession, folder: str) -> DataFrame:
    """shard_id of each shard with a statistics file, by name alone."""
    names = spark.read.format("binaryFile").options(pathGlobFilter="*_stats.json", recursiveFileLookup=True).load(folder).select(F.element_at(F.split("path", "/"), -1).alias("name"))
    return names.select(shard_of_name(F.col("name")).alias("shard_id")).where("shard_id is not null").distinct()


def fresh(stats: DataFrame, done: DataFrame | None) -> DataFrame:
    """Without shards that were done before the run."""
    return stats if done is None else stats.join(done.select("shard_id"), "shard_id", "left_anti")


def totals(stats: DataFrame) -> DataFrame:
    """Running total with ratios: one row, in a stream updated with each file."""
    return with_ratios(summed(stats))


def report(stats: DataFrame) -> DataFrame:
    return speed_report(stats)


def statuses(stats: DataFrame, most: int = 100) -> DataFrame:
    return status_table(merged_status(stats), most)


def line(row) -> str:
    """A report row as one line of text."""
    share = lambda x: "n/a" if x is None else f"{x:.3f}"
    return f"{row['prefix']:7} - success: {share(row['success'])} - failed to download: {share(row['share_failed_to_download'])} - failed to resize: {share(row['share_failed_to_resize'])} - images per sec: {'n/a' if row['img_per_sec'] is None else round(row['img_per_sec'])} - count: {row['count']}"


def start(spark: SparkSession, folder: str, name: str, checkpoint: str, interval: str | None = "5 seconds", done: DataFrame | None = None, emit: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Begin monitoring. Totals go to the in-memory table `name`, or to emit(totals, batch). interval None: all that is
    there, then stop (the final scan)."""
    writer = totals(fresh(good(stream_stats(spark, folder)), done)).writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(emit) if emit else writer.format("memory").queryName(name)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


# --- reports ---------------------------------------------------------------------------------------------------------

COUNTS = ("count", "successes", "failed_to_download", "failed_to_resize")


def folded(stats: DataFrame) -> DataFrame:
    """kind, name, n, start_time, end_time: `total` rows of COUNTS, a `status` row for each status and a `bad` row for each
    file that cannot be parsed (by its shard). In a stream this is one state, which a restart takes up."""
    entry = lambda kind, name, n: F.struct(F.lit(kind).alias("kind"), name.alias("name"), n.cast("long").alias("n"))
    totals_of = F.array(*[entry("total", F.lit(c), F.col(c)) for c in COUNTS])
    said = F.transform(F.map_entries("status_dict"), lambda e: entry("status", e["key"], e["value"]))
    broken = F.col(CORRUPT).isNotNull() | F.col("count").isNull()
    bad_one = F.array(entry("bad", F.coalesce(F.col("shard_id").cast("string"), F.lit("")), F.lit(1)))
    rows = stats.select(F.when(broken, F.lit(None)).otherwise(F.col("start_time")).alias("start_time"), F.when(broken, F.lit(None)).otherwise(F.col("end_time")).alias("end_time"), F.explode(F.when(broken, bad_one).otherwise(F.concat(totals_of, F.coalesce(said, F.array().cast("array<struct<kind:string,name:string,n:bigint>>"))))).alias("e"))
    return rows.groupBy("e.kind", "e.name").agg(F.sum("e.n").alias("n"), F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"))


def totals_in(tally: DataFrame) -> DataFrame:
    """The running total of folded(), with its ratios, as a report's `total` row."""
    only = tally.where("kind = 'total'")
    one = only.agg(*[F.coalesce(F.sum(F.when(F.col("name") == c, F.col("n"))), F.lit(0)).alias(c) for c in COUNTS], F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"))
    return with_ratios(one).withColumn("prefix", F.lit("total"))


def statuses_in(tally: DataFrame, most: int = 100) -> DataFrame:
    """status, frequency, count of the most common statuses of folded()."""
    return status_table(tally.where("kind = 'status'").select(F.col("name").alias("status"), F.col("n").alias("count")), most)


class Throttle:
    """Passes on what it is given if more than min_interval seconds have gone since it last did; sync() passes on the last one
    that was held back."""

    def __init__(self, emit: Callable[[list[Row]], None], min_interval: float, clock: Callable[[], float]):
        self.emit, self.min_interval, self.clock = emit, min_interval, clock
        self.last, self.held = clock(), None

    def __call__(self, rows: list[Row]) -> None:
        if self.clock() - self.last > self.min_interval:
            self.last, self.held = self.clock(), None
            self.emit(rows)
        else:
            self.held = rows

    def sync(self) -> None:
        if self.held is not None:
            rows, self.held = self.held, None
            self.emit(rows)


class Lines(StreamingQueryListener):
    """Says a line for what each batch of a query read, from the metrics that it observes: shards as a `worker` line, and the
    number of files that could not be parsed."""

    def __init__(self, say: Callable[[str], None], name: str):
        super().__init__()
        self.say, self.name = say, name

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception and str(event.id) == self.name:
            self.say(f"monitor failed: {event.exception.splitlines()[0]}")

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get("batch")
        if str(event.progress.id) != self.name or seen is None:
            return
        row = seen.asDict()
        if row["count"]:
            share = lambda c: row[c] / row["count"]
            span = (row["end_time"] or 0) - (row["start_time"] or 0)
            self.say(line({"prefix": "worker", "success": share("successes"), "share_failed_to_download": share("failed_to_download"), "share_failed_to_resize": share("failed_to_resize"), "img_per_sec": row["count"] / span if span else None, "count": row["count"]}))
        if row["bad"]:
            self.say(f"{row['bad']} statistics files could not be parsed")


class Monitor:
    """A running report over a folder of statistics files. totals is given the total row of each batch, statuses the table of
    statuses at most every status_interval seconds, bad each shard whose file cannot be parsed (once, also over a restart from
    the checkpoint it may say it again), say the lines of Lines. What an interval has held back is given in the end. stop() is a
    message: the thread that takes it reads all files that are there once more, flushes, and ends the query."""

    def __init__(self, spark: SparkSession, folder: str, checkpoint: str, totals: Callable[[list[Row]], None], statuses: Callable[[list[Row]], None], bad: Callable[[list[str]], None] = lambda shards: None, say: Callable[[str], None] | None = None, done: DataFrame | None = None,
                 interval: str = "5 seconds", status_interval: float = 60, most: int = 100, clock: Callable[[], float] = time.monotonic):
        self.spark, self.messages, self.told, self.failure = spark, queue.Queue(), set(), None
        self.outputs = (Throttle(totals, 0, clock), Throttle(statuses, status_interval, clock))
        self.outputs[0].last = float("-inf")

        def batch(tally: DataFrame, number: int) -> None:
            held = tally.persist()
            self.outputs[0](totals_in(held).collect())  # one row
            self.outputs[1](statuses_in(held, most).collect())  # `most` rows
            new = [r.name for r in held.where("kind = 'bad'").select("name").orderBy("name").limit(1_000).collect() if r.name not in self.told]
            if new:
                self.told.update(new)
                bad(new)
            held.unpersist()

        stats = fresh(stream_stats(spark, folder), done)
        ok = F.col(CORRUPT).isNull() & F.col("count").isNotNull()
        seen = stats.observe("batch", *[F.coalesce(F.sum(F.when(ok, F.col(c))), F.lit(0)).alias(c) for c in COUNTS], F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"), F.count_if(~ok).alias("bad"))
        self.query = folded(seen).writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(batch).trigger(processingTime=interval).start()
        self.lines = Lines(say, str(self.query.id)) if say else None
        if self.lines:
            spark.streams.addListener(self.lines)
        self.thread = threading.Thread(target=self._wait, daemon=True)
        self.thread.start()

    def _wait(self) -> None:
        self.messages.get()
        try:
            self.query.processAllAvailable()  # the final scan
        except Exception as e:
            self.failure = e
        for output in self.outputs:
            output.sync()
        self.query.stop()

    def stop(self, seconds: float | None = None) -> None:
        """Send the message and wait for the end; a query that has failed raises here."""
        self.messages.put("stop")
        self.thread.join(seconds)
        if self.lines:
            self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
            time.sleep(0.2)  # listeners of streams are told by a bus of their own
            self.spark.streams.removeListener(self.lines)
        if self.failure:
            raise self.failure
