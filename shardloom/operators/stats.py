"""Statistics of shards: counts, histograms, speed, running totals and the most common statuses."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .classify import NOT_FETCHED, NOT_RESIZED, SUCCESS

STATS_SCHEMA = "count bigint, successes bigint, failed_to_download bigint, failed_to_resize bigint, duration double, start_time double, end_time double, status_dict map<string,bigint>"


def counted(condition: Column) -> Column:
    return F.count_if(condition).cast("long")


def shard_stats(samples: DataFrame, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """samples (shard_id, status, error_message, ...) -> a row for each shard with STATS_SCHEMA. Counts are summed for
    each shard and status first, so a shard's histogram is never larger than its distinct statuses."""
    said = F.when(F.col("status") == SUCCESS, F.lit(SUCCESS)).otherwise(F.coalesce("error_message", "status"))
    start, end = F.col("start_time") if start is None else start, F.col("end_time") if end is None else end
    by_status = samples.groupBy("shard_id", said.alias("said")).agg(
        F.count(F.lit(1)).alias("n"), counted(F.col("status") == SUCCESS).alias("ok"), counted(F.col("status") == NOT_FETCHED).alias("nf"), counted(F.col("status") == NOT_RESIZED).alias("nr"), F.min(start).alias("s"), F.max(end).alias("e")
    )
    return by_status.groupBy("shard_id").agg(
        F.sum("n").alias("count"), F.sum("ok").alias("successes"), F.sum("nf").alias("failed_to_download"), F.sum("nr").alias("failed_to_resize"),
        (F.max("e") - F.min("s")).alias("duration"), F.min("s").alias("start_time"), F.max("e").alias("end_time"), F.map_from_entries(F.collect_list(F.struct("said", "n"))).alias("status_dict"),
    )


def histogram(samples: DataFrame) -> DataFrame:
    """shard_id, status, count."""
    said = F.when(F.col("status") == SUCCESS, F.lit(SUCCESS)).otherwise(F.coalesce("error_message", "status"))
    return samples.groupBy("shard_id", said.alias("status")).agg(F.count(F.lit(1)).alias("count"))


def summed(stats: DataFrame) -> DataFrame:
    """One row: totals, first start, last end."""
    return stats.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("count", "successes", "failed_to_download", "failed_to_resize")], F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"))


def with_ratios(stats: DataFrame) -> DataFrame:
    """stats with duration, samples a second and shares; null where they would divide by zero."""
    span = F.col("end_time") - F.col("start_time")
    share = lambda c: F.try_divide(F.col(c).cast("double"), F.col("count"))
    return stats.withColumns({"duration": span, "img_per_sec": F.try_divide(F.col("count").cast("double"), span), "success": share("successes"), "share_failed_to_download": share("failed_to_download"), "share_failed_to_resize": share("failed_to_resize")})


def speed_report(stats: DataFrame) -> DataFrame:
    """A `worker` row for each shard and one `total` row."""
    names = ["count", "successes", "failed_to_download", "failed_to_resize", "start_time", "end_time"]
    per = stats.select(F.lit("worker").alias("prefix"), F.col("shard_id"), *names)
    total = summed(stats).select(F.lit("total").alias("prefix"), F.lit(None).cast("long").alias("shard_id"), *names)
    return with_ratios(per.unionByName(total))


def running_totals(stats: DataFrame, span: float = 600.0) -> DataFrame:
    """Totals over the shards finished so far, a row for each shard. Spans of `span` seconds are summed first; only a row
    for each span is ordered in one place, and shards are ordered within their span."""
    counts = ("count", "successes", "failed_to_download", "failed_to_resize")
    rows = stats.withColumn("_span", F.coalesce(F.floor(F.col("end_time") / span), F.lit(-(2**62))))
    before = Window.orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    spans = rows.groupBy("_span").agg(*[F.sum(c).alias(f"_{c}") for c in counts], F.min("start_time").alias("_first"))
    spans = spans.select("_span", *[F.coalesce(F.sum(f"_{c}").over(before), F.lit(0)).alias(f"_{c}") for c in counts], F.min("_first").over(before).alias("_first"))
    within = Window.partitionBy("_span").orderBy("end_time", "shard_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = [(F.sum(c).over(within) + F.col(f"_{c}")).alias(f"total_{c}") for c in counts]
    return rows.join(spans, "_span").select("shard_id", "end_time", *totals, F.least(F.min("start_time").over(within), F.col("_first")).alias("first_start"))


def merged_status(stats: DataFrame) -> DataFrame:
    """Histograms of all shards summed by status: status, count. Exact, so no cap is needed."""
    return stats.select(F.explode("status_dict").alias("status", "n")).groupBy("status").agg(F.sum("n").alias("count"))


def status_table(counts: DataFrame, most: int = 100) -> DataFrame:
    """status, frequency, count of the most common statuses, ties by name. The share is of all statuses."""
    total = counts.agg(F.sum("count").alias("_total"))  # one row
    return counts.crossJoin(F.broadcast(total)).orderBy(F.desc("count"), "status").limit(most).select("status", (F.col("count") / F.col("_total")).alias("frequency"), "count")


def capped(counts: DataFrame, most: int) -> DataFrame:
    """The larger half of a counter that has reached its size: the most/2 highest counts, ties by name."""
    return counts.orderBy(F.desc("count"), "status").limit(most // 2)


def shrunk(held: Counter, most: int) -> int:
    """Bring a counter down to `most` entries: all lose what the next largest one has, and those with nothing left go.
    Returns what each has lost."""
    if len(held) <= most:
        return 0
    lost = sorted(held.values(), reverse=True)[most]
    for name in [n for n, v in held.items() if v <= lost]:
        del held[name]
    for name in held:
        held[name] -= lost
    return lost


def heavy_hitters(rows: DataFrame, most: int, weight: str | None = None) -> DataFrame:
    """status, count, most: statuses of rows by counters of bounded size. Each task holds at most 2 * `most` counters of its
    own rows and gives on `most` of them, so neither memory nor the shuffle grows with distinct statuses. The true count
    lies between count and most, which differ by no more than all rows / (`most` + 1), and every status with more rows than
    that is there. weight: a column of whole counts, else a row counts one. Null is no status."""
    rows = rows.select(F.col("status").cast("string").alias("status"), (F.lit(1) if weight is None else F.col(weight)).cast("long").alias("n")).where("status is not null and n > 0")

    def work(batches):
        held, lost = Counter(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 10_000):
                own = pa.TableGroupBy(pa.Table.from_batches([batch.slice(at, 10_000)]), "status").aggregate([("n", "sum")])
                for name, n in zip(own["status"].to_pylist(), own["n_sum"].to_pylist(), strict=True):
                    held[name] += n
                    if len(held) > 2 * most:
                        lost += shrunk(held, most)
        lost += shrunk(held, most)
        yield pa.RecordBatch.from_arrays([pa.array([*held, None], pa.string()), pa.array([*held.values(), lost], pa.int64())], names=["status", "n"])

    told = rows.mapInArrow(work, "status string, n long").groupBy("status").agg(F.sum("n").alias("count"))
    lost = told.where("status is null").select(F.col("count").alias("_lost"))  # one row: what all tasks' counters have lost
    return told.where("status is not null").join(F.broadcast(lost)).select("status", "count", (F.col("count") + F.col("_lost")).alias("most"))


def failed_shards(stats: DataFrame, expected: DataFrame) -> DataFrame:
    """Shards that were planned and have no stats."""
    return expected.select("shard_id").distinct().join(stats.select("shard_id"), "shard_id", "left_anti")
