"""Materialised datasets read back: what stands in tar archives, record files, folders of files and Parquet shards."""

from __future__ import annotations

import io
import struct
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.containers import masked

KINDS = {1: "bytes", 2: "float", 3: "int64"}


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """shard, container, table: the files that the statistics of finished shards name; no rows where files were renamed."""
    jvm, kind = spark.sparkContext._jvm, "files struct<container: string, table: string>"
    at = jvm.org.apache.hadoop.fs.Path(f"{folder}/[0-9]*_stats.json")
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at):
        return spark.createDataFrame([], "shard string, container string, table string")
    said = spark.read.schema(kind).json(at.toString())
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)_", 1)
    place = lambda c: F.concat(F.lit(f"{folder}/"), F.col(f"files.{c}"))
    return said.where("files is not null").select(name.alias("shard"), place("container").alias("container"), place("table").alias("table"))


def _named(spark: SparkSession, folder: str, which: str) -> list[str]:
    """Paths of the manifest, one for each shard, as a scan needs them on the driver."""
    return [r[0] for r in manifest(spark, folder).where(F.col(which).isNotNull()).select(which).orderBy(which).collect()]


def _binary(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    if named := _named(spark, folder, "container"):
        return spark.read.format("binaryFile").load(named)
    return spark.read.format("binaryFile").options(pathGlobFilter=glob, recursiveFileLookup=True).load(folder)


def tar_members(spark: SparkSession, folder: str) -> DataFrame:
    """shard, member, body: a row for each file of each archive. An archive is one shard, which is bounded."""

    def work(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with tarfile.open(fileobj=io.BytesIO(content)) as t:
                    found = [(m.name, t.extractfile(m).read()) for m in t]
                shard = path.rsplit("/", 1)[-1].removesuffix(".tar")
                yield pa.RecordBatch.from_arrays([pa.array([shard] * len(found), pa.string()), pa.array([n for n, _ in found], pa.string()), pa.array([b for _, b in found], pa.binary())], names=["shard", "member", "body"])

    return _binary(spark, folder, "*.tar").select("path", "content").mapInArrow(work, "shard string, member string, body binary")


def files(spark: SparkSession, folder: str) -> DataFrame:
    """shard, member, body of a dataset of plain files; what begins with an underscore is not part of it."""
    parts = F.split("path", "/")
    found = [f"{p}/*" for p in _named(spark, folder, "container")] or f"{folder}/[0-9]*/*"
    rows = spark.read.format("binaryFile").load(found).select(F.element_at(parts, -2).alias("shard"), F.element_at(parts, -1).alias("member"), F.col("content").alias("body"))
    return rows


def frames(data: bytes) -> Iterator[bytes]:
    """Records of a record file; a checksum that does not hold raises."""
    at = 0
    while at < len(data):
        (size,) = struct.unpack_from("<Q", data, at)
        record = data[at + 12 : at + 12 + size]
        sums = struct.unpack_from("<I", data, at + 8) + struct.unpack_from("<I", data, at + 12 + size)
        if sums != (masked(data[at : at + 8]), masked(record)):
            raise ValueError("a record's checksum does not hold")
        yield record
        at += 16 + size


def fields(data: bytes) -> Iterator[tuple[int, bytes]]:
    """The length-delimited fields of a message."""
    at = 0
    while at < len(data):
        tag, at = _number(data, at)
        size, at = _number(data, at)
        yield tag >> 3, data[at : at + size]
        at += size


def _number(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        n, at, shift = n | (b & 0x7F) << shift, at + 1, shift + 7
        if b < 0x80:
            return n, at


def features(record: bytes) -> Iterator[tuple[str, str, list]]:
    """Name, kind and values of an example's features."""
    for _, all_features in fields(record):
        for _, entry in fields(all_features):
            parts = dict(fields(entry))
            kind, body = next(fields(parts[2]))
            if kind == 1:
                values = [v for _, v in fields(body)]
            else:
                packed = b"".join(v for _, v in fields(body))
                if kind == 2:
                    values = [*struct.unpack(f"<{len(packed) // 4}f", packed)]
                else:
                    values, at = [], 0
                    while at < len(packed):
                        n, at = _number(packed, at)
                        values.append(n - (1 << 64) if n >= 1 << 63 else n)
            yield parts[1].decode(), KINDS[kind], values


def record_features(spark: SparkSession, folder: str) -> DataFrame:
    """shard, record, name, kind, bytes, floats, ints: a row for each feature of each record."""
    schema = pa.schema([("shard", pa.string()), ("record", pa.int64()), ("name", pa.string()), ("kind", pa.string()), ("bytes", pa.list_(pa.binary())), ("floats", pa.list_(pa.float64())), ("ints", pa.list_(pa.int64()))])

    def work(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = path.rsplit("/", 1)[-1].removesuffix(".tfrecord")
                rows = [
                    {"shard": shard, "record": i, "name": name, "kind": kind, "bytes": values if kind == "bytes" else None, "floats": values if kind == "float" else None, "ints": values if kind == "int64" else None}
                    for i, record in enumerate(frames(content)) for name, kind, values in features(record)
                ]
                yield pa.RecordBatch.from_pylist(rows, schema)

    return _binary(spark, folder, "*.tfrecord").select("path", "content").mapInArrow(work, "shard string, record long, name string, kind string, bytes array<binary>, floats array<double>, ints array<long>")


def parquet_shards(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of a Parquet dataset, with shard as text."""
    if named := _named(spark, folder, "table"):
        return spark.read.parquet(*named).withColumn("shard", F.regexp_extract(F.col("_metadata.file_path"), r"/(\d+)-[0-9a-f]+/table$", 1))
    return spark.read.option("basePath", f"{folder}/data").schema(_with_shard(spark, folder)).parquet(f"{folder}/data")


def _with_shard(spark: SparkSession, folder: str):
    from pyspark.sql.types import StringType, StructField, StructType

    found = spark.read.parquet(f"{folder}/data").schema
    return StructType([StructField("shard", StringType()) if f.name == "shard" else f for f in found.fields])
