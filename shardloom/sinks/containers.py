"""Sinks of a materialised dataset: Parquet, tar archives, plain files, record files, nothing.

Every sink writes one container for each shard and a Parquet table of the metadata beside it, and last a statistics file
for each shard, whose existence marks the shard as done. Containers are written under a name of the attempt and renamed,
so a task that is run again leaves one whole container.

Python's writers reach files through Arrow's file systems when pyarrow knows the scheme, and the local path otherwise.
"""

from __future__ import annotations

import functools
import io
import json
import struct
import tarfile
import uuid
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import OUTPUT_FORMATS
from ..functions.scalars import caption_text, shard_name

# --- record files ---------------------------------------------------------------------------------------------------

#: The reversed Castagnoli polynomial, and the constant by which record files mask their checksums.
CASTAGNOLI, MASK = 0x82F63B78, 0xA282EAD8


def crc_table() -> list[int]:
    table = []
    for n in range(256):
        for _ in range(8):
            n = n >> 1 ^ (CASTAGNOLI if n & 1 else 0)
        table.append(n)
    return table


_TABLE = crc_table()
#: Bytes up to which a checksum is made byte by byte; the bytes of a lane beyond.
SHORT, LANE = 256, 512


def _tables() -> np.ndarray:
    """Row k: what a byte does to the register if k more bytes follow it in a word of four."""
    rows = [np.array(_TABLE, np.uint32)]
    for _ in range(3):
        rows.append(rows[0][rows[-1] & 0xFF] ^ rows[-1] >> 8)
    return np.stack(rows)


_WORD = _tables()


def _applied(registers: np.ndarray, maps: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, as a table for each of the four bytes, applied to registers."""
    return maps[0][registers & 0xFF] ^ maps[1][registers >> 8 & 0xFF] ^ maps[2][registers >> 16 & 0xFF] ^ maps[3][registers >> 24]


@functools.lru_cache(64)
def _zeros(doublings: int) -> np.ndarray:
    """What 2^doublings bytes of zeros do to a register, as a linear map."""
    each = np.arange(256, dtype=np.uint32)
    if not doublings:
        start = np.stack([each << 8 * k for k in range(4)])
        return _WORD[0][start & 0xFF] ^ start >> 8
    half = _zeros(doublings - 1)
    return np.stack([_applied(table, half) for table in half])


def _followed(registers: np.ndarray, n: int) -> np.ndarray:
    """Registers after n bytes of zeros."""
    for k in range(n.bit_length()):
        if n >> k & 1:
            registers = _applied(registers, _zeros(k))
    return registers


def crc32c(data: bytes) -> int:
    """The CRC-32C of data. Long data is cut into lanes of LANE bytes, whose registers go on side by side, a word of four bytes
    at a time; then neighbouring lanes are joined, the left one followed by as many zeros as the right one has bytes. Zeros
    before the first byte change nothing in a register of zero, so lanes are filled up from the front."""
    if len(data) <= SHORT:
        c, table = 0xFFFFFFFF, _TABLE
        for b in data:
            c = table[(c ^ b) & 0xFF] ^ c >> 8
        return c ^ 0xFFFFFFFF
    lanes = 1 << (-(-len(data) // LANE) - 1).bit_length()
    raw = np.zeros(lanes * LANE, np.uint8)
    raw[-len(data) :] = np.frombuffer(data, np.uint8)
    first = (lanes * LANE - len(data)) // LANE  # lanes of zeros alone
    words = np.ascontiguousarray(raw.view("<u4").reshape(lanes, -1)[first:].T)
    c = np.zeros(lanes - first, np.uint32)
    for word in words:
        x = c ^ word
        c = _WORD[3][x & 0xFF] ^ _WORD[2][x >> 8 & 0xFF] ^ _WORD[1][x >> 16 & 0xFF] ^ _WORD[0][x >> 24]
    c = np.concatenate([np.zeros(first, np.uint32), c])
    step = LANE.bit_length() - 1
    while len(c) > 1:
        c = _applied(c[::2], _zeros(step)) ^ c[1::2]
        step += 1
    start = _followed(np.array([0xFFFFFFFF], np.uint32), len(data))
    return int(c[0] ^ start[0]) ^ 0xFFFFFFFF


def masked(data: bytes) -> int:
    c = crc32c(data)
    return ((c >> 15 | c << 17) + MASK) & 0xFFFFFFFF


def framed(record: bytes) -> bytes:
    """A record with its length and both checksums."""
    size = struct.pack("<Q", len(record))
    return size + struct.pack("<I", masked(size)) + record + struct.pack("<I", masked(record))


def varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def field(number: int, data: bytes) -> bytes:
    """A length-delimited field."""
    return varint(number << 3 | 2) + varint(len(data)) + data


def feature(value) -> bytes:
    """A value as one feature: lists by the kind of their first element, whole numbers (and bools) as int64, floats as
    float, the rest as bytes; null is the empty string, and an empty list an empty list of bytes."""
    values = list(value) if isinstance(value, (list, tuple)) else [value]
    if values and isinstance(values[0], int):
        return field(3, field(1, b"".join(varint(int(v)) for v in values)))
    if values and isinstance(values[0], float):
        return field(2, field(1, struct.pack(f"<{len(values)}f", *values)))
    raw = lambda v: b"" if v is None else v if isinstance(v, (bytes, bytearray)) else str(v).encode()
    return field(1, b"".join(field(1, bytes(raw(v))) for v in values))


def example(features: dict) -> bytes:
    entries = b"".join(field(1, field(1, k.encode()) + field(2, feature(v))) for k, v in features.items())
    return field(1, entries)


# --- containers -----------------------------------------------------------------------------------------------------


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def meta_bytes(meta: dict) -> bytes:
    """JSON with four blanks of indent, ASCII only, keys in order; what JSON lacks becomes text."""
    return json.dumps(meta, indent=4, default=str).encode()


class TarShard:
    suffix = ".tar"

    def __init__(self, fs, path, payload, captions):
        self.out, self.payload, self.captions = fs.open_output_stream(path), payload, captions
        self.tar = tarfile.open(fileobj=self.out, mode="w|")

    def add(self, name: str, data: bytes) -> None:
        info = tarfile.TarInfo(name)
        info.size, info.mode = len(data), 0o644
        self.tar.addfile(info, io.BytesIO(data))

    def write(self, key: str, body: bytes, caption: str, meta: dict) -> None:
        self.add(f"{key}.{self.payload}", body)
        if self.captions:
            self.add(f"{key}.txt", caption.encode())
        self.add(f"{key}.json", meta_bytes(meta))

    def close(self) -> None:
        self.tar.close()
        self.out.close()


class FolderShard:
    suffix = ""

    def __init__(self, fs, path, payload, captions):
        self.fs, self.path, self.payload, self.captions = fs, path, payload, captions
        fs.create_dir(path, recursive=True)

    def write(self, key: str, body: bytes, caption: str, meta: dict) -> None:
        members = {self.payload: body} | ({"txt": caption.encode()} if self.captions else {}) | {"json": meta_bytes(meta)}
        for ending, data in members.items():
            with self.fs.open_output_stream(f"{self.path}/{key}.{ending}") as f:
                f.write(data)

    def close(self) -> None:
        pass


class RecordShard:
    suffix = ".tfrecord"

    def __init__(self, fs, path, payload, captions):
        self.out, self.payload, self.captions = fs.open_output_stream(path), payload, captions

    def write(self, key: str, body: bytes, caption: str, meta: dict) -> None:
        features = {"key": key, self.payload: body} | ({"txt": caption} if self.captions else {}) | {k: v for k, v in meta.items() if k != "key"}
        self.out.write(framed(example(features)))

    def close(self) -> None:
        self.out.close()


SHARDS: dict[str, Callable] = {"webdataset": TarShard, "files": FolderShard, "tfrecord": RecordShard}


def by_shard(df: DataFrame, name: str) -> DataFrame:
    """Each shard whole and in order of its keys within one task; a shard has a bounded number of rows."""
    return df.withColumn("_shard", F.col(name)).repartition("_shard").sortWithinPartitions("_shard", "key")


def write_containers(df: DataFrame, folder: str, output_format: str, payload: str, captions: bool, shard_digits: int) -> DataFrame:
    """Write containers of the rows with a payload; a row (shard, path, n) for each. df: shard_id, key, payload and
    metadata. Evaluating the result writes."""
    make, meta_columns = SHARDS[output_format], [c for c in df.columns if c not in ("shard_id", payload)]
    rows = by_shard(df.where(F.col(payload).isNotNull()).withColumn("_name", shard_name(F.col("shard_id"), shard_digits)).withColumn("_caption", caption_text(F.col("caption")) if captions and "caption" in df.columns else F.lit("")), "_name")

    def work(batches):
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        attempt = f"_attempt-{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex}"
        fs.create_dir(f"{root}/_staging", recursive=True)
        now, shard, n, done = None, None, 0, []

        def finish():
            shard.close()
            target = f"{root}/{now}{make.suffix}"
            if fs.get_file_info(target).type == pafs.FileType.Directory:
                fs.delete_dir(target)
            fs.move(f"{root}/_staging/{attempt}-{now}", target)
            done.append((now, target, n))

        for batch in batches:
            for row in batch.to_pylist():
                if row["_name"] != now:
                    if shard:
                        finish()
                    now, n = row["_name"], 0
                    shard = make(fs, f"{root}/_staging/{attempt}-{now}", payload, captions)
                shard.write(row["key"], row[payload], row["_caption"], {c: row[c] for c in meta_columns})
                n += 1
        if shard:
            finish()
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.string()), pa.array([d[2] for d in done], pa.int64())], names=["shard", "path", "n"])

    return rows.mapInArrow(work, "shard string, path string, n long")


def write_parquet(df: DataFrame, folder: str, shard_digits: int) -> None:
    """One folder shard=NNNNN for each shard, failed rows with a null payload. A shard that is written again (its job died
    before its statistics) takes the place of what was there; other shards stay."""
    rows = by_shard(df.withColumn("shard", shard_name(F.col("shard_id"), shard_digits)), "shard").drop("_shard", "shard_id")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(folder)


def write_sidecar(df: DataFrame, folder: str, payload: str, shard_digits: int) -> None:
    """The metadata of all rows, those that failed too."""
    write_parquet(df.drop(payload), f"{folder}/_metadata_table", shard_digits)


def write_stats(stats: DataFrame, folder: str, shard_digits: int) -> int:
    """A NAME_stats.json for each shard, written after its data; returns their number."""
    said = stats.withColumn("_name", shard_name(F.col("shard_id"), shard_digits)).withColumn("_json", F.to_json(F.struct(*[c for c in stats.columns if c != "shard_id"])))

    def work(batches):
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        for batch in batches:
            for row in batch.to_pylist():
                staged = f"{root}/_{row['_name']}-{uuid.uuid4().hex}"
                with fs.open_output_stream(staged) as f:
                    f.write(row["_json"].encode())
                fs.move(staged, f"{root}/{row['_name']}_stats.json")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    return said.select("_name", "_json").mapInArrow(work, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_dataset(df: DataFrame, folder: str, output_format: str, payload: str, captions: bool = False, shard_digits: int = 5) -> None:
    """Write df (shard_id, key, metadata, payload) in one of OUTPUT_FORMATS. df should be materialised: it is read for
    the containers and again for the sidecar."""
    if output_format not in OUTPUT_FORMATS:
        raise ValueError(f"Invalid output format {output_format}")
    if output_format == "dummy":
        df.write.format("noop").mode("overwrite").save()
    elif output_format == "parquet":
        write_parquet(df, f"{folder}/data", shard_digits)
    else:
        write_containers(df, folder, output_format, payload, captions, shard_digits).agg(F.sum("n")).collect()
        write_sidecar(df, folder, payload, shard_digits)


def members(df: DataFrame, payload: str, captions: Sequence[str] | bool = True) -> DataFrame:
    """What a tar archive or a folder of each shard holds, told relationally: shard_id, member."""
    endings = [payload, *(["txt"] if captions else []), "json"]
    return df.where(F.col(payload).isNotNull()).select("shard_id", F.explode(F.array(*[F.concat("key", F.lit(f".{e}")) for e in endings])).alias("member"))
