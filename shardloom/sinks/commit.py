"""Shards that are fetched, written and committed one by one, in the task that holds their rows.

A shard's container, metadata and statistics are written under names of the attempt in the run's staging folder, row by
row as bodies come, and put into place when its last row is there, the statistics last: they mark the shard as done. So a
job that is killed keeps every shard that it finished, and no body is held longer than its turn. A shard that cannot be
written fails alone: what it staged is deleted, its error goes into the ledger, and the task goes on with the next.

Where a store cannot rename (a move copies there), a shard's files stay where the attempt has written them, under _files,
and the statistics name them: this manifest, one small file for each shard, is what readers trust (sources.containers), and
what no manifest names was never finished.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import fetch
from ..operators.classify import AREA_TOO_LARGE, ASPECT_TOO_LARGE, HASH_MISMATCH, NOT_FETCHED, NOT_RESIZED, SUCCESS, TOO_SMALL
from .containers import SHARDS, filesystem

LEDGER = "shard_id long, shard string, count long, successes long, failed_to_download long, failed_to_resize long, error string"
#: Rows and bytes of a row group of metadata, or of Parquet shards.
GROUP_ROWS, GROUP_BYTES = 1_000, 16_000_000
STATS = ("count", "successes", "failed_to_download", "failed_to_resize")


@dataclass
class Outcome:
    """What a fetch comes to: hash checks and pictures, by the rules of operators.classify for rows that are at hand."""

    payload: str
    verify: tuple[str, str] | None = None
    compute: str | None = None
    resizer: Callable | None = None
    boxes: str | None = None

    @property
    def columns(self) -> list[pa.Field]:
        sizes = ("width", "height", "original_width", "original_height") if self.resizer else ()
        return [*([pa.field(self.compute, pa.string())] if self.compute else []), *(pa.field(c, pa.int64()) for c in sizes)]

    def __call__(self, row: dict, body: bytes | None, error: str | None) -> tuple[bytes | None, dict]:
        digest = lambda kind: hashlib.new(kind, body).hexdigest()
        if body is not None and self.verify:
            column, kind = self.verify
            if digest(kind) != (row[column] or "").lower():
                body, error = None, HASH_MISMATCH
        more: dict = {}
        if self.compute:
            more[self.compute] = None if body is None else digest(self.compute)
        came = body is not None and error is None
        if self.resizer:
            body, *sizes, bad = self.resizer(body, row[self.boxes] if self.boxes else None)
            more |= zip(("width", "height", "original_width", "original_height"), sizes, strict=True)
            error = error if error is not None else bad
        if error in (TOO_SMALL, AREA_TOO_LARGE, ASPECT_TOO_LARGE) or (came and error is not None):
            status = NOT_RESIZED
        else:
            status = NOT_FETCHED if error is not None or body is None else SUCCESS
        return body, more | {"status": status, "error_message": error}


@dataclass
class Target:
    """Where and how shards are written. schema: the metadata of a row, in order."""

    folder: str
    run: str
    output_format: str
    payload: str
    captions: bool
    shard_digits: int
    schema: pa.Schema
    manifest: bool = False

    def name(self, shard_id: int) -> str:
        return f"{shard_id:0{self.shard_digits}d}"

    @property
    def tables(self) -> str:
        """The folder of the shards' metadata; nothing else is kept of a dummy run."""
        return {"parquet": "data", "dummy": f"_runs/{self.run}"}.get(self.output_format, "_metadata_table")


class Table:
    """A Parquet file that grows by rows and holds few of them in memory."""

    def __init__(self, fs: pafs.FileSystem, path: str, schema: pa.Schema):
        self.out = fs.open_output_stream(path)
        self.writer, self.schema, self.rows, self.size = pq.ParquetWriter(self.out, schema, compression="zstd"), schema, [], 0

    def add(self, row: dict, size: int) -> None:
        self.rows.append(row)
        self.size += size
        if len(self.rows) >= GROUP_ROWS or self.size >= GROUP_BYTES:
            self.flush()

    def flush(self) -> None:
        if self.rows:
            self.writer.write_table(pa.Table.from_pylist(self.rows, self.schema))
        self.rows, self.size = [], 0

    def close(self) -> None:
        self.flush()
        self.writer.close()
        self.out.close()


@dataclass
class Shard:
    """A shard on its way: add() rows, then commit()."""

    target: Target
    shard_id: int
    fs: pafs.FileSystem
    root: str
    started: float = field(default_factory=time.time)
    ended: float | None = None
    said: Counter = field(default_factory=Counter)
    counts: Counter = field(default_factory=Counter)

    def __post_init__(self):
        t = self.target
        self.name = t.name(self.shard_id)
        self.at = f"{'_files' if t.manifest else '_staging'}/{t.run}/{self.name}-{uuid.uuid4().hex}"
        self.staged = f"{self.root}/{self.at}"
        self.fs.create_dir(self.staged, recursive=True)
        kept = t.schema.append(pa.field(t.payload, pa.binary())) if t.output_format == "parquet" else t.schema
        self.table = Table(self.fs, f"{self.staged}/table", kept)
        self.container = None
        if make := SHARDS.get(t.output_format):
            self.container = make(self.fs, f"{self.staged}/{self.name}{make.suffix}", t.payload, t.captions)

    def add(self, row: dict, body: bytes | None, end: float) -> None:
        t = self.target
        if self.container and body is not None:
            caption = row.get("caption") if t.captions else None
            self.container.write(row["key"], body, "" if caption is None else str(caption), row)
        whole = t.output_format == "parquet"
        self.table.add(row | {t.payload: body} if whole else row, len(body or b"") if whole else 0)
        status = row["status"]
        self.said[SUCCESS if status == SUCCESS else row["error_message"] or status] += 1
        self.counts.update({"count": 1, {SUCCESS: "successes", NOT_FETCHED: "failed_to_download", NOT_RESIZED: "failed_to_resize"}[status]: 1})
        self.ended = end if self.ended is None else max(end, self.ended)

    def put(self, staged: str, target: str) -> None:
        """Move a file or folder into its place, whatever stands there."""
        self.fs.create_dir(target.rsplit("/", 1)[0], recursive=True)
        if self.fs.get_file_info(target).type == pafs.FileType.Directory:
            self.fs.delete_dir(target)
        self.fs.move(f"{self.staged}/{staged}", target)

    def commit(self) -> dict:
        """Put everything into place, statistics last; the ledger's row."""
        self.table.close()
        own = None
        if self.container:
            self.container.close()
            own = f"{self.name}{self.container.suffix}"
        files = {}
        if self.target.manifest:
            files = {"files": {"container": own and f"{self.at}/{own}", "table": f"{self.at}/table"}}
        else:
            if own:
                self.put(own, f"{self.root}/{own}")
            self.put("table", f"{self.root}/{self.target.tables}/shard={self.name}/part-0.parquet")
        told = {c: self.counts[c] for c in STATS}
        end = self.started if self.ended is None else self.ended
        stats = told | {"duration": end - self.started, "start_time": self.started, "end_time": end, "status_dict": dict(self.said)} | files
        with self.fs.open_output_stream(f"{self.staged}/stats") as f:
            f.write(json.dumps(stats).encode())
        self.put("stats", f"{self.root}/{self.name}_stats.json")
        if not self.target.manifest:
            self.fs.delete_dir(self.staged)
        return {"shard_id": self.shard_id, "shard": self.name, **told, "error": None}

    def abort(self, error: Exception) -> dict:
        for close in (self.table.close, *([self.container.close] if self.container else [])):
            try:
                close()
            except Exception:  # what is thrown away need not be whole
                continue
        try:
            self.fs.delete_dir(self.staged)
        except OSError:
            pass  # the run's staging folder goes in the end
        return failed(self.target, self.shard_id, error)


def failed(target: Target, shard_id: int, error: Exception) -> dict:
    return {"shard_id": shard_id, "shard": target.name(shard_id), **{c: 0 for c in STATS}, "error": str(error) or type(error).__name__}


def commit_shards(rows: DataFrame, target: Target, outcome: Outcome, fetcher: Callable | None = None, threads: int = 256, retries: int = 0, most_bytes: int = fetch.BYTES_IN_FLIGHT) -> DataFrame:
    """Write rows (shard_id, key, url, metadata; each shard whole and in order within a task) and commit shard by shard; a
    LEDGER row for each. Evaluating the result writes. Without a fetcher the rows hold their payload and error_message.
    Shards whose statistics stand already, as when a task is run again, are passed over."""
    held = [target.payload, "error_message"]

    def work(batches):
        fs, root = filesystem(target.folder)
        bad: set[int] = set()
        budget = fetch.Budget(most_bytes)

        def items() -> Iterator[tuple[dict, str]]:
            now, there = None, False
            for batch in batches:
                for at in range(0, batch.num_rows, 64):
                    for row in batch.slice(at, 64).to_pylist():
                        if row["shard_id"] != now:
                            now = row["shard_id"]
                            there = fs.get_file_info(f"{root}/{target.name(now)}_stats.json").type == pafs.FileType.File
                        if not there and now not in bad:
                            yield row, row["url"]

        def results():
            if fetcher is None:
                for row, _ in items():
                    body, error = (row.pop(c) for c in held)
                    yield row, body, error, time.time()
            else:
                for row, reply, end in fetch.replies(items(), fetcher, threads, retries, budget):
                    yield row, reply.body, None if reply.body is not None else reply.error or "no reply", end

        shard, now = None, None
        for row, body, error, end in results():
            if row["shard_id"] != now:
                if shard:
                    yield told(finish(shard))
                now, shard = row["shard_id"], None
                try:
                    shard = Shard(target, now, fs, root)
                except Exception as e:
                    bad.add(now)
                    yield told(failed(target, now, e))
            if shard is None:
                continue
            try:
                body, more = outcome(row, body, error)
                whole = row | more
                shard.add({c: whole[c] for c in target.schema.names}, body, end)
            except Exception as e:
                bad.add(now)
                yield told(shard.abort(e))
                shard = None
        if shard:
            yield told(finish(shard))

    def finish(shard: Shard) -> dict:
        try:
            return shard.commit()
        except Exception as e:
            return shard.abort(e)

    names = [c.split(" ")[0] for c in LEDGER.split(", ")]
    kinds = [pa.string() if c.endswith("string") else pa.int64() for c in LEDGER.split(", ")]

    def told(row: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([row[c]], k) for c, k in zip(names, kinds, strict=True)], names=names)

    return rows.mapInArrow(work, LEDGER)


def dealt(rows: DataFrame, n: int) -> DataFrame:
    """Each shard whole and in order of its keys in one of n tasks; neighbouring shards go to different ones."""
    return rows.repartitionById(n, F.pmod(F.col("shard_id"), F.lit(n)).cast("int")).sortWithinPartitions("shard_id", "key")
