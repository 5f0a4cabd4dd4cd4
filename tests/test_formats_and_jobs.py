"""Sources in all formats, sinks read back by independent readers, jobs with a loopback server, the monitor."""

import gzip
import http.server
import json
import struct
import tarfile
import threading
from pathlib import Path

import pandas as pd
import pytest

from shardloom.config import INPUT_FORMATS
from shardloom.operators import fetch, fleet, sharding, stats
from shardloom.plans.materialize import download
from shardloom.sinks import containers
from shardloom.sources import tables
from shardloom.streaming import monitor

ROWS = [("http://x/a", "plain", 1), ("http://x/b,c", "two\nlines", 2), ("http://x/d", "", 3), ("http://x/é", "NA", 4), ("http://x/f", "ünï \"q\"", 5)]


def put(path: Path, text: str) -> None:
    path.write_bytes(gzip.compress(text.encode()) if path.name.endswith(".gz") else text.encode())


def table_file(folder: Path, kind: str, rows=ROWS, name="t") -> None:
    path, df = folder / f"{name}.{kind}", pd.DataFrame(rows, columns=["link", "alt", "n"])
    plain = kind.removesuffix(".gz")
    if plain == "parquet":
        df.to_parquet(path)
    elif plain == "txt":
        put(path, "\n".join(r[0] for r in rows) + "\n\n")
    elif plain in ("csv", "tsv"):
        put(path, df.to_csv(index=False, sep="," if plain == "csv" else "\t"))
    elif plain == "json":
        put(path, json.dumps(df.to_dict("records")))
    else:
        put(path, "\n".join(json.dumps(r) for r in df.to_dict("records")))


@pytest.mark.parametrize("kind", INPUT_FORMATS)
def test_formats(spark, tmp_path, kind):
    table_file(tmp_path, kind)
    got = tables.url_table(spark, str(tmp_path), kind, "link", None if kind.startswith("txt") else "alt", [] if kind.startswith("txt") else ["n"])
    out = sharding.with_shards(got, 2)
    rows = sorted(out.collect(), key=lambda r: (r.shard_id, r.idx))
    assert [r.url for r in rows] == [r[0] for r in ROWS]
    assert [(r.shard_id, r.idx) for r in rows] == [(0, 0), (0, 1), (1, 0), (1, 1), (2, 0)]
    if not kind.startswith("txt"):
        assert [(r.caption, r.n) for r in rows] == [r[1:] for r in ROWS]
        assert out.schema["n"].dataType.simpleString() == "bigint"


def test_json_of_columns(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps({"link": {"0": "a", "1": "b"}, "n": {"0": 1, "1": 2}}))
    got = tables.url_table(spark, str(tmp_path), "json", "link", None, ["n"])
    assert sorted((r.url, r.n) for r in got.collect()) == [("a", 1), ("b", 2)]


def test_many_files_in_name_order(spark, tmp_path):
    many = [(f"b{i}", "", i) for i in range(7)]
    table_file(tmp_path, "csv", many, "b")
    table_file(tmp_path, "csv", [("a0", "", 0), ("a1", "", 1), ("a2", "", 2)], "a")
    got = sharding.with_shards(tables.url_table(spark, str(tmp_path), "csv", "link", "alt"), 2, start_shard_id=5)
    rows = {r.url: (r.shard_id, r.idx) for r in got.collect()}
    assert rows["a0"] == (5, 0) and rows["a2"] == (6, 0) and rows["b0"] == (7, 0) and rows["b6"] == (10, 0)
    kept = sharding.with_shards(tables.url_table(spark, str(tmp_path), "csv", "link", "alt"), 2, start_file_id=1)
    assert {r.shard_id for r in kept.collect()} == {2, 3, 4, 5}


def test_listing_fails_early(spark, tmp_path):
    with pytest.raises(ValueError, match="No file found"):
        tables.listing(spark, str(tmp_path), "csv")
    with pytest.raises(ValueError, match="Invalid input format"):
        tables.listing(spark, str(tmp_path), "xml")
    with pytest.raises(ValueError, match="No such input"):
        tables.listing(spark, str(tmp_path / "none"), "csv")


def test_dashboards(spark, tmp_path):
    html = "<p><table class='x'><tr><th>Id</th><th>Address</th><th>State</th></tr><tr><td>1</td><td><a>10.0.0.1:77</a></td><td>ALIVE</td></tr><tr><td>2</td><td>10.0.0.2:77</td><td>DEAD</td></tr></table><table></table>"
    page = spark.createDataFrame([(html,)], "html string")
    assert [r.host for r in tables.alive_workers(tables.worker_table(page)).collect()] == ["10.0.0.1"]
    reply = spark.createDataFrame([(json.dumps({"data": {"summary": [{"ip": "10.0.0.3 (head)", "state": "x"}, {"ip": "10.0.0.4", "state": None}]}}),)], "body string")
    assert [r.host for r in tables.dashboard_nodes(reply).collect()] == ["10.0.0.3"]
    (tmp_path / "h.csv").write_text(",host\n0,a\n1,b\n")
    assert [r.host for r in tables.hosts(spark, str(tmp_path / "h.csv")).collect()] == ["a", "b"]
    state = {"cluster_id": "c", "status": "running", "master_node": "a", "workers": ["b"], "num_workers": 1, "mem_gb": 2, "master_url": "u"}
    for i, status in enumerate(("running", "stopped")):
        (tmp_path / f"c{i}.json").write_text(json.dumps(state | {"status": status}, indent=4))
    assert tables.running_clusters(spark, str(tmp_path / "c*.json")).count() == 1
    (tmp_path / "cfg.json").write_text('{"id": "x", "num_nodes": 2, "mem_gb": 30}')
    assert tables.cluster_config(spark, str(tmp_path / "cfg.json")).first().num_nodes == 2


# --- sinks ----------------------------------------------------------------------------------------------------------


@pytest.fixture
def sample(spark):
    rows = [(i // 3, f"{i:05d}", f"u{i}", None if i == 4 else f"c{i}", "failed_to_download" if i == 5 else "success", "gone" if i == 5 else None, None if i == 5 else bytes([i]) * i) for i in range(7)]
    return spark.createDataFrame(rows, "shard_id long, key string, url string, caption string, status string, error_message string, bin binary")


def test_tar(spark, sample, tmp_path):
    containers.write_dataset(sample, str(tmp_path), "webdataset", "bin", captions=True)
    with tarfile.open(tmp_path / "00001.tar") as t:
        assert t.getnames() == ["00003.bin", "00003.txt", "00003.json", "00004.bin", "00004.txt", "00004.json"]
        assert t.extractfile("00003.bin").read() == b"\x03\x03\x03" and t.extractfile("00004.txt").read() == b""
        assert json.loads(t.extractfile("00003.json").read())["url"] == "u3"
    meta = spark.read.parquet(str(tmp_path / "_metadata_table"))
    assert meta.count() == 7 and meta.where("status <> 'success'").first().error_message == "gone"
    relational = {(r.shard_id, r.member) for r in containers.members(sample, "bin").collect()}
    assert {m for s, m in relational if s == 1} == {"00003.bin", "00003.txt", "00003.json", "00004.bin", "00004.txt", "00004.json"}
    containers.write_dataset(sample, str(tmp_path), "webdataset", "bin", captions=False)  # again over the first
    with tarfile.open(tmp_path / "00001.tar") as t:
        assert "00003.txt" not in t.getnames()


def test_files(sample, tmp_path):
    containers.write_dataset(sample, str(tmp_path), "files", "bin", captions=True)
    assert sorted(p.name for p in (tmp_path / "00001").iterdir()) == ["00003.bin", "00003.json", "00003.txt", "00004.bin", "00004.json", "00004.txt"]
    assert not (tmp_path / "00001" / "00005.bin").exists()


def test_parquet_sink(spark, sample, tmp_path):
    containers.write_dataset(sample, str(tmp_path), "parquet", "bin")
    back = spark.read.parquet(str(tmp_path / "data"))
    assert back.count() == 7 and back.where("bin is null").first().key == "00005"


def test_parquet_shards_replace_themselves(spark, sample, tmp_path):
    containers.write_dataset(sample, str(tmp_path), "parquet", "bin")
    containers.write_dataset(sample.where("shard_id = 1"), str(tmp_path), "parquet", "bin")
    back = spark.read.parquet(str(tmp_path / "data"))
    assert back.count() == 7 and back.select("key").distinct().count() == 7


def test_noop_and_unknown(sample, tmp_path):
    containers.write_dataset(sample, str(tmp_path), "dummy", "bin")
    assert not [*tmp_path.iterdir()]
    with pytest.raises(ValueError):
        containers.write_dataset(sample, str(tmp_path), "zip", "bin")


def parse(data: bytes) -> list[tuple[int, object]]:
    """Fields of a message: number and raw value."""
    out, at = [], 0

    def number():
        nonlocal at
        n = shift = 0
        while True:
            b = data[at]
            at += 1
            n |= (b & 0x7F) << shift
            shift += 7
            if b < 0x80:
                return n

    while at < len(data):
        tag = number()
        size = number()
        out.append((tag >> 3, data[at : at + size]))
        at += size
    return out


def test_records(sample, tmp_path):
    assert containers.crc32c(b"123456789") == 0xE3069283
    containers.write_dataset(sample, str(tmp_path), "tfrecord", "bin", captions=True)
    raw, keys, at = (tmp_path / "00001.tfrecord").read_bytes(), [], 0
    while at < len(raw):
        (size,) = struct.unpack_from("<Q", raw, at)
        assert struct.unpack_from("<I", raw, at + 8)[0] == containers.masked(raw[at : at + 8])
        record = raw[at + 12 : at + 12 + size]
        assert struct.unpack_from("<I", raw, at + 12 + size)[0] == containers.masked(record)
        at += 16 + size
        entries = {dict(parse(e))[1].decode(): dict(parse(e))[2] for _, e in parse(parse(record)[0][1])}
        assert set(entries) == {"key", "bin", "txt", "url", "caption", "status", "error_message"}
        keys.append(parse(parse(entries["key"])[0][1])[0][1])
    assert keys == [b"00003", b"00004"]


def test_feature_kinds():
    kind = lambda v: parse(containers.feature(v))[0][0]
    assert [kind(v) for v in (1, True, 1.5, "a", b"a", None, [1, 2], [0.5], ["a", None], [])] == [3, 3, 2, 1, 1, 1, 3, 2, 1, 1]


# --- jobs -----------------------------------------------------------------------------------------------------------


class Handler(http.server.BaseHTTPRequestHandler):
    seen: dict[str, int] = {}

    def do_GET(self):
        n = self.seen[self.path] = self.seen.get(self.path, 0) + 1
        code = 404 if self.path == "/gone" else 500 if self.path == "/flaky" and n == 1 else 200
        body = b"" if self.path == "/empty" else b"x" * (5000 if self.path == "/big" else 10)
        self.send_response(code)
        self.send_header("Content-Length", str(len(body)))
        if self.path == "/noai":
            self.send_header("X-Robots-Tag", "noai")
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *a):
        pass


@pytest.fixture(scope="module")
def server():
    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def test_http_job(spark, server, tmp_path):
    paths = ["/ok", "/empty", "/gone", "/noai", "/big", "/flaky"]
    (tmp_path / "in.txt").write_text("\n".join(server + p for p in paths))
    done = download(spark, str(tmp_path / "in.txt"), output_folder=str(tmp_path / "out"), number_sample_per_shard=4, output_format="webdataset", retries=1, max_data_size=0.001, thread_count=4, encode_format="bin")
    got = {r.url.removeprefix(server): (r.status, r.error_message) for r in done.collect()}
    assert got["/ok"] == got["/empty"] == got["/flaky"] == ("success", None)
    assert got["/gone"][1] == "HTTP Error 404: Not Found" and got["/noai"][1].startswith("Use of image") and got["/big"][1] == "Image too large"
    said = json.loads((tmp_path / "out" / "00000_stats.json").read_text())
    assert said["count"] == 4 and said["successes"] == 2 and sum(said["status_dict"].values()) == 4
    asked = sum(Handler.seen.values())
    again = download(spark, str(tmp_path / "in.txt"), output_folder=str(tmp_path / "out"), number_sample_per_shard=4, output_format="webdataset", encode_format="bin")
    assert again.count() == 0 and sum(Handler.seen.values()) == asked  # nothing is fetched twice
    (tmp_path / "out" / "00001_stats.json").unlink()  # as after a crash before the statistics
    assert download(spark, str(tmp_path / "in.txt"), output_folder=str(tmp_path / "out"), number_sample_per_shard=4, output_format="webdataset", encode_format="bin").count() == 2
    more = download(spark, str(tmp_path / "in.txt"), output_folder=str(tmp_path / "out"), number_sample_per_shard=4, output_format="webdataset", encode_format="bin", incremental_mode="extend")
    assert {r.key for r in more.collect()} == {"000020", "000021", "000022", "000023", "000030", "000031"}
    fresh = download(spark, str(tmp_path / "in.txt"), output_folder=str(tmp_path / "out"), number_sample_per_shard=4, output_format="files", encode_format="bin", incremental_mode="overwrite")
    assert fresh.count() == 6 and not (tmp_path / "out" / "00000.tar").exists()


def test_lookup_job(spark, tmp_path):
    table_file(tmp_path, "jsonl")
    store = spark.createDataFrame([("http://x/a", "A"), ("http://x/d", "D")], "url string, body string")
    got = download(spark, str(tmp_path / "t.jsonl"), store=store, input_format="jsonl", url_col="link", caption_col="alt", save_additional_columns=["n"], output_folder=str(tmp_path / "o"), output_format="parquet", compute_hash="md5")
    assert got.columns == ["n", "caption", "url", "md5", "key", "status", "error_message"]
    assert {r.url: r.status for r in got.collect()}["http://x/f"] == "failed_to_download" and got.where("status = 'success'").count() == 2


def a_run(spark, tmp_path, fetcher, rows=40, size=4, **more):
    (tmp_path / "in.txt").write_text("\n".join(f"http://x/{i}" for i in range(rows)))
    return download(spark, str(tmp_path / "in.txt"), fetcher, output_folder=str(tmp_path / "out"), number_sample_per_shard=size, encode_format="bin", thread_count=1, **more)


@pytest.mark.parametrize("kind", ["parquet", "webdataset", "files", "tfrecord", "dummy"])
def test_a_job_that_is_killed_keeps_its_finished_shards(spark, tmp_path, kind):
    """A fetcher ends its whole worker in the midst of shard 7, whatever tries again; the next run fetches what no finished
    shard holds, and no row stands twice."""
    asked = tmp_path / "asked"
    asked.mkdir()

    def fetcher(url):
        n = int(url.rsplit("/", 1)[1])
        with open(asked / str(n), "a") as f:
            f.write("x")
        if n == 30 and (tmp_path / "deadly").exists():
            import os

            os._exit(1)
        return fetch.Reply(body=url.encode())

    count = lambda: sum(len(p.read_text()) for p in asked.iterdir())
    (tmp_path / "deadly").touch()
    with pytest.raises(Exception, match="(?s).*"):
        a_run(spark, tmp_path, fetcher, output_format=kind)
    done = {int(p.name.split("_")[0]) for p in (tmp_path / "out").glob("*_stats.json")}
    assert len(done) >= 2 and 7 not in done
    (tmp_path / "deadly").unlink()
    before = count()
    got = a_run(spark, tmp_path, fetcher, output_format=kind)
    assert count() - before == 40 - 4 * len(done) == got.count()
    assert len([*(tmp_path / "out").glob("*_stats.json")]) == 10 and not [*(tmp_path / "out" / "_staging").iterdir()]
    if kind in ("parquet", "webdataset", "files", "tfrecord"):
        rows = spark.read.parquet(str(tmp_path / "out" / ("data" if kind == "parquet" else "_metadata_table")))
        assert rows.count() == rows.select("key").distinct().count() == 40
    for p in (tmp_path / "out").glob("0000[01]_stats.json"):  # as if these had never been written
        p.unlink()
    assert a_run(spark, tmp_path, fetcher, output_format=kind).count() == 8 and count() - before == 48 - 4 * len(done)
    assert a_run(spark, tmp_path, fetcher, output_format=kind).count() == 0


def test_shards_that_fail_are_tried_again(spark, tmp_path):
    """Shards 1 and 2 cannot be put into place, shard 1 only twice."""
    tables = tmp_path / "out" / "_metadata_table"
    tables.mkdir(parents=True)
    for shard in (1, 2):
        (tables / f"shard=0000{shard}").touch()  # a file where the shard's folder should be

    def fetcher(url):
        if url.endswith("/5"):
            tries = len([*tmp_path.glob("try*")])
            (tmp_path / f"try{tries}").touch()
            if tries == 2:
                (tables / "shard=00001").unlink()
        return fetch.Reply(body=b"x")

    got = a_run(spark, tmp_path, fetcher, rows=16, output_format="webdataset", max_shard_retry=3)
    (tables / "shard=00002").unlink()
    assert sorted(r.key for r in got.collect()) == [f"{s:05d}{i:01d}" for s in (0, 1, 3) for i in range(4)]
    (bad,) = spark.read.parquet(str(tmp_path / "out" / "_failed_shards")).collect()
    assert bad.shard_id == 2 and bad.error
    (run,) = (tmp_path / "out" / "_ledger").iterdir()
    passes = spark.read.parquet(str(run)).collect()
    assert sorted((r["pass"], r.shard_id, r.error is None) for r in passes) == [(0, 0, True), (0, 1, False), (0, 2, False), (0, 3, True), (1, 1, False), (1, 2, False), (2, 1, True), (2, 2, False), (3, 2, False)]
    again = a_run(spark, tmp_path, lambda url: fetch.Reply(body=b"y"), rows=16, output_format="webdataset")
    assert again.count() == 4 and spark.read.parquet(str(tmp_path / "out" / "_failed_shards")).count() == 0


@pytest.mark.parametrize("kind", ["parquet", "webdataset", "files", "tfrecord"])
def test_manifests_name_what_is_finished(spark, tmp_path, kind):
    """Without renames: readers see the shards that a manifest names, and neither unfinished files nor replaced ones."""
    from shardloom.sources import containers as made

    fetcher = lambda tag: lambda url: fetch.Reply(body=tag + url.encode())
    assert a_run(spark, tmp_path, fetcher(b"a"), output_format=kind, commit="manifest", rows=12).count() == 12
    (tmp_path / "out" / "00001_stats.json").unlink()
    assert a_run(spark, tmp_path, fetcher(b"b"), output_format=kind, commit="manifest", rows=12).count() == 4
    left = tmp_path / "out" / "_files" / "left" / f"00000-{'0' * 32}"
    left.mkdir(parents=True)
    (left / "table").write_bytes(b"half a table")
    (left / "00000.tar").write_bytes(b"half an archive")
    read = {"parquet": made.parquet_shards, "webdataset": made.tar_members, "files": made.files, "tfrecord": made.record_features}[kind]
    rows = read(spark, str(tmp_path / "out")).collect()
    body = {"parquet": lambda r: r.bin, "webdataset": lambda r: r.body, "files": lambda r: r.body, "tfrecord": lambda r: (r.bytes or [b""])[0] if r.name == "bin" else b"{"}[kind]
    found = {(r.shard, bytes(body(r))) for r in rows if not bytes(body(r)).startswith(b"{")}
    assert found == {(f"0000{i // 4}", (b"b" if i // 4 == 1 else b"a") + f"http://x/{i}".encode()) for i in range(12)}
    assert not [*(tmp_path / "out").glob("*.tar")] and not (tmp_path / "out" / "_metadata_table").exists()


def test_other_runs_keep_what_they_stage(spark, tmp_path):
    import os
    import time

    for name, age in (("young", 0), ("old", 30 * 24 * 3600)):
        (tmp_path / "out" / "_staging" / name).mkdir(parents=True)
        os.utime(tmp_path / "out" / "_staging" / name, (time.time() - age,) * 2)
    assert a_run(spark, tmp_path, lambda url: fetch.Reply(body=b"x"), output_format="files").count() == 40
    assert [p.name for p in (tmp_path / "out" / "_staging").iterdir()] == ["young"]


@pytest.mark.parametrize("reserving", [True, False])
def test_bodies_in_flight_stay_within_the_budget(reserving):
    """Replies of known sizes, some of them late: what is held at a time, told from outside."""
    import random
    import threading
    import time

    r, lock, held, peak = random.Random(3), threading.Lock(), [0], [0]
    sizes = [r.choice([0, 1_000, 20_000, 45_000]) for _ in range(400)]
    budget = fetch.Budget(100_000)

    def count(n):
        with lock:
            held[0] += n
            peak[0] = max(peak[0], held[0])

    def reserved(url, reserve):
        i = int(url)
        if i % 50 == 0:
            time.sleep(0.05)
        reserve(sizes[i])
        count(sizes[i])
        return fetch.Reply(body=bytes(sizes[i]))

    ask = reserved if reserving else (lambda url: reserved(url, lambda n: None))
    seen = []
    for i, reply, _ in fetch.replies(((i, str(i)) for i in range(400)), ask, 16, 0, budget):
        seen.append((i, len(reply.body)))
        count(-len(reply.body))
    assert seen == [*enumerate(sizes)] and budget.held == 0 and budget.peak <= 100_000
    assert not reserving or peak[0] <= 100_000


def test_a_body_larger_than_the_budget_goes_alone_and_failures_give_back(server):
    budget = fetch.Budget(1_000)
    bodies = {"0": 5_000, "1": 400, "2": None, "3": 5_000}

    def ask(url, reserve):
        reserve(bodies[url] or 900)
        return fetch.Reply(body=bytes(bodies[url])) if bodies[url] is not None else fetch.Reply(error="broke off")

    got = [(i, reply.error or len(reply.body)) for i, reply, _ in fetch.replies(((i, str(i)) for i in range(4)), ask, 4, 1, budget)]
    assert got == [(0, 5_000), (1, 400), (2, "broke off"), (3, 5_000)] and budget.held == 0
    taken = []
    reply = fetch.HttpFetcher()(server + "/ok", taken.append)
    assert taken == [len(reply.body)]


def test_pictures_in_the_job(spark, tmp_path):
    """Gates, resizing and boxes act where re-encoding is not switched off."""
    import numpy as np

    from shardloom.operators import images

    (tmp_path / "in.jsonl").write_text("\n".join(json.dumps({"url": f"http://x/{n}", "boxes": "b"}) for n in ("good", "small", "bad")))
    picture = lambda w, h: images.encode_png(np.full((h, w, 3), 7, np.uint8))
    bodies = {"http://x/good": picture(40, 20), "http://x/small": picture(5, 5), "http://x/bad": b"no picture"}
    seen = []

    def blurred(img, bbox_list):
        return np.zeros_like(img)

    got = download(spark, str(tmp_path / "in.jsonl"), lambda url: fetch.Reply(body=bodies[url]), codecs={"blurrer": blurred}, output_folder=str(tmp_path / "out"), input_format="jsonl", output_format="files", encode_format="png", encode_quality=6, disable_all_reencoding=False, image_size=16, resize_mode="keep_ratio", min_image_size=10, bbox_col="boxes")
    rows = {r.url: r for r in got.collect()}
    good = rows["http://x/good"]
    assert (good.status, good.width, good.height, good.original_width) == ("success", 32, 16, 40)
    assert rows["http://x/small"].status == rows["http://x/bad"].status == "failed_to_resize" and rows["http://x/small"].error_message == "image too small"
    pixels = images.decode_png(next((tmp_path / "out" / "00000").glob("*.png")).read_bytes())
    assert pixels.shape[:2] == (16, 32) and not pixels[..., :3].any()
    assert json.loads((tmp_path / "out" / "00000_stats.json").read_text())["failed_to_resize"] == 2
    with pytest.warns(UserWarning, match="image_size has no effect"):
        from shardloom.config import Options

        Options("u", image_size=5)


def test_monitored_job(spark, tmp_path):
    (tmp_path / "in.txt").write_text("\n".join(f"http://x/{i}" for i in range(9)))
    download(spark, str(tmp_path / "in.txt"), lambda url: fetch.Reply(body=b"x") if url[-1] != "3" else fetch.Reply(error="no"), monitoring=True, output_folder=str(tmp_path / "out"), number_sample_per_shard=4, output_format="dummy", encode_format="bin")
    row = spark.table("job_totals").first()
    assert (row["count"], row.successes, row.failed_to_download) == (9, 8, 1)


def test_bodies_without_a_length_are_bounded():
    class Endless(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            self.send_response(200)
            self.end_headers()
            try:
                for _ in range(2_000):
                    self.wfile.write(b"x" * 10_000)
            except OSError:
                pass

        def log_message(self, *a):
            pass

    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Endless)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    reply = fetch.HttpFetcher(max_bytes=50_000)(f"http://127.0.0.1:{s.server_port}/")
    s.shutdown()
    assert reply.body is None and reply.error == "Image too large"


def test_a_slow_reply_does_not_stop_the_rows_behind_its_batch(spark):
    """Rows of later batches are fetched while the first row of the first batch waits."""
    import time

    def slow(url):
        if url == "u0":
            time.sleep(1.5)
        return fetch.Reply(body=str(time.time()).encode())

    df = spark.createDataFrame([(f"u{i}",) for i in range(40)], "url string").coalesce(1)
    rows = {r.url: float(bytes(r.bin)) for r in fetch.fetched(df, slow, "bin", threads=8, batch_rows=4).collect()}
    assert len(rows) == 40 and sum(at < rows["u0"] for at in rows.values()) >= 28


def test_text_rows_are_numbered_over_splits(spark, tmp_path):
    """One text file of many splits is many tasks; positions follow the lines."""
    (tmp_path / "a.txt").write_text("".join(f"http://x/{i:06d}\n" for i in range(5_000)))
    (tmp_path / "b.txt").write_text("".join(f"http://y/{i:06d}\n\n" for i in range(777)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        table = tables.url_table(spark, str(tmp_path), "txt")
        rows = sharding.with_shards(table, 100).collect()
        assert table.rdd.getNumPartitions() > 10
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    at = {r.url: r.shard_id * 100 + r.idx for r in rows}
    assert at == {f"http://x/{i:06d}": i for i in range(5_000)} | {f"http://y/{i:06d}": 5_000 + i for i in range(777)}


def test_command_line(spark, tmp_path):
    from shardloom.__main__ import main

    (tmp_path / "in.txt").write_text("http://127.0.0.1:1/none\n")
    main(["--url_list", str(tmp_path / "in.txt"), "--output_dir", str(tmp_path / "o"), "--input_format", "txt", "--encode_format", "bin"])
    assert json.loads((tmp_path / "o" / "00000_stats.json").read_text())["failed_to_download"] == 1


def test_windowed_order():
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(4) as pool:
        assert [*fetch.windowed(pool, lambda x: x * x, range(50), 8)] == [x * x for x in range(50)]


def test_retries():
    calls = []

    def flaky(url):
        calls.append(url)
        return fetch.Reply(body=b"x") if len(calls) == 3 else fetch.Reply(error=f"e{len(calls)}")

    assert fetch.with_retries(flaky, "u", 2).body == b"x" and len(calls) == 3
    calls.clear()
    assert fetch.with_retries(flaky, "u", 1).error == "e2"


# --- monitor and fleet ----------------------------------------------------------------------------------------------


def stat_file(folder, shard, count, ok, start, end, said):
    (folder / f"{shard:05d}_stats.json").write_text(json.dumps({"count": count, "successes": ok, "failed_to_download": count - ok, "failed_to_resize": 0, "duration": end - start, "start_time": start, "end_time": end, "status_dict": said}, indent=4))


def test_monitor(spark, tmp_path):
    folder = tmp_path / "s"
    folder.mkdir()
    stat_file(folder, 0, 10, 8, 0.0, 2.0, {"success": 8, "404": 2})
    stat_file(folder, 1, 10, 10, 1.0, 5.0, {"success": 10})
    (folder / "00002_stats.json").write_text("{not json")
    done = spark.createDataFrame([(1,)], "shard_id long")
    q = monitor.start(spark, str(folder), "totals_seen", str(tmp_path / "c"), interval=None)
    q.awaitTermination()
    row = spark.table("totals_seen").first()
    assert (row["count"], row.successes, row.img_per_sec, row.success) == (20, 18, 4.0, 0.9)
    stat_file(folder, 3, 5, 0, 4.0, 6.0, {"404": 5})
    q = monitor.start(spark, str(folder), "totals_seen", str(tmp_path / "c"), interval=None)
    q.awaitTermination()
    assert spark.table("totals_seen").first()["count"] == 25  # files are folded once each
    batch = monitor.read_stats(spark, str(folder))
    assert [r.shard_id for r in monitor.bad(batch).collect()] == [2]
    good = monitor.good(batch)
    assert [(r.status, r["count"]) for r in monitor.statuses(good).collect()] == [("success", 18), ("404", 7)]
    assert monitor.totals(monitor.fresh(good, done)).first()["count"] == 15
    assert {r.shard_id for r in monitor.done_shards(spark, str(folder)).collect()} == {0, 1, 2, 3}
    assert "count: 25" in monitor.line(monitor.report(good).where("prefix = 'total'").first())


def test_empty_statistics(spark):
    none = spark.createDataFrame([], stats.STATS_SCHEMA + ", shard_id long")
    row = stats.with_ratios(stats.summed(none)).first()
    assert row["count"] == 0 and row.success is None and row.img_per_sec is None


def test_fleet(spark, tmp_path):
    hosts = spark.createDataFrame([(f"h{i}",) for i in range(6)], "host string")
    state = spark.createDataFrame([("a", "running", "h0", ["h1", "h2"], 2, 1, "u"), ("b", "stopped", "h3", ["h4"], 1, 1, "u")], fleet.STATE)
    names = lambda df: sorted(r.host for r in df.collect())
    assert names(fleet.free_hosts(hosts, state)) == ["h3", "h4", "h5"]
    assert names(fleet.drawn_hosts(hosts, 7)) == [] and len(names(fleet.drawn_hosts(hosts, 4, 1))) == 4
    a = state.where("cluster_id = 'a'")
    assert names(fleet.tail(a, 1)) == ["h2"] and names(fleet.tail(a, 9)) == ["h1", "h2"] and names(fleet.tail(a, 0)) == []
    grown = fleet.added(a, fleet.first_hosts(fleet.free_hosts(hosts, state), 2)).first()
    assert grown.workers == ["h1", "h2", "h3", "h4"] and grown.num_workers == 4
    assert fleet.without(a, fleet.tail(a, 1)).first().workers == ["h1"] and fleet.killed(a).first().status == "stopped"
    fleet.save(fleet.killed(a), str(tmp_path))
    assert tables.running_clusters(spark, str(tmp_path)).count() == 0 and json.loads((tmp_path / "a.json").read_text())["status"] == "stopped"
    new = fleet.setup(hosts, state, "n", 2, 30).first()
    assert (new.master_node, new.workers, new.num_workers) == ("h3", ["h4"], 1)


def test_fleet_command_line(spark, tmp_path, capsys):
    from shardloom.fleet import main

    (tmp_path / "hosts.csv").write_text(",host\n" + "".join(f"{i},h{i}\n" for i in range(8)))
    (tmp_path / "cfg.json").write_text(json.dumps({"id": "b", "num_nodes": 2, "mem_gb": 4}))
    at = ["--states", str(tmp_path / "s"), "--hosts", str(tmp_path / "hosts.csv")]
    said = lambda *argv: (main([*argv, *at]), [json.loads(x) for x in capsys.readouterr().out.splitlines()])[1]
    assert said("list") == []
    (a,) = said("setup", "--id", "a", "--num_nodes", "3")
    assert (a["master_node"], a["workers"], a["num_workers"]) == ("h0", ["h1", "h2"], 2)
    (b,) = said("setup", "--config", str(tmp_path / "cfg.json"))
    assert (b["master_node"], b["workers"], b["mem_gb"]) == ("h3", ["h4"], 4)
    (more,) = said("add", "--id", "a", "--num_nodes", "2", "--seed", "5")
    assert more["num_workers"] == 4 and set(more["workers"][2:]) <= {"h5", "h6", "h7"}
    (less,) = said("kill", "--id", "a", "--num_nodes", "1")
    assert less["workers"] == more["workers"][:3]
    assert said("list") == [{"cluster_id": "a", "num_workers": 3}, {"cluster_id": "b", "num_workers": 1}]
    assert said("kill", "--id", "b")[0]["status"] == "stopped" and [r["cluster_id"] for r in said("list")] == ["a"]
    for bad in (["add", "--id", "b", "--num_nodes", "1"], ["setup", "--id", "a", "--num_nodes", "1"]):
        with pytest.raises(ValueError):
            said(*bad)
    with pytest.raises(SystemExit):
        main(["add", "--states", "s", "--id", "a"])


def test_counters(spark):
    counts = spark.createDataFrame([("a", 5), ("b", 5), ("c", 9), ("d", 1)], "status string, count long")
    assert [r.status for r in stats.status_table(counts, 3).collect()] == ["c", "a", "b"]
    assert [r.status for r in stats.capped(counts, 4).collect()] == ["c", "a"]


def test_header_of_a_page_is_read_once(spark):
    """The search for header cells stands below explode() in the plan, not above it, where it ran for each row."""
    import re

    page = spark.createDataFrame([("<table><tr><th>Address</th><th>State</th></tr>" + "".join(f"<tr><td>h{i}:1</td><td>ALIVE</td></tr>" for i in range(50)) + "</table>",)], "html string")
    found = tables.alive_workers(tables.worker_table(page))
    assert sorted(r.host for r in found.collect()) == sorted(f"h{i}" for i in range(50))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: re.search(r"Generate explode", plan).start()]
    assert "<th" not in above and "<th" in plan
