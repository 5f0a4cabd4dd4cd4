"""Reports of a running job, counters of bounded size, checksums, filtered pictures, named hosts."""

import json
import random
import time
import zlib
from collections import Counter

import numpy as np
import pytest

from shardloom.operators import images, stats
from shardloom.sinks import containers
from shardloom.streaming import monitor


def stat_file(folder, shard, said, start=0.0, end=2.0):
    count = sum(said.values())
    row = {"count": count, "successes": said.get("success", 0), "failed_to_download": count - said.get("success", 0), "failed_to_resize": 0, "duration": end - start, "start_time": start, "end_time": end, "status_dict": said}
    (folder / f"_{shard}").write_text(json.dumps(row))
    (folder / f"_{shard}").rename(folder / f"{shard:05d}_stats.json")


class Clock:
    now = 0.0

    def __call__(self):
        return self.now


def test_outputs_at_their_own_intervals(spark, tmp_path):
    """Under a clock of its own the status table comes at most each 60 seconds, and what was held back in the end."""
    folder, clock, totals, tables, bad, said = tmp_path / "s", Clock(), [], [], [], []
    folder.mkdir()
    done = spark.createDataFrame([(9,)], "shard_id long")
    start = lambda: monitor.Monitor(spark, str(folder), str(tmp_path / "state"), totals.append, tables.append, bad.extend, said.append, done, interval="0 seconds", clock=clock)
    m = start()
    stat_file(folder, 9, {"success": 100})  # was done before
    at = []
    for shard, step in enumerate((10, 30, 30, 10, 55, 1)):
        clock.now += step
        before = len(tables)
        stat_file(folder, shard, {"success": 3, "404": shard + 1})
        m.query.processAllAvailable()
        at += [clock.now] * (len(tables) - before)
    assert at == [70.0, 135.0] and [t[0]["count"] for t in totals][-6:] == [4, 9, 15, 22, 30, 39]
    assert [(r.status, r["count"]) for r in tables[-1]] == [("404", 15), ("success", 15)]
    (folder / "00006_stats.json").write_text("{broken")
    m.query.processAllAvailable()
    stat_file(folder, 7, {"success": 1})
    m.stop()  # reads shard 7 and flushes
    assert len(tables) == 3 and [(r.status, r["count"]) for r in tables[-1]] == [("404", 21), ("success", 19)]
    assert totals[-1][0]["count"] == 40 and bad == ["6"] and not m.query.isActive
    assert any(x.startswith("worker") and "count: 4" in x for x in said) and "1 statistics files could not be parsed" in said
    m = start()  # the state is taken up, and files are folded once
    stat_file(folder, 8, {"success": 2})
    m.stop()
    assert totals[-1][0]["count"] == 42 and [(r.status, r["count"]) for r in tables[-1]] == [("404", 21), ("success", 21)]


def test_throttle_by_hand():
    clock, out = Clock(), []
    t = monitor.Throttle(out.append, 60, clock)
    for now, rows in ((1, "a"), (59, "b"), (61, "c"), (100, "d"), (122, "e"), (123, "f")):
        clock.now = now
        t(rows)
    assert out == ["c", "e"]
    t.sync()
    t.sync()
    assert out == ["c", "e", "f"]


def test_a_job_reports_while_it_runs(spark, tmp_path):
    """Totals are told while later shards are still being fetched."""
    from shardloom.operators import fetch
    from shardloom.plans.materialize import download

    (tmp_path / "in.txt").write_text("\n".join(f"http://x/{i}" for i in range(24)))
    gate = tmp_path / "gate"

    def fetcher(url):
        if url.endswith("/23"):  # waits until a report has been given
            for _ in range(600):
                if gate.exists():
                    break
                time.sleep(0.1)
            else:
                return fetch.Reply(error="nothing was told")
        return fetch.Reply(body=b"x")

    seen = []

    def told(kind, rows):
        seen.append((kind, rows))
        if kind == "totals" and rows[0]["count"]:
            gate.touch()

    got = download(spark, str(tmp_path / "in.txt"), fetcher, monitoring=told, output_folder=str(tmp_path / "out"), number_sample_per_shard=4, output_format="webdataset", encode_format="bin")
    assert got.where("status = 'success'").count() == 24
    counts = [r[0]["count"] for k, r in seen if k == "totals"]
    assert counts[-1] == 24 and any(0 < c < 24 for c in counts) and [(r.status, r["count"]) for k, rows in seen if k == "statuses" for r in rows][-1] == ("success", 24)


@pytest.mark.parametrize(("most", "parts"), [(1, 3), (5, 1), (20, 6), (10_000, 4)])
def test_heavy_hitters_within_their_bounds(spark, most, parts):
    r = random.Random(most)
    rows = [(None if r.random() < 0.01 else f"s{int(r.paretovariate(0.6)) % 3000}", r.randrange(0, 4)) for _ in range(8_000)]
    df = spark.createDataFrame(rows, "status string, w int").repartition(parts)
    for weight in (None, "w"):
        true = Counter()
        for s, w in rows:
            if s is not None and (weight is None or w):
                true[s] += 1 if weight is None else w
        got = {x.status: (x["count"], x.most) for x in stats.heavy_hitters(df, most, weight).collect()}
        assert len(got) <= most * parts
        bound = true.total() / (most + 1)
        assert all(a <= true[s] <= b and b - a <= bound for s, (a, b) in got.items())
        assert {s for s, n in true.items() if n > bound} <= {*got}
        assert most < len(true) or {s: a for s, (a, _) in got.items()} == true
    assert stats.heavy_hitters(df.where("false"), most).count() == 0


def slow_crc(data):
    c = 0xFFFFFFFF
    for b in data:
        c = containers._TABLE[(c ^ b) & 0xFF] ^ c >> 8
    return c ^ 0xFFFFFFFF


def test_checksums_are_those_of_the_byte_loop():
    r = np.random.default_rng(4)
    assert containers.crc32c(b"123456789") == 0xE3069283  # the check value of the algorithm
    for n in [0, 1, 9, 255, 256, 257, 511, 512, 513, 1023, 1025, 4096, 5000, 70_001, 1 << 17]:
        data = r.bytes(n)
        assert containers.crc32c(data) == slow_crc(data)
        assert containers.crc32c(bytes(n)) == slow_crc(bytes(n))


def test_checksums_are_fast():
    data = np.random.default_rng(1).bytes(40_000_000)
    containers.crc32c(data)
    began = time.process_time()
    containers.crc32c(data)
    assert 40 / (time.process_time() - began) > 100  # MB a second


def filtered(pixels, kinds):
    """The lines of a PNG, each with the filter that is named, by the rule for each byte."""
    height, width, n = pixels.shape
    flat, out = pixels.reshape(height, -1).astype(int), b""
    for y in range(height):
        line = bytearray([kinds[y]])
        for i in range(width * n):
            left = flat[y, i - n] if i >= n else 0
            above = flat[y - 1, i] if y else 0
            corner = flat[y - 1, i - n] if y and i >= n else 0
            p = left + above - corner
            guess = [0, left, above, (left + above) // 2, min((left, above, corner), key=lambda v: abs(p - v))][kinds[y]]
            line.append((flat[y, i] - guess) & 255)
        out += bytes(line)
    return out


@pytest.mark.parametrize("channels", [1, 2, 3, 4])
def test_filters_by_brute_force(channels):
    r = np.random.default_rng(channels)
    for height, width in ((1, 1), (1, 9), (7, 1), (13, 8), (5, 30)):
        pixels = r.integers(0, 256, (height, width, channels), np.uint8)
        if width > 4:
            pixels[:, 2:5] = pixels[:, :1]  # equal neighbours: ties of the fourth filter
        plain = images.encode_png(pixels)
        body = zlib.compress(filtered(pixels, [int(k) for k in r.integers(0, 5, height)]))
        start, end = plain.index(b"IDAT") - 4, plain.index(b"IEND") - 4
        made = plain[:start] + len(body).to_bytes(4, "big") + b"IDAT" + body + b"\0\0\0\0" + plain[end:]
        assert np.array_equal(images.decode_png(made), pixels)


def test_large_pictures_are_decoded_quickly():
    r = np.random.default_rng(0)
    lines = r.integers(0, 256, (1000, 1000, 3), np.uint8)
    began = time.process_time()
    images.along_diagonals(np.full(1000, 4), lines)
    assert time.process_time() - began < 3


def test_named_hosts_are_released(spark, tmp_path, capsys):
    from shardloom.fleet import main

    (tmp_path / "hosts.csv").write_text("host\n" + "".join(f"h{i}\n" for i in range(6)))
    at = ["--states", str(tmp_path / "s"), "--hosts", str(tmp_path / "hosts.csv")]
    main(["setup", "--id", "a", "--num_nodes", "5", *at])
    capsys.readouterr()
    main(["kill", "--id", "a", "--nodes_to_kill", "h2", "h4", *at])
    assert json.loads(capsys.readouterr().out)["workers"] == ["h1", "h3"]
    for names in (["h0"], ["h1", "h5"]):  # the master, and a host of no cluster
        with pytest.raises(ValueError, match="no workers of a"):
            main(["kill", "--id", "a", "--nodes_to_kill", *names, *at])
    with pytest.raises(SystemExit):
        main(["kill", "--id", "a", "--num_nodes", "1", "--nodes_to_kill", "h1", *at])
