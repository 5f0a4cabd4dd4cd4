"""Delimited text and arrays of JSON in many tasks, against Python's modules and Spark's own reading of whole files."""

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from shardloom.operators import sharding
from shardloom.sources import arrays, delimited, tables
from shardloom.sources.tables import BLOCK, FILE, INDEX


def cells(r, n):
    some = ["", "plain", "two words", "line\nend", "\n", "quote\"d", "\"", "\"\"", "a,b", "x\r\ny", "tab\tbed", "é日本", "\n\n\"\n,", "l" * 300]
    return [[str(i), r.choice(some), r.choice(some), f"u{i}"] for i in range(n)]


def written(rows, sep, end):
    out = io.StringIO()
    w = csv.writer(out, delimiter=sep, lineterminator=end)
    w.writerow(["n", "a", "b", "url"])
    w.writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize(("sep", "end", "most"), [(",", "\n", "100"), (",", "\r\n", "700"), ("\t", "\n", "64"), (",", "\n", "1m")])
def test_records_of_many_splits(spark, tmp_path, sep, end, most):
    r = random.Random(most + sep)
    files = {"a": cells(r, 300), "b": cells(r, 1), "c": [], "d": cells(r, 120)}
    kind = "csv" if sep == "," else "tsv"
    for name, rows in files.items():
        (tmp_path / f"{name}.{kind}").write_bytes(written(rows, sep, end).encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", most)
    try:
        table = tables.read_files(spark, tables.listing(spark, str(tmp_path), kind), kind)
        got = {(x[FILE].rsplit("/", 1)[1][0], x[INDEX]): (str(x["n"]), x["a"], x["b"], x["url"]) for x in table.collect()}
        lines = delimited.scanned(spark, [str(tmp_path / f"a.{kind}")], sep)
        assert most == "1m" or lines.select(BLOCK).distinct().count() > 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {(f, i): tuple(row) for f, rows in files.items() for i, row in enumerate(rows)}


def test_as_spark_reads_whole_files(spark, tmp_path):
    """Types and values are those of Spark's reader of whole files."""
    r = random.Random(1)
    rows = [[str(i), r.choice(["1.5", "2", ""]), r.choice(["2020-01-02 03:04:05", ""]), r.choice(["true", "false"]), r.choice(["x\ny", "z"]), r.choice(["2021-05-06", "2022-01-01"]), "99999999999"] for i in range(200)]
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows([["i", "d", "t", "f", "s", "day", "long"], *rows])
    (tmp_path / "t.csv").write_text(out.getvalue())
    own = spark.read.options(header=True, inferSchema=True, multiLine=True, escape='"', timestampFormat="yyyy-MM-dd HH:mm:ss", preferDate=True).csv(str(tmp_path / "t.csv"))
    want = tables.empty_for_null(tables.as_arrow_reads(own))
    got = tables.read_files(spark, [str(tmp_path / "t.csv")], "csv").drop(FILE, BLOCK, INDEX)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_quotes_within_cells_are_plain(spark, tmp_path):
    """A quote that begins no cell opens nothing; marks, blank lines and headers alone."""
    (tmp_path / "a.csv").write_text('﻿n,a\n1,5" nail\n\n2,"so"\n3,6" nail\r\n4,"x ""y""\nz"\n')
    (tmp_path / "b.csv").write_text("n,a\n")
    rows = {r.n: r.a for r in tables.read_files(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], "csv").collect()}
    assert rows == {1: '5" nail', 2: "so", 3: '6" nail', 4: 'x "y"\nz'}


def test_open_cells_and_empty_files_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text('n,a\n1,"open\n2,b\n')
    with pytest.raises(ValueError, match="not closed"):
        tables.read_files(spark, [str(tmp_path / "a.csv")], "csv")
    (tmp_path / "e.csv").write_text("")
    with pytest.raises(ValueError, match="header"):
        tables.read_files(spark, [str(tmp_path / "e.csv")], "csv")


def test_states_by_brute_force():
    """Both states of a line by a scan of its characters."""
    r = random.Random(9)

    def slow(line, inside, sep):
        start, i = not inside, 0
        while i < len(line):
            c = line[i]
            if inside:
                if c == '"' and line[i + 1 : i + 2] == '"':
                    i += 1
                elif c == '"':
                    inside = start = False
            elif c == '"' and start:
                inside = True
            else:
                start = c == sep
            i += 1
        return inside

    for _ in range(20_000):
        line = "".join(r.choice('",ab') for _ in range(r.randrange(0, 12)))
        for inside in (False, True):
            assert delimited.state_after(line, inside, ",") == slow(line, inside, ",")


def test_a_row_without_a_split_raises(spark):
    rows = spark.createDataFrame([("f", 0, 0), ("f", 10, 1)], f"{FILE} string, {BLOCK} long, _seq long")
    starts = spark.createDataFrame([("f", 0, 0)], f"{FILE} string, {BLOCK} long, _start long")
    assert sharding.placed(rows.where(F.col(BLOCK) == 0), starts).first()[INDEX] == 0
    with pytest.raises(Exception, match="split is not known"):
        sharding.placed(rows, starts).collect()


def test_positions_hold_when_the_scan_is_split_otherwise(spark, tmp_path):
    """The size of splits changes between the plan and its use, as when executors join."""
    (tmp_path / "a.txt").write_text("".join(f"http://x/{i:06d}\n" for i in range(3_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
        table = sharding.with_row_index(tables.url_table(spark, str(tmp_path), "txt"))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "9k")
        assert {r.url: r[INDEX] for r in table.collect()} == {f"http://x/{i:06d}": i for i in range(3_000)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def documents(r, n):
    some = ["", "plain", 'quote"d', "{", "}]", "[[", "back\\slash", "\\\"", "line\nend", "é日本", "a, b", "x" * 200]
    return [{"n": i, "s": r.choice(some), "deep": {"k": [r.choice(some), {"z": r.choice([None, i])}]}, "url": f"u{i}"} for i in range(n)]


def compact(rows):
    return json.dumps(rows)


def indented(rows):
    return json.dumps(rows, indent=2, ensure_ascii=False)


def by_line(rows):
    return "[" + ",\n".join(json.dumps(x) for x in rows) + "]\n"


def mixed(rows):
    """Several records on a line, records over several, blanks and blank lines between."""
    r, out = random.Random(2), "  \n[ "
    for i, x in enumerate(rows):
        out += json.dumps(x, indent=r.choice([None, 1])) + (r.choice([",", " ,\n\n", ",\r\n "]) if i + 1 < len(rows) else "")
    return out + "\n ] \n"


@pytest.mark.parametrize(("how", "most"), [(compact, "1m"), (indented, "400"), (by_line, "500"), (mixed, "400")])
def test_arrays_of_many_splits(spark, tmp_path, how, most):
    r = random.Random(most)
    files = {"a": documents(r, 30), "b": documents(r, 1), "c": [], "d": documents(r, 9)}
    for name, rows in files.items():
        (tmp_path / f"{name}.json").write_text(how(rows))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", most)
    try:
        table = tables.read_files(spark, tables.listing(spark, str(tmp_path), "json"), "json")
        got = {(x[FILE].rsplit("/", 1)[1][0], x[INDEX]): {"n": x["n"], "s": x["s"], "deep": {"k": [x["deep"]["k"][0], json.loads(x["deep"]["k"][1])]}, "url": x["url"]} for x in table.collect()}
        lines = arrays.scanned(spark, [str(tmp_path / "a.json")])
        assert how is compact or lines.select(BLOCK).distinct().count() > 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {(f, i): row for f, rows in files.items() for i, row in enumerate(rows)}


def test_arrays_as_spark_reads_whole_files(spark, tmp_path):
    r = random.Random(3)
    (tmp_path / "t.json").write_text(indented([{"i": i, "d": r.choice([1.5, 2, None]), "b": True, "l": 2**40, "a": [i]} for i in range(50)]))
    want = tables.as_arrow_reads(spark.read.option("multiLine", True).json(str(tmp_path / "t.json")))
    got = tables.read_files(spark, [str(tmp_path / "t.json")], "json").drop(FILE, BLOCK, INDEX)
    assert got.schema.simpleString() == want.schema.simpleString() and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_what_is_no_array_of_objects(spark, tmp_path):
    (tmp_path / "one.json").write_text('{"url": "u", "n": 1}')
    assert tables.read_files(spark, [str(tmp_path / "one.json")], "json").first()["url"] == "u"
    (tmp_path / "open.json").write_text('[{"url": "u"}, {"url": ')
    with pytest.raises(ValueError, match="do not close"):
        tables.read_files(spark, [str(tmp_path / "open.json")], "json")
    for text in ("[1, 2]", '[{"a": 1}, 5]', '["x"]', "[[1]]"):
        with pytest.raises(ValueError, match="no object"):
            [*arrays.cut(text, 0)]
    assert [*arrays.cut('{"a": 1}, {"b":', 1)] == [('{"a": 1}', True, True), ('{"b":', True, False)] and [*arrays.cut(" 2}, ", 2)] == [(" 2}", False, True)]
