"""Queries over tables of several files, whose ends are no ends of shards, against their DuckDB twins over one file."""

from itertools import pairwise

import pyarrow.parquet as pq
import pytest
from conftest import SF, duck
from pyspark.sql import functions as F

from shardloom.operators import sharding
from shardloom.plans.queries import ORACLES, QUERIES
from shardloom.sources import tables

LARGER = SF.replace("sf0.001", "sf0.01")  # 250 pages
PLACES = ["extend_start", "files_layout", "incremental_remaining", "parquet_sink", "sample_key", "shard_assign", "shard_manifest", "shard_names", "shard_order", "sidecar", "tar_members", "tar_without_captions", "tfrecord_features"]


def parts(folder, table, *ends):
    folder.mkdir(parents=True)
    for k, (a, b) in enumerate(zip((0, *ends), (*ends, table.num_rows), strict=True)):
        pq.write_table(table.slice(a, b - a), folder / f"part-{k:04d}.parquet")


@pytest.fixture(scope="module")
def split(tmp_path_factory):
    """(folder of tables of one file, folder of the same in parts)"""
    one, many = tmp_path_factory.mktemp("one"), tmp_path_factory.mktemp("many")
    for name, ends in (("pages", (37, 150)), ("orders", (333, 900))):
        table = pq.read_table(f"{LARGER}/{name}.parquet")
        pq.write_table(table, one / f"{name}.parquet")
        parts(many / f"{name}.parquet", table, *ends)
    return str(one), str(many)


def agree(df, name, sf_dir):
    names, want = duck(ORACLES[name], sf_dir)
    assert sorted(map(tuple, df.select(*names).collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("name", PLACES)
def test_parts_are_one_list(spark, split, name):
    one, many = split
    agree(QUERIES[name](spark, many), name, one)


@pytest.fixture(scope="module")
def plain(tmp_path_factory):
    """pages in parts whose numbers are written without zeros: part-10 and part-11 are the last, and part-4 has no rows"""
    folder = tmp_path_factory.mktemp("plain")
    table = pq.read_table(f"{LARGER}/pages.parquet")
    (folder / "pages.parquet").mkdir()
    for k, (a, b) in enumerate(pairwise((0, 30, 41, 70, 95, 95, 120, 133, 150, 171, 190, 230, 250))):
        pq.write_table(table.slice(a, b - a), folder / "pages.parquet" / f"part-{k}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["shard_assign", "shard_names", "shard_order", "sidecar", "tar_members"])
def test_parts_are_in_order_of_their_numbers(spark, split, plain, name):
    agree(QUERIES[name](spark, plain), name, split[0])


def test_numbers_in_names(spark):
    names = ["a/part-2", "a/part-10", "a/part-010-b", "b/1-9", "b/1-10", "b/2-1", "b/x", f"b/x{10**19}", f"b/x{10**19 + 1}"]
    got = spark.createDataFrame([(n,) for n in reversed(names)], "n string").orderBy(sharding.by_numbers(F.col("n")), "n")
    assert [r.n for r in got.collect()] == names


def test_one_list_keeps_numbers(spark, split):
    """Later files alone, from a later shard on: rows keep their places in the list."""
    table = tables.url_table(spark, f"{split[1]}/pages.parquet", "parquet", extras=["page_id"])
    got = sharding.with_shards(table, 20, start_shard_id=5, start_file_id=1, one_list=True).collect()
    assert {(r.page_id, r.shard_id, r.idx) for r in got} == {(p, 5 + p // 20, p % 20) for p in range(37, 250)}


@pytest.mark.parametrize("name", ["fetch_lookup", "manifest_job", "resumed_job", "whole_job", "url_pipeline"])
def test_pages_of_one_url_have_bodies_of_their_own(spark, tmp_path, name):
    """Pages 3 and 160 share a URL, and so do 11, which the store lacks, and 13."""
    table = pq.read_table(f"{LARGER}/pages.parquet")
    urls = table["url"].to_pylist()
    urls[160], urls[13] = urls[3], urls[11]
    table = table.set_column(table.schema.get_field_index("url"), "url", [urls])
    (tmp_path / "one").mkdir()
    pq.write_table(table, tmp_path / "one" / "pages.parquet")
    parts(tmp_path / "many" / "pages.parquet", table, 37, 150)
    agree(QUERIES[name](spark, str(tmp_path / "many")), name, str(tmp_path / "one"))
