"""Golden tables of scalar functions, options and pure Python helpers."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shardloom.config import DIRECTIVES, Options, magnitude
from shardloom.functions import scalars
from shardloom.operators import classify
from shardloom.operators.fetch import opted_out


@pytest.mark.parametrize(("size", "o"), [(1, 0), (2, 1), (10, 1), (11, 2), (1000, 3), (1001, 4), (10_000, 4)])
def test_magnitude(size, o):
    assert magnitude(size) == o


@pytest.mark.parametrize(("idx", "shard", "o", "c", "want"), [(7, 12, 3, 5, "00012007"), (0, 0, 4, 5, "000000000"), (999, 100000, 3, 5, "100000999")])
def test_sample_key(spark, idx, shard, o, c, want):
    assert spark.range(1).select(scalars.sample_key(F.lit(shard), F.lit(idx), o, c)).first()[0] == want


ROBOTS = [("noai", True), ("bot: NoAI , x", True), ("bot : noai", False), ("other: noindex", False), ("unavailable_after: 25 Jun 2010 15:00:00 PST", False), ("a,NOINDEX ", True), ("", False), ("\tnoai\n", True), ("bot:noai:x", False)]


@pytest.mark.parametrize(("value", "want"), ROBOTS)
def test_robots(spark, value, want):
    got = spark.range(1).select(scalars.disallowed(F.array(F.lit(value)), "bot", DIRECTIVES)).first()[0]
    assert got == want == opted_out([value], "bot", DIRECTIVES)


def test_robots_without_values(spark):
    none = F.lit(None).cast("array<string>")
    row = spark.range(1).select(scalars.disallowed(none, "bot", DIRECTIVES), scalars.disallowed(F.array(F.lit("noai")), None, []), scalars.disallowed(F.array(F.lit("bot: noai")), None, DIRECTIVES)).first()
    assert [*row] == [False, False, False]


@given(st.text(alphabet="aAbot:, \tnoainoindex", max_size=24))
@settings(max_examples=60, deadline=None)
def test_robots_agree(spark, value):
    got = spark.range(1).select(scalars.disallowed(F.array(F.lit(value)), "bot", DIRECTIVES)).first()[0]
    assert got == opted_out([value], "bot", DIRECTIVES)


@pytest.mark.parametrize(("name", "want"), [("00012_stats.json", 12), ("7_x", 7), ("x_7", None), ("12", None), ("123456789_stats.json", 123456789)])
def test_shard_of_name(spark, name, want):
    assert spark.range(1).select(scalars.shard_of_name(F.lit(name))).first()[0] == want


def test_caption_and_names(spark):
    row = spark.range(1).select(scalars.caption_text(F.lit(None)), scalars.caption_text(F.lit(3)), scalars.shard_name(F.lit(123456)), scalars.safe_name(F.lit("1.2:3")), scalars.is_ip(F.lit("1.2.3.4")), scalars.is_ip(F.lit("1.2.3.256"))).first()
    assert [*row] == ["", "3", "123456", "1_2_3", True, False]


@pytest.mark.parametrize(("w", "h", "want"), [(50, 500, "image too small"), (2000, 2000, "image area too large"), (100, 900, "aspect ratio too large"), (300, 300, None), (None, 3, None)])
def test_image_gates(spark, w, h, want):
    assert spark.range(1).select(classify.image_error(F.lit(w).cast("long"), F.lit(h).cast("long"), 60, 1_000_000, 5.0)).first()[0] == want


@pytest.mark.parametrize(
    ("mode", "only", "w", "h", "want"),
    [("no", False, 10, 20, (10, 20)), ("keep_ratio", False, 100, 50, (512, 256)), ("keep_ratio", True, 100, 50, (100, 50)), ("keep_ratio", True, 1000, 500, (512, 256)), ("center_crop", False, 100, 50, (256, 256)), ("border", False, 100, 50, (256, 256)), ("border", True, 100, 50, (100, 50)), ("keep_ratio_largest", False, 100, 33, (256, 84))],
)
def test_dimensions(spark, mode, only, w, h, want):
    a, b = classify.resized(F.lit(w), F.lit(h), 256, mode, only)
    assert tuple(spark.range(1).select(a, b).first()) == want


@pytest.mark.parametrize(
    "bad",
    [{"input_format": "xml"}, {"output_format": "zip"}, {"incremental_mode": "again"}, {"compute_hash": "crc"}, {"compute_hash": "md5", "verify_hash": ("h", "sha256")}, {"resize_mode": "stretch"}, {"downscale_interpolation": "none"}, {"save_additional_columns": ["url"]}, {"save_additional_columns": ["mp3"], "encode_format": "mp3"}, {"number_sample_per_shard": 0}, {"distributor": "other"}],
)
def test_bad_options(bad):
    with pytest.raises(ValueError):
        Options("x", **bad)


def test_options():
    o = Options("list.txt", user_agent_token=" Bot ", disallowed_header_directives=[" NoAI "], max_data_size=1.5, downscale_interpolation="AREA", save_additional_columns=["a"], bbox_col="box")
    assert o.user_agent_token == "bot" and o.disallowed_header_directives == ("noai",) and o.max_bytes == 1_500_000 and o.extras == ["a", "box"] and o.url_list.startswith("/")
    assert Options("x").disallowed_header_directives == tuple(sorted(DIRECTIVES)) and Options("x", disallowed_header_directives=[]).disallowed_header_directives == ()
    with pytest.warns(UserWarning):
        Options("x", distributor="ray")
