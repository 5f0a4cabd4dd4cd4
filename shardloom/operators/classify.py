"""Outcomes of samples: size, opt-out, hash and image gates, status columns, retries told relationally, dimensions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import AREA_TOO_LARGE, ASPECT_TOO_LARGE, OPTED_OUT, TOO_LARGE, TOO_SMALL, digest, disallowed

SUCCESS, NOT_FETCHED, NOT_RESIZED = "success", "failed_to_download", "failed_to_resize"
HASH_MISMATCH = "hash mismatch"


def size_error(n_bytes: Column, most: int | None) -> Column:
    """TOO_LARGE beyond the limit; no limit, or no size: no error."""
    return F.lit(None).cast("string") if most is None else F.when(n_bytes > F.lit(most), F.lit(TOO_LARGE))


def robots_error(values: Column, token: str | None, directives: Sequence[str]) -> Column:
    return F.when(disallowed(values, token, directives), F.lit(OPTED_OUT))


def image_error(width: Column, height: Column, min_size: int = 0, max_area: float = math.inf, max_aspect: float = math.inf) -> Column:
    """The first gate that fails, in the order: smallest side, area, aspect ratio; none without both dimensions."""
    small, large = F.when(width.isNotNull() & height.isNotNull(), F.least(width, height)), F.greatest(width, height)
    out = F.when(small < F.lit(min_size), F.lit(TOO_SMALL))
    if not math.isinf(max_area):
        out = out.when(width * height > F.lit(max_area), F.lit(AREA_TOO_LARGE))
    if not math.isinf(max_aspect):
        out = out.when(large / small > F.lit(max_aspect), F.lit(ASPECT_TOO_LARGE))
    return out


def with_hash(df: DataFrame, algorithm: str, payload: str) -> DataFrame:
    """df with a column named after the algorithm: the payload's digest."""
    return df.withColumn(algorithm, digest(F.col(payload), algorithm))


def verify_hash(df: DataFrame, expected: str, algorithm: str, payload: str) -> DataFrame:
    """Payloads whose digest is not the expected one become null, with HASH_MISMATCH as their error; a null expectation
    is not met."""
    bad = F.col(payload).isNotNull() & ~F.coalesce(digest(F.col(payload), algorithm) == F.lower(expected), F.lit(False))
    return df.withColumns({"error_message": F.when(bad, F.lit(HASH_MISMATCH)).otherwise(F.col("error_message")), payload: F.when(~bad, F.col(payload))})


def with_status(df: DataFrame, payload: str) -> DataFrame:
    """df with status: fetched payloads succeed unless a resize error stands, others are not fetched."""
    error = F.col("error_message")
    resized = error.isin(TOO_SMALL, AREA_TOO_LARGE, ASPECT_TOO_LARGE)
    return df.withColumn("status", F.when(resized, NOT_RESIZED).when(error.isNotNull() | F.col(payload).isNull(), NOT_FETCHED).otherwise(SUCCESS))


def with_payload_only(df: DataFrame, payload: str) -> DataFrame:
    """Rows that go into containers."""
    return df.where(F.col(payload).isNotNull())


def retried(attempts: DataFrame, keys: Sequence[str], attempt: str, ok: Column, outcome: str, most: int) -> DataFrame:
    """Outcome of up to `most` attempts for each key: the first that succeeds, else the last error."""
    tried = attempts.where(F.col(attempt) <= most)
    first = F.min_by(F.when(ok, F.col(outcome)), F.when(ok, F.col(attempt)))
    return tried.groupBy(*keys).agg(F.coalesce(F.max(ok), F.lit(False)).alias("success"), first.alias("result"), F.when(~F.max(ok), F.max_by(outcome, attempt)).alias("last_error"), F.count(F.lit(1)).alias("attempts"))


def rounded(x: Column) -> Column:
    """To the nearest whole number, halves up."""
    return F.floor(x + 0.5).cast("long")


def resized(width: Column, height: Column, size: int, mode: str, only_if_bigger: bool = False) -> tuple[Column, Column]:
    """Dimensions after resizing: keep_ratio and center_crop bring the smaller side to size (center_crop then cuts to a
    square), keep_ratio_largest and border the larger one (border then fills up to a square); `no` changes nothing, and
    with only_if_bigger neither does a picture that is small enough."""
    if mode == "no":
        return width.cast("long"), height.cast("long")
    side = F.least(width, height) if mode in ("keep_ratio", "center_crop") else F.greatest(width, height)
    acts = (side > F.lit(size)) if only_if_bigger else F.lit(True)
    if mode in ("center_crop", "border"):
        return tuple(F.when(acts, F.lit(size).cast("long")).otherwise(x.cast("long")) for x in (width, height))
    return tuple(F.when(acts, rounded(x * F.lit(float(size)) / side)).otherwise(x.cast("long")) for x in (width, height))
