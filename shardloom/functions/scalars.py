"""Scalar functions, all as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The agent string that is sent, and the messages that outcomes carry.
USER_AGENT = "Mozilla/5.0 (X11; Ubuntu; Linux x86_64; rv:72.0) Gecko/20100101 Firefox/72.0"
OPTED_OUT = "Use of image disallowed by X-Robots-Tag directive"
TOO_LARGE = "Image too large"
TOO_SMALL, AREA_TOO_LARGE, ASPECT_TOO_LARGE = "image too small", "image area too large", "aspect ratio too large"


def shard_count(rows: Column, size: int) -> Column:
    """Shards that a file of so many rows makes."""
    return F.ceil(rows / F.lit(size)).cast("long")


def sample_key(shard_id: Column, idx: Column, magnitude: int, shard_digits: int) -> Column:
    """Shard id and index as one decimal string, padded to magnitude + shard_digits, wider if need be."""
    return F.format_string(f"%0{magnitude + shard_digits}d", shard_id.cast("long") * F.lit(10**magnitude).cast("long") + idx.cast("long"))


def shard_name(shard_id: Column, shard_digits: int = 5) -> Column:
    return F.format_string(f"%0{shard_digits}d", shard_id.cast("long"))


def shard_of_name(name: Column) -> Column:
    """The number before the first underscore of a file's name; null without one."""
    return F.nullif(F.regexp_extract(name, r"^(\d+)_", 1), F.lit("")).cast("long")


def stripped(text: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def disallowed(values: Column, token: str | None, directives: Sequence[str]) -> Column:
    """Whether any X-Robots-Tag value of the array forbids use. A value may begin with an agent and a colon; it then
    counts only for that agent, compared in lower case and untrimmed. No values, or null: allowed."""

    def one(value: Column) -> Column:
        parts = F.split(value, ":", 2)
        named = F.size(parts) == 2
        said = F.transform(F.split(F.element_at(parts, -1), ","), lambda x: F.lower(stripped(x)))
        for_us = ~named if token is None else ~named | (F.lower(parts[0]) == F.lit(token))
        return for_us & F.arrays_overlap(said, F.array(*[F.lit(d) for d in directives]))

    if not directives:
        return F.lit(False)
    return F.coalesce(F.exists(F.filter(values, lambda v: v.isNotNull()), one), F.lit(False))


def user_agent(token: Column, project_url: str) -> Column:
    """The agent string, with the token and an address for complaints where there is a token."""
    return F.when(F.coalesce(token, F.lit("")) == "", F.lit(USER_AGENT)).otherwise(F.concat(F.lit(USER_AGENT + " (compatible; "), token, F.lit(f"; +{project_url})")))


def caption_text(caption: Column) -> Column:
    """The text that goes beside a payload: empty for null."""
    return F.coalesce(caption.cast("string"), F.lit(""))


def meta_json(columns: Sequence[str]) -> Column:
    """Metadata as JSON with nulls kept, in the order of the columns."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def digest(payload: Column, algorithm: str) -> Column:
    """Hex digest of the bytes; null stays null."""
    if algorithm == "md5":
        return F.md5(payload)
    return F.sha2(payload, {"sha256": 256, "sha512": 512}[algorithm])


def is_ip(text: Column) -> Column:
    """Whether the text is a dotted quad of numbers up to 255."""
    part = r"(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
    return text.rlike(rf"^{part}\.{part}\.{part}\.{part}$")


def host_of(address: Column) -> Column:
    return F.split(address, ":")[0]


def safe_name(address: Column) -> Column:
    return F.translate(address, ".:", "__")


def encoded(text: Column) -> Column:
    """UTF-8 bytes."""
    return F.encode(text, "UTF-8")
