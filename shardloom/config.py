"""Options of a materialisation job, normalised and validated before any data is read."""

from __future__ import annotations

import math
import os
import warnings
from collections.abc import Sequence
from dataclasses import dataclass, field

INPUT_FORMATS = ("txt", "txt.gz", "json", "json.gz", "jsonl", "jsonl.gz", "csv", "csv.gz", "tsv", "tsv.gz", "parquet")
OUTPUT_FORMATS = ("webdataset", "parquet", "files", "tfrecord", "dummy")
INCREMENTAL_MODES = ("incremental", "overwrite", "extend")
DISTRIBUTORS = ("multiprocessing", "pyspark", "ray")
HASHES = (None, "md5", "sha256", "sha512")
COMMITS = ("rename", "manifest")
RESIZE_MODES = ("no", "keep_ratio", "center_crop", "border", "keep_ratio_largest")
INTERPOLATIONS = ("nearest", "linear", "bilinear", "cubic", "bicubic", "area", "lanczos", "lanczos4")
# Column names that the output uses itself.
RESERVED = ("key", "caption", "url", "width", "height", "original_width", "original_height", "status", "error_message", "exif", "md5", "sha256", "sha512")
# Opt-out directives that are honoured by default.
DIRECTIVES = ("noai", "noimageai", "noindex", "noimageindex")
MEGABYTE = 1_000_000


def interpolation(name: str) -> str:
    """The name in lower case, if it is one of INTERPOLATIONS."""
    if name.lower() not in INTERPOLATIONS:
        raise ValueError(f"Invalid interpolation {name}")
    return name.lower()


def magnitude(number_sample_per_shard: int) -> int:
    """Decimal digits that an index within a shard needs: the smallest o with 10^o >= the size."""
    if number_sample_per_shard < 1:
        raise ValueError("a shard needs at least one sample")
    return math.ceil(math.log10(number_sample_per_shard))


def absolute(path: str) -> str:
    """Local paths become absolute; those with a scheme stay."""
    return path if "://" in path or path.startswith("file:") else os.path.abspath(path)


@dataclass
class Options:
    """All parameters of download(). What Spark decides itself (distributor, subjob_size, processes_count) is accepted and
    warned about. max_bytes_in_flight bounds the bodies that a task holds. commit tells how a shard's files come into place: by
    renaming them, or, where a store cannot rename, by naming them in the shard's statistics. one_list: the files of url_list are
    parts of one list, in order of the numbers in their names, and shards run on over their ends. Image parameters act where disable_all_reencoding is off; PNG is built
    in, other codecs are given to download()."""

    url_list: str
    output_folder: str = "images"
    processes_count: int = 1
    image_size: int = 256
    resize_mode: str = "border"
    resize_only_if_bigger: bool = False
    upscale_interpolation: str = "lanczos"
    downscale_interpolation: str = "area"
    encode_quality: int = 95
    encode_format: str = "jpg"
    skip_reencode: bool = False
    output_format: str = "files"
    input_format: str = "txt"
    url_col: str = "url"
    caption_col: str | None = None
    bbox_col: str | None = None
    thread_count: int = 256
    number_sample_per_shard: int = 10_000
    extract_exif: bool = True
    save_additional_columns: Sequence[str] | None = None
    timeout: float = 10
    oom_shard_count: int = 5
    compute_hash: str | None = None
    verify_hash: tuple[str, str] | None = None
    distributor: str = "pyspark"
    subjob_size: int | None = None
    retries: int = 0
    disable_all_reencoding: bool = True
    min_image_size: int = 0
    max_image_area: float = math.inf
    max_aspect_ratio: float = math.inf
    incremental_mode: str = "incremental"
    max_shard_retry: int = 1
    user_agent_token: str | None = None
    disallowed_header_directives: Sequence[str] | None = None
    start_file_id: int = 0
    max_data_size: float | None = None
    enable_wandb: bool = False
    wandb_project: str | None = None
    start_shard_id: int = 0
    max_bytes_in_flight: int = 256_000_000
    commit: str = "rename"
    one_list: bool = False
    extras: list[str] = field(init=False, default_factory=list)

    def __post_init__(self):
        for name, value, allowed in (
            ("input format", self.input_format, INPUT_FORMATS), ("output format", self.output_format, OUTPUT_FORMATS),
            ("incremental mode", self.incremental_mode, INCREMENTAL_MODES), ("distributor", self.distributor, DISTRIBUTORS),
            ("hash", self.compute_hash, HASHES), ("commit", self.commit, COMMITS), ("resize mode", self.resize_mode, RESIZE_MODES),
        ):
            if value not in allowed:
                raise ValueError(f"Invalid {name} {value}; one of {allowed} is expected")
        self.upscale_interpolation, self.downscale_interpolation = interpolation(self.upscale_interpolation), interpolation(self.downscale_interpolation)
        if not self.disable_all_reencoding and not 0 <= self.encode_quality <= (9 if self.encode_format == "png" else 100):
            raise ValueError("encode_quality is out of the range of the format")
        if self.verify_hash is not None:
            if self.verify_hash[1] not in HASHES[1:]:
                raise ValueError(f"Invalid hash {self.verify_hash[1]}")
            if self.compute_hash is not None and self.verify_hash[1] != self.compute_hash:
                raise ValueError("verify_hash and compute_hash must name one algorithm")
        self.extras = [*(self.save_additional_columns or ())]
        if self.bbox_col:
            self.extras.append(self.bbox_col)
        if self.verify_hash and self.verify_hash[0] not in self.extras:
            self.extras.append(self.verify_hash[0])
        if taken := sorted({*(self.save_additional_columns or ())} & {*RESERVED, self.encode_format}):
            raise ValueError(f"save_additional_columns holds reserved columns: {', '.join(taken)}")
        self.user_agent_token = None if self.user_agent_token is None else self.user_agent_token.strip().lower()
        given = DIRECTIVES if self.disallowed_header_directives is None else self.disallowed_header_directives
        self.disallowed_header_directives = tuple(sorted({x.strip().lower() for x in given}))
        self.max_bytes = None if self.max_data_size is None else int(self.max_data_size * MEGABYTE)
        if self.max_shard_retry < 0 or self.max_bytes_in_flight < 1:
            raise ValueError("max_shard_retry and max_bytes_in_flight must not be negative or nothing")
        self.magnitude = magnitude(self.number_sample_per_shard)
        self.url_list, self.output_folder = absolute(self.url_list), absolute(self.output_folder)
        for name, default in (("processes_count", 1), ("subjob_size", None)):
            if getattr(self, name) != default:
                warnings.warn(f"{name} is left to Spark's own configuration", stacklevel=3)
        if self.disable_all_reencoding:
            for name, default in (("image_size", 256), ("resize_mode", "border"), ("resize_only_if_bigger", False), ("skip_reencode", False), ("min_image_size", 0), ("max_image_area", math.inf), ("max_aspect_ratio", math.inf), ("bbox_col", None)):
                if getattr(self, name) != default:
                    warnings.warn(f"{name} has no effect while disable_all_reencoding is set", stacklevel=3)
        if self.enable_wandb:
            warnings.warn("there is no telemetry; see streaming.monitor for reports", stacklevel=3)
        if self.distributor != "pyspark":
            warnings.warn("Spark is the only engine; distributor is ignored", stacklevel=3)
