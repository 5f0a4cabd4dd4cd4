"""Pixels: kind and dimensions from a payload's first bytes, gates, resizing and encoding.

Kind and gates are column expressions; dimensions are read from the headers of PNG, GIF, JPEG and WebP by an Arrow
function, without decoding. Resizing decodes with a codec: PNG of 8 bits is built in, others are passed in as functions.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import RESIZE_MODES, interpolation
from . import classify

DECODING, NO_BLURRER = "Image decoding error", "blurrer not defined"
#: Kinds as encode_format names them.
KINDS = {"jpg": "jpeg", "jpeg": "jpeg", "png": "png", "webp": "webp", "gif": "gif"}


def kind(payload: Column) -> Column:
    """jpeg, png, gif or webp by the first bytes, else null."""
    head = F.hex(F.substring(payload, 1, 12))
    return F.when(head.startswith("FFD8FF"), "jpeg").when(head.startswith("89504E470D0A1A0A"), "png").when(head.startswith("47494638"), "gif").when(head.startswith("52494646") & head.endswith("57454250"), "webp")


def header_size(data: bytes | None) -> tuple[int, int] | None:
    """Width and height as a file's header tells them; none if it tells nothing."""
    try:
        if not data:
            return None
        if data[:8] == b"\x89PNG\r\n\x1a\n":
            return struct.unpack(">II", data[16:24])
        if data[:4] == b"GIF8":
            return struct.unpack("<HH", data[6:10])
        if data[:2] == b"\xff\xd8":
            at = 2
            while at + 9 <= len(data) and data[at] == 0xFF:
                mark = data[at + 1]
                if mark == 0xFF or 0xD0 <= mark <= 0xD8 or mark == 1:
                    at += 1 if mark == 0xFF else 2
                elif 0xC0 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC):
                    return struct.unpack(">HH", data[at + 5 : at + 9])[::-1]
                else:
                    at += 2 + struct.unpack(">H", data[at + 2 : at + 4])[0]
            return None
        if data[:4] == b"RIFF" and data[8:12] == b"WEBP":
            if data[12:16] == b"VP8X":
                return int.from_bytes(data[24:27], "little") + 1, int.from_bytes(data[27:30], "little") + 1
            if data[12:16] == b"VP8L":
                bits = int.from_bytes(data[21:25], "little")
                return (bits & 0x3FFF) + 1, (bits >> 14 & 0x3FFF) + 1
            if data[12:16] == b"VP8 ":
                w, h = struct.unpack("<HH", data[26:30])
                return w & 0x3FFF, h & 0x3FFF
    except struct.error:
        pass
    return None


def _sizes(payloads: pa.Array) -> pa.Array:
    found = [header_size(x) for x in payloads.to_pylist()]
    return pa.array([None if s is None else {"width": s[0], "height": s[1]} for s in found], pa.struct([("width", pa.int64()), ("height", pa.int64())]))


def with_dimensions(df: DataFrame, payload: str) -> DataFrame:
    """df with original_width and original_height; null where the header tells nothing."""
    size = F.arrow_udf(_sizes, "width long, height long")(F.substring(payload, 1, 1 << 16))
    return df.withColumn("_size", size).withColumns({"original_width": F.col("_size.width"), "original_height": F.col("_size.height")}).drop("_size")


def gated(df: DataFrame, payload: str, min_size: int = 0, max_area: float = math.inf, max_aspect: float = math.inf) -> DataFrame:
    """df (with error_message and dimensions): pictures that a gate stops lose their payload and get the gate's error."""
    error = classify.image_error(F.col("original_width"), F.col("original_height"), min_size, max_area, max_aspect)
    told = df.withColumn("_error", F.when(F.col(payload).isNotNull(), error))
    return told.withColumns({"error_message": F.coalesce("error_message", "_error"), payload: F.when(F.col("_error").isNull(), F.col(payload))}).drop("_error")


# --- the built-in codec ---------------------------------------------------------------------------------------------

_CHANNELS = {0: 1, 2: 3, 4: 2, 6: 4}


def decode_png(data: bytes) -> np.ndarray:
    """Pixels (height, width, channels) of a PNG of 8 bits without interlacing and palette."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError(DECODING)
    at, packed, head = 8, b"", None
    while at + 8 <= len(data):
        size, name = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + size]
        if name == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif name == b"IDAT":
            packed += body
        at += 12 + size
    if head is None or head[2] != 8 or head[3] not in _CHANNELS or head[6]:
        raise ValueError(DECODING)
    width, height, n = head[0], head[1], _CHANNELS[head[3]]
    try:
        raw = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(height, width * n + 1)
    except (zlib.error, ValueError) as e:
        raise ValueError(DECODING) from e
    how, lines = raw[:, 0], raw[:, 1:]
    if (how > 2).any():
        return along_diagonals(how, lines.reshape(height, width, n))
    out, above = np.zeros((height, width * n), np.uint8), np.zeros(width * n, np.int64)
    for y in range(height):
        line = lines[y].astype(np.int64)
        if how[y] == 2:
            line = line + above
        elif how[y] == 1:
            line = np.cumsum(line.reshape(width, n), axis=0).ravel()
        out[y] = above = line & 255
    return out.reshape(height, width, n)


def along_diagonals(how: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """Pixels of filtered lines (height, width, channels), whatever filter each line has. A pixel needs the ones on its left,
    above it and between them, so the pixels of a diagonal are worked out together."""
    height, width, n = lines.shape
    out = np.zeros((height + 1, width + 1, n), np.int16)  # with a line and a column of zeros before the first
    for d in range(height + width - 1):
        y = np.arange(max(0, d - width + 1), min(height, d + 1))
        x = d - y
        left, above, corner, kind = out[y + 1, x], out[y, x + 1], out[y, x], how[y][:, None]
        by_left, by_above, by_corner = (np.abs(g) for g in (above - corner, left - corner, left + above - 2 * corner))
        nearest = np.where((by_left <= by_above) & (by_left <= by_corner), left, np.where(by_above <= by_corner, above, corner))
        guess = np.select([kind == 1, kind == 2, kind == 3, kind == 4], [left, above, (left + above) >> 1, nearest], 0)
        out[y + 1, x + 1] = (lines[y, x] + guess) & 255
    return out[1:, 1:].astype(np.uint8)


def encode_png(pixels: np.ndarray, quality: int = 6) -> bytes:
    """A PNG of 8 bits; quality is the level of compression, 0 to 9."""
    pixels = pixels if pixels.ndim == 3 else pixels[..., None]
    height, width, n = pixels.shape
    chunk = lambda name, body: struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))
    lines = np.concatenate([np.zeros((height, 1), np.uint8), pixels.astype(np.uint8).reshape(height, -1)], axis=1)
    head = struct.pack(">IIBBBBB", width, height, 8, {v: k for k, v in _CHANNELS.items()}[n], 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines.tobytes(), min(quality, 9))) + chunk(b"IEND", b"")


def on_white(pixels: np.ndarray) -> np.ndarray:
    """Pictures with an alpha channel laid on white."""
    if pixels.ndim != 3 or pixels.shape[-1] != 4:
        return pixels
    alpha = pixels[..., 3:].astype(np.float64)
    return np.rint(np.clip(alpha / 255 * pixels[..., :3] + 255 - alpha, 0, 255)).astype(np.uint8)


def _weights(old: int, new: int, how: str) -> np.ndarray:
    """Rows: the share of each old place in each new one."""
    out, scale = np.zeros((new, old)), old / new
    for i in range(new):
        if how == "nearest":
            out[i, min(int((i + 0.5) * scale), old - 1)] = 1
        elif how == "area" and scale > 1:
            a, b = i * scale, (i + 1) * scale
            for j in range(int(a), min(math.ceil(b), old)):
                out[i, j] = min(b, j + 1) - max(a, j)
        else:
            reach = {"cubic": 2, "bicubic": 2, "lanczos": 4, "lanczos4": 4}.get(how, 1)
            at = (i + 0.5) * scale - 0.5
            for j in range(math.floor(at) - reach + 1, math.floor(at) + reach + 1):
                d = abs(at - j)
                if reach == 1:
                    v = max(1 - d, 0)
                elif reach == 2:
                    v = 1.25 * d**3 - 2.25 * d * d + 1 if d < 1 else -0.75 * d**3 + 3.75 * d * d - 6 * d + 3 if d < 2 else 0
                else:
                    v = float(np.sinc(d) * np.sinc(d / 4)) if d < 4 else 0
                out[i, min(max(j, 0), old - 1)] += v
    return out / out.sum(1, keepdims=True)


def scaled(pixels: np.ndarray, width: int, height: int, how: str) -> np.ndarray:
    rows, columns = _weights(pixels.shape[0], height, how), _weights(pixels.shape[1], width, how)
    return np.rint(np.clip(np.einsum("ij,kl,jlc->ikc", rows, columns, pixels.astype(np.float64), optimize=True), 0, 255)).astype(np.uint8)


@dataclass
class Resizer:
    """Settings of a resize; a call takes bytes to (bytes, width, height, original width, original height, error)."""

    size: int = 256
    mode: str = "border"
    only_if_bigger: bool = False
    up: str = "lanczos"
    down: str = "area"
    encode_format: str = "png"
    quality: int = 6
    skip_reencode: bool = False
    disable_all_reencoding: bool = False
    min_size: int = 0
    max_area: float = math.inf
    max_aspect: float = math.inf
    blurrer: Callable | None = None
    decoders: dict[str, Callable] = field(default_factory=dict)
    encoders: dict[str, Callable] = field(default_factory=dict)

    def __post_init__(self):
        if self.mode not in RESIZE_MODES:
            raise ValueError(f"Invalid resize mode {self.mode}")
        if self.encode_format not in ("jpg", "png", "webp"):
            raise ValueError(f"Invalid encode format {self.encode_format}")
        if not 0 <= self.quality <= (9 if self.encode_format == "png" else 100):
            raise ValueError("quality is out of the range of the format")
        self.up, self.down = interpolation(self.up), interpolation(self.down)
        self.decoders = {"png": decode_png} | self.decoders
        self.encoders = {"png": encode_png} | self.encoders

    def resized(self, pixels: np.ndarray, boxes) -> tuple[np.ndarray, bool]:
        height, width = pixels.shape[:2]
        crops = self.mode in ("keep_ratio", "center_crop")
        side = min(width, height) if crops else max(width, height)
        acts = self.mode != "no" and (side > self.size or not self.only_if_bigger)
        if acts:
            w, h = (max(1, math.floor(x * self.size / side + 0.5)) for x in (width, height))
            pixels = scaled(pixels, w, h, self.down if side > self.size else self.up)
        if boxes is not None:
            pixels = self.blurrer(img=pixels, bbox_list=boxes)
        if acts and self.mode == "center_crop":
            top, left = (pixels.shape[0] - self.size) // 2, (pixels.shape[1] - self.size) // 2
            pixels = pixels[top : top + self.size, left : left + self.size]
        if acts and self.mode == "border":
            gaps = [self.size - n for n in pixels.shape[:2]]
            pixels = np.pad(pixels, [(g // 2, g - g // 2) for g in gaps] + [(0, 0)], constant_values=255)
        return pixels, acts or boxes is not None

    def __call__(self, data: bytes | None, boxes=None):
        nothing = (None, None, None, None, None)
        if data is None:
            return *nothing, None
        if self.disable_all_reencoding:
            return data, None, None, None, None, None
        try:
            found = next((k for k, magic in (("png", b"\x89PNG"), ("jpeg", b"\xff\xd8\xff"), ("gif", b"GIF8"), ("webp", b"RIFF")) if data.startswith(magic)), None)
            if found not in self.decoders:
                raise ValueError(DECODING)
            pixels = self.decoders[found](data)
            plain = on_white(pixels)
            changed = plain is not pixels or not self.skip_reencode or found != KINDS[self.encode_format]
            height, width = plain.shape[:2]
            for bad, error in ((min(width, height) < self.min_size, classify.TOO_SMALL), (width * height > self.max_area, classify.AREA_TOO_LARGE), (max(width, height) / min(width, height) > self.max_aspect, classify.ASPECT_TOO_LARGE), (boxes is not None and self.blurrer is None, NO_BLURRER)):
                if bad:
                    return *nothing, error
            out, acted = self.resized(plain, boxes)
            data = self.encoders[self.encode_format](out, self.quality) if changed or acted else data
            return data, out.shape[1], out.shape[0], width, height, None
        except Exception as e:  # a picture that cannot be worked on fails alone
            return *nothing, str(e) or type(e).__name__


_RESULT = "payload binary, width long, height long, original_width long, original_height long, error string"


def resize(df: DataFrame, payload: str, resizer: Resizer, boxes: str | None = None) -> DataFrame:
    """df (with error_message): payloads resized, with width, height, original_width and original_height. boxes: a column
    of boxes that the resizer's blurrer is given."""

    def work(payloads: pa.Array, boxed: pa.Array) -> pa.Array:
        names = [n.split(" ")[0] for n in _RESULT.split(", ")]
        kinds = [pa.binary(), *[pa.int64()] * 4, pa.string()]
        rows = [resizer(x.as_py(), b.as_py()) for x, b in zip(payloads, boxed, strict=True)]
        columns = list(zip(*rows, strict=True)) or [()] * 6
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    told = df.withColumn("_out", F.arrow_udf(work, _RESULT)(payload, boxes if boxes else F.lit(None).cast("string")))
    columns = {c: F.col(f"_out.{c}") for c in ("width", "height", "original_width", "original_height")}
    return told.withColumns({"error_message": F.coalesce("error_message", "_out.error"), payload: F.col("_out.payload")} | columns).drop("_out")
