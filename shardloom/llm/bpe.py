"""BPE encoding and decoding with a given vocabulary file (never trained here).

Symbols of a pre-token form a doubly linked list. A heap holds the possible merges by (rank, place); an entry whose
symbols have changed since it was pushed is stale and skipped. Decoding joins the vocabulary's strings.

Defined cases: a null text is the empty text (no ids, empty decoded text); white space yields no ids; a special
token's exact string in a text is that token's id; a text without white space is one pre-token list, merged in
O(n log n); very long texts are encoded whole. Repeated rows each get their row; an empty table gives an empty result.
Extra columns pass through, those with an output's name give way to it, and one named `_ll_bpe` is refused.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import struct
import unicodedata

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: A vocabulary file larger than this is not broadcast.
MOST_VOCABULARY_BYTES = 256 << 20
#: Chunks whose ids a worker keeps, in each of two generations.
KEPT_CHUNKS = 200_000
#: Characters that Python's split() takes for white space and \s of the vocabulary's pattern does not.
NOT_SPACE = re.compile("[\x1c-\x1f]")
SPACE = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+")


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself if it is printable Latin-1, else the next code point from 256."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in shown)
    table = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [table[b] for b in range(256)]


class Tokenizer:
    """What the vocabulary file says, for texts cut at white space into chunks."""

    def __init__(self, blob: bytes):
        spec = json.loads(blob)
        model = spec["model"]
        self.ids = dict(model["vocab"])
        self.suffix = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        self.strings = {i: s for s, i in self.ids.items()} | {i: s for s, i in self.special.items()}
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[self.ids[left], self.ids[right]] = (rank, self.ids[left + right])
        self.pattern = regex.compile(next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"))
        self.at_special = re.compile("|".join(map(re.escape, self.special)) or r"(?!)")
        self.bytes = byte_symbols()
        self.kept: dict[str, tuple[bytes, str]] = common.Kept(self.encode_chunk, KEPT_CHUNKS)

    def merge(self, ids: list[int]) -> list[int]:
        """Merge neighbours, lowest rank first and leftmost among equals, until no pair has a rank."""
        n = len(ids)
        if n < 2:
            return ids
        merges, before, after = self.merges, [*range(-1, n - 1)], [*range(1, n), -1]
        heap = [(m[0], i, m[1], ids[i], ids[i + 1]) for i in range(n - 1) if (m := merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, new, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j < 0 or ids[j] != right:
                continue  # stale: one of its symbols has been merged meanwhile
            ids[i], ids[j] = new, -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if m := merges.get((new, ids[k])):
                    heapq.heappush(heap, (m[0], i, m[1], new, ids[k]))
            if (h := before[i]) >= 0 and (m := merges.get((ids[h], new))):
                heapq.heappush(heap, (m[0], h, m[1], ids[h], new))
        return [x for x in ids if x >= 0]

    def encode_chunk(self, chunk: str) -> tuple[bytes, str]:
        """The ids of a chunk as little-endian 32-bit integers, and the decoded text."""
        plain = chunk if chunk.isascii() else unicodedata.normalize("NFC", chunk)
        plain = plain.lower() if "Σ" not in plain else plain.replace("Σ", "σ").lower()
        ids, table, symbols = [], self.ids, self.bytes
        # letters, and perhaps one mark after them: what the pattern finds is plain
        whole = [plain] if plain.isalpha() else [plain[:-1], plain[-1]] if plain[-1] in ".,;:!?" and plain[:-1].isalpha() else None
        for piece in whole or self.pattern.findall(plain):
            marks = [symbols[b] for b in piece.encode()]
            marks[-1] += self.suffix
            ids += self.merge([table[m] for m in marks if m in table])
        return struct.pack(f"<{len(ids)}I", *ids), " ".join(map(self.strings.__getitem__, ids))

    def parts(self, text: str) -> list[tuple[bytes, str]]:
        def plain(segment: str) -> list[tuple[bytes, str]]:
            cut = segment.split() if not NOT_SPACE.search(segment) else [c for c in SPACE.split(segment) if c]
            return [*map(self.kept.__getitem__, cut)]

        if "<|" not in text and all("<|" in s for s in self.special):
            return plain(text)
        found, at = [], 0
        for m in self.at_special.finditer(text):
            found += plain(text[at : m.start()])
            found.append((self.special[m[0]].to_bytes(4, "little"), m[0]))
            at = m.end()
        return found + plain(text[at:])

    def encode(self, text: str | None) -> bytes:
        return b"".join([p[0] for p in self.parts(text or "")])

    def decode(self, ids: bytes) -> str:
        return " ".join([self.strings[int.from_bytes(ids[i : i + 4], "little")] for i in range(0, len(ids), 4)])

    def encode_and_decode(self, text: str | None) -> tuple[bytes, str]:
        parts = self.parts(text or "")
        return b"".join([p[0] for p in parts]), " ".join([p[1] for p in parts if p[0]])


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def load(spark: SparkSession, path: str | None = None):
    """The vocabulary file, read by the driver and broadcast: its size is fixed by the vocabulary, and checked."""
    with open(path or default_path(), "rb") as f:
        blob = f.read(MOST_VOCABULARY_BYTES + 1)
    if len(blob) > MOST_VOCABULARY_BYTES:
        raise ValueError(f"the vocabulary file has more than {MOST_VOCABULARY_BYTES} bytes")
    return spark.sparkContext.broadcast(blob)


def worker_tokenizer(blob) -> Tokenizer:
    return common.per_worker(lambda: Tokenizer(blob.value), "bpe" + common.digest_of(blob.value), "bpe")


def encoder(spark: SparkSession, path: str | None = None, ids: bool = True):
    """Column function text -> struct(ids array<int>?, n_tokens, ids_sha256, decoded_sha256)."""
    blob = load(spark, path)

    def work(texts: pa.Array) -> pa.Array:
        t = worker_tokenizer(blob)
        n, idsha, decsha, offsets, lists = [], [], [], [0], []
        for text in texts.to_pylist():
            raw, decoded = t.encode_and_decode(text)
            n.append(len(raw) // 4)
            idsha.append(hashlib.sha256(raw).hexdigest())
            decsha.append(hashlib.sha256(decoded.encode()).hexdigest())
            if ids:
                lists.append(raw)
                offsets.append(offsets[-1] + len(raw) // 4)
        columns, names = [pa.array(n, pa.int64()), pa.array(idsha, pa.string()), pa.array(decsha, pa.string())], ["n_tokens", "ids_sha256", "decoded_sha256"]
        if ids:
            values = pa.Array.from_buffers(pa.int32(), offsets[-1], [None, pa.py_buffer(b"".join(lists))])
            columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values))
            names.append("ids")
        return pa.StructArray.from_arrays(columns, names)

    return F.arrow_udf(work, "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids)


def decoder(spark: SparkSession, path: str | None = None):
    """Column function ids array<int> -> the decoded text; null ids are none."""
    blob = load(spark, path)

    def work(lists: pa.Array) -> pa.Array:
        t = worker_tokenizer(blob)
        return pa.array([" ".join([t.strings[i] for i in ids or ()]) for ids in lists.to_pylist()], pa.string())

    return F.arrow_udf(work, "string")


def encode(docs: DataFrame, path: str | None = None, ids: bool = True) -> DataFrame:
    """docs with n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids; columns of docs with these names give
    way. No shuffle: each row is worked on where it is read."""
    common.refuse(docs, "_ll_bpe")
    new = ["n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * ids]
    return docs.withColumn("_ll_bpe", encoder(docs.sparkSession, path, ids)("text")).select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in new], *[F.col(f"_ll_bpe.{c}").alias(c) for c in new])


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(common.read(spark, sf_dir, "documents").select("doc_id", "text"), ids=False).drop("text")

