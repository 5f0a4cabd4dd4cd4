"""Aligning the tokens of two tokenizers, and how often their ids go together in a corpus.

A is a byte-level vocabulary applied to a space and the text, B a piece vocabulary applied to the text (it adds the space
itself), so both cut the same bytes. Each token's end is the running sum of its bytes; two pointers that go through the
sorted ends of A and B meet wherever both end, and these places cut the tokens into groups. The merge is done for the
texts of a chunk at once: their bytes are laid end to end, and since both tokenizers end where a text ends, no group goes
over a text. Every A token of a group is linked to every B token of it.

Words repeat. Where A splits by the usual pattern and no piece of B goes over a blank, both tokenizers end a token before a
blank that stands alone between characters that are none, so no group goes over it: a worker aligns each distinct word
once, and a text is put together from its words. Texts with other blanks at the ends of words, with U+2581 or with words of
WORD_CHARS characters or more are aligned whole.

Spark counts: a document's distinct id pairs are counted by block of documents, then over the corpus; the highest count of
each id of A and of B is joined to the pairs (as many rows as the vocabularies have ids, so they are broadcast), and counts
come back to each block once for each pair that the block holds, not once for each document. In the end a block's documents
and its pairs meet in one group of bounded size. A task of the scan closes a block at BLOCK_LINKS pairs, so no group grows
with the corpus or with a hot key; a frequent pair has a row for each block, which joins of freshly exchanged tables split.

Defined cases: null and empty texts, and texts whose joined tokens are not the space and the text (those that B changes,
such as ones with U+2581), have no tokens, zeros and an empty groups_sha256; special tokens' strings are plain text; rows
that repeat are documents of their own; an empty table gives an empty result. A very long text is worked on whole in one
task, as its tokenizers ask, and is a block of its own. Only the id column and text are read of docs, so further columns may
have any names; an id goes through pandas as text, so that no id and no null changes.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Distinct pairs of its documents that close a block (one document may hold more).
BLOCK_LINKS = 1_000_000
#: Vocabulary files beyond this are refused.
MOST_VOCABULARY_BYTES = 50_000_000
#: Characters of the texts that are worked on at a time, about.
CHUNK_CHARS = 1_000_000
#: Links of a group beyond which equal ids are put together before they are laid out.
LARGE_GROUP = 4_096
#: Shorter words are aligned once; so many of them that a worker keeps between chunks.
WORD_CHARS, MOST_WORDS = 256, 150_000
#: Texts with a run of as many characters, blank or not, take the slower of A's two encoders, which has no stack to exceed.
LONG_RUN = re.compile(r"\S{2000}|\s{500}")
OWN = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
COUNTED = ["n_best", "count_sum", "n_best_b"]


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: itself where it is printable Latin-1, else the
    next of those from U+0100."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteTokenizer:
    """A: a byte-level vocabulary file of the tokenizers library. Where its ids are in order of its merges and it splits
    by the usual pattern, as here, the ranks alone give the same ids three times as fast."""

    def __init__(self, blob: bytes):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_str(blob.decode())
        self.slow.encode_special_tokens = True
        self.slow.no_truncation()
        self.slow.no_padding()
        said, of = json.loads(blob), byte_alphabet()
        vocabulary = said["model"]["vocab"]
        special = {t["content"] for t in said.get("added_tokens") or () if t.get("special")}
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = b"" if token in special else bytes(of[c] for c in token)
        self.fast = None
        merges = [m if isinstance(m, str) else " ".join(m) for m in said["model"]["merges"]]
        ordered = [vocabulary.get(m.replace(" ", ""), -1) for m in merges]
        pre = said.get("pre_tokenizer") or {}
        if pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not said.get("normalizer") and ordered == [*range(256, 256 + len(merges))]:
            import public_tokenizers
            import tiktoken

            ranks = {b: i for i, b in enumerate(self.bytes) if b}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        out = [None if self.fast is None or LONG_RUN.search(t) else self.fast.encode_ordinary(t) for t in texts]
        return [self.slow.encode(t, add_special_tokens=False).ids if ids is None else ids for t, ids in zip(texts, out, strict=True)]


class PieceTokenizer:
    """B: a piece vocabulary with byte fallback."""

    def __init__(self, blob: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.model = sentencepiece.SentencePieceProcessor(model_proto=blob)
        piece = lambda i: bytes([int(self.model.id_to_piece(i)[3:-1], 16)]) if self.model.is_byte(i) else b"" if self.model.is_control(i) or self.model.is_unknown(i) else self.model.id_to_piece(i).replace("▁", " ").encode()
        self.bytes = [piece(i) for i in range(self.model.get_piece_size())]
        said = sentencepiece_model_pb2.ModelProto.FromString(blob)
        plain = said.trainer_spec.model_type == said.trainer_spec.BPE and said.normalizer_spec.name == "identity" and said.normalizer_spec.add_dummy_prefix
        #: whether words between single blanks have the pieces that they have alone
        self.by_word = plain and not any("▁" in p.piece.lstrip("▁") for p in said.pieces)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1) if texts else []


class Words(dict):
    """Numbers of words from 1 on, and the words that are new; 0 for those that cannot be aligned on their own."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        if not word or len(word) >= WORD_CHARS or word[0].isspace() or word[-1].isspace() or "▁" in word:
            return 0
        self.new.append(word)
        self[word] = number = len(self) + 1
        return number


class Aligner:
    """Both tokenizers with what the merge needs of their tokens."""

    def __init__(self, a: bytes, b: bytes):
        self.a, self.b = ByteTokenizer(a), PieceTokenizer(b)
        self.lengths = [np.array([*map(len, t.bytes)], np.int64) for t in (self.a, self.b)]
        self.width = len(self.b.bytes)  # a pair is id of A * width + id of B
        # every token's number with what stands behind it: , within a side, | and ; at its end
        self.strings = [f"{i}{mark}" for n, marks in ((len(self.a.bytes), ",|"), (len(self.b.bytes), ",;")) for mark in marks for i in range(n)]
        self.offsets = np.cumsum([0, len(self.a.bytes), len(self.a.bytes), len(self.b.bytes)])
        self.by_word = self.a.fast is not None and self.b.by_word and len(self.a.bytes) * self.width < 1 << 32
        self.forget()

    def forget(self) -> None:
        """Let all words go. Number 0 has no tokens."""
        self.words, self.said = Words(), [""]
        self.own = {c: np.zeros(1, np.int64) for c in OWN[:-1]}
        self.heads, self.pairs, self.times = np.zeros(2, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def tokens(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Both id arrays of each text; empty ones where a text has no tokens."""
        some = [t for t in texts if t]
        found = iter(zip(self.a.encode([" " + t for t in some]), self.b.encode(some), strict=True))
        out = []
        for t in texts:
            ids = next(found) if t else ([], [])
            if t:
                whole = b" " + t.encode()
                if b"".join(map(self.a.bytes.__getitem__, ids[0])) != whole or b"".join(map(self.b.bytes.__getitem__, ids[1])) != whole:
                    ids = ([], [])
            out.append((np.array(ids[0], np.int64), np.array(ids[1], np.int64)))
        return out

    def merge(self, ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ends that both lists have, and the group of each token of A and of B. Both lists rise."""
        at = np.searchsorted(ends_b, ends_a)
        met = ends_a[(at < len(ends_b)) & (ends_b[np.minimum(at, len(ends_b) - 1)] == ends_a)] if len(ends_b) else ends_a[:0]
        return met, np.searchsorted(met, ends_a), np.searchsorted(met, ends_b)

    def links(self, ids_a, ids_b, n_a, n_b, doc) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(doc, pair, times) of the links of groups: ids in order of groups, tokens of A and B in each, document of each.
        Groups of many links have their equal ids put together first."""
        first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        large = n_a * n_b > LARGE_GROUP
        small_a = ~np.repeat(large, n_a)
        group = np.repeat(np.arange(len(n_a)), n_a)[small_a]
        times = n_b[group]
        of_a = np.repeat(ids_a[small_a], times)
        place = np.arange(len(of_a)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(first_b[group], times)
        yield np.repeat(doc[group], times), of_a * self.width + ids_b[place], np.ones(len(of_a), np.int64)
        for g in np.flatnonzero(large):
            ua, ca = np.unique(ids_a[first_a[g] : first_a[g] + n_a[g]], return_counts=True)
            ub, cb = np.unique(ids_b[first_b[g] : first_b[g] + n_b[g]], return_counts=True)
            pairs = (ua[:, None] * self.width + ub).ravel()
            yield np.full(len(pairs), doc[g]), pairs, np.outer(ca, cb).ravel()

    def laid(self, ids: list[np.ndarray], sizes: list[np.ndarray]) -> tuple[dict, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Of texts, or words, with their ids of A and B one after the other and the number of each one's ids: counts, groups
        as a string, and the distinct pairs of all in order with the number of their links and where each one's begin."""
        n = len(sizes[0])
        ends = [np.cumsum(length[x]) for length, x in zip(self.lengths, ids, strict=True)]
        met, group_a, group_b = self.merge(*ends)
        n_a, n_b = np.bincount(group_a, minlength=len(met)), np.bincount(group_b, minlength=len(met))
        doc_of_a = np.repeat(np.arange(n), sizes[0])
        doc = doc_of_a[np.cumsum(n_a) - 1] if len(met) else np.zeros(0, np.int64)
        n_groups = np.bincount(doc, minlength=n)
        n_links = np.bincount(doc, n_a * n_b, n).astype(np.int64)
        # the tokens of both sides in order of groups, each as its number and the mark behind it
        last = [np.zeros(len(x), bool) for x in ids]
        for mark, k in zip(last, (n_a, n_b), strict=True):
            mark[np.cumsum(k) - 1] = True
        merged = np.zeros(len(ids[0]) + len(ids[1]), np.int64)
        merged[np.arange(len(ids[0])) + (np.cumsum(n_b) - n_b)[group_a]] = ids[0] + np.where(last[0], self.offsets[1], 0)
        merged[np.arange(len(ids[1])) + np.cumsum(n_a)[group_b]] = ids[1] + np.where(last[1], self.offsets[3], self.offsets[2])
        stops = np.cumsum(sizes[0] + sizes[1])
        said = [*map(self.strings.__getitem__, merged.tolist())]
        said = ["".join(said[start:stop])[:-1] for start, stop in zip((stops - sizes[0] - sizes[1]).tolist(), stops.tolist(), strict=True)]
        of_doc, pairs, times = (np.concatenate(x) for x in zip(*self.links(ids[0], ids[1], n_a, n_b, doc), strict=True))
        order = np.lexsort((pairs, of_doc))
        of_doc, pairs, times = of_doc[order], pairs[order], times[order]
        new = np.ones(len(pairs), bool)
        new[1:] = (pairs[1:] != pairs[:-1]) | (of_doc[1:] != of_doc[:-1])
        starts = np.flatnonzero(new)
        times = np.add.reduceat(times, starts) if len(starts) else times
        heads = np.searchsorted(of_doc[starts], np.arange(n + 1))
        return dict(zip(OWN, (*sizes, n_groups, n_links), strict=False)), said, pairs[starts], times, heads

    def learned(self) -> bool:
        """Align the new words, laid end to end with blanks between them; False where they are not what the tokens say."""
        some = self.words.new
        if not some:
            return True
        (ids,) = self.tokens([" ".join(some)])
        if not len(ids[0]):
            return False
        self.words.new = []
        stops = np.cumsum([len(w.encode()) + 1 for w in some])
        sizes = [np.bincount(np.searchsorted(stops, np.cumsum(length[x])), minlength=len(some)) for length, x in zip(self.lengths, ids, strict=True)]
        own, said, pairs, times, heads = self.laid([*ids], sizes)
        self.own = {c: np.concatenate([self.own[c], own[c]]) for c in self.own}
        self.said += said
        self.heads = np.concatenate([self.heads, self.heads[-1] + heads[1:]])
        self.pairs, self.times = np.concatenate([self.pairs, pairs]), np.concatenate([self.times, times])
        return True

    def from_words(self, texts: list[str | None]) -> tuple[pd.DataFrame, np.ndarray]:
        """The rows of the texts put together from their words, and which texts that cannot be done for."""
        if len(self.words) > MOST_WORDS:
            self.forget()
        lists = [t.split(" ") if t else [] for t in texts]
        sizes = np.array([*map(len, lists)], np.int64)
        number = np.fromiter(map(self.words.__getitem__, chain.from_iterable(lists)), np.int64, int(sizes.sum()))
        doc = np.repeat(np.arange(len(texts)), sizes)
        whole = np.bincount(doc, number == 0, len(texts)) > 0
        if not self.learned():
            self.forget()
            whole = sizes > 0
        number, doc = number[~whole[doc]], doc[~whole[doc]]
        ends = np.cumsum(np.where(whole, 0, sizes)).tolist()
        rows = {c: np.bincount(doc, of[number], len(texts)).astype(np.int64) for c, of in self.own.items()}
        said = [*map(self.said.__getitem__, number.tolist())]
        rows["groups_sha256"] = [hashlib.sha256(";".join(said[a:b]).encode()).hexdigest() if b > a else "" for a, b in zip([0, *ends], ends, strict=False)]
        # words once for each text, then their pairs once for each text
        keys, held = _counted(doc << 32 | number, None)
        doc, number = keys >> 32, keys & 0xFFFFFFFF
        n = self.heads[number + 1] - self.heads[number]
        place = np.arange(n.sum()) + np.repeat(self.heads[number] - np.cumsum(n) + n, n)
        keys, times = _counted(np.repeat(doc, n) << 32 | self.pairs[place], np.repeat(held, n) * self.times[place])
        cuts = np.searchsorted(keys, np.arange(1, len(texts)) << 32)
        return pd.DataFrame(rows | {"pairs": np.split(keys & 0xFFFFFFFF, cuts), "times": np.split(times, cuts)}), whole

    def aligned(self, texts: list[str | None]) -> pd.DataFrame:
        """A row for each text: OWN, and its distinct pairs in order with the number of their links."""
        rows, whole = self.from_words(texts) if self.by_word else (None, np.ones(len(texts), bool))
        if not whole.any():
            return rows
        some = [t for t, w in zip(texts, whole, strict=True) if w]
        found = self.tokens(some)
        sizes = [np.array([len(f[k]) for f in found], np.int64) for k in (0, 1)]
        own, said, pairs, times, heads = self.laid([np.concatenate([f[k] for f in found]) for k in (0, 1)], sizes)
        shas = [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in said]
        rest = pd.DataFrame(own | {"groups_sha256": shas, "pairs": np.split(pairs, heads[1:-1]), "times": np.split(times, heads[1:-1])})
        if rows is None or whole.all():
            return rest
        place = np.where(whole, len(rows) + np.cumsum(whole) - 1, np.arange(len(rows)))
        return pd.concat([rows, rest], ignore_index=True).take(place).reset_index(drop=True)


def _counted(keys: np.ndarray, times: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how many there are of each, or the sums of their times."""
    if times is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys)
        keys, times = keys[order], times[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
    return keys[starts], np.diff(np.append(starts, len(keys))) if times is None else np.add.reduceat(times, starts) if len(starts) else times


def files(spark: SparkSession, a: str | None = None, b: str | None = None):
    """Both vocabulary files, read by the driver and broadcast; their size is checked."""
    import public_tokenizers

    blobs = []
    for path in (a or public_tokenizers.path(A_FILE), b or public_tokenizers.path(B_FILE)):
        with open(path, "rb") as f:
            blobs.append(f.read(MOST_VOCABULARY_BYTES + 1))
        if len(blobs[-1]) > MOST_VOCABULARY_BYTES:
            raise ValueError(f"the vocabulary file has more than {MOST_VOCABULARY_BYTES} bytes")
    return spark.sparkContext.broadcast(blobs)


def with_pairs(docs: DataFrame, id: str = "doc_id", a: str | None = None, b: str | None = None) -> DataFrame:
    """id (as text), OWN, block, pairs (distinct id pairs, in order) and times (links of each). Written to the shared folder,
    so that blocks stay what they are."""
    blobs = files(docs.sparkSession, a, b)

    def work(frames):
        aligner = common.per_worker(lambda: Aligner(*blobs.value), "align" + common.digest_of(b"".join(blobs.value)), "align")
        block, held = uuid.uuid4().int >> 65, 0
        for frame in frames:
            at = 0
            for chunk in common.chunks([t if isinstance(t, str) else "" for t in frame["text"]], CHUNK_CHARS):
                rows, blocks = aligner.aligned(chunk), []
                for n in map(len, rows["pairs"]):
                    if held and held + n > BLOCK_LINKS:
                        block, held = uuid.uuid4().int >> 65, 0
                    held += n
                    blocks.append(block)
                yield rows.assign(id=frame["id"].to_numpy()[at : at + len(chunk)], block=np.array(blocks, np.int64))
                at += len(chunk)

    kinds = {"groups_sha256": "string", "pairs": "array<long>", "times": "array<long>"}
    schema = "id string, block long, " + ", ".join(f"{c} {kinds.get(c, 'long')}" for c in [*OWN, "pairs", "times"])
    return common.cut(docs.select(F.col(f"`{id}`").cast("string").alias("id"), "text").mapInPandas(work, schema), "aligned")


def pair_counts(held: DataFrame, width: int) -> DataFrame:
    """held (pair, n) -> pair, count, best, best_b: the documents that hold an id pair, and whether that is the highest count
    of its A id and of its B id."""
    totals = common.cut(held.groupBy("pair").agg(F.sum("n").alias("count")), "pair-counts")
    ids = totals.withColumns({"a": F.expr(f"pair div {width}"), "b": F.expr(f"pair % {width}")})
    most = lambda side: F.broadcast(ids.groupBy(side).agg(F.max("count").alias(f"most_{side}")))  # noqa: E731  a row for each id of a vocabulary
    told = ids.join(most("a"), "a").join(most("b"), "b")
    return told.select("pair", "count", (F.col("count") == F.col("most_a")).alias("best"), (F.col("count") == F.col("most_b")).alias("best_b"))


def _summed(key, docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """A block's documents with n_best, count_sum and n_best_b; pairs: those of the block with their counts."""
    order = np.argsort(pairs["pair"].to_numpy())
    codes = pairs["pair"].to_numpy()[order]
    lists, times = docs["pairs"].combine_chunks(), docs["times"].combine_chunks()
    sizes = np.array(lists.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    place = np.searchsorted(codes, lists.flatten().to_numpy())
    weight, row = times.flatten().to_numpy(), np.repeat(np.arange(len(sizes)), sizes)
    out = docs.drop_columns(["block", "pairs", "times"])
    for name, column in zip(COUNTED, ("best", "count", "best_b"), strict=True):
        by_pair = pairs[column].to_numpy().astype(np.int64)[order]
        total = np.zeros(len(sizes), np.int64)
        np.add.at(total, row, by_pair[place] * weight if len(place) else weight)
        out = out.append_column(name, pa.array(total))
    return out


def align(docs: DataFrame, id: str = "doc_id", a: str | None = None, b: str | None = None) -> DataFrame:
    """A row for each row of docs: the id, OWN and COUNTED: n_best and n_best_b, the links whose pair has the highest count
    of its A (B) id, and count_sum, the sum of the counts of all links."""
    coded = with_pairs(docs, id, a, b)
    held = common.cut(coded.select("block", F.explode("pairs").alias("pair")).groupBy("block", "pair").agg(F.count(F.lit(1)).alias("n")), "block-pairs")
    told = common.cut(pair_counts(held, width(docs.sparkSession, a, b)), "pairs")
    back = held.select("block", "pair").join(told.hint("merge"), "pair")
    schema = "id string, " + ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'long'}" for c in [*OWN, *COUNTED])
    found = coded.select("id", *OWN, "block", "pairs", "times").groupBy("block").cogroup(back.groupBy("block")).applyInArrow(_summed, schema)
    return found.select(F.col("id").cast(docs.schema[id].dataType).alias(id), *OWN, *COUNTED)


def width(spark: SparkSession, a: str | None = None, b: str | None = None) -> int:
    return len(PieceTokenizer(files(spark, a, b).value[1]).bytes)


def dictionary(docs: DataFrame, a: str | None = None, b: str | None = None) -> DataFrame:
    """a_id, b_id, count, best, best_b: which ids of the two vocabularies go together in docs (text)."""
    held = with_pairs(docs.select("text", F.lit(None).alias("none")), "none", a, b).select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    w = width(docs.sparkSession, a, b)
    return pair_counts(held, w).select(F.expr(f"pair div {w}").alias("a_id"), F.expr(f"pair % {w}").alias("b_id"), "count", "best", "best_b")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_best_b"]
    return align(common.read(spark, sf_dir, "documents").select("doc_id", "text")).select(*order)
