"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

All pieces (pre-tokens) that a group of texts meets for the first time form one linked list of bytes. A bucket for each
merge rank holds the places whose pair has that rank; a bitmap of three levels over the ranks gives the lowest filled
bucket by find-first-set. All places of a bucket are merged at once, from left to right where they overlap; entries
whose pair has changed meanwhile are skipped. A place enters a bucket once per change beside it, so a piece of a
million bytes takes time in proportion to its length.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Sequence
from functools import cache
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.llm import common

RANKS = "byte_bpe_multi_50k.tiktoken"
# Pieces whose ids a worker keeps; only speed depends on it.
KEPT_PIECES = 200_000
# Characters of texts whose new pieces go through one queue; only speed depends on it.
GROUP_CHARS = 5_000_000


class RankQueue:
    """Buckets by rank under a bitmap of three levels of 64-bit words."""

    def __init__(self, ranks: int):
        self.buckets: dict[int, list[np.ndarray]] = {}
        self.low = [0] * ((ranks >> 6) + 1)
        self.mid = [0] * ((ranks >> 12) + 1)
        self.top = 0

    def push(self, rank: int, places: np.ndarray) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.append(places)
            return
        self.buckets[rank] = [places]
        a, b = rank >> 6, rank >> 12
        self.low[a] |= 1 << (rank & 63)
        self.mid[b] |= 1 << (a & 63)
        self.top |= 1 << b

    def pop(self) -> tuple[int, np.ndarray] | None:
        """The lowest rank that has entries, and all of them; its bucket is empty afterwards."""
        if not self.top:
            return None
        b = (self.top & -self.top).bit_length() - 1
        a = b << 6 | ((self.mid[b] & -self.mid[b]).bit_length() - 1)
        rank = a << 6 | ((self.low[a] & -self.low[a]).bit_length() - 1)
        self.low[a] &= self.low[a] - 1
        if not self.low[a]:
            self.mid[b] &= self.mid[b] - 1
            if not self.mid[b]:
                self.top &= self.top - 1
        entries = self.buckets.pop(rank)
        return rank, entries[0] if len(entries) == 1 else np.concatenate(entries)

    def push_all(self, ranks: np.ndarray, places: np.ndarray) -> None:
        """Each place to the bucket of its rank; places of rank -1 to none."""
        places = places[ranks >= 0]
        if not len(places):
            return
        ranks = ranks[ranks >= 0]
        order = np.argsort(ranks, kind="stable")
        ranks, places = ranks[order], places[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        starts = [0, *cuts.tolist()]
        for start, end, rank in zip(starts, [*starts[1:], len(ranks)], ranks[starts].tolist(), strict=True):
            self.push(rank, places[start:end])


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each run, one run after the other."""
    shift = starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(starts) else starts
    return np.repeat(shift, lengths) + np.arange(int(lengths.sum()))


class Vocabulary:
    """Ranks of byte strings; the rank of a merged pair is that of its bytes."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        if not set(map(bytes, ([b] for b in range(256)))) <= rank.keys():
            raise ValueError("the vocabulary lacks single bytes")
        self.size = max(rank.values()) + 1
        tokens = [b""] * self.size
        for token, number in rank.items():
            tokens[number] = token
        self.flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.lengths = np.array(list(map(len, tokens)), dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.of_byte = np.array([rank[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = {}
        for token, number in rank.items():
            for cut in range(1, len(token)):
                left, right = rank.get(token[:cut]), rank.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = number
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.ranks = np.array([pairs[k] for k in self.keys.tolist()], dtype=np.int64)
        # Ids of merges that can make a pair of a lower rank, which then comes before the rest of their bucket.
        parts = np.concatenate([self.keys >> 32, self.keys & 0xFFFFFFFF])
        later = (parts > np.tile(self.ranks, 2)) & (self.lengths[parts] > 1)
        self.hasty = np.zeros(self.size, dtype=bool)
        self.hasty[parts[later]] = True

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, -1 if it has none."""
        wanted = left << 32 | right
        place = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[place] == wanted, self.ranks[place], -1)

    def encode(self, pieces: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after the other, and how many each piece has."""
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        ids = self.of_byte[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        count = len(ids)
        after, before = np.arange(1, count + 1), np.arange(-1, count - 1)
        ends = np.cumsum(lengths)[lengths > 0]
        after[ends - 1] = -1
        before[ends[:-1]] = -1
        queue = RankQueue(self.size)
        inner = np.flatnonzero(after >= 0)
        queue.push_all(self.pair_ranks(ids[inner], ids[after[inner]]), inner)
        while (found := queue.pop()) is not None:
            self.merge(*found, ids, after, before, queue)
        alive = ids >= 0
        owner = np.repeat(np.arange(len(pieces)), lengths)
        return ids[alive].astype(np.int32), np.bincount(owner[alive], minlength=len(pieces))

    def merge(
        self, rank: int, places: np.ndarray, ids: np.ndarray, after: np.ndarray, before: np.ndarray, queue: RankQueue
    ) -> None:
        """Merge the places whose pair still has the rank; a place merged into the one before it gets id -1."""
        places = np.sort(places)
        other = after[places]
        open_ = (ids[places] >= 0) & (other >= 0)
        open_[1:] &= places[1:] != places[:-1]
        places, other = places[open_], other[open_]
        same = self.pair_ranks(ids[places], ids[other]) == rank
        places, other = places[same], other[same]
        if not len(places):
            return
        entries = places
        # In a run of overlapping pairs every other one is merged, beginning on the left.
        linked = np.concatenate([[False], other[:-1] == places[1:]])
        if linked.any():
            number = np.arange(len(places))
            first = np.maximum.accumulate(np.where(linked, 0, number))
            kept = (number - first) % 2 == 0
            places, other = places[kept], other[kept]
        beyond = after[other]
        if self.hasty[rank]:
            end = self.first_lower(rank, places, beyond, ids, before)
            rest = entries[entries > places[end - 1]]
            if len(rest) and end < len(places):
                queue.push(rank, rest)
            places, other, beyond = places[:end], other[:end], beyond[:end]
        ids[places], ids[other] = rank, -1
        after[places] = beyond
        right = beyond >= 0
        before[beyond[right]] = places[right]
        ahead = before[places]
        left = ahead[ahead >= 0]
        changed = np.concatenate([places[right], left])
        queue.push_all(self.pair_ranks(ids[changed], ids[after[changed]]), changed)

    def first_lower(
        self, rank: int, places: np.ndarray, beyond: np.ndarray, ids: np.ndarray, before: np.ndarray
    ) -> int:
        """How many of the merges can be done, from the left, until one makes a pair of a lower rank than theirs."""
        right = np.where(beyond >= 0, self.pair_ranks(np.full(len(places), rank), ids[np.maximum(beyond, 0)]), -1)
        ahead = before[places]
        just_merged = np.concatenate([[False], beyond[:-1] == places[1:]])
        left_id = np.where(just_merged, rank, ids[np.maximum(ahead, 0)])
        left = np.where((ahead >= 0) | just_merged, self.pair_ranks(left_id, np.full(len(places), rank)), -1)
        lower = ((right >= 0) & (right < rank)) | ((left >= 0) & (left < rank))
        return int(np.argmax(lower)) + 1 if lower.any() else len(places)

    def decode(self, ids: np.ndarray) -> bytes:
        return self.flat[ragged(self.starts[ids], self.lengths[ids])].tobytes()


class Numbers(dict):
    """Pieces numbered in the order in which they are met."""

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        return number


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Tokenizer:
    """Splits texts by the pattern and keeps the ids of pieces met before, for as long as a task lasts."""

    def __init__(self, path: str, pattern: str):
        self.vocabulary = vocabulary(path)
        self.split = regex.compile(pattern).findall
        self.forget()

    def forget(self) -> None:
        self.numbers = Numbers()
        self.ids, self.counts = np.empty(0, np.int32), np.empty(0, np.int64)

    def encode_batch(self, texts: Sequence[str]) -> Iterable[np.ndarray]:
        """Ids of each text, one after the other; new pieces of texts of GROUP_CHARS go through one queue."""
        start = 0
        while start < len(texts):
            end, chars = start, 0
            while end < len(texts) and chars < GROUP_CHARS:
                chars += len(texts[end])
                end += 1
            yield from self.encode_group(texts[start:end])
            start = end

    def encode_group(self, texts: Sequence[str]) -> Iterable[np.ndarray]:
        if len(self.numbers) > KEPT_PIECES:
            self.forget()
        number, known = self.numbers.__getitem__, len(self.numbers)
        split = []
        for text in texts:
            pieces = self.split(text)
            split.append(np.fromiter(map(number, pieces), dtype=np.int32, count=len(pieces)))
        new = [piece.encode() for piece in islice(self.numbers, known, None)]
        ids, counts = self.vocabulary.encode(new)
        self.ids, self.counts = np.concatenate([self.ids, ids]), np.concatenate([self.counts, counts])
        starts = np.concatenate([[0], np.cumsum(self.counts)[:-1]]) if len(self.counts) else self.counts
        for pieces in split:
            yield self.ids[ragged(starts[pieces], self.counts[pieces])]


def with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    kept = [n for n in batch.schema.names if n != name]
    return pa.RecordBatch.from_arrays([batch.column(n) for n in kept] + [values], [*kept, name])


def schema_with(df: DataFrame, name: str, kind: str) -> str:
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != name]
    return ", ".join([*fields, f"`{name}` {kind}"])


def encode(
    docs: DataFrame,
    text: str = "text",
    ids: str = "token_ids",
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    decoded: str | None = None,
) -> DataFrame:
    """``docs`` with an array of ids of each whole text, without special tokens.

    With ``decoded``, a column of that name has the bytes that the ids stand for, as ``decode`` would add it.

    Null and empty texts have no ids; equal texts have equal ids; a column named ``ids`` is replaced, all others
    stay; an empty table stays empty. ``path`` names a rank file that every worker can read.
    """
    path = path or public_tokenizers.path(RANKS)
    docs = docs.drop(decoded) if decoded else docs
    tokenizers: list[Tokenizer] = []

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not tokenizers:
            tokenizers.append(Tokenizer(path, pattern))
        found = list(tokenizers[0].encode_batch([t or "" for t in batch.column(text).to_pylist()]))
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
        made = with_column(batch, ids, pa.ListArray.from_arrays(offsets, np.concatenate(found)))
        if decoded:
            made = with_column(made, decoded, pa.array(map(tokenizers[0].vocabulary.decode, found), pa.binary()))
        return made

    schema = schema_with(docs, ids, "array<int>")
    return common.map_batches(docs, f"{schema}, `{decoded}` binary" if decoded else schema, work)


def decode(encoded: DataFrame, ids: str = "token_ids", decoded: str = "decoded", path: str | None = None) -> DataFrame:
    """``encoded`` with the bytes that each array of ids stands for; a null array gives no bytes."""
    path = path or public_tokenizers.path(RANKS)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = vocabulary(path)
        made = [known.decode(x.values.to_numpy()) if x.is_valid else b"" for x in batch.column(ids)]
        return with_column(batch, decoded, pa.array(made, pa.binary()))

    return common.map_batches(encoded, schema_with(encoded, decoded, "binary"), work)


def digests(decoded: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id with the number of ids, digests of the ids and of what they decode to, and the columns ``keep``."""
    decimal = F.array_join(F.col("token_ids").cast("array<string>"), ",")
    return decoded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(decimal, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *keep,
    )


def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = common.documents(spark, folder).select("doc_id", "text")
    return digests(encode(docs, decoded="decoded"))
