"""Language-model scores by a bigram model in sharded Elias-Fano tries.

The texts are read twice. Each pass cuts the input into blocks of some million tokens, and a block speaks only of its
different words and bigrams, as sorted, packed arrays.

1. Bigrams go to shards by hash. A shard adds up the training counts, builds its trie of quantised discounted counts,
   and answers each block with one code per bigram; it also reports how many words follow each context.
2. Words go to shards, too, which add up their counts and the reports, and answer with both.
3. In the second pass each block scores its documents with the answers.

P(w | h) = max(c(h w) - D, 0) / c(h) + D * T(h) / c(h) * P(w), with T(h) the different words after h, and
P(w) = (c(w) + 1) / (N + V + 1). It sums to 1 over the vocabulary and one unknown word. After a word never seen in
training it is P(w). Words are told apart by 64 bits everywhere; a shard numbers its words and keys its trie by the numbers.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.llm import common
from opinara.llm.elias_fano import NgramTrie
from opinara.llm.packing import Hashes, pack, pack_sorted, split_two, two, unpack, unpack_sorted
from opinara.session import new_path

DISCOUNT = 0.75
# Tokens of a block and bytes of text per shard: sizes of pieces, not of the whole.
BLOCK_TOKENS = 2_000_000
SHARD_BYTES = 16_000_000
# Codes are 16 bits: 0 for absent, else the logarithm of a discounted count in steps of this size from log10(1 - D).
STEP = 2e-4
LOWEST = np.log10(1 - DISCOUNT)
# No word holds a space.
END = xxhash.xxh3_64_intdigest(b" end")
START = xxhash.xxh3_64_intdigest(b" start")

MESSAGE = "kind string, shard int, block long, body binary"


@dataclass
class Bigrams:
    """Pairs of words, each word by its place in a table of hashes."""

    table: np.ndarray
    first: np.ndarray
    second: np.ndarray

    def shard(self, shards: int) -> np.ndarray:
        """Both words decide, so what follows a frequent word is spread over all shards."""
        mixed = self.table[self.first] * np.uint64(0x9E3779B97F4A7C15) + self.table[self.second] * np.uint64(0xC2B2AE3D27D4EB4F)
        return word_shard(mixed ^ mixed << np.uint64(29), shards)

    def packed(self, at: np.ndarray) -> bytes:
        """Some of the pairs with the part of the table that they need."""
        first, second = self.first[at], self.second[at]
        used = np.unique(np.concatenate([first, second]))
        kind = np.min_scalar_type(len(used))
        first, second = np.searchsorted(used, first).astype(kind), np.searchsorted(used, second).astype(kind)
        return two(pack_sorted(self.table[used]), two(pack(np.diff(first, prepend=kind.type(0))), pack(second)))

    @staticmethod
    def unpacked(body: bytes) -> Bigrams:
        table, pairs = split_two(body)
        first, second = map(unpack, split_two(pairs))
        return Bigrams(unpack_sorted(table), np.cumsum(first, dtype=first.dtype), second)


@dataclass
class Block:
    """Some documents as places into their sorted different words."""

    number: int
    ids: list
    trains: np.ndarray
    lengths: np.ndarray
    words: np.ndarray
    places: np.ndarray

    def context(self) -> np.ndarray:
        """Place of the word before each token; one past the words for the start of a document."""
        before = np.empty_like(self.places)
        before[1:] = self.places[:-1]
        before[np.cumsum(self.lengths)[:-1]] = len(self.words)
        before[:1] = len(self.words)
        return before

    def bigrams(self) -> tuple[Bigrams, np.ndarray]:
        """The different bigrams, and each token's place among them."""
        keys, places = np.unique(self.context() << 32 | self.places, return_inverse=True)
        return Bigrams(np.append(self.words, np.uint64(START)), keys >> 32, keys & 0xFFFFFFFF), places

    def counts(self, places: np.ndarray, size: int) -> np.ndarray:
        """How often training tokens have each place."""
        return np.bincount(places[np.repeat(self.trains, self.lengths)], minlength=size)


def blocks(batches: Iterable[pa.RecordBatch], id_column: str) -> Iterator[Block]:
    """Documents of one task, in blocks; the same rows in the same order give the same blocks."""
    part, hashes, number = TaskContext.get().partitionId() if TaskContext.get() else 0, Hashes(), 0
    ids, trains, lengths, tokens, size = [], [], [], [], 0

    def close() -> Block:
        nonlocal number, size
        words, places = np.unique(np.concatenate(tokens), return_inverse=True)
        made = Block(part << 32 | number, list(ids), np.array(trains), np.array(lengths), words, places)
        number, size = number + 1, 0
        for kept in (ids, trains, lengths, tokens):
            kept.clear()
        return made

    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in (id_column, "_trains", "_text")]
        for own, train, text in zip(*columns, strict=True):
            found = text.encode(errors="replace").lower().split()
            hashes.trim()
            row = np.fromiter(map(hashes.__getitem__, found), dtype=np.uint64, count=len(found))
            tokens += [row, np.array([END], dtype=np.uint64)]
            ids.append(own)
            trains.append(train)
            lengths.append(len(found) + 1)
            size += len(found) + 1
            if size >= BLOCK_TOKENS:
                yield close()
    if ids:
        yield close()


def message(rows: list[tuple[str, int, int, bytes]]) -> pa.RecordBatch:
    kinds = [("kind", pa.string()), ("shard", pa.int32()), ("block", pa.int64()), ("body", pa.binary())]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[n] for r in rows], kind) for n, (_, kind) in enumerate(kinds)], [name for name, _ in kinds]
    )


def word_shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def by_shard(shard: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """Places of each shard that has any, in ascending order."""
    order = np.argsort(shard, kind="stable")
    bounds = np.searchsorted(shard[order], np.arange(shards + 1))
    for number in np.unique(shard).tolist():
        yield number, order[bounds[number] : bounds[number + 1]]


def questions(docs: DataFrame, shards: int, id_column: str) -> DataFrame:
    """Each block's different bigrams and words by shard, with how often they train."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, id_column):
            pairs, pair_places = block.bigrams()
            for kind, places, shard, body in (
                ("bigrams", pair_places, pairs.shard(shards), pairs.packed),
                ("asked", block.places, word_shard(block.words, shards), lambda at, words=block.words: pack_sorted(words[at])),
            ):
                counts = block.counts(places, len(shard))
                yield message(
                    [(kind, number, block.number, two(body(at), pack(counts[at]))) for number, at in by_shard(shard, shards)]
                )

    return docs.mapInArrow(run, MESSAGE)


def added_up(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different keys with a count above 0, sorted, and their sums."""
    key = np.concatenate([k[c > 0] for k, c in zip(keys, counts, strict=True)])
    found, place = np.unique(key, return_inverse=True)
    number = np.concatenate([c[c > 0] for c in counts]).astype(np.float64)
    return found, np.bincount(place, weights=number, minlength=len(found)).astype(np.int64)


def answer_bigrams(shards: int):
    def work(group: pa.Table) -> pa.Table:
        shard, numbers, pairs, counts, rows = group.column("shard")[0].as_py(), [], [], [], []
        for kind, number, body in zip(*(group.column(c).to_pylist() for c in ("kind", "block", "body")), strict=True):
            if kind != "bigrams":
                # Words have come along to be stored for the next step.
                rows.append((kind, shard, number, body))
                continue
            a, b = split_two(body)
            numbers.append(number)
            pairs.append(Bigrams.unpacked(a))
            counts.append(unpack(b))
        if not pairs:
            return pa.Table.from_batches([message(rows)])
        # A word's number is its place among the different words of the shard.
        words, asked = np.unique(np.concatenate([p.table for p in pairs])), []
        while pairs:
            p = pairs.pop(0)
            number_of = np.searchsorted(words, p.table).astype(np.uint64)
            asked.append(number_of[p.first] << np.uint64(32) | number_of[p.second])
        keys, sums = added_up(asked, counts)
        low = np.uint64(0xFFFFFFFF)
        codes = 1 + np.minimum(np.rint((np.log10(sums - DISCOUNT) - LOWEST) / STEP), 65_000).astype(np.uint16)
        trie = NgramTrie([keys >> np.uint64(32), keys & low], codes)
        for number, wanted in zip(numbers, asked, strict=True):
            place = trie.find([wanted >> np.uint64(32), wanted & low])
            found = trie.values[np.maximum(place, 0)] if len(keys) else np.zeros(len(place), np.uint16)
            rows.append(("bigrams", shard, number, pack(np.where(place >= 0, found, 0).astype(np.uint16))))
        contexts = trie.levels[0].get(np.arange(trie.levels[0].count)) if len(keys) else np.empty(0, np.uint64)
        if len(contexts):
            follow = trie.successors(0, np.arange(len(contexts)))
            contexts = words[contexts.astype(np.int64)]
            for number, at in by_shard(word_shard(contexts, shards), shards):
                rows.append(("contexts", number, -1, two(pack_sorted(contexts[at]), pack(follow[at]))))
        return pa.Table.from_batches([message(rows)])

    return work


def answer_words(group: pa.Table) -> pa.Table:
    shard = group.column("shard")[0].as_py()
    asked, counts, numbers, contexts, follow = [], [], [], [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for kind, number, body in zip(*(group.column(c).to_pylist() for c in ("kind", "block", "body")), strict=True):
        a, b = map(bytes, split_two(body))
        if kind == "contexts":
            contexts.append(unpack_sorted(a))
            follow.append(unpack(b))
        else:
            numbers.append(number)
            asked.append(unpack_sorted(a))
            counts.append(unpack(b))
    words, sums = added_up(asked, counts) if asked else (np.empty(0, np.uint64), np.empty(0, np.int64))
    before, after = added_up(contexts, follow)
    start = np.uint64(START)
    rows = [("totals", shard, -1, pickle.dumps((int(sums.sum()), len(words))))]
    at = np.searchsorted(before, start)
    if at < len(before) and before[at] == start:
        rows.append(("start", shard, -1, pickle.dumps(int(after[at]))))

    def lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(len(wanted), dtype=np.int64)
        place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[place] == wanted, values[place], 0)

    for number, wanted in zip(numbers, asked, strict=True):
        body = two(pack(lookup(words, sums, wanted)), pack(lookup(before, after, wanted)))
        rows.append(("words", shard, number, body))
    return pa.Table.from_batches([message(rows)])


def indexes(docs: DataFrame, id_column: str) -> DataFrame:
    """Each block as one message: its documents and the place of each token among its words, frequent ones first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, id_column):
            order = np.argsort(-np.bincount(block.places, minlength=len(block.words)), kind="stable").astype(np.uint32)
            rank = np.empty_like(order)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            body = pickle.dumps(
                (block.ids, block.trains, block.lengths, pack_sorted(block.words), pack(order), pack(rank[block.places]))
            )
            yield message([("index", -1, block.number, body)])

    return docs.mapInArrow(run, MESSAGE)


def restored(number: int, body: bytes) -> Block:
    ids, trains, lengths, words, order, ranks = pickle.loads(body)
    return Block(number, ids, trains, lengths, unpack_sorted(words), unpack(order)[unpack(ranks)].astype(np.int64))


def score_blocks(shards: int, tokens: int, vocabulary: int, after_start: int, id_kind: pa.DataType):
    """Scores of a block's documents from its index and the answers of all shards."""

    def work(group: pa.Table) -> pa.Table:
        index, found = None, {"bigrams": {}, "words": {}}
        for kind, shard, number, body in zip(
            *(group.column(c).to_pylist() for c in ("kind", "shard", "block", "body")), strict=True
        ):
            if kind == "index":
                index = restored(number, body)
            else:
                found[kind][shard] = body
        if index is None:
            raise RuntimeError("the rows of the input came in another order or other parts: write it to a table first")
        pairs, places = index.bigrams()
        codes = np.zeros(len(pairs.first), dtype=np.int64)
        for number, at in by_shard(pairs.shard(shards), shards):
            codes[at] = unpack(found["bigrams"][number])
        counts, follow = np.zeros(len(index.words), np.int64), np.zeros(len(index.words), np.int64)
        for number, at in by_shard(word_shard(index.words, shards), shards):
            a, b = split_two(found["words"][number])
            counts[at], follow[at] = unpack(a), unpack(b)
        single = (counts + 1) / (tokens + vocabulary + 1)
        # Every training document has one start and one end.
        end = counts[np.searchsorted(index.words, np.uint64(END))]
        seen = np.append(counts, end)[index.context()].astype(np.float64)
        kinds = np.append(follow, after_start)[index.context()]
        held = np.where(codes > 0, 10.0 ** (LOWEST + (codes - 1) * STEP), 0.0)[places]
        plain = single[index.places]
        known = seen > 0
        smooth = np.where(known, (held + DISCOUNT * kinds * plain) / np.maximum(seen, 1), plain)
        starts = np.concatenate([[0], np.cumsum(index.lengths)[:-1]])
        add = lambda values: np.add.reduceat(values, starts)
        columns = {
            "id": pa.array(index.ids, id_kind),
            "held_out": pa.array(~index.trains),
            "n_tokens": pa.array(index.lengths.astype(np.int64)),
            "n_known": pa.array(add((counts[index.places] > 0).astype(np.int64))),
            "base_score": pa.array(add(np.log10(plain))),
            "score": pa.array(add(np.log10(smooth))),
        }
        return pa.table(columns)

    return work


def score(docs: DataFrame, trains: Column, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    The model learns from the rows for which ``trains`` holds (null: not). Null and empty texts are one end token;
    repeated rows count each and score alike; an empty table gives no rows; texts are read whole. ``docs`` must give
    the same rows in the same parts whenever it is read, as a table of files does; if not, the job fails.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    id_kind = to_arrow_type(docs.schema[id_column].dataType)
    rows = docs.select(
        id_column, F.coalesce(trains, F.lit(False)).alias("_trains"), common.whole_text(text).alias("_text")
    )
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    shards = max(4, -(-size // SHARD_BYTES))
    path = new_path(spark, "lm-answers")

    asked = questions(rows, shards, id_column).groupBy("shard").applyInArrow(answer_bigrams(shards), MESSAGE)
    asked.write.parquet(f"{path}/bigrams")
    bigrams = spark.read.parquet(f"{path}/bigrams")
    both = bigrams.where("kind IN ('asked', 'contexts')")
    both.groupBy("shard").applyInArrow(answer_words, MESSAGE).write.parquet(f"{path}/words")
    words = spark.read.parquet(f"{path}/words")

    # One row of two numbers for each shard, and one for the start.
    totals = [pickle.loads(r["body"]) for r in words.where("kind = 'totals'").select("body").collect()]
    starts = [pickle.loads(r["body"]) for r in words.where("kind = 'start'").select("body").collect()]
    tokens, vocabulary = sum(n for n, _ in totals), sum(v for _, v in totals)
    answers = bigrams.where("kind = 'bigrams'").unionByName(words.where("kind = 'words'"))
    id_type = docs.schema[id_column].dataType.simpleString()
    scored = (
        indexes(rows, id_column)
        .unionByName(answers)
        .groupBy("block")
        .applyInArrow(
            score_blocks(shards, tokens, vocabulary, sum(starts), id_kind),
            f"id {id_type}, held_out boolean, n_tokens long, n_known long, base_score double, score double",
        )
    )
    return scored.withColumnRenamed("id", id_column).withColumn("train_tokens", F.lit(tokens).cast("long"))


def op5_ngram_lm(spark: SparkSession, folder: str) -> DataFrame:
    docs = common.documents(spark, folder).select("doc_id", "text")
    found = score(docs, common.remainder("doc_id", 7) != 2)
    return found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
