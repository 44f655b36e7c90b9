"""Collocations: phrases of up to four words ranked by how often they stand together, by marginalising windows.

Every word occurrence opens one window of its own word and three lead columns, padded where its piece of text ends.
Only these longest windows are counted; ROLLUP then adds them up over ever shorter prefixes: the windows that start
with the same two words make the count of that pair, and so on down to single words and the words of a language. No
shorter phrase is taken from the texts a second time.

Nearly all windows of a corpus are rare, and a phrase below the least count is neither wanted nor part of a wanted one.
So a window is also padded where it would go on to words that cannot reach that count. A first pass counts words and
pairs by hash cell, whose totals are upper bounds, and marks the cells that reach the least count in a bitmap; a second
one does so for the runs of three and four words whose pairs are all marked. The bitmaps' length follows the input up to
CELLS; beyond, cells fill up and fewer windows are cut short, and the result is the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opinara.llm import common
from opinara.llm.packing import pack, split_two, two, unpack
from opinara.session import lookup_join, stored

# Fixed values of the query contract.
LONGEST = 4
LEAST = 30
COVER = (80, 100)
SCALE = 2_000_000
FIRST = 2_000
NO_LANGUAGE = "und"
SPLIT = b".,;:!?\x0a\x0b\x0c\x0d"
BLANK = b"\x20\x09"
# Characters of text for a cell of the bitmap, its least and most cells (32 MB), characters of text that are split at
# once, rows of a lookup table that may be broadcast, slices of a language before its first phrases are put in order.
# Results do not depend on any of them.
CELL_TEXT = 32
CELLS = (1 << 16, 1 << 28)
BLOCK = 2 << 20
BROADCAST_ROWS = 50_000
SLICES = 64
# Cells of a part of the bitmap (as a power of two), tasks whose messages are added up at first, cells counted by a task
# before it sends them.
PART_BITS = 16
TASKS = 256
HELD_CELLS = 3_000_000
COUNTED = ["part", "task", "body"]

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[list(BLANK)] = 1
_KIND[list(SPLIT)] = 2
_WORDS = [f"w{i}" for i in range(1, LONGEST + 1)]


@dataclass
class Tokens:
    """Word occurrences of a block of texts: numbers into ``words``, the language of each, and its piece of text."""

    words: pa.Array
    word: np.ndarray
    language: np.ndarray
    piece: np.ndarray


def tokens(texts: pa.Array, languages: np.ndarray) -> Tokens:
    """Words of lower-cased texts. Works on bytes: no separator is part of a longer character in UTF-8."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8)[offsets[0] : offsets[-1]] if body is not None else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    data = _LOWER[data]
    kind = _KIND[data]
    inside = kind == 0
    begins = np.zeros(len(data) + 1, dtype=np.int32)  # texts that begin at a byte
    np.add.at(begins, offsets[:-1], 1)
    begins = begins[:-1]
    start = inside.copy()
    start[1:] &= ~inside[:-1] | (begins[1:] > 0)
    at = np.flatnonzero(start)
    kept = np.cumsum(inside)
    bounds = np.append(kept[at] - 1, kept[-1] if len(kept) else 0).astype(np.int32)
    found = pa.StringArray.from_buffers(len(at), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data[inside])))
    coded = found.dictionary_encode()
    piece = (np.cumsum(kind == 2) + np.cumsum(begins))[at]
    text = np.searchsorted(offsets, at, side="right") - 1
    return Tokens(coded.dictionary, coded.indices.to_numpy().astype(np.int64), languages[text], piece)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(texts, languages) of about BLOCK bytes. A longer text is cut behind separators, where no phrase goes on."""
    for batch in batches:
        texts, languages = batch.column("text"), batch.column("lang")
        sizes = np.diff(np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1])
        first, held = 0, 0
        for i, size in enumerate(sizes):
            if size > 2 * BLOCK:
                if i > first:
                    yield texts.slice(first, i - first), languages.slice(first, i - first)
                for part in cuts(texts[i].as_buffer().to_pybytes()):
                    yield pa.array([part.decode()], pa.string()), languages.slice(i, 1)
                first, held = i + 1, 0
                continue
            held += size
            if held >= BLOCK:
                yield texts.slice(first, i + 1 - first), languages.slice(first, i + 1 - first)
                first, held = i + 1, 0
        if first < len(texts):
            yield texts.slice(first), languages.slice(first)


def cuts(text: bytes) -> Iterator[bytes]:
    """Parts of a text that end behind a separator, of BLOCK bytes or, where no separator comes, more."""
    splits = np.flatnonzero(_KIND[np.frombuffer(text, dtype=np.uint8)] == 2) + 1
    start = 0
    while start < len(text):
        nth = np.searchsorted(splits, start + BLOCK)
        end = int(splits[nth]) if nth < len(splits) else len(text)
        yield text[start:end]
        start = end


def _hashes(values: pa.Array) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in values.to_pylist()), dtype=np.uint64, count=len(values))


def _cells(found: Tokens, languages: pa.Array, cells: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For runs of one to LONGEST words: the cell of the run that starts at each word, and whether there is such a run."""
    own = _hashes(found.words)[found.word] ^ _hashes(languages)[found.language]
    mask = np.uint64(cells - 1)
    run, there = own, np.ones(len(own), dtype=bool)
    places, exists = [(run & mask).astype(np.int64)], [there]
    for ahead in range(1, LONGEST):
        run = run * np.uint64(0x9E3779B97F4A7C15)  # an odd factor, so that the order of the words counts
        run[:-ahead] ^= own[ahead:]
        run ^= run >> np.uint64(32)
        there = np.zeros(len(own), dtype=bool)
        there[:-ahead] = found.piece[ahead:] == found.piece[:-ahead]
        places.append((run & mask).astype(np.int64))
        exists.append(there)
    return places, exists


def _often(bitmap: np.ndarray, cell: np.ndarray) -> np.ndarray:
    return (bitmap[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1


def _within(inner: np.ndarray, size: int, longer: int) -> np.ndarray:
    """Whether all runs of ``size`` words inside the run of ``longer`` words at each place fulfil ``inner``."""
    result = inner.copy()
    for ahead in range(1, longer - size + 1):
        result[:-ahead] &= inner[ahead:]
        result[-ahead:] = False
    return result


def _coded(languages: pa.Array) -> tuple[np.ndarray, pa.Array]:
    coded = languages.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def frequent_cells(docs: DataFrame, cells: int, least: int, sizes: tuple[int, ...], pairs: bytes | None = None) -> bytes:
    """A bitmap (``cells`` / 8 bytes) of the cells of runs of the given sizes that occur ``least`` times or more.

    With the bitmap of ``pairs``, only runs whose pairs are all marked there are counted. Tasks send a compressed message
    for each part of the cells; messages are added up for TASKS tasks first, then for all, so no group of them is long.
    """
    shared = docs.sparkSession.sparkContext.broadcast(pairs)

    kind = np.min_scalar_type(least)

    def message(cell: np.ndarray, n: np.ndarray) -> bytes:
        """Sorted cells of one part with their counts, which need not go beyond ``least`` to show that it is reached."""
        return two(pack(np.diff(cell, prepend=0).astype(np.uint16)), pack(np.minimum(n, least).astype(kind)))

    def messages(cell: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        cell, which = np.unique(cell, return_inverse=True)
        n = np.bincount(which, n, len(cell)).astype(np.int64)
        part, first = np.unique(cell >> PART_BITS, return_index=True)
        ends = np.append(first[1:], len(cell))
        low = cell & ((1 << PART_BITS) - 1)
        made = [message(low[i:j], n[i:j]) for i, j in zip(first, ends, strict=True)]
        task = TaskContext.get().partitionId() // TASKS
        return pa.RecordBatch.from_arrays([pa.array(part), pa.array([task] * len(made), pa.int64()), pa.array(made, pa.binary())], COUNTED)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for texts, languages in blocks(batches):
            numbers, names = _coded(languages)
            found = tokens(texts, numbers)
            places, wanted = _cells(found, names, cells)
            if shared.value is not None:
                marked = wanted[1] & _often(np.frombuffer(shared.value, dtype=np.uint8), places[1])
                wanted = [there & _within(marked, 2, size) for size, there in enumerate(wanted, 1)]
            runs = [places[size - 1][wanted[size - 1]] for size in sizes]
            held.append(np.unique(np.concatenate(runs), return_counts=True))
            size += len(held[-1][0])
            if size > HELD_CELLS:
                yield messages(*map(np.concatenate, zip(*held, strict=True)))
                held, size = [], 0
        if size:
            yield messages(*map(np.concatenate, zip(*held, strict=True)))

    def summed(table: pa.Table) -> np.ndarray:
        total = np.zeros(1 << PART_BITS, dtype=np.int64)
        for body in table.column("body"):
            gaps, n = split_two(body.as_buffer().to_pybytes())
            total[np.cumsum(unpack(gaps).astype(np.int64))] += unpack(n)
        return total

    def some_tasks(table: pa.Table) -> pa.Table:
        total = summed(table)
        cell = np.flatnonzero(total)
        return pa.table([table.column("part")[:1], table.column("task")[:1], pa.array([message(cell, total[cell])], pa.binary())], COUNTED)

    def all_tasks(table: pa.Table) -> pa.Table:
        bits = np.packbits(summed(table) >= least, bitorder="little").tobytes()
        return pa.table([table.column("part")[:1], pa.array([bits], pa.binary())], ["part", "bits"])

    schema = "part long, task long, body binary"
    counted = docs.mapInArrow(count, schema).groupBy("part", "task").applyInArrow(some_tasks, schema)
    bitmap = bytearray(cells // 8)
    for row in counted.groupBy("part").applyInArrow(all_tasks, "part long, bits binary").toLocalIterator():
        start = row["part"] << (PART_BITS - 3)
        bitmap[start : start + len(row["bits"])] = row["bits"]
    return bytes(bitmap)


def counted_windows(docs: DataFrame, cells: int, bitmaps: tuple[bytes, bytes]) -> DataFrame:
    """(lang, w1..w4, n) of all padded windows; a word that is rare itself opens a window of padding."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmaps)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        short, long = (np.frombuffer(bits, dtype=np.uint8) for bits in shared.value)
        for texts, languages in blocks(batches):
            numbers, names = _coded(languages)
            found = tokens(texts, numbers)
            if not len(found.word):
                continue
            places, there = _cells(found, names, cells)
            open_ = _often(short, places[0])
            lead = [np.where(open_, found.word, -1)]
            for ahead in range(1, LONGEST):
                # The window goes on if the run up to that word, and all shorter runs in it, may be frequent.
                size = ahead + 1
                marked = [there[k - 1] & _often(short if k < 3 else long, places[k - 1]) for k in range(2, size + 1)]
                for k, runs in enumerate(marked, 2):
                    open_ = open_ & _within(runs, k, size)
                column = np.full(len(open_), -1, dtype=np.int64)
                column[: max(len(open_) - ahead, 0)] = found.word[ahead:]
                lead.append(np.where(open_, column, -1))
            n_words = len(found.words) + 1
            key = found.language
            for column in lead:
                key, _ = pd.factorize(key)
                key = key * n_words + (column + 1)
            group, seen = pd.factorize(key)
            n = np.bincount(group, minlength=len(seen))
            row = np.empty(len(seen), dtype=np.int64)
            row[group[::-1]] = np.arange(len(group))[::-1]
            columns = [found.words.take(pa.array(c[row], mask=c[row] < 0)) for c in lead]
            yield pa.RecordBatch.from_arrays(
                [names.take(pa.array(found.language[row])), *columns, pa.array(n)], names=["lang", *_WORDS, "n"]
            )

    schema = ", ".join(f"{c} string" for c in ["lang", *_WORDS])
    return docs.mapInArrow(windows, f"{schema}, n long").groupBy("lang", *_WORDS).agg(F.sum("n").alias("n"))


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, size, phrase, f) of all phrases of 1 to 4 words that occur ``least`` times, and (lang, n) of all languages."""
    plain = docs.select(common.whole_text(text).alias("text"), F.coalesce(F.col(lang), F.lit(NO_LANGUAGE)).alias("lang"))
    length = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cells = 1 << min(max(int(length // CELL_TEXT), CELLS[0]) - 1, CELLS[1] - 1).bit_length()
    pairs = frequent_cells(plain, cells, least, (1, 2))
    windows = stored(counted_windows(plain, cells, (pairs, frequent_cells(plain, cells, least, (3, 4), pairs))), "windows")
    # The whole windows are counted already, so ROLLUP goes over their prefixes. grouping_id has a bit for each column that
    # is summed over, those of the last words lowest; a null word that is not summed over is padding, and its phrase is
    # counted as a shorter one.
    prefixes = _WORDS[:-1]
    rolled = windows.rollup("lang", *prefixes).agg(F.sum("n").alias("f"), F.grouping_id().alias("_left_out"))
    size = F.coalesce(*[F.when(F.col("_left_out") == (1 << k) - 1, F.lit(len(prefixes) - k)) for k in range(len(prefixes) + 1)])
    sized = rolled.withColumn("size", size).where(F.col("size").isNotNull()).withColumn(_WORDS[-1], F.lit(None).cast("string"))
    columns = ["lang", "size", *_WORDS, "f"]
    whole = windows.select("lang", F.lit(LONGEST).alias("size"), *_WORDS, F.col("n").alias("f"))
    last = F.coalesce(*[F.when(F.col("size") == k, F.col(_WORDS[k - 1]).isNotNull()) for k in range(1, LONGEST + 1)])
    wanted = sized.select(columns).unionByName(whole).where((F.col("size") == 0) | (last & (F.col("f") >= least)))
    kept = stored(wanted.select("lang", "size", F.concat_ws(" ", *_WORDS).alias("phrase"), "f"), "phrase-counts")
    return kept.where("size > 0"), kept.where("size = 0").select("lang", F.col("f").alias("n"))


def _part(words: Column, start: int | Column, size: int | Column) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def scored(counts: DataFrame, scale: int = SCALE) -> DataFrame:
    """(lang, phrase, size, a, l, r, score) of the phrases of two words and more by their lowest-scoring cut."""
    words = F.split("phrase", " ")
    longer = counts.where("size > 1").withColumnRenamed("f", "a")
    cut = longer.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    sides = cut.select("lang", "phrase", "size", "a", "k", F.posexplode(
        F.array(_part(words, F.lit(1), F.col("k")), _part(words, F.col("k") + 1, F.col("size") - F.col("k")))
    ).alias("side", "_of"))
    known = counts.select("lang", F.col("phrase").alias("_of"), "f")
    found = lookup_join(sides, known, ["lang", "_of"], max_rows=BROADCAST_ROWS)
    by_cut = found.groupBy("lang", "phrase", "size", "a", "k").agg(
        F.max(F.when(F.col("side") == 0, F.col("f"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("f"))).alias("r")
    )
    wide = "decimal(30,0)"
    score = F.expr(f"cast((cast(a as {wide}) * {scale}) div (cast(l as {wide}) + cast(r as {wide})) as bigint)")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("_low")
    low = by_cut.groupBy("lang", "phrase", "size", "a").agg(lowest)
    return low.select("lang", "phrase", "size", "a", "_low.l", "_low.r", "_low.score")


def uncovered(phrases: DataFrame, cover: tuple[int, int] = COVER) -> DataFrame:
    """The phrases without those that occur, for the greater part, inside a longer one."""
    words = F.split("phrase", " ")
    sizes = F.explode(F.sequence(F.lit(2), F.col("size") - 1))
    inner = phrases.where("size > 2").select("lang", "phrase", "size", F.col("a").alias("_longer"), sizes.alias("_size"))
    places = F.explode(F.sequence(F.lit(1), F.col("size") - F.col("_size") + 1))
    inner = inner.withColumn("_at", places).select("lang", _part(words, F.col("_at"), F.col("_size")).alias("phrase"), "_longer")
    most = inner.groupBy("lang", "phrase").agg(F.max("_longer").alias("_longer"))
    joined = phrases.join(most.hint("merge"), ["lang", "phrase"], "left")  # Spark takes what it explodes for small
    wide = "decimal(30,0)"
    covered = F.expr(f"cast(_longer as {wide}) * {cover[1]} >= cast(a as {wide}) * {cover[0]}")
    return joined.where(F.col("_longer").isNull() | ~covered).drop("_longer")


def first_phrases(phrases: DataFrame, first: int = FIRST) -> DataFrame:
    """The first phrases of each language by score, count and text, with ``rank``; a language is cut in slices first."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    sliced = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SLICES))).orderBy(*order)
    some = phrases.withColumn("_at", F.row_number().over(sliced)).where(F.col("_at") <= first).drop("_at")
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= first)


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, first: int = FIRST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the first phrases of each language.

    Null texts count as empty, null languages as "und" and with rows of that name; repeated rows count as often as they
    occur; other columns are not read. Equal scores go by count, then by the phrase's bytes. An empty table gives no
    rows. A text is held whole only between two of its separators.
    """
    counts, languages = phrase_counts(docs, text, lang, least)
    candidates = stored(scored(counts), "phrases")
    ranked = lookup_join(first_phrases(uncovered(candidates), first), languages, ["lang"], max_rows=BROADCAST_ROWS)
    numbers = ["a", "l", "r", "n", "score"]
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", *[F.col(c).cast("long").alias(c) for c in numbers])


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The first phrases of each language of ``documents``; see ``collocations`` for odd rows."""
    return collocations(common.documents(spark, folder))


_ASCII = f"translate(coalesce(text, ''), '{common.ASCII_UPPER}', '{common.ASCII_LOWER}')"
OP11_SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, '{NO_LANGUAGE}') AS lang, unnest(string_split_regex({_ASCII}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
totals AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM worded GROUP BY lang),
spans AS (
  SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS start
  FROM worded, (SELECT unnest(range(1, {LONGEST + 1})) AS size) WHERE len(words) >= size),
counts AS (
  SELECT lang, size, array_to_string(words[start:start + size - 1], ' ') AS phrase, count(*) AS f
  FROM spans GROUP BY ALL HAVING count(*) >= {LEAST}),
cuts AS (
  SELECT lang, phrase, size, f AS a, unnest(range(1, size)) AS k, string_split(phrase, ' ') AS words FROM counts WHERE size > 1),
sides AS (
  SELECT c.lang, c.phrase, c.size, c.a, c.k, x.f AS l, y.f AS r,
    CAST(({SCALE}::HUGEINT * c.a) // (x.f::HUGEINT + y.f) AS BIGINT) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[1:c.k], ' ')
    JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.words[c.k + 1:], ' ')),
lowest AS (SELECT * FROM sides QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_sizes AS (
  SELECT lang, phrase, size, a, unnest(range(2, size)) AS part FROM lowest WHERE size > 2),
inner_places AS (
  SELECT lang, string_split(phrase, ' ') AS words, a, part, unnest(range(1, size - part + 2)) AS start FROM inner_sizes),
longer AS (
  SELECT lang, array_to_string(words[start:start + part - 1], ' ') AS phrase, max(a) AS longer FROM inner_places GROUP BY ALL),
kept AS (
  SELECT w.* FROM lowest w LEFT JOIN longer g USING (lang, phrase)
  WHERE g.longer IS NULL OR {COVER[1]}::HUGEINT * g.longer < {COVER[0]}::HUGEINT * w.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang)
QUALIFY rank <= {FIRST}
"""
