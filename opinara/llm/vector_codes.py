"""Product quantisation of vectors by integer arithmetic, over tries of their distinct parts.

Every vector is cut into equal consecutive parts and each part is replaced by the index of the nearest entry of its
position's codebook. A task sorts the distinct parts of a slice of rows, with their counts, in lexicographic order: the
leaves of a trie whose inner nodes are common prefixes of dimensions. The trie is walked depth first; a node's vector
of distances to all entries is its parent's vector plus one term, so that a prefix is added up once, however many parts
share it. A leaf takes the argmin of its vector and adds its count times its components to the sums of that entry.

Parts never leave their task: a round is one pass over the table whose tasks return sums by (part, entry), and the
codebook, bounded by parts x entries x width numbers, goes to all tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.session import lookup_join, stored

# Fixed values of the query contract.
PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
# Rows of a slice whose parts make up one trie, and leaves whose distance vectors are held at once. Results do not
# depend on them.
SLICE_ROWS = 8_192
LEAVES = 4_096
# Integers below NATIVE have squares that add up in 64 bits for up to WIDE components; larger ones go as Python integers.
NATIVE = 1 << 24
WIDE = 4_096
LONGEST = (1 << 63) - 1


@dataclass(frozen=True)
class Codebooks:
    """``entries[p]`` holds the entries of part position p, one row each."""

    entries: tuple[np.ndarray, ...]
    width: int

    def digest(self) -> str:
        flat = ",".join(str(int(x)) for book in self.entries for row in book for x in row)
        return hashlib.sha256(flat.encode()).hexdigest()


def finite(vector: str | Column) -> Column:
    """True for a vector without null and non-finite components; false for a null one."""
    column = F.col(vector) if isinstance(vector, str) else vector
    number = column.cast("array<double>")
    good = F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(good, F.lit(False))


def integers(values: np.ndarray, scale: int, columns: int) -> np.ndarray:
    """floor(scale * x) as 64-bit numbers, or as Python integers where one of them is large."""
    down = np.floor(values * float(scale))
    if down.size == 0 or (np.abs(down).max() < NATIVE and columns <= WIDE):
        return down.astype(np.int64)
    return np.array([int(x) for x in down.ravel()], dtype=object).reshape(down.shape)


def as_matrix(vectors: pa.Array, columns: int, scale: int) -> np.ndarray:
    """Vectors as rows of integers; those shorter than ``columns`` end in zeros."""
    lengths = np.diff(vectors.offsets.to_numpy(zero_copy_only=False).astype(np.int64))
    flat = integers(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64), scale, columns)
    if columns and (lengths == columns).all():
        return flat.reshape(-1, columns)
    table = np.zeros((len(lengths), columns), dtype=flat.dtype)
    row = np.repeat(np.arange(len(lengths)), lengths)
    table[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return table


def distinct_parts(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows in lexicographic order, the place of each row among them, and their counts."""
    if parts.shape[1] == 0:
        return parts[:1], np.zeros(len(parts), dtype=np.int64), np.array([len(parts)])
    order = np.lexsort(parts.T[::-1])
    ordered = parts[order]
    new = np.ones(len(parts), dtype=bool)
    new[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
    place = np.empty(len(parts), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    return ordered[new], place, np.bincount(place)


def walk(leaves: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry (the first on ties) and its squared distance of every leaf, depth first.

    ``stack[d]`` is the distance vector of the prefix of d dimensions that the walk stands on. A run of leaves is
    expanded level by level into matrices with one row for each node; the last rows are the stack of the next run.
    """
    width = leaves.shape[1]
    kind = np.result_type(leaves.dtype, book.dtype)
    best = np.empty(len(leaves), dtype=np.int64)
    away = np.empty(len(leaves), dtype=kind)
    stack: list[np.ndarray] = [np.zeros(len(book), dtype=kind)] * (width + 1)
    previous = None
    for start in range(0, len(leaves), LEAVES):
        run = leaves[start : start + LEAVES]
        fresh = np.ones(len(run), dtype=bool)
        fresh[1:] = False
        at = np.zeros(len(run), dtype=np.int64)  # the node of each leaf on the level above
        level = stack[0][None, :]
        shared = previous is not None
        for d in range(width):
            shared = shared and run[0, d] == previous[d]
            fresh[1:] |= run[1:, d] != run[:-1, d]
            nodes = np.flatnonzero(fresh)
            term = book[:, d][None, :] - run[nodes, d][:, None]
            below = level[at[nodes]] + term * term if not shared else _below(level, at, nodes, term, stack[d + 1])
            at = np.cumsum(fresh) - 1
            level = below
            stack[d + 1] = below[-1]
        found = level.argmin(axis=1)
        best[start : start + len(run)] = found[at]
        away[start : start + len(run)] = level[np.arange(len(level)), found][at]
        previous = run[-1]
    return best, away


def _below(level: np.ndarray, at: np.ndarray, nodes: np.ndarray, term: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """A level whose first node the walk already stands on: its vector is taken from the stack."""
    rest = level[at[nodes[1:]]] + term[1:] * term[1:]
    return np.concatenate([kept[None, :], rest])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(start, SLICE_ROWS)


def entry_sums(kept: DataFrame, vector: str, books: Codebooks, scale: int) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """Count and componentwise sums of the parts of each (part position, nearest entry).

    Sums travel as decimal text, so they are exact at any size; a task returns a row for each entry it has used, and
    the rows of an entry, as many as tasks, are added up by one task.
    """
    entries, width = books.entries, books.width

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(entries), max(len(b) for b in entries)), dtype=np.int64)
        sums = np.zeros((*counts.shape, width), dtype=object)
        for batch in _slices(batches):
            table = as_matrix(batch.column(vector), len(entries) * width, scale)
            for p, book in enumerate(entries):
                leaves, _, copies = distinct_parts(table[:, p * width : (p + 1) * width])
                best, _ = walk(leaves, book)
                counts[p] += np.bincount(best, copies, counts.shape[1]).astype(np.int64)
                weighted = leaves * copies[:, None]
                own = np.zeros((counts.shape[1], width), dtype=weighted.dtype)
                np.add.at(own, best, weighted)
                sums[p] += own.astype(object)
        rows = [(p, e, int(counts[p, e]), [str(int(x)) for x in sums[p, e]]) for p, e in np.argwhere(counts).tolist()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int32()),
                pa.array([r[1] for r in rows], pa.int32()),
                pa.array([r[2] for r in rows], pa.int64()),
                pa.array([r[3] for r in rows], pa.list_(pa.string())),
            ],
            names=["part", "entry", "n", "sums"],
        )

    def add(found: pd.DataFrame) -> pd.DataFrame:
        total = [str(sum(int(x) for x in column)) for column in zip(*found["sums"], strict=True)]
        first = found.iloc[0]
        return pd.DataFrame({"part": [first["part"]], "entry": [first["entry"]], "n": [found["n"].sum()], "sums": [total]})

    schema = "part int, entry int, n long, sums array<string>"
    partial = kept.select(vector).mapInArrow(collect, schema)
    rows = partial.groupBy("part", "entry").applyInPandas(add, schema).collect()  # at most parts x entries
    return {(r["part"], r["entry"]): (r["n"], [int(x) for x in r["sums"]]) for r in rows}


def _book(rows: list[list[int]], width: int) -> np.ndarray:
    large = any(abs(x) >= NATIVE for row in rows for x in row)
    return np.array(rows, dtype=object if large else np.int64).reshape(len(rows), width)


def fit(
    vectors: DataFrame, vector: str, order: list[str], parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
    scale: int = SCALE,
) -> Codebooks | None:
    """Codebooks after ``rounds`` rounds of assignment and averaging; None for a table without a finite vector.

    They start as the parts of the first ``entries`` rows by the columns ``order`` (nulls last, equal ones by vector).
    A part has ceil(longest vector / parts) components; shorter vectors count as ending in zeros. Averages are floors
    of exact quotients; an entry that is nearest to nothing stays.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits a part, so 1 to 256 entries")
    kept = vectors.where(finite(vector)).withColumn("_v", F.col(vector).cast("array<double>"))
    longest = kept.agg(F.max(F.size("_v"))).first()[0]
    if longest is None:
        return None
    width = -(-longest // parts)
    keys = [F.col(c).asc_nulls_last() for c in order]
    seeds = kept.select(*order, "_v").orderBy(*keys, "_v").limit(entries).collect()
    table = as_matrix(pa.array([r["_v"] for r in seeds], pa.list_(pa.float64())), width * parts, scale).tolist()
    split = [[row[p * width : (p + 1) * width] for row in table] for p in range(parts)]
    books = Codebooks(tuple(_book(rows, width) for rows in split), width)
    for _ in range(rounds):
        found = entry_sums(kept, "_v", books, scale)
        split = [
            [
                [x // found[p, e][0] for x in found[p, e][1]] if (p, e) in found else [int(x) for x in book[e]]
                for e in range(len(book))
            ]
            for p, book in enumerate(books.entries)
        ]
        books = Codebooks(tuple(_book(rows, width) for rows in split), width)
    return books


def encode(
    vectors: DataFrame, vector: str, books: Codebooks, code: str = "code", error: str = "error", scale: int = SCALE
) -> DataFrame:
    """The rows with a finite vector, with ``code`` (two hex digits a part) and ``error`` (squared distances, summed).

    The vector itself is left out. An error beyond 64 bits is given as the largest long.
    """
    keep = [c for c in vectors.columns if c != vector]
    kept = vectors.where(finite(vector)).select(*keep, F.col(vector).cast("array<double>").alias("_v"))
    entries, width = books.entries, books.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            table = as_matrix(batch.column("_v"), len(entries) * width, scale)
            codes = np.empty((len(table), len(entries)), dtype=np.uint8)
            total = np.zeros(len(table), dtype=table.dtype)
            for p, book in enumerate(entries):
                leaves, place, _ = distinct_parts(table[:, p * width : (p + 1) * width])
                best, away = walk(leaves, book)
                codes[:, p] = best[place]
                total = total + away[place]
            columns = [batch.column(i) for i, f in enumerate(batch.schema.names) if f != "_v"]
            columns.append(pa.array([row.tobytes().hex() for row in codes], pa.string()))
            columns.append(pa.array([min(int(x), LONGEST) for x in total], pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, code, error])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.drop("_v").schema.fields)
    return kept.mapInArrow(run, f"{types + ', ' if types else ''}`{code}` string, `{error}` long")


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every row of ``embeddings`` with a finite vector.

    Repeated rows are coded like any other and weigh as often as they occur; equal vec_ids are ordered by vector, null
    ones come last among the seeds. An empty table gives no rows.
    """
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label")
    books = fit(vectors, "embedding", ["vec_id"])
    if books is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    coded = stored(encode(vectors, "embedding", books), "vector-codes").withColumns(
        {"_none": F.col("label").isNull(), "_label": F.coalesce(F.col("label"), F.lit(0))}
    )
    exact = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = coded.groupBy("_none", "_label").agg(F.least(exact, F.lit(LONGEST)).cast("long").alias("label_error"))
    joined = lookup_join(coded, sums, ["_none", "_label"], max_rows=100_000)
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def _round_sql(number: int) -> str:
    """Assignment to codebook ``number`` and codebook ``number + 1``."""
    return f"""
away{number} AS (
  SELECT x.row, x.part, b.entry, sum((x.value - b.value) * (x.value - b.value)) AS away
  FROM tall x JOIN book{number} b ON x.part = b.part AND x.place = b.place GROUP BY ALL),
near{number} AS (
  SELECT row, part, entry, away FROM away{number}
  QUALIFY row_number() OVER (PARTITION BY row, part ORDER BY away, entry) = 1),
mean{number} AS (
  SELECT x.part, n.entry, x.place, sum(x.value) AS total, count(*) AS n
  FROM tall x JOIN near{number} n ON x.row = n.row AND x.part = n.part GROUP BY ALL),
book{number + 1} AS (
  SELECT b.part, b.entry, b.place,
    CASE WHEN m.n IS NULL THEN b.value ELSE CAST((m.total - ((m.total % m.n) + m.n) % m.n) // m.n AS BIGINT) END AS value
  FROM book{number} b LEFT JOIN mean{number} m ON b.part = m.part AND b.entry = m.entry AND b.place = m.place)"""


OP13_SQL = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row, vec_id, label, embedding,
    len(embedding) // {PARTS} AS width
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
flat AS (
  SELECT row, width, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS spot FROM kept),
tall AS (
  SELECT row, spot // width AS part, spot % width AS place, CAST(floor(CAST(x AS DOUBLE) * {SCALE}) AS BIGINT) AS value FROM flat),
book0 AS (SELECT part, row - 1 AS entry, place, value FROM tall WHERE row <= {ENTRIES}),
{",".join(_round_sql(n) for n in range(ROUNDS + 1))},
codes AS (
  SELECT row, string_agg(printf('%02x', CAST(entry AS INT)), '' ORDER BY part) AS code, CAST(sum(away) AS BIGINT) AS error
  FROM near{ROUNDS} GROUP BY row),
digest AS (
  SELECT sha256(string_agg(CAST(value AS VARCHAR), ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM book{ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN codes USING (row) CROSS JOIN digest
"""
