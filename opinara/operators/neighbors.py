"""Exact k nearest neighbours by blocks of rows.

Rows are sparse vectors (``idx``, ``val`` arrays). Dense rows and rows with negative values belong to the block of
their nearest pivot and of their distance ring around it: distances obey the triangle inequality, so a query visits
only blocks that can hold one of its k nearest rows. Sparse rows without negative values go by inverted lists and
smallest norms (``inverted``). Both bounds are proven, and nothing is approximated.

Where two sets of dense rows meet, a matrix product (p=2) or sums in single precision (p=1) leave out what is provably
too far, and the rest is measured exactly.

Blocks are cut into chunks and queries into parts of bounded size, so a block holding a third of the table is spread
over many tasks, and a task returns at most k rows per query instead of all pairs. A row is copied only to the parts
that visit its block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.functions.rng import lehmer
from opinara.operators import inverted
from opinara.session import lookup_join, stored

PIVOTS = 16
RINGS = 8
CHUNK_ROWS = 2048
# Rows of a chunk or part of dense rows, which meet as matrices of at most DENSE_VALUES values.
DENSE_ROWS = 16_384
DENSE_VALUES = 4_000_000
# Distances of a tile of rows, held at once for p = 1 and 2, and pairs that are measured at once.
TILES = {1: 130_000, 2: 2_000_000}
PAIRS = 20_000
ASSIGNED = "row_id long, space int, fold int, y int, idx array<int>, val array<double>, pivot int, away double"
FOUND = "row_id long, neighbor_id long, y int, distance double"
# Rows with fewer terms than this part of all terms count as sparse.
SPARSE = 0.25


class _Postings:
    """Column-wise sparse copy of a bounded set of rows, for distances from one query to all of them."""

    def __init__(self, idx: list, val: list):
        self.n = len(idx)
        sizes = np.fromiter((len(i) for i in idx), dtype=np.int64, count=self.n)
        rows = np.repeat(np.arange(self.n), sizes)
        columns = np.concatenate([np.asarray(i, dtype=np.int64) for i in idx]) if self.n else np.empty(0, np.int64)
        values = np.concatenate([np.asarray(v, dtype=np.float64) for v in val]) if self.n else np.empty(0)
        order = np.argsort(columns, kind="stable")
        self.rows, self.values = rows[order], values[order]
        self.columns, first = np.unique(columns[order], return_index=True)
        self.first = np.append(first, len(order))
        self.power = {
            1: np.bincount(rows, np.abs(values), self.n),
            2: np.bincount(rows, values * values, self.n),
        }

    def distances(self, idx, val, p: int) -> np.ndarray:
        idx, val = np.asarray(idx, dtype=np.int64), np.asarray(val, dtype=np.float64)
        at = np.searchsorted(self.columns, idx)
        at_safe = np.minimum(at, max(len(self.columns) - 1, 0))
        known = (self.columns[at_safe] == idx) if len(self.columns) else np.zeros(len(idx), bool)
        start, stop = self.first[at[known]], self.first[at[known] + 1]
        sizes = stop - start
        take = np.repeat(start - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
        mine, theirs = np.repeat(val[known], sizes), self.values[take]
        if p == 2:
            shared = (mine - theirs) ** 2 - mine * mine - theirs * theirs
            own = float(np.dot(val, val))
        else:
            shared = np.abs(mine - theirs) - np.abs(mine) - np.abs(theirs)
            own = float(np.abs(val).sum())
        total = np.bincount(self.rows[take], shared, self.n) + self.power[p] + own
        # Rounding makes equal rows exactly 0 apart, whatever order their parts were summed in.
        total = np.maximum(np.round(total, 12), 0.0)
        return np.sqrt(total) if p == 2 else total


class _Dense:
    """Rows as a matrix of ``width`` columns, for the k nearest of many queries at once."""

    def __init__(self, idx: pd.Series, val: pd.Series, width: int, p: int):
        self.rows, self.p = _matrix(idx, val, width), p
        self.norms = np.abs(self.rows).sum(axis=1) if p == 1 else np.einsum("ij,ij->i", self.rows, self.rows)
        self.finite = bool(np.isfinite(self.rows).all()) and float(self.norms.max(initial=0.0)) < 1e30
        # Columns are taken one by one, so they lie together.
        self.columns = np.ascontiguousarray(self.rows.T, dtype=np.float32) if p == 1 and self.finite else None

    def _rough(self, asked: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Distances (p=2: squared) of a tile of queries to all rows, within the bounds of ``_error``."""
        if self.p == 2:
            away = asked @ self.rows.T
            away *= -2.0
            away += self.norms
            away += own[:, None]
            return away
        away = np.zeros((len(asked), len(self.rows)), dtype=np.float32)
        step = np.empty_like(away)
        for column, of_queries in zip(self.columns, asked.T.astype(np.float32), strict=True):
            np.subtract(column, of_queries[:, None], out=step)
            np.abs(step, out=step)
            away += step
        return away

    def _error(self, own: np.ndarray) -> np.ndarray:
        """More than twice what rounding can move a rough distance, and more than the 12 places of a distance."""
        unit = 2.0**-52 if self.p == 2 else 2.0**-23
        return 8 * (self.rows.shape[1] + 8) * unit * (own + self.norms.max()) + 4e-12

    def _measured(self, asked: np.ndarray, at: np.ndarray, row: np.ndarray) -> np.ndarray:
        parts = []
        for low in range(0, len(at), PAIRS):
            apart = asked[at[low : low + PAIRS]] - self.rows[row[low : low + PAIRS]]
            parts.append(np.abs(apart).sum(axis=1) if self.p == 1 else np.einsum("ij,ij->i", apart, apart))
        total = np.round(np.concatenate(parts), 12) if parts else np.empty(0)
        return np.sqrt(total) if self.p == 2 else total

    def nearest(self, asked: np.ndarray, ids: np.ndarray, k: int, mine: np.ndarray | None, theirs: np.ndarray | None):
        """(query, row, distance) of the k nearest rows of each query, by id on ties; ``mine`` and ``theirs`` may not be equal."""
        n = len(self.rows)
        height = max(1, min(len(asked), TILES[self.p] // n))
        # The k-th least of the minima of slices is no less than the k-th least of all.
        slices = n // 64 if n // 64 >= 4 * k else 0
        found = []
        for low in range(0, len(asked), height):
            part = asked[low : low + height]
            own = np.abs(part).sum(axis=1) if self.p == 1 else np.einsum("ij,ij->i", part, part)
            away = self._rough(part, own)
            if mine is not None:
                away[mine[low : low + height, None] == theirs] = np.inf
            if n <= k:
                bound = np.full(len(part), np.finfo(away.dtype).max)
            else:
                least = away
                if slices:
                    whole = slices * 64
                    least = away[:, :whole].reshape(len(part), 64, slices).min(axis=1)
                    least = np.concatenate([least, away[:, whole:]], axis=1)
                bound = np.partition(least, k - 1, axis=1)[:, k - 1].astype(np.float64)
                bound = np.minimum(bound + self._error(own), np.finfo(away.dtype).max)
            at, row = np.nonzero(away <= bound[:, None].astype(away.dtype))
            apart = self._measured(part, at, row)
            order = np.lexsort((ids[row], apart, at))
            at, row, apart = at[order], row[order], apart[order]
            place = np.arange(len(at)) - np.searchsorted(at, at)
            kept = place < k
            found.append((at[kept] + low, row[kept], apart[kept]))
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _matrix(idx: pd.Series, val: pd.Series, width: int) -> np.ndarray:
    sizes = np.fromiter((len(i) for i in idx), dtype=np.int64, count=len(idx))
    made = np.zeros((len(idx), width))
    if sizes.sum():
        made[np.repeat(np.arange(len(idx)), sizes), np.concatenate(list(idx))] = np.concatenate(list(val))
    return made


def dense_vectors(df: DataFrame, values: Column, row_id: str = "row_id") -> DataFrame:
    """(row_id, idx, val) from an array column."""
    val = F.transform(values, lambda x: x.cast("double"))
    return df.withColumn("val", val).withColumn(
        "idx", F.sequence(F.lit(0), F.size("val") - 1)
    )


def knn(
    queries: DataFrame,
    train: DataFrame,
    k: int,
    p: int = 2,
    exclude: str = "none",
    pivots: int | None = None,
    chunk_rows: int | None = None,
    method: str | None = None,
) -> DataFrame:
    """(row_id, neighbor_id, y, distance, position) of the k nearest training rows of every query.

    Both tables hold row_id, idx, val; ``train`` may hold a payload ``y``. Rows are compared only
    within the same ``space`` (a class, say) if the tables have that column. ``exclude="self"``
    skips the row with the query's own id, ``"fold"`` skips rows of the query's own ``fold``.
    Equal distances are ordered by neighbour id. ``method`` is "pivots" or "inverted"; by default
    sparse rows without negative values take the latter.
    """
    if p not in (1, 2):
        raise ValueError("p must be 1 or 2")
    spark = train.sparkSession
    fill = {"space": F.lit(0), "fold": F.lit(-1), "y": F.lit(0)}

    def shaped(df: DataFrame) -> DataFrame:
        extra = {c: F.col(c).cast("int") if c in df.columns else v for c, v in fill.items()}
        return df.select(
            F.col("row_id").cast("long"),
            *[c.alias(name) for name, c in extra.items()],
            F.col("idx").cast("array<int>").alias("idx"),
            F.col("val").cast("array<double>").alias("val"),
        )

    train, queries = shaped(train), shaped(queries)
    held, asked_for = _shape(train), _shape(queries)
    n_train, n_queries = held["n"], asked_for["n"]
    least = min(held["least"] or 0.0, asked_for["least"] or 0.0)
    width = 1 + max(held["last"] or 0, asked_for["last"] or 0)
    sparse = held["entries"] + asked_for["entries"] < SPARSE * width * (n_train + n_queries)
    matrix = not sparse and width <= DENSE_VALUES // CHUNK_ROWS
    if method is None:
        method = "inverted" if least >= 0 and sparse and pivots is None else "pivots"
    if method == "inverted":
        if least < 0:
            raise ValueError("inverted lists need values of 0 or more")
        return _inverted_knn(queries, train, n_queries, n_train, k, p, exclude, chunk_rows or CHUNK_ROWS)
    if chunk_rows is None:
        chunk_rows = min(DENSE_ROWS, DENSE_VALUES // width) if matrix else CHUNK_ROWS
        if matrix:  # small tables still keep all tasks busy
            chunk_rows = max(CHUNK_ROWS, min(chunk_rows, -(-max(n_train, n_queries) // 8)))
    if pivots is None:
        # Blocks smaller than a chunk only cost tasks, so a small table gets few pivots.
        pivots = max(1, min(PIVOTS, n_train // chunk_rows))
    # A query returns rows of every block that it visits, so blocks of matrices are about as large as a chunk.
    rings = (min(RINGS, -(-n_train // (pivots * chunk_rows))) if matrix else RINGS) if n_train > chunk_rows else 1
    # A bounded number of rows, spread by hash, serve as pivots.
    seeds = train.orderBy(lehmer(F.col("row_id")), "row_id").limit(pivots).select("idx", "val").collect()
    if not seeds:
        return spark.createDataFrame([], FOUND + ", position int")
    seed_idx, seed_val = [list(s["idx"]) for s in seeds], [list(s["val"]) for s in seeds]

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centers = _Postings(seed_idx, seed_val)
        for batch in batches:
            away = [centers.distances(i, v, p) for i, v in zip(batch["idx"], batch["val"], strict=True)]
            nearest = [int(np.argmin(a)) for a in away]
            yield batch.assign(pivot=nearest, away=[float(a[n]) for a, n in zip(away, nearest, strict=True)])

    assigned = train.mapInPandas(assign, ASSIGNED)
    # Ring width comes from the pivots themselves, so no pass over the table is spent on it.
    centers = _Postings(seed_idx, seed_val)
    spread = max(float(centers.distances(i, v, p).max()) for i, v in zip(seed_idx, seed_val, strict=True))
    if spread == 0:
        spread = 1.0
    ring = F.least(F.floor(F.col("away") * rings / spread), F.lit(rings - 1)).cast("int")
    placed = assigned.withColumn("ring", ring)
    keys = ["space", "fold", "pivot", "ring"] if exclude == "fold" else ["space", "pivot", "ring"]
    stats = placed.groupBy(*keys).agg(
        F.count("*").alias("n"), F.min("away").alias("near"), F.max("away").alias("far")
    ).collect()
    if len(stats) > 200_000:
        raise ValueError("too many spaces for one neighbour search")
    blocks = pd.DataFrame([r.asDict() for r in stats])
    blocks["block"] = np.arange(len(blocks))
    blocks["chunks"] = np.ceil(blocks["n"] / chunk_rows).astype(int)
    if "fold" not in blocks:
        blocks["fold"] = -1
    query_chunks = max(1, -(-n_queries // chunk_rows))
    need = k + 1 if exclude == "self" else k

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centers = _Postings(seed_idx, seed_val)
        by_space = {
            space: {c: part[c].to_numpy() for c in ("fold", "pivot", "near", "far", "n", "block")}
            for space, part in blocks.groupby("space")
        }
        nothing = {c: blocks[c].to_numpy()[:0] for c in ("fold", "pivot", "near", "far", "n", "block")}
        for batch in batches:
            visits = []
            for space, fold, idx, val in zip(batch["space"], batch["fold"], batch["idx"], batch["val"], strict=True):
                open_to = by_space.get(space, nothing)
                allowed = open_to["fold"] != fold if exclude == "fold" else np.ones(len(open_to["fold"]), bool)
                center = centers.distances(idx, val, p)[open_to["pivot"]]
                near, far = open_to["near"], open_to["far"]
                most = np.where(allowed, center + far, np.inf)
                order = np.argsort(most, kind="stable")
                enough = np.searchsorted(np.cumsum(np.where(allowed, open_to["n"], 0)[order]), need)
                bound = most[order[enough]] if enough < len(order) else np.inf
                least = np.maximum(np.maximum(center - far, near - center), 0.0)
                near_enough = allowed & (least <= bound * (1 + 1e-9) + 1e-9)
                visits.append(open_to["block"][near_enough].astype(np.int32))
            yield batch.assign(blocks=visits)

    table = spark.createDataFrame(
        [tuple(int(v) for v in row) for row in blocks[[*keys, "block", "chunks"]].itertuples(index=False)],
        ", ".join(f"{c} int" for c in [*keys, "block", "chunks"]),
    )
    routed = queries.drop("y").mapInPandas(
        route, "row_id long, space int, fold int, idx array<int>, val array<double>, blocks array<int>"
    )
    part = F.pmod(lehmer(F.col("row_id"), 11), F.lit(query_chunks)).cast("int").alias("part")
    visiting = stored(routed.select("row_id", "fold", "idx", "val", part, "blocks"), "knn-visits")
    visits = visiting.select("part", F.explode("blocks").alias("block")).distinct().toDF("part", "block")
    here = placed.join(F.broadcast(table), keys).join(visits, "block").select(
        F.col("row_id").alias("t_id"),
        "y",
        F.col("fold").alias("t_fold"),
        F.col("idx").alias("t_idx"),
        F.col("val").alias("t_val"),
        "block",
        F.pmod(lehmer(F.col("row_id"), 7), F.col("chunks")).cast("int").alias("chunk"),
        "part",
    )
    asked = (
        visiting.withColumn("block", F.explode("blocks"))
        .join(F.broadcast(table.select("block", "chunks")), "block")
        .select("row_id", "fold", "idx", "val", "block", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "part")
    )
    return _nearest(asked, here, ["block", "chunk", "part"], k, p, exclude, width if matrix else None)


def _shape(rows: DataFrame) -> dict:
    """Rows, entries, the last term and the least value of a table of sparse rows."""
    return rows.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(F.size("idx")), F.lit(0)).alias("entries"),
        F.max(F.array_max("idx")).alias("last"),
        F.min(F.array_min("val")).alias("least"),
    ).first().asDict()


def _inverted_knn(
    queries: DataFrame, train: DataFrame, n_queries: int, n_train: int, k: int, p: int, exclude: str, chunk_rows: int,
    hot_pairs: int = inverted.HOT_PAIRS,
) -> DataFrame:
    need = k + 1 if exclude == "self" else k
    keys = ["space", "fold"] if exclude == "fold" else ["space"]
    n_blocks, n_parts = max(1, -(-n_train // chunk_rows)), max(1, -(-n_queries // chunk_rows))
    term = inverted.heaviest_term()

    def grouped(name: str, groups: int) -> Column:
        return F.pmod(lehmer(F.coalesce(term, F.lit(0)), 5), F.lit(groups)).cast("int").alias(name)

    normed = stored(train.select("*", inverted.norm(p).alias("norm"), grouped("block", n_blocks)), "knn-rows")
    light = stored(inverted.lightest(normed, need, keys), "knn-light")
    asking = stored(queries.select("*", grouped("part", n_parts)), "knn-queries")
    held = normed.join(light.select("row_id"), "row_id", "left_anti").where(F.size("idx") > 0)
    seen = inverted.visits(held, asking, light, need, exclude == "fold", p, hot_pairs)
    # The lightest rows are one more block, which every part visits.
    lightest = normed.join(light.select("row_id"), "row_id", "left_semi").withColumn("block", F.lit(inverted.LIGHT))
    parts = asking.groupBy("space", "part").agg(F.ceil(F.count("*") / chunk_rows).cast("int").alias("shares"))
    everywhere = parts.select("space", F.lit(inverted.LIGHT).alias("block"), "part")
    every_row = held.unionByName(lightest)
    chunks = every_row.groupBy("space", "block").agg(F.ceil(F.count("*") / chunk_rows).cast("int").alias("chunks"))
    cells = seen.unionByName(everywhere).join(chunks, ["space", "block"]).join(parts, ["space", "part"])
    cells = stored(cells, "knn-cells")
    # Chunks of a block and shares of a part are dealt out before rows meet them, so that no key of a join is hot.
    dealt = lookup_join(every_row, chunks, ["space", "block"]).withColumn("chunk", F.pmod(lehmer(F.col("row_id"), 7), F.col("chunks")).cast("int"))
    shared = lookup_join(asking, parts, ["space", "part"]).withColumn("share", F.pmod(lehmer(F.col("row_id"), 13), F.col("shares")).cast("int"))
    numbers = {n: F.explode(F.sequence(F.lit(0), F.col(f"{n}s") - 1)).alias(n) for n in ("chunk", "share")}
    all_cells = cells.select("space", "block", "part", "shares", numbers["chunk"]).select("space", "block", "part", "chunk", numbers["share"])
    here = dealt.join(all_cells, ["space", "block", "chunk"]).select(
        F.col("row_id").alias("t_id"), "y", F.col("fold").alias("t_fold"), F.col("idx").alias("t_idx"), F.col("val").alias("t_val"),
        "space", "block", "chunk", "part", "share",
    )
    asked = shared.join(all_cells, ["space", "part", "share"]).select(
        "row_id", "fold", "idx", "val", "space", "block", "chunk", "part", "share"
    )
    return _nearest(asked, here, ["space", "block", "chunk", "part", "share"], k, p, exclude)


def _nearest(
    asked: DataFrame, here: DataFrame, where: list[str], k: int, p: int, exclude: str, width: int | None = None
) -> DataFrame:
    """The k nearest of ``here`` for each row of ``asked``, compared only where they meet in the cells ``where``.

    With a ``width``, rows are compared as matrices of that many columns; rows with values that are not finite go one by one.
    """
    skip_self, skip_fold = exclude == "self", exclude == "fold"

    def by_matrix(asking: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame | None:
        dense = _Dense(held["t_idx"], held["t_val"], width, p)
        queries = _matrix(asking["idx"], asking["val"], width)
        if not dense.finite or not np.isfinite(queries).all() or np.abs(queries).max(initial=0.0) > 1e14:
            return None
        compared = {"self": ("row_id", "t_id"), "fold": ("fold", "t_fold")}.get(exclude)
        mine, theirs = (asking[compared[0]].to_numpy(), held[compared[1]].to_numpy()) if compared else (None, None)
        ids = held["t_id"].to_numpy()
        at, row, away = dense.nearest(queries, ids, k, mine, theirs)
        return pd.DataFrame({
            "row_id": asking["row_id"].to_numpy()[at], "neighbor_id": ids[row], "y": held["y"].to_numpy()[row], "distance": away,
        })

    def search(asking: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        found = []
        if width is not None and len(asking) and len(held):
            done = by_matrix(asking, held)
            if done is not None:
                return done
        if len(asking) and len(held):
            postings = _Postings(list(held["t_idx"]), list(held["t_val"]))
            ids, ys, folds = held["t_id"].to_numpy(), held["y"].to_numpy(), held["t_fold"].to_numpy()
            for row_id, fold, idx, val in zip(asking["row_id"], asking["fold"], asking["idx"], asking["val"], strict=True):
                away = postings.distances(idx, val, p)
                if skip_self:
                    away = np.where(ids == row_id, np.inf, away)
                elif skip_fold:
                    away = np.where(folds == fold, np.inf, away)
                best = np.lexsort((ids, away))[:k]
                best = best[np.isfinite(away[best])]
                found.append((np.full(len(best), row_id), ids[best], ys[best], away[best]))
        columns = [np.concatenate(part) for part in zip(*found, strict=True)] if found else [[], [], [], []]
        return pd.DataFrame(dict(zip(("row_id", "neighbor_id", "y", "distance"), columns, strict=True)))

    candidates = asked.groupBy(*where).cogroup(here.groupBy(*where)).applyInPandas(search, FOUND)
    nearest = Window.partitionBy("row_id").orderBy("distance", "neighbor_id")
    return candidates.withColumn("position", F.row_number().over(nearest)).where(F.col("position") <= k)


def knn_votes(neighbors: DataFrame, cells: list[dict], labels: list) -> DataFrame:
    """(row_id, cell, prediction) for every (n_neighbors, weights) cell from one neighbour table.

    ``y`` is the class position in ``labels``. Weights are 1, or 1/distance where neighbours at
    distance zero outvote all others. Ties go to the first class. The table comes partitioned by
    ``row_id``, so no grouping here shuffles again.
    """
    settings = F.array(
        *[
            F.struct(
                F.lit(cell["cell"]).alias("cell"),
                F.lit(cell["n_neighbors"]).alias("k"),
                F.lit(cell.get("weights", "uniform") == "uniform").alias("uniform"),
            )
            for cell in cells
        ]
    )
    closest = F.min("distance").over(Window.partitionBy("row_id"))
    voters = neighbors.withColumn("closest", closest).select("*", F.inline(settings)).where(F.col("position") <= F.col("k"))
    touching = (F.col("distance") == 0).cast("double")
    inverse = 1.0 / F.when(F.col("distance") > 0, F.col("distance"))
    weight = F.when(F.col("uniform"), 1.0).when(F.col("closest") == 0, touching).otherwise(inverse)
    votes = voters.groupBy("row_id", "cell", "y").agg(F.round(F.sum(weight), 9).alias("vote"))
    best = votes.groupBy("row_id", "cell").agg(F.max(F.struct("vote", (-F.col("y")).alias("order"))).alias("best"))
    names = F.array(*[F.lit(v) for v in labels])
    return best.select("row_id", "cell", F.element_at(names, 1 - F.col("best.order")).alias("prediction"))
