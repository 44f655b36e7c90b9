from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinara.operators import inverted, neighbors

SCHEMA = "row_id long, space int, y int, fold int, idx array<int>, val array<double>"


def rows_of(n, width, seed, spaces=2):
    """Sparse rows with copies, empty rows, equal norms and a term that most rows have."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        size = int(rng.integers(0, 5))
        idx = set(int(x) for x in rng.choice(width, size, replace=False)) | ({0} if rng.random() < 0.6 and size else set())
        idx = sorted(idx)
        val = [float(rng.integers(1, 3)) for _ in idx]
        if i % 7 == 0 and i:
            idx, val = rows[i // 2][4], rows[i // 2][5]
        rows.append((i, i % spaces, int(rng.integers(0, 3)), int(rng.integers(0, 5)), idx, val))
    return rows


def brute(queries, rows, k, p, skip):
    width = 1 + max(max(r[4], default=0) for r in [*queries, *rows])

    def dense(table):
        out = np.zeros((len(table), width))
        for i, r in enumerate(table):
            out[i, r[4]] = r[5]
        return out

    q, t = dense(queries), dense(rows)
    want = {}
    for i, a in enumerate(queries):
        diff = np.abs(t - q[i])
        away = diff.sum(axis=1) if p == 1 else np.sqrt(np.round((diff**2).sum(axis=1), 12))
        want[a[0]] = sorted((round(away[j], 9), b[0]) for j, b in enumerate(rows) if a[1] == b[1] and not skip(a, b))[:k]
    return want


def found(df):
    got = {}
    for r in df.orderBy("row_id", "position").collect():
        got.setdefault(r["row_id"], []).append((round(r["distance"], 9), r["neighbor_id"]))
    return got


@pytest.mark.parametrize("exclude", ["none", "self", "fold"])
@pytest.mark.parametrize("p", [1, 2])
def test_equals_brute_force(spark, p, exclude):
    rows = rows_of(260, 40, p)
    df = spark.createDataFrame(rows, SCHEMA)
    skip = {"none": lambda a, b: False, "self": lambda a, b: a[0] == b[0], "fold": lambda a, b: a[3] == b[3]}[exclude]
    got = found(neighbors.knn(df, df, 4, p, exclude, chunk_rows=24, method="inverted"))
    assert got == {i: near for i, near in brute(rows, rows, 4, p, skip).items() if near}


@pytest.mark.parametrize("hot_pairs", [0, 3, 10**6])
def test_hot_terms_change_nothing(spark, hot_pairs):
    rows = rows_of(200, 30, 9, spaces=1)
    df = spark.createDataFrame(rows, SCHEMA)
    shaped = df.select("row_id", "space", "fold", "y", "idx", "val")
    got = found(neighbors._inverted_knn(shaped, shaped, 200, 200, 3, 2, "self", 16, hot_pairs))
    assert got == brute(rows, rows, 3, 2, lambda a, b: a[0] == b[0])


def test_a_third_are_copies_of_one_row(spark):
    rows = [(i, 0, 0, 0, [1, 5], [1.0, 2.0]) if i % 3 == 0 else (i, 0, 0, 0, [i % 20], [1.0 + i % 4]) for i in range(150)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = found(neighbors.knn(df, df, 5, 2, "self", chunk_rows=10, method="inverted"))
    assert got == brute(rows, rows, 5, 2, lambda a, b: a[0] == b[0])


def test_equal_distances_at_the_boundary_go_by_id(spark):
    rows = [(i, 0, 0, 0, [i], [1.0]) for i in range(60)]  # all rows are equally far from each other
    df = spark.createDataFrame(rows, SCHEMA)
    got = found(neighbors.knn(df, df, 4, 2, "self", chunk_rows=8, method="inverted"))
    assert {i: [n for _, n in near] for i, near in got.items()} == {i: [j for j in range(6) if j != i][:4] for i in range(60)}


def test_rows_go_only_to_parts_that_visit_their_block(spark):
    """Groups of rows without a common term: a part visits its own group's block, and no other."""
    rows = [(i, 0, 0, 0, [10 * (i % 8), 10 * (i % 8) + 1 + i % 3], [3.0, 1.0 + i % 2]) for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    term = inverted.heaviest_term()
    held = df.withColumn("norm", inverted.norm(2)).withColumn("block", term)
    light = inverted.lightest(held, 4, ["space"])
    seen = inverted.visits(held, df.withColumn("part", term), light, 4, False, 2).collect()
    assert {(r["block"], r["part"]) for r in seen} == {(10 * g, 10 * g) for g in range(8)}
    heavy = held.withColumn("val", F.transform("val", lambda x: x * F.when(F.col("block") == 0, 100.0).otherwise(1.0)))
    heavy = heavy.withColumn("norm", inverted.norm(2))
    small = df.withColumn("part", term).where("part = 0").withColumn("val", F.transform("val", lambda x: x / 100))
    light = inverted.lightest(heavy, 4, ["space"])
    assert inverted.visits(heavy, small, light, 4, False, 2).count() == 0  # what they could gain is less than their norm


def test_pivots_copy_rows_only_where_they_are_compared(spark, monkeypatch):
    """Far groups: each query visits its own block, and every training row is moved once."""
    rows = [(i, 0, 0, 0, [0, 1], [256.0 * (i % 4) + i / 64, float(i % 3)]) for i in range(320)]
    df = spark.createDataFrame(rows, SCHEMA)
    seen = []
    real = neighbors._nearest
    monkeypatch.setattr(neighbors, "_nearest", lambda asked, here, *rest: seen.append((asked.count(), here.count())) or real(asked, here, *rest))
    got = found(neighbors.knn(df, df, 3, 2, "self", pivots=8, chunk_rows=400))
    assert got == brute(rows, rows, 3, 2, lambda a, b: a[0] == b[0])
    (asked, here), = seen
    assert here <= 320 and asked < 320 * 8


def test_negative_values_are_refused(spark):
    df = spark.createDataFrame([(1, 0, 0, 0, [1], [-1.0])], SCHEMA)
    with pytest.raises(ValueError, match="0 or more"):
        neighbors.knn(df, df, 1, method="inverted")


def test_empty_tables(spark):
    none, one = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, 0, 0, 0, [1], [1.0])], SCHEMA)
    for method in ("inverted", "pivots"):
        assert neighbors.knn(none, one, 2, method=method).count() == 0
        assert neighbors.knn(one, none, 2, method=method).count() == 0


@pytest.mark.parametrize("p", [1, 2])
def test_matrices_measure_few_pairs_and_find_the_nearest(p, monkeypatch):
    rng = np.random.default_rng(7)
    rows = np.round(rng.normal(size=(1500, 8)), 3) + 1000 * (p == 2)
    rows[1000:1100] = rows[0]  # ties, ordered by id
    ids = rng.permutation(1500) // 2  # ids that come twice
    idx, val = [list(range(8))] * 1500, list(rows)
    dense = neighbors._Dense(idx, val, 8, p)
    measured, real = [0], neighbors._Dense._measured
    def counted(self, asked, at, row):
        measured[0] += len(at)
        return real(self, asked, at, row)
    monkeypatch.setattr(neighbors._Dense, "_measured", counted)
    asked = rows[:900:9]
    at, row, away = dense.nearest(asked, ids, 4, ids[:900:9], ids)
    assert measured[0] < 100 * 20 + 2 * 110
    for i, q in enumerate(asked):
        apart = np.abs(rows - q)
        total = np.round(apart.sum(axis=1) if p == 1 else (apart * apart).sum(axis=1), 12)
        apart = np.where(ids == ids[9 * i], np.inf, total if p == 1 else np.sqrt(total))
        want = np.lexsort((ids, apart))[:4]
        assert list(ids[row[at == i]]) == list(ids[want]) and np.allclose(away[at == i], apart[want], rtol=0, atol=1e-9)
