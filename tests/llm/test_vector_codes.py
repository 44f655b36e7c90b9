from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinara.llm import vector_codes as vc


def plain(rows, parts, entries, rounds, scale):
    """(row, code) and codebooks by one comparison of each part with each entry, in Python integers."""
    import math

    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-max(len(r[1]) for r in kept) // parts)
    table = [[math.floor(scale * x) for x in r[1]] + [0] * (parts * width - len(r[1])) for r in kept]
    cut = [[row[p * width : (p + 1) * width] for p in range(parts)] for row in table]
    books = [[row[p] for row in cut[:entries]] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for row in cut:
                groups.setdefault(nearest(row[p], books[p])[1], []).append(row[p])
            books[p] = [
                [sum(c) // len(groups[i]) for c in zip(*groups[i], strict=True)] if i in groups else e for i, e in enumerate(books[p])
            ]
    found = [[nearest(row[p], books[p]) for p in range(parts)] for row in cut]
    return [(r[0], "".join(f"{i:02x}" for _, i in f), min(sum(d for d, _ in f), vc.LONGEST)) for r, f in zip(kept, found, strict=True)], books


def both(spark, rows, parts=2, entries=5, rounds=2, scale=256):
    df = spark.createDataFrame([(*r, "a", 1.5) for r in rows], "vec_id long, v array<double>, code string, error double").repartition(3)
    df = df.drop("code", "error")
    books = vc.fit(df, "v", ["vec_id"], parts, entries, rounds, scale)
    got = [tuple(r) for r in vc.encode(df, "v", books, scale=scale).collect()]
    want, want_books = plain(rows, parts, entries, rounds, scale)
    assert [b.tolist() for b in books.entries] == want_books
    assert sorted(got, key=str) == sorted(want, key=str)
    return got


def test_equals_plain_version(spark):
    draw = random.Random(3)
    rows = [(i, [draw.gauss(0, 0.05) for _ in range(6)]) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(200)]  # a large group of copies
    both(spark, rows)
    both(spark, rows, parts=3, entries=17, rounds=3)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, [0.5, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (None, [0.1, 0.2, 0.3, 0.4]), (5, [0.1]), (5, []),
            (6, [-0.001, -1.0, 2.0, 0.0]), (6, [-0.001, -1.0, 2.0, 0.0]), (7, [0.0, -0.0, 0.1, 0.1])]
    assert len(both(spark, rows)) == 6


def test_large_numbers_stay_exact(spark):
    draw = random.Random(5)
    rows = [(i, [draw.choice([-1, 1]) * draw.random() * 10.0 ** draw.randrange(0, 30) for _ in range(4)]) for i in range(60)]
    assert max(r[2] for r in both(spark, rows)) == vc.LONGEST
    middle = [(i, [draw.uniform(-1, 1) * 10.0**6 for _ in range(4)]) for i in range(60)]
    assert max(r[2] for r in both(spark, middle)) < vc.LONGEST


@pytest.mark.parametrize("leaves", [1, 3, 64])
def test_walk_in_runs_of_any_size(monkeypatch, leaves):
    draw = np.random.default_rng(1)
    parts = draw.integers(-3, 4, (500, 3))
    book = draw.integers(-3, 4, (9, 3))
    found, place, copies = vc.distinct_parts(parts)
    assert copies.sum() == 500 and (found[place] == parts).all()
    assert [tuple(x) for x in found.tolist()] == sorted({tuple(x) for x in parts.tolist()})
    monkeypatch.setattr(vc, "LEAVES", leaves)
    best, away = vc.walk(found, book)
    full = ((found[:, None, :] - book[None]) ** 2).sum(axis=2)
    assert (best == full.argmin(axis=1)).all() and (away == full.min(axis=1)).all()


def test_empty_table(spark, tmp_path):
    schema = "vec_id long, embedding array<float>, label int, extra string"
    spark.createDataFrame([(1, None, 1, "x")], schema).write.parquet(f"{tmp_path}/a/embeddings.parquet")
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/b/embeddings.parquet")
    assert vc.op13_vector_codes(spark, f"{tmp_path}/a").count() == 0
    assert vc.op13_vector_codes(spark, f"{tmp_path}/b").columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_label_errors_take_nulls_together(spark, tmp_path):
    rows = [(i, [0.1 * (i % 7)] * 32, None if i % 3 else 4, "x") for i in range(200)] + [(3, [0.7] * 32, 0, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, error string")
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = vc.op13_vector_codes(spark, str(tmp_path)).join(df.select("vec_id", "label"), "vec_id").dropDuplicates()
    sums = got.groupBy("label").agg(F.countDistinct("label_error").alias("n"))
    assert {r["n"] for r in sums.collect() if r["label"] != 0} == {1}
