from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinara.operators import logistic
from opinara.plans import classify

SCHEMA = "row_id long, y int, fold int, idx array<int>, val array<double>"
TERMS = 30


def made_rows(n, n_classes, seed=5):
    """Rows whose class leans on their terms; some have no term at all."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        idx = np.unique(rng.integers(0, TERMS, rng.integers(0, 7)))
        val = rng.random(len(idx)) + 0.1
        y = int(idx.sum() + rng.integers(0, 2)) % n_classes if len(idx) else 0
        rows.append((i * 7, y, i % 5, [int(t) for t in idx], [float(v) for v in val]))
    return rows


def plain_fit(rows, problem, n_classes):
    """Proximal gradients on dense arrays until nothing moves."""
    rows = [r for r in rows if r[2] != problem.held]
    x = np.zeros((len(rows), TERMS + 1))
    x[:, TERMS] = 1
    for i, r in enumerate(rows):
        x[i, r[3]] = r[4]
    y, weight = np.array([r[1] for r in rows]), 1 / (problem.strength * len(rows))
    free = (np.arange(TERMS + 1) < TERMS)[:, None]
    w = np.zeros((TERMS + 1, logistic.width(n_classes)))
    rate = 1 / (np.linalg.eigvalsh(x.T @ x / len(rows))[-1] + weight)
    for _ in range(20_000):
        if n_classes == 2:
            miss = 1 / (1 + np.exp(-(x @ w))) - y[:, None]
        else:
            e = np.exp(x @ w)
            miss = e / e.sum(axis=1, keepdims=True) - np.eye(n_classes)[y]
        new = w - rate * (x.T @ miss / len(rows) + free * weight * (1 - problem.l1_ratio) * w)
        cut = free * rate * weight * problem.l1_ratio
        new = np.sign(new) * np.maximum(np.abs(new) - cut, 0)
        if np.abs(new - w).max() < 1e-10:
            break
        w = new
    return w, x @ w


@pytest.mark.parametrize("n_classes", [2, 3])
def test_weights_equal_a_plain_fit(spark, monkeypatch, n_classes):
    """Ridge, lasso, a mix and a held-out fold at once, on several blocks."""
    monkeypatch.setattr(logistic, "BLOCK_ENTRIES", 300)
    rows = made_rows(200, n_classes)
    problems = [
        logistic.Problem(0.1, 0.0, 500),
        logistic.Problem(0.3, 1.0, 500),
        logistic.Problem(0.1, 0.5, 500, held=2),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    blocks = logistic.pack(df, TERMS)
    assert blocks.packed.count() > 1
    fitted = logistic.fit(df, problems, n_classes, TERMS, tolerance=1e-6, blocks=blocks)
    each = logistic.width(n_classes)
    found = np.zeros((TERMS + 1, each * len(problems)))
    for r in fitted.collect():
        found[r.term_id] = r.x
    sums = {r.row_id: r.m for r in logistic.margins(blocks, fitted, each * len(problems)).collect()}
    assert len(sums) == len(rows)
    for i, problem in enumerate(problems):
        want, seen = plain_fit(rows, problem, n_classes)
        mine = slice(i * each, (i + 1) * each)
        assert np.abs(found[:TERMS, mine] - want[:TERMS]).max() < 1e-4
        if problem.l1_ratio == 1:
            assert ((want[:TERMS] == 0) == (found[:TERMS, mine] == 0)).mean() > 0.95 and (want[:TERMS] == 0).any()
        if problem.held is None:
            near = np.array([sums[r[0]][mine] for r in rows])
            centred = (lambda m: m - m.mean(axis=1, keepdims=True)) if n_classes > 2 else (lambda m: m)
            assert np.abs(centred(near) - centred(seen)).max() < 1e-3
    blocks.release()


def test_problems_beyond_a_pass_are_fitted_in_turn(spark, monkeypatch):
    df = spark.createDataFrame(made_rows(60, 3), SCHEMA)
    problems = [logistic.Problem(0.1, 0.0, 4), logistic.Problem(0.2, 1.0, 4)]
    whole = {r.term_id: r.x for r in logistic.fit(df, problems, 3, TERMS).collect()}
    monkeypatch.setattr(logistic, "PASS_COLUMNS", 3)
    parts = {r.term_id: r.x for r in logistic.fit(df, problems, 3, TERMS).collect()}
    assert whole.keys() == parts.keys() and all(np.allclose(whole[t], parts[t]) for t in whole)


def test_empty_table_and_unknown_terms(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert logistic.fit(none, [logistic.Problem()], 3, TERMS).collect() == []
    asked = spark.createDataFrame([(1, [3], [2.0]), (2, [], [])], "row_id long, idx array<int>, val array<double>")
    weights = spark.createDataFrame([(TERMS, [0.5, 1.0, 0.0])], "term_id int, x array<double>")
    got = logistic.margins(logistic.pack(asked, TERMS), weights, 3)
    assert {r.row_id: r.m for r in got.collect()} == {1: [0.5, 1.0, 0.0], 2: [0.5, 1.0, 0.0]}
    tied = spark.range(1).select(logistic.likeliest(F.array(F.lit(1.0), F.lit(2.0), F.lit(2.0)), F.lit(0), 3).alias("c"))
    assert tied.first().c == 1


def test_large_models_are_trained_saved_and_loaded(spark, tmp_path):
    """Beyond ``driver_weights``, and with a solver that the library refuses for L1."""
    words = [["good", "fine", "great"], ["bad", "poor", "awful"]]
    rows = [(i, 5 if i % 2 == 0 else 1, f"{words[i % 2][i % 3]} thing {words[i % 2][(i + 1) % 3]}") for i in range(60)]
    df = spark.createDataFrame(rows, "row_id long, score int, text string")
    grid = {"C": [10.0], "l1_ratio": [0, 1], "solver": ["lbfgs"], "max_iter": [12]}
    spec = classify.JobSpec("score", "logistic_regression", grid, text_process="bow", unique_category_threshold=2, driver_weights=0)
    trained = classify.train(df, spec)
    assert all(r.f1 is not None and r.f1 > 0.9 for r in trained.scores.collect()) and trained.scores.count() == 2
    first = {r.row_id: r.prediction for r in classify.predict(trained, df.drop("score")).collect()}
    assert first == {i: "positive" if i % 2 == 0 else "negative" for i in range(60)}
    classify.save(trained, str(tmp_path / "model"))
    again = classify.load(spark, str(tmp_path / "model"))
    assert {r.row_id: r.prediction for r in classify.predict(again, df).collect()} == first


def test_packed_rows_and_what_a_step_reads_of_them(spark):
    rows = spark.createDataFrame(
        [(1, 0, 0, [0, 2], [0.5, 2.0]), (2, 1, 1, [], []), (3, 1, 0, [2], [4.0])],
        "row_id long, y int, fold int, idx array<int>, val array<double>",
    )
    blocks = logistic.pack(rows, 3)
    block = blocks.packed.first()
    assert (block["ids"], block["starts"], block["terms"]) == ([1, 2, 3], [0, 3, 4], [0, 2, 3])
    assert (block["local"], block["val"]) == ([0, 1, 2, 2, 1, 2], [0.5, 2.0, 1.0, 1.0, 4.0, 1.0])
    zeros = F.array(F.lit(0.0))
    state = spark.createDataFrame([(0,), (2,), (3,)], "term_id int").select("term_id", zeros.alias("x"), zeros.alias("prev"))
    step = logistic._gradients(blocks, state, [logistic.Problem()], [0.0], 2)
    assert {r["term_id"]: r["g"] for r in step.collect()} == {0: [0.25], 2: [-1.0], 3: [-0.5]}
    plan = step._jdf.queryExecution().executedPlan().toString()
    read = [columns for columns in re.findall(r"InMemoryTableScan \[([^\]]*)\]", plan) if "starts" in columns]
    assert read and not any("ids" in columns for columns in read)
    blocks.release()


def test_library_models_are_fitted_without_the_vocabulary_on_the_driver(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("the vocabulary was collected")

    monkeypatch.setattr(classify.mlmodels, "text_stages", refuse)
    rows = [(i, 5 if i % 2 == 0 else 1, "good fine thing" if i % 2 == 0 else "bad poor thing") for i in range(40)]
    df = spark.createDataFrame(rows, "row_id long, score int, text string")
    grid = {"C": [10.0], "l1_ratio": [0], "solver": ["lbfgs"], "max_iter": [5]}
    spec = classify.JobSpec("score", "logistic_regression", grid, text_process="tf-idf", unique_category_threshold=2)
    assert classify.train(df, spec).scores.first()["f1"] > 0.9
