from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinara.operators import augment, bayes, neighbors, phrases, sampling, topics
from opinara.plans import classify
from opinara.plans import topics as topic_plan


def sparse_rows(n, width, seed, negative=False):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        size = int(rng.integers(0, 6))
        idx = sorted(int(x) for x in rng.choice(width, size, replace=False))
        low = -3 if negative else 1
        rows.append((i, int(rng.integers(0, 3)), int(rng.integers(0, 5)), idx, [float(v) for v in rng.integers(low, 4, size)]))
    return rows


def brute(rows, k, p, skip):
    width = 1 + max([max(r[3], default=0) for r in rows])
    dense = np.zeros((len(rows), width))
    for r in rows:
        dense[r[0], r[3]] = r[4]
    want = {}
    for a in rows:
        diff = np.abs(dense - dense[a[0]])
        away = diff.sum(axis=1) if p == 1 else np.sqrt((diff**2).sum(axis=1))
        near = sorted((round(away[b[0]], 9), b[0]) for b in rows if not skip(a, b))[:k]
        want[a[0]] = near
    return want


@pytest.mark.parametrize("p", [1, 2])
@pytest.mark.parametrize("exclude", ["self", "fold"])
def test_knn_blocks_match_brute_force(spark, p, exclude):
    """Small chunks and many pivots, so routing, rings and chunking are all used."""
    rows = sparse_rows(300, 12, p, negative=True)
    df = spark.createDataFrame(rows, "row_id long, y int, fold int, idx array<int>, val array<double>")
    if exclude == "self":
        df = df.drop("fold")
    found = neighbors.knn(df, df, 4, p, exclude, pivots=5, chunk_rows=32).collect()
    skip = (lambda a, b: a[0] == b[0]) if exclude == "self" else (lambda a, b: a[2] == b[2])
    want = brute(rows, 4, p, skip)
    got = {i: [] for i in want}
    for r in sorted(found, key=lambda r: r["position"]):
        got[r["row_id"]].append((round(r["distance"], 9), r["neighbor_id"]))
    assert got == want


def test_knn_with_a_hot_point(spark):
    """A third of the rows are copies of one vector."""
    rows = [(i, 0, 0, [0], [1.0 if i % 3 == 0 else float(i)]) for i in range(200)]
    df = spark.createDataFrame(rows, "row_id long, y int, fold int, idx array<int>, val array<double>").drop("fold")
    found = neighbors.knn(df, df, 3, 2, "self", pivots=3, chunk_rows=16).collect()
    want = brute(rows, 3, 2, lambda a, b: a[0] == b[0])
    assert {(r["row_id"], r["neighbor_id"]) for r in found} == {(i, n) for i, near in want.items() for _, n in near}


def test_votes(spark):
    near = spark.createDataFrame(
        [(1, 9, 2, 0.0, 1), (1, 8, 1, 1.0, 2), (1, 7, 1, 1.0, 3), (2, 9, 0, 1.0, 1), (2, 8, 1, 1.0, 2)],
        "row_id long, neighbor_id long, y int, distance double, position int",
    )
    cells = [{"cell": 0, "n_neighbors": 3, "weights": "uniform"}, {"cell": 1, "n_neighbors": 3, "weights": "distance"}]
    got = {(r["row_id"], r["cell"]): r["prediction"] for r in neighbors.knn_votes(near, cells, ["a", "b", "c"]).collect()}
    assert got == {(1, 0): "b", (1, 1): "c", (2, 0): "a", (2, 1): "a"}


def test_smote_lies_between_parents(spark):
    rows = [(i, 0 if i < 30 else 1, [0, 1], [float(i), float(i * i % 17)]) for i in range(38)]
    df = spark.createDataFrame(rows, "row_id long, y int, idx array<int>, val array<double>")
    made = sampling.smote(df).collect()
    assert len(made) == 22
    values = {r[0]: r[3] for r in rows}
    for r in made:
        a, b = values[r["row_id"]], values[r["neighbor_id"]]
        assert r["y"] == 1 and r["row_id"] != r["neighbor_id"]
        assert all(min(x, y) - 1e-9 <= v <= max(x, y) + 1e-9 for x, y, v in zip(a, b, r["val"], strict=True))
    with pytest.raises(ValueError, match="more than 5"):
        sampling.smote(df.where("row_id < 35"))


def test_oversample_counts(spark):
    df = spark.range(100).select(F.col("id").alias("row_id"), F.when(F.col("id") < 70, "a").when(F.col("id") < 95, "b").otherwise("c").alias("label"))
    grown = sampling.random_oversample(df, "label")
    assert {r["label"]: r["count"] for r in grown.groupBy("label").count().collect()} == {"a": 70, "b": 70, "c": 70}
    assert grown.select("row_id", "copy").distinct().count() == 210
    cut = sampling.random_undersample(df, "label")
    assert {r["label"]: r["count"] for r in cut.groupBy("label").count().collect()} == {"a": 5, "b": 5, "c": 5}


def test_rows_of_a_held_fold_are_not_drawn_for_it(spark):
    label = F.when(F.col("id") < 70, "a").when(F.col("id") < 95, "b").otherwise("c").alias("label")
    df = spark.range(100).select(F.col("id").alias("row_id"), label, (F.col("id") % 5).cast("int").alias("fold"))
    grown = sampling.resample_inside_folds(df, "label", "oversampling")
    assert grown.where("held = fold").count() == 0
    assert {(r["held"], r["label"]): r["count"] for r in grown.groupBy("held", "label").count().collect()} == {
        (held, name): 56 for held in range(5) for name in "abc"
    }
    assert grown.select("held", "row_id", "copy").distinct().count() == 5 * 3 * 56
    alone = sampling.random_oversample(df.where("fold <> 2"), "label").select("row_id", "copy")
    assert sorted(map(tuple, alone.collect())) == sorted(map(tuple, grown.where("held = 2").select("row_id", "copy").collect()))
    cut = sampling.resample_inside_folds(df, "label", "undersampling")
    assert cut.where("held = fold").count() == 0
    assert {r["count"] for r in cut.groupBy("held", "label").count().collect()} == {4} and cut.count() == 60
    assert sampling.resample_inside_folds(df.where("row_id < 0"), "label", "oversampling").count() == 0
    with pytest.raises(ValueError, match="neither"):
        sampling.resample_inside_folds(df, "label", "none")


def test_sample_size_bounds(spark, monkeypatch):
    df = spark.range(50).withColumnRenamed("id", "row_id")
    for n in (0, 51):
        with pytest.raises(ValueError):
            sampling.sample_n(df, n)
    small = {r["row_id"] for r in sampling.sample_n(df, 20).collect()}
    monkeypatch.setattr(sampling, "TOP_N_ROWS", 5)
    assert {r["row_id"] for r in sampling.sample_n(df, 20).collect()} == small


def test_phrases_merge_greedily(spark):
    docs = [(i, ["new", "york", "new", "york", f"w{i}"]) for i in range(20)] + [(99, ["york", "new"]), (100, [])]
    df = spark.createDataFrame(docs, "row_id long, tokens array<string>")
    scores = spark.createDataFrame([("new", "york"), ("york", "new")], "a string, b string")
    got = {r["row_id"]: r["tokens"] for r in phrases.merge_phrases(df, scores).collect()}
    assert got[3] == ["new_york", "new_york", "w3"] and got[99] == ["york_new"] and got[100] == []


def test_phrases_merge_inside_their_rows(spark, monkeypatch):
    rng = np.random.default_rng(5)
    docs = [(i, [str(w) for w in rng.choice(["a", "b", "c", "é", "f g"], size)]) for i, size in enumerate([0, 1, 2, 3, 9, 60] * 9)]
    schema = "row_id long, tokens array<string>"
    df = spark.createDataFrame([*docs, (None, ["a", "b"]), (99, None)], schema).repartition(3)
    pairs = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("a", "a"), ("é", "f g")], "a string, b string")

    def merged(rows):
        made = phrases.merge_phrases(rows, pairs)
        plan = made._jdf.queryExecution().executedPlan().toString()
        return sorted((repr(r["row_id"]), r["tokens"] or []) for r in made.collect()), "Join" in plan

    got, joins = merged(df)
    assert not joins and ("None", ["a", "b"]) in got
    twice = df.unionByName(spark.createDataFrame([(7, ["a", "b"])], schema))  # its id is not its own
    assert merged(twice)[1]
    monkeypatch.setattr(phrases, "SET_PHRASES", 0)
    assert merged(df) == (got, True)


def test_words_too_rare_for_a_phrase_are_not_joined(spark, monkeypatch):
    rows = [(i, ["new", "york", f"rare{i}"]) for i in range(9)]
    df = spark.createDataFrame(rows, "row_id long, tokens array<string>")
    joined, lookup_join = [], phrases.lookup_join

    def noted(big, table, on, **more):
        joined.append(table.count())
        return lookup_join(big, table, on, **more)

    monkeypatch.setattr(phrases, "lookup_join", noted)
    (found,) = phrases.phrase_scores(df, threshold=0.0).collect()
    assert (found["a"], found["b"], found["n"]) == ("new", "york", 9)
    assert found["score"] == pytest.approx((9 - 5) / 9 / 9 * (11 + 10)) and joined == [2, 2]


def test_phrases_of_no_words(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, ["x"])], "row_id long, tokens array<string>")
    assert phrases.phrase_scores(df).count() == 0 and phrases.add_phrases(df, "trigram").count() == 3
    scores = phrases.phrase_scores(spark.createDataFrame([(1, ["a", "b"] * 9)], df.schema), threshold=-9.0)
    # 17 pairs: 9 of one kind, 8 of the other; two words and two pairs.
    assert {(r["a"], r["b"]): (r["n"], round(r["score"], 6)) for r in scores.collect()} == {
        ("a", "b"): (9, round(4 / 81 * 4, 6)), ("b", "a"): (8, round(3 / 81 * 4, 6))
    }


def test_window_counts_match_brute_force(spark):
    rng = np.random.default_rng(3)
    docs = [(i, [f"w{x}" for x in rng.integers(0, 9, size)]) for i, size in enumerate([0, 1, 4, 5, 6, 40])]
    df = spark.createDataFrame(docs, "row_id long, tokens array<string>")
    words = ["w1", "w2", "w3"]
    got = {(r["a"], r["b"]): r["n"] for r in topics.window_counts(df, words, window=5).collect()}
    want, total = {}, 0
    for _, tokens in docs:
        if not set(tokens) & set(words):
            continue
        for start in range(max(1, len(tokens) - 4)):
            total += 1
            seen = set(tokens[start : start + 5]) & set(words)
            for a in seen:
                for b in seen:
                    want[a, b] = want.get((a, b), 0) + 1
    assert got == {**want, ("", ""): total}


def test_topics_job(spark):
    words = {1: "slow crash bug error freeze", 5: "great music love playlist song"}
    rows = [(i, f"{words[1 + 4 * (i % 2)]} extra{i % 4}", 1 + 4 * (i % 2)) for i in range(60)] + [(60, "zzz", 1), (61, "odd", 7)]
    df = spark.createDataFrame(rows, "row_id long, review string, score int")
    spec = topic_plan.TopicSpec(manual_k={"negative": 2, "positive": 2})
    done = topic_plan.run_topics(df, spec)
    assigned = {r["row_id"]: r for r in done["assignments"].collect()}
    assert len(assigned) == 61
    assert assigned[60]["Topico_Dominante"] == 0 and assigned[60]["Porcentaje_Similitud"] == "50.0%"
    assert all(abs(sum(r["mixture"]) - 1) < 1e-6 for r in assigned.values())
    assert topics.choose_k([(2, 0.4), (3, 0.5), (4, 0.5)]) == 3 and topics.choose_k([(2, -0.1), (3, -0.2)]) == 2


def separable(spark):
    words = {1: "awful broken terrible", 3: "okay average plain", 5: "lovely superb great"}
    rows = [(i, f"{words[s]} item{i % 3}", float(i % 7) if i % 5 else None, s) for i, s in enumerate([1, 3, 5] * 20)]
    return spark.createDataFrame(rows, "row_id long, review string, size double, score int")


@pytest.mark.parametrize(
    ("algorithm", "grid"),
    [
        ("naive_bayes", {"alpha": [0.5], "fit_prior": [True, False]}),
        ("kNN", {"n_neighbors": [1, 3], "p": [2], "weights": ["uniform"]}),
        ("decision_tree", {"max_depth": [None], "min_samples_leaf": [1], "criterion": ["gini"]}),
    ],
)
def test_train_save_load_predict(spark, tmp_path, algorithm, grid):
    df = separable(spark)
    spec = classify.JobSpec("score", algorithm, grid, scaler="minmax", text_process="bow", unique_category_threshold=2, ngram_range=(1, 2), allow_approx=True)
    trained = classify.train(df, spec)
    best = trained.scores.agg(F.max("f1")).first()[0]
    assert best > 0.9
    first = {r["row_id"]: r["prediction"] for r in classify.predict(trained, df.drop("score")).collect()}
    classify.save(trained, str(tmp_path / "model"))
    again = classify.load(spark, str(tmp_path / "model"))
    assert {r["row_id"]: r["prediction"] for r in classify.predict(again, df).collect()} == first
    assert sum(first[r["row_id"]] == r["label"] for r in classify.predict(trained, df).collect()) >= 55


def test_model_limits():
    from opinara.operators import mlmodels

    assert mlmodels.estimator("logistic_regression", {"solver": "lbfgs", "l1_ratio": 1}, 10) is None
    with pytest.raises(ValueError, match="no exact counterpart"):
        mlmodels._leaf_size({"min_samples_split": 10, "min_samples_leaf": 1}, False)
    assert mlmodels._leaf_size({"min_samples_split": 4, "min_samples_leaf": 2}, False) == 2


def test_augmentation_round(spark):
    rows = [(i, f"r{i}", f"text {i}", 5 if i < 40 else (1 if i < 70 else 3), "x", "y", "z") for i in range(75)]
    df = spark.createDataFrame(rows, "row_id long, reviewId string, review string, score int, gender string, location string, date string")
    plan = augment.plan_balance(df).persist()
    sizes = {(r["group"], r["batch"]): r["size"] for r in plan.collect()}
    assert sizes == {("Negativo", 0): 10, ("Neutro", 0): 30, ("Neutro", 1): 5}

    def model(prompt, heat, length):
        if "Negativo" in prompt:
            raise RuntimeError("down")
        return "\n".join(f"{i}. line {i} x" for i in range(20))

    answers = augment.infer(plan, model).persist()
    left = augment.augment_remaining(plan, answers).collect()
    assert [(r["group"], r["received"], r["remaining"]) for r in left] == [("Neutro", 25, 10)]
    named = df.withColumn("label", augment.labels.score_to_label(F.col("score")))
    made = augment.augment_collect(plan, answers, named, "label", ["gender", "location", "date"], "run").collect()
    assert len(made) == 25 and {r["score"] for r in made} == {3} and all(r["reviewId"].startswith("gen_") for r in made)


def test_adasyn_refuses_a_class_without_enough_neighbours(spark):
    rows = [(i, 0 if i < 40 else 1, [0, 1], [float(i), float(i * i % 17)]) for i in range(43)]
    df = spark.createDataFrame(rows, "row_id long, y int, idx array<int>, val array<double>")
    with pytest.raises(ValueError, match="class 1 has 3 rows"):
        sampling.adasyn(df)


def test_keys_of_ids_numbered_by_partition_differ(spark):
    from opinara.functions.rng import lehmer

    ids = [(p << 33) + i for p in range(40) for i in range(100)]
    df = spark.createDataFrame([(i,) for i in ids], "i long")
    assert df.select(lehmer(F.col("i"), 42).alias("k")).distinct().count() == len(ids)


def reviews_frame(spark, n=60, wide=False):
    """Two classes told apart by one word; ``wide`` adds columns called like the job's own."""
    rows = [(i << 33, f"{'lovely' if i % 2 else 'awful'} thing number", 5 if i % 2 else 1, float(i % 7)) for i in range(n)]
    df = spark.createDataFrame(rows, "row_id long, text string, score int, size double")
    if not wide:
        return df
    return df.withColumnRenamed("size", "idx")


@pytest.mark.parametrize("algorithm", ["naive_bayes", "kNN", "decision_tree"])
def test_source_columns_named_like_the_jobs_own_change_nothing(spark, algorithm):
    grid = {"naive_bayes": {"alpha": [1.0], "fit_prior": [True]}, "kNN": {"n_neighbors": [3]}, "decision_tree": {"max_depth": [3]}}
    spec = {"algorithm": algorithm, "grid": grid[algorithm], "scaler": "minmax", "min_df": 2, "text_process": "bow", "unique_category_threshold": 1}
    plain = reviews_frame(spark)
    odd = plain.withColumnsRenamed({"text": "words", "score": "label", "size": "a.b"}).withColumn("idx", F.col("`a.b`") * 0 + 1)
    first = classify.train(plain, classify.JobSpec("score", **spec))
    second = classify.train(odd, classify.JobSpec("label", **spec))
    assert [tuple(r) for r in first.scores.select("f1").collect()] == [tuple(r) for r in second.scores.select("f1").collect()]
    found = {r.row_id: r.prediction for r in classify.predict(second, odd.withColumn("prediction", F.lit(0))).collect()}
    assert found == {r.row_id: r.prediction for r in classify.predict(first, plain).collect()}


@pytest.mark.parametrize("kind", ["tf-idf", "bow"])
def test_predictions_in_one_pass_equal_those_of_single_values(spark, kind):
    words = ["good", "bad", "plain", "slow", "fast", "cheap"]
    rows = [(i, float(1 + 4 * (i % 2)), " ".join(words[(i * k + k) % 6] for k in range(1, 6)), float(i % 7)) for i in range(40)]
    df = spark.createDataFrame(rows, "row_id long, score double, text string, size double")
    grid = {"alpha": [0.5], "fit_prior": [True]}
    trained = classify.train(df, classify.JobSpec("score", "naive_bayes", grid, scaler="minmax", text_process=kind, min_df=1, max_df=1.0, unique_category_threshold=1))
    odd = [(1, 5.0, "good good new", 2.0), (1, 1.0, "bad", None), (None, 1.0, "slow", 1.0), (3, None, None, None), (4, 1.0, "unheard of", 0.0)]
    asked = df.unionByName(spark.createDataFrame(odd, df.schema))
    inner = classify.prepared_rows(asked, trained.prepared)
    long = classify.as_long(inner, trained.prepared, ["row_id"])
    expected = bayes.predict_bayes(trained.model, inner.select("row_id"), long, 0.5, True)
    done = classify._predict_bayes(trained, inner)
    assert sorted(map(str, done.collect())) == sorted(map(str, expected.collect())) and len(done.collect()) == 45
    assert "Window" in expected._jdf.queryExecution().optimizedPlan().toString() or kind == "bow"
    assert "Window" not in classify.predict(trained, asked)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("kind", ["oversampling", "smote", "adasyn"])
def test_rebalancing_rows_numbered_by_partition(spark, kind):
    rows = [((i % 5) * (100_000 << 33) + i, "lovely" if i % 6 else "awful", 5 if i % 6 else 1, float(i % 11), float(i * i % 13)) for i in range(90)]
    df = spark.createDataFrame(rows, "row_id long, text string, score int, size double, height double")
    spec = classify.JobSpec("score", "decision_tree", {"max_depth": [3]}, sampling=kind, text_process="none", unique_category_threshold=5, drop_features=("text",))
    prepared, kept = classify.fit_preparation(df, spec)
    made, labels = classify.training_rows(kept, prepared)
    ids = [r.row_id for r in made.select("row_id").collect()]
    assert len(ids) == len(set(ids)) > 90 and sorted(labels) == ["negative", "positive"]
    trained = classify.train(df, spec)
    assert trained.scores.first()["f1"] > 0


def test_naive_bayes_refuses_negative_values(spark):
    df = spark.createDataFrame([(i, -5.0 if i % 2 else 1.0, i % 2) for i in range(20)], "row_id long, x double, score int")
    spec = classify.JobSpec("score", pnn=False, scaler="none", text_process="none")
    with pytest.raises(ValueError, match="negative"):
        classify.train(df, spec)


def test_depth_beyond_the_librarys_is_refused(spark):
    from opinara.operators import mlmodels

    with pytest.raises(ValueError, match="max_depth=None"):
        mlmodels.estimator("decision_tree", {}, 10)
    assert mlmodels.estimator("random_forest", {"max_depth": 50}, 10, allow_approx=True).getMaxDepth() == 30
    assert mlmodels.note("decision_tree", {"max_depth": 50}) == "depth 30" and mlmodels.note("decision_tree", {"max_depth": 5}) is None


def test_mini_batches_do_not_change_with_the_number_of_documents(spark):
    from opinara.operators import lda

    for n in (1_000, 4_000):
        df = spark.range(n).select(F.col("id").alias("row_id"), F.array(F.concat(F.lit("w"), F.col("id") % 5)).alias("tokens"))
        sizes = lda.deal(df, topics.build_dictionary(df), 200).sizes.values()
        assert len(sizes) == n // 200 and sum(sizes) == n and max(sizes) < 280 and min(sizes) > 120


def test_grid_takes_ranges():
    from opinara.operators import search

    cells = search.grid_cells({"n_neighbors": {"low": 1, "high": 7, "step": 3}, "p": [1, 2]})
    assert [(c["n_neighbors"], c["p"]) for c in cells] == [(1, 1), (1, 2), (4, 1), (4, 2), (7, 1), (7, 2)]


def test_fills_of_each_table(spark):
    df = spark.createDataFrame([(i, float(i), "a b c", 5 if i % 2 else 1) for i in range(20)], "row_id long, x double, text string, score int")
    gap = spark.createDataFrame([(1, None), (2, 100.0), (3, 100.0)], "row_id long, x double")
    for refit, want in ((False, 9.5), (True, 100.0)):
        spec = classify.JobSpec("score", scaler="none", text_process="none", drop_features=("text",), refit_on_input=refit)
        prepared, _ = classify.fit_preparation(df, spec)
        rows = classify.prepared_rows(gap, prepared).collect()
        assert {r.row_id: r["_x0"] for r in rows}[1] == want
