from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from opinara import session
from opinara.operators import distributions as dist
from opinara.operators import metrics, prepare
from opinara.operators.folds import fold_limits, stratified_folds
from opinara.operators.ranks import class_ranks
from opinara.session import generate_rows, lookup_join
from opinara.sources import files


def test_imputation_edges(spark):
    df = spark.createDataFrame(
        [(1.0, None, "b"), (1.0, None, None), (3.0, None, "a"), (3.0, None, "b"), (7.0, None, "a"), (None, None, None)],
        "x double, empty double, c string",
    )
    assert prepare.fit_imputer(df, ["x"], [], impute_num="mode").fills == {"x": 1.0}
    assert prepare.fit_imputer(df, ["x", "empty"], ["c"]).fills == {"x": 3.0, "c": "a"}
    assert prepare.fit_imputer(df, [], ["empty"], impute_cat="mode").fills == {"empty": "Desconocido"}
    assert prepare.fit_imputer(df, ["x"], ["c"], "delete", "delete").apply(df).count() == 4


@pytest.mark.parametrize("gather", [3, 50, 10_000])
def test_exact_median_narrows(spark, gather):
    df = spark.range(1001).select((F.col("id") * F.col("id")).cast("double").alias("x"), F.lit(2.0).alias("same"))
    assert prepare.exact_medians(df, ["x", "same"], gather=gather, accuracy=100) == {"x": 250_000.0, "same": 2.0}
    even = spark.range(10).select(F.col("id").cast("double").alias("x"))
    assert prepare.exact_medians(even, ["x"], gather=gather) == {"x": 4.5}


def test_scalers_on_constants(spark):
    df = spark.createDataFrame([(2.0, 0.0), (2.0, 0.0)], "c double, z double")
    for kind in ("minmax", "zscore"):
        assert [tuple(r) for r in prepare.fit_scaler(df, ["c", "z"], kind).apply(df).collect()] == [(0.0, 0.0)] * 2
    assert [tuple(r) for r in prepare.fit_scaler(df, ["c", "z"], "maxabs").apply(df).collect()] == [(1.0, 0.0)] * 2
    assert [r["z"] for r in prepare.fit_scaler(df, ["z"], "normalizer").apply(df).collect()] == [0.0, 0.0]


def test_quota_rounds_half_even(spark):
    df = spark.createDataFrame([(1, 1), (2, 3), (3, 5)], "score int, n long")
    assert [r["quota"] for r in dist.percent_quota(df).orderBy("score").collect()] == [0, 2, 2]


def test_metrics_with_one_sided_classes(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "x"), ("b", "a")], "label string, prediction string")
    rows = {r["label"]: r for r in metrics.class_scores(metrics.confusion(df)).collect()}
    assert rows["a"]["precision"] == 0.5 and rows["a"]["recall"] == 0.5
    assert rows["b"]["precision"] == 0.0 and rows["x"]["recall"] == 0.0
    assert metrics.confusion_matrix(df).count() == 9


@pytest.mark.parametrize("order", ["hash", "row"])
def test_class_ranks_are_a_permutation(spark, order):
    df = spark.range(3000).select((F.col("id") ** 2).cast("long").alias("row_id"), (F.col("id") % 3 == 0).alias("c"))
    ranks = class_ranks(df, F.col("c"), order=order, slices=64).collect()
    for flag, size in ((True, 1000), (False, 2000)):
        mine = sorted((r["rank"], r["row_id"]) for r in ranks if r["c"] == flag)
        assert [m[0] for m in mine] == list(range(1, size + 1))
        if order == "row":
            assert [m[1] for m in mine] == sorted(m[1] for m in mine)
    assert class_ranks(df, F.col("c"), limit=F.lit(7)).count() == 14


def test_ranks_ignore_input_layout(spark):
    df = spark.range(500).select(F.col("id").alias("row_id"), (F.col("id") % 2).alias("c"))
    first = {(r["row_id"], r["rank"]) for r in class_ranks(df, F.col("c")).collect()}
    second = {(r["row_id"], r["rank"]) for r in class_ranks(df.repartition(13), F.col("c")).collect()}
    assert first == second


def test_folds(spark):
    assert fold_limits([7, 5], 5) == [[2, 4, 5, 6, 7], [1, 2, 3, 4, 5]]
    df = spark.createDataFrame([(i, "ab"[i % 3 == 0]) for i in range(30)], "row_id long, label string")
    folds = stratified_folds(df, "label").collect()
    sizes = [sum(r["fold"] == f for r in folds) for f in range(5)]
    assert sizes == [6, 6, 6, 6, 6]


def test_generate_rows_in_blocks(spark):
    df = spark.createDataFrame([("a", 10), ("b", 0), ("c", 3)], "k string, n long")
    rows = generate_rows(df, "n", "i", block=4).collect()
    assert sorted((r["k"], r["i"]) for r in rows) == [("a", i) for i in range(10)] + [("c", i) for i in range(3)]


def test_salted_lookup_equals_broadcast(spark):
    big = spark.range(400).select(F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("k"))
    small = spark.range(7).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    one = {tuple(r) for r in lookup_join(big, small, ["k"]).select("id", "k", "v").collect()}
    longer = lookup_join(big, small, ["k"], max_rows=2).select("id", "k", "v")
    two = {tuple(r) for r in longer.collect()}
    assert "Broadcast" not in longer._jdf.queryExecution().executedPlan().toString()
    assert one == two and len(one) == 400


def test_long_lookup_tables_are_copied_less(spark, monkeypatch):
    big = spark.range(400).select(F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 9).alias("k"))
    small = spark.range(7).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    for rows, copied in ((7 * 16, True), (7 * 5, True), (7, False), (3, False)):
        monkeypatch.setattr(session, "COPIED_ROWS", rows)
        for how, expected in (("inner", 312), ("left", 400), ("left_semi", 312)):
            joined = lookup_join(big, small, ["k"], how, table_rows=7, max_rows=2)
            assert joined.count() == expected
            assert ("Generate" in joined._jdf.queryExecution().executedPlan().toString()) == copied


def write(tmp_path, name, data: bytes) -> str:
    path = tmp_path / name
    path.write_bytes(data)
    return str(path)


def test_tolerant_reader(spark, tmp_path):
    path = write(tmp_path, "a.csv", b'id;review;score\n1;"a;b";5\n2;short\n3;x;4;long;longer\n4;NA;nan\n5;"two\nlines";3\n6;;2;\n')
    rows = sorted(tuple(r) for r in files.read_reviews_tolerant(spark, path, infer=False).fillna("-").collect())
    assert rows[:3] == [("1", "a;b", "5"), ("2", "short", "-"), ("4", "-", "-")]
    assert rows[3] == ("5", "two\nlines", "3")
    assert all(r[0] != "3" for r in rows)


def test_latin1_and_tabs(spark, tmp_path):
    path = write(tmp_path, "b.csv", "id\treview\n1\tcafé\n".encode("latin1"))
    assert [tuple(r) for r in files.read_reviews_tolerant(spark, path).collect()] == [(1, "café")]
    path = write(tmp_path, "c.csv", "id,review\n1,café\n".encode())
    assert [tuple(r) for r in files.read_reviews_tolerant(spark, path).collect()] == [(1, "café")]


def test_number_inference(spark, tmp_path):
    path = write(tmp_path, "d.csv", b"a;b;c;d\n1;1;1.5;x\n2;;2;5d\n")
    assert files.read_reviews(spark, path).dtypes == [("a", "bigint"), ("b", "double"), ("c", "double"), ("d", "string")]


def test_missing_column(spark):
    with pytest.raises(ValueError, match="score"):
        prepare.require_columns(spark.createDataFrame([("x",)], "review string"), ["review", "score"])


def test_nan_is_a_missing_value(spark):
    from decimal import Decimal


    df = spark.createDataFrame(
        [(1, 1.0, Decimal("1.5"), True, "a"), (2, 3.0, Decimal("2.5"), False, "b"), (3, float("nan"), None, None, "c"), (4, None, Decimal("1.5"), True, "d")],
        "row_id long, `x.y` double, price decimal(10,2), flag boolean, target string",
    )
    filled = {r.row_id: r["x.y"] for r in prepare.fit_imputer(df, ["x.y"], [], "mean").apply(df).collect()}
    assert filled == {1: 1.0, 2: 3.0, 3: 2.0, 4: 2.0}
    for how in ("median", "mode"):
        assert all(r["x.y"] == r["x.y"] for r in prepare.fit_imputer(df, ["x.y"], [], how).apply(df).collect())
    assert prepare.fit_imputer(df, ["x.y"], [], "delete").apply(df).count() == 2
    assert dist.null_check(df, ["x.y"]).first()["n_null"] == 2
    assert dist.count_unique(df, ["x.y"]).first()["n_distinct"] == 2
    assert dist.feature_roles(df, "target")["numeric"] == ["row_id", "x.y", "price", "flag"]


def test_scores_beyond_whole_numbers_are_no_scores(spark):

    df = spark.createDataFrame([("5", "t"), ("99999999999", "t"), ("4.7", "t"), ("-1", "t"), ("x", "t")], "score string, review string")
    assert sorted(r.score for r in dist.clean_scores(df).collect()) == [4, 5]
    assert sorted(r.score for r in dist.clean_scores(df, only_1_to_5=False).collect()) == [-1, 4, 5]


def test_many_categories_are_encoded(spark):

    df = spark.range(4000).select(F.col("id").alias("row_id"), F.format_string("c%05d", F.col("id") % 2000).alias("c"))
    coded = prepare.fit_label_encoder(df, ["c"]).apply(df)
    assert coded.columns == ["row_id", "c"] and coded.where("c != row_id % 2000").count() == 0
    with pytest.raises(Exception, match="unseen value"):
        prepare.fit_label_encoder(df.where("row_id < 3000 AND row_id % 2000 < 900"), ["c"]).apply(df).collect()


def test_rated_reviews_do_not_outer_join(spark):
    from opinara.sources.tables import rated_reviews

    plan = rated_reviews(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" not in plan
