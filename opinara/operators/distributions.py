"""Counts of scores and classes, and the quotas derived from them."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions import labels
from opinara.functions.numbers import clean_double, is_missing, quoted, to_number


def clean_scores(df: DataFrame, score: str = "score", review: str = "review", only_1_to_5: bool = True) -> DataFrame:
    """Numeric scores only, truncated to whole numbers; rows without text or score are dropped."""
    value = to_number(F.col(score)) if dict(df.dtypes)[score] == "string" else clean_double(F.col(score))
    kept = df.withColumn(score, value).na.drop(how="any", subset=[review, score])
    # Scores beyond the whole numbers are no scores; the check comes before the cast, which would fail on them.
    low, high = (1.0, 6.0) if only_1_to_5 else (-(2.0**31), 2.0**31)
    inside = F.when((F.col(score) >= low) & (F.col(score) < high), F.col(score))
    return kept.withColumn(score, inside.cast("int")).where(F.col(score).isNotNull())


def coerce_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: to_number(F.col(c)) for c in columns})


def score_distribution(df: DataFrame, score: str = "score") -> DataFrame:
    return df.groupBy(score).agg(F.count("*").alias("n")).orderBy(score)


def class_distribution(df: DataFrame, label: Column) -> DataFrame:
    return df.groupBy(label.alias("label")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label")


def majority_size(distribution: DataFrame) -> DataFrame:
    return distribution.agg(F.max("n").alias("majority"))


def class_deficit(distribution: DataFrame, targets: dict[str, int]) -> DataFrame:
    """Rows each target class lacks to reach the largest class; satisfied classes are left out."""
    # The class table is tiny, so it travels as one map beside the exploded targets.
    sizes = distribution.groupBy().agg(
        F.max("n").alias("majority"),
        F.map_from_entries(F.collect_list(F.struct("label", "n"))).alias("size_of"),
    )
    wanted = F.array(*[F.struct(F.lit(k).alias("label"), F.lit(v).alias("target_score")) for k, v in targets.items()])
    rows = sizes.select("majority", "size_of", F.explode(wanted).alias("t"))
    current = F.coalesce(F.element_at("size_of", F.col("t.label")), F.lit(0))
    return rows.select(
        F.col("t.label").alias("label"),
        F.col("t.target_score").alias("target_score"),
        (F.col("majority") - current).cast("long").alias("quota"),
    ).where(F.col("quota") > 0)


def smallest_scores(distribution: DataFrame, k: int = 3, score: str = "score") -> DataFrame:
    """The k least frequent scores; the lower score first on ties."""
    return distribution.orderBy("n", score).limit(k)


def percent_quota(distribution: DataFrame, share: float = 0.5) -> DataFrame:
    return distribution.withColumn("quota", F.bround(F.col("n") * share).cast("long"))


def answer_summary(df: DataFrame, label: str = "prediccion") -> DataFrame:
    """How many answers fell in each class, zero included."""
    names = [labels.POSITIVE, labels.NEUTRAL, labels.NEGATIVE, labels.UNKNOWN_ANSWER]
    counts = df.agg(*[F.count_if(F.col(label) == name).alias(name) for name in names])
    return counts.select(
        F.explode(F.array(*[F.struct(F.lit(n).alias("label"), F.col(n).alias("n")) for n in names])).alias("r")
    ).select("r.label", "r.n")


def null_check(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: how many nulls (NaN is one), and whether there are any. One pass for all columns."""
    kinds = dict(df.dtypes)
    counts = df.agg(*[F.count_if(is_missing(c, kinds[c])).alias(f"_{i}") for i, c in enumerate(columns)])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("n_null")) for i, c in enumerate(columns)]
    return counts.select(
        F.explode(F.array(*pairs)).alias("r")
    ).select("r.column_name", "r.n_null", (F.col("r.n_null") > 0).alias("has_null"))


def count_unique(df: DataFrame, columns: list[str], threshold: int | None = None) -> DataFrame:
    """Distinct values per column, nulls and NaN left out.

    Columns are first sized by a mergeable sketch; only those near or below ``threshold`` are
    counted exactly, since every exact distinct count multiplies the shuffled rows.
    """
    exact = list(columns)
    sizes = {}
    if threshold is not None and columns:
        row = df.agg(*[F.approx_count_distinct(quoted(c), 0.02).alias(f"_{i}") for i, c in enumerate(columns)]).first()
        exact = [c for i, c in enumerate(columns) if row[i] <= 2 * threshold + 10]
        sizes = {c: row[i] for i, c in enumerate(columns) if c not in exact}
    kinds = dict(df.dtypes)
    pairs = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.when(~is_missing(c, kinds[c]), quoted(c).cast("string")).alias("value"),
        )
        for c in exact
    ]
    spark = df.sparkSession
    parts = []
    if exact:
        # Distinct first, so a value held by most rows is collapsed before the shuffle.
        values = df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").distinct()
        base = values.groupBy("column_name").agg(F.count("value").alias("n_distinct"))
        parts.append(base)
    if sizes:
        parts.append(spark.createDataFrame(list(sizes.items()), "column_name string, n_distinct long"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean")


def is_numeric(kind: str) -> bool:
    return kind in NUMERIC_TYPES or kind.startswith("decimal")


def select_features(df: DataFrame, target: str, threshold: int = 20) -> DataFrame:
    """Role of every column: numeric (decimals and booleans, too), categorical (few distinct strings) or text.

    Columns of other types are left out with a warning.
    """
    numeric = [c for c, t in df.dtypes if is_numeric(t) and c != target]
    strings = [c for c, t in df.dtypes if t == "string" and c != target]
    for column, kind in df.dtypes:
        if column != target and column not in numeric and column not in strings:
            warnings.warn(f"column {column} of type {kind} is no feature", stacklevel=2)
    role = F.when(F.col("n_distinct") <= threshold, "categorical").otherwise("text")
    spark = df.sparkSession
    roles = spark.createDataFrame(
        [(c, "numeric", None) for c in numeric], "column_name string, role string, n_distinct long"
    )
    if strings:
        counted = count_unique(df, strings, threshold)
        size = F.when(F.col("n_distinct") <= threshold, F.col("n_distinct"))
        roles = roles.unionByName(counted.select("column_name", role.alias("role"), size.alias("n_distinct")))
    return roles


def feature_roles(df: DataFrame, target: str, threshold: int = 20) -> dict[str, list[str]]:
    rows = select_features(df, target, threshold).collect()
    roles = {"numeric": [], "categorical": [], "text": []}
    for row in rows:
        roles[row["role"]].append(row["column_name"])
    return {role: [c for c in df.columns if c in names] for role, names in roles.items()}
