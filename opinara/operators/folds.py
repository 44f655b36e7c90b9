"""Stratified folds: contiguous blocks per class in row order, five by default."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinara.operators.ranks import class_ranks
from opinara.session import lookup_join, materialise


def fold_limits(class_sizes: list[int], n_folds: int = 5) -> list[list[int]]:
    """Per class, the last in-class rank of every fold.

    Classes lie one after another on a line numbered 0, 1, 2, ...; fold i takes as many rows of a
    class as its stretch has numbers equal to i modulo the number of folds.
    """
    limits, start = [], 0
    for size in class_sizes:
        shares = [(start + size + n_folds - 1 - i) // n_folds - (start + n_folds - 1 - i) // n_folds for i in range(n_folds)]
        limits.append([sum(shares[: i + 1]) for i in range(n_folds)])
        start += size
    return limits


def stratified_folds(df: DataFrame, label: str, row_id: str = "row_id", n_folds: int = 5) -> DataFrame:
    """Add ``fold`` 0..n-1. Classes are taken in order of first appearance.

    The table of classes, one row each, is laid out along the line of ``fold_limits`` by running sums.
    """
    classes = df.groupBy(label).agg(F.count("*").alias("_n"), F.min(row_id).alias("_first"))
    before = Window.orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_n").over(before), F.lit(0))
    upto = lambda end, i: F.floor((end + n_folds - 1 - i) / n_folds)
    shares = [upto(F.col("_start") + F.col("_n"), i) - upto(F.col("_start"), i) for i in range(n_folds)]
    ends = F.array(*[sum(shares[1 : i + 1], shares[0]) for i in range(n_folds)])
    limits, n_classes = materialise(classes.withColumn("_start", start).select(label, ends.alias("_ends")))
    ranked = class_ranks(df, F.col(label), row_id=row_id, order="row", rank="_rank")
    placed = lookup_join(ranked, limits, [label], table_rows=n_classes, max_rows=100_000)
    passed = F.size(F.filter("_ends", lambda end: end < F.col("_rank")))
    return placed.withColumn("fold", passed).select(*df.columns, "fold")
