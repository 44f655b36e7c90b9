"""Classification metrics from one confusion table, for any number of keyed runs at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion(df: DataFrame, true: str = "label", predicted: str = "prediction", keys: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(keys or []), F.col(true).alias("y_true"), F.col(predicted).alias("y_pred")).agg(
        F.count("*").alias("n")
    )


def confusion_matrix(df: DataFrame, true: str = "label", predicted: str = "prediction") -> DataFrame:
    """All pairs of labels seen on either side, zero cells included."""
    counts = confusion(df, true, predicted)
    gathered = counts.agg(
        F.array_sort(F.array_distinct(F.concat(F.collect_set("y_true"), F.collect_set("y_pred")))).alias("names"),
        F.map_from_entries(F.collect_list(F.struct(F.struct("y_true", "y_pred"), "n"))).alias("cells"),
    )
    rows = gathered.select("names", "cells", F.explode("names").alias("y_true"))
    pairs = rows.select("cells", "y_true", F.explode("names").alias("y_pred"))
    cell = F.element_at("cells", F.struct("y_true", "y_pred"))
    return pairs.select("y_true", "y_pred", F.coalesce(cell, F.lit(0)).cast("long").alias("n"))


def _ratio(top, bottom):
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def class_scores(counts: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Per label: precision, recall, F1 and support; labels come from both sides, 0/0 counts as 0."""
    keys = keys or []
    hit = F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("y_true").alias("label"), hit.cast("long").alias("tp"), F.col("n").alias("support"), zero.alias("predicted")),
        F.struct(F.col("y_pred").alias("label"), zero.alias("tp"), zero.alias("support"), F.col("n").alias("predicted")),
    )
    tall = counts.select(*keys, F.explode(sides).alias("s")).select(*keys, "s.*")
    sums = tall.groupBy(*keys, "label").agg(
        F.sum("tp").alias("tp"), F.sum("support").alias("support"), F.sum("predicted").alias("predicted")
    )
    return sums.select(
        *keys,
        "label",
        _ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        _ratio(F.col("tp"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1"),
        "tp",
        "support",
    )


AVERAGES = ("macro", "micro", "weighted")


def precision_recall_f(counts: DataFrame, average: str = "macro", keys: list[str] | None = None) -> DataFrame:
    """One row per key with precision, recall and f1; an unknown average means macro."""
    scores = class_scores(counts, keys)
    if average == "micro":
        share = F.sum("tp") / F.sum("support")
        picks = [share.alias(m) for m in ("precision", "recall", "f1")]
    elif average == "weighted":
        picks = [(F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(m) for m in ("precision", "recall", "f1")]
    else:
        picks = [F.avg(m).alias(m) for m in ("precision", "recall", "f1")]
    return scores.groupBy(*(keys or [])).agg(*picks)


def f1_micro_macro(counts: DataFrame) -> DataFrame:
    return class_scores(counts).agg((F.sum("tp") / F.sum("support")).alias("f1_micro"), F.avg("f1").alias("f1_macro"))


def classification_report(counts: DataFrame) -> DataFrame:
    """Rows per class plus accuracy, macro avg and weighted avg, at 4 digits."""
    scores = class_scores(counts)
    measures = ("precision", "recall", "f1")
    total = F.sum("support")
    accuracy = F.sum("tp") / total
    summary = scores.agg(
        F.array(
            F.struct(F.lit("accuracy").alias("label"), *[accuracy.alias(m) for m in measures], total.alias("support")),
            F.struct(F.lit("macro avg").alias("label"), *[F.avg(m).alias(m) for m in measures], total.alias("support")),
            F.struct(
                F.lit("weighted avg").alias("label"),
                *[(F.sum(F.col(m) * F.col("support")) / total).alias(m) for m in measures],
                total.alias("support"),
            ),
        ).alias("rows")
    ).select(F.inline("rows"))
    per_class = scores.select(F.col("label").cast("string").alias("label"), *measures, "support")
    report = per_class.unionByName(summary)
    return report.select("label", *[F.round(m, 4).alias(m) for m in measures], "support")
