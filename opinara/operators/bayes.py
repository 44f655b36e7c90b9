"""Multinomial naive Bayes on long-form features, fitted and grid-scored by aggregation."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.session import lookup_join, materialise, small_values


@dataclass(frozen=True)
class BayesModel:
    """One row per term with its summed value per class, plus class totals kept on the driver."""

    table: DataFrame
    labels: list
    class_rows: list
    class_mass: list
    n_terms: int

    def unpersist(self) -> None:
        self.table.unpersist()


def label_index(label: Column, labels: list) -> Column:
    return (F.array_position(F.array(*[F.lit(v) for v in labels]), label) - 1).cast("int")


def _label_of(index: Column, labels: list) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in labels]), index + 1)


def _class_rows(rows: DataFrame, label: str, keys: list[str]) -> list:
    return rows.groupBy(*keys, label).agg(F.count("*").alias("n")).collect()


def fit_bayes(features: DataFrame, rows: DataFrame, n_terms: int, label: str = "label") -> BayesModel:
    """``features`` holds (label, term, value >= 0); ``rows`` one row per training row with its label."""
    labels = small_values(rows, label)
    sizes = {r[label]: r["n"] for r in _class_rows(rows, label, [])}
    sums = [F.sum(F.when(F.col(label) == v, F.col("value")).otherwise(0.0)) for v in labels]
    table, _ = materialise(
        features.groupBy("term").agg(F.array(*sums).alias("mass"), F.min("value").alias("least"))
    )
    refuse_negative(table)
    table = table.drop("least")
    totals = table.agg(*[F.sum(F.get("mass", F.lit(j))).alias(f"c{j}") for j in range(len(labels))]).first()
    return BayesModel(table, labels, [sizes[v] for v in labels], [t or 0.0 for t in totals], n_terms)


def refuse_negative(table: DataFrame) -> None:
    """Word counts cannot be below 0, and the model's logarithms mean nothing for such values."""
    found = table.where(F.col("least") < 0).select("term").first()
    if found is not None:
        raise ValueError(f"{found['term']} has negative values; naive Bayes needs values of 0 or more")


def _safe_log(value: float) -> float:
    return math.log(value) if value > 0 else -1e308


def log_prior(class_rows: list, fit_prior: bool) -> list:
    if not fit_prior:
        return [-math.log(len(class_rows))] * len(class_rows)
    total = sum(class_rows)
    return [_safe_log(n / total) if total else 0.0 for n in class_rows]


def log_table(model: BayesModel, alpha: float = 1.0) -> DataFrame:
    """(term, label, log_probability) of every term and class."""
    entries = [
        F.struct(
            F.lit(v).alias("label"),
            F.log((F.get("mass", F.lit(j)) + alpha) / (model.class_mass[j] + alpha * model.n_terms)).alias("log_probability"),
        )
        for j, v in enumerate(model.labels)
    ]
    return model.table.select("term", F.inline(F.array(*entries)))


def best_position(scores: Column) -> Column:
    """0-based position of the largest score, the first one on ties."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def predict_bayes(
    model: BayesModel,
    rows: DataFrame,
    features: DataFrame,
    alpha: float = 1.0,
    fit_prior: bool = True,
    row_id: str = "row_id",
) -> DataFrame:
    """Append ``prediction`` to ``rows``; terms unknown to the model count for nothing."""
    pairs = lookup_join(features.select(row_id, "term", "value"), model.table, ["term"], table_rows=model.n_terms)
    per_row = pairs.groupBy(row_id).agg(*row_sums(model, alpha))
    return predict_by_sums(model, rows, per_row, alpha, fit_prior, row_id)


def row_sums(model: BayesModel, alpha: float) -> list[Column]:
    """What a row's pairs (value, mass) add up to: ``mass`` of the terms that the model knows, and t0, t1, ... by class."""
    by_class = [F.sum(F.col("value") * F.log(F.get("mass", F.lit(j)) + alpha)).alias(f"t{j}") for j in range(len(model.labels))]
    return [F.sum(F.when(F.col("mass").isNotNull(), F.col("value"))).alias("mass"), *by_class]


def predict_by_sums(
    model: BayesModel, rows: DataFrame, per_row: DataFrame, alpha: float = 1.0, fit_prior: bool = True, row_id: str = "row_id"
) -> DataFrame:
    """Append ``prediction`` to ``rows`` by the ``row_sums`` of each row id; a row without them has no term."""
    classes = range(len(model.labels))
    joined = rows.join(per_row, row_id, "left")
    prior = log_prior(model.class_rows, fit_prior)
    scores = [
        F.round(
            F.lit(prior[j])
            + F.coalesce(F.col(f"t{j}") - F.col("mass") * _safe_log(model.class_mass[j] + alpha * model.n_terms), F.lit(0.0)),
            9,
        )
        for j in classes
    ]
    best = best_position(F.array(*scores))
    return joined.withColumn("prediction", _label_of(best, model.labels)).drop("mass", *[f"t{j}" for j in classes])


def bayes_cv_predictions(
    features: DataFrame,
    rows: DataFrame,
    n_terms: int,
    alphas: list[float],
    fit_priors: list[bool],
    label: str = "label",
    row_id: str = "row_id",
    n_folds: int = 5,
) -> DataFrame:
    """Out-of-fold predictions of every grid cell: (row_id, fold, label, cell, prediction).

    Values are summed once per (term, fold, class); the model that leaves a fold out is the total
    minus that fold, so the whole grid costs one fit and one scoring pass. ``features`` and
    ``rows`` carry ``fold`` and the label; cells are numbered alpha-major.
    """
    labels = small_values(rows, label)
    n_classes = len(labels)
    slots = [(f, j) for f in range(n_folds) for j in range(n_classes)]
    slot = (F.col("fold") * n_classes + label_index(F.col(label), labels)).cast("int")
    keyed = features.withColumn("_slot", slot)
    sums = [F.sum(F.when(F.col("_slot") == i, F.col("value")).otherwise(0.0)) for i in range(len(slots))]
    by_term = keyed.groupBy("term").agg(F.array(*sums).alias("held"))
    total = [sum((F.get("held", F.lit(f * n_classes + j)) for f in range(1, n_folds)), F.get("held", F.lit(j))) for j in range(n_classes)]
    table, table_rows = materialise(by_term.withColumn("total", F.array(*total)))
    mass = table.agg(*[F.sum(F.get("held", F.lit(i))) for i in range(len(slots))]).first()
    counts = {(r["fold"], r[label]): r["n"] for r in _class_rows(rows, label, ["fold"])}

    def outside(values, f, j):
        return sum(values(g, j) for g in range(n_folds) if g != f)

    def slot_mass(f, j):
        return mass[f * n_classes + j] or 0.0

    def slot_rows(f, j):
        return counts.get((f, labels[j]), 0)

    pairs = lookup_join(features.select(row_id, "fold", "term", "value"), table, ["term"], table_rows=table_rows)
    aggregates = [F.sum("value").alias("mass")]
    for a, alpha in enumerate(alphas):
        for j in range(n_classes):
            seen = F.get("total", F.lit(j)) - F.get("held", (F.col("fold") * n_classes + j).cast("int"))
            # Summed values can differ from their total by rounding; a count is never negative.
            seen = F.greatest(seen, F.lit(0.0))
            aggregates.append(F.sum(F.col("value") * F.log(seen + alpha)).alias(f"t{a}_{j}"))
    scored = rows.join(pairs.groupBy(row_id).agg(*aggregates), row_id, "left")

    def per_fold(numbers: list[float]) -> Column:
        return F.get(F.array(*[F.lit(float(x)) for x in numbers]), F.col("fold"))

    cells = []
    for a, alpha in enumerate(alphas):
        for b, fit_prior in enumerate(fit_priors):
            scores = []
            for j in range(n_classes):
                priors = [log_prior([outside(slot_rows, f, c) for c in range(n_classes)], fit_prior)[j] for f in range(n_folds)]
                norms = [_safe_log(outside(slot_mass, f, j) + alpha * n_terms) for f in range(n_folds)]
                words = F.coalesce(F.col(f"t{a}_{j}") - F.col("mass") * per_fold(norms), F.lit(0.0))
                scores.append(F.round(per_fold(priors) + words, 9))
            best = best_position(F.array(*scores))
            cells.append(F.struct(F.lit(a * len(fit_priors) + b).alias("cell"), _label_of(best, labels).alias("prediction")))
    return scored.select(row_id, "fold", label, F.inline(F.array(*cells)))
