"""Grid cells, their names, cross-validated scores and the choice of the best cell."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.operators.metrics import confusion, precision_recall_f

# Name pattern of a grid cell per algorithm.
MODEL_NAMES = {
    "kNN": "kNN_k{n_neighbors}_p{p}_w{weights}",
    "decision_tree": "decision_tree_depth{max_depth}_split{min_samples_split}_leaf{min_samples_leaf}_criterion{criterion}",
    "random_forest": "random_forest_nest{n_estimators}_depth{max_depth}_split{min_samples_split}"
    "_leaf{min_samples_leaf}_criterion{criterion}",
    "naive_bayes": "naive_bayes_alpha{alpha}_fitprior{fit_prior}",
    "logistic_regression": "logistic_regression_C{C}_l1ratio{l1_ratio}_solver{solver}_maxiter{max_iter}",
}

# What a parameter means when the grid does not name it.
DEFAULTS = {
    "kNN": {"n_neighbors": 5, "p": 2, "weights": "uniform"},
    "decision_tree": {"max_depth": None, "min_samples_split": None, "min_samples_leaf": None, "criterion": None},
    "random_forest": {
        "n_estimators": None,
        "max_depth": None,
        "min_samples_split": None,
        "min_samples_leaf": None,
        "criterion": None,
    },
    "naive_bayes": {"alpha": None, "fit_prior": None},
    "logistic_regression": {"C": None, "l1_ratio": None, "solver": None, "max_iter": None},
}


def grid_cells(grid: dict[str, list | dict]) -> list[dict]:
    """All combinations, parameters in alphabetical order, the last one varying fastest.

    Values are a list, or an inclusive range given as {"low": ..., "high": ..., "step": ...}.
    """
    names = sorted(grid)
    values = [neighbour_counts(**v) if isinstance(v, dict) else list(v) for v in (grid[name] for name in names)]
    return [dict(zip(names, chosen, strict=True)) for chosen in itertools.product(*values)]


def neighbour_counts(values: list[int] | None = None, low: int = 1, high: int = 1, step: int = 1) -> list[int]:
    """Explicit k values, or the inclusive range low..high."""
    return list(values) if values else list(range(low, high + 1, step))


def model_name(algorithm: str, cell: dict) -> str:
    return MODEL_NAMES[algorithm].format(**{**DEFAULTS[algorithm], **cell})


def grid_scores(predictions: DataFrame, average: str = "macro", label: str = "label") -> DataFrame:
    """Mean over folds of precision, recall and f1 per cell, from (cell, fold, label, prediction)."""
    counts = confusion(predictions, label, "prediction", ["cell", "fold"])
    per_fold = precision_recall_f(counts, average, ["cell", "fold"])
    return per_fold.groupBy("cell").agg(
        F.avg("precision").alias("precision"), F.avg("recall").alias("recall"), F.avg("f1").alias("f1")
    )


def name_cells(scores: DataFrame, algorithm: str, cells: list[dict]) -> DataFrame:
    names = F.array(*[F.lit(model_name(algorithm, cell)) for cell in cells])
    return scores.withColumn("model", F.element_at(names, F.col("cell") + 1))


def best_cell(scores: DataFrame) -> DataFrame:
    """The cell with the highest mean f1; the first one on ties."""
    return scores.where(F.col("f1").isNotNull()).orderBy(F.desc("f1"), "cell").limit(1)
