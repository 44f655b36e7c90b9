"""Imputation, scaling and label encoding: fitting is one aggregate, applying is a projection."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.functions.numbers import clean_double, is_missing, quoted
from opinara.session import lookup_join, small_values

# Fixed value: fill for a categorical column without any value.
UNKNOWN_CATEGORY = "Desconocido"
# Categories that are looked up in an array instead of a table.
FEW_CATEGORIES = 200


def drop_features(df: DataFrame, columns: list[str]) -> DataFrame:
    for column in columns:
        if column not in df.columns:
            warnings.warn(f"column {column} is not in the table", stacklevel=2)
    return df.drop(*columns)


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def drop_null_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows without a null (or NaN) in ``columns``."""
    kinds = dict(df.dtypes)
    for column in columns:
        df = df.where(~is_missing(column, kinds[column]))
    return df


@dataclass(frozen=True)
class Imputer:
    """Fill values of numeric and categorical columns, or the order to drop incomplete rows."""

    fills: dict = field(default_factory=dict)
    drop: tuple = ()

    def apply(self, df: DataFrame) -> DataFrame:
        kinds = dict(df.dtypes)
        filled = df.withColumns({c: F.when(is_missing(c, kinds[c]), F.lit(v)).otherwise(quoted(c)) for c, v in self.fills.items()})
        return drop_null_rows(filled, list(self.drop))


def _most_common(df: DataFrame, columns: list[str]) -> dict:
    """Most frequent value per column, the smallest on ties.

    Values are counted in a shuffle of (column, value) and only the winners reach one task; the
    built-in ``mode`` would keep a map of all distinct values in a single one.
    """
    if not columns:
        return {}
    pairs = [F.struct(F.lit(i).alias("c"), quoted(c).alias("v")) for i, c in enumerate(columns)]
    counted = (
        df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").where(F.col("v").isNotNull()).groupBy("c", "v").agg(F.count("*").alias("n"))
    )
    best = counted.groupBy("c").agg(F.max("n").alias("n"))
    winners = counted.join(F.broadcast(best), ["c", "n"]).groupBy("c").agg(F.min("v").alias("v")).collect()
    return {columns[row["c"]]: row["v"] for row in winners}


def exact_medians(df: DataFrame, columns: list[str], gather: int = 100_000, accuracy: int = 10_000) -> dict:
    """Exact interpolated medians of double columns that never sort a column in one task.

    A quantile sketch brackets the two middle ranks, counts prove that the bracket holds both (it
    is widened otherwise), and it is narrowed until it holds one value or at most ``gather`` rows,
    which alone reach the driver.
    """
    everything = (float("-inf"), float("inf"))
    bracket = dict.fromkeys(columns, everything)
    proven = {c: (everything, 0, None) for c in columns}
    margin = dict.fromkeys(columns, 3.0 / accuracy)
    found: dict = {}
    while bracket:
        measures = []
        for c, (low, high) in bracket.items():
            measures += [
                F.count(c).alias(f"{c}_n"),
                F.count_if(F.col(c) < low).alias(f"{c}_below"),
                F.count_if(F.col(c).between(low, high)).alias(f"{c}_in"),
            ]
        sizes = df.agg(*measures).first()
        shares = {}
        for c, (low, high) in list(bracket.items()):
            n, below, inside = sizes[f"{c}_n"], sizes[f"{c}_below"], sizes[f"{c}_in"]
            first, second = (n - 1) // 2, n // 2
            if n == 0:
                found[c] = None
            elif below <= first and second < below + inside:
                proven[c] = ((low, high), below, inside)
                if low == high:
                    found[c] = low
                elif inside <= gather:
                    rows = df.where(F.col(c).between(low, high)).groupBy(c).agg(F.count("*").alias("n")).collect()
                    ordered = [row[c] for row in sorted(rows, key=lambda r: r[c]) for _ in range(row["n"])]
                    found[c] = (ordered[first - below] + ordered[second - below]) / 2
            else:
                margin[c] *= 4
            if c in found:
                del bracket[c]
                continue
            _, before, held = proven[c]
            shares[c] = (
                max(0.0, (first - before) / held - margin[c]),
                min(1.0, (second + 1 - before) / held + margin[c]),
            )
        if shares:
            sketches = [
                F.percentile_approx(
                    F.when(F.col(c).between(*proven[c][0]), F.col(c)), list(ends), accuracy
                ).alias(c)
                for c, ends in shares.items()
            ]
            row = df.agg(*sketches).first()
            for c in shares:
                narrowed = (row[c][0], row[c][1])
                # A bracket that does not shrink holds few distinct values: finish by counting them.
                if narrowed == proven[c][0] or narrowed == bracket[c]:
                    found[c] = _median_by_values(df, c, proven[c][0], proven[c][1], sizes[f"{c}_n"])
                    del bracket[c]
                else:
                    bracket[c] = narrowed
    return found


def _median_by_values(df: DataFrame, column: str, bracket: tuple, below: int, n: int) -> float:
    """Median from the sorted (value, count) table of a bracket; only two rows are collected."""
    counted = df.where(F.col(column).between(*bracket)).groupBy(column).agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.orderBy(column))
    ranked = counted.withColumn("last", upto + below)
    picks = ranked.agg(
        *[F.min(F.when(F.col("last") > rank, F.col(column))).alias(name) for name, rank in (("a", (n - 1) // 2), ("b", n // 2))]
    ).first()
    return (picks["a"] + picks["b"]) / 2


def fit_imputer(
    df: DataFrame,
    numeric: list[str],
    categorical: list[str],
    impute_num: str = "median",
    impute_cat: str = "mode",
    num_constant: int | None = None,
    cat_constant: str | None = None,
    approximate: bool = False,
) -> Imputer:
    """Learn fills: numeric by mean, mode, constant, delete or (default) median; categorical by
    mode (default), constant or delete. ``approximate`` reads the median from a quantile sketch."""
    fills: dict = {}
    drop: list[str] = []
    # Inside, columns go by number, so that any name will do.
    names = [*numeric, *categorical]
    values = df.select(
        *[clean_double(quoted(c)).alias(f"_{names.index(c)}") for c in numeric],
        *[quoted(c).alias(f"_{names.index(c)}") for c in categorical],
    )
    inner = lambda columns: [f"_{names.index(c)}" for c in columns]
    outer = lambda found: {names[int(c[1:])]: v for c, v in found.items()}
    if impute_num == "delete":
        drop += numeric
    elif impute_num == "constant":
        fills.update({c: float(num_constant) for c in numeric})
    elif numeric:
        if impute_num == "mode":
            fills.update(outer(_most_common(values, inner(numeric))))
        else:
            if impute_num == "mean" or approximate:
                pick = F.avg if impute_num == "mean" else (lambda c: F.percentile_approx(c, 0.5, 100_000))
                row = values.agg(*[pick(c).alias(c) for c in inner(numeric)]).first().asDict()
            else:
                row = exact_medians(values, inner(numeric))
            fills.update({c: v for c, v in outer(row).items() if v is not None})
    if impute_cat == "delete":
        drop += categorical
    elif impute_cat == "constant":
        fills.update(dict.fromkeys(categorical, cat_constant))
    else:
        modes = outer(_most_common(values, inner(categorical)))
        fills.update({c: modes.get(c, UNKNOWN_CATEGORY) for c in categorical})
    return Imputer(fills, tuple(drop))


@dataclass(frozen=True)
class Scaler:
    """Per-column (shift, divisor), or row-wise unit length for ``normalizer``."""

    kind: str
    columns: tuple = ()
    shift: dict = field(default_factory=dict)
    divisor: dict = field(default_factory=dict)

    def apply(self, df: DataFrame) -> DataFrame:
        if self.kind == "none":
            return df
        values = {c: quoted(c).cast("double") for c in self.columns}
        if self.kind == "normalizer":
            squares = [value * value for value in values.values()]
            norm = F.sqrt(sum(squares[1:], squares[0]))
            return df.withColumns({c: F.when(norm > 0, v / norm).otherwise(v) for c, v in values.items()})
        return df.withColumns({c: (v - self.shift[c]) / self.divisor[c] for c, v in values.items()})


def fit_scaler(df: DataFrame, columns: list[str], scaler: str = "standard") -> Scaler:
    """minmax, maxabs, zscore or normalizer; every other name, ``standard`` too, scales nothing."""
    kind = scaler.lower()
    if not columns or kind not in ("minmax", "maxabs", "zscore", "normalizer"):
        warnings.warn("numeric columns are not scaled", stacklevel=2)
        return Scaler("none")
    if kind == "normalizer":
        return Scaler(kind, tuple(columns))
    measures: list[Column] = []
    for i, c in enumerate(columns):
        value = clean_double(quoted(c))
        if kind == "minmax":
            low, size = F.min(value), F.max(value) - F.min(value)
        elif kind == "maxabs":
            low, size = F.lit(0.0), F.max(F.abs(value))
        else:
            low, size = F.avg(value), F.stddev_pop(value)
        measures += [low.alias(f"_low{i}"), size.alias(f"_size{i}")]
    row = df.agg(*measures).first()
    shift = {c: row[f"_low{i}"] or 0.0 for i, c in enumerate(columns)}
    # A constant column keeps divisor 1, so it becomes 0 instead of a division by zero.
    divisor = {c: row[f"_size{i}"] or 1.0 for i, c in enumerate(columns)}
    return Scaler(kind, tuple(columns), shift, divisor)


@dataclass(frozen=True)
class LabelEncoder:
    """Category -> position in sorted order; an unseen category is an error.

    Few categories are looked up in an array, more in a joined table.
    """

    classes: dict

    def apply(self, df: DataFrame) -> DataFrame:
        few = [c for c, values in self.classes.items() if len(values) <= FEW_CATEGORIES]
        columns = df.columns
        df = df.withColumns({c: self.checked(c, F.array_position(F.array(*map(F.lit, self.classes[c])), quoted(c)) - 1) for c in few})
        for c in self.classes.keys() - set(few):
            rows = [(value, code) for code, value in enumerate(self.classes[c])]
            table = df.sparkSession.createDataFrame(rows, "_value string, _code long")
            named = lookup_join(df.withColumn("_value", quoted(c)), table, ["_value"], "left", table_rows=len(rows))
            df = named.withColumn(c, self.checked(c, F.col("_code"))).drop("_value", "_code")
        return df.select(*map(quoted, columns))

    def checked(self, column: str, code: Column) -> Column:
        unseen = F.raise_error(F.concat(F.lit(f"unseen value in {column}: "), F.coalesce(quoted(column), F.lit("null"))))
        return F.when(code >= 0, code.cast("int")).otherwise(unseen.cast("int"))


def fit_label_encoder(df: DataFrame, columns: list[str]) -> LabelEncoder:
    """Categories stay in the encoder; columns are categorical only up to a threshold of distinct values."""
    return LabelEncoder({c: small_values(df, c) for c in columns})
