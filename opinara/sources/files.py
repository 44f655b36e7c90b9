"""Delimited review files: strict and tolerant readers, and the writers of the result tables."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.functions.numbers import DECIMAL, to_number
from opinara.operators.prepare import require_columns

# Texts read as a missing value.
MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Separators looked for in the header line.
SEPARATORS = [";", ",", "\t", "|"]

# Stands for "no text is null", so an empty field and an absent field stay distinguishable.
_NEVER = "\u0001"
_QUOTING = {"quote": '"', "escape": '"', "header": True}


def _missing_to_null(column: str) -> Column:
    return F.when(~F.col(column).isin(*MISSING), F.col(column)).alias(column)


def infer_numbers(df: DataFrame) -> DataFrame:
    """Turn string columns that hold only whole numbers into bigint, other numbers into double.

    All columns are judged in one pass. A whole-number column with gaps becomes double.
    """
    strings = [c for c, t in df.dtypes if t == "string"]
    if not strings:
        return df
    checks = []
    for c in strings:
        value = F.col(c)
        whole = value.rlike(r"^\s*[+-]?\d{1,18}\s*$")
        checks += [
            F.count(value).alias(f"{c}|n"),
            F.count_if(value.isNull()).alias(f"{c}|null"),
            F.count_if(whole).alias(f"{c}|whole"),
            F.count_if(value.rlike(DECIMAL)).alias(f"{c}|number"),
        ]
    row = df.agg(*checks).first()
    changes = {}
    for c in strings:
        n = row[f"{c}|n"]
        if n and row[f"{c}|whole"] == n and not row[f"{c}|null"]:
            changes[c] = F.trim(F.col(c)).cast("long")
        elif n and row[f"{c}|number"] == n:
            changes[c] = to_number(F.col(c))
    return df.withColumns(changes) if changes else df


def _header(spark: SparkSession, path: str, encoding: str) -> str:
    first = spark.read.option("encoding", encoding).option("wholetext", False).text(path).limit(1).collect()
    if not first:
        raise ValueError(f"{path} is empty")
    return first[0][0].lstrip("﻿")


def sniff_separator(header: str) -> str:
    """The candidate separator that occurs most often in the header; the first one on ties."""
    return max(SEPARATORS, key=header.count)


def read_reviews(
    spark: SparkSession,
    path: str,
    sep: str = ";",
    schema: T.StructType | None = None,
    rename: dict[str, str] | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """UTF-8 file with a header and a known separator. Types come from ``schema`` or the values.

    ``multi_line`` allows line breaks inside quotes, as free text has them; such a file is read by one task. Turn it off
    for large files without them, which then are split.
    """
    options = {**_QUOTING, "multiLine": multi_line, "sep": sep, "encoding": "UTF-8"}
    if schema is not None:
        names = {f.name: f.dataType for f in schema.fields}
        texts = T.StructType([T.StructField(n, T.StringType()) for n in names])
        raw = spark.read.schema(texts).options(**options).csv(path).select(*[_missing_to_null(n) for n in names])
        typed = {n: F.trim(F.col(n)).try_cast(t) for n, t in names.items() if not isinstance(t, T.StringType)}
        df = raw.withColumns(typed) if typed else raw
    else:
        raw = spark.read.options(**options, inferSchema=False).csv(path)
        df = infer_numbers(raw.select(*[_missing_to_null(c) for c in raw.columns]))
    for old, new in (rename or {}).items():
        df = df.withColumnRenamed(old, new)
    return df


def valid_utf8(spark: SparkSession, path: str) -> bool:
    """Whether every line is valid UTF-8; stops at the first line that is not."""
    return spark.read.text(path).where(~F.is_valid_utf8("value")).isEmpty()


def read_reviews_tolerant(spark: SparkSession, path: str, infer: bool = True, multi_line: bool = True) -> DataFrame:
    """File of unknown separator and encoding. Short lines are padded, lines too long are skipped.

    ``multi_line`` as in ``read_reviews``.
    """
    encoding = "UTF-8" if valid_utf8(spark, path) else "ISO-8859-1"
    header = _header(spark, path, encoding)
    sep = sniff_separator(header)
    names = next(csv.reader([header], delimiter=sep))
    # One more column than the header: whatever lands there proves the line too long.
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "_surplus"]])
    raw = (
        spark.read.schema(schema)
        .options(**_QUOTING, multiLine=multi_line, sep=sep, encoding=encoding, nullValue=_NEVER, emptyValue="", mode="PERMISSIVE")
        .option("enforceSchema", True)
        .csv(path)
    )
    kept = raw.where(F.col("_surplus").isNull()).select(*[_missing_to_null(n) for n in names])
    return infer_numbers(kept) if infer else kept


def read_topic_source(
    spark: SparkSession, path: str, text: str = "review", score: str = "score", multi_line: bool = True
) -> DataFrame:
    """``;`` file for the topic job, checked for its two columns before anything is run."""
    return require_columns(read_reviews(spark, path, ";", multi_line=multi_line), [text, score])


def write_csv(df: DataFrame, path: str, sep: str = ",", partition_by: list[str] | None = None) -> str:
    """A folder of delimited part files that the readers above read back unchanged."""
    writer = df.write.mode("overwrite").options(
        header=True,
        sep=sep,
        quote='"',
        escape='"',
        encoding="UTF-8",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        emptyValue="",
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)
    return path


def write_predictions(df: DataFrame, path: str) -> str:
    return write_csv(df, path)


# Header of the grid result file.
GRID_HEADER = {"model": "NombreMod", "precision": "Precisión", "recall": "Recall"}


def grid_result_table(scores: DataFrame, average: str = "macro") -> DataFrame:
    """Name and mean scores per grid cell, as text with 4 decimals."""
    four = {m: F.format_string("%.4f", F.col(m)) for m in ("precision", "recall", "f1")}
    return scores.select(
        F.col("model").alias(GRID_HEADER["model"]),
        four["precision"].alias(GRID_HEADER["precision"]),
        four["recall"].alias(GRID_HEADER["recall"]),
        four["f1"].alias(f"F_score({average})"),
    )


def write_grid_results(scores: DataFrame, path: str, average: str = "macro") -> str:
    return write_csv(grid_result_table(scores, average), path)


def write_topic_assignments(df: DataFrame, path: str, company: str, ngram: str, text: str = "review", score: str = "score") -> str:
    """Text, score, topic and share per review in folders company/ngram/sentiment, separator ``;``."""
    chosen = df.select(
        text,
        score,
        "Topico_Dominante",
        "Porcentaje_Similitud",
        F.lit(company).alias("company"),
        F.lit(ngram).alias("ngram"),
        "sentiment",
    )
    return write_csv(chosen, path, ";", ["company", "ngram", "sentiment"])


def write_augmented(augmented: DataFrame, path: str, sep: str = ";") -> tuple[str, str]:
    """Two tables: everything, and generated rows only. ``augmented`` carries ``is_generated``."""
    full = write_csv(augmented.drop("is_generated"), f"{path}/full", sep)
    generated = write_csv(augmented.where("is_generated").drop("is_generated"), f"{path}/generated", sep)
    return full, generated


def write_answer_labels(df: DataFrame, path: str) -> str:
    return write_csv(df, path)
