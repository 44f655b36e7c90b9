"""Parquet tables and the review view built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give a table kept in fewer pieces than there are cores one piece per core.

    Costly text work on one big row group would otherwise run in one task. A table in many files
    is left as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as reviews; the score is null where a document has no label."""
    return _reviews(spark, folder, "left")


def _reviews(spark: SparkSession, folder: str, how: str) -> DataFrame:
    """Reviews of all documents (``left``) or of the rated ones (``inner``): then unrated texts never leave their scan's
    stage where the labels are small enough to be broadcast, and are dropped by the join itself where not."""
    documents = spread(table(spark, folder, "documents"), "doc_id")
    labels = table(spark, folder, "labels")
    odd = (F.col("doc_id") % 2).cast("int")
    score = (
        F.when(F.col("quality") == 0, 1 + odd).when(F.col("toxic") == 1, 3).when(F.col("quality") == 1, 4 + odd)
    )
    if how == "inner":
        labels = labels.where(F.col("quality").isin(0, 1) | (F.col("toxic") == 1))
    return documents.join(labels, "doc_id", how).select(
        F.col("doc_id").alias("row_id"),
        F.concat(F.lit("r"), F.col("doc_id").cast("string")).alias("reviewId"),
        F.col("text").alias("review"),
        score.cast("int").alias("score"),
        F.col("lang").alias("gender"),
        F.when(F.col("doc_id") % 11 != 0, F.col("source")).alias("location"),
        F.concat(F.lit("2024-01-"), F.lpad((1 + F.col("doc_id") % 28).cast("string"), 2, "0")).alias("date"),
        F.when(F.col("doc_id") % 7 != 0, F.col("n_chars").cast("double")).alias("n_chars"),
    )


def rated_reviews(spark: SparkSession, folder: str) -> DataFrame:
    return _reviews(spark, folder, "inner")


def split_of(row_id: str = "row_id") -> Column:
    """train, dev (ids ending in 8) or test (in 9)."""
    last = F.pmod(F.col(row_id), F.lit(10))
    return F.when(last == 8, "dev").when(last == 9, "test").otherwise("train")
