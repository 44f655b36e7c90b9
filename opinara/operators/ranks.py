"""Exact in-class ranks without putting a class into one task."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.functions.rng import MODULUS, lehmer

# Ordered slices of the key space; one (class, slice) pair is the unit that gets sorted.
SLICES = 4096


def _row_slices(df: DataFrame, key: str, slices: int) -> DataFrame:
    """Slice a sortable numeric key at quantiles, so clustered ids still give even slices."""
    points = [i / slices for i in range(1, slices)]
    found = df.select(F.percentile_approx(F.col(key).cast("double"), points, 10 * slices)).first()[0] or []
    splits = [float("-inf"), *sorted(set(found)), float("inf")]
    if len(splits) < 3:
        return df.withColumn("_slice", F.lit(0))
    keyed = df.withColumn("_slice_key", F.col(key).cast("double"))
    sliced = Bucketizer(splits=splits, inputCol="_slice_key", outputCol="_slice").transform(keyed)
    return sliced.drop("_slice_key").withColumn("_slice", F.col("_slice").cast("int"))


def class_ranks(
    df: DataFrame,
    label: Column,
    row_id: str = "row_id",
    order: str = "hash",
    seed: int = 0,
    rank: str = "rank",
    limit: Column | None = None,
    slices: int = SLICES,
) -> DataFrame:
    """Add the 1-based rank of each row within its class.

    ``order="hash"`` orders by a pseudo-random key of ``row_id``; ``order="row"`` by ``row_id``
    itself. Rows are counted per (class, slice), the counts become slice offsets, and only rows of
    one slice are sorted together, so a class holding most of the table is still ranked in parallel.
    With ``limit`` only ranks up to it are produced, and slices beyond it are never sorted.
    """
    columns = df.columns
    keyed = df.withColumn("_label", label)
    if order == "hash":
        keyed = keyed.withColumn("_key", lehmer(F.col(row_id), seed)).withColumn(
            "_slice", F.floor(F.col("_key") * slices / F.lit(float(MODULUS))).cast("int")
        )
    else:
        keyed = _row_slices(keyed.withColumn("_key", F.col(row_id)), "_key", min(slices, 1000))
    counts = keyed.groupBy("_label", "_slice").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_label").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("_label").alias("_l"), F.col("_slice").alias("_s"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    # Both tables share the key of the sort below, so the join adds no further shuffle.
    joined = keyed.join(offsets, F.col("_label").eqNullSafe(F.col("_l")) & (F.col("_slice") == F.col("_s")))
    if limit is not None:
        joined = joined.where(F.col("_before") < limit)
    within = Window.partitionBy("_label", "_slice").orderBy("_key", row_id)
    ranked = joined.withColumn(rank, F.col("_before") + F.row_number().over(within))
    if limit is not None:
        ranked = ranked.where(F.col(rank) <= limit)
    return ranked.select(*columns, F.col(rank).cast("long").alias(rank))
