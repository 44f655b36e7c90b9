"""Which blocks of sparse rows can hold a query's nearest rows, by inverted lists and the rows of smallest norm.

For rows without negative values the distance of two rows is the sum of their norms less a gain from shared terms
(p=2: |a|^2 + |b|^2 - 2 sum a b; p=1: sum a + sum b - sum 2 min(a, b)). So of the rows that share no term with a query
only the k of smallest norm can be among its nearest, and any other row must gain more than its norm exceeds theirs.

Rows lie in blocks by their heaviest term, queries in parts likewise. Both long forms are summed up to the largest value
of a term in a block and in a part and joined on the term; the products, summed by (block, part), bound the gain of any
pair of rows in it. A part visits a block only if that bound reaches what the block's least norm asks for. Rows are
copied to the parts that visit their block and to no others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.functions.rng import lehmer
from opinara.session import lookup_join, stored

# (block, part) pairs that one term may add; a term beyond that counts as shared by all of its space.
HOT_PAIRS = 1_000_000
# Slices of a space when its lightest rows are looked for, and the block that holds them.
SLICES = 64
LIGHT = -1
# Distances are rounded to 12 places; bounds are widened by more than that.
SLACK = 1e-9


def norm(p: int) -> Column:
    """Sum of values (p=1) or of their squares (p=2)."""
    return F.aggregate("val", F.lit(0.0), lambda a, x: a + (x if p == 1 else x * x))


def heaviest_term() -> Column:
    """The term of the largest value, the first on ties; null for a row without terms."""
    place = F.array_position("val", F.array_max("val")).cast("int")
    return F.when(F.size("idx") > 0, F.element_at("idx", F.greatest(place, F.lit(1))))


def lightest(train: DataFrame, need: int, keys: list[str]) -> DataFrame:
    """The ``need`` rows of smallest norm of each space (and fold), by id on ties; no space is sorted in one task."""
    order = [F.round("norm", 12), F.col("row_id")]
    sliced = Window.partitionBy(*keys, F.pmod(lehmer(F.col("row_id"), 3), F.lit(SLICES))).orderBy(*order)
    some = train.select(*keys, "row_id", "norm").withColumn("_at", F.row_number().over(sliced)).where(F.col("_at") <= need)
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return some.withColumn("_at", at).where(F.col("_at") <= need).drop("_at")


def _long(rows: DataFrame, group: str) -> DataFrame:
    entries = F.inline(F.arrays_zip(F.col("idx").alias("term"), F.col("val").alias("value")))
    return rows.select("space", group, entries).groupBy("space", "term", group).agg(F.max("value").alias("most"))


def visits(
    held: DataFrame, asking: DataFrame, light: DataFrame, need: int, by_fold: bool, p: int, hot_pairs: int = HOT_PAIRS
) -> DataFrame:
    """(space, block, part): the blocks that each part has to visit.

    ``held`` holds space, block, norm, idx and val of rows that have terms; ``asking`` space, part, idx and val.
    """
    blocks = held.groupBy("space", "block").agg(F.min("norm").alias("least"))
    if by_fold:  # whichever fold is left out, so many light rows are left
        sizes = light.groupBy("space", "fold").agg(F.count("*").alias("n"), F.max("norm").alias("norm"))
        whole = sizes.groupBy("space").agg((F.sum("n") - F.max("n")).alias("n"), F.max("norm").alias("norm"))
    else:
        whole = light.groupBy("space").agg(F.count("*").alias("n"), F.max("norm").alias("norm"))
    reach = whole.select("space", F.when(F.col("n") >= need, F.col("norm")).alias("reach"))
    # What a row of the block has to gain before it can be among the nearest; null if any row can.
    asked = lookup_join(blocks, reach, ["space"], "left").select("space", "block", (F.col("least") - F.col("reach")).alias("gain"))
    asked = stored(asked, "knn-blocks")
    ours, theirs = _long(held, "block"), _long(asking, "part")
    parts = theirs.select("space", "part").distinct()

    def bound(a: Column, b: Column) -> Column:
        return 2 * F.least(a, b) if p == 1 else 2 * a * b

    spread = ours.groupBy("space", "term").agg(F.count("*").alias("n_blocks"), F.max("most").alias("most_held"))
    spread = spread.join(theirs.groupBy("space", "term").agg(F.count("*").alias("n_parts"), F.max("most").alias("most_asked")), ["space", "term"])
    hot = F.col("n_blocks") * F.col("n_parts") > hot_pairs
    spread = stored(spread.withColumn("hot", hot), "knn-terms")
    shared_by_all = spread.where("hot").groupBy("space").agg(F.sum(bound(F.col("most_held"), F.col("most_asked"))).alias("base"))
    usual = spread.where(~F.col("hot")).select("space", "term")
    pairs = ours.join(usual, ["space", "term"], "left_semi").join(theirs.withColumnRenamed("most", "_most"), ["space", "term"])
    found = pairs.groupBy("space", "block", "part").agg(F.sum(bound(F.col("most"), F.col("_most"))).alias("bound"))
    based = lookup_join(asked, shared_by_all, ["space"], "left").withColumn("base", F.col("base"))
    based = stored(based, "knn-bounds")
    enough = F.col("gain").isNull() | (F.coalesce(F.col("base"), F.lit(0.0)) + F.col("bound") >= F.col("gain") - SLACK)
    some = found.join(based, ["space", "block"]).where(enough).select("space", "block", "part")
    # Blocks that the hot terms alone may reach are visited by every part of their space.
    open_ = based.where(F.col("base").isNotNull() & (F.col("gain").isNull() | (F.col("base") >= F.col("gain") - SLACK)))
    every = open_.select("space", "block").join(parts, "space")
    return some.unionByName(every).distinct()
