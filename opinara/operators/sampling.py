"""Class rebalancing: random over/undersampling, SMOTE, ADASYN, and exact-size sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.functions.rng import lehmer, uniform, wide
from opinara.operators.neighbors import knn
from opinara.operators.ranks import class_ranks
from opinara.session import BROADCAST_TEXT_ROWS, generate_rows, lookup_join, materialise

SEED = 42
NEIGHBORS = 5
# Above this many rows a sample is taken by distributed ranks instead of a single top-n.
TOP_N_ROWS = 100_000


# A table of classes is broadcast up to this many of them.
BROADCAST_CLASSES = 100_000
# More classes than this would make two draws share a seed.
CLASS_STRIDE = 1 << 20


def class_sizes(df: DataFrame, label: str) -> DataFrame:
    """(label, n, deficit): rows of each class, and how many it lacks to the largest one."""
    sizes = df.groupBy(label).agg(F.count("*").alias("n"))
    majority = sizes.agg(F.max("n")).first()[0] or 0
    return sizes.withColumn("deficit", F.lit(majority) - F.col("n"))


def with_classes(df: DataFrame, classes: DataFrame, label: str, how: str = "inner") -> DataFrame:
    """``df`` joined with a row per class; broadcast only if the classes are counted few."""
    return lookup_join(df, classes, [label], how, max_rows=BROADCAST_CLASSES)


def random_oversample(df: DataFrame, label: str, row_id: str = "row_id", seed: int = SEED) -> DataFrame:
    """Every class filled to the largest by draws with replacement; ``copy`` 0 marks originals.

    Draws are counted per row before they meet the table, so each row is moved once however often
    it is drawn.
    """
    draws = generate_rows(class_sizes(df, label), "deficit", "draw")
    picked = draws.withColumn("_rank", wide(F.col("draw"), seed) % F.col("n") + 1)
    times = picked.groupBy(label, "_rank").agg(F.count("*").alias("_times"))
    ranked = class_ranks(df, F.col(label), row_id=row_id, seed=seed, rank="_rank")
    copies = generate_rows(ranked.join(times, [label, "_rank"]), "_times", "copy")
    return df.withColumn("copy", F.lit(0).cast("long")).unionByName(
        copies.select(*df.columns, (F.col("copy") + 1).alias("copy"))
    )


def random_undersample(df: DataFrame, label: str, row_id: str = "row_id", seed: int = SEED) -> DataFrame:
    """Every class cut to the size of the smallest, without replacement."""
    smallest = class_sizes(df, label).agg(F.min("n")).first()[0] or 0
    ranked = class_ranks(df, F.col(label), row_id=row_id, seed=seed, rank="_rank", limit=F.lit(smallest))
    return ranked.drop("_rank")


def resample_inside_folds(df: DataFrame, label: str, kind: str, row_id: str = "row_id", seed: int = SEED, n_folds: int = 5) -> DataFrame:
    """Training rows of every fold, rebalanced without the rows that the fold holds out.

    ``df`` has a ``fold`` of 0..n_folds-1. Result: ``held``, the fold left out, the columns of ``df``, and ``copy``, 0 for
    originals. ``kind`` is ``oversampling`` or ``undersampling``, for each held fold by the same draws as for a table of
    its training rows alone. All folds are ranked and drawn in one pass, a class being a pair of held fold and label.
    Rows without a fold are left out; an empty table gives an empty one.
    """
    others = F.filter(F.sequence(F.lit(0), F.lit(n_folds - 1)), lambda held: held != F.col("fold"))
    spaced = df.select(F.explode(others).alias("held"), *df.columns)
    sizes = spaced.groupBy("held", label).agg(F.count("*").alias("n"))
    pair = F.struct("held", label)
    if kind == "undersampling":
        smallest = sizes.groupBy("held").agg(F.min("n").alias("_smallest"))
        bounded = spaced.join(F.broadcast(smallest), "held")  # a row per fold
        kept = class_ranks(bounded, pair, row_id=row_id, seed=seed, rank="_rank", limit=F.col("_smallest"))
        return kept.select("held", *df.columns, F.lit(0).cast("long").alias("copy"))
    if kind != "oversampling":
        raise ValueError(f"{kind} is neither oversampling nor undersampling")
    largest = sizes.groupBy("held").agg(F.max("n").alias("_largest"))
    short = sizes.join(F.broadcast(largest), "held").withColumn("deficit", F.col("_largest") - F.col("n"))
    picked = generate_rows(short, "deficit", "draw").withColumn("_rank", wide(F.col("draw"), seed) % F.col("n") + 1)
    times = picked.groupBy("held", label, "_rank").agg(F.count("*").alias("_times"))
    ranked = class_ranks(spaced, pair, row_id=row_id, seed=seed, rank="_rank")
    copies = generate_rows(ranked.join(times, ["held", label, "_rank"]), "_times", "copy")
    columns = ["held", *df.columns]
    return spaced.select(*columns, F.lit(0).cast("long").alias("copy")).unionByName(
        copies.select(*columns, (F.col("copy") + 1).alias("copy"))
    )


def sample_n(df: DataFrame, n: int, row_id: str = "row_id", seed: int = SEED, total: int | None = None) -> DataFrame:
    """Exactly n rows in pseudo-random order of row id; n outside 1..total is refused."""
    total = df.count() if total is None else total
    if n <= 0 or n > total:
        raise ValueError(f"sample size {n} is outside 1..{total}")
    if n <= TOP_N_ROWS:
        return df.orderBy(lehmer(F.col(row_id), seed), row_id).limit(n)
    return class_ranks(df, F.lit(0), row_id=row_id, seed=seed, rank="_rank", limit=F.lit(n)).drop("_rank")


def neighbors_in_class(vectors: DataFrame, k: int = NEIGHBORS) -> DataFrame:
    """k nearest rows of the same class for (row_id, y, idx, val)."""
    spaced = vectors.withColumn("space", F.col("y"))
    return knn(spaced, spaced, k, p=2, exclude="self")


def _interpolate(draws: DataFrame, vectors: DataFrame, neighbors: DataFrame, k: int, n_rows: int) -> DataFrame:
    """Synthetic rows on the line from a base row to one of its neighbours.

    ``draws`` holds (synthetic_id, row_id, seed_id). Neighbours are gathered per base row first
    (at most k of them), so a base row drawn very often is looked up, not shuffled on.
    """
    near = neighbors.join(
        vectors.select(F.col("row_id").alias("neighbor_id"), F.col("idx").alias("n_idx"), F.col("val").alias("n_val")),
        "neighbor_id",
    ).select("row_id", "position", "neighbor_id", "n_idx", "n_val")
    pairs = near.join(vectors.select("row_id", "y", "idx", "val"), "row_id")
    chosen = draws.withColumn("position", (lehmer(F.col("seed_id"), 101) % k + 1).cast("int")).withColumn(
        "u", uniform(F.col("seed_id"), 202)
    )
    joined = lookup_join(chosen, pairs, ["row_id", "position"], table_rows=n_rows * k, max_rows=20_000)
    mixed = F.map_zip_with(
        F.map_from_arrays("idx", "val"),
        F.map_from_arrays("n_idx", "n_val"),
        lambda _, a, b: F.coalesce(a, F.lit(0.0)) + F.col("u") * (F.coalesce(b, F.lit(0.0)) - F.coalesce(a, F.lit(0.0))),
    )
    entries = F.array_sort(F.map_entries(mixed))
    return joined.withColumn("_e", entries).select(
        "synthetic_id",
        "row_id",
        "neighbor_id",
        "u",
        "y",
        F.transform("_e", lambda e: e["key"]).alias("idx"),
        F.transform("_e", lambda e: e["value"]).alias("val"),
    )


def minority_rows(vectors: DataFrame, sizes: DataFrame, k: int) -> tuple[DataFrame, int]:
    """Rows of the classes that lack rows, and how many; such a class needs more than ``k`` of them."""
    short = sizes.where(F.col("deficit") > 0)
    scarce = short.where(F.col("n") <= k).orderBy("y").first()
    if scarce is not None:
        raise ValueError(f"class {scarce['y']} has {scarce['n']} rows, more than {k} are needed")
    total = short.agg(F.sum("n")).first()[0] or 0
    return with_classes(vectors, short.select("y"), "y", "left_semi"), total


def smote(vectors: DataFrame, k: int = NEIGHBORS, seed: int = SEED) -> DataFrame:
    """Synthetic rows that fill every class to the largest one.

    ``vectors`` holds (row_id, y, idx, val). Result: synthetic_id, its two parents, the step ``u``
    and the new vector. A class needs more than k rows.
    """
    sizes = class_sizes(vectors, "y")
    highest = sizes.agg(F.max("y")).first()[0] or 0
    if highest >= CLASS_STRIDE:
        raise ValueError(f"classes must be numbered below {CLASS_STRIDE}")
    minority, n_rows = minority_rows(vectors, sizes, k)
    ranked = class_ranks(minority.select("row_id", "y"), F.col("y"), seed=seed, rank="base_rank")
    draws = generate_rows(sizes, "deficit", "draw")
    picked = draws.withColumn("seed_id", F.col("draw") * CLASS_STRIDE + F.col("y")).withColumn(
        "base_rank", wide(F.col("seed_id"), seed) % F.col("n") + 1
    )
    based = lookup_join(picked, ranked, ["y", "base_rank"], table_rows=n_rows).select(
        F.concat_ws("-", "y", "draw").alias("synthetic_id"), "row_id", "seed_id"
    )
    return _interpolate(based, minority, neighbors_in_class(minority, k), k, n_rows)


def adasyn_quota(vectors: DataFrame, k: int = NEIGHBORS) -> DataFrame:
    """(row_id, y, other_share, quota): how many synthetic rows each minority row gets.

    A row's share grows with the part of its k nearest rows, over all classes, that belong to
    other classes; quotas are rounded half to even.
    """
    short = class_sizes(vectors, "y").where(F.col("deficit") > 0)
    minority = with_classes(vectors, short.select("y"), "y", "left_semi")
    found = knn(minority, vectors, k, p=2, exclude="self").withColumnRenamed("y", "other_y")
    shares = (
        found.join(minority.select("row_id", "y"), "row_id")
        .groupBy("row_id", "y")
        .agg((F.count_if(F.col("other_y") != F.col("y")) / k).alias("other_share"))
    )
    totals = shares.groupBy("y").agg(F.sum("other_share").alias("_total"))
    factors, n_classes = materialise(totals.join(short, "y").select("y", "_total", "deficit"))
    stuck = factors.where(F.col("_total") == 0).orderBy("y").first()
    if stuck is not None:
        raise ValueError(f"class {stuck['y']} has no row near another class")
    rated = lookup_join(shares, factors, ["y"], table_rows=n_classes, max_rows=BROADCAST_CLASSES)
    # A product within 1e-9 of one half counts as one half, so summing order cannot move a quota.
    quota = F.bround(F.round(F.col("other_share") * (F.col("deficit") / F.col("_total")), 9)).cast("long")
    return rated.select("row_id", "y", "other_share", quota.alias("quota"))


def adasyn(vectors: DataFrame, k: int = NEIGHBORS) -> DataFrame:
    """Synthetic rows by the quotas of ``adasyn_quota``; a class that lacks rows needs more than k of them."""
    minority, n_rows = minority_rows(vectors, class_sizes(vectors, "y"), k)
    quotas = adasyn_quota(vectors, k)
    draws = generate_rows(quotas.select("row_id", "quota"), "quota", "draw").select(
        F.concat_ws("-", "row_id", "draw").alias("synthetic_id"),
        "row_id",
        (lehmer(F.col("row_id")) * F.lit(1 << 31).cast("long") + F.col("draw")).alias("seed_id"),
    )
    return _interpolate(draws, minority, neighbors_in_class(minority, k), k, n_rows)


def pick_examples(
    batches: DataFrame, df: DataFrame, group: str, text: str, k: int, row_id: str = "row_id", seed: int = SEED
) -> DataFrame:
    """Add ``examples``: k in-group texts per batch, none twice within a batch.

    ``batches`` holds (group, batch). Rows of a group stand in hash order; batch b takes the next k
    of them, wrapping around.
    """
    pool = df.where(F.col(text).isNotNull())
    sizes = class_sizes(pool, group).select(group, F.col("n").alias("_n"))
    n_rows = pool.count()
    ranked = class_ranks(pool.select(row_id, group, text), F.col(group), row_id=row_id, seed=seed, rank="_rank")
    asked = (
        with_classes(batches, sizes, group)
        .withColumn("_i", F.explode(F.sequence(F.lit(0), F.least(F.lit(k).cast("long"), F.col("_n")) - 1)))
        .withColumn("_rank", (F.col("batch") * k + F.col("_i")) % F.col("_n") + 1)
    )
    found = lookup_join(
        asked,
        ranked.select(group, "_rank", text),
        [group, "_rank"],
        table_rows=n_rows,
        max_rows=BROADCAST_TEXT_ROWS,
    )
    listed = found.groupBy(group, "batch").agg(F.array_sort(F.collect_list(F.struct("_i", text))).alias("_t"))
    return batches.join(listed, [group, "batch"]).withColumn(
        "examples", F.transform("_t", lambda t: t[text])
    ).drop("_t")


def base_rows(
    wanted: DataFrame, df: DataFrame, group: str, position: str, carry: list[str], row_id: str = "row_id", seed: int = SEED
) -> DataFrame:
    """Give every wanted (group, position) one pseudo-random in-group row's ``carry`` columns."""
    sizes = class_sizes(df, group).select(group, F.col("n").alias("_n"))
    ranked = class_ranks(df.select(row_id, group, *carry), F.col(group), row_id=row_id, seed=seed, rank="_rank")
    drawn = with_classes(wanted, sizes, group).withColumn("_rank", wide(F.col(position), seed) % F.col("_n") + 1)
    pool = ranked.drop(row_id)
    return lookup_join(drawn, pool, [group, "_rank"], table_rows=df.count()).drop("_n", "_rank")
