"""Bag-of-words and TF-IDF in long form (row, term, value) over a fitted vocabulary."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.session import lookup_join, materialise, new_path


@dataclass(frozen=True)
class Vocabulary:
    """Fitted terms with their document frequency; ``terms`` is persisted and counted."""

    terms: DataFrame
    size: int
    n_docs: int

    def unpersist(self) -> None:
        self.terms.unpersist()


def document_frequency(df: DataFrame, grams: Column) -> DataFrame:
    """(term, df). Repeats are removed inside the row, so one pre-aggregated shuffle is enough."""
    # The outer form spares a second evaluation of the grams in an inferred emptiness test.
    terms = df.select(F.explode_outer(F.array_distinct(grams)).alias("term")).where(F.col("term").isNotNull())
    return terms.groupBy("term").agg(F.count("*").alias("df"))


def fit_vocabulary(df: DataFrame, grams: Column, min_df: int = 5, max_df: float = 0.8) -> Vocabulary:
    n_docs = df.count()
    kept = document_frequency(df, grams).where((F.col("df") >= min_df) & (F.col("df") <= max_df * n_docs))
    terms, size = materialise(kept)
    return Vocabulary(terms, size, n_docs)


def gram_counts(df: DataFrame, grams: Column, out: str = "counts") -> DataFrame:
    """Add an array of (term, n) per row, counted inside the row so that no shuffle is needed."""
    ordered = df.withColumn("_sorted", F.sort_array(grams))
    size = F.size("_sorted")
    positions = F.when(size > 0, F.sequence(F.lit(1), size)).otherwise(F.array().cast("array<int>"))

    def opens_run(i: Column) -> Column:
        return (i == 1) | (F.element_at("_sorted", i) != F.element_at("_sorted", F.greatest(i - 1, F.lit(1))))

    runs = ordered.withColumn("_starts", F.filter(positions, opens_run))
    ends = F.concat(F.slice("_starts", 2, F.greatest(F.size("_starts"), F.lit(1))), F.array(F.size("_sorted") + 1))
    counted = F.zip_with(
        "_starts",
        ends,
        lambda a, b: F.when(
            a.isNotNull(), F.struct(F.element_at("_sorted", a).alias("term"), (b - a).cast("long").alias("n"))
        ),
    )
    return runs.withColumn(out, F.filter(counted, lambda c: c.isNotNull())).drop("_sorted", "_starts")


def term_counts(df: DataFrame, grams: Column, carry: list[str]) -> DataFrame:
    """(carry..., term, n), one row per distinct term of each input row."""
    # The outer form keeps the optimizer from testing the counts below the columns they are built on,
    # which would sort a row's words again for each of them.
    return gram_counts(df, grams).select(*carry, F.inline_outer("counts")).where(F.col("term").isNotNull())


def bag_of_words(df: DataFrame, grams: Column, vocabulary: Vocabulary, carry: list[str] | None = None) -> DataFrame:
    counts = term_counts(df, grams, carry or ["row_id"])
    return lookup_join(counts, vocabulary.terms, ["term"], table_rows=vocabulary.size).drop("df")


def idf_weight(vocabulary: Vocabulary) -> Column:
    """Weight of a term found ``n`` times in a row and in ``df`` fitted rows, before the row is scaled."""
    return F.col("n") * (F.log((1.0 + vocabulary.n_docs) / (1.0 + F.col("df"))) + 1.0)


def tf_idf(df: DataFrame, grams: Column, vocabulary: Vocabulary, carry: list[str] | None = None) -> DataFrame:
    """n * (ln((1+N)/(1+df)) + 1), each row scaled to unit length. ``carry`` starts with the row id."""
    carry = carry or ["row_id"]
    counts = lookup_join(term_counts(df, grams, carry), vocabulary.terms, ["term"], table_rows=vocabulary.size)
    weighted = counts.select(*carry, "term", idf_weight(vocabulary).alias("_w"))
    # Partitioned by the row id alone, so later sums per row need no further shuffle.
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(carry[0])))
    return weighted.select(*carry, "term", (F.col("_w") / norm).alias("value"))


# Fixed value: terms that a topic dictionary keeps unless told otherwise.
KEEP_TERMS = 100_000


def topic_dictionary(
    df: DataFrame, tokens: Column, no_below: int = 5, no_above: float = 0.85, keep_n: int | None = KEEP_TERMS
) -> Vocabulary:
    """Terms in 5 or more documents and at most 85 % of them; the ``keep_n`` most frequent (None: all), numbered.

    ``keep_n`` bounds the table, so numbering it in one task is safe; without it the terms are numbered by their places
    in a distributed sort.
    """
    n_docs = df.count()
    kept = document_frequency(df, tokens).where((F.col("df") >= no_below) & (F.col("df") <= no_above * n_docs))
    if keep_n is None:
        numbered = numbered_in_order(kept, "term")
    else:
        top = kept.orderBy(F.desc("df"), "term").limit(keep_n)
        numbered = top.withColumn("term_id", F.row_number().over(Window.orderBy("term")) - 1)
    terms, size = materialise(numbered)
    return Vocabulary(terms, size, n_docs)


def numbered_in_order(df: DataFrame, column: str) -> DataFrame:
    """Add ``term_id`` from 0 in the order of a column without sorting all rows in one task."""
    path = new_path(df.sparkSession, "ordered")
    df.orderBy(column).withColumn("_id", F.monotonically_increasing_id()).write.parquet(path)
    placed = df.sparkSession.read.parquet(path).withColumn("_part", F.shiftright("_id", 33))
    counts = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    parts = F.broadcast(counts.select("_part", F.coalesce(before, F.lit(0)).alias("_before")))  # a row per part of the sort
    number = F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(parts, "_part").withColumn("term_id", number.cast("int")).drop("_part", "_before", "_id")


def doc2bow(df: DataFrame, tokens: Column, dictionary: Vocabulary, row_id: str = "row_id") -> DataFrame:
    counts = term_counts(df, tokens, [row_id])
    return lookup_join(counts, dictionary.terms, ["term"], table_rows=dictionary.size).select(row_id, "term_id", "n")
