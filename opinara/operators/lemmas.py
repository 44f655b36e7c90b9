"""Lemmas of nouns that a lexicon accepts, as a joined table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.functions import resources
from opinara.functions.text import irregular_nouns
from opinara.session import lookup_join


def lemma_table(words: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(word, lemma) of each different ``word``: exceptions first, then the first suffix rule whose result ``lexicon`` has.

    A word that no rule brings into the lexicon (a column ``word``) stays as it is.
    """
    word = F.col("word")
    rules = [
        F.when(
            word.endswith(ending) & (F.length("word") > len(ending)),
            F.struct(
                F.lit(number).alias("rule"),
                F.concat(word.substr(F.lit(1), F.length("word") - len(ending)), F.lit(new)).alias("lemma"),
            ),
        )
        for number, (ending, new) in enumerate(resources.NOUN_SUFFIXES)
    ]
    different = words.select("word").where(word.isNotNull()).distinct()
    known = different.sparkSession.createDataFrame(list(irregular_nouns().items()), "word string, _known string")
    named = different.join(F.broadcast(known), "word", "left")  # a fixed list
    tried = named.where("_known IS NULL").select("word", F.explode(F.array_compact(F.array(*rules))).alias("r"))
    found = tried.select("word", "r.*").join(lexicon.select(F.col("word").alias("lemma")).distinct(), "lemma", "left_semi")
    first = found.groupBy("word").agg(F.min(F.struct("rule", "lemma"))["lemma"].alias("_found"))
    return named.join(first, "word", "left").select("word", F.coalesce("_known", "_found", "word").alias("lemma"))


def apply_lemmas(df: DataFrame, tokens: str, lemmas: DataFrame, row_id: str = "row_id") -> DataFrame:
    """``df`` with every token replaced by its lemma; a token without one stays."""
    placed = df.select(row_id, F.posexplode(tokens).alias("_at", "word"))
    named = lookup_join(placed, lemmas, ["word"], "left").select(
        row_id, F.struct("_at", F.coalesce("lemma", "word").alias("lemma")).alias("_t")
    )
    listed = named.groupBy(row_id).agg(F.transform(F.sort_array(F.collect_list("_t")), lambda t: t["lemma"]).alias("_l"))
    joined = df.join(listed, row_id, "left")
    return joined.withColumn(tokens, F.coalesce("_l", tokens)).drop("_l")
