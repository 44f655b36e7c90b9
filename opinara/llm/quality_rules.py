"""Quality rules as a short-circuit cascade, in DataFrame expressions only.

Every rule is a boolean expression over measures of one text. Rejecting is an OR over all rules, so their order
cannot change a verdict; it only decides how soon a bad text is given up. A rule's measures stand inside its own branch,
so they are taken only of texts that no rule before it has rejected. ``plan_cascade`` times each rule and counts what it
rejects on a bounded sample, and orders the rules by rejections per second of cost.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.llm import common

WINDOW = 5
SYMBOLS = "#*$%&|<>"
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
# Rows on which costs and selectivities are estimated, how often each is judged in a timed job, jobs of which the fastest
# counts, and seconds a judged row below which costs are not told apart. Verdicts do not depend on any of them.
SAMPLE_ROWS = 500
REPEATS = 40
JOBS = 3
LEAST_COST = 1e-6


@dataclass(frozen=True)
class Rule:
    """``rejects`` maps the measures of ``expressions`` to a boolean expression that is never null."""

    name: str
    rejects: Callable[[Mapping[str, Column]], Column]


def word_list(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(common.WORD), F.lit(0))


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def word_chars(text: Column) -> Column:
    return F.length(without(text, SPACES)).cast("long")


def symbols(text: Column) -> Column:
    return (F.length(text) - F.length(without(text, SYMBOLS))).cast("long")


def worded_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: F.length(without(line, SPACES)) > 0)


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return common.let(worded_lines(text), lambda lines: F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside a window of ``window`` words that the text holds twice or more, the first one included.

    Windows are compared by 64-bit hashes. A text without a repeated window stops at the first comparison; else the
    hashes are sorted with their places, the places of repeated ones are sorted again, and their cover is summed.
    """

    def hashes(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - window)
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(window)]))

    def cover(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return common.let(placed, covered)

    def covered(p: Column) -> Column:
        same = lambda a, b: F.coalesce(F.get(p, a)["h"] == F.get(p, b)["h"], F.lit(False))
        kept = F.filter(F.sequence(F.lit(0), F.size(p) - 1), lambda j: same(j, j + 1) | same(j, j - 1))
        starts = F.sort_array(F.transform(kept, lambda j: F.get(p, j)["i"]))
        start = F.struct(F.lit(0).alias("words"), F.lit(-window).alias("last"))
        step = lambda a, s: F.struct(
            (a["words"] + F.least(F.lit(window), s - a["last"])).alias("words"), s.alias("last")
        )
        return F.aggregate(starts, start, step, lambda a: a["words"])

    found = common.let(
        hashes(words), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(cover(h))
    )
    return F.when(F.size(words) <= window, 0).otherwise(found).cast("long")


def expressions(text: Column, words: Column) -> dict[str, Column]:
    """Every measure of a non-null text and its word array, by name; long values."""
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": word_chars(text),
        "n_symbols": symbols(text),
        "n_dup_lines": duplicate_lines(text),
        "n_repeat_words": repeated_words(words),
        "n_lines": F.size(worded_lines(text)).cast("long"),
        "n_capitals": F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long"),
        "n_exclamations": (F.length(text) - F.length(without(text, "!"))).cast("long"),
    }


# Fixed values of the base rules: fewest words, and the largest share of repeated words in percent.
FEWEST_WORDS = 10
REPEAT_PERCENT = 20
BASE_RULES = (
    Rule("few_words", lambda m: m["n_words"] < FEWEST_WORDS),
    Rule("repeats", lambda m: 100 * m["n_repeat_words"] > REPEAT_PERCENT * m["n_words"]),
)
# Shares that clean prose stays well below: symbols, shouting, glued words, lines said before.
MORE_RULES = (
    Rule("symbols", lambda m: 10 * m["n_symbols"] > m["n_words"]),
    Rule("exclamations", lambda m: 10 * m["n_exclamations"] > 3 * m["n_words"]),
    Rule("capitals", lambda m: 2 * m["n_capitals"] > m["word_chars"]),
    Rule("long_words", lambda m: m["word_chars"] > 40 * m["n_words"]),
    Rule("repeated_lines", lambda m: 2 * m["n_dup_lines"] > m["n_lines"]),
)


def _seconds(rows: DataFrame, value: Column) -> float:
    """The fastest of JOBS runs of one job that sums ``value``."""
    job, best = rows.agg(F.sum(value)), float("inf")
    for _ in range(JOBS):
        began = time.perf_counter()
        job.collect()
        best = min(best, time.perf_counter() - began)
    return best


def plan_cascade(
    docs: DataFrame,
    rules: Sequence[Rule],
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    taken: Sequence[str] = (),
) -> list[Rule]:
    """Rules by rejections per second of cost, measured on the texts of the ``sample_rows`` least hashes, each once.

    A rule's cost is the time of a job that judges every row REPEATS times, less that of the same job without a rule,
    in powers of two; equal ones keep their order. Measures named in ``taken`` are at hand whatever the order, and cost
    a rule nothing.
    """
    body = docs.select(common.whole_text(text).alias("_text"))
    hashed = body.withColumn("_hash", F.xxhash64("_text"))
    last = hashed.select("_hash").orderBy("_hash").limit(sample_rows).agg(F.max("_hash")).first()[0]
    rows = [(row[1],) for row in hashed.where(F.col("_hash") <= last).groupBy("_hash").agg(F.first("_text")).collect()]
    sample = docs.sparkSession.createDataFrame(rows, "_text string").withColumn("_words", word_list(F.col("_text")))
    measure = expressions(F.col("_text"), F.col("_words"))
    sample = sample.withColumns({f"_{name}": measure[name] for name in taken}).coalesce(1).persist()
    sample.count()
    known, value = {**measure, **{name: F.col(f"_{name}") for name in taken}}, {}
    try:
        often = sample.withColumn("_again", F.explode(F.sequence(F.lit(1), F.lit(REPEATS))))
        idle = _seconds(often, F.length("_text"))
        for rule in rules:
            hits = sample.agg(F.sum(rule.rejects(known).cast("int"))).first()[0] or 0
            # The row's number keeps the judging behind the repetition.
            spent = _seconds(often, F.when(rule.rejects(known), F.col("_again")).otherwise(F.length("_text")))
            cost = max((spent - idle) / max(len(rows) * REPEATS, 1), LEAST_COST)
            value[rule.name] = hits / 2.0 ** round(math.log2(cost))
    finally:
        sample.unpersist()
    return sorted(rules, key=lambda rule: -value[rule.name])


def verdict(rules: Sequence[Rule], known: Mapping[str, Column]) -> Column:
    """True if no rule rejects; a rule is evaluated only on texts that those before it let pass."""
    kept = F.lit(True)
    for rule in reversed(rules):
        kept = F.when(rule.rejects(known), F.lit(False)).otherwise(kept)
    return kept


def cascade(
    docs: DataFrame, rules: Sequence[Rule] = BASE_RULES + MORE_RULES, text: str = "text", kept: str = "kept"
) -> DataFrame:
    """``docs`` with a boolean column ``kept`` (replaced if there is one).

    A null text counts as an empty one and fails the rule on few words; repeated rows get the same verdict; an empty
    table stays empty. Texts are judged whole, however long.
    """
    ordered = plan_cascade(docs, rules, text)
    body = common.whole_text(text)
    worded = docs.withColumn("_quality_words", word_list(body))
    return worded.withColumn(kept, verdict(ordered, expressions(body, F.col("_quality_words")))).drop("_quality_words")


def measures(docs: DataFrame, text: str = "text", names: Sequence[str] | None = None) -> DataFrame:
    """``docs`` with a column for each measure (or those named) of each whole text; null texts count as empty."""
    body = common.whole_text(text)
    worded = docs.withColumn("_quality_words", word_list(body))
    every = expressions(body, F.col("_quality_words"))
    return worded.withColumns({name: every[name] for name in names or every}).drop("_quality_words")


# Measures that the query's result shows, whatever its verdicts are.
SHOWN = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Measures and verdict of every document. Texts that fail the base rules meet no other rule, and measures beside
    those shown are taken only in the branch of the rule that asks for them."""
    docs = common.documents(spark, folder).select("doc_id", "text")
    ordered = plan_cascade(docs, MORE_RULES, taken=SHOWN)
    measured = measures(docs, names=SHOWN)
    body = common.whole_text("text")
    known = {**expressions(body, word_list(body)), **{name: F.col(name) for name in SHOWN}}
    judged = measured.withColumn("base_failed", reduce(or_, (rule.rejects(known) for rule in BASE_RULES)))
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(verdict(ordered, known))
    return judged.select("doc_id", *SHOWN, "base_failed", kept.alias("kept"))


OP8_SQL = r"""
WITH worded AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
windows AS (
  SELECT rid, i, words[i:i + 4] AS five
  FROM worded, unnest(range(1, greatest(len(words) - 3, 1))) AS r(i)),
twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, five) AS n FROM windows) WHERE n > 1),
covered AS (SELECT rid, count(DISTINCT i + k) AS n FROM twice, unnest(range(5)) AS s(k) GROUP BY rid),
lines AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM worded, unnest(string_split(body, chr(10))) AS l(line)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
known AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(body, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines, length(regexp_replace(body, '\P{Lu}', '', 'g')) AS n_capitals,
         length(regexp_replace(body, '[^!]', '', 'g')) AS n_exclamations
  FROM worded LEFT JOIN covered USING (rid) LEFT JOIN lines USING (rid)),
based AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM known)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 10 * n_exclamations > 3 * n_words OR 2 * n_capitals > word_chars
            OR word_chars > 40 * n_words OR 2 * n_dup_lines > n_lines) AS kept
FROM based
"""
