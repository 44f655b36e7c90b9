"""Mixing sources to target weights by weighted fair queueing, in DataFrame expressions only.

Each source's documents are shuffled by a hash of their id. A document finishes at the virtual time (words of its
source up to and including it) / (target of its source); a second pass over the source finishes later by
(size of the source) / target. Copies are taken in order of finish time until the next one would pass the budget.

Nothing is ordered in one task. Running sums of a source are summed over slices of the hash space, turned into offsets
and completed inside a slice; a source has as many slices as its rows ask for. The cut in the global order is found by
counting words per slice of time and going on inside the slice that holds the cut, until so few copies are left in it
that one task may sort them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opinara.llm import common
from opinara.session import stored

# Fixed values of the query contract: weights by rank of the source, budget as a share of all words, most repeats.
WEIGHTS = (5, 2, 1)
SHARE = (3, 2)
EPOCHS = 2
# Rows per slice of a source, slices of time per round, copies that one task may sort at the cut, rows and characters
# of a table that may be broadcast. Results do not depend on any of them.
SLICE_ROWS = 1_000
TIME_SLICES = 1_024
CUT_ROWS = 10_000
BROADCAST = (100_000, 10_000_000)
KEY_BITS = 60


def size_of(text: str | Column) -> Column:
    """Words of a whole text; 0 for null."""
    return F.regexp_count(common.whole_text(text), F.lit(common.WORD)).cast("long")


def shuffle_key(id_column: str) -> Column:
    digest = F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def small(df: DataFrame, characters: str | None = None) -> DataFrame:
    """The table marked for broadcast if its counted size allows that, else as it is."""
    length = F.sum(F.length(characters)) if characters else F.lit(0)
    rows, chars = df.agg(F.count(F.lit(1)), length).first()
    return F.broadcast(df) if rows <= BROADCAST[0] and (chars or 0) <= BROADCAST[1] else df


def placed(sources: DataFrame) -> DataFrame:
    """``sources`` with their 0-based place by code point, null last, from a distributed sort and counts per part."""
    ordered = sources.orderBy(F.col("source").asc_nulls_last()).withColumn("_id", F.monotonically_increasing_id())
    ordered = stored(ordered, "mix-places").withColumn("_part", F.shiftright("_id", 33))
    counts = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = F.broadcast(counts.select("_part", before.alias("_before")))  # a row for each part of the sort
    place = F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return ordered.join(parts, "_part").withColumn("place", place).drop("_part", "_id", "_before")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``sources`` (source, source_size, source_rows) with place and target, sharing the budget by weight under the caps.

    A round is one aggregate over the sources: those whose share passes EPOCHS times their size stop there, the others
    share what is left; it ends when no further one stops. Sums are exact integers in units of 1 / SHARE[1] words, and
    a target is one division of them.
    """
    choice = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    weighted = stored(placed(sources).withColumn("weight", choice.cast("decimal(38,0)")), "mix-weights")
    cap = F.col("source_size").cast("decimal(38,0)") * (EPOCHS * SHARE[1])
    size, weight = weighted.agg(F.sum("source_size"), F.sum("weight")).first()
    budget = rest = (size or 0) * SHARE[0]
    weight = int(weight or 0)
    while weight:
        stopped = cap * F.lit(weight) <= F.col("weight") * F.lit(rest)
        gone, left = weighted.agg(F.sum(F.when(stopped, cap)), F.sum(F.when(~stopped, F.col("weight")))).first()
        found = (budget - int(gone or 0), int(left or 0))
        if found == (rest, weight):
            break
        rest, weight = found
    share = (F.col("weight") * F.lit(rest)).cast("double") / F.lit(float(weight * SHARE[1] or 1))
    whole = (F.col("source_size") * EPOCHS).cast("double")
    stopped = cap * F.lit(weight) <= F.col("weight") * F.lit(rest)
    return weighted.withColumn("target", F.when(stopped, whole).otherwise(share)).drop("weight")


def queued(docs: DataFrame, sources: DataFrame, id_column: str) -> DataFrame:
    """``docs`` (with source, size and others) with the finish times ``_t0`` and ``_t1`` of their two copies.

    A time is null in a source whose target is 0. Rows of the same id and size are interchangeable.
    """
    spark_sources = small(sources, "source")
    known = docs.join(
        spark_sources.withColumnRenamed("source", "_of"), F.col("_queue_source").eqNullSafe(F.col("_of")), "left"
    ).drop("_of")
    slices = F.ceil(F.col("source_rows") / SLICE_ROWS)
    sliced = known.withColumn("_slice", F.floor(F.col("_key") / F.lit(float(1 << KEY_BITS)) * slices))
    sums = sliced.groupBy("place", "_slice").agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy("place").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("place", "_slice", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    so_far = Window.partitionBy("place", "_slice").orderBy("_key", id_column, "size")
    so_far = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    target = F.when(F.col("target") > 0, F.col("target"))
    done = F.col("_before") + F.sum("size").over(so_far)
    times = sliced.join(small(stored(offsets, "mix-offsets")), ["place", "_slice"]).withColumn("_done", done)
    for epoch in range(EPOCHS):
        times = times.withColumn(f"_t{epoch}", (F.col("_done") + epoch * F.col("source_size")) / target)
    return times.drop("_slice", "_before", "_done", "source_rows", "_queue_source", "_key")


@dataclass
class Cut:
    """Copies up to and including (time, place) are taken."""

    time: float
    place: int

    def takes(self, time: str) -> Column:
        at = F.col(time)
        taken = (at < F.lit(self.time)) | ((at == F.lit(self.time)) & (F.col("place") <= F.lit(self.place)))
        return F.coalesce(taken, F.lit(False))


@dataclass
class Narrowing:
    """Slices of time chosen so far: copies before the last one are taken, those in it are still open."""

    open: Column = field(default_factory=lambda: F.lit(True))
    words: int = 0


def find_cut(times: DataFrame, budget: int) -> Cut:
    """The last copy that the budget allows, from sums over slices of time and a sort of one small slice."""
    copies = times.select("place", "size", F.explode(F.array(*[F.col(f"_t{e}") for e in range(EPOCHS)])).alias("_t"))
    copies = copies.where((F.col("size") > 0) & F.col("_t").isNotNull())
    state = Narrowing()
    while True:
        inside = copies.where(state.open)
        low, high, rows = inside.agg(F.min("_t"), F.max("_t"), F.count(F.lit(1))).first()
        if not rows:
            return Cut(-1.0, -1)
        if rows <= CUT_ROWS or low == high:
            break
        cell = F.floor((F.col("_t") - F.lit(low)) / F.lit((high - low) / TIME_SLICES))
        sums = sorted(inside.groupBy(cell.alias("cell")).agg(F.sum("size").alias("words")).collect())
        for number, words in sums:
            if state.words + words > budget:
                break
            state.words += words
        else:
            return Cut(high, (1 << 62))
        state.open = state.open & (cell == number)
    running = F.sum("size").over(Window.orderBy("_t", "place").rowsBetween(Window.unboundedPreceding, 0))
    allowed = inside.withColumn("_words", running).where(F.col("_words") + state.words <= F.lit(budget))
    last = allowed.agg(F.max(F.struct("_t", "place"))).first()[0]
    # If none is allowed, everything before the slice is taken: just below its first copy.
    return Cut(last[0], last[1]) if last else Cut(low, -1)


@dataclass
class Schedule:
    """``rows`` have the finish times of each document's copies; ``sources`` their targets; ``keyed`` whole documents."""

    keyed: DataFrame
    sources: DataFrame
    rows: DataFrame
    cut: Cut

    def copies(self) -> Column:
        return sum(self.cut.takes(f"_t{epoch}").cast("int") for epoch in range(EPOCHS))


def schedule(docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source") -> Schedule:
    """When each document's copies finish, and where the mix ends; only ids, sizes and sources are moved for that.

    The budget is SHARE of all words. Null sources are one source, the last; null texts have size 0 and are never
    taken; rows of the same id are shuffled together but count each; an empty table stays empty. Reruns agree, as the
    shuffle is a hash of the id.
    """
    keyed = docs.withColumns({"size": size_of(text), "_queue_source": F.col(source), "_key": shuffle_key(id_column)})
    narrow = stored(keyed.select(F.col(id_column).alias("_doc"), "size", "_queue_source", "_key"), "mix-sizes")
    sources = narrow.groupBy(F.col("_queue_source").alias("source")).agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows")
    )
    sources = stored(targets(sources), "mix-targets")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    rows = stored(queued(narrow, sources, "_doc"), "mix-times")
    return Schedule(keyed, sources, rows, find_cut(rows, total * SHARE[0] // SHARE[1]))


def mixture(docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of ``docs`` whatever their names."""
    packed = docs.select(
        F.struct(*docs.columns).alias("_row"),
        F.col(id_column).alias("_doc"),
        F.col(text).alias("_text"),
        F.col(source).alias("_source"),
    )
    plan = schedule(packed, "_doc", "_text", "_source")
    whole = queued(plan.keyed.select("_row", "_doc", "size", "_queue_source", "_key"), plan.sources, "_doc")
    taken = whole.withColumn("_copies", plan.copies()).where("_copies > 0")
    return taken.select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_row.*")


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    plan = schedule(common.documents(spark, folder).select("doc_id", "text", "source"))
    return plan.rows.select(
        F.col("_doc").alias("doc_id"), "size", "source_size", "target", (F.col("size") * plan.copies()).alias("taken")
    )


OP3_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS k
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS HUGEINT) AS source_size,
         row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS place
  FROM sized GROUP BY source),
weighted AS (
  SELECT *, CAST(CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS HUGEINT) AS w FROM sources),
filled AS (
  SELECT *, 3 * sum(source_size) OVER () AS budget, sum(w) OVER () AS all_w,
         coalesce(sum(4 * source_size) OVER before, 0) AS gone, coalesce(sum(w) OVER before, 0) AS gone_w
  FROM weighted
  WINDOW before AS (ORDER BY source_size / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
stopped AS (SELECT *, 4 * source_size * (all_w - gone_w) <= w * (budget - gone) AS stop FROM filled),
rest AS (
  SELECT max(budget) - coalesce(sum(4 * source_size) FILTER (stop), 0) AS r, coalesce(sum(w) FILTER (NOT stop), 0) AS rw
  FROM stopped),
aimed AS (
  SELECT source, place, CAST(source_size AS BIGINT) AS source_size,
         CASE WHEN stop THEN CAST(2 * source_size AS DOUBLE) ELSE CAST(w * r AS DOUBLE) / CAST(2 * rw AS DOUBLE) END AS target
  FROM stopped, rest),
queued AS (
  SELECT row_number() OVER () AS rid, doc_id, size, source_size, target, place,
         CAST(sum(size) OVER (PARTITION BY place ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS done
  FROM sized JOIN aimed ON sized.source IS NOT DISTINCT FROM aimed.source),
copies AS (
  SELECT rid, size, place, (done + e * source_size) / target AS t
  FROM queued, unnest([0, 1]) AS r(e) WHERE size > 0 AND target > 0),
running AS (SELECT rid, size, sum(size) OVER (ORDER BY t, place ROWS UNBOUNDED PRECEDING) AS words FROM copies),
taken AS (
  SELECT rid, CAST(sum(size) AS BIGINT) AS taken FROM running
  WHERE words <= (SELECT sum(size) * 3 // 2 FROM sized) GROUP BY rid)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken FROM queued LEFT JOIN taken USING (rid)
"""
