"""Session helpers: the shared work folder, fitted-table caching and size-checked joins."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A lookup table is broadcast only when a count proves it is no longer than this.
BROADCAST_ROWS = 1_000_000
# Row bound for lookup tables that carry whole review texts.
BROADCAST_TEXT_ROWS = 5_000
# Copies of a lookup table too long to broadcast; spreads every hot key over that many tasks.
SALTS = 16
# Rows of all its copies together, at most; a longer table gets fewer of them, down to one.
COPIED_ROWS = 8_000_000


def build_session(app: str = "opinara", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; a temporary one only on a local master."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="opinara-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(configured)
    return configured.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """A table written to the shared folder and read again: computed once, held by no executor's memory."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def materialise(df: DataFrame) -> tuple[DataFrame, int]:
    """A stored table and its length, so its size is known before it is joined."""
    kept = stored(df, "fitted")
    return kept, kept.count()


def lookup_join(
    big: DataFrame,
    table: DataFrame,
    on: list[str],
    how: str = "inner",
    table_rows: int | None = None,
    max_rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Join a long table with a lookup table holding one row per key.

    A table proven short is broadcast. A longer one is shuffled with salted keys, so a key that
    fills a third of ``big`` is still spread over ``salts`` tasks. Its copies are never broadcast: Spark
    sizes them by the compressed file and without the explode. A very long table gets fewer salts, as its copies would
    outweigh ``big``; adaptive execution then splits the parts of hot keys.
    """
    if table_rows is None:
        table_rows = table.limit(max_rows + 1).count()
    if table_rows <= max_rows:
        return big.join(F.broadcast(table), on, how)
    salts = min(salts, COPIED_ROWS // table_rows)
    if salts <= 1:
        return big.join(table.hint("merge"), on, how)
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(*big.columns), F.lit(salts)).cast("int"))
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies.hint("merge"), [*on, "_salt"], how).drop("_salt")


def sized(table: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One side of a join: broadcast if its counted rows are few, else sorted and merged, whatever size Spark takes it for."""
    return F.broadcast(table) if table.limit(max_rows + 1).count() <= max_rows else table.hint("merge")


def small_values(df: DataFrame, column: str, limit: int = 100_000) -> list:
    """Sorted distinct non-null values of a column that a fitted model keeps anyway (class labels, categories)."""
    found = df.select(column).where(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"column {column} has more than {limit} distinct values")
    return sorted(row[0] for row in found)


def generate_rows(df: DataFrame, count: str, index: str, block: int = 65_536) -> DataFrame:
    """Repeat each row ``count`` times with a 0-based ``index``.

    Works in two explodes with a repartition between, so one row asking for a billion copies
    neither builds a billion-element array nor stays in one task.
    """
    blocks = df.where(F.col(count) > 0).withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(count) - 1) / block)))
    )
    spread = blocks.repartition("_block", *[c for c in df.columns if c != count])
    first = F.col("_block") * block
    last = F.least(first + block, F.col(count).cast("long")) - 1
    return spread.withColumn(index, F.explode(F.sequence(first, last))).drop("_block")
