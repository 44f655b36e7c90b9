"""Typed character spans of a text as a column, and the digests that queries report of them."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm import common

SCHEMA = "array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"
ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

Span = tuple[str, int, int]
# Gives the base spans of a text and further ones that the method adds.
Finder = Callable[[str], tuple[Iterable[Span], Iterable[Span]]]


def with_spans(
    docs: DataFrame, text: str, spans: str, kinds: tuple[str, ...], make: Callable[[], Finder]
) -> DataFrame:
    """``docs`` with an array of (kind, start, end, base) by start, then kind as listed, then end.

    ``make`` is called once per task. Null texts count as empty; a column named ``spans`` is replaced.
    """
    kept = [f for f in docs.schema.fields if f.name != spans]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), f"`{spans}` {SCHEMA}"])
    finders: list[Finder] = []

    def order(found: tuple[Span, bool]) -> tuple[int, int, int]:
        (kind, start, end), _ = found
        return start, kinds.index(kind), end

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not finders:
            finders.append(make())
        rows = []
        for value in batch.column(text).to_pylist():
            base, more = finders[0](value or "")
            both = sorted([(s, True) for s in base] + [(s, False) for s in more], key=order)
            rows.append([{"kind": k, "start": a, "end": b, "base": own} for (k, a, b), own in both])
        columns = [batch.column(f.name) for f in kept] + [pa.array(rows, ARROW)]
        return pa.RecordBatch.from_arrays(columns, [*(f.name for f in kept), spans])

    return common.map_batches(docs, schema, work)


def span_list(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def digests(scanned: DataFrame, kinds: tuple[str, ...], id_column: str = "doc_id") -> DataFrame:
    """Counts by kind and a digest of the base spans, and all spans, of each document."""
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    return scanned.select(
        id_column,
        *[count(kind).alias(f"n_{kind}") for kind in kinds],
        F.sha2(span_list(base), 256).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"),
    )
