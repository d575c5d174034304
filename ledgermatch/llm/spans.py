"""Spans in texts: the shared shape of what the secret and personal-data scans return."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

Finder = Callable[[str], list[tuple[str, int, int]]]


def scanned(docs: DataFrame, make_finder: Callable[[], Finder]) -> DataFrame:
    """``doc_id, spans`` per document; ``make_finder`` runs once in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = make_finder()
        for b in batches:
            found = [[{"kind": k, "start": s, "end": e} for k, s, e in find(t.as_py())] for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(SPAN))], ["doc_id", "spans"])

    rows = docs.select("doc_id", text_of().alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, spans array<struct<kind:string,start:long,end:long>>")


def listed(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame, base_kinds: list[str]) -> DataFrame:
    """Counts per base kind, the hash of the base spans, and all spans as text."""
    base = F.filter("spans", lambda s: s["kind"].isin(base_kinds))
    counts = [F.size(_of_kind(k)).cast("long").alias(f"n_{k}") for k in base_kinds]
    return found.select("doc_id", *counts, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))


def _of_kind(kind: str) -> Column:
    return F.filter("spans", lambda s: s["kind"] == kind)


def by_start(found: list[tuple[str, int, int]], kinds: list[str]) -> list[tuple[str, int, int]]:
    return sorted(found, key=lambda s: (s[1], kinds.index(s[0])))
