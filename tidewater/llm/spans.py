"""Spans found in texts, and their digest columns."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, prepare

SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float32())])
SPANS = "array<struct<kind:string,start:int,end:int,score:float>>"


def find_spans(docs: DataFrame, find, id_col: str, text_col: str, keep_row: bool = False) -> DataFrame:
    """``find(text)`` gives (kind, start, end, score) in order; per row: id and
    spans, with ``keep_row`` also the whole input row as struct ``row``."""
    prepare(docs.sparkSession)

    def run(batches):
        for b in batches:
            spans = [[{"kind": k, "start": s, "end": e, "score": c} for k, s, e, c in (find(t) if t else ())] for t in b.column(1).to_pylist()]
            cols, names = [b.column(0), pa.array(spans, pa.list_(SPAN))], ["doc_id", "spans"]
            if keep_row:
                cols, names = [*cols, b.column(2)], [*names, "row"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    rows = docs.select(column(id_col).cast("long").alias("doc_id"), column(text_col).cast("string").alias("text"),
                       *([F.struct("*").alias("row")] if keep_row else []))
    schema = f"doc_id long, spans {SPANS}"
    schema = T.StructType.fromDDL(schema)
    if keep_row:
        schema = schema.add("row", rows.schema["row"].dataType)
    return rows.mapInArrow(run, schema)


def count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def base_digest(kinds: list[str]) -> Column:
    return F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin(kinds))), 256)
