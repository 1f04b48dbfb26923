"""Dead-letter routing and replay (K7, P9, ST10, ST12, ST16).

One decoded batch feeds two outputs: usable records go on to the sink, the
rest become dead-letter messages that keep the original bytes and carry the
error context as headers.  Both sides are projections of the same parsed
DataFrame; a streaming caller persists the batch once and writes the
dead letters first (``streaming.pipelines``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import wire
from tidewater.operators.ingest import envelope_problem, envelope_usable
from tidewater.schemas import (
    DLQ_EXCEPTION_CLASS,
    DLQ_EXCEPTION_MESSAGE,
    DLQ_HEADER_PREFIX,
    DLQ_HEADERS,
    DLQ_STAGE,
    ENVELOPE_FIELDS,
)


def _bytes(c: Column) -> Column:
    return F.encode(c.cast("string"), "UTF-8")


def dead_letters(
    parsed: DataFrame,
    source_topic: str,
    connector: str,
    task_id: int = 0,
) -> DataFrame:
    """Unusable envelopes as dead-letter rows: key/value kept, headers added.

    ``parsed`` comes from ``ingest.parse_envelope(messages, keep=[...])`` and
    must keep ``key``, ``partition`` and ``offset`` of the source message.
    """
    bad = parsed.where(envelope_usable(False))
    message = F.when(F.size(F.coalesce(F.col("_missing"), F.array())) > 0,
                     F.lit(DLQ_EXCEPTION_MESSAGE)).otherwise(envelope_problem())
    values = {
        "topic": F.lit(source_topic),
        "partition": F.col("partition"),
        "offset": F.col("offset"),
        "connector.name": F.lit(connector),
        "task.id": F.lit(task_id),
        "stage": F.lit(DLQ_STAGE),
        "exception.class.name": F.lit(DLQ_EXCEPTION_CLASS),
        "exception.message": message,
    }
    headers = F.array(*[
        F.struct(F.lit(DLQ_HEADER_PREFIX + k).alias("key"), _bytes(values[k]).alias("value"))
        for k in DLQ_HEADERS
    ])
    return bad.select(
        "key", "value", F.col("partition").alias("source_partition"),
        F.col("offset").alias("source_offset"), headers.alias("headers"))


def header(name: str) -> Column:
    """Text of one dead-letter context header (NULL when absent)."""
    found = F.filter("headers", lambda h: h["key"] == F.lit(DLQ_HEADER_PREFIX + name))
    return F.decode(F.get(found, 0)["value"], "UTF-8")


def describe(dlq: DataFrame) -> DataFrame:
    """Dead-letter topic rows with their context headers as columns."""
    return dlq.select(
        "partition", "offset",
        header("topic").alias("orig_topic"),
        header("partition").cast("int").alias("orig_partition"),
        header("offset").cast("long").alias("orig_offset"),
        header("stage").alias("stage"),
        header("exception.class.name").alias("exception_class"),
        header("exception.message").alias("exception_message"),
    )


_CONNECT_CAST = {"string": "string", "double": "double", "int32": "int"}


def repair_envelope(value: str | Column, fixes: dict[str, Column],
                    fields=ENVELOPE_FIELDS) -> Column:
    """Re-encode an envelope with ``fixes`` applied where the payload is NULL.

    ``fixes`` maps a field name to an expression over ``payload`` (the text map
    bound by this function, see :func:`payload_value`).
    """
    env = wire.decode_envelope(value)
    payload = env["payload"]
    cols = []
    for f, t, _ in fields:
        current = F.try_element_at(payload, F.lit(f)).cast(_CONNECT_CAST[t])
        if f in fixes:
            current = F.coalesce(current, fixes[f](payload).cast(_CONNECT_CAST[t]))
        cols.append(current.alias(f))
    return F.to_json(
        F.struct(env["schema"].alias("schema"), F.struct(*cols).alias("payload")),
        {"ignoreNullFields": "false"},
    )


def payload_value(payload: Column, field: str, dtype: str = "double") -> Column:
    return F.try_element_at(payload, F.lit(field)).cast(dtype)
